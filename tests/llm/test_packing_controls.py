"""Control characters are tokens, also those that str.split cuts at."""

import numpy as np

from settlekit.llm import packing


def test_every_control_character_gives_the_tokenizers_ids():
    import public_tokenizers
    tok = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    odd = [*map(chr, range(33)), "\x7f", "\x85", "\xa0", " ", "　", "\x1c\x1d", "\x1f \x01", "\x1eé"]
    for x in odd:
        for text in (f"hello{x}world", f"{x}a {x} b{x}", f"{x}", f"Él{x}l'a dit {x}"):
            want = np.array(tok.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert tok.encode(text) == want, repr(text)
