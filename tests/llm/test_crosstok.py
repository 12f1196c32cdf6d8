"""Operator 13 against a plain alignment."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from settlekit.llm import catalog, crosstok

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from odd_table import odd_table  # noqa: E402

SF001 = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        letters = {c: b for b, c in crosstok._byte_letters().items()}
        self.bytes_a = lambda i: bytes(letters[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        """[(A ids, B ids)] of the groups and [(A id, B id)] of the links."""
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a, a)) != raw or b"".join(map(self.bytes_b, b)) != raw:
            return [], []
        spans = []
        for ids, of in ((a, self.bytes_a), (b, self.bytes_b)):
            ends = np.cumsum([len(of(i)) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends, ids)))
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, ia, ib = [], 0, 0
        for e in ends:
            ga, gb = [], []
            while ia < len(a) and spans[0][ia][1] <= e:
                ga.append(spans[0][ia])
                ia += 1
            while ib < len(b) and spans[1][ib][1] <= e:
                gb.append(spans[1][ib])
                ib += 1
            groups.append((ga, gb))
        links = [(x[2], y[2]) for ga, gb in groups for x in ga for y in gb if x[0] < y[1] and y[0] < x[1]]
        return [([x[2] for x in ga], [y[2] for y in gb]) for ga, gb in groups], links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def want(plain, rows):
    found = [(k, *plain.groups(t)) for k, t in rows]
    corpus = Counter(x for _, _, links in found for x in links)
    most = Counter()
    for (_, b), n in corpus.items():
        most[b] = max(most[b], n)
    out = Counter()
    for k, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[k, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(corpus[x] == most[x[1]] for x in links), sum(corpus[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""] += 1
    return out


def run(spark, df, path):
    df.write.parquet(f"{path}/documents.parquet")
    out = catalog.QUERIES["op13_alignment"](spark, str(path))
    assert out.columns == COLUMNS and [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    return Counter(tuple(r) for r in out.collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["given", "odd", "empty"])
def test_query(spark, plain, tmp_path, table):
    df = spark.read.parquet(f"{SF001}/documents.parquet") if table == "given" else odd_table(spark)
    df = df.limit(0) if table == "empty" else df.repartition(3)
    assert run(spark, df, tmp_path / table) == want(plain, rows_of(df))


def test_small_blocks_and_lanes_change_nothing(plain, monkeypatch):
    al = crosstok.Aligner(A, B)
    rng = random.Random(2)
    texts = ["", None, "one▁two", "a", "x" * 500, "漢字 ß İ \U0001F600 end"] + [
        "".join(rng.choices("abetr \n漢é.,<|endoftext|>", k=rng.randint(1, 300))) for _ in range(60)]
    docs = [al.tokens(t) for t in texts]
    whole = crosstok._block(al, docs)
    monkeypatch.setattr(crosstok, "LANE", 3)
    lanes = crosstok._block(al, docs)
    assert whole[0] == lanes[0] and whole[1][2] == lanes[1][2]
    assert all((x == y).all() for x, y in zip(whole[1][:2], lanes[1][:2]))
    for text, row in zip(texts, lanes[0]):
        groups, links = plain.groups(text)
        assert row[1:5] == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links))
        assert row[5] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    codes, copies, held = lanes[1]
    doc, which, times = crosstok._held(held)
    back = Counter()
    for d, w, n in zip(doc.tolist(), which.tolist(), times.tolist()):
        back[d, *divmod(int(codes[w]), al.b.size)] += n
    assert back == Counter((d, *x) for d, t in enumerate(texts) for x in plain.groups(t)[1])
    assert copies.sum() == sum(back.values())


def test_many_blocks(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(crosstok, "BLOCK", 500)
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    assert run(spark, df, tmp_path) == want(plain, rows_of(df))


def test_unstable_characters_go_to_the_files_own_library():
    al = crosstok.ByteLevel(A)
    assert al.other("漢") and not al.other("Él l'a dit — “ça” 3 €")
    assert al.ids(" 漢字 ok") == al.full.encode(" 漢字 ok", add_special_tokens=False).ids
