"""Identifiers written in groups are found whole, by their context."""

from settlekit.llm import pii


def test_contexts_find_identifiers_written_in_groups(spark):
    rows = [(1000 + n, f"Please call my number +1 (2{n:02d}) 555-01{n:02d} before noon") for n in range(60)]
    rows += [(2000 + n, f"charge the card 4{n:03d} 0000 0000 {last} after delivery") for n, last in _cards()]
    ids = {50: "0301 5550123", 52: "030-5550177", 53: "(017) 555-7713", 54: "030 1234 5678", 55: "030.1234.5678"}
    rows += [(k, f"Please call my number {x} before noon") for k, x in ids.items()]
    rows += [(51, "The year was 20240101 in the books"), (56, "call my number (0301 5550188) before noon"),
             (57, "charge the card 4111 1111 1111 1112 after delivery"), (58, "seen 12 3456 78 times"),
             (59, "a@b.cc 10.0.0.1 Please call my number 0301 5550199, before noon"),
             (60, "1 " * 9000), (61, "(1) " * 9000), (62, "1.(" * 9000)]
    out = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, x in ids.items():
        assert [(s.kind, s.start, s.end) for s in out[k].spans] == [("phone", 22, 22 + len(x))], k
    assert not out[51].spans and not out[58].spans and not out[60].spans
    assert [(s.kind, s.start, s.end) for s in out[56].spans] == [("phone", 16, 28)]
    assert [(s.kind, s.start, s.end) for s in out[57].spans] == [("card", 16, 35)]
    assert [(s.kind, s.start, s.end) for s in out[59].spans] == [("email", 0, 6), ("ip", 7, 15), ("phone", 38, 50)]


def _cards():
    """(n, last four digits) that pass the check digit."""
    for n in range(100, 112):
        for last in range(1000, 1010):
            digits = [int(c) for c in f"4{n:03d}00000000{last}"]
            if sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0:
                yield n, last
