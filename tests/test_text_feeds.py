"""Text feeds are bound by name: reordered, missing, further and repeated
columns, files of several layouts, compressed and empty files."""

import gzip
import json

import pytest

import __spark_entry__ as entry
from conftest import SF001
from settlekit import schemas
import derived_queries as catalog
from settlekit.sources.feeds import FeedSchemaError, read_feed
from settlekit.sources.textfeeds import files_of

NAMES = [f.name for f in schemas.INTERNAL.fields]
ROW = dict(zip(NAMES, ["TRD-1", "2025-01-02", "2025-01-04", "TKR", "BUY", "100", "10.5", "Some, Bank", "USD", "1050.0",
                       "internal", "TR1", "DESK", "10:00:00"]))


def _write(path, columns, rows, opener=open):
    cell = lambda v: f'"{v}"' if "," in v else v
    with opener(path, "wt") as f:
        f.write(",".join(columns) + "\n")
        for r in rows:
            f.write(",".join(cell(r[c]) for c in columns) + "\n")


def _rows(spark, path, **options):
    return [r.asDict() for r in read_feed(spark, "internal", str(path), "csv", **options).collect()]


@pytest.fixture
def straight(spark, tmp_path):
    _write(tmp_path / "straight.csv", NAMES, [ROW])
    return _rows(spark, tmp_path / "straight.csv")


def test_swapped_columns_give_the_same_rows(spark, tmp_path, straight):
    swapped = list(NAMES)
    swapped[5], swapped[6] = swapped[6], swapped[5]
    _write(tmp_path / "a.csv", swapped, [ROW])
    assert _rows(spark, tmp_path / "a.csv") == straight
    assert straight[0]["quantity"] == 100 and straight[0]["price"] == 10.5 and straight[0]["counterparty"] == "Some, Bank"


def test_files_of_several_layouts(spark, tmp_path, straight):
    d = tmp_path / "feed"
    d.mkdir()
    _write(d / "a.csv", NAMES, [ROW])
    _write(d / "b.csv", NAMES[::-1], [ROW, ROW])
    _write(d / "c.csv", ["further", *NAMES[3:], "own", *NAMES[:3]], [ROW | {"further": "x", "own": "y"}])
    _write(d / "d.csv.gz", [*NAMES[7:], *NAMES[:7]], [ROW], gzip.open)
    (d / "empty.csv").write_text("")
    _write(d / "header-only.csv", NAMES, [])
    (d / "_SUCCESS").write_text("")
    assert len(files_of(spark, str(d))) == 5      # Spark lists no empty files
    assert _rows(spark, d) == straight * 5
    assert _rows(spark, f"{d}/[ab].csv") == straight * 3


def test_missing_column_names_the_file(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    _write(d / "a.csv", NAMES, [ROW])
    _write(d / "b.csv", [c for c in NAMES if c != "currency"], [ROW])
    with pytest.raises(FeedSchemaError, match=r"currency.*b\.csv"):
        read_feed(spark, "internal", str(d), "csv")
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(FeedSchemaError, match="no file with a header"):
        read_feed(spark, "internal", str(tmp_path / "none.csv"), "csv")


def test_odd_headers(spark, tmp_path, straight):
    """A byte order mark, quoted names, a name twice, other separators and line ends."""
    text = "﻿" + ";".join(f'"{c}"' for c in NAMES) + ';price\r\n' + ";".join(
        ROW[c] for c in NAMES) + ";99.0\r\n"
    (tmp_path / "a.csv").write_bytes(text.encode())
    assert _rows(spark, tmp_path / "a.csv", sep=";") == straight


def test_without_header(spark, tmp_path, straight):
    (tmp_path / "a.csv").write_text(",".join(f'"{ROW[c]}"' for c in reversed(NAMES)) + "\n")
    with pytest.raises(FeedSchemaError, match="needs columns"):
        read_feed(spark, "internal", str(tmp_path / "a.csv"), "csv", header="false")
    assert _rows(spark, tmp_path / "a.csv", header="false", columns=NAMES[::-1]) == straight


def test_json_by_name(spark, tmp_path, straight):
    full, late = tmp_path / "full.json", tmp_path / "late.json"
    full.write_text(json.dumps({k: ROW[k] for k in reversed(NAMES)} | {"further": 1}) + "\n")
    assert [r.asDict() for r in read_feed(spark, "internal", str(full), "json").collect()] == straight
    # a key that only the last row has is there; one that no row has is missing
    late.write_text("".join(json.dumps({k: v for k, v in ROW.items() if k != "desk"}) + "\n" for _ in range(900))
                    + json.dumps(ROW) + "\n")
    assert read_feed(spark, "internal", str(late), "json").filter("desk is not null").count() == 1
    two = tmp_path / "two.json"
    two.write_text('{"trade_id": "T", "price": 1.0}\n')
    with pytest.raises(FeedSchemaError, match="settlement_date"):
        read_feed(spark, "internal", str(two), "json")


def test_other_formats(spark, tmp_path):
    """Any reader format; orc here."""
    feed = catalog.shared_feeds(spark, SF001).exchange
    feed.select(*reversed(feed.columns)).write.orc(str(tmp_path / "orc"))
    back = read_feed(spark, "exchange", str(tmp_path / "orc"), "orc")
    assert back.columns == feed.columns and back.exceptAll(feed).count() == 0 and back.count() == feed.count()
    with pytest.raises(FeedSchemaError):
        read_feed(spark, "internal", str(tmp_path / "orc"), "orc")


def test_query_on_text_feeds(spark):
    a = entry.queries()["text_feed_recon"](spark, SF001)
    b = entry.queries()["three_way_recon"](spark, SF001)
    assert a.count() == 1500 and a.exceptAll(b.select(a.columns)).count() == 0
