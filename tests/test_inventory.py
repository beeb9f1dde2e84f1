import hashlib

import pytest

from textloom.operators import inventory
from textloom.operators.compound import Remote, compound_index, remote_counts
from textloom.operators.shrink import shrink_schema
from textloom.operators.summary import summary, summary_display, summary_json


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def files(docs_of):
    return docs_of({"same": "a", "edited": "bb!", "touched": "c", "resized": "d", "new": "e", "also new": ""})


@pytest.fixture
def index(spark):
    base = 1_700_000_000
    rows = [
        ("same", sha("a")[:8], base, 1),
        ("edited", sha("bb")[:8], base + 1, 2),
        ("touched", sha("c")[:8], base, 1),
        ("resized", sha("d")[:8], base + 3, 9),
        ("gone", sha("x")[:8], base, 1),
    ]
    return spark.createDataFrame(rows, "path string, hash string, mtime int, size short")


def test_status(index, files):
    rows = {r["path"]: tuple(r)[:4] for r in inventory.status(index, files).collect()}
    assert rows == {
        "edited": ("changed", False, True, False),
        "touched": ("changed", True, False, True),
        "resized": ("changed", True, True, False),
        "gone": ("missing", None, None, None),
        "new": ("untracked", None, None, None),
        "also new": ("untracked", None, None, None),
    }


def test_clean(index, files):
    assert [r["path"] for r in inventory.missing(index, files).collect()] == ["gone"]
    assert [r["path"] for r in inventory.untracked(index, files).collect()] == ["also new", "new"]
    assert tuple(inventory.counts(index, files).first()) == (1, 2)
    pruned = inventory.prune(index, files)
    assert pruned.columns == index.columns
    assert {r["path"] for r in pruned.collect()} == {"same", "edited", "touched", "resized"}


def test_verify(index, files):
    def reasons(mode):
        return {r["path"]: r["reason"] for r in inventory.violations(index, files, mode).collect()}

    loose = {"gone": "file not found", "edited": "hash mismatch"}
    assert reasons("permissive") == loose
    assert reasons("strict") == loose | {"touched": "mtime mismatch"}
    assert reasons("pedantic") == loose | {"touched": "mtime mismatch", "resized": "size mismatch"}
    with pytest.raises(ValueError, match="gone"):
        inventory.verify(index.where("path = 'gone'"), files, "permissive")
    inventory.verify(index.where("path IN ('same', 'resized')"), files)
    with pytest.raises(ValueError, match="mode"):
        inventory.violations(index, files, "lax")


def entries(spark, rows):
    return spark.createDataFrame(
        rows, "remote string, doctype string, ppn string, hash string, size long"
    )


def test_summary(spark):
    index = entries(
        spark,
        [("r", "book", "1", "h1", 1000), ("r", "book", "2", "h1", 24), ("r", "toc", "3", "h1", 5),
         ("s", "book", "4", "h1", 7), ("s", "book", "5", "h2", 0)],
    )
    assert [tuple(r) for r in summary(index).collect()] == [
        ("r", "book", 2, 1024, 1),
        ("s", "book", 2, 7, 0),
        ("r", "toc", 1, 5, 0),
    ]
    assert summary_json(index).first()["summary"] == (
        '{"book":{"docs":4,"size":1031,"duplicates":1},"toc":{"docs":1,"size":5,"duplicates":0}}'
    )
    assert tuple(summary_display(index).first()) == ("r", "book", "2", "1 KiB", "1")


def test_compound(spark, tmp_path):
    a = entries(spark, [("a", "book", "1", "h", 10), ("a", "toc", "2", "h", 20)])
    narrow = shrink_schema(entries(spark, [("b", "book", "3", "h", 300)]))
    narrow.write.parquet(str(tmp_path / "b"))
    remotes = [Remote("a", a, "size > 10"), Remote("b", str(tmp_path / "b")), Remote("c", a, "size < 0")]
    got = compound_index(remotes, spark)
    assert dict(got.dtypes)["size"] == "bigint"
    assert sorted((r["ppn"], r["size"]) for r in got.collect()) == [("2", 20), ("3", 300)]
    assert sorted(tuple(r) for r in remote_counts(remotes, spark).collect()) == [("a", 1), ("b", 1), ("c", 0)]
    with pytest.raises(ValueError):
        compound_index([])


def test_shrink(spark):
    df = spark.createDataFrame(
        [(-128, 128, 40_000, 2**31, None, "x", 0.5), (127, 0, 0, 0, None, "y", 1.5)],
        "a long, b long, c int, d long, e long, `f.g` string, h double",
    )
    small = shrink_schema(df)
    assert [t for _, t in small.dtypes] == (
        ["tinyint", "smallint", "int", "bigint", "tinyint", "string", "double"]
    )
    assert small.columns == df.columns
    assert [tuple(r) for r in small.collect()] == [tuple(r) for r in df.collect()]
