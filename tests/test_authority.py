import pytest
from pyspark.sql import functions as F

from textloom.functions import records as rec
from textloom.operators import authority
from textloom.sources.writers import write_vocabulary

BASE = "https://authority.example/"


def field(tag, *subfields, occurrence=""):
    return (tag, occurrence, list(subfields))


RECORDS = [
    ("10", [field("002@", ("0", "Tp1")), field("041A", ("9", "11"))]),
    ("11", [field("002@", ("0", "Ts1"))]),
    ("12", [field("002@", ("0", "Tuz"))]),
    ("13", [field("002@", ("0", "Tp2"))]),
    ("b1", [field("041A", ("9", "10"), ("a", "11"), occurrence="01"), field("041A", ("a", "12"))]),
    ("b2", [field("041A", ("9", "10"), ("9", "10"), ("9", "")), field("044K", ("9", "12"))]),
    ("b3", [field("044K", ("9", "12")), field("010@", ("a", "ger"))]),
    ("b4", []),
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(RECORDS, rec.RECORD_SCHEMA).withColumn("seq", F.monotonically_increasing_id())


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("code", "kind"),
    [("Tb1", "corporate-body"), ("Tf1", "conference"), ("Tg1", "place-or-geo-name"),
     ("Tp1", "person"), ("Ts1", "subject-heading"), ("Tu1", "work")],
)
def test_kind(spark, code, kind):
    assert value(spark, rec.authority_kind(F.lit(code))) == kind


@pytest.mark.parametrize("code", ["Tp", "Tx1", "", None])
def test_invalid_kind(spark, code):
    with pytest.raises(Exception, match="invalid|without"):
        value(spark, rec.authority_kind(F.lit(code).cast("string")))


def test_record_filter(records):
    found = records.where(rec.is_authority(F.col("fields"))).select("record_id").collect()
    assert [r[0] for r in found] == ["10", "11", "12"]


def test_paths(records):
    def values(**options):
        column = rec.subfield_values(F.col("fields"), "041A", ["9", "a"], **options)
        return records.where("record_id = 'b1'").select(column.alias("v")).first()["v"]

    assert values(occurrence="*", having="9") == ["10", "11"]
    assert values(occurrence="*") == ["10", "11", "12"]
    assert values() == ["12"]
    assert values(occurrence="01") == ["10", "11"]
    assert values(occurrence="02") == []


def test_links(records):
    def links(*rules):
        found = authority.link_counts(authority.record_links(records, rules))
        return {r["target"]: r["links"] for r in found.collect()}

    default = authority.LinkRule()
    # Code 13 is no valid authority code, so that record counts as one with links: none.
    assert links(default) == {"10": 2, "11": 1}
    other = authority.LinkRule(tag="044K", codes=("9",))
    assert links(default, other) == {"10": 2, "11": 1, "12": 2}
    german = authority.LinkRule(
        tag="044K", codes=("9",), where=lambda f: rec.any_subfield(f, "010@", "a", lambda v: v == "ger")
    )
    assert links(german) == {"12": 1}


def test_repeated_pairs(spark):
    pairs = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y")], "record_id long, target string")
    got = authority.link_counts(pairs, distinct=False).collect()
    assert {r["target"]: r["links"] for r in got} == {"x": 2, "y": 1}


def test_vocabulary(spark, records, tmp_path):
    vocabulary = authority.authority_vocabulary(
        records, BASE, thresholds={"person": 2, "subject-heading": 2, "conference": 9}
    )
    got = [(r["ppn"], r["kind"], r["links"]) for r in vocabulary.collect()]
    assert got == [("10", "person", 2), ("12", "work", 0)]
    write_vocabulary(vocabulary, str(tmp_path / "v"))
    rows = spark.read.csv(str(tmp_path / "v"), header=True, inferSchema=False).collect()
    assert [tuple(r) for r in rows] == [
        (BASE + "10", "PPN: 10", None),
        (BASE + "12", "PPN: 12", None),
    ]


def test_last_record_wins(spark):
    rows = [("1", [field("002@", ("0", "Tp1"))], 1), ("1", [field("002@", ("0", "Tg1"))], 2)]
    df = spark.createDataFrame(rows, rec.RECORD_SCHEMA + ", seq long")
    got = authority.authorities(df, BASE, order_by="seq").collect()
    assert [(r["ppn"], r["kind"]) for r in got] == [("1", "place-or-geo-name")]


@pytest.mark.parametrize(
    ("a", "b", "ignore", "expected"),
    [("abcd", "abcd", False, 1.0), ("abcd", "abce", False, 0.75), ("", "", False, 1.0),
     ("ABC", "abc", False, 0.0), ("ABC", "abc", True, 1.0), ("abc", "", False, 0.0)],
)
def test_similarity(spark, a, b, ignore, expected):
    assert value(spark, rec.similarity(F.lit(a), F.lit(b), ignore)) == expected
    assert value(spark, rec.similar(F.lit(a), F.lit(b), 0.75, ignore)) == (expected >= 0.75)


def test_one_row_per_identifier(spark, records):
    twice = records.union(records)
    found = [r["ppn"] for r in authority.authorities(twice, "u/").collect()]
    assert len(found) == len(set(found)) > 0
