import json

import pytest

from textloom.operators.ratings import EVENT_SCHEMA, LOG_COLUMNS, admit, latest_ratings, worklist
from textloom.streaming.ratings import (
    ingest_ratings,
    log_stream,
    rating_events,
    read_log,
    read_progress,
    read_rejected,
    track_ratings,
)

EVENTS = [
    ("p1", "h", "C", "", "ann", "s1", "accepted", None),
    ("p2", "h", "P+", "ok", "bob", "s2", "accepted", None),
    ("p1", "h", "C", "", "eve", "s1", "unauthorized", "unknown user"),
    ("p9", "h", "X", "", "ann", "s2", "unauthorized", "wrong secret"),
    ("p1", "h", "C", "", "ann", None, "unauthorized", "wrong secret"),
    ("p9", "h", "X", "", "ann", "s1", "bad request", "unknown path"),
    ("p1", "h", "c", "", "ann", "s1", "bad request", "invalid rating"),
    ("p1", "h", None, "", "ann", "s1", "bad request", "invalid rating"),
]


@pytest.fixture
def users(spark):
    return spark.createDataFrame([("ann", "s1"), ("bob", "s2")], "username string, secret string")


@pytest.fixture
def paths(spark):
    return spark.createDataFrame([("p1",), ("p2",), ("p1",)], "path string")


def judged(df):
    keys = ("path", "rating", "username", "status", "reason")
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=str)


def wanted():
    return sorted(((e[0], e[2], e[4], e[6], e[7]) for e in EVENTS), key=str)


def test_admission(spark, users, paths):
    events = spark.createDataFrame([e[:6] for e in EVENTS], EVENT_SCHEMA)
    got = admit(events, users, paths)
    assert "secret" not in got.columns
    assert judged(got) == wanted()


def test_repeated_lists_are_not_broadcast(spark, users, paths):
    events = spark.createDataFrame([e[:6] for e in EVENTS], EVENT_SCHEMA)
    plan = admit(events, users, paths)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2


def test_stream_equals_batch(spark, users, paths, tmp_path):
    inbox, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    names = ("path", "hash", "rating", "comment", "username", "secret")

    def drop(name, events):
        (tmp_path / "in").mkdir(exist_ok=True)
        lines = [json.dumps(dict(zip(names, e[:6], strict=True))) for e in events]
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

    def run():
        query = ingest_ratings(rating_events(spark, inbox), users, paths, "shed", log, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    drop("a.json", EVENTS[:3])
    run()
    drop("b.json", EVENTS[3:])
    run()
    run()
    accepted = read_log(spark, log)
    assert tuple(accepted.columns) == LOG_COLUMNS
    rows = accepted.collect()
    assert {(r["remote"], r["path"], r["rating"], r["username"]) for r in rows} == {
        ("shed", "p1", "C", "ann"),
        ("shed", "p2", "P+", "bob"),
    }
    assert len(rows) == 2
    assert all(r["created_at"] > 1_700_000_000_000 for r in rows)
    everything = spark.read.parquet(log)
    assert judged(everything) == wanted()
    assert read_rejected(spark, log).count() == 6


def test_latest(spark):
    log = spark.createDataFrame(
        [("r", "p", "h", "C", "", "ann", 1), ("r", "p", "h", "I", "", "bob", 3), ("s", "p", "h", "P", "", "ann", 2)],
        "remote string, path string, hash string, rating string, comment string, username string, created_at long",
    )
    got = {(r["remote"], r["path"]): (r["rating"], r["username"], r["created_at"]) for r in latest_ratings(log).collect()}
    assert got == {("r", "p"): ("I", "bob", 3), ("s", "p"): ("P", "ann", 2)}


def test_worklist(spark):
    index = spark.createDataFrame(
        [("r", "a"), ("r", "b"), ("s", "a"), ("s", "c")], "remote string, path string"
    )
    log = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "c")], "remote string, path string")
    chosen = spark.createDataFrame([("a",), ("c",), ("c",)], "path string")
    assert sorted(tuple(r) for r in worklist(index, log).collect()) == [("r", "b"), ("s", "a"), ("s", "c")]
    assert sorted(tuple(r) for r in worklist(index, log, chosen).collect()) == [("s", "a"), ("s", "c")]
    assert worklist(index).count() == 4


def test_latest_of_equal_stamps(spark):
    rows = [("r", "p", "", "C", "", "ann", 5), ("r", "p", "", "I", "", "bob", 5), ("r", "p", "", "P", "", "zoe", 4)]
    schema = "remote string, path string, hash string, rating string, comment string, username string, created_at long"
    for order in (rows, rows[::-1]):
        (last,) = latest_ratings(spark.createDataFrame(order, schema).coalesce(1)).collect()
        assert (last["rating"], last["username"]) == ("I", "bob")


def test_busy_users_and_missing_names(spark, shuffled):
    events = [("p", "", "C", "", "busy", "s")] * 900 + [(None, "", "C", "", None, "s")] * 80 + [("q", "", "C", "", "rare", "s")] * 20
    log = spark.createDataFrame([(*e, i) for i, e in enumerate(events)], f"{EVENT_SCHEMA}, event_id int")
    users = spark.createDataFrame([("busy", "s"), ("rare", "t"), (None, "s")], "username string, secret string")
    paths = spark.createDataFrame([("p",), (None,)], "path string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        judged = admit(log, users, paths)
        keys = [c for c in shuffled(judged) if "event_id" in c]
        assert keys and all("_salt" in c for c in keys)
        assert sum("secret" in c for c in keys) == 1
        counts = {(r["reason"] or "", r["count"]) for r in judged.groupBy("reason").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {("", 900), ("unknown user", 80), ("wrong secret", 20)}


def test_progress_is_state_that_outlives_restarts(spark, users, paths, tmp_path):
    inbox, log, checkpoint, progress, state = (str(tmp_path / n) for n in ("in", "log", "check", "progress", "state"))
    (tmp_path / "in").mkdir()

    def rate(name, *ratings):
        lines = [{"path": p, "hash": "h", "rating": r, "comment": c, "username": "ann", "secret": "s1"} for p, r, c in ratings]
        (tmp_path / "in" / name).write_text("".join(json.dumps(x) + "\n" for x in lines))
        ingest_ratings(rating_events(spark, inbox), users, paths, "shed", log, checkpoint).awaitTermination(120)

    def track():
        query = track_ratings(log_stream(spark, log), progress, state)
        query.awaitTermination(120)
        assert query.exception() is None
        return sum((b.get("numInputRows") or 0) for b in query.recentProgress)

    read = []
    for name, *ratings in (("1", ("p1", "C", "a"), ("p2", "P", "b")), ("2", ("p1", "P+", "c"),), ("3", ("p1", "I", "d"), ("p9", "C", "e"))):
        rate(name, *ratings)
        read.append(track())
        want = sorted(map(str, latest_ratings(read_log(spark, log)).collect()))
        assert sorted(map(str, read_progress(spark, progress).collect())) == want and want
    track()
    assert sorted(map(str, read_progress(spark, progress).collect())) == want
    assert read == [2, 1, 1]  # each rating once; p9 is unknown
