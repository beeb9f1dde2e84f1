import pytest

from textloom.operators.index import build_index
from textloom.operators.summary import summary_json
from textloom.sources import readers, writers


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([("a", 1), ("b", 2)], "ppn string, size long")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_parquet(spark, frame, tmp_path):
    path = str(tmp_path / "out.parquet")
    writers.write_table(frame, path)
    assert rows(readers.read_index(spark, path)) == rows(frame)
    assert any(".zstd." in p.name for p in (tmp_path / "out.parquet").iterdir())
    writers.write_table(frame, path, append=True)
    assert rows(readers.read_index(spark, path)) == sorted(rows(frame) * 2)
    with pytest.raises(ValueError, match="schemas differ"):
        writers.write_table(frame.selectExpr("ppn", "cast(size as int) size"), path, append=True)
    assert readers.read_index(spark, path).count() == 4


def test_csv(spark, frame, tmp_path):
    path = str(tmp_path / "out.csv")
    writers.write_table(frame, path)
    back = readers.read_filter_list(spark, path)
    assert back.dtypes == [("ppn", "string"), ("size", "string")]
    assert rows(back) == [("a", "1"), ("b", "2")]
    writers.write_table(frame, path, append=True)
    assert readers.read_filter_list(spark, path).count() == 4
    with pytest.raises(ValueError, match="columns differ"):
        writers.write_table(frame.select("size", "ppn"), path, append=True)
    assert dict(readers.read_worklist(spark, path).dtypes)["size"] == "int"


def test_default_format(spark, frame, tmp_path):
    writers.write_table(frame, str(tmp_path / "x"), default="csv")
    assert spark.read.csv(str(tmp_path / "x"), header=True).columns == ["ppn", "size"]
    writers.write_table(frame, str(tmp_path / "y.arrow"))
    assert spark.read.parquet(str(tmp_path / "y.arrow")).count() == 2


def test_filter_list_by_suffix(spark, frame, tmp_path):
    frame.write.parquet(str(tmp_path / "list.parquet"))
    assert readers.read_filter_list(spark, str(tmp_path / "list.parquet")).dtypes == frame.dtypes


def test_stopwords(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\na\n\né\n")
    words = readers.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert [r["value"] for r in words.where(readers.long_enough(words.value, 2)).collect()] == ["the", "é"]


def test_records(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"record_id":"1","fields":[{"tag":"002@","occurrence":"","subfields":[{"code":"0","value":"Tp1"}]}]}\n'
        "broken\n"
        '{"record_id":"2","fields":[]}\n'
    )
    got = readers.read_records(spark, str(tmp_path / "r.json")).collect()
    assert [r["record_id"] for r in got] == ["1", "2"]
    assert got[0]["fields"][0]["subfields"][0]["value"] == "Tp1"


def test_corpus_files_and_snapshot(spark, tmp_path):
    for name in ("book/1.txt", "toc/2.txt", "book/3.txt"):
        file = tmp_path / "shed" / "data" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"text of {name}")
    docs = readers.read_corpus(spark, str(tmp_path / "shed"))
    index = build_index(docs, "shed").where("ppn <> '3'")
    path = str(tmp_path / "snapshot")
    listed = docs.join(index.select("path", "doctype"), "path")
    writers.write_snapshot(listed, index, path)
    assert list((tmp_path / "snapshot").glob("version-*/data/doctype=toc"))
    back, back_index = writers.read_snapshot(spark, path)
    assert rows(back.select("path")) == [("data/book/1.txt",), ("data/toc/2.txt",)]
    assert back_index.columns == index.columns
    writers.write_snapshot(listed.where("doctype = 'toc'"), index, path + "2")
    with pytest.raises(ValueError, match="no document"):
        writers.read_snapshot(spark, path + "2")
    with pytest.raises(ValueError, match="lacks"):
        writers.read_snapshot(spark, str(tmp_path / "nothing"))


def test_write_index(spark, docs_of, tmp_path):
    index = build_index(docs_of({"data/toc/1.txt": "one two"}), "shed")
    writers.write_index(index, str(tmp_path / "index.parquet"))
    back = readers.read_index(spark, str(tmp_path / "index.parquet"))
    assert back.columns == index.columns
    types = dict(back.dtypes)
    assert (types["words"], types["size"], types["mtime"]) == ("tinyint", "tinyint", "int")
    assert rows(back) == rows(index)


def test_json(spark, tmp_path):
    index = spark.createDataFrame([("r", "toc", "1", "h", 3)], "remote string, doctype string, ppn string, hash string, size long")
    writers.write_json(summary_json(index), str(tmp_path / "summary"))
    text = "".join(p.read_text() for p in (tmp_path / "summary").glob("part-*"))
    assert text.strip() == '{"toc":{"docs":1,"size":3,"duplicates":0}}'


def test_write_back_where_it_was_read(spark, tmp_path):
    path = str(tmp_path / "index.parquet")
    writers.write_table(spark.range(10).selectExpr("id AS size", "CAST(id AS STRING) AS path"), path)
    writers.write_table(readers.read_index(spark, path).where("size > 6"), path)
    assert rows(readers.read_index(spark, path).select("size")) == [(7,), (8,), (9,)]
    assert [p.name for p in tmp_path.iterdir()] == ["index.parquet"]


def test_failing_write_leaves_the_old_output(spark, frame, tmp_path):
    path = str(tmp_path / "index.parquet")
    writers.write_table(frame, path)
    with pytest.raises(Exception, match="broken"):
        writers.write_table(frame.selectExpr("ppn", "CAST(raise_error('broken') AS BIGINT) AS size"), path)
    assert rows(readers.read_index(spark, path)) == rows(frame)
    assert [p.name for p in tmp_path.iterdir()] == ["index.parquet"]


def test_hidden_documents_are_read(spark, tmp_path):
    base = tmp_path / "a[1]{b}*"
    names = ["toc/1.txt", "toc/_2.txt", "toc/.3.txt", "_raw/4.txt", "toc/.x/y/5.txt", "toc/.x/_z/6.txt", "7.txt", "book/a/b/_8.txt"]
    for name in [*names, "toc/_9.csv", "toc/10.csv"]:
        file = base / "data" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"text of {name}")
    found = readers.read_corpus(spark, str(base))
    got = {r["path"]: (bytes(r["content"]).decode(), r["size"], r["mtime"]) for r in found.collect()}
    assert got.keys() == {f"data/{n}" for n in names} and found.count() == len(names)
    for name in names:
        stat = (base / "data" / name).stat()
        assert got[f"data/{name}"] == (f"text of {name}", stat.st_size, int(stat.st_mtime))
    assert found.columns == ["path", "mtime", "size", "content"]


def test_many_files_are_not_walked_by_the_driver(spark, tmp_path, monkeypatch):
    for folder in range(5):
        (tmp_path / f"data/{folder}").mkdir(parents=True)
        for i in range(200):
            (tmp_path / f"data/{folder}/{i}.txt").write_text("x")
    calls = []
    command = spark.sparkContext._gateway._gateway_client.send_command if hasattr(spark.sparkContext._gateway, "_gateway_client") else None
    client = spark.sparkContext._gateway._gateway_client
    monkeypatch.setattr(client, "send_command", lambda *a, **k: (calls.append(1), command(*a, **k))[1])
    found = readers.read_corpus(spark, str(tmp_path))
    assert len(calls) < 600  # far fewer than files
    monkeypatch.undo()
    assert found.count() == 1000


def test_paths_without_a_scheme(spark, tmp_path):
    (tmp_path / "data/toc").mkdir(parents=True)
    (tmp_path / "data/toc/1.txt").write_text("text")
    for base in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        assert [r["path"] for r in readers.read_corpus(spark, base).collect()] == ["data/toc/1.txt"]


def test_a_snapshot_is_of_one_version(spark, docs_of, tmp_path, monkeypatch):
    path = str(tmp_path / "snapshot")

    def parts(*names):
        docs = docs_of({f"data/toc/{n}.txt": f"text {n}" for n in names})
        index = build_index(docs, "shed")
        return docs.join(index.select("path", "doctype"), "path"), index

    def read():
        return [rows(df.select("path")) for df in writers.read_snapshot(spark, path)]

    writers.write_snapshot(*parts("1", "2"), path)
    first = [[("data/toc/1.txt",), ("data/toc/2.txt",)]] * 2
    assert read() == first
    with monkeypatch.context() as crash:  # between documents and index
        crash.setattr(writers, "write_table", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            writers.write_snapshot(*parts("3"), path)
    assert read() == first
    with monkeypatch.context() as crash:  # before the manifest
        crash.setattr(writers, "_replace", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")) if a[1].endswith("manifest") else replace(*a, **k))
        with pytest.raises(OSError, match="killed"):
            writers.write_snapshot(*parts("3"), path)
    assert read() == first
    (tmp_path / "snapshot/manifest").rename(tmp_path / "snapshot/_manifest.x.old")  # between its two renames
    assert read() == first
    (tmp_path / "snapshot/_manifest.x.old").rename(tmp_path / "snapshot/manifest")
    for names in (("4",), ("5", "6")):
        writers.write_snapshot(*parts(*names), path)
    assert read() == [[("data/toc/5.txt",), ("data/toc/6.txt",)]] * 2
    assert len(list((tmp_path / "snapshot").glob("version-*"))) == 2


replace = writers._replace


@pytest.mark.parametrize("name", ["out.parquet", "out.csv"])
def test_an_append_that_is_run_again_adds_nothing(spark, frame, tmp_path, monkeypatch, name):
    path = str(tmp_path / name)
    writers.write_table(frame, path)
    more = spark.createDataFrame([("c", 3)], frame.schema)
    for batch in ("day-1", "day-1", "day-2"):
        writers.write_table(more, path, append=True, batch=batch)
    want = sorted([("a", 1), ("b", 2), ("c", 3), ("c", 3)], key=str)
    assert sorted(((r["ppn"], int(r["size"])) for r in readers.read_filter_list(spark, path).collect()), key=str) == want
    bad = more.selectExpr("ppn", "CAST(raise_error('broken') AS BIGINT) AS size")
    with pytest.raises(Exception, match="broken"):
        writers.write_table(bad, path, append=True, batch="day-3")
    writers.write_table(more, path, append=True, batch="day-3")
    assert readers.read_filter_list(spark, path).count() == 5
    with pytest.raises(ValueError, match="name of a batch"):
        writers.write_table(more, path, append=True, batch="../x")


def test_unreadable_records_are_counted_by_file(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r/1.json").write_text('{"record_id":"1","fields":[]}\nbroken\n{"record_id":"2","fields":[]}\n')
    (tmp_path / "r/2.json").write_text('{"record_id":\n{"record_id":"3","fields":7}\n')
    found = readers.read_all_records(spark, str(tmp_path / "r")).cache()
    counts = {r["file"].rsplit("/", 1)[-1]: (r["good"], r["bad"]) for r in readers.records_by_file(found).collect()}
    assert counts == {"1.json": (2, 1), "2.json": (0, 2)}
    assert sorted(r["unreadable"] for r in found.where("unreadable IS NOT NULL").collect()) == ["broken", '{"record_id":', '{"record_id":"3","fields":7}']
    assert rows(readers.readable(found).select("record_id")) == [("1",), ("2",)]
