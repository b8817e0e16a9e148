"""Files in and out, in temporary folders."""

import time

import pytest

from voxloom.operators import manifest as mf
from voxloom.operators import sentences as st
from voxloom.sources import files as fl
from voxloom.sources import sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a b.txt").write_bytes("one\r\ntwo\rthree. த".encode())
    (tmp_path / "c.srt").write_bytes(b"\xef\xbb\xbf1\n")
    (tmp_path / "bad.txt").write_bytes(b"ok \xff\xfe")
    (tmp_path / "other.md").write_text("no")
    (tmp_path / "UP.TXT").write_text("no")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "d.txt").write_text("no")
    return tmp_path


def test_directory_scan(spark, folder):
    rows = {r.path.rsplit("/", 1)[-1]: r for r in fl.read_directory(spark, str(folder)).collect()}
    assert set(rows) == {"a b.txt", "c.srt", "bad.txt"}
    assert rows["a b.txt"].text == "one\ntwo\nthree. த" and rows["a b.txt"].error is None
    assert rows["c.srt"].text == "\ufeff1\n"
    assert rows["bad.txt"].text is None
    assert rows["bad.txt"].error.startswith("Failed to process file: ")


def test_work_list_keeps_duplicates(spark, folder):
    explicit = [str(folder / "a b.txt"), str(folder / "other.md")]
    rows = fl.read_work_list(spark, explicit, str(folder)).collect()
    assert sorted(r.path.rsplit("/", 1)[-1] for r in rows) == [
        "a b.txt", "a b.txt", "bad.txt", "c.srt", "other.md",
    ]


def test_no_work_and_missing_input(spark, tmp_path):
    assert fl.read_work_list(spark).count() == 0
    absent = str(tmp_path / "absent.txt")
    assert [tuple(r) for r in fl.read_files(spark, [absent]).collect()] == [
        (absent, None, f"Failed to process file: {absent}")
    ]
    assert fl.read_directory(spark, str(tmp_path / "no folder")).count() == 0


def test_no_requested_file_is_lost(spark, folder):
    (folder / "lang=ta").mkdir()
    (folder / "lang=ta" / "p.txt").write_text("no")
    (folder / "_u.txt").write_text("hidden")
    (folder / "e[1].txt").write_text("pattern")
    names = {r.path.rsplit("/", 1)[-1] for r in fl.read_directory(spark, str(folder)).collect()}
    assert names == {"a b.txt", "c.srt", "bad.txt", "e[1].txt", "_u.txt"}
    paths = [str(folder / n) for n in ("_u.txt", "e[1].txt", "e[1].txt", "absent.txt", "deeper")]
    rows = [tuple(r) for r in fl.read_files(spark, paths).collect()]
    assert sorted(r[0] for r in rows) == sorted(paths)
    assert sorted(r[1] for r in rows if r[1]) == ["hidden", "pattern", "pattern"]
    assert all((r[1] is None) == (r[2] is not None) for r in rows)


def test_file_identity(spark):
    paths = ["x/a.tar.gz", "/.srt", "U.SRT", "..srt", "a..srt", "dir.d/f", "end."]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    found = [(r.base_name, r.extension) for r in mf.file_identity(frame).collect()]
    assert found == [
        ("a.tar", ".gz"), (".srt", ""), ("U", ".srt"), ("..srt", ""), ("a.", ".srt"), ("f", ""),
        ("end", "."),
    ]


def test_rewritten_table_holds_no_stale_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a. b. c."), (2, "d.")], "doc_id bigint, text string")
    path = str(tmp_path / "utterances")
    sinks.write_table(st.utterances(docs), path)
    assert spark.read.parquet(path).count() == 4
    sinks.write_table(st.utterances(docs, 2), path)
    assert spark.read.parquet(path).count() == 3


def files_below(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in path.rglob("*") if p.is_file()}


def test_text_export(spark, tmp_path):
    """Flat in a folder for each document, nothing added, and nothing left of an earlier run."""
    docs = spark.createDataFrame([(7, "a\n\nb. c."), (8, "த. d. e.")], "doc_id bigint, text string")
    path = tmp_path / "out"
    sinks.export_text(st.utterances(docs), str(path), "content", "doc_id", "utt_name")
    assert files_below(path) == {
        "7/sentence_0001.txt": b"a\n\nb.", "7/sentence_0002.txt": b"c.", "8/sentence_0001.txt": "த.".encode(),
        "8/sentence_0002.txt": b"d.", "8/sentence_0003.txt": b"e.",
    }
    sinks.export_text(st.utterances(docs, 2).repartition(5), str(path), "content", "doc_id", "utt_name")
    assert sorted(files_below(path)) == ["7/sentence_0001.txt", "8/sentence_0001.txt", "8/sentence_0002.txt"]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_subtitle_export_and_append(spark, tmp_path):
    cues = "1\n00:00:01,000 --> 00:00:02,000\nhi\n\n"
    rows = spark.createDataFrame([("a.srt", cues), ("b.srt", None)], "name string, content string")
    path = tmp_path / "deep" / "out"
    fl.write_text_files(rows, f"file://{path}", "content", "name")
    fl.write_text_files(rows.limit(1).selectExpr("'c.srt' AS name", "content"), str(path), "content", "name", mode="append")
    assert files_below(path) == {"a.srt": cues.encode(), "b.srt": b"", "c.srt": cues.encode()}
    fl.write_text_files(rows.limit(0), str(path), "content", "name")
    assert files_below(path) == {} and path.is_dir()


@pytest.mark.parametrize("rows", [
    [("1", "a.txt", "x"), ("1", "a.txt", "y")], [("..", "a.txt", "x")], [("1", "b/a.txt", "x")], [("1", None, "x")],
])
def test_failed_export_leaves_nothing(spark, tmp_path, rows):
    path = tmp_path / "out"
    good = spark.createDataFrame([("1", "old.txt", "kept")], "folder string, name string, content string")
    fl.write_text_files(good, str(path), "content", "name", "folder")
    bad = spark.createDataFrame(rows, good.schema).unionByName(good.repartition(2))
    with pytest.raises(Exception, match="no file can be named|two rows name the file"):
        fl.write_text_files(bad, str(path), "content", "name", "folder")
    assert files_below(path) == {"1/old.txt": b"kept"} and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_work_list_order(spark, folder):
    """Explicit files as given, hidden, absent, undecodable and repeated ones too, then .txt, .srt."""
    for name in ("_u.txt", ".h.txt", "z.srt"):
        (folder / name).write_text(name)
    (folder / "folder.txt").mkdir()
    explicit = [str(folder / n) for n in ("other.md", "_u.txt", "gone.txt", ".h.txt", "bad.txt", "_u.txt")]
    rows = fl.read_work_list(spark, explicit, str(folder), files_per_task=2).collect()
    rows.sort(key=lambda r: r.position)
    names = [r.path.rsplit("/", 1)[-1] for r in rows]
    assert names == [
        "other.md", "_u.txt", "gone.txt", ".h.txt", "bad.txt", "_u.txt",
        ".h.txt", "_u.txt", "a b.txt", "bad.txt", "folder.txt", "c.srt", "z.srt",
    ]
    assert [r.position for r in rows] == list(range(13)) and [r.origin for r in rows] == [0] * 6 + [1] * 7
    failed = {n for n, r in zip(names, rows, strict=True) if r.error}
    assert failed == {"gone.txt", "bad.txt", "folder.txt"}
    assert all((r.text is None) == (r.error == f"Failed to process file: {r.path}") for r in rows)


def test_long_list_plans_at_once(spark, tmp_path):
    """100,000 names are planned without a look at any of them."""
    listed = [f"{tmp_path}/f{i}.txt" for i in range(100_000)]
    began = time.time()
    frame = fl.read_work_list(spark, listed, files_per_task=5000)
    frame.explain()
    assert frame.rdd.getNumPartitions() == 20 and time.time() - began < 20


def test_table_of_paths(spark, folder):
    rows = [(1, f"{folder}/a b.txt", 5), (2, None, 6), (3, f"{folder}/bad.txt", 7), (4, f"file://{folder}/c.srt", 8)]
    listed = spark.createDataFrame(rows, "k int, path string, text int")
    got = {r.k: r for r in fl.read_listed(listed).collect()}
    assert got[1].text.startswith("one\ntwo\nthree") and got[4].text == "\ufeff1\n"
    assert got[2].error == "Failed to process file: " and got[3].text is None


def test_directory_stream(spark, folder):
    """Files that appear between batches and over a restart come once each, as in a batch."""
    target, progress = str(folder.parent / "rows"), str(folder.parent / "progress")

    def run():
        stream = fl.stream_directory(spark, str(folder), settle_ms=1, files_per_task=1)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", progress)
        return writer.start(target)

    def settle_and(query):
        time.sleep(0.05)
        query.processAllAvailable()

    query = run()
    settle_and(query)
    (folder / "later.txt").write_text("later")
    settle_and(query)
    query.stop()
    (folder / "_after.srt").write_text("after")
    query = run()
    settle_and(query)
    query.stop()
    batch = sorted(map(tuple, fl.read_directory(spark, str(folder)).collect()))
    assert len(batch) == 5 and sorted(map(tuple, spark.read.parquet(target).collect())) == batch


def test_chunks_of_files(spark, folder):
    """Cut between characters wherever a cut falls; a large file has many tasks."""
    text = "த😀é a\r\n" * 500
    (folder / "big.txt").write_bytes(text.encode())
    (folder / "empty.txt").write_bytes(b"")
    names = ["big.txt", "gone.txt", "empty.txt", "bad.txt", "big.txt"]
    for size in (4, 5, 1001):
        frame = fl.read_chunks(spark, [f"{folder}/{n}" for n in names], size)
        rows = sorted(frame.collect(), key=lambda r: (r.position, r.chunk_no))
        for position in (0, 4):
            own = [r for r in rows if r.position == position]
            assert "".join(r.text for r in own) == text and [r.chunk_no for r in own] == list(range(len(own)))
        assert [(r.text, r.error) for r in rows if r.position in (1, 2)] == [
            (None, f"Failed to process file: {folder}/gone.txt"), ("", None)
        ]
        assert any(r.error for r in rows if r.position == 3)
    assert frame.rdd.getNumPartitions() > 10


def test_commit_never_lists_the_target(tmp_path):
    """The files moved so far are not looked at again with each task's files."""
    import pyarrow.fs as pafs

    from voxloom.sources import text_sink

    class Seen:
        asked = []

        def __getattr__(self, name):
            return getattr(pafs.LocalFileSystem(), name)

        def get_file_info(self, what):
            found = pafs.LocalFileSystem().get_file_info(what)
            self.asked.append(len(found))
            return found

    for task in range(10):
        (tmp_path / f"{task}" / f"own{task}").mkdir(parents=True)
        (tmp_path / f"{task}" / "shared").mkdir()
        for folder in ("", f"own{task}/", "shared/"):
            (tmp_path / f"{task}" / f"{folder}{task}.txt").write_text(f"{task}")
    (tmp_path / "new").mkdir()
    for task in range(10):
        text_sink._merge(Seen(), str(tmp_path / f"{task}"), str(tmp_path / "new"))
    assert max(Seen.asked) == 3
    assert len(files_below(tmp_path / "new")) == 30
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "4.txt").write_text("other")
    with pytest.raises(ValueError, match="two rows name the file"):
        text_sink._merge(Seen(), str(tmp_path / "again"), str(tmp_path / "new"))
    assert (tmp_path / "new" / "4.txt").read_text() == "4"
