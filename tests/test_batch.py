"""Files of a batch, from reading to the report."""

from pyspark.sql import functions as F

from voxloom.plans.batch import batch_report, batch_requests
from voxloom.sources.files import read_files

CUES = "1\n00:00:01,000 --> 00:00:02,000\nhi\nyou\n\n2\n00:00:03,000 --> 00:00:04,000\n\n3\n00:00:05,000 --> 00:00:06,000\nbye\n"
SILENT = "1\n00:00:01,000 --> 00:00:02,000\n\n"


def test_batch_from_files(spark, tmp_path):
    texts = {"a.txt": " Some prose. ", "b.txt": CUES, "c.srt": SILENT, "d.txt": "\n 　", "e.txt": "lost"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "f.txt").write_bytes(b"\xff\xfe")
    names = [*texts, "f.txt", "absent.txt"]
    files = read_files(spark, [f"{tmp_path}/{n}" for n in names])
    files = files.withColumn("file_no", F.element_at(F.split("path", "/"), -1))
    requests = batch_requests(files, rate=-5)
    made = {(r.file_no, r.kind, r.cue_no, r.start_ms, r.text, r.rate) for r in requests.collect()}
    failed = {(n, "error", 0, None, None, "-5%") for n in ("d.txt", "f.txt", "absent.txt")}
    assert made == failed | {
        ("a.txt", "prose", 0, None, "Some prose.", "-5%"),
        ("e.txt", "prose", 0, None, "lost", "-5%"),
        ("b.txt", "cue", 1, 1000, "hi you", "-5%"),
        ("b.txt", "cue", 3, 5000, "bye", "-5%"),
    }
    reported = spark.createDataFrame(
        [("a.txt", 0, "first try failed"), ("a.txt", 0, None), ("b.txt", 1, "no audio"), ("b.txt", 3, None)],
        "file_no string, cue_no int, error string",
    )
    report = batch_report(files, requests, reported, "out/", generate_subtitles=True).collect()
    got = {r.file_no: (r.requested, r.skipped, r.audio, r.subtitle, r.error) for r in report}
    unread = "Failed to process file: "
    assert len(report) == len(names) and got == {
        "a.txt": (0, 0, "out/a.mp3", "out/a.srt", None),
        "b.txt": (2, 1, "out/b.mp3", "out/b.srt", None),
        "c.srt": (0, 0, "out/c.mp3", "out/c.srt", None),
        "d.txt": (0, 0, None, None, "Please enter text to convert."),
        "e.txt": (0, 0, None, None, "No outcome was reported."),
        "f.txt": (0, 0, None, None, f"{unread}{tmp_path}/f.txt"),
        "absent.txt": (0, 0, None, None, f"{unread}{tmp_path}/absent.txt"),
    }
