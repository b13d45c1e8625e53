"""Ingest: inbox scan, decoding, outcomes, archive decisions and the commit of one run."""

import os

import pytest
from pyspark.sql import functions as F

from strata.functions.schema import assert_not_null
from strata.operators import ingest as IG
from strata.operators import metadata as MD
from strata.session import as_local
from strata.sources import changelog as CL


def fill(folder, files):
    os.makedirs(os.path.join(folder, "older"))
    for name, content in files.items():
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(content)


def test_inbox_scan_filters_names(spark, scratch):
    folder = as_local(scratch("inbox"))
    fill(folder, dict.fromkeys(["notes.md", "table.CSV", "image.raw", ".notes.md", "~$notes.docx"], b"x"))
    assert sorted(r.filename for r in MD.scan_inbox(spark, folder).collect()) == ["notes.md", "table.CSV"]
    assert MD.scan_inbox(spark, folder + "-missing").count() == 0


def test_inbox_to_table(spark, scratch):
    folder, target = as_local(scratch("inbox")), scratch("documents")
    head = b"**Title:** On Mills\n**Authors:** Ada Fell\n**Date:** 1999-03-04\n\n"
    fill(folder, {"a.md": head + b"Body text", "b.md": head + b"Body text", "c.txt": b"\xff\xfe", "d.json": b"{broken",
                  "e.json": b'{"k": 1}', "f.jsonl": b'{"k": 1}\n{"k": 2}\n', "g.pdf": b"%PDF", "h.csv": "é,1\r\n".encode()})
    outcomes, version = IG.ingest_folder(spark, folder, target)
    got = {r.filename: (r.outcome, (r.error or "").split("(")[0]) for r in outcomes.collect()}
    assert got == {"a.md": ("ingested", ""), "b.md": ("duplicate", ""), "c.txt": ("failed", "UnicodeDecodeError"),
                   "d.json": ("failed", "JSONDecodeError"), "e.json": ("ingested", ""), "f.jsonl": ("ingested", ""),
                   "g.pdf": ("failed", "ValueError"), "h.csv": ("ingested", "")}
    rows = {r.filename: r for r in CL.snapshot(CL.read_log(spark, target), "document_id").collect()}
    a = rows["a.md"]
    assert (a.title, a.author, str(a.publication_date), a.text, a.char_count, a.size_bytes) == (
        "On Mills", "Ada Fell", "1999-03-04", "Body text", 9, len(head) + 9)
    assert rows["h.csv"].text == "é,1\n" and rows["h.csv"].size_bytes == 6 and version == 0
    again, version = IG.ingest_folder(spark, folder, target)  # nothing is new: nothing is written
    assert version is None and again.where("outcome = 'ingested'").count() == 0
    assert CL.committed_versions(spark, target) == [0]
    assert IG.ingest_folder(spark, folder + "-missing", target) is None


def test_books_from_the_inbox(spark, scratch):
    folder, target = as_local(scratch("inbox")), scratch("chapters")
    pages = [f"# Topic {t}\n" + f"All about {t}, at some length. " * 60 for t in "ABC"]
    fill(folder, {"Mills (2001) - Ada Fell.md": ("**Title:** Mills\n\n" + "\n".join(pages)).encode()})
    _, version = IG.ingest_folder(spark, folder, target, kind="books")
    rows = CL.snapshot(CL.read_log(spark, target), "chapter_id").orderBy("chapter_number").collect()
    assert [(r.chapter_number, r.chapter_name, r.title, r.author, r.split_strategy) for r in rows] == [
        (i + 1, f"Topic {t}", "Mills", "Ada Fell", "headings") for i, t in enumerate("ABC")] and version == 0
    assert not any("**Title" in r.text for r in rows)


def test_header_of_many_blank_lines(spark):
    text = "\n" * 20_000 + "**Title:** Deep\n\nBody"
    r = spark.createDataFrame([(text,)], "t string").select(
        MD.header_metadata(F.col("t"))["title"].alias("title"), MD.strip_header(F.col("t")).alias("body")).first()
    assert (r.title, r.body) == ("Deep", "Body")


def test_not_null_is_enforced(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    with pytest.raises(Exception, match="NOT NULL"):
        assert_not_null(df, ["k"]).select("v").write.parquet(scratch("broken"))
    assert assert_not_null(df, ["v"]).count() == 2


def files(spark, *rows):
    return spark.createDataFrame(rows, "path string, filename string, file_hash string, error string")


def test_outcomes(spark):
    parsed = files(spark, ("in/1", "first", "same", None), ("in/2", "second", "same", None), ("in/3", "stored", "known", None),
                   ("in/4", "broken", "known", "no parse"))
    known = spark.createDataFrame([("known",)], "file_hash string")
    out = {r.filename: r.outcome for r in IG.classify_files(parsed, known).collect()}
    assert out == {"first": "ingested", "second": "duplicate", "stored": "duplicate", "broken": "failed"}


def test_archive_name_clash_gets_stamp(spark):
    o = spark.createDataFrame([("map.csv", "ingested", None), ("log.txt", "failed", "why")],
                              "filename string, outcome string, error string")
    archived = spark.createDataFrame([("processed", "map.csv")], "folder string, filename string")
    got = {r.filename: (r.target, r.reason) for r in IG.archive_targets(o, archived, "T1").collect()}
    assert got == {"map.csv": ("processed/map.T1.csv", None), "log.txt": ("failed/log.txt", "why")}


def test_filename_metadata(spark):
    df = spark.createDataFrame([("River Mills (2014) - Ada Fell.epub",), ("On Water by Ada Fell.txt",)], "n string")
    got = [r.m for r in df.select(MD.filename_metadata(F.col("n")).alias("m")).collect()]
    assert (got[0].title, got[0].author, str(got[0].publication_date)) == ("River Mills", "Ada Fell", "2014-01-01")
    assert (got[1].title, got[1].author) == ("On Water", "Ada Fell")
