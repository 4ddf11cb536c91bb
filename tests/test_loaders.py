"""Loaders as Spark formats, and one text file per document with two-phase commit."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import textfiles
from tessera.sources.loaders import Loader, PagedTextLoader, load_pages


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def found(df):
    return sorted((os.path.basename(r["path"]), r["page_no"], r["text"], (r["error"] or "")[:12])
                  for r in df.collect())


def test_text_and_pages(spark):
    root = scratch_path(spark, "load")
    put(root, "a.txt", "first\fsecond\f")
    put(root, "sub/b.txt", "ü" * 9)
    put(root, "sub/empty.txt", "")
    put(root, "broken.txt", b"good\fbad \xff\xfe")
    put(root, "_hidden.txt", "no")
    put(root, "other.md", "no")
    assert found(load_pages(spark, root, "text")) == [
        ("a.txt", 0, "first\fsecond\f", ""), ("b.txt", 0, "ü" * 9, ""),
        ("broken.txt", 0, None, "UnicodeDecod"), ("empty.txt", 0, "", "")]
    assert found(load_pages(spark, root, "paged_text", partition_bytes=1)) == [
        ("a.txt", 0, "first", ""), ("a.txt", 1, "second", ""), ("a.txt", 2, "", ""),
        ("b.txt", 0, "ü" * 9, ""), ("broken.txt", 0, None, "UnicodeDecod"),
        ("empty.txt", 0, "", "")]
    assert load_pages(spark, root, "text", recursive="false").count() == 2
    assert load_pages(spark, f"file://{root}/sub/b.txt", "text").first()["text"] == "ü" * 9
    assert load_pages(spark, f"{root}/sub", "csv").count() == 0
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        load_pages(spark, root, "text", on_error="raise").collect()
    with pytest.raises(Exception, match="FileNotFound"):
        load_pages(spark, f"{root}/none", "text").collect()
    with pytest.raises(ValueError, match="unknown loader"):
        load_pages(spark, root, "pdf")


def test_records(spark):
    root = scratch_path(spark, "records")
    put(root, "r.jsonl", "\n".join([json.dumps({"text": "one", "n": 1, "src": "x"}), "",
                                    json.dumps({"text": None}), json.dumps({"body": "z"})]))
    put(root, "t.csv", "id,body\n1,\"a, b\"\n2,c\n")
    rows = load_pages(spark, root, "jsonl").orderBy("page_no").collect()
    assert [r["text"] for r in rows] == ["one", None, None]
    assert rows[0]["metadata"] == {"source": f"{root}/r.jsonl", "n": "1", "src": "x"}
    assert rows[2]["error"].startswith("ValueError: line 4 has no 'text'")
    assert [r["text"] for r in load_pages(spark, root, "csv", content_column="body").collect()] == [
        "a, b", "c"]
    assert load_pages(spark, root, "csv").first()["text"] == "id: 1\nbody: a, b"


def test_a_class_of_the_callers(spark):
    root = scratch_path(spark, "own")
    put(root, "x.log", "a\nb\n")

    class Lines(Loader):
        glob = "*.log"

        def pages(self, stream, path):
            for line in stream.read().decode().splitlines():
                yield line.upper(), {"kind": "log"}

    df = load_pages(spark, root, Lines)
    assert [(r["text"], r["metadata"]["kind"]) for r in df.collect()] == [("A", "log"), ("B", "log")]


def test_pages_come_before_the_file_ends():
    class Endless:
        def __init__(self):
            self.blocks = 0

        def read(self, n):
            self.blocks += 1
            return b"x" * 10 + b"\f"

    stream = Endless()
    pages = PagedTextLoader({}).pages(stream, "p")
    assert [next(pages)[0] for _ in range(3)] == ["x" * 10] * 3
    assert stream.blocks <= 4


def names(root):
    return sorted(os.listdir(root)) if os.path.isdir(root) else []


def test_files_per_document(spark):
    root = scratch_path(spark, "files")
    docs = spark.createDataFrame([("a", "one"), ("b", None), ("c", "drei ü")], "stem string, text string")
    assert textfiles.write_text_files(docs.repartition(3), root) == 3
    assert names(root) == ["a.txt", "b.txt", "c.txt"]
    assert textfiles.write_text_files(docs.filter("stem = 'a'").withColumn("text", F.lit("new")),
                                      f"file://{root}") == 1
    assert open(f"{root}/a.txt").read() == "new" and open(f"{root}/c.txt").read() == "drei ü"
    assert textfiles.write_text_files(docs.limit(0), root) == 0
    for bad in ([("a", "x"), ("a", "y")], [(None, "x")], [("a/b", "x")], [("", "x")]):
        with pytest.raises(ValueError):
            textfiles.write_text_files(spark.createDataFrame(bad, "stem string, text string"), root)


def test_a_failed_job_leaves_no_file(spark):
    root = scratch_path(spark, "failed")
    docs = spark.range(40).repartition(4).select(
        F.concat(F.lit("d"), F.col("id")).alias("stem"),
        F.when(F.col("id") == 33, F.raise_error(F.lit("boom")).cast("string"))
        .otherwise(F.lit("x")).alias("text"))
    with pytest.raises(Exception, match="boom"):
        textfiles.write_text_files(docs, root)
    # tasks that were still running may leave staged files, none under its name
    assert [n for n in names(root) if not n.startswith("_pending-")] == []
    assert load_pages(spark, root, "text").count() == 0


def test_a_failed_attempt_leaves_no_file_and_publish_repeats(spark):
    root = scratch_path(spark, "attempt")
    writer = textfiles.TextFileWriter({"path": root, "job": "j", "suffix": ".txt"})

    def broken():
        yield "a", "one"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    assert names(f"{root}/_pending-j") == []
    done = writer.write(iter([("a", "one"), ("b", "two")]))
    lost = writer.write(iter([("a", "stray")]))  # an attempt that nobody commits
    writer.commit([done, None])
    assert names(root) == ["_pending-j"] and lost.files == 1
    assert textfiles.publish(spark, root, "j") == 2
    assert names(root) == ["a.txt", "b.txt"] and open(f"{root}/a.txt").read() == "one"
