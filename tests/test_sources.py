"""File sources S1-S7 on small files written to the checkpoint folder."""

import json
import os

from tessera.operators.chunking import default_attention_mask
from tessera.session import scratch_path
from tessera.sources import files, listing


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def test_text_scans(spark):
    root = scratch_path(spark, "texts")
    _write(f"{root}/a.txt", "alpha\nbeta")
    _write(f"{root}/B.TXT", "upper-case suffix is not .txt")
    _write(f"{root}/notes.md", "no")
    _write(f"{root}/sub/c.txt", "nested")
    flat = {os.path.basename(r.path): r.text for r in files.read_texts(spark, root).collect()}
    assert flat == {"a.txt": "alpha\nbeta"}
    deep = files.read_texts(spark, root, recursive=True)
    assert sorted(os.path.basename(r.path) for r in deep.collect()) == ["a.txt", "c.txt"]
    docs = files.read_documents(spark, root).collect()
    assert all(r.metadata["source"].endswith(".txt") for r in docs) and len(docs) == 2


def test_chunk_metadata_array_and_lines(spark):
    root = scratch_path(spark, "meta")
    recs = [{"text": "x", "metadata": {"source": "a.txt", "chunk_id": "0"}},
            {"text": "y", "metadata": {"chunk_id": "1"}}]
    _write(f"{root}/arr/meta.json", json.dumps(recs, indent=2))
    _write(f"{root}/lines/meta.jsonl", "\n".join(json.dumps(r) for r in recs))
    a = files.read_chunk_metadata(spark, f"{root}/arr", json_array=True).collect()
    b = files.read_chunk_metadata(spark, f"{root}/lines", json_array=False).collect()
    for rows in (a, b):
        assert [r.text for r in rows] == ["x", "y"]
        assert rows[1].metadata.get("source") is None          # missing key reads as null


def test_prompt_file(spark):
    root = scratch_path(spark, "prompt")
    body = "Extract triples.\n\nText: some text\n"
    _write(f"{root}/prompt.txt", body)
    assert files.read_prompt(spark, f"{root}/prompt.txt").first().prompt == body


def test_samples_with_missing_mask(spark):
    root = scratch_path(spark, "samples")
    _write(f"{root}/doc_0.jsonl", json.dumps({"input_ids": [5, 6, 0], "labels": [5, 6, 0]}))
    _write(f"{root}/doc_1.jsonl", json.dumps({"input_ids": [7], "labels": [7],
                                              "attention_mask": [1]}))
    s = default_attention_mask(files.read_samples(spark, root)).orderBy("input_ids").collect()
    assert [r.attention_mask for r in s] == [[1, 1, 1], [1]]


def _by_spark(spark, root, recursive):
    reader = spark.read.option("pathGlobFilter", "*.txt")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return sorted(tuple(r) for r in reader.text(root, wholetext=True).selectExpr(
        "_metadata.file_path", "hex(value)").collect())


def test_a_folder_is_listed_by_the_tasks_as_spark_lists_it(spark, monkeypatch):
    root = scratch_path(spark, "odd names")
    for name in ("a b", "p%41", "\u00fc\u00a0\u3000", "plus+#?", "q'\"&=;,@!$()~", "<^`|>", "_hid", ".hid", "_a=1", "sub/s",
                 "sub/_no/t", "deep/er/u"):
        _write(f"{root}/{name}.txt", f"x\r\ny\n{name}")
    _write(f"{root}/none.txt", "")
    _write(f"{root}/bad.txt", b"\xff\xfe bad", "wb")
    want = {deep: _by_spark(spark, root, deep) for deep in (False, True)}
    monkeypatch.setattr(listing, "NAMES_PER_BLOCK", 3)
    monkeypatch.setattr(listing, "TEXT_BYTES", 8)
    for deep in (False, True):
        for path in (root, f"file://{root}/"):
            got = files.read_texts(spark, path, recursive=deep)
            # no file index, which holds every file's status on the driver
            assert "wholetext" not in got._jdf.queryExecution().toString()
            assert sorted(tuple(r) for r in got.selectExpr("path", "hex(text)").collect()) == want[deep]
    assert len(want[True]) == len(want[False]) + 2 == 10


def test_what_only_spark_can_list_is_read_by_spark(spark):
    root = scratch_path(spark, "parts")
    _write(f"{root}/k=1/a.txt", "one")
    _write(f"{root}/k=2/b.txt", "two")
    for path in (root, f"{root}/*", f"{root}/k=1/a.txt"):
        assert {r.text for r in files.read_texts(spark, path).collect()} >= {"one"}
    assert {r.text for r in files.read_texts(spark, root).collect()} == {"one", "two"}
    assert {r.text for r in files.read_texts(spark, root, recursive=True).collect()} == {"one", "two"}
