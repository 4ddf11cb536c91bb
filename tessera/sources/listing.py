"""Folders of very many files, listed and read by the tasks.

Spark's file index keeps the status of every file on the driver, and so does its
file stream: some hundred bytes a file, gigabytes for millions.  Here one task
walks the folder and writes the names as a table, block by block; they are dealt
to the tasks that read the files.  The driver holds no name.  Files, paths and
texts are those of Spark's text reader (``wholetext``): names that begin with
``_`` or ``.`` and files without a byte are left out.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Names of one block, and bytes of texts that share an Arrow batch.
NAMES_PER_BLOCK = 10_000
TEXT_BYTES = 4 << 20
# what Spark reads as a pattern, and files that it decompresses
_PATTERN = re.compile(r"[*?\[\]{}\\]")
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")
# what java.net.URI quotes in a path: all but these, and spaces beyond ASCII
_QUOTED = re.compile(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/\u00a1-\U0010ffff]"
                     r"|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the tasks' own file system knows it (a mounted folder), or
    None where only Spark can tell."""
    if re.match(r"file:/", path):
        path = "/" + re.sub(r"^file:/*", "", path)
    elif re.match(r"[^/]*:", path) or not spark.sparkContext._jsc.hadoopConfiguration().get(
            "fs.defaultFS", "file:///").startswith("file:"):
        return None
    return os.path.abspath(path)


def uri(path: str) -> str:
    """A local path as Spark's ``_metadata.file_path`` shows it."""
    return "file:" + _QUOTED.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), path)


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or \
        name.endswith("._COPYING_")


def names(spark: SparkSession, path: str, suffix: str, recursive: bool = False) -> DataFrame | None:
    """``(file)``: the files of a folder now, as a written table.  None where
    Spark has to list them: other file systems, patterns, single files, packed
    files, and folders of a partitioned table (``key=value``)."""
    folder = local_path(spark, path)
    if folder is None or not suffix or _PATTERN.search(path + suffix) or suffix.endswith(_PACKED) \
            or not os.path.isdir(folder):
        return None

    def walk(batches):
        def block(found):
            return pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["file"])

        for batch in batches:
            found, folders = [], batch.column(0).to_pylist()
            top = set(folders)
            while folders:
                at = folders.pop()
                with os.scandir(at) as entries:
                    for entry in entries:
                        if _hidden(entry.name):
                            continue
                        if entry.is_dir():
                            folders.append(entry.path)
                            if "=" in entry.name and not recursive:
                                found.append(None)
                        elif entry.name.endswith(suffix) and (recursive or at in top):
                            found.append(entry.path)
                        if len(found) >= NAMES_PER_BLOCK:
                            yield block(found)
                            found = []
            yield block(found)

    table = scratch_path(spark, "names")
    spark.createDataFrame([(folder,)], "folder string").coalesce(1).mapInArrow(
        walk, "file string").write.parquet(table)
    found = spark.read.schema("file string").parquet(table)
    return found if found.filter("file IS NULL").limit(1).count() == 0 else None


def texts(files: DataFrame) -> DataFrame:
    """``(path, text)`` of ``files (file)``, read where the names lie."""
    def read(batches):
        def block(paths, data):
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()),
                                               pa.array(data, pa.binary())], ["path", "data"])

        for batch in batches:
            paths, data, held = [], [], 0
            for file in batch.column("file").to_pylist():
                with open(file, "rb") as f:
                    content = f.read()
                if not content:
                    continue
                paths.append(uri(file))
                data.append(content)
                held += len(content)
                if held >= TEXT_BYTES:
                    yield block(paths, data)
                    paths, data, held = [], [], 0
            if paths:
                yield block(paths, data)

    return files.select("file").mapInArrow(read, "path string, data binary").select(
        "path", F.col("data").cast("string").alias("text"))
