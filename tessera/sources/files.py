"""File sources (S1-S7): text, binary, JSON lines / arrays, prompts, stores."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas
from tessera.sources import listing

#: Tasks of a scan of small files that are run as one, and files of such a task.
FILE_TASKS = 32
TASK_FILES = 32


def read_texts(spark: SparkSession, path: str, suffix: str = ".txt",
               recursive: bool = False) -> DataFrame:
    """One row per file, ``(path, text)``; the suffix is case-sensitive.
    The whole file is one value (``wholetext``), split across tasks by file.
    A folder is listed by a task and its names are dealt to the reading tasks
    (``listing``), so the driver holds none of them.  What only Spark can list
    is read by Spark: it puts 32 small files into a task; of many such tasks,
    ``FILE_TASKS`` are run as one."""
    least = 4 * spark.sparkContext.defaultParallelism
    names = listing.names(spark, path, suffix, recursive)
    if names is not None:
        n = names.count()
        tasks = max(1, min(n, max(least, -(-n // (TASK_FILES * FILE_TASKS)))))
        return listing.texts(names.repartition(tasks, "file"))
    reader = spark.read.option("pathGlobFilter", f"*{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    texts = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"),
                                                     F.col("value").alias("text"))
    tasks = texts.rdd.getNumPartitions()
    return texts.coalesce(max(least, -(-tasks // FILE_TASKS))) if tasks > least else texts


def read_documents(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``(text, metadata map<string,string>)`` with ``source`` = file path."""
    t = read_texts(spark, path, suffix, recursive=True)
    return t.select("text", F.create_map(F.lit("source"), F.col("path")).alias("metadata"))


def read_binary(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """S3 listing: ``(path, modificationTime, length, content)``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path))


def extract_pages(binary: DataFrame, make_extractor: Callable) -> DataFrame:
    """S3: document bytes -> ordered page texts via a plug-in extractor.

    ``make_extractor()`` returns ``f(bytes) -> list[str]`` (one string per
    page); it is built once per task.  Output ``(path, page_no, text, error)``:
    a file without pages gives one empty page, a file that the extractor
    rejects one row without text that says why."""
    def run(batches):
        import pandas as pd
        extract = make_extractor()
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    pages = extract(bytes(content))
                except Exception as e:  # kept as a row: a broken file is counted, not lost
                    rows.append((path, 0, None, f"{type(e).__name__}: {e}"))
                    continue
                rows.extend((path, i, p or "", None) for i, p in enumerate(pages or [""]))
            yield pd.DataFrame(rows, columns=["path", "page_no", "text", "error"])
    return binary.select("path", "content").mapInPandas(
        run, "path string, page_no int, text string, error string")


def read_samples(spark: SparkSession, path: str, suffix: str = ".json*",
                 keys: str | None = None) -> DataFrame:
    """Token samples, one JSON object per file/line, fixed schema.  The
    suffix rule takes what ``write_windows`` writes (``.json``) and ``.jsonl``
    files; ``keys`` names further columns to read (a DDL string)."""
    schema = schemas.TRAIN_SAMPLES
    if keys:
        schema = T.StructType([*T._parse_datatype_string(keys).fields, *schema.fields])
    return spark.read.schema(schema).option("pathGlobFilter", f"*{suffix}").json(path)


def read_chunk_metadata(spark: SparkSession, path: str, json_array: bool = True) -> DataFrame:
    """Chunk metadata written as one JSON array (``multiLine``) or as JSON
    lines; a missing key reads as null."""
    reader = spark.read.schema(schemas.METADATA_RECORD)
    if json_array:
        reader = reader.option("multiLine", True)
    return reader.json(path)


def read_prompt(spark: SparkSession, path: str) -> DataFrame:
    """The whole prompt file as one value."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("prompt"))


def parse_metadata_json(col, schema: T.DataType = T.ArrayType(schemas.METADATA_RECORD)):
    """S5 on a column: ``from_json`` of a JSON array of records."""
    return F.from_json(col, schema)
