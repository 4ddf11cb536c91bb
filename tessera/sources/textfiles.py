"""K1: one text file per document, as a Python data source with two-phase commit.

Tasks write their files below ``<path>/_pending-<job>/<task attempt>/``; each
sends back that folder's name and a count.  When all have ended, ``commit``
lists the folders in one marker file; a failed job's ``abort`` removes them all,
and a failed attempt removes its own.  ``publish`` then moves the files into place
as a Spark job of its own, one folder at a time; it may be repeated after a crash.
Until it runs, no file of the job is visible under its final name.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tessera.sources.filesystems import filesystem

FORMAT = "tessera_text_files"
MARKER = "_committed"


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class TextFileWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options
        self.root = f"{options['path'].rstrip('/')}/_pending-{options['job']}"

    def write(self, iterator):
        files, root = filesystem(self.root)
        folder = f"{root}/{uuid.uuid4().hex}"
        files.create_dir(folder)
        n = 0
        try:
            for stem, text in iterator:
                with files.open_output_stream(f"{folder}/{stem}{self.options['suffix']}") as out:
                    out.write((text or "").encode())
                n += 1
        except BaseException:
            files.delete_dir(folder)
            raise
        return Staged(folder, n)

    def commit(self, messages):
        files, root = filesystem(self.root)
        files.create_dir(root)
        with files.open_output_stream(f"{root}/{MARKER}") as out:
            out.write("\n".join(m.folder for m in messages if m is not None).encode())

    def abort(self, messages):
        from pyarrow import fs

        files, root = filesystem(self.root)
        if files.get_file_info(root).type == fs.FileType.Directory:
            files.delete_dir(root)


class TextFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "stem string, text string"

    def writer(self, schema, overwrite):
        return TextFileWriter(dict(self.options))


def publish(spark: SparkSession, path: str, job: str) -> int:
    """Move a committed job's files into place; returns how many there were."""
    root = f"{path.rstrip('/')}/_pending-{job}"
    files, inner = filesystem(root)
    with files.open_input_file(f"{inner}/{MARKER}") as f:
        folders = [x for x in f.read().decode().split("\n") if x]

    def move(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, target = filesystem(path)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                staged = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                for info in staged:
                    store.move(info.path, f"{target.rstrip('/')}/{info.base_name}")
                yield pa.RecordBatch.from_arrays([pa.array([len(staged)], pa.int64())], ["n"])

    n = 0
    if folders:
        table = spark.createDataFrame([(f,) for f in folders], "folder string")
        moved = table.repartition(min(len(folders), 10_000)).mapInArrow(move, "n long")
        n = moved.agg(F.sum("n")).first()[0]
    files.delete_dir(inner)
    return n or 0


def write_text_files(df: DataFrame, path: str, name_col: str = "stem", text_col: str = "text",
                     suffix: str = ".txt") -> int:
    """One ``<name><suffix>`` file per row of ``df`` in ``path``; returns the
    number.  Null, empty or repeated names, and names with a slash, are refused
    before anything is written; files of earlier runs are replaced."""
    spark = df.sparkSession
    names = df.select(F.col(name_col).cast("string").alias("stem"))
    bad = names.filter(F.col("stem").isNull() | (F.col("stem") == "")
                       | F.contains("stem", F.lit("/")) | F.col("stem").startswith("_")
                       | F.col("stem").startswith(".")).limit(1).collect()
    if bad:
        raise ValueError(f"not a file name: {bad[0].stem!r}")
    twice = names.groupBy("stem").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two documents have the name {twice[0].stem!r}")
    spark.dataSource.register(TextFiles)
    job = uuid.uuid4().hex
    (df.select(F.col(name_col).cast("string").alias("stem"),
               F.col(text_col).cast("string").alias("text"))
     .write.format(FORMAT).mode("append").option("job", job).option("suffix", suffix).save(path))
    return publish(spark, path, job)
