"""ST1: incremental ingest — process only files not seen before; safe to run
again.  A file-source stream with a checkpoint remembers what was committed;
``availableNow`` processes what is new and stops.  The file sink commits
atomically, so a half-written output is never mistaken for done.

A stream over text files would keep the path of every file ever seen on the
driver.  So a pass first lists the folder in a task and writes the names that are
new into the checkpoint, a micro-batch to a file; these lists are what the stream
follows.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.session import settings
from tessera.sources import listing
from tessera.sources.tables import NOTHING_WRITTEN

# tasks in which Spark looks up the files of a micro-batch
LOOK_UP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# schema of Spark's binaryFile source (a stream needs it up front)
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, "
                      "content binary")


def ingest_texts(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                 suffix: str = ".txt", recursive: bool = True, transform=None,
                 max_files_per_batch: int = 10_000) -> int:
    """Run one incremental pass; returns the number of rows now in the sink (0
    while nothing has arrived).
    New files are taken in micro-batches of at most ``max_files_per_batch``;
    each committed batch survives a lost executor or driver restart.  A
    micro-batch's files are read in tasks dealt by the cluster's cores, which
    also keeps the sink's files few.  One pass at a time.

    Folders that only Spark can list (``listing.names``) are followed as a stream
    of text files; Spark looks up such a micro-batch's files in a job of its own,
    by default with a task for each file."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    names = listing.names(spark, source_dir, suffix, recursive)
    if names is not None:
        lists = _new_lists(spark, names, checkpoint, max_files_per_batch)
        files = (spark.readStream.schema("file string").format("parquet")
                 .option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).load(lists))
        stream = listing.texts(files.repartition(tasks, "file"))
    else:
        reader = (spark.readStream.format("text").option("wholetext", True)
                  .option("pathGlobFilter", f"*{suffix}")
                  .option("maxFilesPerTrigger", max_files_per_batch))
        if recursive:
            reader = reader.option("recursiveFileLookup", True)
        stream = reader.load(source_dir).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    if transform is not None:
        stream = transform(stream)
    with settings(spark, **{LOOK_UP_TASKS: str(tasks)}):
        q = (stream.coalesce(tasks).writeStream.format("parquet").option("path", sink_dir)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return _rows(spark, sink_dir)


def _new_lists(spark: SparkSession, names, checkpoint: str, most: int) -> str:
    """The folder of lists in ``checkpoint``, now with the files of ``names (file)``
    that no earlier list holds, at most ``most`` a list.  A list is whole or not
    there, and its files are not listed again, so a pass that breaks off neither
    loses nor doubles a file.  What a stream of text files has seen under the same
    checkpoint counts as listed."""
    checkpoint = checkpoint.rstrip("/")
    lists = f"{checkpoint}/files"
    folder = spark._jvm.org.apache.hadoop.fs.Path(lists)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    seen = spark.read.schema("file string").option("recursiveFileLookup", True).parquet(lists)
    try:
        log = spark.read.schema("value string").text(f"{checkpoint}/sources/0")
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_WRITTEN:
            raise
    else:
        path = F.regexp_replace(F.get_json_object("value", "$.path"), "^file:/+", "/")
        seen = seen.unionAll(log.select(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
                                        .alias("file")).filter("file IS NOT NULL"))
    # merged, not broadcast: the driver holds no names
    new = names.join(seen.hint("merge"), "file", "left_anti")
    if not new.isEmpty():
        new.repartition(1).write.option("maxRecordsPerFile", most).parquet(
            f"{lists}/{uuid.uuid4().hex}")
    return lists


def _rows(spark: SparkSession, sink_dir: str) -> int:
    """Rows of a sink from its files' footers; an empty sink has none."""
    try:
        return spark.read.parquet(sink_dir).count()
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_WRITTEN:
            raise
        return 0  # nothing has been written yet


#: How often a file that its extractor rejects is taken up again.
MAX_ATTEMPTS = 3

DEAD_LETTERS = "path string, modified timestamp, attempt int, error string, state string"


def dead_letters(spark: SparkSession, sink_dir: str):
    """The latest state of every file that was rejected: ``failed`` files are
    tried again on the next pass, ``given_up`` ones when they change."""
    try:
        log = spark.read.schema(DEAD_LETTERS).parquet(_letters(sink_dir))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], DEAD_LETTERS)
    latest = F.max(F.struct("modified", "attempt", "state", "error")).alias("s")
    return log.groupBy("path").agg(latest).select("path", "s.modified", "s.attempt", "s.state",
                                                  "s.error")


def _letters(sink_dir: str) -> str:
    return f"{sink_dir.rstrip('/')}/_dead_letters"


def _extracted(files, make_extractor, target: str):
    """Extract ``files`` once into a written page table."""
    from tessera.sources.files import extract_pages

    extract_pages(files, make_extractor).write.mode("overwrite").parquet(target)
    return files.sparkSession.read.schema(
        "path string, page_no int, text string, error string").parquet(target)


def _file_results(pages, files, attempts, max_attempts: int):
    """Good files' page texts, and a dead-letter row per rejected one."""
    from tessera.operators.corpus import concat_pages

    bad = pages.filter("error IS NOT NULL").groupBy("path").agg(F.max("error").alias("error"))
    good = concat_pages(pages.join(bad.select("path"), "path", "left_anti"), "path", "page_no",
                        "text")
    nth = F.coalesce("attempt", F.lit(0)) + 1
    letters = bad.join(files, "path").join(attempts, "path", "left").select(
        "path", F.col("modificationTime").alias("modified"), nth.cast("int").alias("attempt"),
        "error", F.when(nth >= max_attempts, "given_up").otherwise("failed").alias("state"))
    return good, letters


def ingest_binary(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                  make_extractor, glob: str = "*.pdf", max_files_per_batch: int = 1_000,
                  max_attempts: int = MAX_ATTEMPTS) -> int:
    """ST1 for binary documents: new files -> extractor plug-in -> page texts
    glued per file (A6) -> parquet, incrementally; returns the rows in the sink."""
    return ingest_binary_counts(spark, source_dir, sink_dir, checkpoint, make_extractor, glob,
                                max_files_per_batch, max_attempts)["rows"]


def ingest_binary_counts(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                         make_extractor, glob: str = "*.pdf", max_files_per_batch: int = 1_000,
                         max_attempts: int = MAX_ATTEMPTS) -> dict:
    """One pass; ``ok, failed, given_up, retried, rows``.

    The checkpoint remembers files as seen, whether or not they could be read.
    So a rejected file goes to a dead-letter table under its path, modification
    time and attempt, and every pass first takes up again what is there: files
    that failed fewer than ``max_attempts`` times, and files that changed since.
    What a replayed micro-batch writes has a folder of its own and is
    overwritten, so nothing is doubled; a file that goes in by a retry is marked
    ``done`` in the same table."""
    letters_dir, sink = _letters(sink_dir), sink_dir.rstrip("/")
    totals = {"ok": 0, "failed": 0, "given_up": 0, "retried": 0}

    def settle(files, attempts, name: str, retry: bool) -> None:
        listing = files.select("path", "modificationTime").checkpoint(eager=True)
        pages = _extracted(files, make_extractor, f"{sink}/_pages/{name}")
        good, letters = _file_results(pages, listing, attempts, max_attempts)
        good.write.mode("overwrite").parquet(f"{sink}/batch_id={name}")
        if retry:  # entered now: closes the file's entry
            nth = (F.coalesce("attempt", F.lit(0)) + 1).cast("int")
            done = good.select("path").join(listing, "path").join(attempts, "path", "left").select(
                "path", F.col("modificationTime").alias("modified"), nth.alias("attempt"),
                F.lit(None).cast("string").alias("error"), F.lit("done").alias("state"))
            letters = letters.unionByName(done)
        letters.write.mode("overwrite").parquet(f"{letters_dir}/batch={name}")
        per = {r["state"]: r["count"] for r in spark.read.schema(DEAD_LETTERS).parquet(
            f"{letters_dir}/batch={name}").groupBy("state").count().collect()}
        n = listing.count()
        bad = per.get("failed", 0) + per.get("given_up", 0)
        totals["ok"] += n - bad
        totals["failed"] += per.get("failed", 0)
        totals["given_up"] += per.get("given_up", 0)
        totals["retried"] += n if retry else 0

    waiting = dead_letters(spark, sink).filter("state <> 'done'").checkpoint(eager=True)
    if waiting.limit(1).count():
        listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source_dir)
        again = listed.join(waiting.select("path", "modified", "attempt", "state"), "path").filter(
            (F.col("state") == "failed") | (F.col("modificationTime") > F.col("modified")))
        # a changed file starts over
        attempts = again.select("path", F.when(F.col("modificationTime") > F.col("modified"), 0)
                                .otherwise(F.col("attempt")).alias("attempt")).checkpoint(eager=True)
        if attempts.limit(1).count():
            files = listed.join(attempts.select("path"), "path", "left_semi")
            settle(files, attempts, f"retry-{uuid.uuid4().hex[:12]}", True)

    none = spark.createDataFrame([], "path string, attempt int")

    def per_batch(batch_df, epoch):
        settle(batch_df, none, str(epoch), False)

    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_batch)
              .load(source_dir))
    tasks = 4 * spark.sparkContext.defaultParallelism
    with settings(spark, **{LOOK_UP_TASKS: str(tasks)}):
        q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return {**totals, "rows": _rows(spark, sink_dir)}
