"""Operator 9: WARC archives with segmented records.

Writing: one record per page.  Of the pages whose payloads are equal and have
at least ``REVISIT_BYTES`` bytes, the one with the largest id is archived as
``response``; the others become ``revisit`` records that point at it.  The
payload travels as an HTTP message in chunked transfer framing; a block longer
than ``segment_bytes`` is cut into a first segment and continuation records.
Archives are written by Spark's own text writer: records end with the two line
ends the format asks for, so each file is a plain WARC file, and its size is
bounded by ``records_per_file`` records.

Reading: archives are parsed by content length, continuation records are
grouped by origin identifier and put in order by segment number, the total
length is verified, the chunked framing is undone and the payload's digest
checked against the record's header.

Defined cases: a null html has an empty payload; repeated rows of one page_id
are archived one by one, and those with the largest id all stay responses; a
page without id is archived and read back without id, and is a response only
if no page with id has its payload; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, shared_path, written

REVISIT_BYTES = 1000
SEGMENT_BYTES = 4 << 10
FRAME_BYTES = 3 << 10
RECORDS_PER_FILE = 512
#: A repeated digest takes about 100 bytes in a broadcast table.
BROADCAST_ROWS = 200_000
END = b"\r\n"
VERSION = b"WARC/1.1"
IDENTITY = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

PARSED = T.StructType([
    T.StructField("origin", T.StringType()), T.StructField("segment", T.IntegerType()),
    T.StructField("total", T.LongType()), T.StructField("page", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("block", T.BinaryType())])

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType())])


def frame_chunks(payload: bytes, size: int = FRAME_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    out = []
    for a in range(0, len(payload), size):
        part = payload[a:a + size]
        out += [b"%x" % len(part), END, part, END]
    out += [b"0", END, END]
    return b"".join(out)


def unframe_chunks(body: bytes) -> bytes:
    """Undo chunked transfer framing (chunk extensions and trailers skipped)."""
    out, at = [], 0
    while True:
        stop = body.index(END, at)
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size:at + size + 2] != END:
            raise ValueError("broken chunk framing")
        out.append(body[at:at + size])
        at += size + 2


def header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    lines.append(b"Content-Length: %d" % length)
    return END.join(lines) + END + END


def record_parts(uid: str, page: str | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, segment_bytes: int):
    """The records of one page, each without the two line ends behind it."""
    ident = f"<{URN}{page if page is not None else ''}#{uid}>"
    target = "".join(c for c in (url or "") if c not in "\r\n")
    common = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", target or None)]
    if refers_to is not None:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 b"Content-Length: %d\r\n\r\n" % len(payload))
        yield header([("WARC-Type", "revisit"), ("WARC-Record-ID", ident), *common,
                      ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Profile", IDENTITY),
                      ("WARC-Refers-To", f"<{URN}{refers_to}>"),
                      ("Content-Type", "application/http; msgtype=response")], len(block)) + block
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n" + frame_chunks(payload))
    first = [("WARC-Type", "response"), ("WARC-Record-ID", ident), *common,
             ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("Content-Type", "application/http; msgtype=response")]
    cuts = list(range(0, len(block), segment_bytes))
    if len(cuts) == 1:
        yield header(first, len(block)) + block
        return
    for n, a in enumerate(cuts, 1):
        part = block[a:a + segment_bytes]
        number = ("WARC-Segment-Number", str(n))
        if n == 1:
            yield header([*first, number], len(part)) + part
        else:
            yield header([("WARC-Type", "continuation"),
                          ("WARC-Record-ID", f"<{URN}{page or ''}#{uid}/{n}>"), *common,
                          ("WARC-Segment-Origin-ID", ident), number,
                          ("WARC-Segment-Total-Length", str(len(block)) if n == len(cuts) else None)],
                         len(part)) + part


def mark_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                  url: str = "url") -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` per page.

    Digests are grouped with partial maxima on a narrow table.  The repeated
    ones are broadcast if they were counted and are few enough; beyond that
    bound they are joined by shuffle, where AQE splits a hot digest."""
    rows = pages.select(
        col(pages, page_id).cast("long").alias("page_id"),
        (col(pages, url) if url in pages.columns else F.lit(None)).cast("string").alias("url"),
        F.coalesce(col(pages, html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = written(
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND keeper IS NOT NULL").select("digest", "keeper"), "digests")
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(
            F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")),
            F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, **names: str) -> None:
    """Archive every page below ``path`` as gzip-compressed WARC files."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out, size = [], 0
            for i, row in enumerate(batch.to_pylist()):
                page = None if row["page_id"] is None else str(row["page_id"])
                for part in record_parts(str(row["uid"]), page, row["url"], row["payload"] or b"",
                                         row["digest"], row["refers_to"], segment_bytes):
                    out.append(part)
                    size += len(part)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    marked = mark_revisits(pages, **names).withColumn("uid", F.monotonically_increasing_id())
    records = marked.mapInArrow(run, "record binary")
    # the text writer copies the bytes as they are; its line end closes a record
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(data: bytes):
    """``(headers, block)`` of each record of one archive, by content length."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].split(END)
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        for line in lines[1:]:
            k, _, v = line.partition(b":")
            fields[k.strip().lower().decode()] = v.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        begin = stop + 4
        if data[begin + size:begin + size + 4] != b"\r\n\r\n":
            raise ValueError("record does not end where its length says")
        yield fields, data[begin:begin + size]
        at = begin + size + 4


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file; archives often hold one record to a member."""
    import zlib

    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        if not member.eof:
            raise ValueError("the last gzip member is cut short")
        data = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def _ident(value: str | None) -> str | None:
    return value.strip("<>").removeprefix(URN) if value else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, continuations included."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                if raw[:2] == b"\x1f\x8b":
                    raw = gunzip(raw)
                rows, size = [], 0
                for f, block in parse_records(raw):
                    kind = f["warc-type"]
                    ident = _ident(f.get("warc-record-id"))
                    rows.append({
                        "origin": _ident(f.get("warc-segment-origin-id")) or ident,
                        "segment": int(f.get("warc-segment-number", 0)),
                        "total": int(f["warc-segment-total-length"])
                        if "warc-segment-total-length" in f else None,
                        "page": f.get("warc-target-uri"), "record_type": kind,
                        "refers_to": _ident(f.get("warc-refers-to")),
                        "payload_digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        "block": block})
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    import pyarrow as pa

    arrow = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
                       ("page", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.string()), ("payload_digest", pa.string()),
                       ("block", pa.binary())])
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, PARSED)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: single ones pass, segments are grouped by origin.  A
    group holds one record's segments and nothing else."""
    single = records.filter("segment = 0").drop("segment", "total")
    segments = records.filter("segment > 0").groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"), F.max("page").alias("page"),
        F.max(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"),
        F.max("refers_to").alias("refers_to"), F.max("payload_digest").alias("payload_digest"))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["block"]))
    numbers = F.transform("parts", lambda p: p["segment"])
    joined = segments.withColumn("block", whole).filter(
        F.assert_true((F.size("parts") == F.array_max(numbers))
                      & (F.size(F.array_distinct(numbers)) == F.size("parts"))
                      & (F.octet_length("block") == F.col("total")),
                      F.lit("WARC segments are missing, doubled or of wrong length")).isNull())
    return single.unionByName(joined.select(single.columns))


def read_pages(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per archived page; ``with_payload`` adds its html bytes.  Records
    that hold no page (``warcinfo``, ``request``, ``metadata``) are passed over."""
    records = read_records(spark, path).filter(
        F.col("record_type").isin("response", "revisit", "continuation"))
    whole = reassemble(records)
    schema = T.StructType([*PAGE.fields, *([T.StructField("payload", T.BinaryType())]
                                           if with_payload else [])])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                head, _, body = r["block"].partition(b"\r\n\r\n")
                names = {k.strip().lower(): v.strip() for k, _, v in
                         (line.partition(b":") for line in head.split(END)[1:])}
                page = r["origin"].rpartition("#")[0]
                digest, payload = r["payload_digest"], None
                if r["record_type"] == "response":
                    payload = (unframe_chunks(body) if names.get(b"transfer-encoding") == b"chunked"
                               else body)
                    size = len(payload)
                    if hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload digest of {r['origin']} does not hold")
                else:
                    size = int(names[b"content-length"])
                row = {"page_id": int(page) if page else None, "url": r["page"],
                       "payload_bytes": size, "payload_digest": digest,
                       "record_type": r["record_type"],
                       "refers_to": int(r["refers_to"]) if r["refers_to"] else None}
                if with_payload:
                    row["payload"] = payload
                rows.append(row)
            arrays = [pa.array([x[f.name] for x in rows], kinds[f.name]) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    import pyarrow as pa

    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
             "payload": pa.binary()}
    return whole.select("origin", "page", "record_type", "refers_to", "payload_digest",
                        "block").mapInArrow(run, schema)


def op9(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    return read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest",
                                          "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d
           FROM pages),
g AS (SELECT d, max(page_id) AS keeper FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND n >= {REVISIT_BYTES}"""
