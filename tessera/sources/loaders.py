"""Document loaders chosen by name, as Python data sources.

A loader is a class: ``Loader(options).pages(stream, path)`` yields ``(text,
metadata)`` per page while it reads, so a file is never one cell and a page is
gone before the next is read.  ``register_loader`` makes a loader a Spark format
of its own (``tessera_<name>``); ``load_pages`` reads a folder through it:

    path string, page_no int, text string, metadata map<string,string>, error string

Files are dealt to tasks by size: small ones share a task, a large one has its
own.  A file that its loader rejects keeps the pages before the fault and one more
row that says why (``on_error="raise"`` fails the job instead).  A file without
pages gives one empty page.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.filesystems import filesystem

PAGES = "path string, page_no int, text string, metadata map<string,string>, error string"
#: Bytes of files that share a task, and of rows that share an Arrow batch.
PARTITION_BYTES = 64 << 20
BATCH_BYTES, BATCH_ROWS = 4 << 20, 512
READ_BYTES = 1 << 20


class Loader:
    """Base of loaders; ``glob`` is the default file pattern."""

    glob = "*"

    def __init__(self, options: dict):
        self.options = options
        self.encoding = options.get("encoding", "utf-8")

    def pages(self, stream, path: str):
        raise NotImplementedError

    def text_blocks(self, stream):
        """The decoded text, a block at a time; bytes that do not decode are an
        error, as is a file that ends inside a character."""
        decoder = codecs.getincrementaldecoder(self.encoding)()
        while block := stream.read(READ_BYTES):
            yield decoder.decode(block)
        yield decoder.decode(b"", final=True)


class TextLoader(Loader):
    """The whole file as one page."""

    glob = "*.txt"

    def pages(self, stream, path):
        yield "".join(self.text_blocks(stream)), {}


class PagedTextLoader(Loader):
    """Pages cut at ``separator`` (form feed); at most one page is held."""

    glob = "*.txt"

    def pages(self, stream, path):
        cut = self.options.get("separator", "\f")
        rest = ""
        for block in self.text_blocks(stream):
            *whole, rest = (rest + block).split(cut)
            for page in whole:
                yield page, {}
        yield rest, {}


class JsonLinesLoader(Loader):
    """One page per JSON object a line; ``content_key`` names the text, the other
    keys are metadata."""

    glob = "*.jsonl"

    def pages(self, stream, path):
        key = self.options.get("content_key", "text")
        for n, line in enumerate(io.TextIOWrapper(stream, self.encoding, newline="\n"), 1):
            if not line.strip():
                continue
            row = json.loads(line)
            if not isinstance(row, dict) or key not in row:
                raise ValueError(f"line {n} has no {key!r}")
            text = row.pop(key)
            yield None if text is None else str(text), {
                k: v if isinstance(v, str) else json.dumps(v) for k, v in row.items()}


class CsvLoader(Loader):
    """One page per CSV row; ``content_column`` is the text (all columns as
    ``name: value`` lines where it is not given), the others are metadata."""

    glob = "*.csv"

    def pages(self, stream, path):
        column = self.options.get("content_column")
        text = io.TextIOWrapper(stream, self.encoding, newline="")
        for row in csv.DictReader(text, delimiter=self.options.get("delimiter", ",")):
            if column is None:
                yield "\n".join(f"{k}: {v}" for k, v in row.items()), {}
            elif column not in row:
                raise ValueError(f"no column {column!r}")
            else:
                yield row.pop(column), {k: v for k, v in row.items() if k is not None}


LOADERS = {"text": TextLoader, "paged_text": PagedTextLoader, "jsonl": JsonLinesLoader,
           "csv": CsvLoader}


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: list = field(default_factory=list)
    value: int = 0


class PageReader(DataSourceReader):
    def __init__(self, loader, options: dict):
        self.loader, self.options = loader, options

    def listing(self) -> list[tuple[str, int]]:
        """``(path, bytes)`` of the files that match, in path order.  Names that
        begin with ``_`` or ``.`` are not data."""
        from fnmatch import fnmatchcase

        from pyarrow import fs

        files, root = filesystem(self.options["path"])
        pattern = self.options.get("glob", self.loader.glob)
        info = files.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.options["path"])
        if info.type == fs.FileType.File:
            return [(info.path, info.size)]
        deep = str(self.options.get("recursive", "true")).lower() == "true"
        found = files.get_file_info(fs.FileSelector(root, recursive=deep))
        top = root.rstrip("/")
        return sorted((i.path, i.size) for i in found if i.type == fs.FileType.File
                      and fnmatchcase(i.base_name, pattern)
                      and not any(p.startswith(("_", ".")) for p in
                                  i.path[len(top):].strip("/").split("/")))

    def partitions(self):
        room = int(self.options.get("partition_bytes", PARTITION_BYTES))
        out, used = [], 0
        for path, size in self.listing():
            if not out or used + size > room:
                out.append(Files([], len(out)))
                used = 0
            out[-1].paths.append(path)
            used += size
        return out or [Files()]

    def rows(self, paths):
        files, _ = filesystem(self.options["path"])
        strict = self.options.get("on_error", "row") == "raise"
        for path in paths:
            n = 0
            try:
                with files.open_input_file(path) as stream:
                    for text, metadata in self.loader(self.options).pages(stream, path):
                        yield path, n, text, {"source": path, **metadata}, None
                        n += 1
            except Exception as e:
                if strict:
                    raise
                yield path, n, None, {"source": path}, f"{type(e).__name__}: {e}"
                continue
            if n == 0:
                yield path, 0, "", {"source": path}, None

    def read(self, partition):
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("page_no", pa.int32()), ("text", pa.string()),
                            ("metadata", pa.map_(pa.string(), pa.string())),
                            ("error", pa.string())])

        def batch(rows):
            paths, numbers, texts, metadata, errors = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(numbers, pa.int32()),
                 pa.array(texts, pa.string()),
                 pa.array([list(m.items()) for m in metadata], schema.field("metadata").type),
                 pa.array(errors, pa.string())], schema=schema)

        held, size = [], 0
        for row in self.rows(partition.paths):
            held.append(row)
            size += len(row[2] or "")
            if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)


def register_loader(spark: SparkSession, name: str, loader: type) -> str:
    """Make ``loader`` the Spark format ``tessera_<name>``; returns that name."""
    format_name = f"tessera_{name}"

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def schema(self):
            return PAGES

        def reader(self, schema):
            return PageReader(loader, dict(self.options))

    spark.dataSource.register(Pages)
    return format_name


def load_pages(spark: SparkSession, path: str, loader: str | type = "text",
               **options) -> DataFrame:
    """The pages of all files below ``path``; ``loader`` is a name of ``LOADERS``
    or a class of the caller's."""
    if isinstance(loader, str):
        if loader not in LOADERS:
            raise ValueError(f"unknown loader {loader!r}: one of {sorted(LOADERS)} or a class")
        name, loader = loader, LOADERS[loader]
    else:
        name = loader.__name__.lower()
    reader = spark.read.format(register_loader(spark, name, loader))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
