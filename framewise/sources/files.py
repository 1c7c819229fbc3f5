"""File sources and sinks: CSV, many files, JSON documents, zipped CSV, HTML records,
partitioned sinks and materialised tables.

Every writer targets a folder the caller names; helpers that need scratch space take it
below the cluster's shared checkpoint folder (``framewise.session.scratch_path``).
"""

from __future__ import annotations

import html
import io
import itertools
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from framewise.session import local_fs_path


# ---------------------------------------------------------------- CSV

def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             comment: str | None = None, encoding: str = "UTF-8", usecols: Sequence[str] | None = None,
             timestamp_format: str | None = None) -> DataFrame:
    """``read_csv(path, usecols, header, comment, encoding, parse_dates)`` with a declared
    schema (no inference pass); ``usecols`` is a projection Catalyst prunes."""
    r = spark.read.schema(schema).option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if comment:
        r = r.option("comment", comment)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    df = r.csv(path)
    return df.select(*usecols) if usecols else df


def write_csv(df: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8",
              partition_by: Sequence[str] = (), mode: str = "overwrite", raw_comments: bool = False) -> None:
    """``to_csv`` -- with ``partition_by`` one folder (and files) per key: the distributed
    ``for k, g in df.groupby(k): g.to_csv(...)``. ``raw_comments`` writes values starting
    with ``#`` unquoted, so such rows become comment lines for readers."""
    w = df.write.mode(mode).option("header", header).option("encoding", encoding)
    if raw_comments:
        w = w.option("comment", "\u0001")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


# ---------------------------------------------------------------- many files

def read_many(spark: SparkSession, pattern: str, fmt: str = "parquet", base_path: str | None = None,
              provenance: str | None = "source_file") -> DataFrame:
    """Glob many files into one table; each row can carry the file it came from."""
    r = spark.read.format(fmt)
    if base_path:
        r = r.option("basePath", base_path)
    df = r.load(pattern)
    return df.withColumn(provenance, F.col("_metadata.file_path")) if provenance else df


# ---------------------------------------------------------------- JSON documents

def read_json_records(spark: SparkSession, path: str, schema: StructType | str, records: str = "features",
                      multiline: bool = False) -> DataFrame:
    """JSON documents -> one row per element of their ``records`` array. JSON Lines (one
    document per line) stays splittable; ``multiline`` reads each file as one document."""
    df = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return df.select(F.explode(F.col(records)).alias("_fw_r")).select("_fw_r.*")


# ---------------------------------------------------------------- zipped CSV

def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it (``file:/a b``, ``hdfs://h/a``, ``s3a://b/a``; nothing is escaped) and the path on it.
    Tasks open archives through it; ``hdfs`` needs Hadoop's client library on the executors."""
    local = local_fs_path(path)
    if local is not None:
        return pafs.LocalFileSystem(), local
    root, rest = re.fullmatch(r"(\w+://[^/]*)(.*)", re.sub(r"^s3[an]://", "s3://", path), re.DOTALL).groups()
    fs, base = pafs.FileSystem.from_uri(root + "/")
    return fs, base.rstrip("/") + rest


def write_zipped_csv(df: DataFrame, folder: str, name: str = "part") -> DataFrame:
    """Write each partition as one zip archive holding one CSV (with header). Lazy like any
    DataFrame: run one action on the result (one row per archive) to write the files.

    The folder is any that the executors reach, by path or URI. An archive is streamed to a name that starts
    with an underscore, which readers skip, and moved when it is whole, to a name made of the partition's number: a task that
    dies leaves nothing to read, and one that runs again takes its own archive's place. Empty partitions write none."""
    cols = df.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        target, growing = f"{base}/{name}-{part:06d}.csv.zip", f"{base}/_{name}-{uuid.uuid4().hex}"
        rows = 0
        for first in batches:
            if len(first):
                with fs.open_output_stream(growing) as to, zipfile.ZipFile(to, "w", compression=zipfile.ZIP_DEFLATED) as z:
                    with z.open(f"{name}.csv", "w", force_zip64=True) as out:
                        for b in itertools.chain([first], batches):
                            out.write(b[cols].to_csv(index=False, header=rows == 0).encode("utf-8"))
                            rows += len(b)
        if rows:
            fs.move(growing, target)
            yield pd.DataFrame({"path": [target], "rows": [rows]})

    return df.mapInPandas(write, "path string, rows long")


def csv_records(lines: Iterator[str]) -> Iterator[str]:
    """Records of a CSV text: lines, put together where a quoted field goes on in the next one."""
    record = ""
    for line in lines:
        record += line
        if record.count('"') % 2 == 0:
            yield record.rstrip("\r\n")
            record = ""
    if record:
        yield record.rstrip("\r\n")


def read_zipped_csv(spark: SparkSession, pattern: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """Zip archives of CSV files -> rows, with their archive's ``path``.

    Spark lists the archives, without their content; a first pass reads their central directories, at the
    end of each, and deals the members found there to tasks of their own. A task seeks to its member and streams it in blocks
    of 10,000 records, whatever its size; the JVM parses them with ``from_csv`` against the declared schema.
    A single member is not splittable. Folders and empty members give no rows."""
    archives = spark.read.format("binaryFile").load(pattern).select("path")

    def directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                fs, at = file_system(path)
                with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                    yield pd.DataFrame({"path": path, "member": [i for i, m in enumerate(z.infolist()) if not m.is_dir() and m.file_size]})

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, member in zip(b["path"], b["member"], strict=True):
                fs, at = file_system(path)
                with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z, z.open(z.infolist()[member]) as m:
                    records = csv_records(io.TextIOWrapper(m, "utf-8", newline="\n"))
                    if header:
                        next(records, None)
                    while some := list(itertools.islice(records, 10_000)):
                        yield pd.DataFrame({"path": path, "line": some})

    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    # a given number of partitions, as these few bytes would be coalesced into one task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = archives.mapInPandas(directory, "path string, member int").repartition(tasks, "path", "member")
    parsed = members.mapInPandas(lines, "path string, line string").select("path", F.from_csv(F.col("line"), ddl).alias("r"))
    return parsed.select("r.*", "path")


# ---------------------------------------------------------------- HTML records

# HTML entities decoded in extracted text.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

LIST_LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def unescape(c: Column) -> Column:
    for ent, ch in HTML_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def html_links(df: DataFrame, html: str, keys: Sequence[str]) -> DataFrame:
    """Repeated ``<li><a href=...>text</a></li>`` records of each page -> (keys, pos, href,
    text); a JVM regex per page, no Python."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LIST_LINK), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(LIST_LINK), 2)
    z = df.select(*keys, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("pos", "r"))
    return z.select(*keys, F.col("pos").cast("bigint").alias("pos"), unescape(F.col("r.href")).alias("href"),
                    unescape(F.col("r.text")).alias("text"))


# Fixed values of the HTML standard: the most columns and rows that one cell may span.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

_HTML_TOKEN = re.compile(r"(?s)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>|<[^>]*>|[^<]+|<",
                         re.IGNORECASE)
_SPAN = re.compile(r"\b(colspan|rowspan)\s*=\s*[\"']?\s*(\d+)", re.IGNORECASE)


class _OpenTable:
    """A table whose end has not come: its number, its rows so far, and the cell that is open."""

    def __init__(self, number: int):
        self.number, self.rows = number, -1
        self.cells: list[str] | None = None          # of the open row
        self.below: dict[int, tuple[int, str]] = {}  # column -> (rows still to fill, text) of cells that span rows
        self.cell: tuple[int, int, int] | None = None  # (first piece of text, columns, rows) of the open cell

    def fill(self) -> None:
        """Cells of earlier rows that reach into the next columns of the open row."""
        while (at := len(self.cells)) in self.below:
            left, text = self.below.pop(at)
            self.cells.append(text)
            if left > 1:
                self.below[at] = (left - 1, text)

    def end_cell(self, pieces: list[str]) -> None:
        if self.cell is None:
            return
        first, columns, rows = self.cell
        self.cell = None
        text = " ".join(html.unescape("".join(pieces[first:])).split())
        self.fill()
        for _ in range(columns):
            if rows > 1:
                self.below[len(self.cells)] = (rows - 1, text)
            self.cells.append(text)

    def end_row(self, pieces: list[str]) -> Iterator[tuple[int, int, list[str]]]:
        self.end_cell(pieces)
        if self.cells is None:
            return
        self.fill()
        cells, self.cells = self.cells, None
        if cells:
            self.rows += 1
            yield self.number, self.rows, cells


def table_rows(page: str) -> Iterator[tuple[int, int, list[str]]]:
    """(table, row, cells) of a page, in one pass over its tags. A tag ends what it can't stand in: a cell the
    cell before it, a row the row before it, a table's end all that is open in it."""
    open_tables: list[_OpenTable] = []
    pieces: list[str] = []   # texts since the outermost table began
    n_tables = 0
    for m in _HTML_TOKEN.finditer(page):
        name = (m[3] or "").lower()
        top = open_tables[-1] if open_tables else None
        if name == "table" and not m[2]:
            open_tables.append(_OpenTable(n_tables))
            n_tables += 1
        elif top is None:
            continue
        elif name == "table":
            yield from top.end_row(pieces)
            open_tables.pop()
            if not open_tables:
                pieces.clear()
        elif name in ("tr", "thead", "tbody", "tfoot"):
            yield from top.end_row(pieces)
            if name == "tr" and not m[2]:
                top.cells = []
        elif name in ("td", "th"):
            top.end_cell(pieces)
            if not m[2]:
                if top.cells is None:
                    top.cells = []
                spans = {k.lower(): int(v) for k, v in _SPAN.findall(m[4])}
                top.cell = (len(pieces), min(max(spans.get("colspan", 1), 1), MAX_COLSPAN),
                            min(max(spans.get("rowspan", 1), 1), MAX_ROWSPAN))
        elif name in ("br", "p", "div", "li"):
            pieces.append(" ")
        elif m[0][0] != "<" or m[0] == "<":
            pieces.append(m[0])
    for t in reversed(open_tables):   # unclosed at the end of the page
        yield from t.end_row(pieces)


def html_table_rows(df: DataFrame, page: str, keys: Sequence[str]) -> DataFrame:
    """``read_html``: the rows of all tables of each page -> (keys, ``table``, ``row``, ``cells``).

    Tables are numbered from 0 by where they begin in their page, a table within a cell too; a cell's text holds the
    texts of the tables within it. Texts are unescaped and runs of white space become one space. ``colspan`` and
    ``rowspan`` repeat a cell's text; cells and rows may lack their end tags. Scripts, styles and comments are left
    out, as are rows without cells. A page that is NULL, empty or without tables has no rows. Pages are independent: no
    shuffle, and a task holds one batch of pages and one page's open tables."""
    cut = [df.schema[k] for k in keys]
    schema = StructType([*cut, StructField("table", IntegerType()), StructField("row", IntegerType()),
                         StructField("cells", ArrayType(StringType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column(b.num_columns - 1)):
                rows = table_rows(text.as_py() or "")
                while some := list(itertools.islice(rows, 10_000)):
                    own = [b.column(k).take(pa.array([i] * len(some), pa.int64())) for k in range(len(cut))]
                    number, row, cells = zip(*some)
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(number, pa.int32()), pa.array(row, pa.int32()), pa.array(cells, pa.list_(pa.string()))],
                        names=schema.names)

    return df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{page}`").alias("_fw_page")).mapInArrow(read, schema)


# ---------------------------------------------------------------- materialised tables

def materialize(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """"If the stored table exists read it, else build it, save it, and read it back."
    A table exists if its folder holds the mark that Spark's commit leaves last; a folder
    without it is left over from a failed build and is built anew."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- profile

def table_profile(df: DataFrame) -> DataFrame:
    """``df.info()``: per column its type and non-NULL count, from one aggregation pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_fw_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"_fw_{i}").alias("non_null")) for i, f in enumerate(df.schema.fields)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
