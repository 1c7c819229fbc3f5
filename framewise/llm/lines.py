"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A run is a Parquet table (hash, number of documents, fresh) sorted by hash in each file.
Each new batch meets the runs in a merge join on the hash: what no run holds (the
anti-join) are the batch's fresh keys, and only these are new entries; what some run
holds already only adds its count. So every key is fresh in exactly one run, and the sum
over the runs is its number of documents. ``fanout`` runs of a level are merged into one
run of the next, where a count falls in with its key once both are there: a key is
rewritten once a level and the number of runs grows with the logarithm of the batches.
Batches meet runs by hashes and counts alone: no text is moved for it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewise.llm.text import SPACES, lower_ascii, require, row_key
from framewise.session import cut_lineage, scratch_path


def split_lines(text: Column) -> Column:
    """Lines of a text; NULL and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(SPACES)))


def line_hash(line: Column, min_chars: int) -> Column:
    """128-bit hash of the line's key; NULL for keys shorter than ``min_chars`` code points."""
    key = line_key(line)
    return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))


def _hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(``rk``, ``h``): the distinct line hashes of each document."""
    distinct = F.array_distinct(F.transform(split_lines(F.col(text_col)), lambda x: line_hash(x, min_chars)))
    return (docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rk"), F.explode(distinct).alias("h"))
            .where("h is not null"))


#: The most bytes of files in a batch, and the fewest batches of a table of enough files.
BATCH_BYTES = 256 << 30
LEAST_BATCHES = 4


def batches_of(docs: DataFrame, most_bytes: int = BATCH_BYTES, least_batches: int = LEAST_BATCHES) -> list[DataFrame]:
    """The rows of a table of files, dealt into batches by ranges of file names.

    Batches hold whole files of about the same number of bytes: a ``least_batches``-th of the table, but at most
    ``most_bytes`` (or one file). The cuts are summed up in Spark, from one row a file; Spark prunes the files of other batches
    from each scan. Filters on ``docs`` stay in force. Rows that come from no file, and tables joined of several, are one batch."""
    if most_bytes < 1 or least_batches < 1:
        raise ValueError("most_bytes and least_batches must be 1 or more")
    try:
        meta = docs.metadataColumn("_metadata")
        files = docs.select(meta["file_path"].alias("path"), meta["file_size"].alias("bytes")).distinct()
    except AnalysisException:
        return [docs]
    upto = F.sum("bytes").over(Window.orderBy("path"))
    share = F.least(F.ceil(F.sum("bytes").over(Window.partitionBy()) / least_batches), F.lit(most_bytes))
    cuts = [r["path"] for r in files.select("path", F.floor((upto - F.col("bytes")) / F.greatest(share, F.lit(1))).alias("batch"))
            .groupBy("batch").agg(F.min("path").alias("path")).orderBy("path").collect()]
    if len(cuts) < 2:
        return [docs]
    path = meta["file_path"]
    return [docs.where((path >= cut) & (path < after) if after else path >= cut)
            for cut, after in zip(cuts, [*cuts[1:], None], strict=True)]


class LineRuns:
    """The runs of a corpus. ``add`` takes batches of any number and size; the folders lie below the
    shared checkpoint folder, so they outlive executors."""

    def __init__(self, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1,
                 fanout: int = 4):
        if fanout < 2 or min_chars < 1:
            raise ValueError("fanout must be 2 or more, min_chars 1 or more")
        self.spark, self.id_col, self.text_col = spark, id_col, text_col
        self.min_chars, self.fanout = min_chars, fanout
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions("h").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        return (self.spark.read.parquet(*paths).groupBy("h")
                .agg(F.sum("n_docs").alias("n_docs"), F.bool_or("fresh").alias("fresh")))

    def _known(self) -> DataFrame:
        """Every key that some run holds, once: a key is fresh in one run only."""
        return self.spark.read.parquet(*self.runs()).where("fresh").select("h", F.lit(True).alias("__known"))

    def add(self, batch: DataFrame) -> None:
        """Write the batch's run, then compact every level that is full.

        One merge join with the runs' keys says both: keys without a partner are fresh (the anti-join),
        the others are counts for a key that an older run holds."""
        require(batch, self.id_col, self.text_col)
        own = _hashes(batch, self.id_col, self.text_col, self.min_chars).groupBy("h").agg(F.count("*").alias("n_docs"))
        if self.runs():
            own = own.join(self._known(), "h", "left").select("h", "n_docs", F.col("__known").isNull().alias("fresh"))
        else:
            own = own.withColumn("fresh", F.lit(True))
        self._write(own, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            level += 1

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def frequent(self, min_docs: int) -> DataFrame:
        """Hashes found in at least ``min_docs`` documents of all batches, written once."""
        if not self.runs():
            raise ValueError("no batch was added")
        return cut_lineage(self._merged(self.runs()).where(F.col("n_docs") >= min_docs).select("h"), "line-frequent")

    def strip(self, docs: DataFrame, min_docs: int, keep: list[str] | None = None) -> DataFrame:
        """The kept columns (default: the id) and ``lines``, ``kept`` (arrays) of each document.

        Only hits travel: the documents' hashes meet the frequent ones in a sort merge join that Spark
        can split where one line fills many documents; what is left goes back to its document."""
        keep = [self.id_col] if keep is None else keep
        require(docs, self.id_col, self.text_col, *keep)
        hits = (_hashes(docs, self.id_col, self.text_col, self.min_chars)
                .join(self.frequent(min_docs), "h", "left_semi")
                .groupBy("rk").agg(F.collect_set("h").alias("__drop")))
        key = row_key(F.col(self.id_col), F.col(self.text_col))
        lines = split_lines(F.col("__text"))
        kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), line_hash(x, self.min_chars)), F.lit(False)))
        return (docs.select(*keep, F.col(self.text_col).alias("__text"), key.alias("__rk"))
                .join(hits.withColumnRenamed("rk", "__rk"), "__rk", "left")
                .select(*keep, lines.alias("lines"),
                        F.when(F.col("__drop").isNull(), lines).otherwise(kept).alias("kept")))


def drop_common_lines(batches: list[DataFrame] | None, docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Drop every line whose key stands in at least ``min_docs`` documents of ``batches`` (None: of ``docs``, in batches of its files).

    A key is the line without white space at its ends, A-Z lower-cased. Each row counts as one
    document, however often it repeats a line. NULL or empty text is one empty line, whose empty key
    never counts; a document all of whose lines go keeps an empty array. Extra columns are ignored
    unless named in ``keep``; an empty table gives an empty result."""
    spark = docs.sparkSession
    runs = LineRuns(spark, id_col, text_col, min_chars)
    for batch in batches_of(docs) if batches is None else batches:
        runs.add(batch)
    return runs.strip(docs, min_docs, keep)


SQL = r"""
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT max(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (key IN (SELECT key FROM f))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM k GROUP BY r
"""
