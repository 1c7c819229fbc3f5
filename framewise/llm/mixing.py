"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

A document's expected copies are ``target / size`` of its source. Within a source the
documents are laid on a line in a fixed order, each as long as its expected copies, and
the line is shifted by one random offset; a document is emitted once for every integer
its piece of the line crosses. Sizes along the line rise, so that the words taken differ
from the target by no more than about one document of the source.

The prefix sums never see a source, or a group of equal documents, as a whole: the order
is (size class, md5 bucket, md5), so the position of a document is the number of rows in
earlier classes, plus those in earlier buckets of its class, plus its rank in its bucket.
The first two come from counts (at most some 2,600 classes a source and 256 buckets a
class); only the rank needs rows, and a bucket holds 1/256 of a class at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.text import require, word_count
from framewise.session import cut_lineage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"


def size_class(size: str) -> Column:
    """Exact below 64, then 32 classes per power of two: a bounded number for any size."""
    return F.expr(f"""case when {size} < 64 then {size} else
        64 + (length(bin({size})) - 7) * 32 + shiftright({size}, length(bin({size})) - 6) - 32 end""").cast("int")


def _keyed(df: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str], seed: str) -> DataFrame:
    """Internal columns start with an underscore pair, so that columns of the table cannot clash."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}")))
    return (df.select(*[F.col(c) for c in keep], F.col(id_col).alias("__id"),
                      F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("~")).alias("__src"),
                      F.col(source_col).isNull().alias("__nosrc"),
                      word_count(F.col(text_col)).alias("__size"), digest.alias("__md5"))
            .withColumn("__cls", size_class("__size"))
            .withColumn("__bucket", F.substring("__md5", 1, 2)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Target words of each source; one row per source in and out (``__src, __nosrc, __words``).

    With caps ``max_copies * words`` the targets are ``min(cap, level * weight)`` for the one
    level at which they sum to all words. For any set of capped sources that equation gives at
    most that level, and exactly that level for the right set, which is a prefix in the order of
    cap / weight: so the level is the largest over all prefixes."""
    everything = Window.partitionBy()
    by_name = Window.orderBy("__nosrc", "__src")
    by_ratio = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("__nosrc"), F.col("__src")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")
    level = (F.sum("__words").over(everything) - F.coalesce(F.sum("__cap").over(by_ratio), F.lit(0))) / \
            (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(by_ratio), F.lit(0)))
    return (sizes.withColumn("__w", weight).withColumn("__cap", F.col("__words") * max_copies)
            .withColumn("__level", level)
            .withColumn("__target", F.least(F.col("__cap").cast("double"),
                                            F.max("__level").over(everything) * F.col("__w"))))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES,
        seed: str = SEED) -> DataFrame:
    """One row per input row: the kept columns (default: the id), then ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken = copies * size``.

    Sources in code point order, NULL last, weigh 5, 2, 1, 5, ... NULL text has size 0; a document
    of size 0 takes no words whatever its copies, and a source of size 0 has target 0 and no copies.
    NULL ids count like an empty id; repeated rows are separate documents. An empty table gives an
    empty result. Reruns agree: order and offset come from md5 of id, source and ``seed``."""
    keep = [id_col] if keep is None else keep
    require(df, id_col, text_col, source_col, *keep)
    clash = {"size", "source_size", "target", "copies", "taken"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results of mix; rename or leave them out of keep")
    docs = _keyed(df, id_col, text_col, source_col, keep, seed)
    spot = ["__src", "__cls", "__bucket"]
    counts = cut_lineage(docs.groupBy("__nosrc", *spot).agg(F.count("*").alias("__n"), F.sum("__size").alias("__words")),
                         "mix-counts")
    sources = targets(counts.groupBy("__src", "__nosrc").agg(F.sum("__words").alias("__words")), weights, max_copies)
    before = (Window.unboundedPreceding, -1)
    classes = (counts.groupBy("__src", "__cls").agg(F.sum("__n").alias("__n"))
               .withColumn("__before_cls", F.coalesce(F.sum("__n").over(
                   Window.partitionBy("__src").orderBy("__cls").rowsBetween(*before)), F.lit(0)))
               .drop("__n"))
    offset = F.conv(F.substring(F.md5(F.concat(F.col("__src"), F.lit(f"|{seed}"))), 1, 8), 16, 10).cast("double") / 2.0 ** 32
    places = (counts.withColumn("__before_bucket", F.coalesce(F.sum("__n").over(
                  Window.partitionBy("__src", "__cls").orderBy("__bucket").rowsBetween(*before)), F.lit(0)))
              .join(classes, ["__src", "__cls"])
              .join(sources.select("__src", F.col("__words").alias("source_size"), F.col("__target").alias("target")), ["__src"])
              .select(*spot, "source_size", "target",
                      (F.col("__before_cls") + F.col("__before_bucket")).alias("__before"),
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("__rate"),
                      offset.alias("__u")))
    rank = F.row_number().over(Window.partitionBy(*spot).orderBy("__md5", "__size", "__id"))
    at = lambda k: F.floor(F.col("__rate") * k + F.col("__u"))
    return (docs.drop("__nosrc").join(places, spot)
            .withColumn("__at", F.col("__before") + rank)
            .withColumn("copies", (at(F.col("__at")) - at(F.col("__at") - 1)).cast("long"))
            .select(*keep, F.col("__size").alias("size"), "source_size", "target", "copies",
                    (F.col("copies") * F.col("__size")).alias("taken")))


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy taken: ``copy`` counts from 1."""
    return (mixed.where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


SQL = r"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce('s' || source, '~') AS src, source IS NULL AS nosrc,
         md5(coalesce(doc_id::VARCHAR, '') || '|mix-1') AS h
  FROM documents),
c AS (SELECT *, CASE WHEN size < 64 THEN size
        ELSE 64 + (length(bin(size)) - 7) * 32 + (size >> (length(bin(size)) - 6)) - 32 END AS cls FROM d),
s AS (SELECT src, nosrc, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY nosrc, src)) - 1) % 3 + 1]::BIGINT AS w, words * 3 AS cap FROM s),
l AS (SELECT *, (sum(words) OVER ()::DOUBLE - coalesce(sum(cap) OVER p, 0)) /
                (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level
      FROM w WINDOW p AS (ORDER BY cap / w, nosrc, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap::DOUBLE, max(level) OVER () * w) AS target,
        ('0x' || substr(md5(src || '|mix-1'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM l),
r AS (SELECT doc_id, size, t.words AS source_size, target, u,
        CASE WHEN t.words > 0 THEN target / t.words ELSE 0.0::DOUBLE END AS rate,
        row_number() OVER (PARTITION BY c.src ORDER BY cls, h, size, doc_id) AS k
      FROM c JOIN t ON c.src = t.src)
SELECT doc_id, size, source_size, target, floor(rate * k + u)::BIGINT - floor(rate * (k - 1) + u)::BIGINT AS copies,
       (floor(rate * k + u)::BIGINT - floor(rate * (k - 1) + u)::BIGINT) * size AS taken
FROM r
"""
