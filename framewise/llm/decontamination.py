"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, A-Z lower-cased. Each test item is looked up by its
rarest word pairs in the corpus. How many seeds an item needs follows from the least
score that is reported: an alignment of that score leaves so many of the item's pairs
intact that at least ``NEED`` (or all that are sure) of the seeds must stand in the passage;
so no copy is missed for being common, in part or as a whole, or for how its edits are
spread: longer grams would not do, as a word put in after every second one leaves no three
words together. Where the least score is met by one matched word, single words are the seeds.

1. A filter of fixed size (``SLOTS`` bytes) of the items' grams goes to all tasks; the
   documents' grams that pass are counted by document, and the counts are summed.
2. A filter of the seeds alone, which holds the items' length classes, cuts the passages
   out of the documents: the words around seeds, as far as the longest item can reach.
3. Passages and items are joined on seeds; each pair is aligned once, as words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.arrow_text import Powers, chunks, given_back, gram_hashes, is_alnum_byte, lower, text_bytes, word_hashes, word_spans
from framewise.llm.text import require, row_key
from framewise.session import cut_lineage

GRAM = 2
LEAST_WORDS = 1
LEAST_SCORE = 0.5
NEED = 3
SLOTS = 1 << 22
MATCH, MISMATCH, GAP = 1, -1, -1


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, each row's first word and the end) of the chunks of a column."""
    powers, inside = Powers(), is_alnum_byte()
    for lo, hi, data, offsets in chunks(*text_bytes(texts)):
        starts, ends, first = word_spans(data, offsets, inside)
        yield lo, hi, word_hashes(lower(data), starts, ends, powers), first


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(SLOTS - 1)).astype(np.int64)


def least_points(n_words: int, least_score: float) -> int:
    """The least whole score of an item that is reported, or one less where rounding leaves that open."""
    return math.ceil(n_words * least_score - 1e-9)


def gram_sizes(items: DataFrame, least_score: float) -> list[int]:
    """The sizes of the grams of the items at hand: single words only if there is an item of which one matched word is enough."""
    shortest = items.agg(F.min("n_words")).first()[0]
    return [GRAM] if shortest is None or least_points(shortest, least_score) >= GRAM else [1, GRAM]


def _items(benchmark: DataFrame, id_col: str, text_col: str, least_score: float, least_words: int) -> DataFrame:
    """(``item_id``, ``n_words``, ``sure``, ``words``, ``grams``) of the items of at least ``least_words`` words.

    ``sure``: so many of the item's different grams stand in any copy that is reported. With
    scores 1, -1, -1 such a copy has p more matched words than edits (words replaced, put in or left out), p the least
    points. Its matched words lie in at most edits + 1 runs, so at least p - 1 pairs stay intact, wherever the edits are."""
    kind = benchmark.schema[id_col].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, words, first in hashed_words(b.column("text")):
                own = [words[first[i]:first[i + 1]] for i in range(hi - lo)]
                sure, grams = [], []
                for w in own:
                    points = least_points(len(w), least_score)
                    n = GRAM if points >= GRAM else 1
                    gram = np.unique(gram_hashes(w, np.array([0, len(w)]), n)[0]).view(np.int64)
                    repeated = len(w) - n + 1 - len(gram)  # places whose gram stands elsewhere in the item too
                    sure.append(max(points - n + 1 - repeated, 1))
                    grams.append(gram)
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id").slice(lo, hi - lo), pa.array([len(w) for w in own], pa.int32()), pa.array(sure, pa.int32()),
                     pa.array([w.tobytes() for w in own], pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                    names=["item_id", "n_words", "sure", "words", "grams"])

    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(given_back(read), f"item_id {kind.simpleString()}, n_words int, sure int, words binary, grams array<long>").where(F.col("n_words") >= least_words)


def filter_of(grams: DataFrame) -> np.ndarray:
    """A byte for each slot: 0, or the largest ``mark`` of the grams that fall in it. At most ``SLOTS`` rows come."""
    got = (grams.groupBy(F.col("gram").bitwiseAND(SLOTS - 1).alias("slot")).agg(F.max("mark").cast("int").alias("mark")).toArrow())
    out = np.zeros(SLOTS, np.uint8)
    out[got["slot"].to_numpy()] = got["mark"].to_numpy()
    return out


def document_counts(docs: DataFrame, text_col: str, marks: np.ndarray, sizes: list[int]) -> DataFrame:
    """(``gram``, ``n_docs``) over all documents of the grams that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, words, first in hashed_words(b.column("text")):
                for size in sizes:
                    grams, doc = gram_hashes(words, first, size)
                    hit = shared.value[slot(grams)] > 0
                    seen = np.unique(np.rec.fromarrays([grams[hit], doc[hit]], names="g,d"))["g"]
                    values, n = np.unique(seen, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(given_back(count), "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n_docs")))


def seeds_of(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(``item_id``, ``gram``, ``n_words``, ``need``): the rarest grams of each item, ties by hash; all but ``sure`` -
    ``need`` of them are seeds, so of the ``sure`` grams in a copy that is reported ``need`` are seeds at least."""
    grams = items.select("item_id", "n_words", "sure", F.size("grams").alias("m"), F.explode("grams").alias("gram"))
    ranked = grams.join(counts, "gram", "left").withColumn(
        "rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("n_docs", F.lit(0)), "gram")))
    need = F.least("sure", F.lit(NEED))
    return ranked.withColumn("need", need).where(F.col("rank") <= F.col("m") - F.col("sure") + need).select("item_id", "gram", "n_words", "need")


def _passages(docs: DataFrame, id_col: str, text_col: str, marks: np.ndarray, sizes: list[int]) -> DataFrame:
    """(``doc_id``, ``rk``, ``start``, ``words``, ``grams``): stretches of words around seeds."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, words, first in hashed_words(b.column("text")):
                hits = []
                for size in sizes:
                    grams, doc = gram_hashes(words, first, size)
                    mark = shared.value[slot(grams)]
                    at = np.flatnonzero(mark)
                    # the n-th gram of a document starts at its n-th word
                    grams_before = np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - size + 1, 0))])
                    hits.append((at - grams_before[doc[at]] + first[doc[at]], doc[at], grams[at], mark[at].astype(np.int64)))
                at, own, gram, mark = (np.concatenate(x) for x in zip(*hits, strict=True))
                row, start, text, held = [], [], [], []
                if len(at):
                    order = np.argsort(at, kind="stable")
                    place, own, gram, reach = at[order], own[order], gram[order], 2 << mark[order]
                    left, right = np.maximum(place - reach, first[own]), np.minimum(place + reach, first[own + 1])
                    open_end = np.maximum.accumulate(right)  # documents rise, and so do their ends
                    new = np.concatenate([[True], (own[1:] != own[:-1]) | (left[1:] > open_end[:-1])])
                    heads = np.flatnonzero(new)
                    lefts, rights = np.minimum.reduceat(left, heads), np.maximum.reduceat(right, heads)
                    for h, end, x, y in zip(heads, [*heads[1:], len(at)], lefts, rights, strict=True):
                        row.append(lo + int(own[h]))
                        start.append(int(x - first[own[h]]))
                        text.append(words[x:y].tobytes())
                        held.append(np.unique(gram[h:end]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())), b.column("rk").take(pa.array(row, pa.int64())),
                     pa.array(start, pa.int32()), pa.array(text, pa.binary()), pa.array(held, pa.list_(pa.int64()))],
                    names=["doc_id", "rk", "start", "words", "grams"])

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("rk"), F.col(text_col).alias("text"))
    return rows.mapInArrow(given_back(cut), f"doc_id {kind}, rk long, start int, words binary, grams array<long>")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, first word, end word) of the best local alignment of an item within a passage.

    One row of the table for each word of the item; gaps along the row come from a running maximum. With
    each cell goes the place where its alignment began; of equal scores the first cell wins."""
    n = len(passage)
    slide = np.arange(n + 1) * -GAP
    above, began = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        cell, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
        diagonal, vertical = above[:-1] + step, above[1:] + GAP
        cell[1:] = np.maximum(diagonal, vertical)
        start[1:] = np.where(diagonal >= vertical, began[:-1], began[1:])
        fresh = cell <= 0
        cell[fresh], start[fresh] = 0, np.flatnonzero(fresh)
        lifted = cell + slide
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        along = top - slide
        start = np.where(along > cell, start[source], start)
        above, began = np.maximum(cell, along), start
        j = int(above.argmax())
        if above[j] > best[0]:
            best = (int(above[j]), int(began[j]), j)
    return best


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(``doc_id``, ``rk``, ``item_id``, ``score``, ``first_word``, ``end_word``): documents that hold a copy of a test item.

    ``score`` is that of the best local alignment over the item's number of words (1: word for word), at
    least ``least_score`` (above 0); the words are counted from 0, the end excluded. ``rk`` is the row key of id and
    text: rows that agree in both give one answer. NULL and empty texts hold nothing. Items of any length
    are looked for, as long as they hold a word; a caller whose short items can't be told from ordinary text leaves out those of
    fewer than ``least_words`` words. An item of two words is found at 0.5 where one of them stands. Repeated items are
    reported under each of their ids. NULL ids stay NULL. Other columns are ignored; empty tables give an
    empty result."""
    require(docs, id_col, text_col)
    require(benchmark, item_col, item_text_col)
    if not least_score > 0:
        raise ValueError("least_score must be above 0: a score of 0 needs no common word")
    if least_words < 1:
        raise ValueError("an item without words has no copies: least_words must be 1 or more")
    items = cut_lineage(_items(benchmark, item_col, item_text_col, least_score, least_words).dropDuplicates(["item_id", "words"])
                        .withColumn("item", F.xxhash64("item_id", "words")), "leak-items")
    every = items.select(F.explode("grams").alias("gram"), F.lit(1).alias("mark"))
    sizes = gram_sizes(items, least_score)
    counts = document_counts(docs, text_col, filter_of(every), sizes)
    seeds = cut_lineage(seeds_of(items.withColumn("item_id", F.col("item")), counts), "leak-seeds")
    longest = F.ceil(F.log2(F.col("n_words").cast("double"))) + 1
    passages = cut_lineage(_passages(docs, id_col, text_col, filter_of(seeds.select("gram", longest.alias("mark"))), sizes)
                           .withColumn("pid", F.xxhash64("rk", "start")), "leak-passages")
    pairs = (passages.select("pid", F.explode("grams").alias("gram")).distinct()
             .join(seeds.select("gram", F.col("item_id").alias("item"), "need"), "gram")
             .groupBy("pid", "item").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("pid", "item"))
    both = (pairs.join(passages.select("pid", "doc_id", "rk", "start", "words").dropDuplicates(["pid"]), "pid")
            .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
            .select("doc_id", "rk", "start", "words", "item_id", "item_words"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for words, item in zip(b.column("words").to_pylist(), b.column("item_words").to_pylist(), strict=True):
                item = np.frombuffer(item, np.uint64)
                points, lo, hi = align(item, np.frombuffer(words, np.uint64))
                found.append((points / (MATCH * len(item)), lo, hi))
            share, lo, hi = zip(*found, strict=True) if found else ((), (), ())
            start = b.column("start").to_numpy()
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rk"), b.column("item_id"), pa.array(share, pa.float64()),
                 pa.array(start + np.array(lo, np.int64), pa.int64()), pa.array(start + np.array(hi, np.int64), pa.int64())],
                names=["doc_id", "rk", "item_id", "score", "first_word", "end_word"])
            yield out.filter(pa.array(np.array(share) >= least_score, pa.bool_()))

    kinds = f"doc_id {docs.schema[id_col].dataType.simpleString()}, rk long, item_id {benchmark.schema[item_col].dataType.simpleString()}"
    scored = both.mapInArrow(given_back(score), f"{kinds}, score double, first_word long, end_word long")
    best = Window.partitionBy("rk", "item_id").orderBy(F.desc("score"), "first_word")
    return scored.withColumn("__n", F.row_number().over(best)).where("__n = 1").drop("__n")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, id_col: str = "doc_id", text_col: str = "text",
               least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents, all their columns, without those that hold a copy of a test item."""
    leaks = cut_lineage(find_leaks(docs, benchmark, least_score, id_col, text_col, least_words=least_words).select(F.col("rk").alias("__rk")).distinct(), "leaks")
    return docs.join(leaks, row_key(docs[id_col], docs[text_col]) == leaks["__rk"], "left_anti")
