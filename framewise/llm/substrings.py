"""Substring dedup: remove words of passages that occur more than once, by FM-indexes of shards.

A window is ``WINDOW`` consecutive words of a document. Windows are dealt to shards by
content: the smallest hashed ``GRAM``-gram in a window is its mark, so equal windows have equal
marks and meet in one shard, whatever documents hold them. Consecutive windows of one mark
are a segment. Of the segments only numbers travel at first:

* a mark that comes up once in the corpus holds no repeated window, and is dropped;
* segments whose whole content comes up again are repeated throughout; one of each content
  goes into the index if its mark has other contents;
* all other segments of marks that come up again are indexed, and streamed through the
  shard's index: backward search over the wavelet tree gives their matching statistics, and
  stretches of ``WINDOW`` words or more that occur twice are reported.

A mark of more than ``CONTENTS`` contents (the edges of a passage that very many documents share)
would fill a shard; its windows are dealt on by their whole content, each to a key of its own,
and those that come up again are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.arrow_text import Powers, chunks, is_word_byte, mix64, text_bytes, word_hashes, word_spans
from framewise.llm.fm_index import FMIndex
from framewise.llm.text import require, row_key
from framewise.session import cut_lineage

WINDOW = 35
GRAM = 5
CONTENTS = 64
SHARD_WORDS = 1 << 19
_MUL = np.uint64(0xD1342543DE82EF95)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x, k = np.minimum(x[:-k], x[k:]), 2 * k
    rest = width - k
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def stretch_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of each stretch of words."""
    up, down = powers.get(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MUL)


def segments(words: np.ndarray, first: np.ndarray, window: int, gram: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(document, first word, windows, mark, content, self) of the segments, words counted over the whole chunk.
    ``self``: the mark comes up twice in the segment, so that it may repeat itself."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    if not counts.sum():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for k in range(gram):
        grams = grams * _MUL + words[k:k + len(grams)]
    grams = mix64(grams)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 28) - 1)
    high = grams & ~low
    leftmost = (sliding_min(high | place, window - gram + 1) & low)[at].astype(np.int64)
    rightmost = (low - (sliding_min(high | (low - place), window - gram + 1) & low))[at].astype(np.int64)
    mark = grams[leftmost]
    new = np.ones(len(at), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    size = np.diff([*head, len(at)])
    again = np.maximum.reduceat((leftmost != rightmost).astype(np.int8), head) > 0
    start = at[head]
    content = stretch_hashes(words, start, start + size + window - 1, powers)
    return doc[head], start, size, mark[head], content, again | (size > window - gram + 1)


def _chunk_words(column: pa.Array, powers: Powers, inside: np.ndarray):
    for lo, _, data, offsets in chunks(*text_bytes(column)):
        starts, ends, first = word_spans(data, offsets, inside)
        yield lo, word_hashes(data, starts, ends, powers), first


def _list_segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(``mark``, ``content``, ``rk``, ``at``, ``size``, ``self``) of all documents."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, inside = Powers(), is_word_byte()
        for b in batches:
            rk = b.column("rk").to_numpy()
            for lo, words, first in _chunk_words(b.column("text"), powers, inside):
                doc, start, size, mark, content, again = segments(words, first, window, gram, powers)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mark.view(np.int64)), pa.array(content.view(np.int64)), pa.array(rk[lo + doc]), pa.array((start - first[doc]).astype(np.int32)),
                     pa.array(size.astype(np.int32)), pa.array(again)], names=["mark", "content", "rk", "at", "size", "self"])
    return docs.mapInArrow(read, "mark long, content long, rk long, at int, size int, self boolean")


INDEXED, STREAMED, DEALT_ON = 1, 2, 4


def _plan(listed: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(intervals repeated as a whole, segments that need their words with what to do with them)."""
    alive = cut_lineage(listed.groupBy("mark").agg(F.count("*").alias("n"), F.max("self").alias("s")).where("n > 1 or s").select("mark"), "marks")
    left = cut_lineage(listed.drop("self").join(alive, "mark", "left_semi"), "segments-alive")
    contents = cut_lineage(left.groupBy("mark", "content").agg(F.count("*").alias("n"), F.min(F.struct("rk", "at")).alias("one"), F.max("size").alias("size")), "contents")
    per_mark = cut_lineage(contents.groupBy("mark").agg(F.count("*").alias("contents")), "contents-of-marks")
    many = F.col("contents") > CONTENTS
    todo = contents.join(per_mark, "mark").where("n = 1 or contents > 1")
    what = F.when(many, DEALT_ON).when(F.col("n") == 1, INDEXED | STREAMED).otherwise(INDEXED)
    need = todo.select("mark", "one.rk", "one.at", "size", what.alias("what"))  # the one segment, or one for all with its content
    copied = cut_lineage(contents.where("n > 1").select("mark", "content"), "contents-copied")
    whole = left.join(copied, ["mark", "content"], "left_semi").select("rk", "at", (F.col("at") + F.col("size") + (window - 1)).alias("end"))
    return whole, need


def _with_words(docs: DataFrame, need: DataFrame, window: int) -> DataFrame:
    """(``mark``, ``rk``, ``at``, ``size``, ``what``, ``words``): 8-byte word hashes; segments to be dealt on
    come as their windows, one row each, with the window's hash for a mark and no words."""
    by_doc = need.groupBy("rk").agg(F.collect_set(F.struct("mark", "at", "size", "what")).alias("need"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, inside = Powers(), is_word_byte()
        for b in batches:
            rk, wanted = b.column("rk").to_pylist(), b.column("need").to_pylist()
            for lo, words, first in _chunk_words(b.column("text"), powers, inside):
                out = {k: [] for k in ("mark", "rk", "at", "size", "what", "words")}

                def put(*values):
                    for column, v in zip(out.values(), values, strict=True):  # noqa: B023
                        column.append(v)

                for d in range(len(first) - 1):
                    for s in wanted[lo + d]:
                        x = first[d] + s["at"]
                        if s["what"] == DEALT_ON:
                            from_ = np.arange(x, x + s["size"])
                            for k, h in enumerate(stretch_hashes(words[x:x + s["size"] + window - 1], from_ - x, from_ - x + window, powers).view(np.int64).tolist()):
                                put(h, rk[lo + d], s["at"] + k, 1, DEALT_ON, None)
                        else:
                            put(s["mark"], rk[lo + d], s["at"], s["size"], s["what"], words[x:x + s["size"] + window - 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["mark"], pa.int64()), pa.array(out["rk"], pa.int64()), pa.array(out["at"], pa.int32()), pa.array(out["size"], pa.int32()),
                     pa.array(out["what"], pa.int32()), pa.array(out["words"], pa.binary())], names=list(out))

    return docs.join(by_doc, "rk").mapInArrow(read, "mark long, rk long, at int, size int, what int, words binary")


def _search_shard(window: int):
    def search(rows: pa.Table) -> pa.Table:
        """Index the shard's segments, each closed by a separator, and stream those that ask for it."""
        parts = [np.frombuffer(x, np.uint64) for x in rows["words"].to_pylist()]
        size = np.array([len(x) for x in parts])
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        names, numbers = np.unique(np.concatenate(parts), return_inverse=True)
        text = np.zeros(int(ends[-1]) + 1, np.int64)  # 0 separates; no pattern holds it
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = numbers + 1
        index = FMIndex(text, len(names) + 1)
        asks = np.flatnonzero(rows["what"].to_numpy() & STREAMED)
        seg, lo, hi = index.repeats(text, starts[asks], ends[asks], window)
        own = asks[seg]
        at = rows["at"].to_numpy()[own] - starts[own]
        return pa.table({"rk": rows["rk"].to_numpy()[own], "at": pa.array(lo + at, pa.int32()), "end": pa.array(hi + at, pa.int32())})
    return search


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``rk``, ``at``, ``end``): stretches of words (the end excluded) covered by repeated windows; they may overlap.

    Rows that agree in id and text share the row key ``rk`` and repeat each other."""
    keyed = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rk"), F.col(text_col).alias("text"))
    listed = cut_lineage(_list_segments(keyed, window, gram), "segments")
    whole, need = _plan(listed, window)
    need = cut_lineage(need, "segments-needed")
    words = need.where(F.col("what") != DEALT_ON).agg(F.sum(F.col("size") + (window - 1))).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    carried = cut_lineage(_with_words(keyed, need, window), "segment-words")
    found = (carried.where(F.col("what") != DEALT_ON).withColumn("shard", F.pmod(F.xxhash64("mark"), F.lit(shards)))
             .groupBy("shard").applyInArrow(_search_shard(window), "rk long, at int, end int"))
    dealt = carried.where(F.col("what") == DEALT_ON).select("mark", "rk", "at")
    twice = cut_lineage(dealt.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "windows-again")
    again = dealt.join(twice, "mark", "left_semi").select("rk", "at", (F.col("at") + window).alias("end"))
    return cut_lineage(whole.unionByName(found).unionByName(again), "passages")


def drop_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: the id), ``n_words``, ``n_removed`` and ``kept_text``: the words that no repeated
    window covers, joined by one space.

    A window is ``window`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document, unchanged, and repeated if
    its words also start anywhere else, in the same document too. Windows are judged on the input, so every copy
    goes. Shorter documents, NULL and empty texts (no words) lose nothing. Repeated rows keep their rows and count
    as copies; an empty table gives an empty result; a kept column named like a result is refused."""
    keep = [id_col] if keep is None else keep
    require(docs, id_col, text_col, *keep)
    if {"n_words", "n_removed", "kept_text"} & set(keep):
        raise ValueError("n_words, n_removed and kept_text are results; leave such columns out of keep")
    cuts = (repeated_passages(docs, window, id_col=id_col, text_col=text_col)
            .groupBy("rk").agg(F.collect_set(F.struct("at", "end")).alias("__cuts")))
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType())])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, kept = [], [], []
            for text, cut in zip(b.column("__text").to_pylist(), b.column("__cuts").to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()  # at just the six ASCII space characters
                n.append(len(words))
                if cut:
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, [c["at"] for c in cut], 1)
                    np.add.at(depth, [c["end"] for c in cut], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=[*keep, "n_words", "n_removed", "kept_text"])

    return (docs.select(*keep, F.col(text_col).alias("__text"), row_key(F.col(id_col), F.col(text_col)).alias("__rk"))
            .join(cuts.withColumnRenamed("rk", "__rk"), "__rk", "left").select(*keep, "__text", "__cuts").mapInArrow(strip, schema))
