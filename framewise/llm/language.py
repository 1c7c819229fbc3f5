"""Language ID: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; letters stand for themselves, everything else is one separator.
N-grams of 1 to 3 characters that hold a letter are hashed to ``buckets``. Training counts
them by language in Arrow batches, each task adding up its own matrix, and sums the
matrices in Spark; the log-probability matrix (languages x buckets, of a size checked
against ``MAX_ENTRIES``) is broadcast, and a document's score is the sum of the matrix
rows its n-grams name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.arrow_text import given_back, mix64
from framewise.llm.text import require

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
MAX_ENTRIES = 1 << 23  # 32 MB of float32
CHUNK_CHARS = 1 << 17
UNDETERMINED = "und"


class Letters:
    """Maps code points to themselves for letters, to 0 otherwise; looks up only those that occur."""

    def __init__(self):
        self.known = np.zeros(0x110000, bool)
        self.symbol = np.zeros(0x110000, np.uint32)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        new = np.unique(codes[~self.known[codes]])
        if len(new):
            self.symbol[new] = [c if chr(c).isalpha() else 0 for c in new.tolist()]
            self.known[new] = True
        return self.symbol[codes]


def text_chunks(texts: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, lower-cased texts) of runs of whole texts; only one run's are Python strings."""
    run, size, first = [], 0, 0
    for i, t in enumerate(texts):
        t = (t.as_py() or "").lower()
        if run and size + len(t) > limit:
            yield first, run
            run, size, first = [], 0, i
        run.append(t)
        size += len(t)
    if run:
        yield first, run


def grams(run: list[str], letters: Letters, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram at every place, -1 where it holds no letter; and each text's
    first place (one more entry). Two separators stand between texts, so no n-gram spans two."""
    joined = "\0\0" + "\0\0".join(run) + "\0\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = letters.symbols(codes).astype(np.uint64)
    starts = np.cumsum([1, *[len(t) + 2 for t in run]])  # from the second separator before the text
    for n in ORDERS:
        size = len(s) - n + 1
        h, any_letter = np.zeros(size, np.uint64), np.zeros(size, bool)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + s[k:k + size]
            any_letter |= s[k:k + size] > 0
        after = starts[1:] - 1
        any_letter[after[after < size]] = False  # from the first separator after a text on: the next text's letters
        bucket = (mix64(h + np.uint64(n)) % np.uint64(buckets)).astype(np.int64)
        yield np.where(any_letter, bucket, -1), np.minimum(starts, size)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # languages x buckets, float32


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """Fits on all rows with a language and a text. Without any, the model knows no language. Raises if
    languages x buckets would pass ``MAX_ENTRIES``."""
    require(labelled, text_col, lang_col)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    priors = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_ENTRIES // buckets + 1).collect()}
    if len(priors) * buckets > MAX_ENTRIES:
        raise ValueError(f"{len(priors)} languages or more with {buckets} buckets: at most {MAX_ENTRIES // buckets} can be learned")
    if not priors:
        return Model([], np.zeros(0), np.zeros((0, buckets), np.float32))
    languages = sorted(priors)
    row_of = {v: i for i, v in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, counts = Letters(), np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            lang = np.array([row_of[x] for x in batch.column("lang").to_pylist()], np.int64)
            for first, run in text_chunks(batch.column("text")):
                order = lang[first:first + len(run)]
                for bucket, at in grams(run, letters, buckets):
                    owner = np.repeat(order, np.diff(at))
                    bucket = bucket[at[0]:at[-1]]
                    counts += np.bincount((owner * buckets + bucket)[bucket >= 0], minlength=counts.size).reshape(counts.shape)
        at_lang, at_bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at_lang, pa.int32()), pa.array(at_bucket, pa.int32()), pa.array(counts[at_lang, at_bucket])],
                                         names=["l", "b", "n"])

    summed = rows.mapInArrow(given_back(count), "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()  # at most MAX_ENTRIES
    matrix = np.ones((len(languages), buckets))
    matrix[summed["l"].to_numpy(), summed["b"].to_numpy()] += summed["n"].to_numpy()
    total = sum(priors.values())
    return Model(languages, np.log(np.array([priors[v] / total for v in languages])),
                 np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32))


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all), ``lang_pred`` and ``score``, the probability of that language.

    Texts that are NULL or hold no letter get ``und`` and score 0, all texts if the model knows no language. Ties go to the language first in code
    point order. Repeated rows keep their rows; an empty table gives an empty result. A kept column named
    like a result is refused."""
    keep = df.columns if keep is None else keep
    require(df, text_col, *keep)
    if {"lang_pred", "score"} & set(keep):
        raise ValueError("lang_pred and score are results; leave such columns out of keep")
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_prob))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    carried = [F.col(c) for c in keep]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (languages, log_prior, log_prob), letters = shared.value, Letters()
        buckets = log_prob.shape[1]
        padded = np.hstack([log_prob, np.zeros((len(languages), 1), np.float32)])  # bucket -1 adds nothing
        names = np.array([*languages, UNDETERMINED], object)
        for batch in batches:
            best, sure = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            best[:] = len(languages)
            for first, run in text_chunks(batch.column("__text")) if languages else ():
                sums, seen = np.tile(log_prior, (len(run), 1)), np.zeros(len(run), np.int64)
                for bucket, at in grams(run, letters, buckets):
                    has = np.flatnonzero(np.diff(at) > 0)
                    if not len(has):
                        continue
                    bucket, cut = bucket[:at[-1]], at[:-1][has]
                    seen[has] += np.add.reduceat((bucket >= 0).astype(np.int64), cut)
                    for i in range(len(languages)):
                        sums[has, i] += np.add.reduceat(padded[i][bucket], cut, dtype=np.float64)
                top = sums.max(axis=1, keepdims=True)
                p = np.exp(sums - top)
                choice = np.where(seen > 0, sums.argmax(axis=1), len(languages))
                best[first:first + len(run)] = choice
                sure[first:first + len(run)] = np.where(seen > 0, (p / p.sum(axis=1, keepdims=True)).max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(sure)], names=[*keep, "lang_pred", "score"])

    return df.select(*carried, F.col(text_col).alias("__text")).mapInArrow(given_back(score), schema)


FOLDS = 5


def held_out(id_col) -> Column:
    """The fold that training leaves out: crc32 of the id as text, modulo 5, is 0 (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def crc_held_out(doc_id: int | None) -> bool:
    """``held_out`` in plain Python, for tests."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0
