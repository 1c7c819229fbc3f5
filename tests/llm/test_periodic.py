"""Periodic runs against a scan of every lag, on random words, planted repetitions and awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import periodic
from framewise.llm.queries import periodic_runs
from helpers import DOC_SCHEMA, awkward, sha, words


def brute_runs(w, least=12):
    """{(start, length): smallest period} by a scan of every lag."""
    out, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, 2 * q):
                out.setdefault((i, size), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def check(got, w, row_id):
    runs = brute_runs(w)
    assert [tuple(r) for r in got["runs"]] == runs and got["n_runs"] == len(runs) and got["n_words"] == len(w), row_id
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    assert tuple(got[c] for c in ("start", "length", "period", "exponent_milli")) == want, row_id
    assert got["collapsed_text"] == collapsed(w, runs), row_id


def texts():
    rng = random.Random(13)
    out = []
    for _ in range(150):  # few different words, so that runs meet and overlap
        out.append(" ".join(rng.choice("ab" if rng.random() < 0.3 else "abcd") for _ in range(rng.randint(0, 90))))
    for _ in range(40):
        unit = [f"u{rng.randint(0, 5)}" for _ in range(rng.randint(1, 30))]
        body = [f"n{i}" for i in range(rng.randint(0, 40))] + unit * rng.randint(2, 6) + unit[:rng.randint(0, len(unit))]
        out.append("\t".join(body + [f"m{i}" for i in range(rng.randint(0, 40))]))
    a, b = "a", "b"
    for _ in range(9):  # Fibonacci words: as many runs as can be
        a, b = a + " " + b, a
    out.append(a)
    t = "a"
    for _ in range(8):  # Thue-Morse words
        t += " " + t.translate(str.maketrans("ab", "ba"))
    return [*out, t, "x " * 700, "é ü ü é " * 6, "a b c d e f a b c d e f", "a b c d e f a b c d e"]


def test_runs_against_every_lag(spark, monkeypatch):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in periodic.collapse_runs(spark.createDataFrame(rows, DOC_SCHEMA), keep=["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        check(got[i], words(t), i)
    monkeypatch.setattr(periodic, "PLACES", 50)  # the places of one lag range after another
    for t in texts()[:40] + texts()[-5:]:
        w = np.array([int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in words(t)], np.uint64)
        assert periodic.find_runs(w, np.array([0, len(w)])).get(0, []) == brute_runs(words(t))


def test_runs_awkward(spark):
    df, rows = awkward(spark)
    got = periodic.collapse_runs(df).collect()
    assert len(got) == len(rows) and got[0]["rk"] == "clash"
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    for r in rows:
        w = words(r[1])
        if len(w) < 1000:
            check(by[r[0], len(w)], w, r[0])
    long = by[3, 30_000]  # its words are numbered modulo 997 and 13
    assert [tuple(x) for x in long["runs"]] == [(0, 30_000, 997 * 13)]
    assert periodic.collapse_runs(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse_runs(df.withColumnRenamed("size", "period"))


def test_long_texts_stay_linear():
    for w in (np.zeros(300_000, np.uint64), np.arange(300_000, dtype=np.uint64) % 5003):
        runs = periodic.find_runs(w, np.array([0, len(w)]))[0]
        assert runs == [(0, len(w), 1 if not w.any() else 5003)]


def test_query_plants_and_finds(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == docs.keys()
    for i, w in docs.items():
        w = planted(i, w)
        if len(w) > 1500:
            continue
        runs = brute_runs(w)
        assert got[i]["n_runs"] == len(runs)
        assert got[i]["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert got[i]["collapsed_sha256"] == sha(collapsed(w, runs))
    assert sum(r["n_runs"] > 0 for r in got.values()) > 5
    assert periodic_runs(spark, sf_dir).where(F.col("start").isNull() != (F.col("n_runs") == 0)).count() == 0
