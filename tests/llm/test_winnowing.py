"""Winnowing against a plain version, its match guarantee, and edited copies of awkward tables."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from framewise.llm import winnowing as w
from framewise.llm.queries import fingerprints
from helpers import DOC_SCHEMA, awkward, sha

TOKEN = re.compile("[⺀-\U0010ffff]|[^\x20\x09-\x0d⺀-\U0010ffff]+")


def tokens(text):
    return TOKEN.findall(text or "")


def polynomial(codes, base):
    h = 0
    for c in codes:
        h = (h * base + c) % w.MODULUS
    return h


def plain(text, gram=w.GRAM, window=w.WINDOW):
    codes = [zlib.crc32(t.encode()) >> 4 for t in tokens(text)]
    if not codes:
        return []
    if len(codes) < gram:
        codes += [0] * gram
        grams = [codes[:gram]]
    else:
        grams = [codes[i:i + gram] for i in range(len(codes) - gram + 1)]
    h = [polynomial(g, w.BASE) for g in grams]
    out = set()
    for lo in range(max(1, len(h) - window + 1)):
        span = range(lo, min(len(h), lo + window))
        out.add(min(span, key=lambda i: (h[i], -i)))
    return [(i, h[i] * 2 ** 31 + polynomial(grams[i], w.SECOND_BASE)) for i in sorted(out)]


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_rows(docs):
    """``docs``: (id, text) in order, without repeats."""
    out = {}
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        t, after = t or "", after or ""
        q = len(t) // 4
        out[i, t] = (len(t), t[:len(t) - q] + after[:q], after)
    return out


def texts():
    rng = random.Random(11)
    out = [None, "", " \t\n", "one", "a b c d", "a b c d e", "x " * 60, "漢字かな混じり文の長い本文です。" * 4 + " und Wörter dazwischen 𝒳𝒴 ok"]
    return out + [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80))) for _ in range(60)]


def test_picks_against_plain(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "i int, text string")
    for gram, window in ((5, 8), (1, 1), (2, 3), (8, 16), (15, 4)):
        got = df.select("i", w.fingerprint(F.col("text"), gram, window).alias("f")).collect()
        for r in got:
            assert [tuple(x) for x in r["f"]] == plain(texts()[r["i"]], gram, window), (gram, window, r["i"])
    with pytest.raises(ValueError):
        w.fingerprint(F.col("text"), 16)


def test_shared_passages_are_found_where_they_stand(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(w.GRAM + w.WINDOW - 1)]
    rows = []
    for i in range(30):
        at = rng.randint(0, 50)
        rows.append((i, at, " ".join([word() for _ in range(at)] + passage + [word() for _ in range(rng.randint(0, 50))])))
    got = {r["i"]: r for r in spark.createDataFrame(rows, "i int, at int, text string").select("i", "at", w.fingerprint(F.col("text")).alias("f")).collect()}
    for i in range(1, 30):
        a, b = got[0], got[i]
        at = {x["hash"]: x["pos"] for x in a["f"]}
        shared = [(at[x["hash"]] - a["at"], x["pos"] - b["at"]) for x in b["f"] if x["hash"] in at]
        assert shared and all(p == q for p, q in shared)


def test_edited_copies_awkward(spark):
    df, rows = awkward(spark)
    got = w.edited_likeness(df).collect()
    assert len(got) == len(rows)
    assert sum(r["doc_id"] is None for r in got) == 1
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    ids = sorted({r[0] for r in rows if r[0] is not None}) + [None]
    want = edited_rows([(i, next(r[1] for r in rows if r[0] == i)) for i in ids])
    for (i, t), (n, edited, after) in want.items():
        for r in by_id[i]:  # id 4 stands on two equal rows
            assert (r["n_chars"], r["edited"]) == (n, edited)
            assert r["near_edited"] == pytest.approx(jaccard(plain(t), plain(edited))) and r["near_next"] == pytest.approx(jaccard(plain(t), plain(after)))
    assert w.edited_likeness(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    one = w.edited_likeness(spark.createDataFrame([(1, "a b c d", "x")], "doc_id long, text string, k string")).collect()
    assert [(r["edited"], r["near_next"]) for r in one] == [("a b c a", 1.0)]


def test_ids_on_several_texts(spark):
    rows = [(1, "a a a a"), (1, "b b b b"), (2, "c c c c")]
    got = sorted(r["edited"] for r in w.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got in (["a a a b", "b b b c", "c c c a"], ["a a a c", "b b b a", "c c c b"])


def test_query_on_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = edited_rows(docs)
    got = {r["doc_id"]: r for r in fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for (i, t), (n, edited, after) in want.items():
        r = got[i]
        assert r["n_chars"] == n and r["edited_sha256"] == sha(edited)
        assert r["fingerprint"] == ",".join(f"{p}:{h}" for p, h in plain(t)) and r["edited_fingerprint"] == ",".join(f"{p}:{h}" for p, h in plain(edited))
        assert r["near_edited"] == pytest.approx(jaccard(plain(t), plain(edited))) and r["near_next"] == pytest.approx(jaccard(plain(t), plain(after)))
