"""Language ID against a plain multinomial naive Bayes, counted n-gram by n-gram."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framewise.llm import language

ALL = (1 << 64) - 1


def _bucket(window: list[int], buckets: int) -> int:
    h = 0
    for c in window:
        h = (h * 0x100000001B3 + c) & ALL
    h = (h + len(window)) & ALL
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & ALL
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & ALL
    return (h ^ (h >> 31)) % buckets


def _grams(text: str | None, buckets: int) -> Counter:
    """One separator before the text and two after it; n-grams without a letter do not count."""
    codes = [0, *[ord(c) if c.isalpha() else 0 for c in (text or "").lower()], 0, 0]
    found = Counter()
    for n in (1, 2, 3):
        for i in range(len(codes) - 2):
            if any(codes[i:i + n]):
                found[_bucket(codes[i:i + n], buckets)] += 1
    return found


def _plain(train: list, texts: list, buckets: int) -> list:
    counts, priors = {}, Counter()
    for text, lang in train:
        if text is not None and lang is not None:
            priors[lang] += 1
            counts.setdefault(lang, Counter()).update(_grams(text, buckets))
    out = []
    for text in texts:
        grams = _grams(text, buckets)
        if not grams:
            out.append(("und", 0.0))
            continue
        sums = {}
        for lang in sorted(priors):
            total = sum(counts[lang].values()) + buckets
            sums[lang] = math.log(priors[lang] / sum(priors.values())) + sum(
                k * math.log((counts[lang][b] + 1) / total) for b, k in grams.items())
        best = max(sums, key=lambda v: (sums[v], [-ord(c) for c in v]))
        out.append((best, 1 / sum(math.exp(s - sums[best]) for s in sums.values())))
    return out


@pytest.mark.parametrize("buckets", [64, 4096])
def test_labels_and_scores_of_a_plain_naive_bayes(spark, monkeypatch, buckets):
    monkeypatch.setattr(language, "CHUNK_CHARS", 200)
    rng = random.Random(3)
    letters = {"aa": "abcde fg", "bb": "defgh, ij", "cc": "ghéß 1ijk", "dd": "абвг de"}
    rows = []
    for i in range(240):
        lang = rng.choice(["aa", "aa", "bb", "cc", "dd"])
        rows.append((i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(0, 40))), lang if i % 11 else None))
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "12 34", "cc"), (303, "İstanbul DE", "dd"), (304, "e" * 900, "bb"), (305, "x", None), (305, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language.train(df.where(F.col("doc_id") % 3 != 0), buckets=buckets)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(df.drop("lang"), model).collect()}
    want = _plain([(t, v) for i, t, v in rows if i % 3], [t for _, t, _ in rows], buckets)
    for (i, _, _), (lang, score) in zip(rows, want, strict=True):
        assert got[i][0] == lang, i
        assert got[i][1] == pytest.approx(score, abs=2e-3), i
