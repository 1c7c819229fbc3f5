"""Brute-force versions and awkward tables for the tests of the training-data operators."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n=5):
    w = words((text or "").translate(ASCII_LOWER))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def components(docs, percent=75):
    """doc_id -> smallest id reachable by links; ``docs``: (doc_id, text)."""
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def kept_words(docs, window=35):
    """Words of each text that no repeated window covers, by position in ``docs``."""
    split = [words(t) for t in docs]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        stay = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                stay[i:i + window] = [False] * window
        out.append([x for x, s in zip(w, stay, strict=True) if s])
    return out


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)


def strip_lines(texts, least):
    """(lines, kept lines) of each text."""
    split = [(t or "").split("\n") for t in texts]
    docs = Counter(k for ls in split for k in {line_key(x) for x in ls} if k)
    return [(ls, [x for x in ls if docs[line_key(x)] < least]) for ls in split]


def awkward(spark, n_copies=12):
    """NULLs in every column, empty, blank and long texts, ties, repeated rows, a column with a clashing name."""
    long_text = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(0, None, "en", "a", 0), (1, "", "en", None, None), (2, " \t\n ", None, "b", 3), (None, "Ohne Nummer, aber mit Text.", "de", "b", 5),
            (3, long_text, "en", "a", len(long_text)), (4, base, "en", "a", 1), (4, base, "en", "a", 1), (5, "one", None, None, 3), (6, "one", "en", "c", 3)]
    rows += [(10 + i, f"{base}\nAll rights reserved.", "en", "a", 9) for i in range(n_copies)]
    rows += [(40 + i, " all Rights reserved.\t\n" + " ".join(f"d{i}e{k}" for k in range(40)), "fr", "c", 9) for i in range(n_copies)]
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], DOC_SCHEMA + ", rk string, size int"), rows
