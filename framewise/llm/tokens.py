"""Token counts at every prefix of a text, for a byte-level BPE vocabulary.

``prefix_counts(text)[i]`` is the number of tokens of the first ``i`` code points, exactly
as the tokenizer's library encodes that prefix on its own, so truncation and budget
questions are answered by lookups.

The table comes from dynamic programming over the pieces that the tokenizer's pattern
cuts. In a piece, the encoding of a prefix ends with the one token that is the last token
of some earlier prefix's encoding extended by itself: a token ``t`` that ends at ``i`` is
right if the last token of the prefix before it and ``t``, side by side, encode to just
those two. So each step looks at the tokens that end at ``i`` and adds 1 to a count that
is stored already. Nearly every prefix cuts the text into the same pieces, the last one
shortened; three places differ and are handled: runs of white space, contractions, and
special strings.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.text import require

# Fixed values of the public byte-level format: the pattern of pieces and the printable stand-ins of bytes.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
MEMO = 600_000  # pieces, and pairs of tokens, remembered by a task; beyond, it starts anew


def latin_pieces() -> re.Pattern:
    """The same pattern for texts of the first 256 code points, whose letters, numbers and white space are listed."""
    of = lambda kinds: "".join(re.escape(c) for c in map(chr, range(256)) if unicodedata.category(c)[0] in kinds)
    space = "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(r"\s", c))
    return re.compile(PIECES.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{of('L')}{of('N')}]").replace(r"\p{L}", f"[{of('L')}]")
                      .replace(r"\p{N}", f"[{of('N')}]").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))


def stand_ins() -> dict[str, int]:
    """Character of the vocabulary file -> byte."""
    rest = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and special strings of a tokenizer file (byte-level BPE, no normalizer)."""

    def __init__(self, file: str):
        d = json.loads(file)
        byte = stand_ins()
        raw = lambda s: bytes(byte[c] for c in s)
        self.special = [t["content"] for t in d["added_tokens"]]
        self.ids = {raw(s): i for s, i in d["model"]["vocab"].items() if s not in self.special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.begun = {t[:n] for t in self.ids for n in range(len(t) + 1)}


class PrefixCounter:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.formed = {a + b: i for (a, b), i in reversed(vocabulary.ranks.items())}
        self.halves = {a + b: (a, b) for a, b in reversed(vocabulary.ranks)}
        self.pieces, self.latin = regex.compile(PIECES), latin_pieces()
        self.gaps = regex.compile(r"\s{2,}+")
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None
        self.pairs: dict[int, bool] = {}  # by the ids of both tokens, in one number
        self.memo: dict[str, bytes] = {}

    def follows(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side encode to themselves: merges are undone, the latest first,
        and no merge across the border may have come before one that was undone."""
        if len(self.pairs) >= MEMO:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self._follows(self.v.tokens[a], self.v.tokens[b])
        return known

    def _follows(self, a: bytes, b: bytes) -> bool:
        ranks, formed, before = self.v.ranks, self.formed, 1 << 60
        while True:
            if ranks.get((a, b), before) < before:
                return False
            made_a, made_b = formed.get(a, -1), formed.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:  # of equal ranks the left one is merged first
                before, a = made_a, self.halves[a][1]
            else:
                before, b = made_b + 1, self.halves[b][0]

    def steps(self, piece: str) -> bytes:
        """What each code point of a piece adds to the count (it may be negative), as 16-bit numbers."""
        got = self.memo.get(piece)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            counts = self.counts(piece)
            if piece in ("'re", "'ve", "'ll"):
                counts[1:3] = 1, 2  # cut short it is no contraction: an apostrophe, then a letter
            got = self.memo[piece] = array("h", map(sub, counts[1:], counts)).tobytes()
        return got

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, by code points, from the empty one to the whole."""
        data = piece.encode("utf-8", "surrogatepass")
        ids, begun, pairs = self.v.ids, self.v.begun, self.pairs
        last, count, lo = [-1], [0], 0
        for i in range(1, len(data) + 1):
            while data[lo:i] not in begun:  # no token that ends at i or later begins before lo
                lo += 1
            for j in range(lo, i):
                t = ids.get(data[j:i])
                if t is not None:
                    if j:
                        right = pairs.get(last[j] << 32 | t)
                        if not (self.follows(last[j], t) if right is None else right):
                            continue
                    last.append(t)
                    count.append(count[j] + 1)
                    break
            else:
                raise ValueError(f"byte {data[i - 1]} is no token of this vocabulary")
        if len(data) == len(piece):
            return count
        return [0] + [count[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pieces.findall(text)
        return self.latin.findall(text)

    def plain(self, text: str) -> np.ndarray:
        """Tokens of each prefix of a text without special strings, from the empty one on."""
        known = self.memo.get
        steps = np.frombuffer(b"".join([known(p) or self.steps(p) for p in self.cut(text)]), np.int16)
        out = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
        for gap in self.gaps.finditer(text):
            if gap.end() < len(text):
                # the last space of a gap belongs to what follows; a prefix that ends with it has the gap as one piece
                out[gap.end()] = out[gap.start()] + np.frombuffer(known(gap[0]) or self.steps(gap[0]), np.int16).sum()
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... code points of a text."""
        parts, base, at = [], 0, 0
        for m in self.special.finditer(text) if self.special else ():
            counts = base + self.plain(text[at:m.end() - 1])  # cut short, the string is ordinary text
            parts.append(counts)
            base, at = int(counts[m.start() - at]) + 1, m.end()
        parts.append(base + self.plain(text[at:]))
        return np.concatenate(parts)


def longest_prefix(counts: np.ndarray, limit: int) -> int:
    """The longest prefix of at most ``limit`` tokens. Counts may fall from one prefix to the next, so all are asked."""
    return int(np.flatnonzero(counts <= limit)[-1])


def token_prefixes(df: DataFrame, tokenizer: str, text_col: str = "text", keep: list[str] | None = None,
                   limits: Sequence[int] = ()) -> DataFrame:
    """The kept columns (default: all), ``n_bytes``, ``n_tokens`` and ``prefix_tokens``: 32-bit little-endian
    counts at every prefix, from the empty one to the whole text. Limits that are known beforehand are
    looked up while the table is at hand: ``chars_within_<limit>``, as ``fits`` gives it later.

    ``tokenizer`` is the content of the tokenizer's file (2 MB, sent to the executors once). NULL is the
    empty text. Repeated rows keep their rows; an empty table gives an empty result. A kept column named
    like a result is refused."""
    keep = df.columns if keep is None else keep
    require(df, text_col, *keep)
    results = ["n_bytes", "n_tokens", *[f"chars_within_{n}" for n in limits], "prefix_tokens"]
    if set(results) & set(keep):
        raise ValueError(f"{', '.join(results)} are results; leave such columns out of keep")
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in results[:-1]],
                           T.StructField("prefix_tokens", T.BinaryType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(Vocabulary(shared.value))
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):  # what goes out at once stays small
                batch = whole.slice(lo, 256)
                texts = [t or "" for t in batch.column("__text").to_pylist()]
                tables = [counter.prefix_counts(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                     pa.array([int(c[-1]) for c in tables], pa.int64()),
                     *[pa.array([longest_prefix(c, n) for c in tables], pa.int64()) for n in limits],
                     pa.array([c.astype("<i4").tobytes() for c in tables], pa.binary())],
                    names=[*keep, *results])

    return df.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text")).mapInArrow(count, schema)


def fits(limit: int):
    """Column function of ``prefix_tokens``: the longest prefix, in code points, of at most ``limit`` tokens."""
    @F.pandas_udf(T.LongType())
    def longest(tables):
        return tables.map(lambda b: longest_prefix(np.frombuffer(b, "<i4"), limit))
    return longest


def tokens_at(prefix_tokens: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points (NULL beyond the text): one lookup in the stored table."""
    at = F.substring(prefix_tokens, chars * 4 + 1, F.lit(4))
    return F.when(F.octet_length(at) == 4, F.conv(F.hex(F.reverse(at)), 16, 10).cast("long"))
