"""Periodic runs of words: found by recursive frequency splitting and a lag scan, and collapsed.

A run is a stretch of consecutive words with smallest period q, of at least ``MIN_WORDS`` words
and ``MIN_PERIODS`` * q words, that no neighbouring word extends. Every word of a run comes
up once a period, so at least ``MIN_PERIODS`` times: a word that occurs more rarely in a
segment of a document lies in no run and splits it. Splitting counts again in the smaller segments
until nothing changes; what is left of most texts is nothing. All segments of a chunk of
documents are split at once.

The lag scan of a surviving segment looks, for each lag q, at every q-th word only: a run of
period q holds q consecutive words that are equal q words on, so it meets one of those
places. There it is extended both ways by binary search over prefix hashes, so the scan takes
about m log(m) places for m words, not m * m / 2, and memory stays linear in the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from framewise.llm.arrow_text import Powers, chunks, is_word_byte, text_bytes, word_hashes, word_spans
from framewise.llm.text import require

MIN_WORDS = 12
MIN_PERIODS = 2
#: Places of the lag scan that are looked at in one go.
PLACES = 1 << 20
#: Moduli of the prefix hashes (primes below 2**31) and their bases: together 62 bits.
_MODULI = ((2147483647, 1664525), (2147483629, 22695477))
RESULTS = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, " \
          "runs array<struct<start:long,length:long,period:long>>, collapsed_text string"


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment) of all words of segments that begin at ``starts``."""
    segment = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[segment], segment


def split_by_frequency(words: np.ndarray, first: np.ndarray, min_words: int, min_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the segments in which every word occurs at least ``min_periods`` times; ``first``: the
    documents' first words (one more entry)."""
    starts, sizes = first[:-1], np.diff(first)
    done = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while True:
        long = sizes >= min_words
        starts, sizes = starts[long], sizes[long]
        if not len(starts):
            return done
        places, segment = _spread(starts, sizes)
        order = np.lexsort((words[places], segment))
        w, s = words[places][order], segment[order]
        head = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (s[1:] != s[:-1])]))
        times = np.diff([*head, len(w)])
        rare = np.zeros(len(w), bool)
        rare[order] = np.repeat(times < min_periods, times)
        stable = np.ones(len(starts), bool)
        stable[segment[rare]] = False
        done = np.concatenate([done[0], starts[stable]]), np.concatenate([done[1], sizes[stable]])
        # stretches of the other segments' words that are not rare
        live = ~rare & ~stable[segment]
        begin = live & np.concatenate([[True], ~live[:-1] | (segment[1:] != segment[:-1])])
        end = live & np.concatenate([~live[1:] | (segment[1:] != segment[:-1]), [True]])
        starts, sizes = places[begin], places[end] - places[begin] + 1


class _Stretches:
    """Equality of stretches of a segment by prefix hashes."""

    def __init__(self, words: np.ndarray):
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
        self.n, self.sums, self.powers = len(codes), [], []
        for p, base in _MODULI:
            power = np.ones(self.n + 1, np.int64)
            done = 1
            while done <= self.n:  # doubling: base ** (done + i) = base ** done * base ** i
                more = min(done, self.n + 1 - done)
                power[done:done + more] = power[:more] * (int(power[done - 1]) * base % p) % p
                done += more
            total = np.zeros(self.n + 1, np.int64)
            np.cumsum(codes * power[:-1] % p, out=total[1:])
            self.sums.append(total % p)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
        out = np.ones(len(a), bool)
        for (p, _), total, power in zip(_MODULI, self.sums, self.powers, strict=True):
            out &= (total[a + size] - total[a]) % p * power[b - a] % p == (total[b + size] - total[b]) % p
        return out

    def extend(self, a: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last word of the longest stretches around ``a`` that are equal ``lag`` words on."""
        lo, hi = a.copy(), a.copy()
        for step in (1 << k for k in reversed(range(int(self.n).bit_length()))):
            on = np.flatnonzero(hi + lag + step <= self.n)
            on = on[self.same(hi[on], hi[on] + lag[on], step)]
            hi[on] += step
            on = np.flatnonzero(lo >= step)
            on = on[self.same(lo[on] - step, lo[on] - step + lag[on], step)]
            lo[on] -= step
        return lo, hi


def lag_scan(words: np.ndarray, min_words: int, min_periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment, by start, then period."""
    n, found, stretches = len(words), [], None
    lags = np.arange(1, n // min_periods + 1)
    places = (n - 1) // lags  # c = 0, q, 2q, ... with c + q < n
    ends = np.cumsum(places)
    lo = 0
    while lo < len(lags):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PLACES, "right")))
        lag = np.repeat(lags[lo:hi], places[lo:hi])
        at = _spread(np.zeros(hi - lo, np.int64), places[lo:hi])[0] * lag
        met = words[at] == words[at + lag]
        at, lag = at[met], lag[met]
        lo = hi
        if not len(at):
            continue
        stretches = stretches or _Stretches(words)
        start, end = stretches.extend(at, lag)
        size = end + lag - start
        fine = (size >= min_words) & (size >= min_periods * lag)
        if fine.any():
            found.append(np.unique(np.stack([start[fine], size[fine], lag[fine]], axis=1), axis=0))
    if not found:
        return []
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # the same stretch at a multiple of its period is no run of its own
    smallest = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    rows = rows[smallest]
    return [tuple(map(int, r)) for r in rows[np.lexsort((rows[:, 2], rows[:, 0]))]]


def find_runs(words: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each document that has any, words numbered from the document's first."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    starts, sizes = split_by_frequency(words, first, min_words, min_periods)
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        runs = lag_scan(words[start:start + size], min_words, min_periods)
        if runs:
            doc = int(np.searchsorted(first, start, "right")) - 1
            out.setdefault(doc, []).extend((start - int(first[doc]) + s, n, q) for s, n, q in runs)
    for runs in out.values():
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _join_words(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each document joined by one space."""
    edge = np.zeros(len(data) + 1, np.int32)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    stay = np.cumsum(edge[:-1]) > 0
    place = np.flatnonzero(kept)
    doc = np.searchsorted(first, place, "right")
    between = place[:-1][doc[1:] == doc[:-1]]  # another kept word of the document follows
    data = data.copy()
    data[ends[between]] = 0x20
    stay[ends[between]] = True
    ends_of = np.concatenate([[0], np.cumsum(stay)])[offsets]
    wide = ends_of[-1] > 0x7FFFFFFF
    return (pa.LargeStringArray if wide else pa.StringArray).from_buffers(
        len(offsets) - 1, pa.py_buffer(ends_of.astype(np.int64 if wide else np.int32)), pa.py_buffer(data[stay]))


def collapse_runs(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """The kept columns (default: all but the text), the longest run, all ``runs`` and ``collapsed_text`` of each row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``start``, ``length``, ``period`` and
    ``exponent_milli`` = floor(1000 * length / period) are those of the longest run, ties to the smallest start,
    then period; NULL without a run. ``runs`` are sorted by start, then period. ``collapsed_text`` drops each
    word that some run holds after its first period, and joins the others by one space. NULL and empty
    texts have no words, no runs and an empty ``collapsed_text``. Rows stay apart, repeated ones too; an empty
    table gives an empty result. Kept columns must not be named like results."""
    keep = [c for c in df.columns if c != text_col] if keep is None else keep
    require(df, text_col, *keep)
    if min_periods < 2 or min_words < 1:
        raise ValueError("min_periods must be 2 or more, min_words 1 or more")
    results = T.StructType.fromDDL(RESULTS)
    clash = {f.name for f in results} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results; rename or leave them out of keep")
    schema = T.StructType([df.schema[c] for c in keep] + results.fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, inside = Powers(), is_word_byte()
        for b in batches:
            for lo, hi, data, offsets in chunks(*text_bytes(b.column(b.num_columns - 1))):
                starts, ends, first = word_spans(data, offsets, inside)
                found = find_runs(word_hashes(data, starts, ends, powers), first, min_words, min_periods)
                change = np.zeros(len(starts) + 1, np.int32)
                best = np.zeros((hi - lo, 4), np.int64)
                for doc, runs in found.items():
                    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
                    best[doc] = s, n, q, 1000 * n // q
                    for s, n, q in runs:
                        change[first[doc] + s + q] += 1
                        change[first[doc] + s + n] -= 1
                kept = np.cumsum(change[:-1]) == 0
                none = np.ones(hi - lo, bool)
                none[list(found)] = False
                lists = [[{"start": s, "length": n, "period": q} for s, n, q in found.get(d, ())] for d in range(hi - lo)]
                columns = [b.column(i).slice(lo, hi - lo) for i in range(b.num_columns - 1)]
                columns += [pa.array(np.diff(first).astype(np.int64)), pa.array([len(x) for x in lists], pa.int64())]
                columns += [pa.array(best[:, k], mask=none) for k in range(4)]
                columns += [pa.array(lists, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))),
                            _join_words(data, offsets, starts, ends, first, kept).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*keep, text_col).mapInArrow(read, schema)
