"""N-gram Jaccard join: which documents share most of their word 5-grams.

Documents are sets of hashed 5-grams ("shingles"). All sets are ordered rare-first, by the
number of documents that hold a shingle (counted up to ``COMMON``) and then by hash. Two sets
that reach the similarity share a shingle within their prefixes, the first ``n - ceil(s n) + 1``;
so a set whose shingles that occur nowhere else fill the prefix links with nothing, and only
what is left of the others is joined, on prefix shingles, with length and positional filters.
Each candidate pair is verified once; a suffix filter comes before the exact overlap.

Counting moves every shingle once, packed: 6 bytes of hash and 2 bytes for the document
within its block, one row for each block and part of the hash range. A shingle that fills
a block (``COMMON`` documents or more) is known to be common there and then, so it goes on as one
count, and its documents' entries travel by block: no part holds a hot shingle as a whole.

Equal sets are joined as one. Groups of near copies are not expanded into pairs: in each
round a prefix shingle's sets are compared with one pivot only; sets that the links found so
far put into one component need no further comparison. After ``PIVOT_ROUNDS`` all pairs that
share a prefix shingle and still lie in different components are compared, which makes the
result exact. For shingles of few sets a join lists them; the sets of other shingles meet
in blocks, where length, positional and suffix filter are applied to whole arrays, and only
pairs that pass all three come out.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.arrow_text import Powers, chunks, given_back, gram_hashes, is_word_byte, lower, mix64, text_bytes, word_hashes, word_spans
from framewise.llm.components import components
from framewise.llm.text import require, row_key
from framewise.session import cut_lineage

WORDS = 5
PERCENT = 75
COMMON = 16
PART_BYTES = 8 << 20  # of text for each part of the hash range
PIVOT_ROUNDS = 2
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 1 << 20
SMALL_GROUP = 64
MEMBER_BLOCK = 512
PARTNERS = 512
RANGES = 64


def pack(tokens: np.ndarray) -> bytes:
    """48-bit numbers, 6 bytes each."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of all word n-grams; a document of fewer words has its whole sequence as one."""
    grams, doc = gram_hashes(words, first, n)
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        whole = np.array([mix64(np.array([_sequence(words[first[d]:first[d + 1]])], np.uint64))[0] for d in short], np.uint64)
        grams, doc = np.concatenate([grams, whole]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        grams, doc = grams[order], doc[order]
    return grams, doc


def _sequence(words: np.ndarray) -> int:
    out = 0x9E3779B97F4A7C15 + len(words)
    for w in words.tolist():
        out = (out * 0x100000001B3 ^ w) & 0xFFFFFFFFFFFFFFFF
    return out


PACKED = "part int, block long, n_common int, tokens binary, docs binary, classes binary, ids array<{id}>, rks array<long>, sizes array<int>, low array<long>, high array<long>"


def _packed(docs: DataFrame, id_col: str, text_col: str, n: int, parts: int) -> DataFrame:
    """Blocks of documents: per part of the hash range their shingles, the common ones by block, and one
    row about the documents themselves."""
    kind = docs.schema[id_col].dataType.simpleString()
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, inside, block = Powers(), is_word_byte(), (TaskContext.get().partitionId() << 32) - 1
        for whole in batches:
            id_type = whole.schema.field("doc_id").type
            schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n_common", pa.int32()), ("tokens", pa.binary()), ("docs", pa.binary()),
                                ("classes", pa.binary()), ("ids", pa.list_(id_type)), ("rks", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                                ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))])
            for top in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(top, BLOCK_ROWS)
                for lo, hi, data, offsets in chunks(*text_bytes(batch.column("text")), BLOCK_BYTES):
                    block += 1
                    starts, ends, first = word_spans(data, offsets, inside)
                    grams, doc = shingles(word_hashes(lower(data), starts, ends, powers), first, n)
                    order = np.argsort(grams, kind="stable")  # by hash, then document
                    h, d = grams[order], doc[order]
                    once = np.ones(len(h), bool)
                    once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                    h, d = h[once], d[once]
                    sizes = np.bincount(d, minlength=hi - lo)
                    kept = np.zeros(len(grams), bool)
                    kept[order[once]] = True
                    low, high = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                    if len(grams):
                        have = np.flatnonzero(sizes)
                        edge = np.searchsorted(doc, have)
                        low[have] = np.add.reduceat(np.where(kept, mix64(grams), np.uint64(0)), edge)
                        high[have] = np.bitwise_xor.reduceat(np.where(kept, mix64(grams ^ np.uint64(0x5851F42D4C957F2D)), np.uint64(0)), edge)
                    rows: list[dict] = [{"part": block % parts, "block": block, "n_common": 0,
                                         "ids": batch.column("doc_id").slice(lo, hi - lo).to_pylist(),
                                         "rks": batch.column("rk").slice(lo, hi - lo).to_pylist(), "sizes": sizes.tolist(),
                                         "low": low.view(np.int64).tolist(), "high": high.view(np.int64).tolist()}]
                    h >>= np.uint64(16)
                    d = d.astype("<u2")
                    new = np.ones(len(h), bool)
                    new[1:] = h[1:] != h[:-1]
                    at = np.flatnonzero(new)
                    count = np.diff([*at, len(h)])
                    common = np.repeat(count >= COMMON, count)
                    if common.any():
                        rows.append({"part": block % parts, "block": block, "n_common": 0, "tokens": pack(h[common]), "docs": d[common].tobytes(),
                                     "classes": np.full(int(common.sum()), COMMON, np.uint8).tobytes()})
                    told = h[at][count >= COMMON]  # these are sent on as one count each
                    rest, rest_doc = h[~common], d[~common]
                    owner = lambda x: ((x >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                    in_rest, in_told = owner(rest), owner(told)
                    here = np.union1d(in_rest, in_told)  # only the parts that occur, however many there are
                    spans = [np.searchsorted(x, here, side) for x in (in_rest, in_told) for side in ("left", "right")]
                    for p, a, b, x, y in zip(here.tolist(), *(e.tolist() for e in spans), strict=True):
                        rows.append({"part": p, "block": block, "n_common": y - x, "tokens": pack(np.concatenate([told[x:y], rest[a:b]])),
                                     "docs": rest_doc[a:b].tobytes()})
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("rk"), F.col(text_col).alias("text"))
    return rows.mapInArrow(given_back(read), PACKED.format(id=kind))


def _count_part(part: pa.Table) -> pa.Table:
    """Gives each shingle its class, the number of its documents up to ``COMMON``, and drops those of one document."""
    ready = part.filter(pc.or_(part["ids"].is_valid(), part["classes"].is_valid()))
    todo = part.filter(pc.and_(part["ids"].is_null(), part["classes"].is_null()))
    blocks, n_common = todo["block"].to_numpy(), todo["n_common"].to_numpy()
    tokens = [unpack(x) for x in todo["tokens"].to_pylist()]
    docs = [np.frombuffer(x, "<u2") for x in todo["docs"].to_pylist()]
    out = []
    if tokens:
        size = [len(t) for t in tokens]
        flat, row = np.concatenate(tokens), np.repeat(np.arange(len(tokens), dtype=np.int32), size)
        within = np.concatenate([np.arange(s, dtype=np.int32) for s in size])
        weight = np.where(within < n_common[row], COMMON, 1).astype(np.int32)
        local = np.concatenate([np.concatenate([np.zeros(c, "<u2"), d]) for c, d in zip(n_common, docs, strict=True)])
        del tokens, docs, within, todo
        order = np.argsort(flat, kind="stable")
        flat, weight, row, local = flat[order], weight[order], row[order], local[order]
        del order
        at = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        total = np.minimum(np.add.reduceat(weight, at), COMMON)
        cls = np.repeat(total, np.diff([*at, len(flat)]))
        keep = (weight == 1) & (cls >= 2)
        flat, cls, row, local = flat[keep], cls[keep].astype(np.uint8), row[keep], local[keep]
        by_row = np.argsort(row, kind="stable")
        flat, cls, row, local = flat[by_row], cls[by_row], row[by_row], local[by_row]
        cut = np.searchsorted(row, np.arange(len(size) + 1))
        for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if b > a:
                out.append({"part": 0, "block": int(blocks[i]), "n_common": 0, "tokens": pack(flat[a:b]), "docs": local[a:b].tobytes(), "classes": cls[a:b].tobytes()})
    return pa.concat_tables([ready, pa.Table.from_pylist(out, schema=part.schema)])


def least_shared(n: np.ndarray | int, percent: int):
    """Fewest shingles that a set of n must share with any set it links with: ceil(percent n / 100)."""
    return -(-n * percent // 100)


def _sets_of_block(percent: int):
    def assemble(rows: pa.Table) -> pa.Table:
        """One row per document; ``tokens``: what others hold too, rare-first, if that can reach the similarity."""
        about = rows.filter(rows["ids"].is_valid()).to_pylist()[0]
        parts = rows.filter(rows["ids"].is_null())
        tokens = [unpack(x) for x in parts["tokens"].to_pylist()] or [np.zeros(0, np.uint64)]
        flat = np.concatenate(tokens)
        docs = np.frombuffer(b"".join(parts["docs"].to_pylist()), "<u2")
        cls = np.frombuffer(b"".join(parts["classes"].to_pylist()), np.uint8)
        order = np.lexsort((flat, cls, docs))
        flat, docs = flat[order], docs[order]
        cut = np.searchsorted(docs, np.arange(len(about["sizes"]) + 1))
        held = [pack(flat[a:b]) if n and b - a >= least_shared(n, percent) else None
                for n, a, b in zip(about["sizes"], cut[:-1], cut[1:], strict=True)]
        kind = rows.schema.field("ids").type.value_type
        return pa.table({"doc_id": pa.array(about["ids"], kind), "rk": pa.array(about["rks"], pa.int64()), "n": pa.array(about["sizes"], pa.int32()),
                         "low": pa.array(about["low"], pa.int64()), "high": pa.array(about["high"], pa.int64()), "tokens": pa.array(held, pa.binary())})
    return assemble


def release(df: DataFrame) -> None:
    """Lets Spark's cleaner drop shuffle files that nothing refers to any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def document_sets(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(``doc_id``, ``rk``, ``n``, ``low``, ``high``, ``tokens``), one row per row of ``docs``. ``low`` and
    ``high`` are a 128-bit hash of the set; ``tokens`` is NULL where the set cannot link."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    kind = docs.schema[id_col].dataType.simpleString()
    packed = _packed(docs, id_col, text_col, words, parts)
    counted = packed.groupBy("part").applyInArrow(_count_part, packed.schema)
    sets = counted.groupBy("block").applyInArrow(_sets_of_block(percent), f"doc_id {kind}, rk long, n int, low long, high long, tokens binary")
    done = cut_lineage(sets, "shingle-sets")
    release(done)
    return done


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """(``token``, ``rep``, ``n``, ``pos``): prefix shingles that other documents hold too, with their places."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, n = b.column("rep").to_numpy(), b.column("n").to_numpy().astype(np.int64)
            held = [unpack(x) for x in b.column("tokens").to_pylist()]
            alone = n - np.array([len(x) for x in held], np.int64)
            prefix = n - least_shared(n, percent) + 1 - alone
            held = [x[:p] for x, p in zip(held, prefix, strict=True)]
            size = np.array([len(x) for x in held], np.int64)
            pos = np.concatenate([a + np.arange(s) for a, s in zip(alone, size, strict=True)]) if len(held) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*held, np.zeros(0, np.uint64)]).astype(np.int64)), pa.array(np.repeat(rep, size)),
                                              pa.array(np.repeat(n, size).astype(np.int32)), pa.array(pos.astype(np.int32))], names=["token", "rep", "n", "pos"])
    return sets.select("rep", "n", "tokens").mapInArrow(given_back(read), "token long, rep long, n int, pos int")


def _may_link(a: str, b: str, percent: int):
    """Length and positional filters. The first shared prefix shingle has none before it in both sets, so at
    most it and the shorter rest can be shared; a pair passes at that shingle if it passes at all."""
    n1, n2 = F.col(f"{a}.n").cast("long"), F.col(f"{b}.n").cast("long")
    rest = F.least(n1 - F.col(f"{a}.pos"), n2 - F.col(f"{b}.pos"))
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (rest * (100 + percent) >= (n1 + n2) * percent)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) that link. Sets travel to the pairs' first members once for each pair; the partners of
    a first member are dealt to cells of about ``PARTNERS``, each with a copy of its set."""
    cells = pairs.groupBy(F.col("u").alias("rep")).agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("cells"))
    many = cells.where("cells > 1").withColumnRenamed("rep", "u")
    dealt = pairs.join(many, "u", "left").withColumn("cell", F.pmod(F.xxhash64("v"), F.coalesce("cells", F.lit(1))).cast("int")).drop("cells")
    there = dealt.join(sets.select(F.col("rep").alias("v"), "n", "tokens"), "v").select(F.col("u").alias("rep"), "cell", "v", "n", "tokens")
    own = (sets.join(cells, "rep").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
           .select("rep", "cell", F.lit(None).cast("long").alias("v"), "n", "tokens"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by first member and cell, its own set before those it is compared with."""
        now, n_now, mine, spread = None, 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            u, v = [], []
            rows = zip(b.column("rep").to_pylist(), b.column("v").to_pylist(), b.column("n").to_pylist(), b.column("tokens").to_pylist(), strict=True)
            for rep, other, n, tokens in rows:
                got = unpack(tokens)
                part = _spread(got)
                if other is None:
                    now, n_now, mine, spread = rep, n, np.sort(got), part
                    continue
                assert rep == now
                need = (n + n_now) * percent
                if np.minimum(part, spread).sum() * (100 + percent) < need:  # suffix filter: the hash ranges share too few
                    continue
                at = np.searchsorted(mine, got)
                shared = int((mine[np.minimum(at, len(mine) - 1)] == got).sum())
                if shared * (100 + percent) >= need:
                    u.append(rep)
                    v.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return (own.unionByName(there).repartition("rep", "cell").sortWithinPartitions("rep", "cell", F.col("v").isNotNull())
            .select("rep", "v", "n", "tokens").mapInArrow(given_back(check), "u long, v long"))


def _spread(tokens: np.ndarray) -> np.ndarray:
    """How many shingles lie in each of ``RANGES`` parts of the hash range: the smaller counts of two sets, added
    up, are at least what they share."""
    return np.bincount((tokens >> np.uint64(42)).astype(np.int64), minlength=RANGES)


def _pairs_of_few(now: DataFrame, percent: int) -> DataFrame:
    return (now.alias("x").join(now.alias("p"), "token")
            .where((F.col("x.rep") > F.col("p.rep")) & (F.col("x.comp") != F.col("p.comp")) & _may_link("x", "p", percent))
            .select(F.col("p.rep").alias("u"), F.col("x.rep").alias("v")))


def _pairs_of_many(now: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The sets of a shingle are dealt to blocks of about ``MEMBER_BLOCK``; every two blocks meet in one place.
    A pair comes out at the first prefix shingle that both hold, and so only once."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [unpack(x) for x in b.column("tokens").to_pylist()]
            longest = [len(x) - least_shared(n, percent) + 1 for x, n in zip(held, b.column("n").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), pa.array([_spread(x).astype("<u4").tobytes() for x in held], pa.binary()),
                 pa.array([pack(x[:p]) for x, p in zip(held, longest, strict=True)], pa.binary())], names=["rep", "spread", "prefix"])

    wanted = sets.join(now.select("rep").distinct(), "rep", "left_semi").select("rep", "n", "tokens")
    spreads = cut_lineage(wanted.mapInArrow(given_back(spread), "rep long, spread binary, prefix binary"), "spreads")
    blocks = F.ceil(F.col("size") / MEMBER_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    met = (now.join(spreads, "rep").withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n", "pos", "comp", "spread", "prefix"))

    def compare(group: pa.Table) -> pa.Table:
        rep, n, pos, comp, own = (group[c].to_numpy().astype(np.int64) for c in ("rep", "n", "pos", "comp", "own"))
        held = np.frombuffer(b"".join(group["spread"].to_pylist()), "<u4").reshape(-1, RANGES)
        token = group["token"][0].as_py()
        earlier = []
        for x in group["prefix"].to_pylist():
            prefix = unpack(x).tolist()
            earlier.append(frozenset(prefix[:prefix.index(token)]))
        first = np.flatnonzero(own == group["i"][0].as_py())
        second = np.flatnonzero(own == group["j"][0].as_py())
        one_block = np.array_equal(first, second)
        u, v = [], []
        for k, x in enumerate(first):
            y = second[k + 1:] if one_block else second
            y = y[(comp[y] != comp[x]) & (np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent)]
            need = (n[y] + n[x]) * percent
            fits = np.minimum(n[y] - pos[y], n[x] - pos[x]) * (100 + percent) >= need
            y, need = y[fits], need[fits]
            y = y[np.minimum(held[y], held[x]).sum(axis=1).astype(np.int64) * (100 + percent) >= need]
            y = y[[earlier[x].isdisjoint(earlier[z]) for z in y.tolist()]] if len(y) else y
            u.append(np.minimum(rep[x], rep[y]))
            v.append(np.maximum(rep[x], rep[y]))
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": np.concatenate(u or none), "v": np.concatenate(v or none)})

    return met.groupBy("token", "i", "j").applyInArrow(compare, "u long, v long")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(``u``, ``v``) of every set but the roots: its component's smallest set."""
    entries = _entries(sets, percent)
    shared = entries.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    entries = cut_lineage(entries.join(cut_lineage(shared, "shared"), "token"), "prefixes")
    tree = None
    for turn in range(PIVOT_ROUNDS + 1):
        now = entries.withColumn("comp", F.col("rep"))
        if tree is not None:
            now = (entries.join(tree.select(F.col("u").alias("rep"), F.col("v").alias("comp")), "rep", "left")
                   .withColumn("comp", F.coalesce("comp", "rep")))
            # a shingle whose sets all lie in one component is done with
            open_tokens = now.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("token")
            now = cut_lineage(now.join(open_tokens, "token", "left_semi"), "prefixes-open")
            if now.isEmpty():
                break
        if turn < PIVOT_ROUNDS:
            order = F.xxhash64("rep", F.lit(turn))
            pivots = now.groupBy("token").agg(F.min_by(F.struct("rep", "n", "pos", "comp"), order).alias("p")).select("token", "p.*")
            pairs = (now.alias("x").join(pivots.alias("p"), "token")
                     .where((F.col("x.rep") != F.col("p.rep")) & (F.col("x.comp") != F.col("p.comp")) & _may_link("x", "p", percent))
                     .select(F.least("x.rep", "p.rep").alias("u"), F.greatest("x.rep", "p.rep").alias("v")))
        else:
            few = F.col("size") <= SMALL_GROUP
            pairs = _pairs_of_few(now.where(few), percent).unionByName(_pairs_of_many(now.where(~few), sets, percent))
        found = cut_lineage(_verify(cut_lineage(pairs.distinct(), "pairs"), sets, percent), "links")
        tree = components(found if tree is None else tree.unionByName(found))
    return tree


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``rk``, ``n_shingles``, ``component_id``, ``component``), one row per row of ``docs``.

    Two documents link when ``100 * shared >= percent * all`` of their distinct word n-grams (A-Z
    lower-cased; a document of fewer words has its whole sequence as one). ``component_id`` is the smallest
    id reachable by links, the document's own included; ``component`` a key of the component itself. NULL and
    empty texts and texts without words have no n-grams and link with nothing. Repeated rows are separate
    documents and link; ``rk`` is the row key of id and text, which they share. NULL ids count as larger than
    any; columns besides id and text are ignored; an empty table gives an empty result."""
    require(docs, id_col, text_col)
    sets = document_sets(docs, id_col, text_col, words, percent)
    key = ["low", "high"]
    reps = cut_lineage(sets.where("tokens is not null").groupBy(*key).agg(
        F.min("rk").alias("rep"), F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("tokens").alias("tokens")), "reps")
    tree = _links(reps, percent)
    placed = (reps.select(*key, "rep", "least_id").join(tree.select(F.col("u").alias("rep"), "v"), "rep", "left")
              .withColumn("component", F.coalesce("v", "rep")))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    placed = cut_lineage(placed.join(least, "component").select(*key, "component", "component_id"), "placed")
    linked = sets.where("tokens is not null").select("doc_id", "rk", "n", *key).join(placed, key)
    alone = sets.where("tokens is null").select("doc_id", "rk", "n", F.col("rk").alias("component"), F.col("doc_id").alias("component_id"))
    columns = ["doc_id", "rk", F.col("n").cast("long").alias("n_shingles"), "component_id", "component"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all their columns, one of each component: that of the smallest id, NULL last. Rows that
    agree in id and text count as one document."""
    placed = near_duplicates(docs, words, percent, id_col, text_col)
    stay = cut_lineage(placed.groupBy("component").agg(F.min_by("rk", F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("__rk"))
                       .select("__rk").distinct(), "stay")
    keyed = docs.withColumn("__rk", row_key(F.col(id_col), F.col(text_col)))
    return keyed.join(stay, "__rk", "left_semi").dropDuplicates(["__rk"]).drop("__rk")
