"""Document fingerprints by winnowing (DataFrame functions only).

A text is a sequence of tokens: a word ``[^\\x20\\x09-\\x0D]+``, cut so that each character of
scripts written without spaces (U+2E80 and up) is a token by itself. Each token has a code, and
the rolling hash at a place is the polynomial of the codes of the ``GRAM`` tokens there, modulo a prime.
Of each ``WINDOW`` consecutive grams the one with the smallest hash is picked, of equal ones
the rightmost: hash and place are held in one number, (hash, -place), so the least number decides.

Picks are kept with their places and a hash of 62 bits, the rolling one and one of another base.
Guarantee: two texts that share a passage of ``WINDOW + GRAM - 1`` tokens share a pick inside
it, and its two places say where the passage lies. All of it are array functions in one projection; what a
task holds is linear in its longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.text import require
from framewise.operators.ordering import with_positions
from framewise.session import cut_lineage

GRAM = 5
WINDOW = 8
TOKEN = r"[\x{2E80}-\x{10FFFF}]|[^\x20\x09-\x0D\x{2E80}-\x{10FFFF}]+"
#: Modulus and base of the rolling hash; base of the second hash that picks are kept with.
MODULUS, BASE, SECOND_BASE = 2147483647, 1103515245, 1812433253
_PLACES = 1 << 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside lambdas Spark shares no common expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _code(token: Column) -> Column:
    """28 bits of a token, so that a gram's products sum up in a long."""
    return F.shiftright(F.crc32(token.cast("binary")), 4)


def _polynomial(codes: Column, i: Column, gram: int, base: int) -> Column:
    """Polynomial of the codes of the gram at place i; NULL where fewer than ``gram`` tokens are left."""
    terms = [F.get(codes, i + j) * F.lit(pow(base, gram - 1 - j, MODULUS)).cast("long") for j in range(gram)]
    return sum(terms[1:], terms[0]) % F.lit(MODULUS).cast("long")


def picks(codes: Column, gram: int, window: int) -> Column:
    """Places of the grams that winnowing picks, in rising order."""
    size, last = F.lit(_PLACES).cast("long"), F.lit(_PLACES - 1).cast("long")
    packed = F.transform(codes, lambda _, i: _polynomial(codes, i, gram, BASE) * size + (last - i))

    def chosen(h: Column) -> Column:
        minima = F.transform(h, lambda x, i: F.least(x, *[F.get(h, i + j) for j in range(1, window)]) if window > 1 else x)
        minima = F.slice(minima, F.lit(1), F.greatest(F.size(h) - (gram + window - 2), F.lit(1)))
        return F.transform(F.array_distinct(minima), lambda x: (last - x % size).cast("int"))
    return _let(packed, chosen)


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """``array<struct<pos: int, hash: long>>``: the picks of a text by place, counted in tokens from 0.

    NULL and empty texts, and those of white space alone, have none; texts of fewer than ``gram`` tokens have
    one, for all of them. Equal texts have equal fingerprints."""
    if not 1 <= gram <= 15 or window < 1:  # sums of 15 products of 28 and 31 bits fit a long
        raise ValueError("gram must be 1 to 15, window 1 or more")

    def both(codes: Column, i: Column) -> Column:
        return _polynomial(codes, i, gram, BASE) * F.lit(1 << 31).cast("long") + _polynomial(codes, i, gram, SECOND_BASE)

    def of(codes: Column) -> Column:
        many = F.transform(picks(codes, gram, window), lambda p: F.struct(p.alias("pos"), both(codes, p).alias("hash")))
        filled = F.concat(codes, F.array_repeat(F.lit(0).cast("long"), gram))
        few = _let(filled, lambda c: F.array(F.struct(F.lit(0).alias("pos"), both(c, F.lit(0)).alias("hash"))))
        kind = "array<struct<pos:int,hash:bigint>>"
        return (F.when(F.size(codes) >= gram, many.cast(kind)).when(F.size(codes) > 0, few.cast(kind))
                .otherwise(F.array().cast(kind)))
    return _let(F.transform(tokens(text), _code), of)


def fingerprint_text(picked: Column) -> Column:
    """``place:hash`` of the picks, joined by commas."""
    return F.array_join(F.transform(picked, lambda x: F.concat_ws(":", x["pos"], x["hash"])), ",")


def hashes(picked: Column) -> Column:
    return F.array_distinct(F.transform(picked, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; two empty sets are alike (1), an empty one is like no other (0)."""
    def of(common: Column) -> Column:
        union = F.size(a) + F.size(b) - common
        return F.when(union == 0, F.lit(1.0)).otherwise(common.cast("double") / union)
    return _let(F.size(F.array_intersect(a, b)), of)


def _key(id_col: str, text_col: str) -> Column:
    """128-bit key of (id, text)."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.lit("|"), F.coalesce(F.col(text_col), F.lit("")))))


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint, that of an edited copy, and how like they are to it: (id, ``n_chars``, ``edited``, ``picked``,
    ``edited_picked``, ``near_edited``, ``near_next``).

    The copy's last quarter (``floor(n_chars / 4)`` code points) is replaced by the beginning of the next document in order
    of id, as much as it has of that length; after the last comes the first. NULL text is empty. A NULL id comes last. Documents that share an
    id come in order of a hash of their text; rows that agree in id and text are one document, and each of them gets its row. An
    empty table gives an empty result. Other columns are ignored.

    Only ids and lengths are ordered. A document then sends its beginning, as long as its predecessor asks for, and its hashes; whole texts
    move once, by their key."""
    require(df, id_col, text_col)
    # both uses of ``texts`` take the same columns dealt by the same key, so that Spark moves them once
    texts = df.select(_key(id_col, text_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = df.select(_key(id_col, text_col).alias("k"), F.col(id_col).alias("id"),
                      F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n")).distinct()
    placed = cut_lineage(with_positions(sizes, ["id", "k"], name="pos", size_name="of"), "winnow-order")
    before = placed.select(F.col("k").alias("pk"), "id", F.floor(F.col("n") / 4).cast("int").alias("need"), ((F.col("pos") + 1) % F.col("of")).alias("pos"))
    asked = placed.select("k", "pos").join(before, "pos").select("k", "pk", "id", "need")
    sent = (texts.join(asked, "k")
            .select("pk", "id", F.substring("text", F.lit(1), F.col("need")).alias("head"), hashes(fingerprint(F.col("text"), gram, window)).alias("next_hashes"))
            .dropDuplicates(["pk"]))
    n = F.char_length("text")
    joined = (texts.join(sent, F.col("k") == F.col("pk"))
              .select("id", n.cast("long").alias("n_chars"), "next_hashes", fingerprint(F.col("text"), gram, window).alias("picked"),
                      F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head")).alias("edited")))
    done = joined.select("*", fingerprint(F.col("edited"), gram, window).alias("edited_picked"))
    return (done.select("*", hashes(F.col("picked")).alias("own"))
            .select(F.col("id").alias(id_col), "n_chars", "edited", "picked", "edited_picked",
                    likeness(F.col("own"), hashes(F.col("edited_picked"))).alias("near_edited"), likeness(F.col("own"), F.col("next_hashes")).alias("near_next")))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next,
             coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id FROM d),
e AS (SELECT *, left(text, n_chars - n_chars // 4) || left(next, n_chars // 4) AS edited FROM o),
w AS (SELECT doc_id, kind, regexp_extract_all(s, '[\x{2E80}-\x{10FFFF}]|[^\x20\x09-\x0D\x{2E80}-\x{10FFFF}]+') AS w
      FROM (SELECT doc_id, 1 AS kind, text AS s FROM e UNION ALL SELECT doc_id, 2, edited FROM e)),
t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
x AS (SELECT DISTINCT unnest(w) AS token FROM w),
k AS (SELECT token, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(token))),
        lambda i: ('0x' || substr(hex(encode(token)), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) >> 4 AS code FROM x, t),
p AS (SELECT doc_id, kind, len(w) AS n, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM w),
c AS (SELECT doc_id, kind, n, pos, code FROM p JOIN k USING (token)),
g AS (SELECT doc_id, kind, n, pos,
        coalesce(code, 0) AS c0, coalesce(lead(code, 1) OVER q, 0) AS c1, coalesce(lead(code, 2) OVER q, 0) AS c2,
        coalesce(lead(code, 3) OVER q, 0) AS c3, coalesce(lead(code, 4) OVER q, 0) AS c4
      FROM c WINDOW q AS (PARTITION BY doc_id, kind ORDER BY pos)),
h AS (SELECT doc_id, kind, n, pos,
        (c0 * {b[4]} + c1 * {b[3]} + c2 * {b[2]} + c3 * {b[1]} + c4) % {m} AS h,
        (c0 * {s[4]} + c1 * {s[3]} + c2 * {s[2]} + c3 * {s[1]} + c4) % {m} AS h2
      FROM g WHERE pos <= greatest(n - 5, 0)),
m AS (SELECT doc_id, kind, pos, n, 4294967295 - min(h * 4294967296 + (4294967295 - pos)) OVER (
        PARTITION BY doc_id, kind ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) % 4294967296 AS pick FROM h),
f AS (SELECT DISTINCT doc_id, kind, pick FROM m WHERE pos <= greatest(n - 12, 0)),
z AS (SELECT f.doc_id, f.kind, string_agg(pick || ':' || (h * 2147483648 + h2), ',' ORDER BY pick) AS fp,
        list(DISTINCT h * 2147483648 + h2) AS hs
      FROM f JOIN h ON h.doc_id = f.doc_id AND h.kind = f.kind AND h.pos = f.pick GROUP BY ALL),
r AS (SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, coalesce(a.fp, '') AS fingerprint, coalesce(b.fp, '') AS edited_fingerprint,
        coalesce(a.hs, []) AS own, coalesce(b.hs, []) AS ed, coalesce(x.hs, []) AS nx
      FROM e LEFT JOIN z a ON a.doc_id = e.doc_id AND a.kind = 1 LEFT JOIN z b ON b.doc_id = e.doc_id AND b.kind = 2
      LEFT JOIN z x ON x.doc_id = e.next_id AND x.kind = 1)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN len(own) + len(ed) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(own, ed))::DOUBLE / len(list_distinct(own || ed)) END AS near_edited,
  CASE WHEN len(own) + len(nx) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(own, nx))::DOUBLE / len(list_distinct(own || nx)) END AS near_next
FROM r
"""
for _name, _base in (("b", BASE), ("s", SECOND_BASE)):
    for _j in range(1, GRAM):
        SQL = SQL.replace(f"{{{_name}[{_j}]}}", str(pow(_base, _j, MODULUS)))
SQL = SQL.replace("{m}", str(MODULUS))
