"""Secret scans through an inverted trigram index (DataFrame functions only).

Each rule's regular expression is turned into a Boolean query over trigrams that every
match must hold. The index keeps postings (trigram, document) of all trigrams that some
rule asks for, in lower case; a document's postings are intersected into one bit mask,
and only documents whose mask satisfies a rule's query are verified with its expression.
Rules without a mandatory trigram are run over every document. Both ways give the spans
of all matches, in code points.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.text import require, row_key

ANY: frozenset = frozenset([frozenset()])  # a query is an OR of ANDs of trigrams; this one always holds


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``min_chars`` code points, or the match is dropped. ``base`` rules come first."""
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0
    base: bool = False
    query: frozenset = field(default=ANY)


def _strings(node: list, most: int = 64) -> set[str] | None:
    """All lower-case strings that the parsed expression can match, if they are few and known."""
    out = {""}
    for op, arg in node:
        if op is sre.LITERAL:
            part = {chr(arg).lower()}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            part = {chr(a).lower() for _, a in arg}
        elif op is sre.SUBPATTERN:
            part = _strings(arg[3])
        elif op is sre.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            part = None if None in parts else set().union(*parts)
        elif op is sre.MAX_REPEAT and arg[1] <= 4:
            one = _strings(arg[2])
            part = None if one is None else {a for n in range(arg[0], arg[1] + 1) for a in ["".join(x) for x in _powers(one, n)]}
        else:
            part = None
        if part is None or len(part) * len(out) > most:
            return None
        out = {a + b for a in out for b in part}
    return out


def _powers(items: set[str], n: int) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = [()]
    for _ in range(n):
        out = [(*a, b) for a in out for b in items]
    return out


def _both(a: frozenset, b: frozenset, most: int = 64) -> frozenset:
    """AND of two queries; the weaker of the two if that would become too long."""
    if len(a) * len(b) > most:
        return a if len(a) <= len(b) else b
    return frozenset(x | y for x in a for y in b)


def _of_strings(strings: set[str]) -> frozenset:
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _query(node: list) -> frozenset:
    """Walk a sequence, collecting runs of known strings; each run and each unknown part adds its query."""
    out, run = ANY, {""}
    for item in [*node, None]:
        more = None if item is None else _strings([item])
        if more is not None and len(run) * len(more) <= 64:
            run = {a + b for a in run for b in more}
            continue
        out, run = _both(out, _of_strings(run)), (more or {""})
        if item is None or more is not None:
            continue
        op, arg = item
        if op is sre.SUBPATTERN:
            out = _both(out, _query(list(arg[3])))
        elif op is sre.BRANCH:
            out = _both(out, frozenset().union(*(_query(list(x)) for x in arg[1])))
        elif op is sre.MAX_REPEAT and arg[0] >= 1:
            out = _both(out, _query(list(arg[2]) * min(arg[0], 3)))
    return out


def trigram_query(pattern: str) -> frozenset:
    """Boolean query of an expression as OR of ANDs of lower-case trigrams; ``ANY`` if none is mandatory.

    An AND that holds only where a shorter one holds is left out, and of a long AND six trigrams are
    kept: both leave the query true wherever it was."""
    query = _query(list(sre_parser.parse(pattern)))
    least = [c for c in query if not any(other < c for other in query)]
    return ANY if frozenset() in query else frozenset(frozenset(sorted(c)[-6:]) for c in least)


def rule(kind: str, pattern: str, group: int = 0, min_chars: int = 0, base: bool = False) -> Rule:
    return Rule(kind, pattern, group, min_chars, base, trigram_query(pattern))


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])
RULES = (
    rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, min_chars=8, base=True),
    rule("access", r"AKIA[A-Z0-9]+", min_chars=16, base=True),
    rule("hex", r"[0-9a-f]{32,}", min_chars=32, base=True),  # a run of 32 or more is one leftmost match either way
    rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def _spans(text: Column, r: Rule, number: int) -> Column:
    """Array of (start, kind number, end) of the rule's matches: the pieces between the matches and the
    matches themselves, laid end to end, give every position."""
    found = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(r.pattern), F.lit(r.group)) if r.group else found
    between = F.split(text, r.pattern, -1)
    steps = F.arrays_zip(F.transform(found, F.char_length).alias("len"),
                         F.transform(F.slice(between, 1, F.size(found)), F.char_length).alias("gap"),
                         F.transform(held, F.char_length).alias("held"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["held"] >= r.min_chars, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, walked).otherwise(empty)


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for clause in r.query for t in clause})


def postings(docs: DataFrame, id_col: str, text_col: str, trigrams: list[str]) -> DataFrame:
    """(``trigram``, ``rk``): the documents whose text in lower case holds each of the given trigrams."""
    low = F.lower(F.col(text_col))
    held = F.filter(F.array(*[F.when(F.contains(F.col("__low"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]).cast("array<int>"),
                    lambda x: x.isNotNull())
    return (docs.select(row_key(F.col(id_col), F.col(text_col)).alias("rk"), low.alias("__low"))
            .select("rk", F.explode(held).alias("trigram")))


MASK_BITS = 63


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(``rk``, ``__rules``): documents that satisfy the query of at least one rule, with the numbers of those rules.

    Any number of trigrams: they are bits of as many longs as it takes, put together in one partial aggregation."""
    words = vocabulary(rules)
    place = {t: divmod(i, MASK_BITS) for i, t in enumerate(words)}
    n_masks = -(-len(words) // MASK_BITS)
    here = [F.when(F.floor(F.col("trigram") / MASK_BITS) == m, F.expr(f"shiftleft(1L, trigram % {MASK_BITS})")).otherwise(F.lit(0).cast("long"))
            for m in range(n_masks)]
    have = (postings(docs, id_col, text_col, words).groupBy("rk")
            .agg(F.count("*").alias("__n"), *[F.bit_or(bits).alias(f"__have{m}") for m, bits in enumerate(here)]))
    held = []
    for n, r in enumerate(rules):
        if r.query != ANY:
            holds = F.lit(False)
            for clause in r.query:
                masks: dict[int, int] = {}
                for t in clause:
                    m, bit = place[t]
                    masks[m] = masks.get(m, 0) | 1 << bit
                every = F.lit(True)
                for m, mask in sorted(masks.items()):
                    every = every & (F.col(f"__have{m}").bitwiseAND(F.lit(mask)) == F.lit(mask))
                holds = holds | every
            held.append(F.when(holds, F.lit(n)))
    kept = F.array_compact(F.array(*held)) if held else F.array().cast("array<int>")
    return have.select("rk", kept.alias("__rules")).where(F.size("__rules") > 0)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``spans``, an array of (start, kind number, end), by start, then kind.

    NULL text counts as empty and has no spans. Repeated rows each keep their row; an empty table gives
    an empty result; columns besides the id and the text are ignored."""
    require(docs, id_col, text_col)
    found = candidates(docs.select(id_col, text_col), rules, id_col, text_col)
    text = F.coalesce(F.col("__text"), F.lit(""))
    spans = [F.when(F.lit(True) if r.query == ANY else F.coalesce(F.array_contains("__rules", n), F.lit(False)),
                    _spans(text, r, n)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
             for n, r in enumerate(rules)]
    return (docs.select(F.col(id_col), F.col(text_col).alias("__text"), row_key(F.col(id_col), F.col(text_col)).alias("rk"))
            .join(found, "rk", "left")
            .select(id_col, F.sort_array(F.concat(*spans)).alias("spans")))


def span_text(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
p(k, kind, base, pat, grp, least) AS (VALUES
  (0, 'assign', true, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  (1, 'access', true, 'AKIA[A-Z0-9]+', 0, 16),
  (2, 'hex', true, '[0-9a-f]+', 0, 32),
  (3, 'private_key', false, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
  (4, 'github', false, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0),
  (5, 'slack', false, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0)),
m AS (
  SELECT r, 0 AS k, unnest(regexp_extract_all(text, (SELECT pat FROM p WHERE k = 0), 0)) AS hit,
         unnest(regexp_extract_all(text, (SELECT pat FROM p WHERE k = 0), 2)) AS held,
         unnest(string_split_regex(text, (SELECT pat FROM p WHERE k = 0))) AS gap,
         generate_subscripts(string_split_regex(text, (SELECT pat FROM p WHERE k = 0)), 1) AS i FROM d
  UNION ALL BY NAME
  SELECT r, k, unnest(regexp_extract_all(text, pat, 0)) AS hit, unnest(regexp_extract_all(text, pat, 0)) AS held,
         unnest(string_split_regex(text, pat)) AS gap, generate_subscripts(string_split_regex(text, pat), 1) AS i
  FROM d, (SELECT * FROM p WHERE k > 0)),
e AS (SELECT r, k, held, length(hit) AS n,
        sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY r, k ORDER BY i) AS stop, hit FROM m),
s AS (SELECT e.r, e.k, kind, base, stop - n AS start, stop FROM e JOIN p USING (k) WHERE hit IS NOT NULL AND length(held) >= least)
SELECT max(doc_id) AS doc_id, count(*) FILTER (s.k = 0)::BIGINT AS n_assign, count(*) FILTER (s.k = 1)::BIGINT AS n_access,
  count(*) FILTER (s.k = 2)::BIGINT AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, s.k) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, s.k), '') AS spans
FROM d LEFT JOIN s ON d.r = s.r GROUP BY d.r
"""
