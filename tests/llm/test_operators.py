"""Each operator against brute force, on small, awkward and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import chat, components, decontamination, language, lines, mixing, neighbours, ngram_join, secret_scan, substrings, tokens
from framewise.llm.fm_index import FMIndex
from framewise.llm.queries import tokenizer_file
from helpers import DOC_SCHEMA, awkward, kept_words, shingle_set, strip_lines, words
from helpers import components as brute_components


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


# mixing

def test_mix_awkward(spark):
    df, rows = awkward(spark)
    got = mixing.mix(df, keep=["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    assert sum(r["target"] for r in {r["source"]: r for r in got}.values()) == pytest.approx(sum(len(words(r[1])) for r in rows))
    for r in got:
        assert r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        assert r["target"] <= 3 * r["source_size"]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df, keep=["doc_id", "source"]).collect()))
    assert mixing.emit(mixing.mix(df)).count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, keep=["doc_id", "size"])


def test_mix_targets_and_hot_source(spark):
    rows = [(i, " ".join(["w"] * (5 + i % 40)), "en", "hot" if i % 3 else f"s{i % 7}", 1) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, DOC_SCHEMA), keep=["source"]).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")).collect()
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 100
    by = sorted(got, key=lambda r: r["source"])
    free = [(r["target"] / w) for r, w in zip(by, [5, 2, 1] * 3, strict=False) if r["target"] < 3 * r["size"]]
    assert max(free) == pytest.approx(min(free))


# line dedup

def test_lines_awkward(spark):
    df, rows = awkward(spark)
    got = lines.drop_common_lines([df], df, keep=["doc_id", "text", "rk"]).collect()
    want = strip_lines([r[1] for r in rows], 10)
    assert Counter((r["doc_id"], r["text"], tuple(r["lines"]), tuple(r["kept"])) for r in got) == \
        Counter((r[0], r[1], tuple(a), tuple(b)) for r, (a, b) in zip(rows, want, strict=True))
    assert lines.drop_common_lines([empty(spark)], empty(spark)).count() == 0


def test_line_runs_compact_and_write_known_keys_once(spark):
    batch = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    runs = lines.LineRuns(spark, fanout=2)
    held = lambda: spark.read.parquet(*runs.runs())
    for i in range(5):
        runs.add(batch(f"common\nbatch {i}", "Common ", "ÉCOLE\nécole"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert runs.frequent(10).count() == 1  # upper case outside A-Z is another key
    assert held().where("fresh").groupBy("h").count().where("count > 1").count() == 0
    assert held().where("fresh").count() == 3 + 5
    newest = spark.read.parquet(runs.levels[0][0])
    assert newest.where("fresh").count() == 1  # "batch 4" alone: the three known keys only add their counts
    assert sorted(r["n_docs"] for r in newest.where("not fresh").collect()) == [1, 1, 2]
    merged = runs._merged(runs.runs())
    assert sorted(r["n_docs"] for r in merged.collect()) == [1] * 5 + [5, 5, 10] and merged.where("not fresh").count() == 0


def test_batches_of_files(spark, tmp_path):
    path = str(tmp_path / "a table")
    rows = [(i, f"line {i % 5}\nown {i}" if i % 9 else None) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(10).write.parquet(path)
    docs = spark.read.parquet(path)
    for batches in (lines.batches_of(docs), lines.batches_of(docs, most_bytes=1), lines.batches_of(docs, least_batches=1)):
        assert sorted(r["doc_id"] for b in batches for r in b.collect()) == list(range(300))
    assert len(lines.batches_of(docs)) == 4 and len(lines.batches_of(docs, most_bytes=1)) == 10 and len(lines.batches_of(docs, least_batches=1)) == 1
    some = docs.where("doc_id < 40").select("doc_id", "text", F.lit("x").alias("_metadata"))
    assert sorted(r["doc_id"] for b in lines.batches_of(some) for r in b.collect()) == list(range(40))
    assert len(lines.batches_of(spark.createDataFrame(rows, "doc_id long, text string"))) == 1
    with pytest.raises(ValueError):
        lines.batches_of(docs, most_bytes=0)
    whole = lambda batches: {(r["doc_id"], tuple(r["kept"])) for r in lines.drop_common_lines(batches, docs).collect()}
    assert whole(None) == whole([docs]) == whole(lines.batches_of(docs, most_bytes=1))


# secrets

def test_many_rules_ask_for_any_number_of_trigrams(spark):
    rng = random.Random(3)
    names = ["".join(rng.choices("bcdfghjklmnpqrstvwxz", k=12)) for _ in range(100)]
    rules = tuple(secret_scan.rule(f"r{i}", f"{n}_?[0-9]+") for i, n in enumerate(names))
    assert len(secret_scan.vocabulary(rules)) > 400
    texts = [f"{'text ' * (i % 7)}{names[i]}_{i}, {names[-1 - i]}7 {names[i].upper()}9 {names[i][:8]}5" for i in range(100)] + ["nothing"]
    got = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rules).collect()
    for r in got:
        text = texts[r["doc_id"]]
        want = sorted((m.start(), i, m.end()) for i, n in enumerate(names) for m in re.finditer(f"{n}_?[0-9]+", text))
        assert [tuple(x) for x in r["spans"]] == want


def test_trigram_queries_are_sound():
    for r in secret_scan.RULES:
        assert (r.query == secret_scan.ANY) == (r.kind == "hex")
    assert secret_scan.trigram_query("(abc|def)g") == frozenset({frozenset({"abc", "bcg"}), frozenset({"def", "efg"})})
    assert secret_scan.trigram_query("(abc|def)g+") == frozenset({frozenset({"abc"}), frozenset({"def"})})
    assert secret_scan.trigram_query("(abcd)?x") == secret_scan.ANY


def test_secrets_against_python(spark):
    base = re.compile(r"""(?a:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
    rng = random.Random(3)
    bits = ["password", " = ", "Api_KEY", ": '", "token=", "abcdefgh12", "short", "AKIA", "ABCDEF0123456789", "0123456789abcdef" * 2, "é", "漢", "\n",
            "ſecret=abcdefghij", "toKen=abcdefghij", " SECRET:  \"x.y_z-9/", "ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----"]
    texts = [None, "", *["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(300)]]
    got = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        t = texts[r["doc_id"]] or ""
        want = [(m.start(), 0, m.end()) for m in base.finditer(t) if len(m[2]) >= 8]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert [tuple(s) for s in r["spans"] if s["kind"] < 3] == sorted(want)
    df, rows = awkward(spark)
    assert secret_scan.scan(df).count() == len(rows)
    assert secret_scan.scan(empty(spark)).count() == 0


# chat

def test_chat_round_trip(spark):
    nasty = ["", None, "<|im_end|>", "\\<|", "<", "|im_start|>user\n", "a\\\\<\\|b\n<|im_start|>assistant\nx<|im_end|>\n", "é漢🙂\\"]
    rows = [(c, t, ("user", "assistant", "we\nird<|", None)[(t + c) % 4], nasty[(t * 3 + c) % len(nasty)], "clash") for c in range(6) for t in range(8)]
    rows += [(None, None, None, None, None), (99, 1, "user", "tie", "b"), (99, 1, "user", "tie", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    done = chat.format_turns(chat.canonical(df)).select(
        "conv_id", "turns", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said")).collect()
    assert len(done) == 8
    for r in done:
        assert r["back"] == r["turns"]
        assert r["said"] == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")
    assert chat.canonical(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    import json
    want = [("user", "hi"), ("assistant", "yo")]
    layouts = {
        "messages": {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        "share": {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "other": 1},
        "prompt_response": {"prompt": "hi", "response": "yo"},
        "instruction": {"instruction": "hi", "output": "yo"},
        "instruction_input": {"instruction": "hi", "input": "", "output": "yo"},
        "system_prompt": {"system": None, "prompt": "hi", "response": "yo"},
    }
    rows = [(n, json.dumps(v)) for n, v in layouts.items()] + [("none", "{"), ("null", None), ("odd", '{"x": 1}')]
    df = spark.createDataFrame(rows, "conv_id string, record string")
    got = {r["conv_id"]: r for r in chat.canonical_json(df, "record").collect()}
    for name in layouts:
        assert got[name]["layout"] == name and [tuple(t) for t in got[name]["turns"]] == want
    assert all(got[n]["layout"] is None and got[n]["turns"] == [] for n in ("none", "null", "odd"))
    table = spark.createDataFrame([(1, "hi", "yo", 5)], "conv_id long, prompt string, response string, extra int")
    assert [tuple(t) for t in chat.canonical(table).first()["turns"]] == want
    assert [tuple(t) for t in chat.canonical(table.withColumn("text", F.lit("clash"))).first()["turns"]] == want
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1,)], "conv_id long"))


# tokens

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_prefix_counts_are_the_librarys(library):
    counter = tokens.PrefixCounter(tokens.Vocabulary(tokenizer_file()))
    rng = random.Random(1)
    bits = [*"abcdest 's're'll'  \n\t\n 12 !?.=-éüñ漢字🙂\xa0\x1c\x85​", "<|endoftext|>", "'re", "'ve ", "   ", "====", " the ", "ll"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want


def test_tokens_awkward(spark, library):
    df, rows = awkward(spark)
    stored = tokens.token_prefixes(df, tokenizer_file(), keep=["doc_id", "text", "size"], limits=[5])
    got = stored.select("*", tokens.fits(5)("prefix_tokens").alias("fit"), tokens.tokens_at(F.col("prefix_tokens"), F.lit(3)).alias("at3")).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        assert r["n_bytes"] == len(text.encode()) and r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert len(library.encode(text[:r["fit"]], add_special_tokens=False).ids) <= 5
        assert r["chars_within_5"] == r["fit"]
        assert r["at3"] == (len(library.encode(text[:3], add_special_tokens=False).ids) if len(text) >= 3 else None)
    assert tokens.token_prefixes(empty(spark), tokenizer_file()).count() == 0


# n-gram join

@pytest.mark.parametrize("small", [64, 1])
def test_ngram_join_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    monkeypatch.setattr(ngram_join, "MEMBER_BLOCK", 16)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 1)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = list(base) if i % 2 else [f"u{rng.randint(0, 30)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = f"e{rng.randint(0, 400)}"
        rows.append((i, " ".join(text).title() if i % 3 else " ".join(text)))
    rows += [(200, rows[1][1]), (201, None), (202, ""), (203, "\t"), (204, "a b"), (205, "A  b"), (206, "the " * 300), (207, "the " * 9)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    comp, size = brute_components(rows)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (comp[i], size[i]) for i, _ in rows}


def test_ngram_join_awkward(spark):
    df, rows = awkward(spark)
    got = ngram_join.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((r[0], len(shingle_set(r[1]))) for r in rows)
    left = ngram_join.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.where("doc_id >= 4 and doc_id < 40").collect()) == [4, 5]
    assert left.where("text is null or text = '' or doc_id = 2").count() == 3
    assert ngram_join.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 60), (7, 7), (-3, 200)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 60: 50, 100: 50, 200: -3}


# substrings

def test_fm_index_counts():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 4, 500)
    index = FMIndex(text, 4)
    for _ in range(200):
        n = int(rng.integers(1, 7))
        pattern = rng.integers(0, 4, n)
        lo, hi = np.array([0]), np.array([index.size])
        for s in pattern[::-1]:
            lo, hi = index.extend(np.array([s]), lo, hi)
        assert hi[0] - lo[0] == sum(np.array_equal(text[i:i + n], pattern) for i in range(len(text) - n + 1))


@pytest.mark.parametrize("contents", [64, 2])
def test_substrings_against_brute_force(spark, monkeypatch, contents):
    monkeypatch.setattr(substrings, "CONTENTS", contents)  # at 2 most marks are dealt on by window
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(70)]
    texts = [None, "", "short text", "the " * 90, "x y " * 40]
    for _ in range(80):
        text = [f"v{rng.randint(0, 500)}" for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            a, at = rng.randint(0, 40), rng.randint(0, len(text))
            text[at:at] = passage[a:a + rng.randint(20, 70)]
        texts.append(" \n".join(text))
    texts += texts[10:14]
    df = spark.createDataFrame([(i % 80, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substrings.drop_repeats(df).collect())
    assert got == Counter((i % 80, len(words(t)), len(words(t)) - len(k), " ".join(k)) for i, (t, k) in enumerate(zip(texts, kept_words(texts), strict=True)))


def test_substrings_awkward(spark):
    df, rows = awkward(spark)
    got = substrings.drop_repeats(df, keep=["doc_id", "rk"]).collect()
    want = kept_words([r[1] for r in rows])
    assert Counter((r["doc_id"], r["kept_text"]) for r in got) == Counter((r[0], " ".join(k)) for r, k in zip(rows, want, strict=True))
    assert substrings.drop_repeats(empty(spark)).count() == 0


# decontamination

def _slow_alignment(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if item[i - 1] == passage[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_against_the_plain_table():
    rng = np.random.default_rng(4)
    for _ in range(200):
        item, passage = rng.integers(0, 5, rng.integers(3, 15)), rng.integers(0, 5, rng.integers(0, 30))
        score, lo, hi = decontamination.align(item, passage)
        assert score == _slow_alignment(item, passage)
        assert score == 0 or _slow_alignment(item, passage[lo:hi]) == score


def test_leaks(spark):
    rng = random.Random(6)
    item = [f"q{i}" for i in range(40)]
    noise = lambda n: [f"n{rng.randint(0, 3000)}" for _ in range(n)]
    edited = [w for i, w in enumerate(item) if i % 13 != 5]
    edited[10] = "other"
    texts = {0: noise(300), 1: noise(50) + item + noise(60), 2: noise(20) + edited + noise(5), 3: noise(200) + item[:12] + noise(40), 4: [],
             **{100 + i: noise(30) + item + noise(30) for i in range(40)}}
    df = spark.createDataFrame([(i, ", ".join(t).upper() if i == 1 else " ".join(t)) for i, t in texts.items()] + [(5, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (9, None), (10, " ".join(noise(30)))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.find_leaks(df, bench).collect()}
    assert set(got) == {(i, 7) for i in [1, 2, *range(100, 140)]}
    assert got[1, 7]["score"] == 1 and (got[1, 7]["first_word"], got[1, 7]["end_word"]) == (50, 90)
    assert got[2, 7]["score"] == 32 / 40  # 36 words matched, 3 gaps, 1 other word
    assert sorted(r["doc_id"] for r in decontamination.drop_leaks(df, bench).collect()) == [0, 3, 4, 5]


@pytest.mark.parametrize("least", [0.5, 0.55, 0.3])
def test_leaks_against_full_alignment(spark, least):
    rng = random.Random(9)
    noise = lambda n: [f"n{rng.randint(0, 400)}" for _ in range(n)]
    own = {n: [f"i{n}w{k}" for k in range(n)] for n in (3, 5, 8, 15, 20, 40)}
    own[100] = ["a", "b"] * 6  # repeated pairs
    texts = []
    for item in own.values():
        n = len(item)
        for extra in range(1, n):  # words put in at even distances
            places = {round((k + 1) * n / (extra + 1)) for k in range(extra)}
            texts.append([x for i, w in enumerate(item) for x in ([f"new{i}"] if i in places else []) + [w]])
        for _ in range(12):  # words replaced, put in and left out
            share = rng.uniform(0.1, 0.45)
            texts.append([x for w in item for x in ([w] if rng.random() > share else rng.choice([["x"], [w, "y"], []]))])
    texts = [noise(rng.randint(0, 12)) + t + noise(rng.randint(0, 12)) for t in texts]
    texts += [noise(5) + own[40][a::2] + noise(3) for a in (0, 1)] + [noise(300)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in own.items()], "item_id long, text string")
    ids = {}
    code = lambda ws: np.array([ids.setdefault(w, len(ids)) for w in ws])
    want = {(d, i): p / len(t) for d, x in enumerate(texts) for i, t in own.items() if (p := decontamination.align(code(t), code(x))[0]) / len(t) >= least}
    assert len(want) > 80
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.find_leaks(df, bench, least).collect()} == want


def test_leaks_of_short_items(spark):
    """Items of one and two words against full alignment, and left out where the caller says so."""
    texts = ["a b c d", "x alpha y", "x alpha beta y", "beta, alpha", "ALPHA beta", "gamma", "", "omega " * 50 + "gamma"]
    items = {1: "alpha beta", 2: "Gamma", 3: "no such words here", 4: "", 5: "- -"}
    df = spark.createDataFrame([*enumerate(texts), (99, None)], "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for least in (0.5, 1.0):
        want = {}
        for i, item in items.items():
            t = re.findall("[a-z]+", item.lower())
            for d, x in enumerate(texts):
                p = re.findall("[a-z]+", x.lower())
                if t and p and _slow_alignment(t, p) / len(t) >= least:
                    want[d, i] = _slow_alignment(t, p) / len(t)
        assert (2, 1) in want and (7, 2) in want
        assert {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.find_leaks(df, bench, least).collect()} == want
    assert {r["item_id"] for r in decontamination.find_leaks(df, bench, least_words=2).collect()} == {1}
    assert decontamination.drop_leaks(df, bench, least_words=3).count() == len(texts) + 1
    with pytest.raises(ValueError, match="1 or more"):
        decontamination.find_leaks(df, bench, least_words=0)


def test_leaks_need_a_score(spark):
    with pytest.raises(ValueError, match="above 0"):
        decontamination.find_leaks(empty(spark), empty(spark).select(F.col("doc_id").alias("item_id"), "text"), 0)


def test_leaks_awkward(spark):
    df, rows = awkward(spark)
    bench = spark.createDataFrame([(None, rows[5][1])], "item_id long, text string")
    left = decontamination.drop_leaks(df, bench)
    assert left.columns == df.columns and sorted(r["doc_id"] or -1 for r in left.where("doc_id < 40 or doc_id is null").collect()) == [-1, -1, 1, 2, 3, 5, 6]
    assert decontamination.find_leaks(empty(spark), bench).count() == 0
    assert decontamination.drop_leaks(df, bench.limit(0)).count() == len(rows)


# language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    got = language.predict(docs, model).where(language.held_out(F.col("doc_id"))).collect()
    assert all(language.crc_held_out(r["doc_id"]) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)


def test_language_awkward(spark):
    df, rows = awkward(spark)
    model = language.train(df)
    got = language.predict(df, model, keep=["doc_id", "text", "rk"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert 0 <= r["score"] <= 1
    none = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.predict(df, none, keep=["doc_id"]).collect()} == {"und"}
    assert language.predict(empty(spark), model).count() == 0


# neighbours

def test_neighbours_recall_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 300)
    rng = np.random.default_rng(8)
    v = rng.standard_normal((1500, 24)) + 3 * rng.integers(0, 3, (1500, 1))
    v[100:160] = v[100]  # copies
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(5000, None), (5100, []), (5200, [0.0] * 24), (5300, [float("nan")] + [1.0] * 23), (5400, [None] + [1.0] * 23), (None, v[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df.where("vec_id % 20 = 0"), df).toPandas()
    assert len(got) == 75 * 10
    found = 0
    for q, part in got.sort_values("rank").groupby("query_id"):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(v)), d)) if i != q][:10]
        assert list(part["rank"]) == list(range(1, 11)) and np.allclose(part["score"], d[part["vec_id"]], rtol=0, atol=1e-12)
        if 100 <= q < 160:
            assert list(part["vec_id"]) == order
        found += len(set(order) & set(part["vec_id"]))
    assert found >= 0.9 * len(got)


def test_neighbours_of_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 4))
    v[1:30] = v[0] + rng.standard_normal((29, 4)) * 1e-3
    v[40:55], v[60:62], v[70:90] = v[40], v[60], v[70]
    ids = np.arange(300)
    ids[1:30], ids[40:55], ids[61], ids[70:82] = 0, 40, 60, 70  # near copies, equal rows, one repeat, among other ids
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>")
    places = [(int(ids[q]), v[q]) for q in (0, 7, 40, 60, 70, 85, 120, 200)] + [(999, v[0])]
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in places], df.schema)
    got = neighbours.nearest(queries, df, sure=0.9999999).toPandas()
    want = []
    for own, x in places:
        d = np.sqrt(((v - x) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != own][:10]
        assert len(order) == 10
        want += [(own, r + 1, int(ids[j]), round(float(d[j]), 9)) for r, j in enumerate(order)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for _, r in got.iterrows()) == sorted(want)


def test_neighbours_few_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.nearest(df.where("vec_id = 2"), df).collect()] == [(2, 1, 1, 1.0), (2, 2, 1, 2.0)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0
    assert neighbours.nearest(df.limit(0), df).count() == 0
