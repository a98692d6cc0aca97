"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import base64
import collections
import hashlib
import os
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lakevault.llm import (
    bktree,
    bpe,
    chat_format,
    components,
    decontaminate,
    lm_scoring,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    url_filters,
    warc,
)
from lakevault.llm.storage import new_path

FORM = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "one two three four five six seven eight nine ten eleven. " * 20_000
TEXTS = [None, "", " \n\t ", "word", "Word", "one two three four", "one two three four",
         "\ud7ff é 日本 🙂 mixed", "trailing blank ", " leading", "two  blanks", LONG, LONG]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[5], (None, "no id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, FORM)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], FORM)


@pytest.fixture(scope="module")
def clashing(spark):
    """Columns that bear names used inside operators."""
    names = ("fp key row_number h hits row rid t m quality verdict chunk numbers order ids c0 "
             "n_tokens found component label x held_out").split()
    rows = [(i, t, "en", "s", 1, *["v"] * len(names)) for i, t in enumerate(TEXTS[3:8])]
    return spark.createDataFrame(rows, FORM + "".join(f", {n} string" for n in names))


def coder():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                    mergeable_ranks=ranks, special_tokens={})


# quality rules

def test_rules_on_odd_rows(docs, none, clashing):
    rows = quality_rules.measure(docs).select("text", "quality.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        w = (r["text"] or "").encode().split()
        assert r["n_words"] == len(w)
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        assert r["base_failed"] == (len(w) < 10 or r["n_repeat_words"] * 100 > 20 * len(w))
    assert [r["n_repeat_words"] for r in rows if r["text"] == LONG] == [220_000] * 2
    assert quality_rules.keep(none).count() == 0
    assert quality_rules.keep(clashing).columns == clashing.columns
    assert quality_rules.keep(docs, table=(), base=()).count() == docs.count()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=8))
def test_repeated_words(spark, lists):
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lists)],
                                 "i int, text string")
    got = dict(quality_rules.measure(rows).select("i", "quality.n_repeat_words").collect())
    for i, w in enumerate(lists):
        runs = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        covered = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
        assert got[i] == len(covered)


# SimHash near-duplicates

def test_near_duplicates_on_odd_rows(docs, none):
    rows = simhash_dedup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["key"], set()).add((r["fp"] & (1 << 64) - 1, r["component"]))
    for i, t in enumerate(TEXTS):
        assert {p for p, _ in by[i]} == {brute.fingerprint(t)}
    assert by[0] | by[1] | by[2] == {(0, 0)}
    assert {c for _, c in by[6]} == {5} and {c for _, c in by[12]} == {11}
    assert {c for _, c in by[None]} == {0, None}
    assert simhash_dedup.near_duplicates(none).count() == 0


def test_keep_one(docs, none, clashing):
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [
        *((False, i) for i in (0, 3, 5, 7, 8, 9, 10, 11)), (True, None)]
    assert simhash_dedup.keep_one(none).count() == 0
    assert simhash_dedup.keep_one(clashing).columns == clashing.columns


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1), min_size=1, max_size=60),
       st.integers(0, 40))
def test_tree_finds_what_a_scan_finds(points, radius):
    points = list(points)
    tree = bktree.Tree(points, *bktree.build(points))
    for p in points[:5]:
        near = {q for q in points if ((p ^ q) & (1 << 64) - 1).bit_count() <= radius}
        assert set(tree.within(p, radius)) == near


def test_links_in_small_parts_and_components(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(63) for _ in range(40)]
    points = set(base)
    for p in base:  # dense groups: shards of many parts
        points |= {p ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(30)}
    points = sorted(points)
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    got = sorted(tuple(r) for r in simhash_dedup.links(df, part=4).collect())
    want = sorted((b, a) for i, a in enumerate(points) for b in points[i + 1:]
                  if (a ^ b).bit_count() <= 2)
    assert got == want
    assert simhash_dedup.links(df, radius=0).count() == 0
    root = dict(components.roots(spark.createDataFrame(got, "u long, v long")).collect())
    assert [root.get(p, p) for p in points] == brute.components(points, points)


def test_components_of_a_long_path_and_of_nothing(spark):
    path = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    assert set(r["v"] for r in components.roots(path).collect()) == {0}
    assert components.roots(path.filter("u < 0")).count() == 0


# decontamination

def test_leaks_on_odd_rows(spark, docs, none, clashing):
    item = "the quick brown fox jumps over the lazy dog near the old stone bridge at noon today"
    items = spark.createDataFrame([
        (1, item), (1, item), (2, None), (3, ""), (4, "!!"), (5, "word"), (None, "no id"),
        (6, "one two three four")], "item_id long, text string")
    texts = [
        item, item.upper().replace(" ", ", "), "x " + item + " y", item + " " + item,
        item.replace("at noon today", "at noon"), item.replace("lazy dog", "cat"),
        "well " + item.replace("quick", "quick quick")]
    more = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(texts)], FORM)
    every = docs.union(more).union(more.limit(1))
    found = decontaminate.leaks(every, items).collect()
    pairs = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    want = brute.leaks([(r[0], r[1]) for r in every.collect() if r[0] is not None],
                       [(1, item), (5, "word"), (6, "one two three four")])
    assert {k: v for k, v in pairs.items() if None not in k} == pytest.approx(want)
    assert sum(r["doc_id"] == 100 and r["item_id"] == 1 for r in found) == 4  # repeated rows
    assert (None, None) in pairs
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(docs, items.filter("item_id > 99")).count() == 0
    clean = decontaminate.keep_clean(every, items)
    assert clean.columns == docs.columns
    left = [r["doc_id"] for r in clean.collect()]
    gone = {d for d, _ in want} | {None}
    assert sorted(d for d in left if d is not None) == sorted(
        r[0] for r in every.collect() if r[0] not in gone)
    assert decontaminate.keep_clean(clashing, items).columns == clashing.columns
    assert decontaminate.keep_clean(none, items).count() == 0
    assert decontaminate.keep_clean(docs, items.limit(0)).count() == docs.count()


def test_leaks_of_long_and_repetitive_items(spark):
    """Items that lost their last ninth, one word repeated or many words: similarity 0.8."""
    rng = random.Random(3)

    def some(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    items, docs = [], []
    for i in range(40):
        n = (13, 49, 94, 184)[i % 4]
        lost = (n - 4) // 9
        head = some(n - lost)
        items.append((i, " ".join(head + (some(lost) if i < 8 else ["same"] * lost))))
        docs.append((i, " ".join(some(5) + head + some(lost + 5))))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.leaks(docs, items)
    assert len(want) == 40
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == pytest.approx(want)


# pseudonyms

def test_pseudonyms_keep_formats(spark, docs, none, clashing):
    cases = {
        "card 4111 1111 1111 1111, 378282246310005": "card", "4111 1111 1111 1112": None,
        "1234567890123456": None, "on 2024-02-29.": "date", "2023-02-29": None, "31/12/1999": "date",
        "12/31/1999": "date", "2150-01-01": None, "078-05-1120": "ssn", "666-05-1120": None,
        "10.0.0.1": "ip", "10.0.0.256": None, "1.2.3.4.5": None, "v1.2.3": None,
        "+1 (017) 555-7713": "phone", "(743)555-3824": "phone", "743-555-3824": "phone",
        "É.ñ-1@mail.example.org!": "email", "a@b": None, "token 04DBEBAB91AB85687D33EEAAF9AC699E": "secret",
        "a" * 40: None}
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, text string")
    for r in pii.pseudonymise(rows, "key", found="found").collect():
        text, kind = list(cases.items())[r["i"]]
        assert (r["text"] != text) == (kind is not None), text
        assert set(r["found"]) == ({kind} if kind else set()), text
        if kind not in (None, "email", "secret"):
            shape = str.maketrans("123456789", "0" * 9)
            assert kind == "ip" or r["text"].translate(shape) == text.translate(shape)
    odd = pii.pseudonymise(docs, "key")
    assert odd.columns == docs.columns
    assert sorted(map(str, odd.collect())) == sorted(map(str, docs.collect()))
    assert pii.pseudonymise(none, "key").count() == 0
    made = pii.pseudonymise(clashing, "key")
    assert made.columns == clashing.columns


def test_feistel_is_the_permutation_it_says(spark):
    a, b = 7, 30
    rows = spark.range(a * b).select(F.floor(F.col("id") / b).alias("x"), (F.col("id") % b).alias("y"))
    there = pii.feistel(F.col("x"), F.col("y"), F.lit(a), F.lit(b), "k", "t")
    back = pii.feistel(F.col("s.x"), F.col("s.y"), F.lit(a), F.lit(b), "k", "t", back=True)
    got = rows.withColumn("s", there).withColumn("r", back).collect()
    assert {(r["s"]["x"], r["s"]["y"]) for r in got} == {(x, y) for x in range(a) for y in range(b)}
    for r in got:
        assert (r["s"]["x"], r["s"]["y"]) == brute.permuted(r["x"], r["y"], a, b, "k", "t")
        assert (r["r"]["x"], r["r"]["y"]) == (r["x"], r["y"])


def test_digit_strings_and_cards_are_permuted(spark):
    digits = [f"{i:03d}" for i in range(1000)]
    rows = spark.createDataFrame([(d,) for d in digits], "d string")
    made = [r[0] for r in rows.select(pii.permuted_digits(F.col("d"), "k", "t")).collect()]
    assert sorted(made) == digits and made != digits
    cards = [c for c in (f"411111111111{i:04d}" for i in range(400)) if brute.luhn(c)]
    rows = spark.createDataFrame([(c,) for c in cards], "text string")
    made = [r[0] for r in pii.pseudonymise(rows, "k").collect()]
    assert all(map(brute.luhn, made)) and len(set(made)) == len(cards) and len(made[0]) == 16


# byte-level BPE

def test_bpe_on_odd_rows(spark, docs, none, clashing):
    ranks, enc = coder()
    pattern = public_tokenizers.PATTERN
    for size in (bpe.CHUNK, 10):
        rows = bpe.encode(docs, ranks, pattern, carry=["doc_id", "text"], chunk=size)
        rows = rows.withColumn("back", bpe.decode(spark, F.col("ids"), ranks)).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert np.frombuffer(r["ids"], "<u4").tolist() == enc.encode_ordinary(r["text"] or "")
            assert bytes(r["back"]).decode() == (r["text"] or "")
    assert bpe.encode(none, ranks, pattern).count() == 0
    made = bpe.encode(clashing, ranks, pattern, out=("n1", "ids1"))
    assert made.columns == [*clashing.columns, "n1", "ids1"] and made.count() == clashing.count()
    odd = spark.createDataFrame([(np.array([1 << 20], "<u4").tobytes(),), (None,)], "ids binary")
    assert [r[0] for r in odd.select(bpe.decode(spark, F.col("ids"), ranks)).collect()] == [None, None]


def test_bpe_of_chunks_of_the_same_words(spark):
    ranks, enc = coder()
    texts = ["one two two three", "one two three three three", "one two three", "one two two three"]
    rows = spark.createDataFrame(spark.sparkContext.parallelize(
        list(enumerate(texts)), len(texts)), "doc_id long, text string")
    for docs in (rows, rows.coalesce(1)):  # a chunk in each partition; all of them in one
        made = bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk=10).collect()
        assert sorted(r["doc_id"] for r in made) == [0, 1, 2, 3]
        for r in made:
            assert np.frombuffer(r["ids"], "<u4").tolist() == enc.encode_ordinary(r["text"])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x1c\x85\u3000ab'sé1!日\u0301", max_size=12) | st.text(max_size=12))
def test_words_make_whole_pre_tokens(text):
    import regex
    _, enc = CODER
    text = text.encode("utf-8", "ignore").decode()
    keys = [k for some in bpe.words(text, regex.compile(public_tokenizers.PATTERN)) for k in some]
    assert "".join(map(bpe.spelled, keys)) == text
    assert [i for k in keys for i in enc.encode_ordinary(bpe.spelled(k))] == enc.encode_ordinary(text)


CODER = coder()


@given(st.lists(st.lists(st.integers(0, (1 << 35) - 1), max_size=9), min_size=1, max_size=9))
def test_packing(lists):
    flat = [v for part in lists for v in part]
    parts = packing.pack_parts(flat, np.cumsum([len(p) for p in lists]))
    assert [p.tolist() for p in packing.unpack_parts(parts)] == lists
    assert b"".join(parts) == packing.pack(flat)


def test_ranks_of_a_file(tmp_path):
    (tmp_path / "v").write_bytes(base64.b64encode(b"ab") + b" 7\n")
    assert bpe.load_ranks(str(tmp_path / "v")) == {b"ab": 7}


# language model

def test_lm_on_odd_rows(docs, none):
    for size in (lm_scoring.CHUNK, 10):
        rows = lm_scoring.score(docs, F.col("doc_id") == 4, chunk=size).collect()
        assert len(rows) == docs.count()
        assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
        assert sum(r["held_out"] for r in rows) == 1
        assert all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    assert lm_scoring.score(none, F.lit(False)).count() == 0
    all_out = lm_scoring.score(docs, F.lit(True)).collect()
    assert {(r["base_score"], r["n_known"], r["train_tokens"]) for r in all_out} == {(0.0, 0, 0)}
    assert {r["score"] for r in all_out} == {0.0}  # no state, so that of the base


def test_base_of_chunks_of_the_same_words(spark):
    texts = ["a b b", "a b", "a b b", "b a a a c", "a b b b b", "b a", "c c a b", "x a b", "a b b"]
    rows = spark.createDataFrame(spark.sparkContext.parallelize(
        list(enumerate(texts)), len(texts)), "doc_id long, text string")
    known = collections.Counter(w for i, t in enumerate(texts) if i != 7 for w in t.split())
    trained = sum(known.values()) + len(texts) - 1
    for docs in (rows, rows.coalesce(1)):
        made = lm_scoring.score(docs, F.col("doc_id") == 7, chunk=3).collect()
        assert sorted(r["doc_id"] for r in made) == list(range(len(texts)))
        for r in made:
            counts = [len(texts) - 1, *(known[w] for w in texts[r["doc_id"]].split())]
            assert (r["n_known"], r["train_tokens"]) == (sum(map(bool, counts)), trained)
            assert r["base_score"] == pytest.approx(sum(
                np.log10((n + 1) / (trained + len(known) + 2)) for n in counts))


@pytest.mark.parametrize("least_count, least_gain, weight, chunk", [
    (2, 0.1, 1.0, 40), (2, 0.1, 1.0, 1 << 20), (4, 2.0, 0.5, 200), (3, 1.0, 3.0, 1)])
def test_tree_against_dictionaries(spark, least_count, least_gain, weight, chunk):
    rng = random.Random(least_count)
    passage = "the cat sat on the mat and the dog sat on the log".split()
    texts = [" ".join(rng.choice("a b c d e".split()) for _ in range(rng.randrange(12))) for _ in range(40)]
    texts += [" ".join(passage[rng.randrange(4):rng.randrange(6, 13)]) for _ in range(25)]
    texts += [None, "", "A b A b A b A b", "new words alone", "a new b"] + ["a b a b c"] * 6
    out = {3, 45, 60, 66, 69, 70}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows.write.mode("overwrite").parquet(path := new_path(spark, "texts"))
    model = lm_scoring.learn(spark.read.parquet(path), F.col("doc_id").isin(out), chunk=chunk,
                             least_count=least_count, least_gain=least_gain, weight=weight)
    scores, levels = brute.suffix_tree([(t, i not in out) for i, t in enumerate(texts)],
                                       least_count, least_gain, weight)
    got = {r["doc_id"]: r["score"] for r in model.scores.collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(scores, rel=1e-9)
    counted = collections.Counter(r["level"] for r in model.states.collect())
    assert [counted[k + 1] for k in range(len(levels))] == levels and len(counted) == len(levels)
    assert len(levels) > 1


def test_more_text_has_more_states_and_longer_ones(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    after = {w: rng.sample(words, 3) for w in words}

    def text():
        at = [rng.choice(words)]
        for _ in range(30):
            at.append(rng.choice(after[at[-1]]))
        return " ".join(at)

    found = []
    for n in (20, 200):
        rows = spark.createDataFrame([(i, text()) for i in range(n)], "doc_id long, text string")
        model = lm_scoring.learn(rows, F.col("doc_id") % 5 == 0)
        sums = model.scores.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        found.append((model.states.count(), sums[0] > sums[1]))
    assert found[1][0] >= 2 * found[0][0] > 0 and found[0][1] and found[1][1]


# classifier

def test_classifier_on_odd_rows(spark, docs, none, clashing):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(13)] + [(3, 0), (None, 1), (7, None)], "doc_id long, quality int")
    rows = quality_classifier.classify(docs, labels, F.lit(False)).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    one = quality_classifier.classify(docs, labels.filter("quality = 1"), F.lit(False)).collect()
    assert {r["score"] for r in one} == {1.0}
    without = quality_classifier.classify(docs, labels, F.lit(True)).collect()
    assert {(r["score"], r["predicted"], r["held_out"]) for r in without} == {(0.5, 1, True)}
    assert quality_classifier.classify(none, labels, F.lit(False)).count() == 0
    assert quality_classifier.classify(clashing, labels, F.lit(False)).count() == clashing.count()


def test_scores_do_not_depend_on_other_columns(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = F.col("doc_id") % 3 == 1
    first = dict(quality_classifier.classify(rows, labels, out).select("doc_id", "score").collect())
    other = rows.withColumn("source", F.lit("x")).withColumn("lang", F.lit(None).cast("string"))
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = dict(quality_classifier.classify(other, flipped, out).select("doc_id", "score").collect())
    assert again == pytest.approx(first, abs=1e-6)


# conversations

TURN = st.tuples(st.sampled_from(["user", "assistant", "assistant", "a\nb\\n", ""]),
                 st.text(alphabet="\\#</turn>\n é日🙂ax", max_size=25) | st.just("### user\n</turn>\n"))


@settings(max_examples=150, deadline=None)
@given(st.lists(TURN, max_size=6))
def test_template_is_reversible(turns):
    text, spans = chat_format.render(turns)
    assert chat_format.read_turns(text) == turns
    assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


def test_conversations_on_odd_rows(spark):
    form = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"), (1, 1, "assistant", "b", "x"),
            (2, None, None, None, None), (None, 0, "assistant", "🙂 né ### x\\", None),
            (3, 0, "assistant", "", None), (4, 0, "assistant", "y " * 50_000, None)]
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        json = f.read()
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(
        spark.createDataFrame(rows, form), json)).collect()}
    turns = {k: [tuple(t) for t in r["turns"]] for k, r in back.items()}
    assert turns == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], 2: [("", "")],
                     None: [("assistant", "🙂 né ### x\\")], 3: [("assistant", "")],
                     4: [("assistant", "y " * 50_000)]}
    assert {k: r["loss_text"] for k, r in back.items()} == {
        1: "bb", 2: "", None: "🙂 né ### x\\", 3: "", 4: "y " * 50_000}
    empty = spark.createDataFrame([], form)
    assert chat_format.read_back(chat_format.format_conversations(empty, json)).count() == 0


# address lists

def test_lists_over_time(spark):
    entries = spark.createDataFrame([
        ("domain", "Example.com", "add", "2024-01-10"), ("domain", "example.com", "remove", "2024-01-20"),
        ("domain", "example.com", "add", "2024-02-01"), ("domain", "sub.example.com", "add", "2024-01-15"),
        ("domain", "tie.org", "add", "2024-01-01"), ("domain", "tie.org", "remove", "2024-01-01"),
        ("domain", "tie.org", "add", "2024-01-01"), ("url", "http://x.org/a#frag", "add", "2024-01-05"),
        ("domain", None, "add", "2024-01-01"), ("domain", "null.org", "add", None)],
        "kind string, value string, action string, day string")
    cases = [
        ("http://example.com/", "2024-01-09", 0), ("http://example.com/", "2024-01-10", 1),
        ("http://u@EXAMPLE.com.:80/x", "2024-01-19", 1), ("http://example.com/", "2024-01-20", 0),
        ("https://a.sub.example.com?q", "2024-01-16", 2), ("https://a.sub.example.com", "2024-01-25", 1),
        ("http://notexample.com/", "2024-01-15", 0), ("http://tie.org", "2024-01-02", 0),
        ("http://x.org/a", "2024-01-05", 1), ("http://x.org/a#b", "2024-06-05", 1),
        ("http://x.org/A", "2024-06-05", 0), ("no address", "2024-06-05", 0), (None, "2024-06-05", 0),
        ("http://example.com/", None, 0), ("http://null.org/", "2024-06-05", 0),
        ("http://" + "a." * 200 + "example.com/", "2024-01-15", 0),
        ("http://example.com/", "2024-01-10", 1)]
    rows = spark.createDataFrame([(i, u, d, "v") for i, (u, d, _) in enumerate(cases)],
                                 "row int, url string, day string, host string")
    got = url_filters.judge(rows, entries)
    assert got.columns == [*rows.columns, "verdict"]
    assert {r["row"]: r["verdict"]["n_active"] for r in got.collect()} == {
        i: n for i, (_, _, n) in enumerate(cases)}
    best = next(r["verdict"] for r in got.collect() if r["row"] == 4)
    assert best["domain"] == "sub.example.com" and str(best["since"]) == "2024-01-15"
    assert not any(r["verdict"]["blocked"] for r in url_filters.judge(rows, entries.limit(0)).collect())
    assert url_filters.judge(rows.limit(0), entries).count() == 0


# archives

def test_archives_on_odd_rows(spark):
    big = "x" * 999 + "é"
    nested = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 30
    pages = [(1, "http://a/", big), (3, "http://a/\r\nX: y", big), (2, None, big), (4, "u", None),
             (5, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", nested), (9, "u", nested),
             (None, "u", "z" * 2000), (None, "u", big), (3, "again", big)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "size", F.lit(1)).withColumn("key", F.lit("k"))
    for compression in ("gzip", "none"):
        path = new_path(spark, "warc")
        warc.write(rows, path, "2024-01-01T00:00:00Z", records_per_file=2, compression=compression)
        got = warc.resolve_revisits(warc.read_headers(spark, path)).collect()
        assert len(got) == len(pages)
        found = sorted((r["page_id"] or "", r["record_type"], r["refers_to"] or "",
                        r["payload_bytes"], r["payload_sha1"]) for r in got)
        want = []
        for i, _, html in pages:
            data = (html or "").encode()
            original = {big: 3, nested: 9}.get(html)
            revisit = original is not None and i != original
            want.append((str(i or ""), "revisit" if revisit else "response",
                         str(original) if revisit else "", len(data), hashlib.sha1(data).hexdigest()))
        assert found == sorted(want)
        assert {r["url"] for r in got if r["page_id"] == "3"} == {"http://a/%0D%0AX:%20y", "again"}
    path = new_path(spark, "warc")
    warc.write(rows.limit(0), path, "2024-01-01T00:00:00Z")
    assert warc.read_headers(spark, path).count() == 0


def test_records_zipped_one_by_one(spark, tmp_path):
    import gzip
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:%d>\r\n" \
             b"Content-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record % i) for i in range(3)))
    got = warc.read_headers(spark, str(tmp_path)).collect()
    assert [(r["page_id"], r["payload_bytes"]) for r in got] == [("0", 4), ("1", 4), ("2", 4)]
    (tmp_path / "b.warc").write_bytes((record % 9)[:-20])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_headers(spark, str(tmp_path)).collect()


# pipeline

def test_pipeline_on_odd_rows(spark, docs, none, tmp_path):
    for name, table in (("odd", docs), ("none", none)):
        folder = os.path.join(tmp_path, name)
        table.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(
            f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).columns == [
            "doc_id", "lang", "source", "n_tokens", "ids"]
