"""The registered queries over whole small tables, against SQL or plain Python."""

from __future__ import annotations

import collections
import hashlib
import math

import brute
import compare
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from lakevault.llm import bpe, quality_rules
from lakevault.llm.queries import QUERIES
from lakevault.llm.statements import ORACLES, quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]


def result(spark, name, sf_dir=SF_DIR):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def coder():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_registration():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, len(QUERIES) + 1)}
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = compare.connect(SF_DIR)
    assert compare.difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_classifier_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect())
    rows = result(spark, "op1_quality_classifier", sf_dir)
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (brute.fold(r["doc_id"], 3) == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    seen = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([s for q, s in seen if q == k] for k in (1, 0))
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.95
    assert np.mean([(s >= 0.5) == q for q, s in seen]) > 0.93


def test_bpe_as_the_library_encodes(spark, docs):
    rows = {r["doc_id"]: r for r in result(spark, "op4_byte_bpe")}
    assert len(rows) == len(docs)
    enc = coder()
    for doc_id, text in docs:
        ids = enc.encode_ordinary(text or "")
        row = rows[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_lm_base_and_score(spark, docs):
    rows = {r["doc_id"]: r for r in result(spark, "op5_lm_scoring")}
    counts, ends = collections.Counter(), 0
    for doc_id, text in docs:
        if brute.fold(doc_id, 7) != 2:
            counts.update(brute.words(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for doc_id, text in docs:
        w, row = brute.words(text), rows[doc_id]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10(
            (ends + 1) / (n + v + 1))
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (
            brute.fold(doc_id, 7) == 2, len(w) + 1, sum(x in counts for x in w) + 1, n)
        assert -math.inf < row["score"] < 0
    for held_out in (True, False):  # what was learned is likelier than the base, on unseen texts too
        mine = [r for r in rows.values() if r["held_out"] == held_out]
        assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)


def test_leaks_against_all_windows(spark, docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"]
             for r in result(spark, "op6_decontamination")}
    assert found == pytest.approx(brute.leaks(docs, [tuple(i) for i in items]))
    assert found


def test_pseudonyms_hide_and_link(spark, docs):
    import re
    rows = {r["doc_id"]: r for r in result(spark, "op8_pii_pseudonyms")}
    email = re.compile(r"[\w.]+@mail\w*\.example\.com", re.I)
    phone, ip = re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}"), re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}\b")
    number = re.compile(r"\b\d{16}\b")
    linked = {}
    for doc_id, text in docs:
        made = rows[doc_id]["text"]
        if not re.search("[0-9@]", text):
            assert made == text
            continue
        for kind in (email, phone, ip):
            assert not set(kind.findall(text)) & set(kind.findall(made))
        old, new = number.findall(text), number.findall(made)
        assert len(old) == len(new)
        for a, b in zip(old, new, strict=True):
            assert (a != b) == brute.luhn(a) and brute.luhn(a) == brute.luhn(b)
            assert linked.setdefault(a, b) == b
    assert len(set(linked.values())) == len(linked)


def test_near_duplicates_against_all_pairs(spark, docs):
    rows = {r["doc_id"]: r for r in result(spark, "op9_simhash_near_dedup")}
    keys, prints = [d for d, _ in docs], [brute.fingerprint(t) for _, t in docs]
    assert len(rows) == len(docs)
    for key, p, component in zip(keys, prints, brute.components(keys, prints), strict=True):
        assert rows[key] == {"doc_id": key, "fingerprint": f"{p:016x}", "component_id": component}


def test_pipeline_against_brute_force(spark):
    sf_dir = SF_DIR
    con = compare.connect(sf_dir)
    kept = con.execute(
        f"SELECT doc_id, text FROM ({quality()}) WHERE kept ORDER BY doc_id").fetchall()
    prints = [brute.fingerprint(t) for _, t in kept]
    roots = brute.components([d for d, _ in kept], prints)
    kept = [(d, t) for (d, t), c in zip(kept, roots, strict=True) if d == c]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    leaked = {d for d, _ in brute.leaks(kept, items)}
    kept = {d: t for d, t in kept if d not in leaked}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(kept)
    enc = coder()
    for doc_id, row in got.items():
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["n_tokens"]
        text = enc.decode_bytes(ids).decode()
        assert ids == enc.encode_ordinary(text)
        if not any(c.isdigit() or c == "@" for c in kept[doc_id]):
            assert text == kept[doc_id]


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_rules_name_what_failed(spark):
    rows = spark.createDataFrame([
        ("a a a a a a a a a a a a",), ("one two three four five six seven eight nine ten",),
        ("of*** to*** in*** is*** it*** be*** at*** or*** on*** as*** by***",),
        ("YES!! NO!! GO!! UP!! ON!! IN!! AT!! BY!! OF!! TO!!",)], "text string")
    got = [r["quality"] for r in quality_rules.measure(rows).collect()]
    assert [(q["base_failed"], q["kept"]) for q in got] == [
        (True, False), (False, True), (False, False), (False, False)]
    assert got[2]["failed"] == ["symbols"]
    assert got[3]["failed"] == ["exclamations"]
