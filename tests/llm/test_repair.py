"""Repairs against plain enumeration, split conversations against whole ones, odd input."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakevault.llm import audit_dp, chat_repair
from lakevault.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FORM = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def enumerated(rows):
    """Cheapest and least audit of a few rows, over every sequence of edits."""
    best = None
    edits = [["D"] if must_go else ["D", "K", "Ru", "Ra"] for _, must_go, _ in rows]
    gaps = [p for k in range(3) for p in itertools.product("ua", repeat=k)]
    for chosen in itertools.product(*edits):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            cost, roles, audit = 0, "", ""
            for i, letters in enumerate(inserted):
                roles, audit, cost = roles + "".join(letters), audit + "I" * len(letters), cost + 2 * len(letters)
                if i < len(rows):
                    e, (initial, _, truncated) = chosen[i], rows[i]
                    audit += e[0]
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (truncated and e != "D")
                    roles += "" if e == "D" else initial if e == "K" else e[1]
            if SHAPE.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def plain(rows):
    """(cost, audit) by a table of copied strings."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}

    def closed(best):
        while True:
            new = dict(best)
            for s, (c, a) in best.items():
                for r, t in after[s].items():
                    if r != "s":
                        new[t] = min(new.get(t, (c + 2, a + "I")), (c + 2, a + "I"))
            if new == best:
                return best
            best = new

    for initial, must_go, truncated in rows:
        best, new = closed(best), {}
        for s, (c, a) in best.items():
            offers = [(s, c + 3, a + "D")]
            if not must_go:
                offers += [(t, c + truncated, a + "K") for r, t in after[s].items() if r == initial]
                offers += [(t, c + 2 + truncated, a + "R") for r, t in after[s].items() if r != "s"]
            for t, cost, audit in offers:
                new[t] = min(new.get(t, (cost, audit)), (cost, audit))
        best = new
    return min(best_of for s, best_of in closed(best).items() if s in ("", "a"))


def expected(rows):
    """The whole contract on (conv_id, turn, role, text) rows, in plain Python."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        made = (turn, "user" if code == 4 else role, text)
        convs[conv] += [] if code == 0 else [made] * (2 if code == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64],
                                hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen, judged = collections.Counter(), set(), []
        for _, role, text in own:
            body = text.strip(" \t\n\v\f\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {r[0] for r in own} - {None}
        cost, audit = plain(judged)
        told, state, given_ = [], "", iter(own)
        for letter in audit:
            want = "assistant" if state == "u" else "user"
            if letter == "I":
                told.append((want, ""))
                state = want[0]
                continue
            _, role, text = next(given_)
            if letter != "D":
                told.append((want if letter == "R" else role, text))
                state = told[-1][0][0]
        assert SHAPE.fullmatch("".join(r[0] for r, _ in told))
        out[conv] = {
            "conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "blank": faults["blank"], "duplicate": faults["duplicate"],
            "truncated": faults["truncated"], "cost": cost, "audit": audit,
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au")
                           for a, b in zip(own, own[1:], strict=False)),
            "repaired_sha256": hashlib.sha256(
                "\n".join(f"{r}:{t}" for r, t in told).encode()).hexdigest()}
    return out


def repaired(spark, rows, **limits):
    harmed = chat_repair.damage(spark.createDataFrame(rows, FORM))
    made = chat_repair.repair(harmed, key="key", absent="absent", **limits)
    out = chat_repair.digests(made, "key").withColumnRenamed("key", "conv_id").drop("repaired").collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: r.asDict() for r in out}


ROWS = st.lists(st.tuples(st.sampled_from("suax "), st.booleans(), st.booleans()).map(
    lambda r: (r[0], r[1], r[2] and not r[1])))


@settings(max_examples=100, deadline=None)
@given(ROWS.map(lambda r: r[:2]))
def test_audits_against_every_sequence_of_edits(rows):
    assert audit_dp.solve(rows) == enumerated(rows) == plain(rows)


@settings(max_examples=300, deadline=None)
@given(ROWS)
def test_audits_against_copied_strings(rows):
    assert audit_dp.solve(rows) == plain(rows)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.integers(1, 4))
def test_joined_runs_equal_the_whole(rows, size):
    runs = [rows[a:a + size] for a in range(0, len(rows), size)]
    cost, pieces = audit_dp.join([audit_dp.transfer(r) for r in runs])
    assert (cost, "".join(letters for _, letters in pieces)) == audit_dp.solve(rows)
    turns = [(r[0], str(i)) for i, r in enumerate(rows)]
    whole = audit_dp.render(turns, audit_dp.solve(rows)[1])
    *pieces, (_, tail) = pieces
    if pieces:
        pieces[-1] = (pieces[-1][0], pieces[-1][1] + tail)
    split = [x for k, (state, letters) in enumerate(pieces)
             for x in audit_dp.render(turns[k * size:(k + 1) * size], letters, state)]
    assert split == whole


@given(st.lists(st.text("DIKR", max_size=40), min_size=2, max_size=6),
       st.sampled_from([2, 3, 7, audit_dp._PRIME]))
def test_order_of_audits_whatever_collides(strings, prime):
    audits = audit_dp.Audits(prime)
    nodes = [audits.extend(0, s) for s in strings]
    nodes += [audits.extend(n, "KD") for n in nodes]  # shared prefixes
    strings += [s + "KD" for s in strings]
    for (a, s), (b, t) in itertools.product(zip(nodes, strings, strict=True), repeat=2):
        assert audits.less(a, b) == (s < t)
    assert [audits.text(n) for n in nodes] == strings
    assert all(audits.text(audits.ancestor(n, d)) == s[:d]
               for n, s in zip(nodes, strings, strict=True) for d in range(len(s) + 1))


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_against_plain_python(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()
    got = {r["conv_id"]: r.asDict() for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert got == expected([tuple(r) for r in rows])


def odd_rows():
    rng = random.Random(5)
    said = ["Yes.", "No!", "what", "", None, " \n", "and then", "Good?  ", "."]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None, *range(12)]),
             rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(said))
            for _ in range(160)]
    rows += [(9, i, "user" if i % 2 else "assistant", "same words.") for i in range(60)]
    rows += [(10, i, "ua"[i % 2] + "x", f"long {'é ' * 20_000}{i}.") for i in range(8)]
    rows += [(c, t, "user", "hello") for c in range(100, 180) for t in (0,)]  # some lose every row
    return rows + rows[:20]


@pytest.mark.parametrize("limits", [{}, {"run_rows": 1}, {"run_rows": 3}, {"run_chars": 50}])
def test_odd_rows_however_split(spark, limits):
    rows = odd_rows()
    want = expected(rows)
    assert repaired(spark, rows, **limits) == want
    assert any(not r["audit"] for r in want.values())


def test_empty_table_and_clashing_names(spark):
    assert repaired(spark, []) == {}
    rows = [(1, 0, "user", "Hi.", "a", 1), (1, 1, "assistant", "Yes.", "b", 2)]
    df = spark.createDataFrame(rows, FORM + ", key string, run int")
    made = chat_repair.repair(df)
    (row,) = chat_repair.digests(made).collect()
    assert (row["conv_id"], row["audit"], row["cost"]) == (1, "KK", 0)
    assert row["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
