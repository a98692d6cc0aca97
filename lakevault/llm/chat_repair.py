"""Repair of conversation structure: what is wrong with each, and the cheapest edits that mend it.

``audit_dp`` finds the edits of one run of rows. Around it, rows are range-partitioned by
(conversation, turn, ...), so that a task sees neighbours in order and a conversation of any length
is spread over as many tasks as its rows fill. A conversation that begins and ends inside one task
and below the limits of a run (``RUN_ROWS``, ``RUN_CHARS``) is solved there. Of the others, two a
task and the very long ones, each run is solved from every state to every state; the runs of a
conversation are joined by their costs and audits, without texts, and every run then renders its
own part. First occurrences of a (role, text) across runs are a grouping by digest.

A digest of a whole conversation can only be taken in order: ``digests`` streams the runs of a
split conversation through one task, a run at a time.

Rows of one turn are ordered by role, then by the first 64 characters of the text, then by its MD5.

Defined results: a null role or text counts as one space; rows with a null conversation are one
conversation, which comes first; null turns come first and count neither as gaps nor as turns;
a row marked ``absent`` only keeps its conversation in the result; a conversation without rows has
zeros, an empty audit and no repaired turns; repeated rows are rows; an empty table gives an empty
result. Other columns are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm import audit_dp
from lakevault.llm.storage import stored

RUN_ROWS, RUN_CHARS = 4096, 8 << 20
BLANKS = " \t\n\v\f\r"
ENDINGS = ".!?"
LEGAL = ("su", "ua", "au")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURNS = "array<struct<role string, text string>>"
_ROWS = "array<struct<turn long, role string, text string>>"


class Repair(NamedTuple):
    """``summary``: a row for each conversation with its counts, cost, audit and, unless it was
    split, its repaired turns. ``pieces``: (key, run, repaired) of the split ones, in order of run."""

    summary: DataFrame
    pieces: DataFrame


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(key, turn, role, text, absent): rows harmed in ways that the checksum of `key:turn` draws:
    one of twenty is dropped (here marked absent), emptied, stripped of its sentence ends,
    repeated, given to the user."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    drawn = F.crc32(F.concat(spaced(key), F.lit(":"), spaced(turn)).cast("binary")) % 20
    body = spaced(text)
    made = rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.when(drawn == 4, F.lit("user")).otherwise(spaced(role)).alias("role"),
        F.when(drawn == 1, F.lit("")).when(
            drawn == 2, F.regexp_replace(body, r"[.!?]", "")).otherwise(body).alias("text"),
        (drawn == 0).alias("absent"),
        F.explode(F.when(drawn == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return made.drop("col")


def _judge(rows: list[dict], known: list[bool] | None) -> tuple[list[tuple], dict]:
    """What the edits need to know of each row, and the counts of a run. ``known`` tells which rows
    were seen before; without it the run is the whole conversation."""
    seen, out = set(), []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    before = None
    for i, row in enumerate(rows):
        body, pair = row["text"].strip(BLANKS), (row["role"], row["text"])
        again = pair in seen if known is None else known[i]
        seen.add(pair)
        fault = ("blank" if not body else "duplicate" if again
                 else "truncated" if body[-1] not in ENDINGS else None)
        if fault:
            counts[fault] += 1
        initial = row["role"][:1]
        counts["illegal"] += before is not None and before + initial not in LEGAL
        before = initial
        out.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    counts |= {"least": min(turns, default=None), "most": max(turns, default=None),
               "turns": len(set(turns))}
    return out, counts


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def _solved(rows: list[dict]) -> dict:
    """A whole conversation."""
    judged, counts = _judge(rows, None)
    cost, audit = audit_dp.solve(judged)
    made = audit_dp.render([(r["role"], r["text"]) for r in rows], audit)
    return {k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {
        "gaps": _gaps(counts["least"], counts["most"], counts["turns"]), "cost": cost,
        "audit": audit, "repaired": [{"role": r, "text": t} for r, t in made]}


def _runs(form: pa.Schema, most_rows: int, most_chars: int):
    """Rows in order -> whole conversations solved, and runs of those that may go on elsewhere."""
    def run(batches):
        context = TaskContext.get()
        running = (context.partitionId() if context else 0) << 33
        out: list[dict] = []
        held: list[dict] = []
        chars, key, apart, begun = 0, None, True, False

        def made(whole: bool) -> dict:
            nonlocal running, held, chars
            running += 1
            row = {"key": key, "run": running, "whole": whole}
            row |= _solved(held) if whole else {"rows": held}
            held, chars = [], 0
            return row

        def flushed():
            nonlocal out
            batch, out = pa.RecordBatch.from_pylist(out, schema=form), []
            return batch

        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row["key"] != key:
                    if begun:
                        out.append(made(whole=not apart))
                        apart = False  # the task's first may have begun in the task before
                    key, begun = row["key"], True
                if row["absent"]:
                    continue
                held.append({k: row[k] for k in ("turn", "role", "text")})
                chars += len(row["text"])
                size += len(row["text"])
                if len(held) >= most_rows or chars >= most_chars:
                    out.append(made(whole=False))
                    apart = True
                if len(out) >= 2000 or size >= most_chars:
                    yield flushed()
                    size = 0
        if begun:
            out.append(made(whole=False))  # it may go on in the next task
        yield flushed()
    return run


def _transfers(form: pa.Schema):
    """Runs with the flags of their rows -> counts, ends, and the way from each state to each."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                rows = row["rows"]
                known = [f["again"] for f in sorted(row["flags"] or [], key=lambda f: f["at"])]
                if len(known) != len(rows):
                    raise ValueError("a run changed between two readings")
                judged, counts = _judge(rows, known)
                out.append({"key": row["key"], "run": row["run"], **counts, "size": len(rows),
                            "first": judged[0][0] if rows else None,
                            "last": judged[-1][0] if rows else None, "rows": rows, "ways": [
                                dict(zip(("begun", "ended", "cost", "letters"), w, strict=True))
                                for w in audit_dp.transfer(judged)]})
            yield pa.RecordBatch.from_pylist(out, schema=form)
    return run


def _joined(form: pa.Schema):
    """The runs of a conversation -> its counts, cost and audit, and each run's part of the audit."""
    def run(table: pa.Table) -> pa.Table:
        runs = sorted(table.to_pylist(), key=lambda r: r["run"])
        full = [r for r in runs if r["size"]]
        total = {k: sum(r[k] for r in full) for k in ("blank", "duplicate", "truncated", "illegal")}
        total["illegal"] += sum(a["last"] + b["first"] not in LEGAL
                                for a, b in zip(full, full[1:], strict=False))
        dated = [r for r in full if r["turns"]]
        turns = sum(r["turns"] for r in dated) - sum(
            a["most"] == b["least"] for a, b in zip(dated, dated[1:], strict=False))
        cost, pieces = audit_dp.join([
            [(w["begun"], w["ended"], w["cost"], w["letters"]) for w in r["ways"]] for r in full])
        *pieces, (_, tail) = pieces
        if pieces:  # what is put in at the end belongs to the last run
            pieces[-1] = (pieces[-1][0], pieces[-1][1] + tail)
        row = total | {
            "key": runs[0]["key"], "cost": cost, "audit": "".join(letters for _, letters in pieces),
            "gaps": _gaps(dated[0]["least"], dated[-1]["most"], turns) if dated else 0,
            "parts": [{"run": r["run"], "begun": begun, "letters": letters}
                      for r, (begun, letters) in zip(full, pieces, strict=True)]}
        return pa.Table.from_pylist([row], schema=form)
    return run


def _rendered(form: pa.Schema):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([
                {"key": r["key"], "run": r["run"], "repaired": [
                    {"role": role, "text": text} for role, text in audit_dp.render(
                        [(x["role"], x["text"]) for x in r["rows"]], r["letters"], r["begun"])]}
                for r in batch.to_pylist()], schema=form)
    return run


def _arrow(spark, form: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], form).schema)


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", absent: str | None = None, run_rows: int = RUN_ROWS,
           run_chars: int = RUN_CHARS) -> Repair:
    """The repair of every conversation of ``rows``."""
    spark = rows.sparkSession

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    rows = rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").cast("long").alias("turn"),
        spaced(role).alias("role"), spaced(text).alias("text"),
        (F.col(f"`{absent}`") if absent else F.lit(False)).alias("absent"))
    kind = rows.schema["key"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    order = [F.col("key").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
             F.substring("text", 1, 64), F.md5(F.col("text").cast("binary")), F.col("row")]
    placed = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        *order).sortWithinPartitions(*order).drop("row")
    form = f"key {kind}, run long, whole boolean, {counts}, audit string, repaired {_TURNS}, rows {_ROWS}"
    runs = stored(placed.mapInArrow(_runs(_arrow(spark, form), run_rows, run_chars), form), "turns")

    split = runs.filter("not whole").select("key", "run", "rows")
    each = split.select("key", "run", F.posexplode("rows").alias("at", "r")).select(
        "key", "run", "at", F.sha2(F.concat(F.md5(F.col("r.role").cast("binary")), F.sha2(
            F.col("r.text").cast("binary"), 256)).cast("binary"), 256).alias("told"))
    first = each.groupBy("key", "told").agg(F.min(F.struct("run", "at")).alias("first")).select(
        F.col("key").alias("k"), F.col("told").alias("d"), "first")
    flags = each.join(first, F.col("key").eqNullSafe(F.col("k")) & (F.col("told") == F.col("d"))).select(
        "run", F.struct("at", (F.struct("run", "at") != F.col("first")).alias("again")).alias("flag")
    ).groupBy("run").agg(F.collect_list("flag").alias("flags"))  # as many as a run has rows
    form = (f"key {kind}, run long, size long, first string, last string, least long, most long, "
            "turns long, blank long, duplicate long, truncated long, illegal long, "
            f"rows {_ROWS}, ways array<struct<begun int, ended int, cost long, letters string>>")
    solved = stored(split.join(flags, "run", "left").select("key", "run", "rows", "flags").mapInArrow(
        _transfers(_arrow(spark, form)), form), "runs")
    form = (f"key {kind}, {counts}, audit string, "
            "parts array<struct<run long, begun int, letters string>>")
    joined = stored(solved.drop("rows").groupBy("key").applyInArrow(
        _joined(_arrow(spark, form)), form), "audits")
    parts = joined.select(F.explode("parts").alias("p")).select("p.*")
    form = f"key {kind}, run long, repaired {_TURNS}"
    pieces = solved.select("key", "run", "rows").join(parts, "run").select(
        "key", "run", "rows", "begun", "letters").mapInArrow(_rendered(_arrow(spark, form)), form)
    shown = [F.col("key").alias(key), *COUNTS, "audit"]
    summary = runs.filter("whole").select(*shown, "repaired").union(
        joined.select(*shown, F.lit(None).cast(_TURNS)))
    return Repair(summary, pieces.withColumnRenamed("key", key))


def told(turns: Column) -> Column:
    """Turns as one text: `role:text`, joined by line feeds."""
    return F.array_join(F.transform(
        turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _streamed(batches):
    """Pieces in order of (key, run) -> SHA-256 of each key's text, held a piece at a time."""
    key, state, begun, empty = None, None, False, True
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if not begun or row["key"] != key:
                if begun:
                    out.append((key, state.hexdigest()))
                key, state, begun, empty = row["key"], hashlib.sha256(), True, True
            if row["n"]:
                state.update((row["text"] if empty else "\n" + row["text"]).encode())
                empty = False
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], batch.schema.field("key").type),
             pa.array([d for _, d in out], pa.string())], names=["key", "digest"])
    if begun:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], batch.schema.field("key").type), pa.array([state.hexdigest()])],
            names=["key", "digest"])


def digests(made: Repair, key: str = "conv_id") -> DataFrame:
    """The summary with ``repaired_sha256``, the lowercase hexadecimal digest of the repaired text."""
    kind = made.pieces.schema[key].dataType.simpleString()
    split = made.pieces.select(
        F.col(f"`{key}`").alias("key"), "run", F.size("repaired").alias("n"),
        told(F.col("repaired")).alias("text")).repartition("key").sortWithinPartitions(
        "key", "run").mapInArrow(_streamed, f"key {kind}, digest string").select(
        F.col("key").alias("of"), "digest")
    whole = F.when(F.col("repaired").isNotNull(), F.sha2(told(F.col("repaired")).cast("binary"), 256))
    return made.summary.join(split, F.col(f"`{key}`").eqNullSafe(F.col("of")), "left").withColumn(
        "repaired_sha256", F.coalesce(whole, "digest", F.sha2(F.lit("").cast("binary"), 256))).drop(
        "of", "digest")
