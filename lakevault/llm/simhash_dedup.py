"""SimHash near-duplicates: BK-trees over shards of fingerprints that agree in one bit block.

``radius + 1`` blocks cover the 64 bits, so two fingerprints within the radius agree in one block
at least and meet in that block's shard. A shard is cut into parts of about ``PART`` fingerprints.
Each part's tree is built once, then sent to the query slices of its own shard only (part i asks
the trees 0..i): the broadcast is of proven size, whatever the data. Searches follow only edges
within the radius.

Only distinct fingerprints are linked: any number of copies is one point, and a point has at most
1 + 64 + 2016 others within two bits, so links stay in proportion to the points. Components come
from ``components.roots``.

Defined results: a null, empty or blank text has fingerprint zero, linked like any other; fewer
words than a shingle holds make one shingle; repeated rows are documents of their own with equal
fingerprints; null ids lose to any other id as the id of a component and stay null if alone; an
empty table gives an empty result. Columns of any name are carried by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm import bktree
from lakevault.llm.components import roots
from lakevault.llm.storage import cut, free_name, stored

SHINGLE = 3
RADIUS = 2
SEED = 42
PART = 2048
_BLOCK = 1 << 16


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text: bit set if it is in over half the shingles' hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    rows = zip(*(words[i:] for i in range(k)), strict=False)
    hashes = np.array([digest(b" ".join(r), SEED) for r in rows], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        some = hashes[at:at + _BLOCK]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text, shingle: int = SHINGLE):
    """Column of fingerprints."""
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([text_fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, T.LongType())(text)


def _masks(blocks: int) -> list[tuple[int, int]]:
    """First bit and bit mask of each block."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def _trees(batches):
    for batch in batches:
        made = [bktree.build(p) for p in batch.column("points").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("block", "value", "part", "parts", "points")]
            + [pa.array([m[k] for m in made], pa.list_(pa.int32())) for k in (0, 1)],
            names=["block", "value", "part", "parts", "points", "parents", "edges"])


def _search(radius: int):
    masks = [mask << first for first, mask in _masks(radius + 1)]

    def search(batches):
        for batch in batches:
            us, vs = [], []
            for row in batch.to_pylist():
                before = masks[:row["block"]]
                own = row["asked_by"] == row["part"]
                tree = bktree.Tree(row["points"], row["parents"], row["edges"])
                for q in row["queries"]:
                    for p in tree.within(q, radius):
                        # each pair once: from one side, in the first block it agrees in
                        if p != q and (p < q or not own) and all((p ^ q) & m for m in before):
                            us.append(max(p, q))
                            vs.append(min(p, q))
                    if len(us) >= _BLOCK:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
                        us, vs = [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return search


def links(points: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Distinct fingerprints (column fp) -> pairs (u, v) within the radius, each once, u > v. A
    radius of 0 links nothing but equal fingerprints, so there are no pairs."""
    if radius == 0:
        return points.limit(0).select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    blocks = [F.struct(F.lit(i).alias("block"),
                       F.shiftrightunsigned("fp", first).bitwiseAND(F.lit(mask)).alias("value"))
              for i, (first, mask) in enumerate(_masks(radius + 1))]
    keyed = points.select("fp", F.explode(F.array(*blocks)).alias("k")).select("k.*", "fp")
    parts = F.ceil(F.col("n") / part).cast("int")
    sizes = keyed.groupBy("block", "value").agg(F.count("*").alias("n")).filter("n > 1").select(
        "block", "value", parts.alias("parts"))
    shards = (
        keyed.join(sizes, ["block", "value"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("block", "value", "part", "parts").agg(F.collect_list("fp").alias("points")))
    trees = shards.mapInArrow(
        _trees, "block int, value long, part int, parts int, points array<long>, "
                "parents array<int>, edges array<int>")
    sent = trees.withColumn("asked_by", F.explode(F.sequence("part", F.col("parts") - 1)))
    slices = shards.select("block", "value", F.col("part").alias("asked_by"),
                           F.col("points").alias("queries"))
    return sent.join(slices, ["block", "value", "asked_by"]).mapInArrow(
        _search(radius), "u long, v long")


def components(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, key) rows -> (fp, component): the smallest key reachable over links, for each fp."""
    per_point = rows.groupBy("fp").agg(F.min("key").alias("key"))
    root = roots(links(rows.select("fp").distinct(), radius))
    known = per_point.join(root.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp",
                           "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("key").alias("component"))
    return known.join(least, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: (key, fp, component). Fingerprints are computed once and stored."""
    rows = cut(docs.select(F.col(f"`{key}`").alias("key"),
                           fingerprint(F.col(f"`{text}`"), shingle).alias("fp")))
    return rows.join(components(rows, radius), "fp").select("key", "fp", "component")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, one of each component: that of the smallest key, of
    several with that key any one. Rows are numbered in a stored table, so equal ids don't mix."""
    fp, n = free_name(docs.columns, "fp"), free_name(docs.columns, "row_number")
    kept = stored(docs.withColumn(fp, fingerprint(F.col(f"`{text}`"), shingle)).withColumn(
        n, F.monotonically_increasing_id()), "near_dedup")
    rows = kept.select(F.col(fp).alias("fp"), F.struct(
        F.col(f"`{key}`").isNull().alias("no_key"), F.col(f"`{key}`").alias("key"),
        F.col(n).alias("n")).alias("key"))
    first = components(rows, radius).select(F.col("component.n").alias(n)).distinct()
    return kept.join(first, n, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
