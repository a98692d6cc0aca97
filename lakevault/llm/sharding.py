"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level the children of the node reached so far draw for a row, and the least draw wins:
``-ln(u) / weight``, an exponential whose rate is the child's weight, with u from a hash of the
row's key and the child's name. A child therefore wins in proportion to its weight, and a change
of weight alters that child's draws alone. A region whose weight rises only takes rows, one whose
weight falls only gives some; no row moves between two subtrees whose weights stay.

``grown`` hangs the next shard below a rack and a region of its own. No existing subtree changes
its weight, so rows move into the new shard or stay. A shard put into an existing rack instead
(``Node`` takes any layout) also draws rows to its neighbours in the region that grew.

Slots number a shard's rows by key, without gaps. Rows are range-partitioned by (shard, key, size,
checksum, row number), which splits a shard, and also one key that most rows have, over many tasks;
each task numbers its own rows and the counts of the tasks before it are added. There are at most
as many such counts as tasks and shards together.

Defined results: a null key draws as the empty text and comes first in its shard; a null text has
no bytes, size 8 and checksum 0; rows of equal keys share a shard, repeated rows have slots of
their own; an empty table gives an empty result. Columns of any name are carried by ``assign``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.storage import free_name, stored

LAW = "key"
#: Bytes that each row costs besides its text.
ROW_BYTES = 8
#: Hexadecimal digits of a draw: as many bits as a double holds.
DIGITS = 13


@dataclass(frozen=True)
class Node:
    """A region, a rack or a shard. Only a shard has a number and a weight of its own; the weight
    of other nodes is the sum of their shards'."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own: float = 1.0

    @property
    def weight(self) -> float:
        return self.own if self.shard is not None else sum(c.weight for c in self.children)


def rack(name: str, shards, weights: dict[int, float] | None = None) -> Node:
    return Node(name, tuple(
        Node(f"{name}/s{s}", shard=s, own=(weights or {}).get(s, 1.0)) for s in shards))


def layout(regions: int = 3, racks: int = 2, shards: int = 4,
           weights: dict[int, float] | None = None) -> Node:
    """A regular tree, its shards numbered from 0; ``weights`` by shard, 1 where none is given."""
    def first(r: int, k: int) -> int:
        return (r * racks + k) * shards

    return Node("", tuple(Node(f"r{r}", tuple(
        rack(f"r{r}/k{k}", range(first(r, k), first(r, k) + shards), weights)
        for k in range(racks))) for r in range(regions)))


def shard_names(tree: Node) -> dict[str, int]:
    """Shards by name."""
    if tree.shard is not None:
        return {tree.name: tree.shard}
    return {name: s for c in tree.children for name, s in shard_names(c).items()}


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with the next shard in a region and rack of its own."""
    new = max(shard_names(tree).values()) + 1
    own = Node(f"x{new}", (rack(f"x{new}/k0", [new], {new: weight}),))
    return Node(tree.name, (*tree.children, own))


def _children(tree: Node) -> dict[str, list[tuple[str, float]]]:
    """Every inner node's children that have a weight."""
    kids = [c for c in tree.children if c.weight > 0]
    if not kids:
        raise ValueError(f"no shard below {tree.name!r} has a weight")
    out = {tree.name: [(c.name, float(c.weight)) for c in kids]}
    for c in kids:
        out |= _children(c) if c.shard is None else {}
    return out


def _depth(tree: Node) -> int:
    return 0 if tree.shard is not None else 1 + max(map(_depth, tree.children))


def _draw(key: Column, child: Column) -> Column:
    digest = F.md5(F.concat(key, F.lit("|"), child["name"]).cast("binary"))
    whole = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return -F.log((whole + 0.5) / float(16 ** DIGITS)) / child["weight"]


def descend(df: DataFrame, key: Column, tree: Node, name: str) -> DataFrame:
    """``df`` with the shard of each row as column ``name``. Ties between draws go to the smaller
    name; children without weight take no rows."""
    made = _children(tree)
    names = [n for kids in made.values() for n, _ in kids]
    if len(set(names)) < len(names):
        raise ValueError("every node needs a name of its own")
    kids = F.create_map(*(x for parent, own in made.items() for x in (
        F.lit(parent), F.array(*(F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"))
                                 for n, w in own)))))
    key = F.coalesce(key.cast("string"), F.lit(""))
    at = F.lit(tree.name)
    for _ in range(_depth(tree)):
        drawn = F.transform(F.try_element_at(kids, at), lambda c: F.struct(
            _draw(key, c).alias("draw"), c["name"].alias("name")))
        df = df.withColumn(name, F.coalesce(F.array_min(drawn)["name"], at))
        at = F.col(f"`{name}`")  # a level's draws are made once; the next reads who won
    shards = F.create_map(*(F.lit(x) for pair in shard_names(tree).items() for x in pair))
    return df.withColumn(name, F.element_at(shards, at))


def assign(docs: DataFrame, tree: Node, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with an integer column for the shard, of a free name where ``name`` is taken."""
    return descend(docs, F.col(f"`{key}`"), tree, free_name(docs.columns, name))


def manifest(docs: DataFrame, tree: Node, larger: Node, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every document: where it lies,
    its place there, and its shard in the ``larger`` tree."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"))
    rows = descend(rows, F.col("key"), tree, "shard")
    rows = descend(rows, F.col("key"), larger, "grown_shard")
    # the texts are read once; all that is sorted and numbered is a few numbers a row
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "shards")
    order = ("shard", "key", "size", "text_crc32", "row")
    placed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).drop("row"),
        "shards_in_order")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("shard", "part").agg(
        F.min("at").alias("first"), F.count("*").alias("n")).select(
        "shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("add"))
    return placed.join(F.broadcast(first), ["shard", "part"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("at") + F.col("add")).alias("slot"), "grown_shard")


def write(docs: DataFrame, path: str, tree: Node, key: str = "doc_id",
          rows_per_file: int = 1_000_000) -> DataFrame:
    """The documents as Parquet files in a folder for each shard, several files where a shard is
    large; returns them as they read back. Each file comes from one task's range of (shard, key)."""
    placed = assign(docs, tree, key)
    name = placed.columns[-1]
    spread = placed.withColumn(free_name(placed.columns, "row"), F.monotonically_increasing_id())
    row = spread.columns[-1]
    spread.repartitionByRange(F.col(f"`{name}`"), F.col(f"`{key}`"), F.col(row)).drop(row).write.option(
        "maxRecordsPerFile", rows_per_file).partitionBy(name).parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)
