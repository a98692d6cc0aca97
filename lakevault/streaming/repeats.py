"""Repeated keys summed on a stream, with corrections.

The batch form (``operators.ingest.dedup_sum``) sees a file whole and returns one row per key. On a
stream a key may come again in any later batch. A grouping that the stream keeps holds, per key, the
sums so far, the first non-null value of every other column by the row order, and the times of the
batches that had the key, whose number is how often the row was handed on. Every batch hands on the
keys it changed: revision 1 when a key is new, a higher one as a correction that replaces what was
handed on before. The newest revision of every key is what the batch form returns for all rows taken
together.

The batch form's rule that missing numbers become 0 as soon as any key repeats depends on rows that
have not come yet, so a sum of nothing stays NULL here (``null_sum="keep"``). Rows with a NULL in the
key are passed over, as the batch form does as soon as any key repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.sources.warehouse import Warehouse
from lakevault.streaming.landing import Batch, Sink

REVISION, CORRECTS = "_revision", "_corrects"


def summed(rows: DataFrame, key: Sequence[str], order_by: str) -> DataFrame:
    """The stream of changed keys: columns of ``rows`` without ``order_by`` (a whole number), the
    revision, and whether it corrects an earlier row. Output mode ``update``."""
    aggs = []
    for f in rows.schema.fields:
        if f.name in key or f.name == order_by:
            continue
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.sum(f.name).cast(f.dataType).alias(f.name))
        else:
            first = f"min_by(`{f.name}`, _order) filter (where `{f.name}` is not null)"
            aggs.append(F.expr(first).alias(f.name))
    # on a stream the current time is that of the batch, which a batch keeps when it is run again
    keyed = rows.dropna(subset=list(key)).withColumns({
        "_order": F.col(order_by).cast("long"), "_batch": F.current_timestamp()})
    revision = F.size(F.collect_set("_batch")).cast("long")
    made = keyed.groupBy(*key).agg(*aggs, revision.alias(REVISION))
    return made.select(*[f.name for f in rows.schema.fields if f.name != order_by], REVISION,
                       (F.col(REVISION) > 1).alias(CORRECTS))


def into_log(root: str, layer: str, name: str) -> Sink:
    """A sink that adds what was handed on to a table, each batch once; nothing is rewritten."""
    def write(rows: DataFrame, batch: Batch) -> None:
        Warehouse(rows.sparkSession, root).append(rows, layer, name, batch)
    return write


def newest(log: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last revision of every key, without the columns that tell of it."""
    rest = [c for c in log.columns if c not in (*key, REVISION, CORRECTS)]
    last = log.groupBy(*key).agg(F.max_by(F.struct(*rest), REVISION).alias("_last"))
    return last.select(*key, "_last.*").select(*[c for c in log.columns if c not in (REVISION, CORRECTS)])


def corrections(log: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """(key, revision, before, after) of every correction of a summed column."""
    held = Window.partitionBy(*key).orderBy(REVISION)
    return log.withColumn("before", F.lag(column).over(held)).filter(CORRECTS).select(
        *key, F.col(REVISION).alias("revision"), "before", F.col(column).alias("after"))
