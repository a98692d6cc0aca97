"""Landed source rows into the vault: transactions appended, satellite versions added once.

A micro-batch is modelled like a load, from its own rows, and written table by table. Each table's
commit names the batch that it holds, so a batch that is run again after a failure adds to the
tables that it had not reached and leaves the others alone. Hubs and links are upserts: a second
run writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from lakevault.plans import MODELS, Tables
from lakevault.sources.warehouse import Warehouse
from lakevault.streaming.landing import Batch, Sink


def into_vault(root: str, table: str, models: Sequence[str], load_ts: datetime) -> Sink:
    """A sink that feeds vault ``models`` from rows of the source ``table``. Models must not need
    rows of other tables or of other batches: transactions, satellites, hubs and links do not."""
    fed = [MODELS[name] for name in models]
    for m in fed:
        if m.layer != "dv":
            raise ValueError(f"{m.name} is not a vault model")

    def write(rows: DataFrame, batch: Batch) -> None:
        warehouse = Warehouse(rows.sparkSession, root)
        tables = Tables({table: rows}, load_ts)
        for m in fed:
            if warehouse.holds(m.layer, m.name, batch):
                continue
            made = m.build(tables)
            if m.kind == "append":
                warehouse.append_versions(made, m.layer, m.name, m.key[0], batch)
            elif m.kind == "upsert":
                warehouse.upsert(made, m.layer, m.name, m.key, once=batch)
            else:
                warehouse.append(made, m.layer, m.name, batch)
    return write
