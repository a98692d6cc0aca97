"""Cutting lineage in the folder that all machines share, and free column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakevault.sources.shared import new_path, shared_folder, stored

__all__ = ["cut", "free_name", "new_path", "shared_folder", "stored"]


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed now and kept as a checkpoint in the shared folder: a lost executor
    costs nothing that came before."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(taken, stem: str) -> str:
    """A column name that none of ``taken`` has, in any case."""
    taken = {c.lower() for c in taken}
    while stem.lower() in taken:
        stem += "_"
    return stem
