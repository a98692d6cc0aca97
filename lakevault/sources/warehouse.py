"""Layered parquet warehouse: overwrite, append, upsert and satellite append.

A table is a folder of segments, each written by one job, and of commits ``_commit_<n>.json`` that
list the segments which make up version n, and for each stream the last of its batches that is in
them. The last complete commit is the table. A write creates
new segments first and its commit last, so a run that dies at any point leaves the table as it
was, and nothing is ever moved. Segments that neither the new version nor the one before it uses
are deleted after the commit; readers of these two versions are not disturbed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.incremental import new_versions, newer_than_stored, upsert_by_key

# Tables with upserts are stored in so many parts by a hash of the key; a batch rewrites only
# those that it touches.
KEY_PARTS = 64
# Most of a vault table are hash keys in hexadecimal digits: this writes a digit in half a byte, the
# default in a whole one.
COMPRESSION = "zstd"
_PART = "_key_part"


class Warehouse:
    """Tables under ``root/<layer>/<name>`` on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def path_exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _names(self, folder: str) -> list[str]:
        fs, target = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _commits(self, layer: str, name: str) -> list[tuple[int, list[str], dict[str, int]]]:
        """(version, segments, last batch by stream) of the complete commits, the last one first. A
        commit that was cut off while being written is no commit."""
        folder, out = self.path(layer, name), []
        for file in self._names(folder):
            if file.startswith("_commit_"):
                try:
                    listed = json.loads(self._text(f"{folder}/{file}"))
                except ValueError:
                    continue
                out.append((listed["version"], listed["segments"], listed.get("batches", {})))
        return sorted(out, key=lambda c: c[0], reverse=True)

    def _text(self, path: str) -> str:
        fs, target = self._fs(path)
        stream = fs.open(target)
        try:
            return self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream).decode()
        finally:
            stream.close()

    def _segments(self, layer: str, name: str) -> list[str]:
        commits = self._commits(layer, name)
        return commits[0][1] if commits else []

    def holds(self, layer: str, name: str, once: tuple[str, int] | None) -> bool:
        """Whether the table has this (stream, batch) already. Batches of a stream come in order,
        and only its last one can come twice."""
        commits = self._commits(layer, name) if once else []
        return bool(commits) and commits[0][2].get(once[0], -1) >= once[1]

    def _commit(self, layer: str, name: str, segments: list[str],
                once: tuple[str, int] | None = None) -> None:
        """Make these segments the table. Creating the file is the one step that counts; two
        writers cannot create the same version."""
        folder, commits = self.path(layer, name), self._commits(layer, name)
        version = commits[0][0] + 1 if commits else 1
        fs, target = self._fs(f"{folder}/_commit_{version}.json")
        if fs.exists(target) and version not in [c[0] for c in commits]:
            fs.delete(target, False)  # cut off in an earlier run
        batches = (commits[0][2] if commits else {}) | dict([once] if once else [])
        listed = {"version": version, "segments": segments} | ({"batches": batches} if batches else {})
        stream = fs.create(target, False)
        try:
            stream.write(bytearray(json.dumps(listed).encode()))
        finally:
            stream.close()
        used = {s.split("/")[0] for s in segments} | {
            s.split("/")[0] for _, before, _ in commits[:1] for s in before}
        keep = {f"_commit_{v}.json" for v in (version, version - 1)}
        for file in self._names(folder):
            if file not in used and file not in keep:
                fs.delete(self._fs(f"{folder}/{file}")[1], True)

    def _write(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (),
               kind: str = "segment") -> str:
        """A new segment, not yet part of the table."""
        segment = f"{kind}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.option("compression", COMPRESSION).parquet(f"{self.path(layer, name)}/{segment}")
        return segment

    def exists(self, layer: str, name: str) -> bool:
        return bool(self._commits(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        """The last committed version."""
        segments = self._segments(layer, name)
        if not segments:
            raise FileNotFoundError(f"{self.path(layer, name)} has no committed version")
        return self._read(layer, name, segments)

    def _read(self, layer: str, name: str, segments: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path(layer, name)}/{s}" for s in segments))

    def overwrite(self, df: DataFrame, layer: str, name: str,
                  partition_by: Sequence[str] = ()) -> None:
        """Full refresh. The plan may read the table it replaces. With ``partition_by`` rows are
        first rebalanced on those columns, which splits a hot value over several tasks."""
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        self._commit(layer, name, [self._write(df, layer, name, partition_by)])

    def append(self, df: DataFrame, layer: str, name: str,
               once: tuple[str, int] | None = None) -> None:
        """Add rows; a failed append adds none, and one of a (stream, batch) that the table holds
        does nothing."""
        if not self.holds(layer, name, once):
            segment = self._write(df, layer, name)
            self._commit(layer, name, [*self._segments(layer, name), segment], once)

    def replace_run(self, df: DataFrame, layer: str, name: str, run: str) -> None:
        """Add the rows of a run in place of those that an earlier attempt at this run stored."""
        others = [s for s in self._segments(layer, name) if not s.startswith(f"run-{run}-")]
        self._commit(layer, name, [*others, self._write(df, layer, name, kind=f"run-{run}")])

    def upsert(self, batch: DataFrame, layer: str, name: str, key: Sequence[str],
               part: Column | None = None, once: tuple[str, int] | None = None,
               merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert_by_key,
               ) -> list:
        """Replace rows with a matching key, insert the others; ``merge`` does otherwise. Only parts
        of the table that hold a key of the batch are read and written; these are returned.

        A part is one of ``KEY_PARTS`` hashes of the key, or ``part``, a text that depends on the
        key alone and has few values, which must be the same for all batches of a table."""
        if part is None:
            part = F.pmod(F.xxhash64(*key), F.lit(KEY_PARTS)).cast("int")
        touched = {r[0] for r in batch.select(part).distinct().collect()}
        if self.holds(layer, name, once):
            return sorted(touched)
        stored = self._segments(layer, name)
        names = {p: f"{_PART}={p}" for p in touched}
        mine = [s for s in stored if "/" not in s or s.split("/")[1] in names.values()]
        if mine:
            batch = merge(self._read(layer, name, mine), batch, key)
        segment = self._write(batch.withColumn(_PART, part).hint("rebalance", _PART), layer, name,
                              [_PART])
        made = [f"{segment}/{p}" for p in self._names(f"{self.path(layer, name)}/{segment}")
                if p.startswith(_PART)]
        kept = [s for s in stored if s not in mine]
        if not made and not kept:  # a table without rows is a file without rows
            made = [self._write(batch.limit(0), layer, name)]
        self._commit(layer, name, kept + made, once)
        return sorted(touched)

    def read_parts(self, layer: str, name: str, parts: Sequence) -> DataFrame:
        """Only these parts of a table with upserts."""
        stored, names = self._segments(layer, name), {f"{_PART}={p}" for p in parts}
        mine = [s for s in stored if "/" in s and s.split("/")[1] in names]
        return self._read(layer, name, mine) if mine else self.read(layer, name).limit(0)

    def append_versions(self, batch: DataFrame, layer: str, name: str, key: str,
                        once: tuple[str, int] | None = None) -> None:
        """Add the satellite rows whose (key, hashdiff) is not stored yet."""
        if self.exists(layer, name):
            batch = new_versions(self.read(layer, name), batch, key)
        self.append(batch, layer, name, once)

    def upsert_daily(self, batch: DataFrame, layer: str, name: str, key: Sequence[str]) -> None:
        """Upsert of rows newer than the last stored ``run_date``; earlier ones are ignored."""
        if self.exists(layer, name):
            batch = newer_than_stored(batch, self.read(layer, name))
        self.upsert(batch, layer, name, key)
