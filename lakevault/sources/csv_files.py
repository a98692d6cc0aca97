"""CSV source and the load of one or all source files into bronze."""

from __future__ import annotations

import posixpath
import warnings
from collections.abc import Callable, Collection, Mapping
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakevault.operators import ingest
from lakevault.schemas import INGESTION_LOG, SPECS, TableSpec, spec_for
from lakevault.sources.warehouse import Warehouse

LoadResult = tuple[int, list[str]]

# The largest table is stored by presentation, so that a filter on it prunes folders.
PARTITIONED = {"student_vle": ["code_presentation"]}


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All cells as text, plus a column that orders rows as they stand in the file.

    Only the header line is read ahead; types are declared, never inferred. Cells keep their
    blanks, numbers are trimmed when they are cast. Short rows end in NULL. A row with more cells
    than the header has stops the read, and so does a quoted line break, unless ``multi_line``
    says that cells may hold one (files are then read whole instead of split). The order column is
    file, offset of the split and position within it, the same on every attempt of a task.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    columns = reader.csv(path).columns
    cells = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{c} string" for c in [*cells, "odd"])
    df = reader.option("columnNameOfCorruptRecord", "odd").schema(schema).csv(path)
    order = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("row"))
    # "odd" is the text of a line that has another number of cells than the header
    found = F.regexp_count(F.regexp_replace("odd", '"(?:[^"]|"")*"', ""), F.lit(",")) + 1
    fault = F.when(found > len(columns), F.concat(
        F.lit("a row has "), found.cast("string"), F.lit(f" cells, the header {len(columns)}")))
    if not multi_line:
        fault = F.when(F.regexp_count("odd", F.lit('"')) % 2 == 1, F.lit(
            "a quoted cell holds a line break; read the file with multi_line")).otherwise(fault)
    sound = F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean"))
    return df.filter(sound).select(*cells, order.alias(ingest.FILE_ORDER)).toDF(
        *columns, ingest.FILE_ORDER)


def load_table(spark: SparkSession, warehouse: Warehouse, source: str, path: str,
               load_ts: datetime, audit: Callable | None = None,
               multi_line: bool = False) -> LoadResult:
    """Read, validate, type, de-duplicate, pseudonymise and store one file as its bronze table.

    Returns the stored row count and the error messages (none on success). A file that cannot be
    read, has the wrong header or a malformed row leaves the stored table as it was. The row count
    is observed while writing, no second pass counts the rows. A log that cannot be written is a
    warning: the load has succeeded.
    """
    spec = spec_for(source)
    try:
        raw = ingest.clean_header(read_csv(spark, path, multi_line), spec)
    except PySparkException as e:
        return 0, [f"CSV read failed: {e}"]
    errors = ingest.schema_errors(raw.columns, spec)
    if errors:
        return 0, errors

    return store_bronze(warehouse, raw, spec, load_ts, path, audit)


def store_bronze(warehouse: Warehouse, raw: DataFrame, spec: TableSpec, load_ts: datetime, path: str,
                 audit: Callable | None = None) -> LoadResult:
    """Rows with sound columns as a bronze table, with an entry in the log: rows read, merged into
    others of their key, and written, all counted by the one job that writes."""
    file_name = posixpath.basename(path.rstrip("/"))
    read = Observation(f"rows read for {spec.table}")
    rows = Observation(f"rows of {spec.table}")
    out = ingest.to_bronze(raw, spec, load_ts, file_name, read=read).observe(
        rows, F.count(F.lit(1)).alias("n"))
    try:
        warehouse.overwrite(out, "bronze", spec.table, PARTITIONED.get(spec.table, ()))
    except Exception as e:  # a failed write is reported, not raised, like a failed read
        return 0, [f"write failed: {e}"]
    count, seen = rows.get["n"], read.get
    total = seen["rows"] or 0

    log = warehouse.spark.createDataFrame(
        [(spec.table, file_name, count, None, load_ts, total, total - seen["keys"])], INGESTION_LOG)
    try:
        warehouse.append(log, "bronze", "ingestion_log")
        if audit:
            audit(action="ingest", resource=f"bronze.{spec.table}",
                  detail={"rows": count, "source": path, "errors": []})
    except Exception as e:
        warnings.warn(f"{spec.table} is loaded, but its log is not written: {e}", stacklevel=2)
    return count, []


def load_all_tables(spark: SparkSession, warehouse: Warehouse, data_dir: str, load_ts: datetime,
                    audit: Callable | None = None, paths: Mapping[str, str] | None = None,
                    multi_line: Collection[str] = ()) -> dict[str, LoadResult]:
    """Load every registered source; absent files are skipped with a warning. A source's file is
    ``<source>.csv`` unless ``paths`` names another, anywhere; ``multi_line`` names sources whose
    cells may hold line breaks."""
    results: dict[str, LoadResult] = {}
    for source in SPECS:
        path = (paths or {}).get(source, f"{data_dir.rstrip('/')}/{source}.csv")
        if warehouse.path_exists(path):
            results[source] = load_table(
                spark, warehouse, source, path, load_ts, audit, source in multi_line)
        else:
            warnings.warn(f"{path} does not exist; {SPECS[source].table} is not loaded", stacklevel=2)
    return results


def summary_frame(spark: SparkSession, results: dict[str, LoadResult]) -> DataFrame:
    """Load results as rows ``(table, rows, errors)``."""
    rows = [(t, n, "; ".join(e) or None) for t, (n, e) in results.items()]
    return spark.createDataFrame(rows, "table string, rows bigint, errors string")
