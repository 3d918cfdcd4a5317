"""Writers: documents to files or tables, dry runs, and batch-versioned upserts."""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayline.operators.documents import latest_by_id


def write_documents(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    replace: bool = False,
    partitions: int | None = None,
    by_id: str | None = None,
    compression: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write documents to any Spark sink format.

    ``replace`` overwrites the target, which need not exist; the default appends.
    ``partitions`` sets the output parallelism, by hash of ``by_id`` if given.
    """
    if partitions:
        df = df.repartition(partitions, by_id) if by_id else df.repartition(partitions)
    writer = df.write.format(format).mode("overwrite" if replace else "append")
    if compression:
        writer = writer.option("compression", compression)
    writer.options(**(options or {})).save(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, format: str = "parquet") -> None:
    """Create a table with a declared schema if absent; raise if it exists with another."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format(format).saveAsTable(name)
        return
    existing = {f.name: f.dataType for f in spark.table(name).schema}
    declared = {f.name: f.dataType for f in schema}
    if existing != declared:
        raise ValueError(f"table {name} exists with other columns: {existing} instead of {declared}")


def write_table(df: DataFrame, name: str, format: str = "parquet") -> None:
    """Append to a table, creating it from the frame's schema if it is absent."""
    ensure_table(df.sparkSession, name, df.schema, format)
    df.select(*df.sparkSession.table(name).columns).write.format(format).mode("append").saveAsTable(name)


@dataclass(frozen=True)
class DryRun:
    """Rows that went through a plan, and how fast."""

    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def dry_run(df: DataFrame) -> DryRun:
    """Run the whole plan without writing; every column is computed."""
    counted = Observation()
    start = time.perf_counter()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return DryRun(counted.get["rows"], time.perf_counter() - start)


# Names sort as text: a snapshot before everything, others by the time they were made.
SNAPSHOT = "0-snapshot"
FIRST = "1"
# Column of a written batch: when the job that wrote it began.
SESSION = "_session"


def new_name() -> str:
    """A name that sorts after all earlier ones."""
    return f"{FIRST}-{time.time_ns() // 1_000_000:014d}-{uuid.uuid4().hex[:8]}"


def write_batch(
    df: DataFrame, path: str, batch_id: int, format: str = "parquet", run: str = FIRST, session: str = FIRST
) -> None:
    """Write one batch of a run under its own directory.

    Writing the same batch of the same run again replaces it; no run touches another's.
    ``session`` orders what different runs wrote.
    """
    marked = df.withColumn(SESSION, F.lit(session))
    marked.write.format(format).mode("overwrite").save(f"{path}/run={run}/batch_id={batch_id}")


def _batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """Run and batch of every written batch, from the names of the files."""
    files = spark.read.option("basePath", path).parquet(path).inputFiles()
    return {(m[1], int(m[2])) for m in (re.search(r"/run=([^/]+)/batch_id=(\d+)/", f) for f in files) if m}


# A folder that listings of the batches pass over.
MANIFEST = "_manifest"


def _manifest(spark: SparkSession, path: str) -> tuple[int, str | None, set[tuple[str, int]]]:
    """Newest version, its snapshot's run, and the batches that are folded into that."""
    try:
        files = spark.read.parquet(f"{path}/{MANIFEST}").inputFiles()
    except AnalysisException:
        return 0, None, set()
    version = max(int(re.search(r"/v=(\d+)/", f)[1]) for f in files)
    rows = spark.read.parquet(f"{path}/{MANIFEST}/v={version}").collect()  # one row per folded batch
    return version, rows[0].snapshot, {(r.run, r.batch_id) for r in rows if r.run is not None}


def _live(spark: SparkSession, path: str) -> tuple[int, set[tuple[str, int]], set[tuple[str, int]]]:
    """Manifest version, batches to read, and batches folded before."""
    version, snapshot, folded = _manifest(spark, path)
    live = {(run, b) for run, b in _batches(spark, path) - folded if not run.startswith(f"{SNAPSHOT}-") or run == snapshot}
    return version, live, folded


def _read_batches(spark: SparkSession, path: str, batches: set[tuple[str, int]]) -> DataFrame:
    folders = [f"{path}/run={run}/batch_id={batch}" for run, batch in sorted(batches)]
    return spark.read.option("basePath", path).parquet(*folders)


def current_documents(spark: SparkSession, path: str, id_column: str = "_id", order: str = "_seq") -> DataFrame:
    """Latest document of each id over all runs and batches under ``path``."""
    _, live, _ = _live(spark, path)
    written = _read_batches(spark, path, live)
    return latest_by_id(written, [SESSION, "batch_id", order], id_column).drop("run", "batch_id", SESSION)


def fold(spark: SparkSession, path: str, id_column: str = "_id", order: str = "_seq") -> int:
    """Fold the batches written so far into one snapshot in place, while streams go on writing.

    The snapshot becomes visible with the next version of the manifest, one file that names it
    and the batches it holds. Until then readers take the batches, afterwards the snapshot and
    whatever was written meanwhile. A folded batch that is written again, by a retry, stays
    folded: it holds the same documents. One fold may run at a time. Returns the number of batches folded.
    """
    version, live, folded = _live(spark, path)
    snapshot = f"{SNAPSHOT}-{version + 1:08d}"
    written = _read_batches(spark, path, live)
    documents = latest_by_id(written, [SESSION, "batch_id", order], id_column).drop("run", "batch_id", SESSION)
    write_batch(documents, path, 0, run=snapshot, session=SNAPSHOT)
    rows = [(snapshot, run, batch) for run, batch in sorted(live | folded)] or [(snapshot, None, None)]
    listed = spark.createDataFrame(rows, "snapshot string, run string, batch_id int").coalesce(1)
    listed.write.mode("overwrite").parquet(f"{path}/{MANIFEST}/v={version + 1}")
    return len(live)


def compact(spark: SparkSession, path: str, snapshot: str, id_column: str = "_id", order: str = "_seq") -> None:
    """Write the current documents as a new snapshot, which later batches can follow.

    The snapshot is a run of its own, before all others, so no batch overwrites it.
    """
    try:
        exists = bool(spark.read.parquet(snapshot).take(1))
    except AnalysisException:
        exists = False
    if exists:
        raise ValueError(f"snapshot {snapshot} already holds data")
    write_batch(current_documents(spark, path, id_column, order), snapshot, 0, run=SNAPSHOT, session=SNAPSHOT)
