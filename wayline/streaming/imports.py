"""Streaming imports. Rows pass the same transforms as in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from wayline.config import ImportConfig, ImportOptions
from wayline.operators.documents import latest_by_id
from wayline.plans.import_job import LookupTables, import_lines
from wayline.sinks import new_name, write_batch
from wayline.sources.lines import scan_lines, with_order


def stream_lines(spark: SparkSession, path: str, skip_header: bool = False, max_files: int | None = None) -> DataFrame:
    """Lines of files dropped into a directory, with their positions."""
    return scan_lines(spark, path, skip_header, stream=True, max_files_per_trigger=max_files, positions=True)


def write_stream(df: DataFrame, path: str, checkpoint: str, format: str = "parquet", once: bool = False) -> StreamingQuery:
    """Append a stateless stream to files; ``once`` takes what is there and stops."""
    writer = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def stream_run(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that belongs to a checkpoint, kept beside its state."""
    folder = f"{checkpoint}/run"
    try:
        found = spark.read.text(folder).first()
    except AnalysisException:
        found = None
    if found:
        return found[0]
    run = new_name()
    spark.range(1).select(F.lit(run).alias("value")).coalesce(1).write.mode("overwrite").text(folder)
    return run


def each_batch(
    lines: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Run a batch transform on every micro-batch and write it under its batch id.

    For transforms that a stream cannot hold: distinct-key lookups, row order,
    last-write-wins. A retried batch replaces its own directory; a stream that starts
    anew, with a new or lost checkpoint, is another run and replaces nothing.
    """
    run, session = stream_run(lines.sparkSession, checkpoint), new_name()

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch), path, batch_id, run=run, session=session)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def import_stream(
    lines: DataFrame,
    cfg: ImportConfig,
    options: ImportOptions,
    tables: LookupTables,
    path: str,
    checkpoint: str,
    once: bool = False,
    report: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Import dropped files batch by batch.

    Each batch is numbered in file order and, with ids on, trimmed to the last document
    per id; read the result with :func:`wayline.sinks.current_documents`. Collected
    rejects, with their order, go to ``<path>_rejects`` under the same run and batch.
    ``report`` gets the batch number and its load counts, such as
    :meth:`LoadListener.add`.
    """

    tables = tables.measured()
    run, session = stream_run(lines.sparkSession, checkpoint), new_name()

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        found = import_lines(with_order(batch, "_seq"), cfg, options, tables, counts)
        rows = latest_by_id(found.rows, ["_seq"]) if options.md5_id else found.rows
        write_batch(rows, path, batch_id, run=run, session=session)
        if found.rejects is not None:
            write_batch(found.rejects, f"{path}_rejects", batch_id, run=run, session=session)
        if report:
            report(batch_id, counts.get)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def drop_repeated_ids(df: DataFrame, event_time: str | Column, delay: str, id_column: str = "_id") -> DataFrame:
    """Keep the first document of each id seen within ``delay``, with bounded state."""
    timed = df.withColumn("_time", F.col(event_time) if isinstance(event_time, str) else event_time)
    return timed.withWatermark("_time", delay).dropDuplicatesWithinWatermark([id_column]).drop("_time")


class LoadListener(StreamingQueryListener):
    """Sums the observed load counts of all batches."""

    def __init__(self, name: str = "load") -> None:
        self.name = name
        self.totals: dict[str, int] = {}
        self.rows_per_second = 0.0

    def add(self, batch_id: int, counts: dict[str, int]) -> None:
        """Count a batch that was imported by :func:`import_stream`."""
        for key, value in counts.items():
            self.totals[key] = self.totals.get(key, 0) + (value or 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        metrics = event.progress.observedMetrics.get(self.name)
        self.rows_per_second = event.progress.processedRowsPerSecond or 0.0
        if metrics is not None:
            for key, value in metrics.asDict().items():
                self.totals[key] = self.totals.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
