"""Incremental export of measurement rows as time-series points (ops H6, H7, A12).

The reference polls the store for rows with ``processed_at IS NULL`` and then
sets ``processed_at``. Here a file-source stream over the fact folder does the
same bookkeeping: the stream checkpoint records which files were exported, so a
run with ``trigger(availableNow=True)`` exports exactly the rows not yet
exported and stops.

Epochs are transactions. A micro-batch's points go to a folder of their own, and only then does the output's
commit log (its manifest, see ``sources.versions``) name that folder with the epoch's number. Readers
follow the log, so they never see half an epoch; an epoch that is retried after its commit does nothing, and one
that was lost before it is written again. When the log names more than ``KEEP_EPOCHS`` folders, they are
compacted into one that holds the points as the time-series store would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import closed_range
from ..operators.upsert import is_pending
from ..sources import versions
from ..sources.sinks import points

POINT_KEYS = ["measurement", "station_id", "pollutant_id", "unit", "source", "year", "time"]
#: Folders that the commit log names at most before they are compacted.
KEEP_EPOCHS = 50


def export_points(spark: SparkSession, source_path: str, schema, out_path: str, checkpoint: str,
                  start=None, end=None,
                  max_files_per_trigger: int | None = None, keep_epochs: int = KEEP_EPOCHS):
    """Start an availableNow stream; returns the ``StreamingQuery`` (caller waits).
    ``checkpoint`` belongs to one source and one output. Rows that were exported before
    (``processed_at`` set) are left out; a time range reads the years that it needs only."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    pending = reader.parquet(source_path).filter(is_pending())
    if start is not None and end is not None:
        pending = closed_range(pending, start, end)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        commit_epoch(points(batch), out_path, epoch_id, keep_epochs)

    return (pending.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def commit_epoch(batch: DataFrame, out_path: str, epoch: int, keep_epochs: int = KEEP_EPOCHS) -> bool:
    """Add an epoch's points to the output, once; False if the log has the epoch already."""
    spark, out_path = batch.sparkSession, out_path.rstrip("/")
    log = versions.manifest(spark, out_path)
    if log is not None and log["last_epoch"] >= epoch:
        return False
    folder = f"{versions.DATA}/v={versions.new_version()}"
    batch.write.parquet(f"{out_path}/{folder}")
    folders = [*(log["folders"] if log else []), {"epoch": epoch, "folder": folder}]
    log = versions.commit(spark, out_path, {"folders": folders, "last_epoch": epoch}, log)
    if len(folders) > keep_epochs:
        folder = f"{versions.DATA}/v={versions.new_version()}"
        read_points(spark, out_path).write.parquet(f"{out_path}/{folder}")
        versions.commit(spark, out_path, {"folders": [{"epoch": epoch, "folder": folder}], "last_epoch": epoch}, log)
    return True


def read_epochs(spark: SparkSession, out_path: str) -> DataFrame:
    """All points of the committed epochs, with ``epoch``."""
    log = versions.manifest(spark, out_path)
    if log is None:
        raise ValueError(f"{out_path} holds no committed epoch")
    out = None
    for entry in log["folders"]:  # as many as KEEP_EPOCHS
        part = spark.read.parquet(f"{out_path.rstrip('/')}/{entry['folder']}").withColumn("epoch", F.lit(entry["epoch"]).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


def read_points(spark: SparkSession, out_path: str) -> DataFrame:
    """The exported points as the time-series store would hold them: a point
    written again with the same tags and time (a re-exported, rewritten year
    partition, or an updated row) replaces the earlier one, so the latest epoch
    wins (then the larger ``measurement_sk``). A ``max_by`` aggregate, combined
    map-side."""
    order = F.struct(F.col("epoch"), F.col("measurement_sk"))
    g = read_epochs(spark, out_path).groupBy(*POINT_KEYS).agg(F.max_by(F.struct("value", "measurement_sk"), order).alias("_w"))
    return g.select(*POINT_KEYS, F.col("_w.value").alias("value"), F.col("_w.measurement_sk").alias("measurement_sk"))
