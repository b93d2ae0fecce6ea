"""Keyed upserts, surrogate keys and incremental-load state (ops H1-H8).

There is no table format here: every operator returns the merged DataFrame and
the sink decides where it goes (never overwrite a path that is being read; write
to a new path or a staging table and swap).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..session import ensure_checkpoint_dir, pin_table
from .cleaning import closed_range, keep_one
from .joins import checked_broadcasts

NATURAL_KEY = ["station_id", "pollutant_id", "ts_utc"]


def _ts(now) -> Column:
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now


def one_update(updates: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """The last update of each key in ``order``, as statements applied one by one
    would leave it; without an order the largest row wins, so reruns agree."""
    return keep_one(updates, keys, order or [c for c in updates.columns if c not in keys], last=True)


def upsert_replace(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Replace all non-key columns on key match, insert new keys (op H1).
    = target rows whose key is absent from ``updates`` + the last update of each key."""
    kept = target.join(updates.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(one_update(updates, keys, order).select(*target.columns))


def delete_insert(target: DataFrame, staging: DataFrame, key: str = "measurement_sk") -> DataFrame:
    """Delete target rows whose key is staged, then insert the staging rows (op H3)."""
    kept = target.join(staging.select(key), on=key, how="left_anti")
    return kept.unionByName(staging.select(*target.columns))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str],
                     order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): new keys are inserted, existing keys rejected (op H4).
    Rows that repeat a new key are taken in ``order`` (all other columns by default): the first is
    accepted, the others are rejected. A key's rows are ranked together, so ``rows`` is a
    batch of requests, not a fact."""
    turn = Window.partitionBy(*keys).orderBy(*(order or [c for c in rows.columns if c not in keys]))
    asked = rows.withColumn("_turn", F.row_number().over(turn))
    existing = target.select(*keys).distinct().withColumn("_there", F.lit(True))
    judged = asked.join(existing, on=keys, how="left")
    new = F.col("_there").isNull() & (F.col("_turn") == 1)
    return (judged.filter(new).select(*rows.columns), judged.filter(~new).select(*rows.columns))


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append without key check (op H5)."""
    return target.unionByName(rows.select(*target.columns))


def max_key(df: DataFrame, key: str = "measurement_sk") -> int:
    """Largest surrogate key (0 when empty): one scalar to the driver."""
    row = df.agg(F.max(key).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def assign_surrogate_keys(df: DataFrame, order_cols: list, start: int = 0,
                          key: str = "measurement_sk") -> DataFrame:
    """Dense keys ``start+1, start+2, ...`` in ``order_cols`` order (op H8).

    No single-partition global window: rows are range-partitioned and sorted,
    the sorted frame is checkpointed to the shared checkpoint folder (pins the
    partitions and cuts lineage), each partition's row count is aggregated
    (one row per partition), and its running offset is added to the position of
    the row inside its partition. ``order_cols`` (names or sort columns) should
    identify a row, as a natural key or an ingest position does: then the range
    partitions are even, and keys are reproducible on a rerun."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    pinned = ordered.checkpoint(eager=True)
    pos = (pinned.withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    # One row per partition: bounded by the partition count, broadcast as is.
    out = pos.join(F.broadcast(offsets), on="_pid", how="left")
    return out.withColumn(key, (F.lit(start) + F.col("_off") + F.col("_pos") + 1).cast("bigint")) \
              .drop("_pid", "_pos", "_off")


def touched_years(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Target rows in the years the updates touch. On a year-partitioned table
    the semi join becomes a partition filter (dynamic partition pruning), so an
    upsert reads and rewrites only those years (``partitionOverwriteMode=dynamic``)."""
    years = updates.select(cal.year_of("ts_utc").alias("year")).distinct()
    # Distinct years: bounded by the calendar span, a few hundred rows at most.
    return target.join(F.broadcast(years), "year", "left_semi")


def upsert_measurements(target: DataFrame, updates: DataFrame, now=None,
                        update_order: list[str] | None = None,
                        keys: list[str] = NATURAL_KEY, only_touched_years: bool = False) -> DataFrame:
    """Upsert on (station, pollutant, ts) (op H2).

    Matched: value, unit, source replaced; processed_at reset to NULL; sk,
    inserted_at and is_valid kept. New: next surrogate keys (H8) in key order,
    inserted_at = now, is_valid = true, processed_at NULL. Several updates of one
    key: the last in ``update_order`` wins, as sequential statements would (without an
    order the largest value does).

    The store is joined to the updates and goes straight to the sink; new rows are the updates
    whose key the store lacks. Only the updates and the new rows are written to the shared
    checkpoint folder. With ``only_touched_years`` the target (which must carry ``year``) is cut to
    the years present in the updates and the result holds only those years, for
    a dynamic partition overwrite."""
    cols = ["station_id", "pollutant_id", "ts_utc", "value", "unit", "source"]
    start = max_key(target)  # over the whole store: keys of other years are in use too
    if only_touched_years:
        target = touched_years(target, updates)
    if "year" in target.columns:
        target = target.drop("year")
    upd = pin_table(one_update(updates.select(*cols, *(update_order or [])), keys, update_order).select(*cols), "updates")
    changes = upd.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols if c not in keys], F.lit(True).alias("_u"))
    j = target.join(changes, on=keys, how="left")
    matched_or_old = j.select(
        "measurement_sk", *keys,
        *[F.when(F.col("_u").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
          for c in ("value", "unit", "source")],
        "is_valid", "inserted_at",
        F.when(F.col("_u").isNotNull(), F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("processed_at")).alias("processed_at"),
    )
    new = upd.join(target.select(*keys), on=keys, how="left_anti").select(*keys, "value", "unit", "source")
    new = assign_surrogate_keys(new, keys, start).select(
        "measurement_sk", *keys, "value", "unit", "source",
        F.lit(True).alias("is_valid"), _ts(now).alias("inserted_at"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"))
    out = matched_or_old.unionByName(new)
    return out.withColumn("year", cal.year_of("ts_utc"))


def is_pending() -> Column:
    """Not yet exported: processed_at NULL and valid."""
    return F.col("processed_at").isNull() & (F.col("is_valid") == F.lit(True))


def pending_rows(df: DataFrame, start, end) -> DataFrame:
    """Rows not yet exported: processed_at NULL, valid, ts BETWEEN start AND end (op H6). On
    a store partitioned by year only the years of the range are read."""
    return closed_range(df.filter(is_pending()), start, end).sortWithinPartitions("measurement_sk")


def mark_processed(target: DataFrame, written: DataFrame, now=None,
                   key: str = "measurement_sk") -> DataFrame:
    """Set processed_at = now on the written keys (op H7)."""
    hits = written.select(key).distinct().withColumn("_hit", F.lit(True))
    j = target.join(hits, on=key, how="left")
    return j.withColumn(
        "processed_at", F.when(F.col("_hit").isNotNull(), _ts(now)).otherwise(F.col("processed_at"))
    ).drop("_hit").select(*target.columns)


def cascade_delete_zones(zones: DataFrame, stations: DataFrame, capabilities: DataFrame,
                         measurements: DataFrame, zone_ids: DataFrame) -> dict[str, DataFrame]:
    """Delete zones and, through the foreign keys, their stations, capabilities
    and measurements (op I6): chained anti joins. The deleted keys are subsets
    of catalogues, so they go to the facts as size-checked broadcasts: a station
    holding a third of all measurements is never hashed into one task."""
    zid = zone_ids.select("zone_id").distinct()
    (zid_b,) = checked_broadcasts([zid])
    gone_st = stations.join(zid_b, "zone_id", "left_semi").select("station_id")
    (gone_b,) = checked_broadcasts([gone_st])
    return {
        "zones": zones.join(zid_b, "zone_id", "left_anti"),
        "stations": stations.join(gone_b, "station_id", "left_anti"),
        "station_capabilities": capabilities.join(gone_b, "station_id", "left_anti"),
        "measurements_raw": measurements.join(gone_b, "station_id", "left_anti"),
    }
