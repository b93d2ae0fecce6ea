"""The fact store: rows partitioned by year, bucketed and sorted by key within each year, with versions.

A merge rewrites only the years that its changes touch. The store's side of the join reads buckets as they
lie, so nothing but the changes is shuffled. How many buckets a year has follows from its number of
rows (a power of two, at most ``rows_per_bucket`` rows in each on average), so years of the same number form one
bucketed table and a merge runs once for each such number; a year that outgrows its buckets is dealt anew, which
happens once each time it doubles. Every rewrite of a year goes to a folder of its own
(``data/year=1995/v=<version>``); the manifest (see ``versions``) names the live one of each year, with its number of
rows, its buckets and the largest surrogate key, so that counts by year, loaded years and the next
key are known without a scan. Years are the only thing listed on the driver: the calendar bounds them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..operators.upsert import NATURAL_KEY, _ts, assign_surrogate_keys, one_update
from ..session import pin_table
from . import versions

#: Rows that a bucket of a year, one sorted file, holds on average at most.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, rows_per_bucket: int) -> int:
    n = 1
    while n * rows_per_bucket < rows:
        n *= 2
    return n


class FactStore:
    """Facts at ``root``, one row set per ``keys`` value; ``number`` is the surrogate key column."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str] = NATURAL_KEY, number: str = "measurement_sk",
                 rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.number, self.rows_per_bucket = list(keys), number, rows_per_bucket

    # --- what is live ------------------------------------------------------------------

    def manifest(self) -> dict:
        entries = versions.manifest(self.spark, self.root)
        if entries is None:
            raise ValueError(f"{self.root} holds no store")
        return entries

    def read(self, years: list[int] | None = None) -> DataFrame:
        """The live rows, or those of some years. A snapshot: later changes leave it as it is."""
        entries = self.manifest()
        schema = T.StructType.fromJson(entries["schema"])
        parts = {int(y): p for y, p in entries["years"].items() if years is None or int(y) in years}
        if not parts:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("v", T.StringType())])
        rows = (self.spark.read.schema(full).option("basePath", f"{self.root}/{versions.DATA}")
                .parquet(*(f"{self.root}/{versions.DATA}/year={y}/v={p['v']}" for y, p in sorted(parts.items()))))
        return rows.select(*schema.names)

    def years(self) -> DataFrame:
        """(year int, n_rows long, buckets int, v string): the years that are loaded, from the manifest alone."""
        rows = [(int(y), p["rows"], p["buckets"], p["v"]) for y, p in sorted(self.manifest()["years"].items())]
        return self.spark.createDataFrame(rows, "year int, n_rows long, buckets int, v string")

    # --- writing -----------------------------------------------------------------------

    def create(self, rows: DataFrame) -> "FactStore":
        """A new store with these rows (which have ``year`` or ``ts_utc``)."""
        if versions.manifest(self.spark, self.root) is not None:
            raise ValueError(f"{self.root} holds a store already")
        rows = pin_table(with_year(rows), "facts")
        fresh = {"years": {}, "top": 0, "schema": _year_last(rows.schema).jsonValue()}
        counts = _by_year(rows)
        top = rows.agg(F.max(self.number)).first()[0] if self.number in rows.columns else 0
        self._rewrite(fresh, None, counts, lambda part, years: rows.filter(F.col("year").isin(years)), top)
        return self

    def upsert(self, updates: DataFrame, now=None, order: list[str] | None = None) -> list[int]:
        """Upsert on the key, which must tell the year (op H2); returns the years that were rewritten.

        Matched rows take value, unit and source, and are pending again; the others are new
        rows with the next surrogate keys, in key order (op H8). The last update of a key in ``order`` wins."""
        cols = [*self.keys, "value", "unit", "source"]
        before = self.manifest()
        upd = pin_table(with_year(one_update(updates.select(*cols, *(c for c in order or [] if c not in cols)),
                                             self.keys, order).select(*cols)), "updates")
        counts = _by_year(upd)
        new = []
        for part, years in self._parts(before, counts):
            mine = upd.filter(F.col("year").isin(years)).select(*self.keys)
            new.append(mine.join(part.select(*self.keys), self.keys, "left_anti") if part is not None else mine)
        if not new:
            return []
        fresh = new[0]
        for more in new[1:]:
            fresh = fresh.unionByName(more)
        fresh = assign_surrogate_keys(fresh, self.keys, before["top"], "_number")
        changes = pin_table(upd.join(fresh, self.keys, "left"), "changes").select(
            *self.keys, F.col("year").alias("_year"), "_number", *(F.col(c).alias(f"_{c}") for c in ("value", "unit", "source")))
        self._drop_parts()
        added = _by_year(changes.filter("_number IS NOT NULL").select(F.col("_year").alias("year")))
        there, hit = F.col(self.number).isNotNull(), F.col("_year").isNotNull()

        def merged(part, years):
            mine = changes.filter(F.col("_year").isin(years))
            joined = self._empty(before) if part is None else part
            joined = joined.join(mine, self.keys, "full_outer")
            new_values = {
                self.number: F.coalesce(F.col(self.number), "_number"),
                **{c: F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("value", "unit", "source")},
                "is_valid": F.when(there, F.col("is_valid")).otherwise(F.lit(True)),
                "inserted_at": F.when(there, F.col("inserted_at")).otherwise(_ts(now)),
                "processed_at": F.when(~hit, F.col("processed_at")),
                "year": F.coalesce("year", "_year")}
            return joined.select(*(new_values[c].alias(c) if c in new_values else F.col(c) for c in self._columns(before)))

        self._rewrite(before, before, {y: added.get(y, 0) for y in counts}, merged, top=changes.agg(F.max("_number")).first()[0])
        return sorted(counts)

    def mark_processed(self, written: DataFrame, now=None) -> list[int]:
        """Set ``processed_at`` of the written rows (op H7), found by key and number; returns the years rewritten."""
        before = self.manifest()
        hits = with_year(written).groupBy(*self.keys, "year").agg(F.collect_set(self.number).alias("_numbers"))
        hits = pin_table(hits.withColumnRenamed("year", "_year"), "hits")

        def marked(part, years):
            joined = part.join(hits.filter(F.col("_year").isin(years)).drop("_year"), self.keys, "left")
            seen = F.coalesce(F.array_contains("_numbers", F.col(self.number)), F.lit(False))
            return joined.withColumn("processed_at", F.when(seen, _ts(now)).otherwise(F.col("processed_at"))) \
                         .select(*self._columns(before))

        counts = {y: 0 for y in _by_year(hits.withColumnRenamed("_year", "year")) if str(y) in before["years"]}
        self._rewrite(before, before, counts, marked)
        return sorted(counts)

    def replace(self, rows: DataFrame) -> list[int]:
        """Delete the rows whose key is given, then insert the given rows (op H3); returns the years
        rewritten: those that the rows come from and those that they go to."""
        before = self.manifest()
        rows = pin_table(with_year(rows).select(*self._columns(before)), "staged")
        counts = _by_year(rows)
        loaded = {int(y): 0 for y in before["years"]}
        for part, _ in self._parts(before, loaded):
            for r in part.select("year", *self.keys).join(rows.select(*self.keys), self.keys, "left_semi") \
                         .select("year").distinct().collect():  # years: bounded by the calendar
                counts.setdefault(r.year, 0)
        self._drop_parts()

        def replaced(part, years):
            mine = rows.filter(F.col("year").isin(years))
            return mine if part is None else part.join(rows.select(*self.keys), self.keys, "left_anti").unionByName(mine)

        self._rewrite(before, before, counts, replaced, top=rows.agg(F.max(self.number)).first()[0])
        return sorted(counts)

    # --- bucketed tables ---------------------------------------------------------------

    def _columns(self, entries: dict) -> list[str]:
        return T.StructType.fromJson(entries["schema"]).names

    def _empty(self, entries: dict) -> DataFrame:
        return self.spark.createDataFrame([], T.StructType.fromJson(entries["schema"]))

    def _table(self, entries: dict, buckets: int, years: list[int]) -> str:
        """A bucketed table over the live folders of some years, known to this session only until ``_drop_parts``."""
        name = f"smogline_store_{uuid.uuid4().hex}"
        fields = [*T.StructType.fromJson(entries["schema"]).fields, T.StructField("v", T.StringType())]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (year, v) "
                       f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS "
                       f"LOCATION '{self.root}/{versions.DATA}'")
        self._names = [*getattr(self, "_names", []), name]
        live = " ".join(f"PARTITION (year={y}, v='{entries['years'][str(y)]['v']}')" for y in years)
        if live:
            self.spark.sql(f"ALTER TABLE {name} ADD {live}")
        return name

    def _drop_parts(self) -> None:
        """Forget the session's tables; their files stay."""
        for name in getattr(self, "_names", []):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names = []

    def _parts(self, entries: dict, counts: dict[int, int]) -> list[tuple[DataFrame | None, list[int]]]:
        """(live rows, years) for each number of buckets among the years; no rows for years not loaded."""
        groups: dict[int, list[int]] = {}
        for y in sorted(counts):
            groups.setdefault(entries["years"].get(str(y), {}).get("buckets", 0), []).append(y)
        return [(self.spark.table(self._table(entries, n, years)).drop("v") if n else None, years)
                for n, years in sorted(groups.items())]

    def _rewrite(self, before: dict, after: dict | None, counts: dict[int, int],
                 made: Callable[[DataFrame | None, list[int]], DataFrame], top: int | None = None) -> None:
        """Write the years in ``counts`` (with the number of rows that may be added) anew and make them live."""
        version, done = versions.new_version(), dict(before["years"])
        schema = T.StructType.fromJson(before["schema"])
        groups: dict[tuple[int, int], list[int]] = {}
        for y, added in sorted(counts.items()):
            was = done.get(str(y), {"rows": 0, "buckets": 0})
            groups.setdefault((was["buckets"], max(was["buckets"], buckets_for(was["rows"] + added, self.rows_per_bucket))), []).append(y)
        try:
            for (old, new), years in sorted(groups.items()):
                part = self.spark.table(self._table(before, old, years)).drop("v") if old else None
                out = made(part, years)
                if old != new:
                    out = out.repartition(new, *self.keys)
                target = self._table(before, new, [])
                out.withColumn("v", F.lit(version)).select(*schema.names, "v").write.insertInto(target)
                rows = self._written(years, version)
                for y in years:
                    done.pop(str(y), None)
                    if rows.get(y):
                        done[str(y)] = {"v": version, "rows": rows[y], "buckets": new}
        finally:
            self._drop_parts()
        versions.commit(self.spark, self.root, {**before, "years": done, "top": max(before["top"], int(top or 0))}, after)


    def _written(self, years: list[int], version: str) -> dict[int, int]:
        """Rows of each year that a version has, from the files' footers: no column is read."""
        folders = [f"{self.root}/{versions.DATA}/year={y}/v={version}" for y in years]
        folders = [f for f in folders if versions.exists(self.spark, f)]
        if not folders:
            return {}
        got = self.spark.read.schema("year int").option("basePath", f"{self.root}/{versions.DATA}").parquet(*folders)
        return _by_year(got)


def with_year(df: DataFrame) -> DataFrame:
    """``df`` with the year of each row as its last column; a row without a time fails the run."""
    year = F.col("year").cast("int") if "year" in df.columns else cal.year_of("ts_utc")
    checked = F.coalesce(year, F.raise_error(F.lit("a fact without a time has no year")).cast("int"))
    return df.select(*(c for c in df.columns if c != "year"), checked.alias("year"))


def _year_last(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name != "year"] + [T.StructField("year", T.IntegerType())])


def _by_year(df: DataFrame) -> dict[int, int]:
    """Rows by year: a row for each year comes to the driver."""
    return {r.year: r["count"] for r in df.groupBy("year").count().collect()}
