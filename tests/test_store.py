"""The fact store, versioned tables and the sized layout."""

import tempfile

import pytest
from pyspark.sql import functions as F

from smogline.operators import upsert as U
from smogline.sources import sinks as S
from smogline.sources import versions
from smogline.sources.fact_store import FactStore, buckets_for

COLS = ("measurement_sk long, station_id int, pollutant_id string, ts_utc timestamp_ntz, value double, unit string, "
        "source string, is_valid boolean, inserted_at timestamp_ntz, processed_at timestamp_ntz")


def facts(spark, n, first=1, year=2020, hot=0):
    """n facts from ``first`` on, in three years; ``hot`` more in the last."""
    rows = spark.range(first, first + n + hot).select(
        F.col("id").alias("measurement_sk"), (F.col("id") % 7).cast("int").alias("station_id"),
        F.lit("pm10").alias("pollutant_id"),
        F.when(F.col("id") < first + n, F.make_date(F.lit(year) + (F.col("id") % 3).cast("int"), F.lit(1), F.lit(1)))
        .otherwise(F.make_date(F.lit(year + 2), F.lit(2), F.lit(1))).cast("timestamp_ntz").alias("day"),
        F.col("id").cast("double").alias("value"), F.lit("u").alias("unit"), F.lit("s").alias("source"),
        F.lit(True).alias("is_valid"), F.lit("2024-01-01").cast("timestamp_ntz").alias("inserted_at"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("processed_at"))
    rows = rows.withColumn("ts_utc", F.expr("day + make_dt_interval(0, 0, 0, measurement_sk)"))
    return rows.select(*[c.split()[0] for c in COLS.split(", ")])


def store_of(spark, rows, **kw):
    return FactStore(spark, tempfile.mkdtemp(prefix="smogline-store-"), **kw).create(rows)


def content(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def changes(rows):
    return rows.select("station_id", "pollutant_id", "ts_utc", (F.col("value") + 0.5).alias("value"), "unit", "source")


def test_upsert_agrees_with_the_plain_one(spark):
    base = facts(spark, 300)
    store = store_of(spark, base, rows_per_bucket=30)
    upd = changes(base.filter("measurement_sk % 5 = 0")).unionByName(changes(facts(spark, 50, first=1000, year=2030)))
    want = U.upsert_measurements(base, upd, now="2025-01-01 00:00:00")
    years = store.upsert(upd, now="2025-01-01 00:00:00")
    assert years == [2020, 2021, 2022, 2030, 2031, 2032]
    assert content(store.read()) == content(want)
    # numbers go on from the largest one ever given
    again = changes(facts(spark, 5, first=5000, year=2040))
    store.upsert(again, now="2025-01-01 00:00:00")
    new = [r.measurement_sk for r in store.read([2040, 2041, 2042]).orderBy("measurement_sk").collect()]
    assert new == [351, 352, 353, 354, 355]


def test_only_touched_years_are_rewritten(spark):
    store = store_of(spark, facts(spark, 300), rows_per_bucket=50)
    was = {r.year: r for r in store.years().collect()}
    assert {r.buckets for r in was.values()} == {2}
    assert store.upsert(changes(facts(spark, 300).filter("year(ts_utc) = 2021"))) == [2021]
    now = {r.year: r for r in store.years().collect()}
    assert now[2020] == was[2020] and now[2022] == was[2022] and now[2021].v != was[2021].v
    assert [r.n_rows for r in now.values()] == [100, 100, 100]


def test_the_store_side_is_not_shuffled(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.insertInto

    def insert(self, *a, **k):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *a, **k)

    base = facts(spark, 300)
    store = store_of(spark, base, rows_per_bucket=40)
    monkeypatch.setattr(DataFrameWriter, "insertInto", insert)
    monkeypatch.setattr(store, "_drop_parts", lambda: None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.upsert(changes(base.filter("year(ts_utc) = 2021")))
        store.mark_processed(base.filter("year(ts_utc) = 2021"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2
    for plan in plans:
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        above, d = [], depth[scan]
        for i in range(scan, -1, -1):  # the scan's ancestors
            if depth[i] < d or i == scan:
                above.append(lines[i])
                d = depth[i]
        assert any("SortMergeJoin" in line for line in above)
        assert not any("Exchange" in line for line in above), plan
        assert sum("Exchange hashpartitioning" in line for line in lines) >= 1  # the changes' side


def test_a_year_that_outgrows_its_buckets(spark):
    store = store_of(spark, facts(spark, 30), rows_per_bucket=10)
    assert [r.buckets for r in store.years().collect()] == [1, 1, 1]
    more = changes(facts(spark, 90, first=100))
    want = U.upsert_measurements(facts(spark, 30), more, now="2025-01-01 00:00:00")
    store.upsert(more, now="2025-01-01 00:00:00")
    assert [(r.n_rows, r.buckets) for r in store.years().collect()] == [(40, 4)] * 3
    assert content(store.read()) == content(want)


def test_a_failed_write_leaves_the_old_rows(spark):
    def known():
        return {t.name for t in spark.catalog.listTables()}

    names = known()
    store = store_of(spark, facts(spark, 60))
    before = content(store.read())
    bad = changes(facts(spark, 60)).withColumn("value", F.when(F.col("value") > 40, F.raise_error(F.lit("lost"))).otherwise(F.col("value")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        store.upsert(bad)
    assert content(store.read()) == before
    # a run that ends after the data and before the manifest
    kept = versions.commit
    try:
        versions.commit = lambda *a: (_ for _ in ()).throw(RuntimeError("ended"))
        with pytest.raises(RuntimeError, match="ended"):
            store.upsert(changes(facts(spark, 60)))
    finally:
        versions.commit = kept
    assert content(store.read()) == before
    store.upsert(changes(facts(spark, 60)))
    assert content(store.read()) != before
    # no definition is left in the session
    assert known() == names


def test_a_store_is_read_while_it_is_replaced(spark):
    store = store_of(spark, facts(spark, 60))
    reading = store.read()
    before = content(reading)
    store.upsert(changes(facts(spark, 60)))
    assert content(reading) == before and content(store.read()) != before


def test_replace_moves_and_deletes(spark):
    base = facts(spark, 90)
    store = store_of(spark, base, keys=["measurement_sk"], rows_per_bucket=20)
    # all of 2021 goes to 2031
    moved = base.filter("year(ts_utc) = 2021").withColumn("ts_utc", F.expr("ts_utc + INTERVAL 10 YEAR"))
    assert store.replace(moved) == [2021, 2031]
    assert [r.year for r in store.years().collect()] == [2020, 2022, 2031]
    want = base.filter("year(ts_utc) <> 2021").unionByName(moved)
    assert content(store.read().drop("year")) == content(want)


def test_empty_changes_null_times_and_second_store(spark):
    store = store_of(spark, facts(spark, 30))
    version = store.manifest()["version"]
    assert store.upsert(changes(facts(spark, 30).limit(0))) == []
    assert store.manifest()["version"] == version
    with pytest.raises(Exception, match="without a time"):
        store.upsert(changes(facts(spark, 3)).withColumn("ts_utc", F.lit(None).cast("timestamp_ntz")))
    with pytest.raises(ValueError):
        FactStore(spark, store.root).create(facts(spark, 3))
    with pytest.raises(ValueError):
        FactStore(spark, tempfile.mkdtemp()).read()
    assert store_of(spark, facts(spark, 1).limit(0)).read().count() == 0


def test_published_tables(spark):
    root = tempfile.mkdtemp(prefix="smogline-table-")
    assert S.write_table(spark.range(10), root)["rows"] == 10
    first = S.read_table(spark, root)
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        S.write_table(bad, root)
    assert S.read_table(spark, root).count() == 10
    S.write_table(S.read_table(spark, root).filter("id < 4"), root)  # its own rows
    assert S.read_table(spark, root).count() == 4 and first.count() == 10
    # half of a manifest, as a lost writer would leave it
    fs, place = versions._place(spark, f"{root}/_live/0000000099.json")
    out = fs.create(place, False)
    out.write(bytearray(b'{"folder": "da'))
    out.close()
    assert S.read_table(spark, root).count() == 4
    S.write_table(spark.range(3), root)
    assert S.read_table(spark, root).count() == 3
    # a plain folder is read as it is
    spark.range(5).write.parquet(f"{root}-plain")
    assert S.read_table(spark, f"{root}-plain").count() == 5


def test_two_writers_of_one_version(spark):
    root = tempfile.mkdtemp(prefix="smogline-table-")
    S.write_table(spark.range(1), root)
    seen = versions.manifest(spark, root)
    S.write_table(spark.range(2), root)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.commit(spark, root, {"folder": "x"}, seen)
    assert S.read_table(spark, root).count() == 2


def test_files_follow_the_rows_of_a_year(spark):
    path = tempfile.mkdtemp(prefix="smogline-layout-") + "/facts"
    rows = facts(spark, 300, hot=5000).withColumn("year", F.year("ts_utc"))
    S.write_facts_by_year(rows, path, rows_per_file=200)
    back = spark.read.parquet(path).select("year", F.col("_metadata.file_path").alias("f"))
    files = back.groupBy("year", "f").count().collect()
    by_year = {}
    for r in files:
        by_year.setdefault(r.year, []).append(r["count"])
    assert {y: len(v) for y, v in by_year.items()} == {2020: 1, 2021: 1, 2022: 26}
    assert max(max(v) for v in by_year.values()) <= 400
    assert sum(map(sum, by_year.values())) == 5300
    # one year again: the others stay
    S.write_facts_by_year(rows.filter("year = 2021").limit(7), path, rows_per_file=200)
    assert {r.year: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()} == {2020: 100, 2021: 7, 2022: 5100}


def test_buckets_double():
    assert [buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 41, 1000)] == [1, 1, 1, 2, 2, 4, 8, 128]
