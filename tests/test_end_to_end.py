"""The batch jobs chained as a user runs them, on the smallest driver tables:
annual CSV files -> catalogues -> daily series -> year-partitioned facts ->
cleaning -> upsert into the store -> enriched warehouse fact and analyses."""

import tempfile

from pyspark.sql import functions as F

from smogline import schemas
from smogline import constants as K
from smogline.operators import catalogs as CAT
from smogline.operators import cleaning as C
from smogline.operators import enrich as E
from smogline.operators import synth as SY
from smogline.operators import timeseries as TS
from smogline.operators import upsert as U
from smogline.plans.q_catalog import WIN
from smogline.sources import base_csv as B
from smogline.sources import sinks as S
from smogline.sources import years as Y
from tests.conftest import SF_SMALL


def test_jobs_chain_end_to_end(spark):
    work = tempfile.mkdtemp(prefix="smogline-e2e-")
    # 1. The annual CSV as files, with padded headers.
    rows = B.driver_base_rows(spark, SF_SMALL).drop(B.POS)
    rows.toDF(*[f" {c} " for c in rows.columns]).write.option("header", True).csv(f"{work}/csv")
    csv = B.read_base_csv(spark, f"{work}/csv")
    typed = B.typed_base(csv)
    base = B.compact_rows(typed)

    # 2. Catalogues and the generated daily series.
    codes = CAT.variable_codes(spark)
    zones = CAT.zones(base, csv)
    stations = CAT.stations(base, zones, WIN.end_year, WIN.base_data_end)
    sums = SY.series_sums(base, codes)
    caps = CAT.capabilities(spark, base, stations, pairs=sums)
    plan = SY.series_plan(caps, stations, SY.raw_means_from(sums), SY.trends(SY.yearly_means_from(sums)), WIN)
    series = SY.daily_series(plan, WIN)
    S.write_facts_by_year(series, f"{work}/facts")
    assert SY.days_by_year(plan) == {r.year: r["count"] for r in spark.read.parquet(f"{work}/facts").groupBy("year").count().collect()}
    S.write_table(zones, f"{work}/zones")
    stations.write.parquet(f"{work}/stations")
    left = {r.table: (r.n, r.ok) for r in S.output_check(
        spark, {"zones": f"{work}/zones", "stations": f"{work}/stations", "missing": f"{work}/none"}, f"{work}/facts").collect()}
    years = sorted(SY.days_by_year(plan))
    assert left == {"zones": (zones.count(), True), "stations": (stations.count(), True), "missing": (0, False),
                    "measurement_years": (len(years), True)}
    assert S.loaded_years(spark, f"{work}/facts") == years and S.loaded_years(spark, f"{work}/none") == []
    n_caps, n_days = caps.count(), plan.agg(F.sum(F.datediff("last_day", "first_day") + 1)).first()[0]
    assert n_caps > 0

    # 3. Read the years back, clean (ISO text timestamps are parsed), upsert into an empty store.
    years = Y.years_to_process(year_start=WIN.start_year, year_end=WIN.end_year)
    raw = Y.read_years(spark, f"{work}/facts", years).select(
        "station_id", "pollutant_id", "ts_utc", "value", "unit", "source",
        F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))
    report = C.cleaning_report(raw.drop("_f", "_r")).first()
    assert report.initial_count == n_days and report.final_count == n_days
    clean = C.clean_measurements(raw, ["_f", "_r"])
    store = spark.createDataFrame([], schemas.MEASUREMENTS_RAW)
    stored = U.upsert_measurements(store.drop("year"), clean, now="2030-01-01 00:00:00")
    got = stored.agg(F.count(F.lit(1)).alias("n"), F.min("measurement_sk").alias("lo"),
                     F.max("measurement_sk").alias("hi"), F.count_distinct("measurement_sk").alias("d")).first()
    assert (got.n, got.lo, got.hi, got.d) == (n_days, 1, n_days, n_days)
    # Loading the same facts again changes nothing.
    again = U.upsert_measurements(stored.drop("year"), clean, now="2031-01-01 00:00:00")
    assert again.count() == n_days and again.agg(F.max("measurement_sk")).first()[0] == n_days

    # 4. The warehouse fact and the analyses over the store.
    fact = E.enriched_fact(stored, CAT.pollutant_catalogue(spark), stations, zones, loaded_at="2030-01-02")
    # the extract's floor date leaves earlier days out
    floor = F.lit(K.EXTRACT_FLOOR_DATE).cast("date")
    n_recent = plan.agg(F.sum(F.greatest(F.datediff("last_day", F.greatest("first_day", floor)) + 1, F.lit(0)))).first()[0]
    assert 0 < n_recent < n_days
    assert fact.count() == n_recent and len(fact.columns) == 36
    assert fact.filter(F.col("pollutant_name").isNull()).count() == 0
    stats = TS.yearly_stats(stored)
    assert stats.agg(F.sum("count_records")).first()[0] == n_days
    assert TS.daily_derivative(stored).count() == n_days - n_caps
