import math

import pytest
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import catalogs as CAT
from smogline.operators import synth as SY
from smogline.operators import upsert as U
from smogline.sources import base_csv as B


def test_upsert_replace_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = U.upsert_replace(t, u, ["k"])
    twice = U.upsert_replace(once, u, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "C")]


def _raw(spark, rows):
    return spark.createDataFrame(rows, "measurement_sk long, station_id int, pollutant_id string, t string, "
                                       "value double, unit string, source string, is_valid boolean, "
                                       "inserted_at timestamp_ntz, processed_at timestamp_ntz") \
        .withColumn("ts_utc", F.col("t").cast("timestamp_ntz")).drop("t")


def test_measurement_upsert(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    target = _raw(spark, [(10, 1, "a", "2024-01-01 00:00:00", 1.0, "u", "s", False, t0, t0),
                          (11, 1, "a", "2024-01-02 00:00:00", 2.0, "u", "s", True, t0, t0)])
    upd = spark.createDataFrame([(1, "a", "2024-01-01 00:00:00", 9.0, "u2", "s2", 1),
                                 (1, "a", "2024-01-01 00:00:00", 7.0, "u3", "s3", 2),
                                 (2, "b", "2024-01-03 00:00:00", 5.0, "u", "s", 3),
                                 (1, "b", "2024-01-03 00:00:00", 6.0, "u", "s", 4)],
                                "station_id int, pollutant_id string, t string, value double, unit string, "
                                "source string, pos int").withColumn("ts_utc", F.col("t").cast("timestamp_ntz"))
    out = {r.measurement_sk: r for r in
           U.upsert_measurements(target, upd, now="2025-01-01 00:00:00", update_order=["pos"]).collect()}
    assert set(out) == {10, 11, 12, 13}
    r10 = out[10]
    assert (r10.value, r10.unit, r10.is_valid, r10.processed_at, r10.inserted_at) == (7.0, "u3", False, None, t0)
    assert out[11].processed_at == t0
    assert (out[12].station_id, out[12].pollutant_id) == (1, "b")   # new keys numbered in key order
    assert (out[13].station_id, out[13].pollutant_id) == (2, "b")
    assert out[13].is_valid is True and out[13].processed_at is None


def test_surrogate_keys_dense_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = U.assign_surrogate_keys(df, ["k"], start=100).collect()
    got = sorted((r.k, r.measurement_sk) for r in out)
    assert [sk for _, sk in got] == list(range(101, 5101))


def test_mark_processed(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    target = _raw(spark, [(1, 1, "a", "2024-01-01 00:00:00", 1.0, "u", "s", True, t0, None),
                          (2, 1, "a", "2024-01-02 00:00:00", 2.0, "u", "s", True, t0, None)])
    out = {r.measurement_sk: r.processed_at
           for r in U.mark_processed(target, target.filter("measurement_sk = 2"), now="2024-02-01").collect()}
    assert out == {1: None, 2: dt.datetime(2024, 2, 1)}


def _base(spark):
    c = B.COLS
    rows = [
        ("1,234", None, "A", "antioquia", "medellín", "PM2.5", "2019", "1,000.5", "6.2", "-75.5", "U", 1),
        ("1,234", "est. norte", "A", "antioquia", "medellín", "PM2.5", "2020", "10", "6.3", "-75.6", "U", 2),
        ("1234", "dup", "A", "antioquia", "medellín", "PM10", "2021", "5", "6.3", "-75.6", "U", 3),
        ("abc", "bad id", "A", "x", "y", "PM10", "2020", "5", "1", "1", "U", 4),
        ("7", "siete", "B", "valle", "san-juan o'neil", "CO", "2018", "2", "nan", "2", "R", 5),
        ("8", "ocho", "B", "otro", "Medellin", "Benzene", "2020", "3", "1", "1", "R", 6),
    ]
    df = spark.createDataFrame(rows, [c["station_id"], c["station"], c["authority"], c["dept"], c["muni"],
                                      c["pollutant"], c["year"], c["value"], c["lat"], c["lon"],
                                      c["station_type"], B.POS])
    return B.typed_base(df)


def test_catalogues_from_csv_rows(spark):
    b = _base(spark)
    assert b.count() == 5  # Benzene dropped
    assert b.filter(F.col("value") == 1000.5).count() == 1
    zones = CAT.zones(b).collect()
    assert sorted(z.city_name for z in zones) == ["Medellin", "San-Juan O'Neil", "Y"]
    # first seen in the input rows 1, 4 and 5
    assert {(z.zone_id, z.zone_code) for z in zones} == {(1, "Z01"), (4, "Z04"), (5, "Z05")}
    assert all(K.POPULATION_RANGE[0] <= z.population < K.POPULATION_RANGE[1] for z in zones)
    st = {r.station_id: r for r in CAT.stations(b, CAT.zones(b), end_year=2025, base_data_end=2020).collect()}
    assert set(st) == {1234, 7}              # "abc" skipped
    s = st[1234]
    assert s.station_code == "ST-1234"       # the first raw id ("1,234" sorts before "1234")
    assert s.station_name == "Est. Norte"    # first non-null name
    assert (s.years_min, s.years_max) == (2019, 2025)
    assert s.lat == 6.2
    assert st[7].zone_id == [z.zone_id for z in zones if z.city_name == "San-Juan O'Neil"][0]
    assert st[7].lat is None
    caps = {(r.station_id, r.pollutant_id, r.unit) for r in CAT.capabilities(spark, b, CAT.stations(b, CAT.zones(b), 2025, 2020)).collect()}
    assert caps == {(1234, "pm25", "µg/m³"), (1234, "pm10", "µg/m³"), (7, "co", "mg/m³")}


def test_pollutant_constants(spark):
    rows = {r.pollutant_id: r for r in CAT.pollutant_catalogue(spark).collect()}
    assert set(rows) == {"pm25", "pm10", "o3", "no2", "so2", "co"}
    assert rows["o3"].who_annual_limit is None and rows["co"].default_unit == "mg/m³"


def test_trend_clip_and_gates(spark):
    ym = spark.createDataFrame(
        [("s1", "pm25", float(y), 10.0 + 5 * i) for i, y in enumerate(range(2018, 2022))]
        + [("s2", "pm25", 2019.0, 5.0), ("s2", "pm25", 2020.0, 6.0)]
        + [("s3", "pm25", float(y), 4.0) for y in (2018, 2019, 2020)]
        + [("s4", "pm25", float(y), 100.0 + i) for i, y in enumerate(range(2018, 2021))],
        "station_key string, pollutant_id string, year double, year_mean double")
    got = {r.station_key: r.trend for r in SY.trends(ym).collect()}
    assert set(got) == {"s1", "s4"}
    assert got["s1"] == 0.1
    assert abs(got["s4"] - 1.0 / 101.0) < 1e-12


def test_generator_properties(spark):
    win = SY.Window_(start_year=2020, end_year=2021, base_data_end=2020, end_date="2021-03-31")
    plan = spark.createDataFrame(
        [(1, "pm25", "µg/m³", 20.0, 0.05, 2020, 2021), (2, "co", "mg/m³", 1.5, 0.0, 2020, 2020)],
        "station_id int, pollutant_id string, unit string, annual_mean double, trend double, "
        "start_year int, end_year int")
    plan = plan.withColumn("first_day", F.make_date("start_year", F.lit(1), F.lit(1))) \
        .withColumn("last_day", F.when(F.col("end_year") == 2021, F.lit("2021-03-31").cast("date"))
                    .otherwise(F.make_date("end_year", F.lit(12), F.lit(31)))) \
        .withColumn("is_extended", F.col("end_year") > 2020)
    out = SY.daily_series(plan, win, partitions=4)
    rows = out.collect()
    s1 = [r for r in rows if r.station_id == 1]
    s2 = [r for r in rows if r.station_id == 2]
    assert len(s1) == 366 + 90 and len(s2) == 366
    assert all(r.value >= 0 for r in rows)
    assert all(round(r.value, 1) == r.value for r in s2)
    assert {r.source for r in s1} == {K.SOURCE_BASE, K.SOURCE_PROJECTED}
    assert s1[0].ts_utc.endswith("T00:00:00Z")
    mean = sum(r.value for r in s2) / len(s2)
    assert 1.2 < mean < 1.8
    again = sorted(SY.daily_series(plan, win, partitions=3).collect())
    assert again == sorted(rows)   # hash-seeded: independent of partitioning


def test_upsert_only_touched_years(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    target = _raw(spark, [(1, 1, "a", "2023-05-01 00:00:00", 1.0, "u", "s", True, t0, None),
                          (2, 1, "a", "2024-05-01 00:00:00", 2.0, "u", "s", True, t0, None)]) \
        .withColumn("year", F.year("ts_utc"))
    upd = spark.createDataFrame([(1, "a", "2024-05-01 00:00:00", 9.0, "u", "s")],
                                "station_id int, pollutant_id string, t string, value double, unit string, "
                                "source string").withColumn("ts_utc", F.col("t").cast("timestamp_ntz"))
    out = U.upsert_measurements(target, upd, now="2025-01-01", only_touched_years=True).collect()
    assert [(r.measurement_sk, r.value, r.year) for r in out] == [(2, 9.0, 2024)]


def test_compact_rows_give_the_same_catalogues(spark):
    """Zones, stations, capabilities, means and trends read from the compact
    form equal those read from the raw typed rows (nulls, NaN coordinates,
    repeated combinations and positions out of input order included)."""
    c = B.COLS
    rows = [
        ("5", None, "A", "d1", "m1", "PM2.5", "2018", "10", "nan", "-75", "U", 9),
        ("5", "late name", "A", "d1", "m1", "PM2.5", "2019", "20", "6.5", "-75", "U", 7),
        ("5", "early name", "A", "d1", "m1", "PM2.5", "2020", "30", "6.1", "-75", "U", 3),
        ("5", "early name", "A", "d1", "m1", "PM2.5", "2020", "50", "6.1", "-75", "U", 1),
        ("5", "early name", "A", "d2", "m2", "PM10", "2021", "40", None, None, None, 2),
        ("6", "six", None, "d2", "m2", "NO2", "2018", "1", "1", "1", "R", 4),
        ("6", "six", "B", "d2", "m2", "NO2", "2019", "2", "1", "1", "R", 8),
        ("6", "six", "B", "d2", "m2", "NO2", "2020", "7", "1", "1", "R", 6),
        ("6", "six", "B", "d2", "m2", "NO2", "2020", None, "1", "1", "R", 5),
    ]
    raw = B.typed_base(spark.createDataFrame(
        rows, [c["station_id"], c["station"], c["authority"], c["dept"], c["muni"], c["pollutant"], c["year"],
               c["value"], c["lat"], c["lon"], c["station_type"], B.POS]))
    comp = B.compact_rows(raw)
    assert comp.count() < raw.count()

    def same(a, b):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))

    same(CAT.zones(raw), CAT.zones(comp, raw))
    with pytest.raises(ValueError):
        CAT.zones(comp)
    st_raw = CAT.stations(raw, CAT.zones(raw), 2025, 2020)
    st_comp = CAT.stations(comp, CAT.zones(comp, raw), 2025, 2020)
    same(st_raw, st_comp)
    s5 = st_comp.filter("station_id = 5").first()
    assert (s5.station_name, s5.lat, s5.station_type) == ("Early Name", 6.1, "U")
    codes = CAT.variable_codes(spark)
    same(CAT.capabilities(spark, raw, st_raw), CAT.capabilities(spark, comp, st_comp, pairs=SY.series_sums(comp, codes)))
    r = SY.raw_means(raw, codes)
    same(r, SY.raw_means_from(SY.series_sums(comp, codes)).select(*r.columns))
    y = SY.yearly_means(raw, codes)
    same(y, SY.yearly_means_from(SY.series_sums(comp, codes)).select(*y.columns))
    same(SY.trends(y), SY.trends(SY.yearly_means_from(SY.series_sums(comp, codes))))


def test_zone_ids_count_all_input_rows(spark):
    """Ids are row numbers of the unfiltered input: rows of unknown variables and repeats leave gaps."""
    c = B.COLS
    seen = [("Benzene", "d1", "m1"), ("PM10", "d1", "m1"), ("CO", "d1", "m1"), ("Benzene", "d2", "m2"), ("O3", "d2", "m2")]
    rows = spark.createDataFrame(
        [("1", "s", "A", d, m, v, "2020", "1", "1", "1", "U", i) for i, (v, d, m) in enumerate(seen)],
        [c["station_id"], c["station"], c["authority"], c["dept"], c["muni"], c["pollutant"], c["year"],
         c["value"], c["lat"], c["lon"], c["station_type"], B.POS])
    got = CAT.zones(B.typed_base(rows), rows).collect()
    assert {(r.city_name, r.zone_id, r.zone_code) for r in got} == {("M1", 2, "Z02"), ("M2", 5, "Z05")}


def test_cascade_delete_zones(spark):
    zones = spark.createDataFrame([(1, "Z01"), (2, "Z02")], "zone_id int, zone_code string")
    stations = spark.createDataFrame([(10, 1), (11, 1), (20, 2)], "station_id int, zone_id int")
    caps = spark.createDataFrame([(10, "pm25"), (20, "pm25"), (20, "co")], "station_id int, pollutant_id string")
    # Station 10 holds most of the measurements (a hot key).
    meas = spark.range(0, 300).select(
        F.when(F.col("id") < 200, F.lit(10)).when(F.col("id") < 250, F.lit(11)).otherwise(F.lit(20))
        .cast("int").alias("station_id"), F.col("id").alias("measurement_sk"))
    out = U.cascade_delete_zones(zones, stations, caps, meas, spark.createDataFrame([(1,), (1,)], "zone_id int"))
    assert [r.zone_id for r in out["zones"].collect()] == [2]
    assert [r.station_id for r in out["stations"].collect()] == [20]
    assert sorted(r.pollutant_id for r in out["station_capabilities"].collect()) == ["co", "pm25"]
    m = out["measurements_raw"]
    assert m.count() == 50 and {r.station_id for r in m.collect()} == {20}


def test_measurement_upsert_is_idempotent(spark):
    """Applying the same updates again changes nothing: every key now matches,
    values are the same, keys and insert times are kept."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    target = _raw(spark, [(10, 1, "a", "2024-01-01 00:00:00", 1.0, "u", "s", True, t0, t0)])
    upd = spark.createDataFrame([(1, "a", "2024-01-01 00:00:00", 9.0, "u", "s"),
                                 (2, "b", "2024-01-03 00:00:00", 5.0, "u", "s")],
                                "station_id int, pollutant_id string, t string, value double, unit string, "
                                "source string").withColumn("ts_utc", F.col("t").cast("timestamp_ntz"))
    once = U.upsert_measurements(target, upd, now="2025-01-01 00:00:00")
    cols = [c for c in once.columns if c != "year"]
    twice = U.upsert_measurements(once.select(*cols), upd, now="2026-01-01 00:00:00")
    assert sorted(map(tuple, once.select(*cols).collect())) == sorted(map(tuple, twice.select(*cols).collect()))
    assert once.count() == 2


def test_spike_count_is_two_percent_of_days(spark):
    plan = spark.createDataFrame(
        [(1, "pm25", "2020-01-01", "2020-12-31"), (2, "co", "2021-01-01", "2021-03-31"),
         (3, "no2", "2021-01-01", "2021-01-20")],
        "station_id int, pollutant_id string, f string, l string") \
        .select("station_id", "pollutant_id", F.col("f").cast("date").alias("first_day"),
                F.col("l").cast("date").alias("last_day"))
    days = plan.withColumn("d", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))))
    got = {r.station_id: (r.n, r.spikes, r.lo, r.hi) for r in SY.with_spikes(days).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_spike") != 1.0).alias("spikes"),
        F.min(F.when(F.col("_spike") != 1.0, F.col("_spike"))).alias("lo"),
        F.max(F.when(F.col("_spike") != 1.0, F.col("_spike"))).alias("hi")).collect()}
    assert {k: (n, s) for k, (n, s, _, _) in got.items()} == {1: (366, 7), 2: (90, 1), 3: (20, 0)}
    assert all(1.5 <= lo <= hi < 2.5 for _, s, lo, hi in got.values() if s)


def _store(spark):
    rows = [(y * 10 + k, k, "pm25", f"{y}-0{k}-01 00:00:00", 1.0) for y in (2023, 2024) for k in range(1, 6)]
    df = spark.createDataFrame(rows, "measurement_sk long, station_id int, pollutant_id string, ts string, value double")
    return df.selectExpr("measurement_sk", "station_id", "pollutant_id", "CAST(ts AS timestamp_ntz) AS ts_utc", "value", "'u' AS unit",
                         "'s' AS source", "true AS is_valid", "CAST(ts AS timestamp_ntz) AS inserted_at",
                         "CAST(NULL AS timestamp_ntz) AS processed_at", "year(CAST(ts AS timestamp_ntz)) AS year")


def test_new_rows_of_an_older_year_get_unused_keys(spark):
    store = _store(spark)
    upd = spark.createDataFrame([(9, "pm25", "2023-07-01", 5.0, "u", "s"), (1, "pm25", "2023-01-01", 2.0, "u", "s"),
                                 (1, "pm25", "2023-01-01", 3.0, "u", "s")],
                                "station_id int, pollutant_id string, ts string, value double, unit string, source string")
    upd = upd.withColumn("ts_utc", F.col("ts").cast("timestamp_ntz")).drop("ts")
    out = U.upsert_measurements(store, upd, now="2025-01-01", only_touched_years=True).collect()
    assert {r.year for r in out} == {2023} and len(out) == 6
    used = {r.measurement_sk for r in store.collect()}
    assert [r.measurement_sk for r in out if r.station_id == 9] == [max(used) + 1]
    assert [r.value for r in out if r.station_id == 1] == [3.0]


def test_repeated_updates_apply_one_by_one(spark):
    t = spark.createDataFrame([(1, "a"), (5, "e")], "k int, v string")
    u = spark.createDataFrame([(1, "b", 1), (1, "c", 0), (2, "x", 1), (2, "y", 2)], "k int, v string, n int")
    got = U.upsert_replace(t.withColumn("n", F.lit(0)), u, ["k"], order=["n"]).collect()
    assert sorted((r.k, r.v) for r in got) == [(1, "b"), (2, "y"), (5, "e")]
    yes, no = U.insert_if_absent(t.withColumn("n", F.lit(0)), u, ["k"], order=["n"])
    assert [(r.k, r.v) for r in yes.collect()] == [(2, "x")]
    assert sorted((r.k, r.v) for r in no.collect()) == [(1, "b"), (1, "c"), (2, "y")]


def test_row_numbers_whatever_the_splits(spark):
    """Numbers of CSV rows follow their place in the file, for splits of any size; no sort of all rows."""
    import os
    import tempfile

    from smogline.operators.positions import row_numbers

    folder = tempfile.mkdtemp(prefix="smogline-csv-")
    names = list(B.COLS.values())
    with open(os.path.join(folder, "rows.csv"), "w", encoding="utf-8") as f:
        f.write(",".join(names) + "\n")
        for i in range(4000):
            f.write(",".join(str(i) if c == B.COLS["station_id"] else "x" * (i % 9) for c in names) + "\n")
    for size in ("2k", "9k", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            rows = B.read_base_csv(spark, folder)
            asked = rows.filter(F.col(B.COLS["station_id"]).isin("0", "17", "2500", "3999"))
            got = row_numbers(rows, asked, B.POS)
            assert sorted(r.row_number for r in got.collect()) == [1, 18, 2501, 4000]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_row_numbers_of_key_positions(spark, monkeypatch):
    from smogline.operators import positions

    monkeypatch.setattr(positions, "BLOCK_ROWS", 7)
    keys = [(i * i % 101, i % 3) for i in range(90)]
    rows = spark.createDataFrame([((a, b),) for a, b in keys], f"{B.POS} struct<a: long, b: int>")
    want = sorted(keys)
    got = positions.row_numbers(rows, rows.filter(F.col(f"{B.POS}.a") % 5 == 0), B.POS).collect()
    assert {(tuple(r[0]), r[1]) for r in got} == {(k, want.index(k) + 1) for k in keys if k[0] % 5 == 0}
    one = spark.createDataFrame([(x,) for x in (5, 9, 9, 2)], f"{B.POS} long")
    assert {tuple(r) for r in positions.row_numbers(one, one, B.POS).collect()} == {(2, 1), (5, 2), (9, 3)}
    assert positions.row_numbers(one.limit(0), one.limit(0), B.POS).count() == 0
