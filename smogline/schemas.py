"""Declared schemas of the catalogues, the fact and the analysis outputs."""

from pyspark.sql import types as T

ZONES = T.StructType([
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("city_code", T.StringType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("zone_code", T.StringType()),
    T.StructField("zone_name", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("centroid_lat", T.DoubleType()),
    T.StructField("centroid_lon", T.DoubleType()),
])

STATIONS = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("station_code", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("zone_id", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("station_type", T.StringType()),
    T.StructField("authority", T.StringType()),
    T.StructField("years_min", T.IntegerType()),
    T.StructField("years_max", T.IntegerType()),
])

POLLUTANTS = T.StructType([
    T.StructField("pollutant_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("default_unit", T.StringType()),
    T.StructField("who_daily_limit", T.DoubleType()),
    T.StructField("who_annual_limit", T.DoubleType()),
])

CAPABILITIES = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("pollutant_id", T.StringType()),
    T.StructField("unit", T.StringType()),
])

MEASUREMENTS_RAW = T.StructType([
    T.StructField("measurement_sk", T.LongType()),
    T.StructField("station_id", T.IntegerType()),
    T.StructField("pollutant_id", T.StringType()),
    T.StructField("ts_utc", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("inserted_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()),
])

# Columns each loader requires (op B12).
REQUIRED = {
    "zones": [f.name for f in ZONES.fields],
    "stations": [f.name for f in STATIONS.fields],
    "pollutants": [f.name for f in POLLUTANTS.fields],
    "station_capabilities": [f.name for f in CAPABILITIES.fields],
    "measurements_raw": ["station_id", "pollutant_id", "ts_utc", "value", "unit", "source"],
}

# Maximum text lengths of the store (op B19).
MAX_LENGTHS = {
    "zones": {"city_code": 10, "city_name": 100, "zone_code": 50, "zone_name": 100},
    "stations": {"station_code": 50, "station_name": 200, "station_type": 100, "authority": 100},
    "pollutants": {"pollutant_id": 20, "name": 100, "default_unit": 20},
    "station_capabilities": {"pollutant_id": 20, "unit": 20},
    "measurements_raw": {"pollutant_id": 20, "unit": 20, "source": 50},
}

# Output columns of the enriched warehouse fact, in order, with types (op B17).
ENRICHED_COLUMNS = [
    ("year", "int"), ("measurement_timestamp", "timestamp_ntz"), ("quarter", "int"),
    ("month_number", "int"), ("day_of_week", "int"), ("measurement_sk", "bigint"),
    ("measurement_value", "double"), ("measurement_unit", "string"),
    ("measurement_source", "string"), ("is_valid", "int"), ("pollutant_id", "string"),
    ("pollutant_name", "string"), ("pollutant_default_unit", "string"),
    ("who_daily_limit", "double"), ("who_annual_limit", "double"),
    ("who_compliance_status", "string"), ("station_id", "string"),
    ("station_code", "string"), ("station_name", "string"), ("station_type", "string"),
    ("authority", "string"), ("station_latitude", "double"),
    ("station_longitude", "double"), ("station_start_year", "int"),
    ("station_end_year", "int"), ("zone_id", "int"), ("zone_code", "string"),
    ("zone_name", "string"), ("city_code", "string"), ("city_name", "string"),
    ("zone_population", "int"), ("zone_centroid_lat", "double"),
    ("zone_centroid_lon", "double"), ("inserted_at", "timestamp_ntz"),
    ("processed_at", "timestamp_ntz"), ("etl_loaded_at", "timestamp_ntz"),
]
