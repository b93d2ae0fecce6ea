"""Fixed values that must equal the reference's for results to agree.

These are stated plainly and together; every other table is built from
them or from data.
"""

# --- fixed values: the reference's pollutant catalogue -----------------------
# (source variable name, pollutant_id, unit, daily limit, annual limit)
POLLUTANTS = [
    ("PM2.5", "pm25", "µg/m³", 15.0, 5.0),
    ("PM10", "pm10", "µg/m³", 45.0, 15.0),
    ("O3", "o3", "µg/m³", 100.0, None),
    ("NO2", "no2", "µg/m³", 25.0, 10.0),
    ("SO2", "so2", "µg/m³", 40.0, None),
    ("CO", "co", "mg/m³", 4.0, None),
]

# --- fixed values: compliance status labels ----------------------------------
STATUS_DAILY = "Excede límite diario"
STATUS_ANNUAL = "Excede límite anual"
STATUS_OK = "Dentro de límites"

# --- fixed values: parameter texts that count as "unset" (any case, trimmed) --
UNSET_TOKENS = ("", "NONE", "NULL", "N/A", "NA", "EMPTY")

# --- fixed values: base CSV column headers ------------------------------------
CSV_COLUMNS = {
    "station_id": "ID Estacion",
    "station": "Estación",
    "authority": "Autoridad Ambiental",
    "dept": "Nombre del Departamento",
    "muni": "Nombre del Municipio",
    "pollutant": "Variable",
    "year": "Año",
    "value": "Promedio",
    "lat": "Latitud",
    "lon": "Longitud",
    "station_type": "Tipo de Estación",
}

# --- fixed values: generator parameters ----------------------------------------
DEFAULT_MEAN = 25.0          # mean for a capability without data
DEFAULT_MEAN_CO = 1.5        # same, for carbon monoxide
TREND_CLIP = 0.1             # relative trend is clipped to +/- this
NOISE_SD_FRACTION = 0.2      # gaussian noise sd as a fraction of the mean
SEASONAL_AMPLITUDE = 0.15    # seasonal term amplitude as a fraction of the annual mean
WEEKEND_EFFECT = -0.2        # Saturday/Sunday
WEEKDAY_EFFECT = 0.1         # Monday..Friday
WEEKLY_POLLUTANTS = ("pm25", "pm10", "no2", "co")
SPIKE_FRACTION = 0.02        # share of days that spike
SPIKE_LOW, SPIKE_HIGH = 1.5, 2.5
SOURCE_BASE = "synthetic"
SOURCE_PROJECTED = "synthetic_projected"
DAYS_PER_YEAR = 365.25       # trend exponent unit
SEASON_PERIOD = 365          # seasonality period in days
EPOCH_YEAR_SECONDS = 31536000  # 365-day "year" of the epoch365 year mode

# --- fixed values: zone synthesis ranges ---------------------------------------
POPULATION_RANGE = (50000, 1500000)      # [low, high)
CENTROID_LAT_RANGE = (1.0, 11.0)
CENTROID_LON_RANGE = (-79.0, -66.0)

# --- fixed values: incremental extract -----------------------------------------
EXTRACT_FLOOR_DATE = "2000-01-01"

