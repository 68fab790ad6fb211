"""Fixed values that results depend on.

They are part of the data contract (file layout, season calendars, column
names), so they are stated here once, as plain text, and used everywhere else.
"""

import datetime

# --- Wide day files -------------------------------------------------------
DAY_FILE_PATTERN = "cyme_load_timeseries_day_{}.txt"
HEADER_PREFIX = "FORMAT="
HEADER_LINE = "FORMAT=ID,PROFILETYPE,INTERVALFORMAT,TIMEINTERVAL,GLOBALUNIT,NETWORKID,YEAR,MONTH,DAY,UNIT,PHASE,VALUES"
HEADER_WITHIN_LINES = 10
ROW_PREFIX = "res_"
META_CELLS = 11
MINUTES_PER_CELL = 15
MISSING_WORDS = ("NONE", "NULL")
FIRST_DAY = datetime.date(2016, 1, 1)
DEFAULT_DAY = 1

# --- Warehouse tables -----------------------------------------------------
BATCH_READINGS_TABLE = "raw_load_data"
STREAM_READINGS_TABLE = "kafka_raw_data"
READINGS_TOPIC = "sensor-data"
SENSOR_TOPIC_PATTERN = "sensor-topic-(accelerometer|gyroscope|light|magnetometer|proximity)"
MAX_OFFSETS_PER_TRIGGER = 10000
STREAM_TRIGGER = "5 seconds"
FANOUT_TRIGGER = "1 minute"

# --- Calendars ------------------------------------------------------------
# Three season conventions coexist; each consumer names the one it means.
PI = 3.14159
MODEL_SEASONS = {
    "spring": (1, 2, 3, 4, 5),
    "summer": (6, 7, 8, 9),
    "autumn": (10, 11, 12),
}
SEASON_LAST_DAY = {"spring": "05-31", "summer": "09-30", "autumn": "12-31"}
GENERAL_SEASON = "general"
FLAG_SUMMER_MONTHS = (12, 1, 2)
FLAG_WINTER_MONTHS = (6, 7, 8)
PROFILE_WINTER_MONTHS = (12, 1, 2)
PROFILE_SUMMER_MONTHS = (6, 7, 8)
SAMPLE_DAYS_PER_MONTH = 8
SAMPLE_DAY_STEP = 4

# --- Expected load profile ------------------------------------------------
PROFILE_BASE = 35.0
PROFILE_SEASON_FACTORS = {"winter": 1.4, "summer": 1.3, "other": 0.9}
PROFILE_HOUR_FACTORS = {"peak": 1.5, "night": 0.5, "other": 1.0}
PROFILE_PEAK_HOURS = ((6, 9), (17, 22))
PROFILE_NIGHT_FROM, PROFILE_NIGHT_TO = 23, 5
PROFILE_WEEKEND_FACTOR = 0.85
PROFILE_BOUNDS = (10.0, 90.0)

# --- Models ---------------------------------------------------------------
SEASON_MODELS = {
    "spring": "spring_energy_model",
    "summer": "summer_energy_model",
    "autumn": "autumn_energy_model",
}
GENERAL_MODEL = "general_energy_model"
TARGET = "total_daily_energy"
LAG_STEPS = (1, 2, 3, 7)
AVERAGE_SPANS = (3, 7, 30)
EXTREME_SPAN = 7
TREND_SPANS = (3, 7)
SILVER_FEATURES = (
    "month", "dayofweek", "year",
    "energy_lag_1", "energy_lag_2", "energy_lag_3", "energy_lag_7",
    "rolling_avg_3d", "rolling_avg_7d", "rolling_avg_30d",
    "rolling_max_7d", "rolling_min_7d",
    "month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos",
    "is_weekend", "is_summer", "is_winter",
    "peak_to_avg_ratio", "energy_trend_3d", "energy_trend_7d",
    "avg_daily_load", "peak_daily_load", "customer_count",
)
SEASONAL_FEATURES = ("month", "day", "day_of_week", "month_sin", "day_sin", "is_weekend")
MIN_TRAINING_ROWS = 30
TEST_DAYS, VALIDATION_DAYS = 60, 15
OVERFIT_GAP = 0.1
SPLIT_SEED = 42
GBT = {
    "maxDepth": 6, "maxBins": 32, "maxIter": 100, "stepSize": 0.1,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt", "seed": 42,
}
SEASONAL_FOREST = {
    "spring": {"numTrees": 50, "maxDepth": 8, "seed": 42},
    "summer": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "autumn": {"numTrees": 100, "maxDepth": 10, "seed": 42},
}
RIDGE = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0}
ELASTIC_NET = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
