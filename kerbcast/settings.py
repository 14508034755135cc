"""Fixed values that define results, and limits that shape plans."""

from __future__ import annotations

# --- Fixed values: the published trip schema (public data dictionary names) ----------
PICKUP_TIME = "tpep_pickup_datetime"
DROPOFF_TIME = "tpep_dropoff_datetime"
RAW_COLUMNS = {
    "tpep_pickup_datetime": "start_time",
    "tpep_dropoff_datetime": "end_time",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "trip_distance": "trip_distance_miles",
    "fare_amount": "fare_amount",
}

# --- Fixed values: cleaning limits, inclusive ----------------------------------------
MIN_DURATION_MIN = 1
MAX_DURATION_MIN = 180
MIN_DISTANCE_MILES = 0.1
MAX_DISTANCE_MILES = 60
MAX_SPEED_MPH = 70
KM_PER_MILE = 1.609344
LOW_DAY_SHARE_OF_MEDIAN = 0.05

# --- Fixed values: service area and clock --------------------------------------------
LAT_MIN, LAT_MAX = 40.4766, 40.9176
LNG_MIN, LNG_MAX = -74.2588, -73.7002
SERVICE_TIME_ZONE = "America/New_York"
STALE_AFTER_DAYS = 30

# --- Fixed values: experiment defaults -----------------------------------------------
N_ZONES = 20
SEED = 42
ZONE_COUNT_CANDIDATES = tuple(range(5, 65, 5))
TRAIN_WINDOW_MONTHS = 12
EVAL_GAP_MONTHS = 2
BACKTEST_WINDOWS = (3, 6, 12, 24)
BACKTEST_TEST_MONTHS = 6
TUNING_TRIALS = 30
PROMOTION_TOLERANCE = 0.05
INGEST_LOOKBACK_MONTHS = 14
FEATURE_ORDER = (
    "pickup_zone",
    "hour",
    "day_of_week",
    "avg_ride_duration_min",
    "avg_ride_distance",
)
# Tree settings, under the names the decision records use.  Row sampling is off in the
# default: the shipped value has no effect without a sampling frequency.
TREE_PARAMS = {
    "n_estimators": 187,
    "num_leaves": 114,
    "learning_rate": 0.055238410897498764,
    "subsample": 0.6571467271687763,
    "colsample_bytree": 0.6624074561769746,
}

# Ranges that random trials are drawn from, and what every trial has.
SEARCH_SPACE = {
    "n_estimators": ("whole", 100, 600),
    "num_leaves": ("whole", 15, 255),
    "learning_rate": ("power of ten", -2, -0.7),
    "subsample": ("share", 0.6, 1.0),
    "colsample_bytree": ("share", 0.6, 1.0),
}
SEARCH_FIXED = {"subsample_freq": 1}

# --- Fixed values: decision texts ----------------------------------------------------
ALREADY_CURRENT = "this model is already the current one"
REASON_NOT_EVALUATED = "the new model was not evaluated, so it can't be compared"
REASON_NO_CURRENT = "there is no current model"
REASON_WITHIN = "WAPE %s is within the limit of %s (current model %s)"
REASON_ABOVE = "WAPE %s is above the limit of %s (current model %s)"
OBSTACLE_PREFIX = "no fair comparison: "
OBSTACLE_NO_MONTHS = "the current model doesn't record what it was trained on"
OBSTACLE_SEEN = "the current model was already trained on data up to %s"
OBSTACLE_ABSENT = "the data for %s is not on disk to train a matching copy on"
OBSTACLE_UNREADABLE = "the current model's file could not be loaded (%s)"

# --- Plan limits (ours) --------------------------------------------------------------
# Cells per day kept in one row while filling a dense grid.
GRID_MAX_CELLS_PER_DAY = 100_000
# Points held in one block of the pairwise distance sums.
PAIRWISE_BLOCK = 1024
# Rows of a partition in fits with seeded draws.
FIT_ROWS = 65_536
