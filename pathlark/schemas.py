"""Table schemas and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (given by the data contract; do not tune) -----------------------------
BEHAVIOR_TYPES = ("pv", "cart", "fav", "buy")
TS_LOWER = 1451606400  # 2016-01-01 00:00:00 UTC, inclusive
TS_UPPER = 1893456000  # 2030-01-01 00:00:00 UTC, inclusive
MILLIS_ABOVE = 2000000000  # a stamp above this may be in milliseconds ...
MILLIS_LOWER = 1451606400000  # ... and is, from here on
LINE_FIELDS = ("user_id", "item_id", "category_id", "behavior_type", "behavior_time")
BEHAVIOR_DISPLAY = {"pv": "浏览", "cart": "加购", "fav": "收藏", "buy": "购买"}
POPULARITY_DISPLAY = {"high": "高", "medium": "中", "low": "低"}
HIGH_FROM, MEDIUM_FROM = 0.7, 0.4
DEFAULT_BUY_RATE = "0.05"
DEFAULT_ACTIVE_SCORE = "1.0"
DEFAULT_POPULARITY = "0.5"
PREDICT_WEIGHT, POPULARITY_WEIGHT = "0.7", "0.3"
PV_CAP = 20
TOP_K = 10
SERVING_SIZE = 50
SERVING_LIFE_HOURS = 24
WINDOW_SIZE, WINDOW_SLIDE = "30 seconds", "10 seconds"
HOT_SIZE_SECONDS, HOT_SLIDE_SECONDS = 300, 60
SALT_SLOTS = 10
NOT_MEASURED = -1
MODEL_FEATURES = (
    "buy_rate",
    "active_score",
    "pv_count_5min",
    "is_cart_or_fav",
    "category_match",
)
# ----------------------------------------------------------------------------------------

SCORE4 = T.DecimalType(18, 4)  # four decimals, wide enough for an unbounded popularity
SCORE12 = T.DecimalType(28, 12)
RATIO = T.DecimalType(18, 4)


def _table(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in cols])


_L, _I, _S, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()

USER_BEHAVIOR = _table(
    ("id", _L), ("user_id", _L), ("item_id", _L), ("category_id", _L),
    ("behavior_type", _S), ("behavior_time", _L), ("create_time", _TS),
)
USER_FEATURES = _table(
    ("user_id", _L), ("pv_count", _L), ("buy_count", _L), ("cart_count", _L),
    ("fav_count", _L), ("buy_rate", SCORE4), ("active_score", SCORE4),
    ("high_freq_category", _L), ("update_time", _TS),
)
ITEM_FEATURES = _table(
    ("item_id", _L), ("category_id", _L), ("pv_count", _L), ("buy_count", _L),
    ("popularity_score", SCORE4), ("update_time", _TS),
)
RECOMMENDATIONS = _table(
    ("user_id", _L), ("item_id", _L), ("predict_score", T.DoubleType()),
    ("popularity_score", SCORE4), ("final_score", SCORE12), ("rank_no", _I),
    ("recommend_type", _S), ("create_time", _TS),
)
EVAL_METRICS = _table(
    ("id", _L), ("metric_start_time", _TS), ("metric_end_time", _TS),
    ("pr_auc", T.DoubleType()), ("ctr", T.DoubleType()), ("cvr", T.DoubleType()),
    ("recommend_count", _L), ("create_time", _TS),
)

# Raw CSV columns arrive as text and are coerced one by one, so a bad cell never fails a job.
CSV_BEHAVIOR_COLUMNS = ("user_id", "item_id", "category_id", "behavior_type", "behavior_time")
CSV_USER_FEATURE_COLUMNS = (
    "user_id", "pv_count", "buy_count", "cart_count", "fav_count",
    "buy_rate", "active_score", "high_freq_category",
)
