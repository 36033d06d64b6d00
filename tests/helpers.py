from datetime import datetime, timezone

BEHAVIOR = "id BIGINT, user_id BIGINT, item_id BIGINT, category_id BIGINT, behavior_type STRING, behavior_time BIGINT, create_time TIMESTAMP"
T0 = 1704067200  # 2024-01-01 00:00:00 UTC


def at(seconds: int) -> datetime:
    return datetime.fromtimestamp(T0 + seconds, tz=timezone.utc)


def behaviors(spark, rows):
    """rows of (user, item, category, type, seconds after the origin)"""
    full = [(n, u, i, c, k, T0 + t, at(t)) for n, (u, i, c, k, t) in enumerate(rows, 1)]
    return spark.createDataFrame(full, BEHAVIOR)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
