import random

import pytest
from pyspark.sql import functions as F

from pathlark.operators import cleaning as C
from tests.helpers import behaviors, rows

GOOD = [
    ("1,2,3,pv,1704067200", ("pv", 1704067200)),
    (" 1 , 2 ,3, PV ,1704067200", ("pv", 1704067200)),
    ("1,2,3,pv,1704067200,,", ("pv", 1704067200)),
    ("\t+1,2,3,\x01fav\x02,1704067200\r", ("fav", 1704067200)),
    ("1,2,3,buy,1451606400", ("buy", 1451606400)),
    ("1,2,3,buy,1893456000", ("buy", 1893456000)),
]
BAD = [
    ("", "blank"), (" \t ", "blank"), (None, "blank"),
    ("1,2,3,pv", "field_count"), ("1,2,3,pv,1704067200,x", "field_count"), (",,,,", "field_count"),
    ("0,2,3,pv,1704067200", "user_id"), ("-1,2,3,pv,1704067200", "user_id"),
    ("1,0,3,pv,1704067200", "item_id"), ("1,2,0,pv,1704067200", "category_id"),
    ("1.5,2,3,pv,1704067200", "non_numeric"), ("x,0,3,pv,1704067200", "non_numeric"),
    ("0,x,3,pv,1704067200", "user_id"), ("1,2,3,click,x", "behavior_type"),
    ("1,2,3,click,1704067200", "behavior_type"), ("1,2,3,pv,1e9", "non_numeric"), ("1,2,3,pv, ,", "non_numeric"),
    ("1,2,3,buy,1893456001", "timestamp"), ("1,2,3,buy,1451606399", "timestamp"),
    ("99999999999999999999,2,3,pv,1704067200", "non_numeric"),
]
MILLIS = "1,2,3,pv,1704067200000"


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def test_good_lines(spark):
    got = C.clean_valid(lines(spark, [v for v, _ in GOOD]))
    assert rows(got, "behavior_type", "behavior_time") == sorted(w for _, w in GOOD)
    assert set(rows(got, "user_id", "item_id", "category_id")) == {(1, 2, 3)}


@pytest.mark.parametrize("normalize_first", [True, False])
def test_reasons(spark, normalize_first):
    got = C.clean_reject_reasons(lines(spark, [v for v, _ in BAD + GOOD]), normalize_first)
    assert sorted(map(str, rows_any(got))) == sorted(map(str, BAD))


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_milliseconds_first_or_last(spark):
    raw = lines(spark, [MILLIS])
    assert rows(C.clean_valid(raw), "behavior_time") == [(1704067200,)]
    assert rows(C.clean_reject_reasons(raw, normalize_first=False), "reject_reason") == [("timestamp",)]


def test_normalize_lines(spark):
    raw = lines(spark, [MILLIS, "1,2,3,pv,1704067200", "a,b", "1,2,3,pv,2000000001", "1,2,3,pv,x"])
    assert rows(C.normalize_lines(raw)) == sorted(
        [("1,2,3,pv,1704067200",), ("1,2,3,pv,1704067200",), ("a,b",), ("1,2,3,pv,2000000001",), ("1,2,3,pv,x",)])


def test_time_normalize(spark):
    df = spark.createDataFrame([(1451606400000,), (1451606399999,), (5,), (None,)], "behavior_time BIGINT")
    assert {r[0] for r in C.time_normalize(df).collect()} == {1451606400, 1451606399999, 5, None}


def test_stats(spark):
    parsed = C.parse_lines(lines(spark, [v for v, _ in BAD[:1] + GOOD[:2]]))
    assert rows(C.clean_stats(parsed)) == [(3, 1, 33.3)]
    assert rows(C.clean_stats(parsed.limit(0))) == [(0, 0, 0.0)]


def test_filters_do_not_parse_twice(spark):
    """A filter on parsed fields stays above the parsing step."""
    plan = C.clean_valid(lines(spark, [MILLIS]).repartition(2)).filter("user_id > 3")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1


def test_dedupe_keeps_first_and_ignores_order(spark):
    data = [(1, 2, 3, "pv", 5), (1, 2, 4, "pv", 5), (1, 2, 3, "buy", 5), (1, 2, 3, "pv", 6)] * 2
    df = behaviors(spark, data)
    want = [(1, 3, "pv"), (3, 3, "buy"), (4, 3, "pv")]
    assert rows(C.dedupe_behavior(df), "id", "category_id", "behavior_type") == want
    mixed = df.orderBy(F.rand(random.randint(0, 99))).repartition(3)
    assert rows(C.dedupe_behavior(mixed), "id", "category_id", "behavior_type") == want


def test_lines_survive_a_round_trip(spark):
    df = behaviors(spark, [(1, 2, 3, "pv", 5), (4, 5, 6, "buy", 7)])
    columns = ("user_id", "item_id", "category_id", "behavior_type", "behavior_time")
    assert rows(C.clean_valid(C.format_lines(df)), *columns) == rows(df, *columns)
