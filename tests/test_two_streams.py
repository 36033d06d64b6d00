"""Interval joins, lateness reports and landing without repeats."""

import pytest
from pyspark.sql import functions as F

from pathlark.operators import sinks as K
from pathlark.operators import windows as W
from pathlark.operators.evaluation import ctr_cvr_after_rec
from pathlark.session import fresh_path
from pathlark.streaming import intervals as IV
from pathlark.streaming import jobs as JB
from pathlark.streaming import lateness as LT
from pathlark.streaming import replays as RP
from pathlark.streaming import serving as SV
from tests.helpers import at, behaviors, rows
from tests.test_streaming import arrivals, wait

HOUR = 3600


def shown(spark, some):
    return spark.createDataFrame([(u, i, at(t)) for u, i, t in some], "user_id BIGINT, item_id BIGINT, create_time TIMESTAMP")


def test_interval_join_equals_batch_inside_the_bound_and_gives_up_state(spark):
    recs = [[(u, u % 3, 10 * HOUR * n + u) for u in range(20)] for n in range(6)]
    done = [[(u, u % 3, 1, "pv" if u % 2 else "buy", 10 * HOUR * n + 1800 + u * 60) for u in range(0, 20, 3)] + [(u, u % 3, 1, "cart", 10 * HOUR * n + 60) for u in range(20)]
            + [(5, 2, 1, "pv", 10 * HOUR * n + 4 * HOUR)] * 30 for n in range(6)]
    path, ck = fresh_path(spark, "rates"), fresh_path(spark, "ck")
    left = arrivals(spark, [shown(spark, r) for r in recs])
    right = arrivals(spark, [behaviors(spark, b) for b in done])
    queries = IV.stream_ctr_cvr(left, right, path, ck, JB.Timing(), "2 hours", "10 minutes")
    for q in queries:
        wait(q)
    r = shown(spark, sum(recs, []))
    b = behaviors(spark, sum(done, []))
    inside = b.alias("b").join(r.alias("r"), F.expr("b.user_id = r.user_id AND b.item_id = r.item_id AND b.create_time > r.create_time "
                                                    "AND b.create_time <= r.create_time + INTERVAL 2 HOURS"))
    viewed, bought = (inside.filter(f"b.behavior_type = '{k}'").select("r.user_id", "r.item_id", "r.create_time").distinct().count() for k in ("pv", "buy"))
    assert rows(IV.read_ctr_cvr(spark, path)) == [(120, viewed, bought, viewed / 120, bought / viewed)]
    assert 0 < viewed < ctr_cvr_after_rec(r, b).first()["viewed_count"]  # without the bound there are more
    report = fresh_path(spark, "report")
    LT.OperatorReport().take(queries[1]).flush(spark, report)
    held = [x[0] for x in LT.read_report(spark, report).orderBy("batch_id", "place").select("state_rows").collect()]
    assert max(held) <= 2 * (20 + 37) and held[-1] < max(held)  # of 120 and 222 rows that came


def test_late_rows_are_reported_by_batch_and_operator(spark):
    early = behaviors(spark, [(u, 1, 1, "pv", 100 * HOUR + u) for u in range(10)]).drop("create_time")
    late = behaviors(spark, [(u, 1, 1, "pv", u) for u in range(7)] * 2 + [(1, 1, 1, "pv", 100 * HOUR + 50)]).drop("create_time")
    ck, path, report = fresh_path(spark, "ck"), fresh_path(spark, "out"), fresh_path(spark, "report")
    folder = fresh_path(spark, "arrivals")
    listener = LT.OperatorReport()
    spark.streams.addListener(listener)
    try:
        for part in (early, late):
            part.withColumn("event_time", F.timestamp_seconds("behavior_time")).write.mode("append").parquet(folder)
            stream = W.watermarked(spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder), "10 minutes")
            q = JB.file_sink(JB.stream_features(JB.dedupe_stream(stream), "1 hour", "1 hour"), path, ck, JB.Timing())
            wait(q)
            LT.OperatorReport().take(q).flush(spark, report)
            LT.OperatorReport().take(q).flush(spark, report)  # told twice, counted once
    finally:
        spark.streams.removeListener(listener)
    found = LT.late_rows(LT.read_report(spark, report))
    assert rows(found.filter("late_rows > 0"), "operator", "late_rows") == [("dedupeWithinWatermark", 14)]
    batches = LT.read_report(spark, report).filter("late_rows > 0")
    assert batches.count() == 1 and batches.first()["watermark"] is not None
    assert LT.OperatorReport().flush(spark, report) == 0


@pytest.fixture
def days(spark):
    return behaviors(spark, [(u, u % 5, 1, "pv", day * 24 * HOUR + u) for day in range(6) for u in range(400)])


def test_replays_of_any_age_leave_no_second_row(spark, days):
    path, ck = fresh_path(spark, "once"), fresh_path(spark, "ck")
    older = days.filter("id <= 700")
    stream = arrivals(spark, [days, older.unionByName(older), days.filter("id > 2000").withColumn("user_id", F.col("user_id") + 1000), older])
    wait(RP.stream_land_once(stream, path, ck, JB.Timing(), per_day=400))
    want = days.unionByName(days.filter("id > 2000").withColumn("user_id", F.col("user_id") + 1000))
    assert rows(RP.read_landed(spark, path)) == rows(want, "user_id", "item_id", "category_id", "behavior_type", "behavior_time")
    RP.land_once(days.select(*RP.S.LINE_FIELDS), path, 0, 400)  # the first batch runs again
    assert RP.read_landed(spark, path).count() == want.count()


@pytest.mark.parametrize("per_day", [400, 16])
def test_filters_answer_for_new_keys_and_false_positives_are_verified(spark, days, per_day):
    path = fresh_path(spark, "once")
    first = days.select(*RP.S.LINE_FIELDS)
    RP.land_once(first, path, 0, per_day)
    new = first.withColumn("user_id", F.col("user_id") + 5000)
    fresh, doubtful = RP.unseen(new.unionByName(first.limit(50)), path, 1, per_day)
    assert fresh.count() == new.count()  # exact, whatever the filters say
    if per_day == 16:  # far too small: everything is doubtful, and still right
        assert doubtful.count() > 2000
    else:
        assert 50 <= doubtful.count() < 50 + 0.05 * new.count()


def test_served_lists_equal_one_merge_and_touch_only_their_buckets(spark):
    path = fresh_path(spark, "serving")
    kind = "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, final_score DECIMAL(20,12)"
    batches = [spark.createDataFrame([(u, i, 0.5, (u * 7 + i * 13 + n * 5) % 17) for u in users for i in range(n, n + 4)], "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, final_score INT")
               .withColumn("final_score", F.col("final_score").cast("decimal(20,12)")) for n, users in enumerate([range(12), range(3), range(5, 9), [1], range(12)])]
    served = spark.createDataFrame([], kind + ", updated_at TIMESTAMP")
    written, readers = [], []
    for n, batch in enumerate(batches):
        served = K.merge_serving(served, batch, F.lit(at(n)), size=5)
        if n:
            readers.append((SV.read_serving(spark, path, "decimal(20,12)"), rows(SV.read_serving(spark, path, "decimal(20,12)"))))
        written.append(SV.update_serving(batch, path, n, F.lit(at(n)), buckets=8, size=5))
        if n == 2:
            assert SV.update_serving(batch, path, n, F.lit(at(n)), buckets=8, size=5) == written[-1]  # runs again
        if readers:  # a reader that began before the write still sees its own state
            assert rows(readers[-1][0]) == readers[-1][1]
    columns = ("user_id", "serving_rank", "item_id", "final_score", "updated_at")
    assert rows(SV.read_serving(spark, path, "decimal(20,12)"), *columns) == rows(served, *columns)
    assert written[3] == 1 and max(written[1:4]) <= 4 < written[0]
    assert rows(SV.read_user(spark, path, 7, 8, "decimal(20,12)"), *columns) == rows(served.filter("user_id = 7"), *columns)
    assert len(K.versions(spark, f"{path}/versions")) == SV.KEPT
    assert SV.update_serving(batches[0].limit(0), path, 9, F.lit(at(9)), buckets=8) == 0


def test_levelled_counts_equal_batch_features_and_read_little(spark):
    from pathlark.operators import cleaning as C
    from pathlark.operators.features import item_features, user_features
    from pathlark.streaming import refresh as RS

    data = [(n % 4 + 1 if n % 3 else 1, n % 6 + 1, n % 6 % 3 + 1, ("pv", "cart", "pv", "buy")[n % 4], n * 37) for n in range(240)]
    sample = C.with_event_time(behaviors(spark, data))
    users, items = RS.user_counts(fresh_path(spark, "users"), 4, 2), RS.item_counts(fresh_path(spark, "items"), 4, 2)
    for n in range(7):
        part = sample.filter(F.col("id") % 7 == n)
        for log, counts in ((users, RS.user_category_counts(part)), (items, RS.agg_item_behavior_counts(part))):
            log.write(counts, n)
            if n == 3:
                log.write(counts, n)  # runs again
    got_users, got_items = RS.read_features(spark, users, items)
    assert rows(got_users) == rows(user_features(sample)) and rows(got_items) == rows(item_features(sample))
    assert len(users.folders(spark)) <= 4
