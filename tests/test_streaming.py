import time
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from pathlark.operators import cleaning as C
from pathlark.operators import ranking as R
from pathlark.operators import windows as W
from pathlark.operators.sinks import write_changes
from pathlark.session import fresh_path
from pathlark.streaming import jobs as JB
from pathlark.streaming.topk_state import fold, merged_lists, salted_topk, stateful_topk
from tests.helpers import T0, at, behaviors, rows

ONE_BY_ONE = 1


def wait(q, seconds=90):
    if not q.awaitTermination(seconds):
        q.stop()
        raise AssertionError("the stream did not finish")


def landed(spark, stream):
    path = fresh_path(spark, "out")
    wait(JB.file_sink(stream, path, fresh_path(spark, "ck"), JB.Timing()))
    return spark.read.schema(stream.schema).parquet(path)


def arrivals(spark, parts):
    """Each part becomes one file, in this order; a stream reads them one per micro-batch."""
    folder = fresh_path(spark, "arrivals")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken in order of their time
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", ONE_BY_ONE).parquet(folder)


def test_landing_equals_batch_cleaning(spark):
    lines = [f"{n % 9},{n % 5 + 1},2,{'pv' if n % 2 else 'Buy '},{T0 + n}" for n in range(50)] + ["", "junk"]
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    stream = arrivals(spark, [df.filter(F.hash("value") % 2 == 0), df.filter(F.hash("value") % 2 != 0)])
    path = fresh_path(spark, "landed")
    wait(JB.stream_land_behavior(stream, path, fresh_path(spark, "ck"), JB.Timing()))
    columns = ["user_id", "item_id", "category_id", "behavior_type", "behavior_time"]
    assert rows(spark.read.parquet(path), *columns) == rows(C.clean_valid(df), *columns)


def test_metrics_are_observed_and_logged(spark):
    df = spark.createDataFrame([("1,2,3,pv,1704067200",), ("bad",), ("",)], "value STRING")
    path = fresh_path(spark, "metrics")
    wait(JB.stream_clean_metrics(arrivals(spark, [df, df]), path, fresh_path(spark, "ck"), JB.Timing()))
    assert rows(spark.read.parquet(path), "batch_id", "total_count", "filtered_count") == [(0, 3, 2), (1, 3, 2)]
    totals = JB.CleanTotals()
    spark.streams.addListener(totals)
    try:
        landed(spark, JB.observed_lines(arrivals(spark, [df, df])))
        for _ in range(50):
            if totals.total >= 6:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(totals)
    assert (totals.total, totals.filtered) == (6, 4)


@pytest.fixture(scope="module")
def sample(spark):
    data = [(n % 4 + 1, n % 6 + 1, n % 6 % 3 + 1, ("pv", "cart", "pv", "buy")[n % 4], n * 37) for n in range(200)]
    return C.with_event_time(behaviors(spark, data)).drop("create_time")


def in_two(sample):
    middle = F.lit(at(100 * 37))
    return [sample.filter(F.col("event_time") < middle), sample.filter(F.col("event_time") >= middle)]


def closed(df, newest, delay):
    return df.filter(F.unix_timestamp("window_end") <= newest - delay)


NEWEST = T0 + 199 * 37


def test_stream_windows_equal_batch_windows(spark, sample):
    stream = W.watermarked(arrivals(spark, in_two(sample)), "60 seconds")
    got = landed(spark, JB.stream_features(stream, "5 minutes", "1 minute"))
    want = closed(W.win_sliding_features(sample, "5 minutes", "1 minute"), NEWEST, 60)
    assert rows(got) == rows(want)
    hot = landed(spark, JB.stream_hot_items(W.watermarked(arrivals(spark, in_two(sample)), "60 seconds")))
    # the second aggregate closes a window once panes up to its end are out
    assert set(rows(hot)) <= set(rows(W.hot_items_unsalted(sample)))
    assert rows(hot) == rows(closed(W.hot_items_unsalted(sample), NEWEST, 60))


def test_late_rows_are_dropped(spark, sample):
    old, new = in_two(sample)
    newest = new.filter(F.col("behavior_time") == NEWEST)
    # rows are late by the watermark the batch before ran with, hence a batch in between
    parts = [new.filter(F.col("behavior_time") < NEWEST).unionAll(newest), newest.limit(0), old]
    got = landed(spark, JB.stream_features(W.watermarked(arrivals(spark, parts), "60 seconds"), "5 minutes", "1 minute"))
    late_free = closed(W.win_sliding_features(new, "5 minutes", "1 minute"), NEWEST, 60)
    assert rows(got) == rows(late_free)


def test_replays_within_the_watermark_are_dropped(spark, sample):
    stream = W.watermarked(arrivals(spark, [sample, sample]), "3 hours")
    got = landed(spark, JB.dedupe_stream(stream))
    assert rows(got, "user_id", "item_id", "behavior_time") == rows(sample, "user_id", "item_id", "behavior_time")


def scores(spark, n, start):
    data = [((k * 7) % 3 + 1, (k * 5) % 23, 0.5, Dec("1.0000"), Dec((k * 7919) % 101), at(k)) for k in range(start, start + n)]
    return spark.createDataFrame(
        data, "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), final_score DECIMAL(28,12), window_end TIMESTAMP")


def test_merged_lists_equal_batch_ranking(spark):
    """Keeping only k rows per user between batches loses nothing; users miss some batches."""
    parts = [scores(spark, 40, 40 * n).filter(F.col("user_id") != n % 4) for n in range(6)]
    path = fresh_path(spark, "lists")
    everything = parts[0]
    for n, part in enumerate(parts):
        JB.merge_topk(part, path, n, k=4, every=2)
        if n:
            everything = everything.unionByName(part)
        if n == 3:
            JB.merge_topk(part, path, n, k=4, every=2)  # the batch runs again
        want = R.topk_per_user(everything, 4, "window_end")
        assert rows(JB.read_lists(spark, path), "user_id", "rank_no", "item_id", "final_score", "create_time") == rows(
            want, "user_id", "rank_no", "item_id", "final_score", "create_time")


@pytest.mark.parametrize("every", [1, 2, 50])
def test_an_item_that_returns_keeps_its_first_stamp(spark, every):
    kind = "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), final_score DECIMAL(28,12), window_end TIMESTAMP"
    path = fresh_path(spark, "lists")
    for n, (item, score) in enumerate([(7, 1), (8, 2), (9, 3), (7, 4)]):
        JB.merge_topk(spark.createDataFrame([(1, item, 0.5, Dec("1"), Dec(score), at(600 * n))], kind), path, n, k=1, every=every)
    first = JB.read_lists(spark, path).select("item_id", (F.col("create_time") == F.lit(at(0))).alias("first"))
    assert rows(first) == [(7, True)]


def test_topk_job(spark, sample):
    from pathlark.operators.features import item_features, user_features
    from pathlark.plans.recommend import score_features

    users, items = user_features(sample), item_features(sample)
    stream = JB.stream_features(W.watermarked(arrivals(spark, in_two(sample)), "60 seconds"), "5 minutes", "1 minute")
    path = fresh_path(spark, "lists")
    wait(JB.stream_topk(stream, lambda s: (users, items), path, fresh_path(spark, "ck"), JB.Timing(), k=3))
    batch = closed(W.win_sliding_features(sample, "5 minutes", "1 minute"), NEWEST, 60)
    want = R.topk_per_user(score_features(batch, users, items), 3)
    assert rows(JB.read_lists(spark, path), "user_id", "rank_no", "item_id", "final_score") == rows(
        want, "user_id", "rank_no", "item_id", "final_score")


def test_fold():
    best = fold({1: (0, 0, 5), 2: (0, 0, 4)}, [(3, 0, 0, 4), (1, 9, 9, 3), (2, 0, 0, 6)], 2)
    assert best == {2: (0, 0, 6), 1: (0, 0, 5)}
    assert fold({1: (1, 0, 5)}, [(1, 2, 0, 5)], 2) == {1: (2, 0, 5)}  # as the batch ranking does
    assert list(fold({}, [(9, 0, 0, 1), (4, 0, 0, 1), (7, 0, 0, 1)], 2)) == [4, 7]


def test_keyed_state_equals_batch_ranking(spark):
    parts = [scores(spark, 60, 60 * n) for n in range(3)]
    path = fresh_path(spark, "lists")

    def step(batch, batch_id):
        from pathlark.operators.sinks import write_changes

        write_changes(batch, path, batch_id)

    lists = stateful_topk(arrivals(spark, parts), k=4, flush_ms=0)
    wait(JB.batch_sink(lists, step, fresh_path(spark, "ck"), JB.Timing(), mode="update"))
    want = R.topk_per_user(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)
    got = JB.current_lists(spark.read.parquet(path))
    assert rows(got, "user_id", "rank_no", "item_id", "final_score") == rows(want, "user_id", "rank_no", "item_id", "final_score")


def test_partial_lists_of_a_heavy_user_spread_and_merge(spark):
    parts = [scores(spark, 60, 60 * n).unionByName(scores(spark, 200, 500 * n).withColumn("user_id", F.lit(1).cast("bigint"))) for n in range(3)]
    path = fresh_path(spark, "lists")

    def step(batch, batch_id):
        from pathlark.operators.sinks import write_changes

        write_changes(batch, path, batch_id)

    lists = salted_topk(arrivals(spark, parts), k=4, salts=6, flush_ms=0)
    wait(JB.batch_sink(lists, step, fresh_path(spark, "ck"), JB.Timing(), mode="update"))
    log = spark.read.parquet(path)
    assert log.filter("user_id = 1").select("salt").distinct().count() > 2  # several keys, so several tasks
    want = R.topk_per_user(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)
    assert rows(merged_lists(log, 4), "user_id", "rank_no", "item_id", "final_score") == rows(want, "user_id", "rank_no", "item_id", "final_score")


@pytest.mark.parametrize("ttl_ms", [None, 3_600_000])
def test_a_list_is_one_value_of_the_state(spark, ttl_ms):
    """One row of state for each user, however long the list; with a time to live one for each entry. A missing
    predict score stays missing."""
    parts = [scores(spark, 60, 60 * n).withColumn("predict_score", F.expr("if(item_id % 2 = 0, null, predict_score)")) for n in range(2)]
    path = fresh_path(spark, "lists")
    lists = stateful_topk(arrivals(spark, parts), k=4, flush_ms=0, ttl_ms=ttl_ms)
    timing = JB.Timing(every="1 second" if ttl_ms else None)  # with a time to live the stream never ends by itself
    q = JB.batch_sink(lists, lambda batch, n: write_changes(batch, path, n), fresh_path(spark, "ck"), timing, mode="update")
    try:
        for _ in range(90):
            if q.awaitTermination(1) or (ttl_ms and q.lastProgress and q.lastProgress.batchId >= 2):
                break
        held = q.lastProgress.stateOperators[0].numRowsTotal
    finally:
        q.stop()
    got = JB.current_lists(spark.read.parquet(path))
    columns = ["user_id", "rank_no", "item_id", "predict_score", "final_score"]
    assert rows(got, *columns) == rows(R.topk_per_user(parts[0].unionByName(parts[1]), 4), *columns)
    if not ttl_ms:
        assert held == got.select("user_id").distinct().count() < got.count()


def test_keyed_state_emits_on_its_timer(spark):
    lists = stateful_topk(arrivals(spark, [scores(spark, 60, 0)]), k=2, flush_ms=500)
    q = JB.memory_sink(lists, "timed", JB.Timing(every="1 second"), mode="update")
    try:
        for _ in range(60):
            time.sleep(0.5)
            if spark.table("timed").count() >= 12:  # two flushes of two rows for three users
                break
    finally:
        q.stop()
    want = R.topk_per_user(scores(spark, 60, 0), 2)
    columns = ["user_id", "rank_no", "item_id", "final_score"]
    assert rows(spark.table("timed").distinct(), *columns) == rows(want, *columns)
    assert spark.table("timed").count() >= 12


def test_refreshed_features_equal_batch_features(spark, sample):
    from pathlark.operators.features import item_features, user_features

    users, items = fresh_path(spark, "users"), fresh_path(spark, "items")
    stream = arrivals(spark, in_two(sample))
    for q in JB.stream_refresh(stream, users, items, fresh_path(spark, "ck"), JB.Timing()):
        wait(q)
    got_users, got_items = JB.read_refreshed(spark, users, items)
    assert rows(got_users) == rows(user_features(sample))
    assert rows(got_items) == rows(item_features(sample))
    assert spark.read.parquet(users).select("batch_id").distinct().count() == 2
