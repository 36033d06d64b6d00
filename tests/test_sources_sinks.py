from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from pathlark import schemas as S
from pathlark.operators import sinks as K
from pathlark.session import shared_dir
from pathlark.sources import feeds as FD
from tests.helpers import at, behaviors, rows


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def test_csv_behaviours_are_coerced(spark, workdir):
    path = write(f"{workdir}/b.csv", "behavior_time,user_id,item_id,category_id,behavior_type,extra\n"
                 "100,1,2,3,pv,z\nx,1,2,,buy,z\n5,0,2,3,pv,z\n5,abc,2,3,pv,z\n5,7,0,3,pv,z\n9007199254740993,9007199254740993,2.9,3,pv,z\n")
    got = FD.read_csv_behavior(spark, path, now())
    assert rows(got, "user_id", "item_id", "category_id", "behavior_type", "behavior_time") == [
        (1, 2, 0, "buy", 0), (1, 2, 3, "pv", 100), (9007199254740993, 2, 3, "pv", 9007199254740993)]


def test_csv_needs_its_columns(spark, workdir):
    with pytest.raises(ValueError, match="category_id"):
        FD.read_csv_behavior(spark, write(f"{workdir}/b.csv", "user_id,item_id,behavior_type,behavior_time\n1,2,pv,3\n"), now())


def test_csv_user_features_keep_the_first(spark, workdir):
    head = "user_id,pv_count,buy_count,cart_count,fav_count,buy_rate,active_score,high_freq_category\n"
    path = write(f"{workdir}/u.csv", head + "5,9,1,1,1,0.5,0.1,7\n5,1,1,1,1,0.5,0.1,7\n0,1,1,1,1,0.5,0.1,7\n6,x,1,1,1,,0.1,7\n")
    got = FD.read_csv_user_features(spark, path, now())
    assert rows(got, "user_id", "pv_count", "buy_rate") == [(5, 9, 0.5), (6, 0, 0.0)]


def test_header_is_optional(spark, workdir):
    write(f"{workdir}/a.csv", "user_id,item_id,category_id,behavior_type,timestamp\n1,2,3, PV ,10\n")
    write(f"{workdir}/b.csv", "4,5,,buy,11\n\n6,7,8,superuser,12\n")
    got = FD.read_headered_or_not(spark, workdir)
    assert rows(got) == [(1, 2, 3, "pv", 10), (4, 5, 0, "buy", 11), (6, 7, 8, "superuser", 12)]


def test_header_gives_the_order(spark, workdir):
    write(f"{workdir}/a.csv", 'item_id,user_id,timestamp,"behavior_type",category_id\n900,1,10,"pv",12.0\n')
    write(f"{workdir}/b.csv", "user_id,item_id,behavior_type,behavior_time\n7,8,buy,11\n")
    write(f"{workdir}/c.csv", "4,5,,buy,11\n")
    assert rows(FD.read_headered_or_not(spark, workdir)) == [(1, 900, 12, "pv", 10), (4, 5, 0, "buy", 11), (7, 8, 0, "buy", 11)]


def test_header_of_too_many_columns_fails(spark, workdir):
    more = ",".join(f"x{i}" for i in range(FD.MAX_COLUMNS - 4))
    write(f"{workdir}/a.csv", f"user_id,item_id,behavior_type,behavior_time,{more}\n1,2,pv,3,{more}\n")
    assert rows(FD.read_headered_or_not(spark, f"{workdir}/a.csv")) == [(1, 2, 0, "pv", 3)]
    write(f"{workdir}/b.csv", f"user_id,item_id,behavior_type,{more},behavior_time,category_id\n1,2,pv,{more},3,4\n")
    with pytest.raises(Exception, match="more than 64 columns"):
        FD.read_headered_or_not(spark, f"{workdir}/b.csv").collect()


def test_header_without_a_required_column_fails(spark, workdir):
    write(f"{workdir}/a.csv", "user_id,category_id,behavior_type,behavior_time\n1,2,pv,3\n")
    with pytest.raises(Exception, match="missing required columns: item_id"):
        FD.read_headered_or_not(spark, workdir).collect()


def test_range_includes_both_ends_and_is_pushed_down(spark, workdir):
    behaviors(spark, [(1, 1, 1, "pv", t) for t in (0, 10, 20, 30)]).write.parquet(f"{workdir}/t")
    got = FD.read_table_range(spark, f"{workdir}/t", "2024-01-01 00:00:10", "2024-01-01 00:00:20")
    assert rows(got, "id") == [(2,), (3,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(create_time" in plan and "LessThanOrEqual(create_time" in plan


def test_only_needed_columns_are_read(spark, sf):
    from checks.queries import beh
    from pathlark.operators.features import agg_user_behavior_counts

    plan = agg_user_behavior_counts(beh(spark, sf, "orders"))._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_orderstatus" not in plan


def recs(spark, data):
    full = [(u, i, 0.5, Dec("1.0000"), Dec(f), n, "realtime", at(t)) for u, i, f, n, t in data]
    return spark.createDataFrame(full, S.RECOMMENDATIONS)


def shown(df):
    return [(u, i, str(f.normalize()), n, int(c.timestamp()) - 1704067200) for u, i, f, n, c in
            rows(df, "user_id", "item_id", "final_score", "rank_no", "create_time")]


def test_upsert_keeps_creation_time(spark, workdir):
    path = f"{workdir}/recs"
    first, second = recs(spark, [(1, 1, "2", 1, 10), (1, 2, "1", 2, 10)]), recs(spark, [(1, 3, "9", 1, 20), (1, 1, "3", 2, 20)])
    K.write_changes(first, path, 0)
    K.write_changes(second, path, 1)
    want = [(1, 1, "3", 2, 10), (1, 2, "1", 2, 10), (1, 3, "9", 1, 20)]
    assert shown(K.read_recommendations(spark, path)) == want
    K.write_changes(second, path, 1)  # the batch runs again
    assert shown(K.read_recommendations(spark, path)) == want
    assert shown(K.read_recommendations(spark, path, prune_stale=True)) == [want[0], want[2]]
    K.compact(spark, path, f"{workdir}/compacted", 1)
    assert shown(K.read_recommendations(spark, f"{workdir}/compacted")) == want
    assert shown(K.upsert_once(first, second)) == want


def test_upsert_does_not_sort(spark):
    changes = recs(spark, [(1, 1, "2", 1, 10)]).withColumn("batch_id", F.lit(1).cast("bigint"))
    assert "SortAggregate" not in K.merge_recommendations(changes)._jdf.queryExecution().executedPlan().toString()


def test_append_lands_in_day_folders(spark, workdir):
    b = behaviors(spark, [(1, 1, 1, "pv", 0), (1, 1, 1, "pv", 86400)])
    K.append_behavior(b, f"{workdir}/b")
    K.append_behavior(b, f"{workdir}/b")
    one = spark.read.parquet(f"{workdir}/b").filter("day = '2024-01-02'")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_rebuild_reports(spark, workdir):
    b = behaviors(spark, [(1, 1, 1, "pv", t) for t in range(5)])
    K.rebuild_table(b, f"{workdir}/t")
    assert rows(K.rebuild_table(b.limit(3), f"{workdir}/t")) == [(3, 3, 0)]


def test_serving_is_bucketed_and_expires(spark, workdir):
    data = spark.createDataFrame([(1, 10, 0.5, 1), (2, 11, 0.6, 1)], "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, serving_rank INT")
    K.write_serving(data, f"{workdir}/s", F.lit(at(0)), buckets=4)
    back = spark.read.parquet(f"{workdir}/s")
    assert back.filter(F.col("user_bucket") == K.user_bucket(4)).count() == 2
    hour = 3600
    aged = spark.createDataFrame([(1, at(0)), (2, at(hour)), (3, at(2 * hour)), (3, at(0))], "user_id INT, updated_at TIMESTAMP")
    # a list lives as long as its newest row
    assert rows(K.expire_serving(aged, F.lit(at(24 * hour))), "user_id") == [(3,), (3,)]


def test_serving_lists_take_updates_and_stay_cut(spark):
    kind = "user_id INT, item_id INT, predict_score DOUBLE, final_score DOUBLE"
    served = spark.createDataFrame([(1, 10, 0.5, 5.0), (1, 11, 0.4, 4.0), (2, 10, 0.1, 1.0)], kind).withColumn("updated_at", F.lit(at(0)))
    fresh = spark.createDataFrame([(1, 11, 0.9, 9.0), (1, 12, 0.2, 2.0), (1, 11, 0.3, 3.0)], kind)
    got = K.merge_serving(served, fresh, F.lit(at(5)), size=2)
    got = got.withColumn("fresh", F.col("updated_at") == F.lit(at(5)))
    assert rows(got, "user_id", "serving_rank", "item_id", "final_score", "fresh") == [
        (1, 1, 11, 9.0, True), (1, 2, 10, 5.0, False), (2, 1, 10, 1.0, False)]


def test_a_reader_survives_replacements(spark, workdir):
    for n in range(4):
        K.replace_table(spark.range(n + 1), f"{workdir}/t")
        old = K.read_table(spark, f"{workdir}/t")
        K.replace_table(old.union(old), f"{workdir}/t")  # from the table itself
        assert old.count() == n + 1 and K.read_table(spark, f"{workdir}/t").count() == 2 * n + 2
    assert len(K.versions(spark, f"{workdir}/t")) == 2
    with pytest.raises(FileNotFoundError):
        K.read_table(spark, f"{workdir}/none")


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_levelled_log_reads_few_folders_and_equals_the_whole_log(spark, workdir):
    kind = "user_id BIGINT, item_id BIGINT, predict_score DOUBLE, popularity_score DECIMAL(18,4), final_score DECIMAL(28,12), rank_no INT, recommend_type STRING, create_time TIMESTAMP"

    def batch(n):
        data = [(u, (u * 3 + n * 7 + k) % 11, 0.1 * k, Dec(n), Dec(k), k + 1, "realtime", at(100 * n + k)) for u in range(n % 5, 9, 2) for k in range(3)]
        return spark.createDataFrame(data, kind).select(*K.S.RECOMMENDATIONS.fieldNames())

    log, read = K.upsert_log(f"{workdir}/log", buckets=4, every=3), []
    for n in range(20):
        log.write(batch(n), n)
        read.append(len(log.folders(spark)))
        if n in (8, 13, 14):
            log.write(batch(n), n)  # a batch that runs again: with a snapshot, alone, with a run
    assert max(read) <= 6 and read[8] == read[17] == 1
    plain = f"{workdir}/plain"
    for n in range(20):
        K.write_changes(batch(n), plain, n)
    for prune in (False, True):
        assert rows(K.upserted(spark, log, prune)) == rows(K.read_recommendations(spark, plain, prune))
    one = K.upserted(spark, log, user=4, buckets=4)
    assert rows(one) == rows(K.read_recommendations(spark, plain).filter("user_id = 4")) and one.count()
    import glob

    assert len(glob.glob(f"{workdir}/log/level=0/*")) <= 6  # merged changes go, a turn later
