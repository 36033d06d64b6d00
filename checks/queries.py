"""Every operator as a query over the given tables.

Results are made comparable with plain SQL: decimals as doubles, stamps as epoch microseconds,
computed doubles rounded to 9 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathlark import schemas as S
from pathlark.functions import labels, lines, numeric
from pathlark.functions.trees import Ensemble, Split, score_tree_ensemble
from pathlark.operators import (
    cleaning as C, dashboard as D, evaluation as E, features as X, joins as J, ranking as R, sampling as P,
    sinks as K, windows as W,
)
from pathlark.plans import evaluate as EV
from pathlark.plans import recommend as RC
from pathlark.plans import refresh as RF
from pathlark.plans import search as SE
from pathlark.plans import training as TR
from pathlark.session import ROCKSDB, fresh_path, stored, use_utc
from pathlark.sources import adapters as A
from pathlark.sources import feeds as FD
from pathlark.streaming import intervals as IV
from pathlark.streaming import jobs as JB
from pathlark.streaming import lateness as LT
from pathlark.streaming import refresh as RS
from pathlark.streaming import replays as RP
from pathlark.streaming import serving as SV
from pathlark.streaming.topk_state import merged_lists, salted_topk, stateful_topk

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL twins.
REC_SIZE, REC_SLIDE = 86400, 28800
ORDER_SIZE, ORDER_SLIDE = 30 * 86400, 10 * 86400
RANGE_START, RANGE_END = "2024-01-08 00:00:00", "2024-01-21 23:59:59"
SPLIT_AT = "2024-01-22 00:00:00"
AS_OF = "2024-02-01 00:00:00"
ONE_USER = 7
DELAY_SECONDS = 600

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 9)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return plain(fn(spark, sf_dir))

        QUERIES[name] = run
        return fn

    return add


# --- shared inputs ----------------------------------------------------------------------------
def beh(s, d, source="events"):
    return A.behaviors(s, d, source)


def feed(s, d):
    """Careless event lines and every line of every document."""
    return A.lines_from_events(A.table(s, d, "events")).select("value").unionAll(
        A.lines_from_documents(A.table(s, d, "documents")).select("value")
    )


def tables(s, d, source="events"):
    b = beh(s, d, source)
    if source == "orders":  # a join, which windows and both kinds of features would do again
        b = stored(b, "behaviors")
    return b, X.user_features(b), X.item_features(b)


def recs(s, d, source="events"):
    b, u, i = tables(s, d, source)
    size, slide = (REC_SIZE, REC_SLIDE) if source == "events" else (ORDER_SIZE, ORDER_SLIDE)
    return RC.recommend(b, u, i, size=f"{size} seconds", slide=f"{slide} seconds")


def windows(s, d, size=REC_SIZE, slide=REC_SLIDE):
    return W.win_sliding_features(C.with_event_time(beh(s, d)), f"{size} seconds", f"{slide} seconds")


def halves(s, d):
    b = beh(s, d)
    cut = F.lit(SPLIT_AT).cast("timestamp")
    return b.filter(F.col("create_time") < cut), b.filter(F.col("create_time") >= cut)


def offline(s, d):
    history, test = halves(s, d)
    return test, X.user_features(history), history


def offline_scored(s, d):
    test, users, history = offline(s, d)
    rows = EV.offline_features(C.with_labels(test).drop("is_cart_or_fav"), users, history, keep=("id", "label"))
    return score_tree_ensemble(rows)


def metrics(s, d):
    """An evaluation per day: an online row, and an offline row of a model that gives every row the
    same score (its average precision is the share of purchases)."""
    day = F.to_date("create_time")
    b = beh(s, d)
    first, last = F.col("day").cast("timestamp"), (F.date_add("day", 1).cast("timestamp") - F.expr("INTERVAL 1 SECOND"))
    number = F.date_diff("day", F.lit("2024-01-01").cast("date")).cast("bigint") * 2
    same_day = E.rec_outcomes(recs(s, d), b).select(F.to_date("create_time").alias("day"), "viewed", "bought")
    online = same_day.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("viewed").alias("v"), F.count_if("bought").alias("w")
    ).select(
        number.alias("id"), first.alias("metric_start_time"), last.alias("metric_end_time"),
        F.lit(-1.0).alias("pr_auc"),
        numeric.half_up_ratio(F.col("v"), F.col("n")).cast("double").alias("ctr"),
        numeric.half_up_ratio(F.col("w"), F.col("v")).cast("double").alias("cvr"),
        F.col("n").alias("recommend_count"), last.alias("create_time"),
    )
    constant = b.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"), X.count_kind("buy").alias("w")).select(
        (number + 1).alias("id"), first.alias("metric_start_time"), last.alias("metric_end_time"),
        numeric.half_up_ratio(F.col("w"), F.col("n")).cast("double").alias("pr_auc"),
        F.lit(-1.0).alias("ctr"), F.lit(-1.0).alias("cvr"), F.lit(-1).cast("bigint").alias("recommend_count"),
        last.alias("create_time"),
    )
    return online.unionByName(constant)


def store(rows: DataFrame, name: str) -> str:
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return path


# --- sources -----------------------------------------------------------------------------------
@query("src_stream_behavior")
def _(s, d):
    """A stream of lines from text files: the topic's plan with another source."""
    folder = store_text(A.lines_from_events(A.table(s, d, "events")).select("value"), "topic")
    out = fresh_path(s, "lines")
    wait(JB.file_sink(FD.stream_folder(s, folder), out, fresh_path(s, "ck"), JB.Timing()))
    return s.read.schema("value STRING").parquet(out)


def store_text(rows: DataFrame, name: str) -> str:
    path = fresh_path(rows.sparkSession, name)
    rows.write.text(path)
    return path


def wait(q) -> None:
    q.awaitTermination()


@query("src_csv_behavior")
def _(s, d):
    """Behaviour CSV with bad cells: an ``error`` row loses its item, a sign-up its stamp."""
    raw = A.behaviors_from_events(A.table(s, d, "events"))
    kind = F.col("behavior_type")
    path = fresh_path(s, "csv")
    raw.select(
        "user_id", F.when(kind == "error", F.lit("n/a")).otherwise(F.col("item_id").cast("string")).alias("item_id"),
        "category_id", "behavior_type",
        F.when(kind == "fav", F.lit("")).otherwise(F.col("behavior_time").cast("string")).alias("behavior_time"),
    ).write.option("header", True).csv(path)
    return FD.read_csv_behavior(s, path, F.lit(AS_OF).cast("timestamp"))


@query("src_csv_user_features")
def _(s, d):
    users = X.user_features(beh(s, d))
    path = fresh_path(s, "csv")
    # every user twice in a row: the first must win
    doubled = users.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("again"))
    shown = doubled.withColumn("pv_count", F.col("pv_count") + F.col("again") * 1000)
    K.export_csv(shown.sortWithinPartitions("user_id", "again").select(*S.CSV_USER_FEATURE_COLUMNS), path)
    return FD.read_csv_user_features(s, path, F.lit(AS_OF).cast("timestamp"))


@query("src_headered_or_not_csv")
def _(s, d):
    rows = beh(s, d).select(*S.LINE_FIELDS)
    with_header, without = fresh_path(s, "csv"), fresh_path(s, "csv")
    views = F.col("behavior_type") == "pv"
    shuffled = rows.select("item_id", "behavior_time", "user_id", "behavior_type", "category_id")
    shuffled.filter(views).write.option("header", True).csv(with_header)  # the header gives the order
    rows.filter(~views).write.option("header", False).csv(without)
    return FD.read_headered_or_not(s, with_header).unionByName(FD.read_headered_or_not(s, without))


@query("src_table_range")
def _(s, d):
    path = store(beh(s, d), "user_behavior")
    return FD.read_table_range(s, path, RANGE_START, RANGE_END)


@query("src_history_behavior")
def _(s, d):
    return C.history_behavior(beh(s, d)).select("user_id", "item_id", "behavior_type")


# --- cleaning and projections ------------------------------------------------------------------
@query("clean_valid")
def _(s, d):
    return C.clean_valid(feed(s, d))


@query("clean_valid_filter_first")
def _(s, d):
    return C.clean_valid(feed(s, d), normalize_first=False)


@query("clean_reject_reasons")
def _(s, d):
    return C.clean_reject_reasons(feed(s, d))


@query("clean_stats")
def _(s, d):
    return C.clean_stats(C.parse_lines(feed(s, d)))


@query("time_normalize")
def _(s, d):
    return C.normalize_lines(feed(s, d))


@query("parse_behavior")
def _(s, d):
    return C.parse_lines(A.lines_from_events(A.table(s, d, "events"))).drop("line_no", "value", "reject_reason")


@query("format_lines")
def _(s, d):
    return C.format_lines(beh(s, d))


@query("filter_pv")
def _(s, d):
    return C.filter_pv(beh(s, d))


@query("project_features")
def _(s, d):
    return X.project_features(offline_scored(s, d), keep=("id",))


@query("label_buy")
def _(s, d):
    return C.with_labels(beh(s, d)).select("id", "label", "is_cart_or_fav")


@query("behavior_type_desc")
def _(s, d):
    rows = A.behaviors_from_events(A.table(s, d, "events"))
    return rows.select("id", labels.behavior_type_desc(F.col("behavior_type")).alias("description"))


@query("popularity_level")
def _(s, d):
    level = labels.popularity_level(F.col("score"))
    _, u, _ = tables(s, d)
    scored = score_tree_ensemble(J.join_user_features(windows(s, d), u)).select(
        "window_start", "user_id", "item_id", F.col("predict_score").alias("score")
    )
    return scored.withColumn("level", level)


@query("category_match")
def _(s, d):
    b, u, _ = tables(s, d)
    joined = b.join(u.select("user_id", "high_freq_category"), "user_id")
    match = labels.category_match(F.col("category_id"), F.col("high_freq_category"))
    return joined.select("id", match.alias("category_match"))


@query("clip_pv")
def _(s, d):
    counted = beh(s, d).groupBy("user_id", "category_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", "category_id", numeric.clip_pv(F.col("n")).alias("clipped"))


@query("clamp_probability")
def _(s, d):
    u = X.user_features(beh(s, d))
    return u.select("user_id", numeric.clamp_probability(F.col("buy_rate").cast("double")).alias("p"))


# --- joins ------------------------------------------------------------------------------------
@query("join_user_features")
def _(s, d):
    history, _ = halves(s, d)
    # features of users with a purchase in the history only: the others are cold
    users = X.user_features(history).filter("buy_count > 2")
    return J.join_user_features(windows(s, d), users)


@query("join_user_features_salted")
def _(s, d):
    history, _ = halves(s, d)
    users = X.user_features(history).filter("buy_count > 2")
    return J.join_user_features(windows(s, d), users, hot_rows=50)


@query("join_item_popularity")
def _(s, d):
    items = X.item_features(beh(s, d)).filter("buy_count > 12")
    return J.join_item_popularity(windows(s, d), items)


@query("join_training_samples")
def _(s, d):
    b, u, i = tables(s, d, "orders")
    return J.join_training_samples(b, u, i, hot_rows=200).drop("create_time")


@query("join_exclude_cold_users")
def _(s, d):
    test, users, _ = offline(s, d)
    warm = users.filter("buy_count > 2")
    return J.join_exclude_cold_users(test, warm).select("id", "user_id", "buy_rate", "active_score", "high_freq_category")


@query("count_cold_rows")
def _(s, d):
    test, users, _ = offline(s, d)
    return J.count_cold_rows(test, users.filter("buy_count > 2"))


@query("join_pairs_interactions")
def _(s, d):
    history, test = halves(s, d)
    return J.join_pairs_interactions(test, X.agg_interactions(C.history_behavior(history)))


@query("join_rec_then_behavior")
def _(s, d):
    return J.join_rec_then_behavior(recs(s, d), beh(s, d), hot_rows=5)


@query("semi_rec_viewed")
def _(s, d):
    return J.semi_rec(recs(s, d), beh(s, d), "pv").select("user_id", "item_id", "rank_no")


@query("semi_rec_bought")
def _(s, d):
    return J.semi_rec(recs(s, d), beh(s, d), "buy").select("user_id", "item_id", "rank_no")


@query("join_before_after")
def _(s, d):
    return J.join_before_after(recs(s, d), beh(s, d))


# --- aggregates ---------------------------------------------------------------------------------
def both_sources(name: str):
    """Register ``name`` on events and ``name_orders`` on the larger order history."""
    def add(fn):
        query(name)(lambda s, d: fn(s, d, "events"))
        query(f"{name}_orders")(lambda s, d: fn(s, d, "orders"))
        return fn

    return add


@both_sources("agg_user_behavior_counts")
def _(s, d, source):
    return X.agg_user_behavior_counts(beh(s, d, source))


@both_sources("agg_item_behavior_counts")
def _(s, d, source):
    return X.agg_item_behavior_counts(beh(s, d, source))


@both_sources("user_features")
def _(s, d, source):
    return X.user_features(beh(s, d, source))


@both_sources("item_features")
def _(s, d, source):
    return X.item_features(beh(s, d, source))


@both_sources("behavior_distribution")
def _(s, d, source):
    return X.behavior_distribution(beh(s, d, source))


@both_sources("behavior_funnel")
def _(s, d, source):
    return X.behavior_funnel(beh(s, d, source))


@query("behavior_share")
def _(s, d):
    return X.behavior_share(beh(s, d))


@query("behavior_type_counts")
def _(s, d):
    return X.behavior_type_counts(A.behaviors_from_events(A.table(s, d, "events")))


@query("avg_user_profile")
def _(s, d):
    return X.avg_user_profile(X.user_features(beh(s, d)))


@query("user_feature_summary")
def _(s, d):
    return X.user_feature_summary(X.user_features(beh(s, d, "orders")))


@query("prediction_stats")
def _(s, d):
    return X.prediction_stats(recs(s, d), X.item_features(beh(s, d)))


@query("recommend_count_trend")
def _(s, d):
    # recommendations of 30-second windows fall on many different minutes
    b, u, i = tables(s, d)
    return X.recommend_count_trend(FD.in_range(RC.recommend(b, u, i), RANGE_START, RANGE_END))


@both_sources("agg_training_samples")
def _(s, d, source):
    return X.agg_training_samples(*tables(s, d, source))


@query("agg_interactions")
def _(s, d):
    return X.agg_interactions(C.history_behavior(beh(s, d)))


@query("hot_items_two_phase")
def _(s, d):
    return W.hot_items_two_phase(C.with_event_time(beh(s, d)))


@query("hot_items_unsalted")
def _(s, d):
    return W.hot_items_unsalted(C.with_event_time(beh(s, d)))


@query("hot_items_two_phase_day")
def _(s, d):
    return W.hot_items_two_phase(C.with_event_time(beh(s, d)), REC_SIZE, REC_SLIDE)


@query("hot_items_two_phase_orders")
def _(s, d):
    return W.hot_items_two_phase(C.with_event_time(beh(s, d, "orders")), ORDER_SIZE, ORDER_SLIDE)


@query("dataset_profile")
def _(s, d):
    return X.dataset_profile(beh(s, d, "orders"))


@query("interaction_coverage")
def _(s, d):
    history, test = halves(s, d)
    pairs = J.join_pairs_interactions(test, X.agg_interactions(C.history_behavior(history)))
    return X.interaction_coverage(pairs)


@query("score_summary")
def _(s, d):
    return E.score_summary(offline_scored(s, d))


@query("ctr_cvr_after_rec")
def _(s, d):
    return E.ctr_cvr_after_rec(recs(s, d), beh(s, d))


@query("ctr_cvr_after_rec_orders")
def _(s, d):
    return E.ctr_cvr_after_rec(recs(s, d, "orders"), beh(s, d, "orders"))


@query("ctr_cvr_naive")
def _(s, d):
    return E.ctr_cvr_naive(recs(s, d), beh(s, d))


@query("pr_auc_average_precision")
def _(s, d):
    """A continuous score (hence very many steps): the row's value against a purchase label."""
    ev = A.table(s, d, "events")
    return E.pr_auc_average_precision(
        ev.select(F.col("value").alias("predict_score"), (F.col("event_type") == "purchase").cast("int").alias("label"))
    )


@query("precision_recall_points")
def _(s, d):
    ev = A.table(s, d, "events")
    rows = ev.select(F.col("value").alias("v"), (F.col("event_type") == "purchase").cast("int").alias("y"))
    return E.precision_recall_points(stored(E.score_counts(rows, "v", "y"), "score_counts"))


@query("classification_report")
def _(s, d):
    return E.classification_report(offline_scored(s, d), threshold=0.25)


# --- ranking and look-ups ------------------------------------------------------------------------
@both_sources("user_high_freq_category")
def _(s, d, source):
    return X.user_high_freq_category(beh(s, d, source))


@both_sources("topk_per_user")
def _(s, d, source):
    return recs(s, d, source).drop("recommend_type")


def scored_windows(s, d):
    _, u, i = tables(s, d)
    return RC.score_features(windows(s, d), u, i)


@query("serving_top50")
def _(s, d):
    return R.serving_top50(scored_windows(s, d))


@query("latest_recommendations")
def _(s, d):
    return R.latest_recommendations(recs(s, d))


@query("latest_recommendations_fallback")
def _(s, d):
    """Users with even ids are served; the others' lists come from the table."""
    served = R.serving_top50(scored_windows(s, d)).filter("user_id % 2 = 0")
    return R.served_or_stored(served, recs(s, d))


@query("latest_recommendations_by_rank")
def _(s, d):
    return R.latest_recommendations(recs(s, d), ONE_USER, by="rank")


@query("top10_items")
def _(s, d):
    return D.top10_items(X.item_features(C.clean_valid(feed(s, d))))


@query("item_list")
def _(s, d):
    return D.item_list(X.item_features(beh(s, d)))


@query("item_list_keyword")
def _(s, d):
    return D.item_list(X.item_features(beh(s, d, "orders")), "7")


@query("recent_behaviors")
def _(s, d):
    return D.recent_behaviors(beh(s, d), ONE_USER, 20)


@query("category_list")
def _(s, d):
    return D.category_list(X.item_features(beh(s, d)))


@query("user_list")
def _(s, d):
    return D.user_list(X.user_features(beh(s, d)))


@query("user_profile")
def _(s, d):
    """Every customer is wanted; most have no events and get zeros."""
    wanted = A.table(s, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return D.user_profile(X.user_features(beh(s, d)), wanted)


@query("pr_auc_latest")
def _(s, d):
    return D.pr_auc_latest(metrics(s, d))


@query("pr_auc_trend")
def _(s, d):
    return D.pr_auc_trend(metrics(s, d))


@query("ctr_cvr_trend")
def _(s, d):
    return D.ctr_cvr_trend(metrics(s, d), RANGE_START, RANGE_END)


@query("ctr_cvr_trend_with_sentinel")
def _(s, d):
    return D.ctr_cvr_trend(metrics(s, d), RANGE_START, RANGE_END, exclude_sentinel=False)


@query("ctr_cvr_lookup")
def _(s, d):
    return D.ctr_cvr_lookup(metrics(s, d), recs(s, d), "2024-01-10 00:00:00", "2024-01-10 23:59:59")


# --- set operations and sampling ---------------------------------------------------------------
@query("distinct_pairs")
def _(s, d):
    return J.distinct_pairs(beh(s, d, "orders"))


def samples(s, d):
    return X.agg_training_samples(*tables(s, d, "orders"))


@query("union_pos_neg")
def _(s, d):
    rows = samples(s, d)
    return P.union_pos_neg(rows.filter("buy_label = 1"), rows.filter("buy_label = 0"))


@query("downsample_negatives")
def _(s, d):
    return P.downsample_negatives(samples(s, d), ratio=2)


@query("train_test_split")
def _(s, d):
    return P.train_test_split(samples(s, d)).select("user_id", "item_id", "is_test")


@query("with_folds")
def _(s, d):
    return P.with_folds(samples(s, d)).select("user_id", "item_id", "fold")


@query("class_balance_weight")
def _(s, d):
    return P.class_balance_weight(samples(s, d)).select("user_id", "item_id", "buy_label", "weight")


@query("impute_zero")
def _(s, d):
    history, test = halves(s, d)
    pairs = J.distinct_pairs(test).join(X.agg_interactions(C.history_behavior(history)), ["user_id", "item_id"], "left")
    return P.impute_zero(pairs, ["pv_count_5min", "is_cart_or_fav"])


@query("dedupe_behavior")
def _(s, d):
    b = beh(s, d)
    again = b.withColumn("id", F.col("id") + 1_000_000_000)
    return C.dedupe_behavior(b.unionByName(again))


# --- scalars --------------------------------------------------------------------------------------
@query("final_score")
def _(s, d):
    return scored_windows(s, d).select(
        "window_start", "user_id", "item_id", "predict_score", "popularity_score", "final_score"
    )


@query("behavior_ts")
def _(s, d):
    return C.with_event_time(beh(s, d)).select("id", "event_time")


# --- scoring and evaluation ------------------------------------------------------------------------
@query("build_training_set")
def _(s, d):
    return TR.build_training_set(beh(s, d))


def grown_ensemble(trees: int, depth: int) -> Ensemble:
    """As many trees as the search may choose, with thresholds and leaves by a rule."""
    steps = {"buy_rate": 0.05, "active_score": 0.04, "pv_count_5min": 0.75, "is_cart_or_fav": 0.5, "category_match": 0.5}

    def grown(level: int, k: int):
        if not level:
            return ((k * 37) % 101 - 50) / 64
        feature = list(steps)[(k * 7 + level) % len(steps)]
        return Split(feature, (1 + (k * 5 + level) % 19) * steps[feature], grown(level - 1, 2 * k), grown(level - 1, 2 * k + 1))

    return Ensemble(tuple(grown(depth, k + 1) for k in range(trees)), rate=0.1, intercept=-1.0)


LARGE = {"50x3": grown_ensemble(50, 3), "100x5": grown_ensemble(100, 5)}


def scored_by_vectors(name: str):
    @query(f"score_tree_ensemble_{name}")
    def _(s, d):
        samples = X.agg_training_samples(*tables(s, d, "orders"))
        return score_tree_ensemble(samples, LARGE[name]).select("user_id", "item_id", "predict_score")


for _name in LARGE:
    scored_by_vectors(_name)


@query("score_tree_ensemble")
def _(s, d):
    rows = X.agg_training_samples(*tables(s, d, "orders"))
    return score_tree_ensemble(rows).select("user_id", "item_id", "predict_score")


@query("score_batch")
def _(s, d):
    return offline_scored(s, d)


@query("evaluate_offline")
def _(s, d):
    return EV.evaluate_offline(*offline(s, d))


@query("evaluate_online")
def _(s, d):
    return EV.evaluate_online(recs(s, d), beh(s, d), RANGE_START, RANGE_END)


def prepared(s, d):
    return TR.prepare(samples(s, d))


def held_out(model, test):
    """The rows no fit has seen, and two facts worked out from their scores: each is a probability, and
    together they rank buyers better than chance would (average precision above the share of buyers)."""
    scored = stored(TR.score_with(model, test), "scored")
    area, _ = TR.held_out(model, test)
    share = scored.agg(F.avg("buy_label")).first()[0]
    return scored.select(
        "user_id", "item_id", "buy_label", F.col("predict_score").between(0, 1).alias("in_range"), F.lit(area > share).alias("beats_chance"))


def trained(pipeline_of):
    def run(s, d):
        data = prepared(s, d)
        return held_out(pipeline_of(data).fit(data.train), data.test)

    return run


query("train_gbt")(trained(lambda data: TR.train_gbt(50, 3, 0.1)))
query("train_rf")(trained(lambda data: TR.train_rf(50, 5)))
query("train_logreg")(trained(lambda data: TR.train_logreg(1.0, data.train_rows)))
query("train_fallback_tree")(trained(lambda data: TR.train_fallback_tree()))


#: Fits at a time. The result is the same for any number.
AT_ONCE = 6
_SEARCHED: dict[tuple[str, str], tuple] = {}


def searched(s, d):
    """The whole search, once for the queries that report on it: training rows, fold scores, ranked models, and
    where the champion was saved."""
    key = (s.sparkContext.applicationId, d)
    if key not in _SEARCHED:
        data, path = prepared(s, d), fresh_path(s, "champion")
        scores = SE.search(data, parallel=AT_ONCE)
        ranked = SE.best_models(data, scores, AT_ONCE)
        TR.save_best(data, ranked, path)
        _SEARCHED[key] = (data, scores, ranked, path)
    return _SEARCHED[key]


@query("grid_search_cv")
def _(s, d):
    """All 15 options over three folds: each one's parameters, its folds, whether its scores are shares, and
    whether its place is what the stored fold scores give, worked out anew by counting better options."""
    _, scores, _, _ = searched(s, d)
    own = SE.ranked_options(scores)
    means = scores.groupBy("family", "params").agg((F.sum("score") / F.count(F.lit(1))).alias("mean"), F.min("score").alias("low"), F.max("score").alias("high"))
    x, y = means.alias("x"), means.alias("y")
    better = x.join(y, F.expr("y.mean > x.mean OR y.mean = x.mean AND (y.family, y.params) < (x.family, x.params)"), "left").groupBy(
        "x.family", "x.params", "x.low", "x.high").agg(F.count("y.mean").alias("better"))
    return own.join(better, ["family", "params"]).select(
        "family", "params", "folds", ((F.col("low") > 0) & (F.col("high") <= 1)).alias("in_range"),
        (F.col("place") == F.col("better") + 1).alias("place_holds"))


@query("rank_models")
def _(s, d):
    """Each family's best option by its fold scores, best family first."""
    _, scores, ranked, _ = searched(s, d)
    best = {r["family"]: r for r in scores.groupBy("family", "params").agg(F.avg("score").alias("score")).groupBy("family").agg(
        F.max_by("params", F.struct("score", "params")).alias("params"), F.max("score").alias("score")).collect()}
    rows = [(n, abs(c.score - best[c.name]["score"]) < 1e-12, all(best[c.name]["score"] >= best[x.name]["score"] for x in ranked[n:]))
            for n, c in enumerate(ranked, 1)]
    return s.createDataFrame(rows, "place INT, best_of_family BOOLEAN, in_order BOOLEAN")


@query("select_champion")
def _(s, d):
    """What the champion of all options, loaded from where it was saved, says of the held-out rows."""
    from pyspark.ml import PipelineModel

    data, _, _, path = searched(s, d)
    return held_out(PipelineModel.load(path), data.test)


@query("score_batch_champion")
def _(s, d):
    """The saved champion scores the offline test rows, as ``score_batch`` does with the starting model; each score
    is a probability, and the one that the model gave before it was saved."""
    _, _, ranked, path = searched(s, d)
    test, users, history = offline(s, d)
    own = use_utc(s.newSession())  # a loaded model carries its session along
    rows = EV.offline_features(C.with_labels(test).drop("is_cart_or_fav"), users, history, keep=("id", "label"))
    rows = own.read.parquet(store(rows, "offline"))
    scored = EV.score_batch(rows, TR.scorer(path))
    before = TR.score_with(ranked[0].model, rows, "before").select("id", "before")
    return scored.join(before, "id").select("user_id", "item_id", "id", "label", F.col("predict_score").between(0, 1).alias("in_range"),
                                            (F.abs(F.col("predict_score") - F.col("before")) < 1e-12).alias("as_fitted"))


# --- sinks ----------------------------------------------------------------------------------------
@query("sink_append_behavior")
def _(s, d):
    path = fresh_path(s, "user_behavior")
    for half in halves(s, d):
        K.append_behavior(half, path)
    return s.read.parquet(path).drop("day")


def rec_batches(s, d):
    """Recommendations as of the split, and as of the end."""
    history, _ = halves(s, d)
    size, slide = f"{REC_SIZE} seconds", f"{REC_SLIDE} seconds"
    early = RC.recommend(history, X.user_features(history), X.item_features(history), size=size, slide=slide)
    return early, recs(s, d)


def upserted(s, d, prune):
    path = fresh_path(s, "recommendations")
    for n, batch in enumerate(rec_batches(s, d)):
        K.write_changes(batch, path, n)
    return K.read_recommendations(s, path, prune)


@query("sink_upsert_levelled")
def _(s, d):
    """The same upserts in a log that is merged every second batch; the newest batch comes four times."""
    log = K.upsert_log(fresh_path(s, "recommendations"), buckets=8, every=2)
    early, late = rec_batches(s, d)
    late = s.read.parquet(store(late, "recs"))
    for n, batch in enumerate((early, late, late, late, late)):
        log.write(batch, n)
    return K.upserted(s, log)


@query("sink_upsert_recommendations")
def _(s, d):
    return upserted(s, d, False)


@query("sink_upsert_recommendations_pruned")
def _(s, d):
    return upserted(s, d, True)


@query("merge_recommendations")
def _(s, d):
    early, late = rec_batches(s, d)
    return K.upsert_once(early, late)


@query("sink_serving_scores")
def _(s, d):
    path = fresh_path(s, "serving")
    K.write_serving(R.serving_top50(scored_windows(s, d)), path, F.lit(AS_OF).cast("timestamp"))
    return s.read.parquet(path).drop("user_bucket")


def refreshed(s, d):
    users, items = fresh_path(s, "user_features"), fresh_path(s, "item_features")
    for rows in (halves(s, d)[0], beh(s, d)):  # the second run replaces the first
        RF.refresh_features(rows, users, items, F.lit(AS_OF).cast("timestamp"))
    return users, items


@query("sink_replace_user_features")
def _(s, d):
    return K.read_table(s, refreshed(s, d)[0])


@query("sink_replace_item_features")
def _(s, d):
    return K.read_table(s, refreshed(s, d)[1])


@query("refresh_features")
def _(s, d):
    users, items = refreshed(s, d)
    return J.join_training_samples(beh(s, d), K.read_table(s, users), K.read_table(s, items)).select(
        "id", "buy_rate", "active_score", "high_freq_category", "item_category"
    )


@query("sink_eval_metrics")
def _(s, d):
    path = fresh_path(s, "eval_metrics")
    K.append_metrics(EV.offline_row(EV.evaluate_offline(*offline(s, d)), AS_OF, AS_OF, 1), path)
    on = EV.evaluate_online(recs(s, d), beh(s, d), RANGE_START, RANGE_END)
    K.append_metrics(EV.online_row(on, RANGE_START, RANGE_END, AS_OF, 2), path)
    return s.read.schema(S.EVAL_METRICS).parquet(path)


@query("sink_rebuild_table")
def _(s, d):
    return K.rebuild_table(beh(s, d), fresh_path(s, "user_behavior"))


@query("expire_serving")
def _(s, d):
    """Each pair counts as served at its last behaviour; lists with a row of the last 23 hours stay whole."""
    served = beh(s, d).groupBy("user_id", "item_id").agg(F.max("create_time").alias("updated_at"))
    return K.expire_serving(served, F.lit("2024-01-30 12:00:00").cast("timestamp"))


@query("export_features_csv")
def _(s, d):
    path = fresh_path(s, "csv")
    history, _ = halves(s, d)
    K.export_csv(X.agg_interactions(C.history_behavior(history)), path)
    return s.read.schema("user_id BIGINT, item_id BIGINT, pv_count_5min BIGINT, is_cart_or_fav INT").option(
        "header", True).csv(path)


# --- windows and streams -----------------------------------------------------------------------------
@query("win_sliding_features")
def _(s, d):
    return W.win_sliding_features(C.with_event_time(beh(s, d)))


@query("win_hot_items")
def _(s, d):
    """Hot items from cleaned raw lines, as the job sees them."""
    return W.hot_items_two_phase(C.with_event_time(C.clean_valid(feed(s, d))))


@query("win_sliding_features_day")
def _(s, d):
    return windows(s, d)


ARRIVALS = 5
#: Rows of a file of an arrival, about; larger tables arrive in more files.
FILE_ROWS = 10_000


def in_arrivals(s, d, rows: DataFrame, path: str, time: str) -> int:
    """Rows as files in order of time, ``ARRIVALS`` times a number of files, which it returns.

    The times are cut where a fifth of the span of the events ends, for every table alike.
    """
    span = s.read.parquet(f"{d}/events.parquet").agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    step = (span["high"] - span["low"]) / ARRIVALS
    files = max(1, rows.count() // (ARRIVALS * FILE_ROWS))
    for n in range(ARRIVALS):
        low, high = F.lit(span["low"] + n * step), F.lit(span["low"] + (n + 1) * step)
        own = rows if n == 0 else rows.filter(F.col(time) >= low)
        own = own if n == ARRIVALS - 1 else own.filter(F.col(time) < high)
        own.repartition(files).write.mode("append").parquet(path)
    return files


def events_arriving(s, d):
    folder = fresh_path(s, "arrivals")
    files = in_arrivals(s, d, s.read.parquet(f"{d}/events.parquet"), f"{folder}/events.parquet", "ts")
    return A.event_stream(s, folder, files_per_trigger=files)


def line_stream(s, d):
    return A.lines_from_events(events_arriving(s, d)).select("value")


def row_stream(s, d, delay=DELAY_SECONDS):
    rows = C.with_event_time(C.valid_rows(A.behaviors_from_events(events_arriving(s, d))))
    return W.watermarked(rows, f"{delay} seconds")


def landed(s, stream: DataFrame, name: str) -> DataFrame:
    path = fresh_path(s, name)
    wait(JB.file_sink(stream, path, fresh_path(s, "ck"), JB.Timing()))
    return s.read.schema(stream.schema).parquet(path)


@query("stream_land_behavior")
def _(s, d):
    path = fresh_path(s, "user_behavior")
    wait(JB.stream_land_behavior(line_stream(s, d), path, fresh_path(s, "ck"), JB.Timing()))
    return s.read.parquet(path).drop("create_time")


@query("stream_clean_metrics")
def _(s, d):
    path = fresh_path(s, "clean_metrics")
    wait(JB.stream_clean_metrics(line_stream(s, d), path, fresh_path(s, "ck"), JB.Timing()))
    return s.read.parquet(path).agg(
        F.sum("total_count").alias("total_count"), F.sum("filtered_count").alias("filtered_count")
    )


@query("stream_win_sliding_features")
def _(s, d):
    size, slide = f"{REC_SIZE} seconds", f"{REC_SLIDE} seconds"
    return landed(s, JB.stream_features(row_stream(s, d), size, slide), "features")


@query("stream_hot_items")
def _(s, d):
    return landed(s, JB.stream_hot_items(row_stream(s, d), REC_SIZE, REC_SLIDE), "hot")


def kept_current(s, d):
    users, items = fresh_path(s, "user_counts"), fresh_path(s, "item_counts")
    rows = C.valid_rows(A.behaviors_from_events(events_arriving(s, d)))
    for q in JB.stream_refresh(rows, users, items, fresh_path(s, "ck"), JB.Timing()):
        wait(q)
    return JB.read_refreshed(s, users, items)


@query("stream_user_features")
def _(s, d):
    return kept_current(s, d)[0]


@query("stream_item_features")
def _(s, d):
    return kept_current(s, d)[1]


def counted_in_levels(s, d):
    """Five arrivals, merged every second batch."""
    users, items = RS.user_counts(fresh_path(s, "user_counts"), 8, 2), RS.item_counts(fresh_path(s, "item_counts"), 8, 2)
    rows = C.valid_rows(A.behaviors_from_events(events_arriving(s, d)))
    wait(RS.stream_counts(rows, users, items, fresh_path(s, "ck"), JB.Timing()))
    return RS.read_features(s, users, items)


@query("stream_user_features_levelled")
def _(s, d):
    return counted_in_levels(s, d)[0]


@query("stream_item_features_levelled")
def _(s, d):
    return counted_in_levels(s, d)[1]


@query("stream_dedupe_behavior")
def _(s, d):
    """Every row twice in the same stream."""
    rows = row_stream(s, d).select(*S.LINE_FIELDS, "event_time", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return landed(s, JB.dedupe_stream(rows).drop("copy"), "deduped")


def feature_tables(s, d):
    """Features stored once, read anew by every micro-batch."""
    _, u, i = tables(s, d)
    users, items = store(u, "user_features"), store(i, "item_features")
    return lambda spark: (spark.read.parquet(users), spark.read.parquet(items))


def closed_windows(s, d):
    return JB.stream_features(row_stream(s, d), f"{REC_SIZE} seconds", f"{REC_SLIDE} seconds")


@query("stream_score")
def _(s, d):
    path = fresh_path(s, "scored")
    wait(JB.stream_score(closed_windows(s, d), feature_tables(s, d), path, fresh_path(s, "ck"), JB.Timing()))
    return s.read.parquet(path).select(
        "window_start", "user_id", "item_id", "predict_score", "popularity_score", "final_score"
    )


@query("stream_topk")
def _(s, d):
    path = fresh_path(s, "lists")
    wait(JB.stream_topk(closed_windows(s, d), feature_tables(s, d), path, fresh_path(s, "ck"), JB.Timing()))
    return JB.read_lists(s, path).drop("recommend_type")


def scores_arriving(s, scored: DataFrame) -> DataFrame:
    """Scored windows as a stream of ``ARRIVALS`` batches; a user's windows come in several of them."""
    rows = s.read.parquet(store(scored, "scored"))
    folder, files = fresh_path(s, "arrivals"), max(1, rows.count() // (ARRIVALS * FILE_ROWS))
    for n in range(ARRIVALS):
        own = rows.filter(F.pmod(F.expr(f"unix_timestamp(window_end) div {REC_SLIDE}"), F.lit(ARRIVALS)) == n)
        own.repartition(files).write.mode("append").parquet(folder)
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("stream_serving")
def _(s, d):
    """Served lists from five batches of scores: each replaces its items' scores and rewrites the buckets it touches."""
    path = fresh_path(s, "serving")
    stream = scores_arriving(s, scored_windows(s, d))
    wait(SV.stream_serving(stream, path, fresh_path(s, "ck"), JB.Timing(), F.lit(AS_OF).cast("timestamp"), buckets=16))
    return SV.read_serving(s, path, stream.schema["final_score"].dataType.simpleString())


@query("stateful_topk")
def _(s, d):
    """Keyed state instead of a merge: scores arrive as a stream, each user's last list counts."""
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    _, u, i = tables(s, d)
    path = fresh_path(s, "lists")
    lists = stateful_topk(scores_arriving(s, RC.score_features(windows(s, d), u, i)), flush_ms=0)

    def step(batch, batch_id):
        K.write_changes(batch, path, batch_id)

    wait(JB.batch_sink(lists, step, fresh_path(s, "ck"), JB.Timing(), mode="update"))
    return JB.current_lists(s.read.parquet(path)).drop("batch_id")


@query("stateful_topk_salted")
def _(s, d):
    """As ``stateful_topk``, with eight partial lists for each user."""
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    _, u, i = tables(s, d)
    path = fresh_path(s, "lists")
    lists = salted_topk(scores_arriving(s, RC.score_features(windows(s, d), u, i)), salts=8, flush_ms=0)
    wait(JB.batch_sink(lists, lambda batch, n: K.write_changes(batch, path, n), fresh_path(s, "ck"), JB.Timing(), mode="update"))
    return merged_lists(s.read.parquet(path))


@query("late_data")
def _(s, d):
    """The newer half arrives first; the older half is behind the watermark and is dropped."""
    b = C.with_event_time(beh(s, d)).drop("create_time")
    cut = F.lit(SPLIT_AT).cast("timestamp")
    folder, path, ck = fresh_path(s, "arrivals"), fresh_path(s, "features"), fresh_path(s, "ck")
    size, slide = f"{REC_SIZE} seconds", f"{REC_SLIDE} seconds"
    for part in (b.filter(F.col("event_time") >= cut), b.filter(F.col("event_time") < cut)):
        part.write.mode("append").parquet(folder)
        rows = W.watermarked(s.readStream.schema(b.schema).parquet(folder), f"{DELAY_SECONDS} seconds")
        wait(JB.file_sink(JB.stream_features(rows, size, slide), path, ck, JB.Timing()))
    return s.read.schema(W.win_sliding_features(b, size, slide).schema).parquet(path)


@query("late_data_reported")
def _(s, d):
    """As ``late_data``, with repeats dropped first; each row says how many rows were dropped as late."""
    b = C.with_event_time(beh(s, d)).drop("create_time")
    cut = F.lit(SPLIT_AT).cast("timestamp")
    folder, path, ck, reported = (fresh_path(s, x) for x in ("arrivals", "features", "ck", "report"))
    size, slide = f"{REC_SIZE} seconds", f"{REC_SLIDE} seconds"
    for part in (b.filter(F.col("event_time") >= cut), b.filter(F.col("event_time") < cut)):
        part.write.mode("append").parquet(folder)
        rows = JB.dedupe_stream(W.watermarked(s.readStream.schema(b.schema).parquet(folder), f"{DELAY_SECONDS} seconds"))
        q = JB.file_sink(JB.stream_features(rows, size, slide), path, ck, JB.Timing())
        wait(q)
        LT.OperatorReport().take(q).flush(s, reported)
    dropped = LT.late_rows(LT.read_report(s, reported)).agg(F.sum("late_rows")).first()[0]
    kept = s.read.schema(W.win_sliding_features(b, size, slide).schema).parquet(path)
    return kept.withColumn("late_rows", F.lit(dropped))


REC_BOUND_DAYS = 3


@query("stream_ctr_cvr_after_rec")
def _(s, d):
    """Recommendations and behaviours as two streams, five arrivals each, joined within three days."""
    path, folder, shown = fresh_path(s, "rates"), fresh_path(s, "arrivals"), fresh_path(s, "recs")
    made = s.read.parquet(store(recs(s, d).select("user_id", "item_id", "create_time"), "recs"))
    done = s.read.parquet(store(beh(s, d).select("user_id", "item_id", "behavior_type", "create_time"), "behaviors"))
    a, b = in_arrivals(s, d, made, shown, "create_time"), in_arrivals(s, d, done, folder, "create_time")
    left = s.readStream.schema(made.schema).option("maxFilesPerTrigger", a).parquet(shown)
    right = s.readStream.schema(done.schema).option("maxFilesPerTrigger", b).parquet(folder)
    for q in IV.stream_ctr_cvr(left, right, path, fresh_path(s, "ck"), JB.Timing(), f"{REC_BOUND_DAYS} days", f"{DELAY_SECONDS} seconds"):
        wait(q)
    return IV.read_ctr_cvr(s, path)


@query("stream_land_once")
def _(s, d):
    """Five arrivals, then the first and the third one again, far behind any watermark: no row comes twice."""
    folder, path = fresh_path(s, "arrivals"), fresh_path(s, "user_behavior")
    rows = s.read.parquet(store(C.valid_rows(beh(s, d)).select(*S.LINE_FIELDS, "create_time"), "behaviors"))
    files = in_arrivals(s, d, rows, folder, "create_time")
    span = rows.agg(F.min("create_time").alias("low"), F.max("create_time").alias("high")).first()
    step = (span["high"] - span["low"]) / ARRIVALS
    for n in (0, 2):
        low, high = F.lit(span["low"] + n * step), F.lit(span["low"] + (n + 1) * step)
        rows.filter(F.col("create_time").between(low, high)).repartition(files).write.mode("append").parquet(folder)
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    wait(RP.stream_land_once(stream, path, fresh_path(s, "ck"), JB.Timing(), per_day=max(1, rows.count() // 30)))
    return RP.read_landed(s, path)


@query("stream_console")
def _(s, d):
    """The console prints the top of each batch; the same stream into a folder can be checked."""
    top = JB.stream_hot_items(row_stream(s, d), REC_SIZE, REC_SLIDE)
    wait(JB.console_sink(top, "pv", fresh_path(s, "ck"), JB.Timing()))
    return landed(s, top, "console")


# line helpers used by the SQL twins
REASONS = lines.REASONS
