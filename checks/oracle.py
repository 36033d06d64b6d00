"""The same results in SQL, written against the raw tables."""

from __future__ import annotations

import json

from checks.queries import (
    ARRIVALS, AS_OF, DELAY_SECONDS, LARGE, ONE_USER, ORDER_SIZE, ORDER_SLIDE, RANGE_END, RANGE_START, REC_BOUND_DAYS, REC_SIZE, REC_SLIDE, SPLIT_AT,
)
from pathlark.functions.trees import STARTER, Split
from pathlark.plans import training as TR

TYPES = "('pv','cart','fav','buy')"


def us(stamp: str) -> str:
    return f"epoch_us(TIMESTAMP '{stamp}')"


EVENTS = """
ev AS (SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, epoch_us(ts) // 1000000 AS sec FROM events),
raw_beh AS (SELECT event_id AS id, user_id + 1 AS user_id, k + 1 AS item_id, k % 10 + 1 AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav'
              WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior_type,
         sec AS behavior_time, epoch_us(ts) AS create_time FROM ev)"""
BEH = EVENTS + f""",
beh AS (SELECT * FROM raw_beh WHERE behavior_type IN {TYPES})"""
ORD = f"""
beh AS (SELECT l_orderkey * 8 + l_linenumber AS id, o_custkey + 1 AS user_id, l_partkey + 1 AS item_id,
         l_partkey % 25 + 1 AS category_id,
         CASE WHEN l_linestatus = 'O' THEN 'pv' WHEN l_returnflag = 'R' THEN 'cart'
              WHEN l_returnflag = 'A' THEN 'fav' ELSE 'buy' END AS behavior_type,
         epoch_us(l_shipdate) // 1000000 + 788918400 AS behavior_time,
         epoch_us(l_shipdate) + 788918400000000 AS create_time
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SOURCE = {"events": BEH, "orders": ORD}


def counts(kinds: str = "pv buy cart fav") -> str:
    return ", ".join(f"count(*) FILTER (WHERE behavior_type = '{k}') AS {k}_count" for k in kinds.split())


def uf(name: str = "uf", src: str = "beh") -> str:
    return f"""
{name} AS (SELECT user_id, pv_count, buy_count, cart_count, fav_count,
    CASE WHEN pv_count > 0 THEN ((20000 * buy_count + pv_count) // (2 * pv_count)) / 10000.0 ELSE 0.0 END AS buy_rate,
    least(pv_count + buy_count + cart_count + fav_count, 100) / 100.0 AS active_score, high_freq_category
  FROM (SELECT user_id, {counts()} FROM {src} GROUP BY user_id) JOIN
       (SELECT user_id, category_id AS high_freq_category FROM
          (SELECT user_id, category_id,
                  row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category_id) AS rn
           FROM {src} GROUP BY user_id, category_id) WHERE rn = 1) USING (user_id))"""


def itf(name: str = "itf", src: str = "beh") -> str:
    return f"""
{name} AS (SELECT *, (3 * pv_count + 7 * buy_count) / 10.0 AS popularity_score FROM
   (SELECT item_id, max(category_id) AS category_id, {counts('pv buy')} FROM {src} GROUP BY item_id))"""


def win(size: int, slide: int, name: str = "win", src: str = "beh") -> str:
    return f"""
{name} AS (SELECT ws * 1000000 AS window_start, (ws + {size}) * 1000000 AS window_end, user_id, item_id,
    arg_max(category_id, behavior_time * 4294967296 - category_id) AS category_id, count(*) AS pv_count_5min,
    max(CASE WHEN behavior_type IN ('cart','fav') THEN 1 ELSE 0 END) AS is_cart_or_fav
  FROM (SELECT *, (behavior_time // {slide}) * {slide} - {slide} * unnest(range(0, {size // slide})) AS ws FROM {src})
  GROUP BY ws, user_id, item_id)"""


def leaves(node, path=()):
    if not isinstance(node, Split):
        return [(path, node)]
    x = f"CAST(CAST({node.feature} AS FLOAT) AS DOUBLE)"
    t = repr(float(node.threshold))
    return leaves(node.left, (*path, f"{x} <= CAST({t} AS DOUBLE)")) + leaves(
        node.right, (*path, f"{x} > CAST({t} AS DOUBLE)"))


def predict() -> str:
    """Sum over all leaves whose path conditions hold."""
    parts = [
        f"CASE WHEN {' AND '.join(p)} THEN CAST({v!r} AS DOUBLE) ELSE 0.0 END"
        for tree in STARTER.trees for p, v in leaves(tree)
    ]
    z = f"(({' + '.join(parts)}) * CAST({STARTER.rate!r} AS DOUBLE) + CAST({STARTER.intercept!r} AS DOUBLE))"
    return f"1.0 / (1.0 + exp(-{z}))"


def nested(node) -> str:
    if not isinstance(node, Split):
        return f"CAST({float(node)!r} AS DOUBLE)"
    return f"CASE WHEN {node.feature} <= CAST({float(node.threshold)!r} AS DOUBLE) THEN {nested(node.left)} ELSE {nested(node.right)} END"


def predict_large(model) -> str:
    """One value for each tree, added up."""
    names = ("buy_rate", "active_score", "pv_count_5min", "is_cart_or_fav", "category_match")
    inputs = ", ".join(f"CAST(CAST({n} AS FLOAT) AS DOUBLE) AS {n}" for n in names)
    z = f"list_sum([{', '.join(map(nested, model.trees))}]) * CAST({model.rate!r} AS DOUBLE) + CAST({model.intercept!r} AS DOUBLE)"
    return f"""SELECT user_id, item_id, round(1.0 / (1.0 + exp(-({z}))), 9) AS predict_score
      FROM (SELECT user_id, item_id, {inputs} FROM samples)"""


def enriched(win_name: str = "win", users: str = "uf", items: str = "itf", name: str = "scored") -> str:
    return f"""
{name} AS (SELECT *, CAST(0.7 AS DOUBLE) * predict_score + CAST(0.3 AS DOUBLE) * popularity_score AS fs FROM
  (SELECT *, {predict()} AS predict_score FROM
    (SELECT w.*, coalesce(u.buy_rate, 0.05) AS buy_rate, coalesce(u.active_score, 1.0) AS active_score,
       coalesce(u.high_freq_category, w.category_id) AS high_freq_category,
       CASE WHEN w.category_id = coalesce(u.high_freq_category, w.category_id) THEN 1 ELSE 0 END AS category_match,
       coalesce(i.popularity_score, 0.5) AS popularity_score
     FROM {win_name} w LEFT JOIN {users} u USING (user_id) LEFT JOIN {items} i USING (item_id))))"""


def topk(k: int, scored: str = "scored", name: str = "recs", rank: str = "rank_no") -> str:
    return f"""
{name} AS (SELECT * FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(fs, 12) DESC, item_id) AS {rank} FROM
    (SELECT user_id, item_id, arg_max(predict_score, fs) AS predict_score, arg_max(popularity_score, fs) AS popularity_score,
            max(fs) AS fs, min(window_end) AS create_time FROM {scored} GROUP BY user_id, item_id)) WHERE {rank} <= {k})"""


def recs(source: str = "events", size: int | None = None, slide: int | None = None) -> str:
    s, l = (REC_SIZE, REC_SLIDE) if source == "events" else (ORDER_SIZE, ORDER_SLIDE)
    return ",".join([SOURCE[source], uf(), itf(), win(size or s, slide or l), enriched(), topk(10)])


REC_COLS = """user_id, item_id, round(predict_score, 9) AS predict_score, popularity_score,
 round(fs, 12) AS final_score, rank_no, create_time"""
HALVES = BEH + f""",
history AS (SELECT * FROM beh WHERE create_time < {us(SPLIT_AT)}),
test AS (SELECT * FROM beh WHERE create_time >= {us(SPLIT_AT)})"""
PAST = """
past AS (SELECT user_id, item_id, least(count(*), 20) AS pv_count_5min,
   max(CASE WHEN behavior_type IN ('cart','fav') THEN 1 ELSE 0 END) AS is_cart_or_fav
 FROM history WHERE behavior_type IN ('pv','cart','fav') GROUP BY user_id, item_id)"""
OFFLINE = ",".join([HALVES, uf(src="history"), PAST]) + f""",
feat AS (SELECT t.user_id, t.item_id, t.id, CASE WHEN behavior_type = 'buy' THEN 1 ELSE 0 END AS label, buy_rate,
   active_score, CASE WHEN t.category_id = high_freq_category THEN 1 ELSE 0 END AS category_match,
   coalesce(pv_count_5min, 0) AS pv_count_5min, coalesce(is_cart_or_fav, 0) AS is_cart_or_fav
 FROM test t JOIN uf USING (user_id) LEFT JOIN past USING (user_id, item_id)),
off AS (SELECT *, {predict()} AS predict_score FROM feat)"""


def ap(rel: str, score: str, label: str) -> str:
    return f"""
steps AS (SELECT {score} AS s, count(*) AS n, sum({label}) AS pos FROM {rel} GROUP BY 1),
points AS (SELECT s, n, CAST(pos AS BIGINT) AS pos, CAST(sum(n) OVER (ORDER BY s DESC) AS BIGINT) AS cum_n,
                  CAST(sum(pos) OVER (ORDER BY s DESC) AS BIGINT) AS cum_pos FROM steps)"""


AP_OUT = """SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(pos) AS BIGINT) AS positive_count,
 round(CASE WHEN sum(pos) > 0 THEN sum(pos * (cum_pos / CAST(cum_n AS DOUBLE))) / sum(pos) ELSE 0.0 END, 9) AS pr_auc FROM points"""

LINES = EVENTS + """,
ev_lines AS (SELECT CASE event_type
    WHEN 'click' THEN ' ' || user_id || ',' || k || ',' || k % 10 || ', CART , ' || sec || ',,'
    WHEN 'signup' THEN user_id || ',' || k || ',' || k % 10 || ',fav,' || sec * 1000
    ELSE user_id || ',' || k || ',' || k % 10 || ',' ||
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' ELSE event_type END || ',' || sec END AS value FROM ev)"""
FEED = LINES + """,
feed AS (SELECT value FROM ev_lines UNION ALL SELECT unnest(string_split(text, chr(10))) FROM documents)"""


def num(i: int) -> str:
    bare = f"regexp_replace(regexp_replace(f[{i}], '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '')"
    return f"CASE WHEN regexp_full_match({bare}, '[+-]?[0-9]+') THEN TRY_CAST({bare} AS BIGINT) END"


def parsed(src: str = "feed", normalize: bool = True) -> str:
    ts = "CASE WHEN t0 > 2000000000 AND t0 >= 1451606400000 THEN t0 // 1000 ELSE t0 END" if normalize else "t0"
    strip = "regexp_replace(regexp_replace({}, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '')"
    return f"""
cut AS (SELECT value, {strip.format('value')} AS v FROM {src}),
split AS (SELECT value, v, string_split(regexp_replace(v, ',+$', ''), ',') AS f FROM cut),
nums AS (SELECT value, v, f, {num(1)} AS user_id, {num(2)} AS item_id, {num(3)} AS category_id,
   lower({strip.format('f[4]')}) AS behavior_type, {num(5)} AS t0 FROM split),
typed AS (SELECT *, {ts} AS behavior_time FROM nums),
parsed AS (SELECT *, CASE WHEN v = '' THEN 'blank' WHEN len(f) <> 5 THEN 'field_count'
   WHEN user_id IS NULL THEN 'non_numeric' WHEN user_id <= 0 THEN 'user_id'
   WHEN item_id IS NULL THEN 'non_numeric' WHEN item_id <= 0 THEN 'item_id'
   WHEN category_id IS NULL THEN 'non_numeric' WHEN category_id <= 0 THEN 'category_id'
   WHEN behavior_type NOT IN {TYPES} THEN 'behavior_type'
   WHEN behavior_time IS NULL THEN 'non_numeric'
   WHEN behavior_time < 1451606400 OR behavior_time > 1893456000 THEN 'timestamp' END AS reject_reason FROM typed)"""


TYPED = "user_id, item_id, category_id, behavior_type, behavior_time"
# A window of a stream is out once the newest stamp, less the delay, has reached its end.
CLOSED = f"window_end <= (SELECT max(behavior_time) - {DELAY_SECONDS} FROM beh) * 1000000"
METRICS = f""",
outcome AS (SELECT r.user_id, r.item_id, r.create_time // 86400000000 AS day,
   bool_or(coalesce(b.behavior_type = 'pv' AND b.create_time > r.create_time, FALSE)) AS viewed,
   bool_or(coalesce(b.behavior_type = 'buy' AND b.create_time > r.create_time, FALSE)) AS bought
  FROM recs r LEFT JOIN beh b USING (user_id, item_id) GROUP BY 1, 2, 3),
days AS (SELECT day, count(*) AS n, count(*) FILTER (WHERE viewed) AS v, count(*) FILTER (WHERE bought) AS w FROM outcome GROUP BY day),
shares AS (SELECT create_time // 86400000000 AS day, count(*) AS n, count(*) FILTER (WHERE behavior_type = 'buy') AS w FROM beh GROUP BY 1),
metrics AS (
  SELECT (day - 19723) * 2 AS id, day * 86400000000 AS metric_start_time, (day + 1) * 86400000000 - 1000000 AS metric_end_time,
    -1.0 AS pr_auc, ((20000 * v + n) // (2 * n)) / 10000.0 AS ctr,
    CASE WHEN v > 0 THEN ((20000 * w + v) // (2 * v)) / 10000.0 ELSE 0.0 END AS cvr, n AS recommend_count FROM days
  UNION ALL
  SELECT (day - 19723) * 2 + 1, day * 86400000000, (day + 1) * 86400000000 - 1000000,
    ((20000 * w + n) // (2 * n)) / 10000.0, -1.0, -1.0, -1 FROM shares)"""
PROFILE = ", ".join(
    f"CAST(sum({c}) AS DOUBLE) / count(*) AS avg_{c}" for c in ("pv_count", "buy_count", "cart_count", "fav_count"))
PROFILE4 = ", ".join(  # four-decimal values are summed as whole ten-thousandths
    f"round(CAST(sum(CAST(round({c} * 10000) AS BIGINT)) AS DOUBLE) / 10000.0 / count(*), 9) AS avg_{c}"
    for c in ("buy_rate", "active_score"))
PROFILE = ", ".join(f"round({p.split(' AS avg_')[0]}, 9) AS avg_{p.split(' AS avg_')[1]}" for p in PROFILE.split(", ")) + ", " + PROFILE4
SAMPLES = """
pairs AS (SELECT user_id, item_id, least(count(*), 20) AS pv_count_5min,
   max(CASE WHEN behavior_type IN ('cart','fav') THEN 1 ELSE 0 END) AS is_cart_or_fav,
   max(CASE WHEN behavior_type = 'buy' THEN 1 ELSE 0 END) AS buy_label FROM beh GROUP BY user_id, item_id),
samples AS (SELECT user_id, item_id, buy_rate, active_score, pv_count_5min, is_cart_or_fav,
   CASE WHEN itf.category_id = high_freq_category THEN 1 ELSE 0 END AS category_match, buy_label
  FROM pairs JOIN uf USING (user_id) JOIN itf USING (item_id))"""
SAMPLE_COLS = "user_id, item_id, buy_rate, active_score, pv_count_5min, is_cart_or_fav, category_match, buy_label"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def base(source: str = "events") -> str:
    return ",".join([SOURCE[source], uf(), itf()])


def sampled(source: str = "orders") -> str:
    return ",".join([base(source), SAMPLES])


def hot(size: int, slide: int, source: str = "events", closed: bool = False, ctes: str = "") -> str:
    return with_(ctes or SOURCE[source], f"""SELECT ws * 1000000 AS window_start, (ws + {size}) * 1000000 AS window_end, item_id, count(*) AS pv
 FROM (SELECT item_id, (behavior_time // {slide}) * {slide} - {slide} * unnest(range(0, {size // slide})) AS ws
       FROM beh WHERE behavior_type = 'pv') GROUP BY ws, item_id
 {"HAVING " + CLOSED.replace("window_end", f"(ws + {size}) * 1000000") if closed else ""}""")


CTR = """SELECT count(*) AS recommend_count, count(*) FILTER (WHERE viewed) AS viewed_count,
  count(*) FILTER (WHERE bought) AS bought_count,
  round(coalesce(count(*) FILTER (WHERE viewed) / CAST(nullif(count(*), 0) AS DOUBLE), 0.0), 9) AS ctr,
  round(coalesce(count(*) FILTER (WHERE bought) / CAST(nullif(count(*) FILTER (WHERE viewed), 0) AS DOUBLE), 0.0), 9) AS cvr FROM o"""


def ctr(where_rec: str = "TRUE", where_beh: str = "TRUE", later: str = "AND b.create_time > r.create_time") -> str:
    def some(kind: str) -> str:
        return f"""EXISTS (SELECT 1 FROM beh b WHERE b.user_id = r.user_id AND b.item_id = r.item_id
             AND b.behavior_type = '{kind}' {later} AND {where_beh})"""

    return f""",
o AS (SELECT {some('pv')} AS viewed, {some('buy')} AS bought FROM recs r WHERE {where_rec})
{CTR}"""


BETWEEN = f"BETWEEN {us(RANGE_START)} AND {us(RANGE_END)}"


def hexrank(label: str) -> str:
    return f"""
hashed AS (SELECT *, md5(concat_ws('|', 42, user_id, item_id)) AS h FROM samples),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY h) AS rn FROM hashed)"""


def upsert(prune: bool) -> str:
    early = ",".join([
        uf("uf0", "history"), itf("itf0", "history"), win(REC_SIZE, REC_SLIDE, "win0", "history"),
        enriched("win0", "uf0", "itf0", "scored0"), topk(10, "scored0", "recs0"),
    ])
    ctes = ",".join([HALVES, uf(), itf(), win(REC_SIZE, REC_SLIDE), enriched(), topk(10), early])
    keep = "AND r0.user_id NOT IN (SELECT user_id FROM recs)" if prune else ""
    return with_(ctes, f"""SELECT user_id, item_id, round(predict_score, 9) AS predict_score, popularity_score, round(fs, 12) AS final_score,
  rank_no, 'realtime' AS recommend_type, create_time FROM (
 SELECT r.user_id, r.item_id, r.predict_score, r.popularity_score, r.fs, r.rank_no,
        least(r.create_time, coalesce(r0.create_time, r.create_time)) AS create_time
 FROM recs r LEFT JOIN recs0 r0 USING (user_id, item_id)
 UNION ALL
 SELECT r0.user_id, r0.item_id, r0.predict_score, r0.popularity_score, r0.fs, r0.rank_no, r0.create_time FROM recs0 r0
 WHERE NOT EXISTS (SELECT 1 FROM recs r WHERE r.user_id = r0.user_id AND r.item_id = r0.item_id) {keep})""")


def level(x: str) -> str:
    return f"CASE WHEN {x} >= 0.7 THEN '高' WHEN {x} >= 0.4 THEN '中' ELSE '低' END"


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    scored = ",".join([base(), win(REC_SIZE, REC_SLIDE), enriched()])
    rw = win(REC_SIZE, REC_SLIDE)
    win_cols = "window_start, window_end, user_id, item_id, category_id, pv_count_5min, is_cart_or_fav"
    rates = "predict_score"

    # sources
    o["src_stream_behavior"] = with_(LINES, "SELECT value FROM ev_lines")
    o["src_csv_behavior"] = with_(EVENTS, f"""SELECT user_id, item_id, category_id, behavior_type,
      CASE WHEN behavior_type = 'fav' THEN 0 ELSE behavior_time END AS behavior_time, {us(AS_OF)} AS create_time
      FROM raw_beh WHERE behavior_type <> 'error'""")
    o["src_csv_user_features"] = with_(base(), f"""SELECT user_id, pv_count, buy_count, cart_count, fav_count, buy_rate,
      active_score, high_freq_category, {us(AS_OF)} AS update_time FROM uf""")
    o["src_headered_or_not_csv"] = with_(BEH, f"SELECT {TYPED} FROM beh")
    o["src_table_range"] = with_(BEH, f"SELECT * FROM beh WHERE create_time {BETWEEN}")
    o["src_history_behavior"] = with_(BEH, "SELECT user_id, item_id, behavior_type FROM beh WHERE behavior_type <> 'buy'")

    # cleaning and projections
    good = f"SELECT {TYPED} FROM parsed WHERE reject_reason IS NULL"
    o["clean_valid"] = with_(FEED + "," + parsed(), good)
    o["clean_valid_filter_first"] = with_(FEED + "," + parsed(normalize=False), good)
    o["clean_reject_reasons"] = with_(
        FEED + "," + parsed(), "SELECT value, reject_reason FROM parsed WHERE reject_reason IS NOT NULL")
    o["clean_stats"] = with_(FEED + "," + parsed(), """SELECT count(*) AS total_count, count(reject_reason) AS filtered_count,
      round(count(reject_reason) * 100.0 / count(*), 1) AS filtered_percent FROM parsed""")
    o["time_normalize"] = with_(LINES + """,
      feed AS (SELECT value FROM ev_lines UNION ALL SELECT unnest(string_split(text, chr(10))) FROM documents)""",
      r"""SELECT CASE WHEN regexp_full_match(value, '[0-9]+,[0-9]+,[0-9]+,fav,[0-9]{13}')
        THEN left(value, len(value) - 3) ELSE value END AS value FROM feed""")
    o["parse_behavior"] = with_(LINES + "," + parsed("ev_lines"), f"SELECT {TYPED} FROM parsed")
    o["format_lines"] = with_(BEH, """SELECT user_id || ',' || item_id || ',' || category_id || ',' || behavior_type || ',' ||
      behavior_time AS value FROM beh""")
    o["filter_pv"] = with_(BEH, "SELECT item_id, 1 AS cnt FROM beh WHERE behavior_type = 'pv'")
    o["project_features"] = with_(OFFLINE, """SELECT id, buy_rate, active_score, CAST(pv_count_5min AS DOUBLE) AS pv_count_5min,
      CAST(is_cart_or_fav AS DOUBLE) AS is_cart_or_fav, CAST(category_match AS DOUBLE) AS category_match FROM feat""")
    o["label_buy"] = with_(BEH, """SELECT id, CAST(behavior_type = 'buy' AS INT) AS label,
      CAST(behavior_type IN ('cart','fav') AS INT) AS is_cart_or_fav FROM beh""")
    o["behavior_type_desc"] = with_(EVENTS, """SELECT id, CASE behavior_type WHEN 'pv' THEN '浏览' WHEN 'cart' THEN '加购'
      WHEN 'fav' THEN '收藏' WHEN 'buy' THEN '购买' ELSE behavior_type END AS description FROM raw_beh""")
    o["popularity_level"] = with_(scored, f"""SELECT window_start, user_id, item_id, round({rates}, 9) AS score, {level(rates)} AS level FROM scored""")
    o["category_match"] = with_(base(), "SELECT id, CAST(category_id = high_freq_category AS INT) AS category_match FROM beh JOIN uf USING (user_id)")
    o["clip_pv"] = with_(BEH, "SELECT user_id, category_id, least(count(*), 20) AS clipped FROM beh GROUP BY ALL")
    o["clamp_probability"] = with_(base(), "SELECT user_id, greatest(0.0, least(1.0, buy_rate)) AS p FROM uf")

    # joins
    cold = ",".join([HALVES, uf("uf0", "history"), rw, itf()]) + ", uf AS (SELECT * FROM uf0 WHERE buy_count > 2),"
    joined = f"SELECT {win_cols}, buy_rate, active_score, high_freq_category, category_match FROM scored"
    o["join_user_features"] = with_(cold + enriched(), joined)
    o["join_user_features_salted"] = o["join_user_features"]
    o["join_item_popularity"] = with_(
        ",".join([BEH, itf("itf0"), rw, uf()]) + ", itf AS (SELECT * FROM itf0 WHERE buy_count > 12)," + enriched(),
        f"SELECT {win_cols}, popularity_score FROM scored")
    o["join_training_samples"] = with_(base("orders"), f"""SELECT b.id, {TYPED.replace('category_id', 'b.category_id')},
      buy_rate, active_score, high_freq_category, itf.category_id AS item_category
      FROM beh b JOIN uf USING (user_id) JOIN itf USING (item_id)""")
    o["join_exclude_cold_users"] = with_(",".join([HALVES, uf(src="history")]), """SELECT id, user_id, buy_rate, active_score,
      high_freq_category FROM test JOIN uf USING (user_id) WHERE buy_count > 2""")
    o["count_cold_rows"] = with_(",".join([HALVES, uf(src="history")]), """SELECT count(*) AS excluded_count FROM test
      WHERE user_id NOT IN (SELECT user_id FROM uf WHERE buy_count > 2)""")
    o["join_pairs_interactions"] = with_(HALVES + "," + PAST, """SELECT user_id, item_id, coalesce(pv_count_5min, 0) AS pv_count_5min,
      coalesce(is_cart_or_fav, 0) AS is_cart_or_fav FROM (SELECT DISTINCT user_id, item_id FROM test) LEFT JOIN past USING (user_id, item_id)""")
    o["join_rec_then_behavior"] = with_(recs(), """SELECT user_id, item_id, behavior_type, b.create_time AS behavior_at,
      r.create_time AS rec_time FROM recs r JOIN beh b USING (user_id, item_id) WHERE b.create_time > r.create_time""")
    for key, kind in (("semi_rec_viewed", "pv"), ("semi_rec_bought", "buy")):
        o[key] = with_(recs(), f"""SELECT user_id, item_id, rank_no FROM recs r WHERE EXISTS (SELECT 1 FROM beh b
          WHERE b.user_id = r.user_id AND b.item_id = r.item_id AND behavior_type = '{kind}')""")
    o["join_before_after"] = with_(recs() + """,
      hits AS (SELECT b.create_time > r.create_time AS later FROM recs r JOIN beh b USING (user_id, item_id))""",
      """SELECT count(*) AS matches, count(*) FILTER (WHERE NOT later) AS before_count, count(*) FILTER (WHERE later) AS after_count,
        round(count(*) FILTER (WHERE NOT later) * 100.0 / count(*), 9) AS before_pct,
        round(count(*) FILTER (WHERE later) * 100.0 / count(*), 9) AS after_pct FROM hits""")

    # aggregates
    for source, tail in (("events", ""), ("orders", "_orders")):
        src = SOURCE[source]
        o["agg_user_behavior_counts" + tail] = with_(src, f"SELECT user_id, {counts()} FROM beh GROUP BY user_id")
        o["agg_item_behavior_counts" + tail] = with_(
            src, f"SELECT item_id, max(category_id) AS category_id, {counts('pv buy')} FROM beh GROUP BY item_id")
        o["user_features" + tail] = with_(base(source), "SELECT * FROM uf")
        o["item_features" + tail] = with_(base(source), "SELECT * FROM itf")
        o["user_high_freq_category" + tail] = with_(base(source), "SELECT user_id, high_freq_category AS category_id FROM uf")
        o["agg_training_samples" + tail] = with_(sampled(source), f"SELECT {SAMPLE_COLS} FROM samples")
        o["topk_per_user" + tail] = with_(recs(source), f"SELECT {REC_COLS} FROM recs")
        four = f"(SELECT {', '.join(f'''count(*) FILTER (WHERE behavior_type = '{k}') AS {k}''' for k in ('pv', 'cart', 'fav', 'buy'))} FROM beh)"
        o["behavior_distribution" + tail] = with_(src, f"SELECT * FROM {four}")

        def pct(n: str, d: str) -> str:
            return f"CASE WHEN pv > 0 AND {d} > 0 THEN ((20000 * {n} + {d}) // (2 * {d})) / 100.0 ELSE 0.0 END"

        o["behavior_funnel" + tail] = with_(src, f"""SELECT *, {pct('cart', 'pv')} AS pv_to_cart, {pct('fav', 'cart')} AS cart_to_fav,
          {pct('buy', 'fav')} AS fav_to_buy, {pct('buy', 'pv')} AS pv_to_buy FROM {four}""")
    o["behavior_share"] = with_(BEH, """SELECT behavior_type, cnt, ((20000 * cnt + total) // (2 * total)) / 100.0 AS share_pct FROM
      (SELECT behavior_type, count(*) AS cnt, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM beh GROUP BY behavior_type)""")
    o["behavior_type_counts"] = with_(EVENTS, "SELECT behavior_type, count(*) AS cnt FROM raw_beh GROUP BY behavior_type")
    o["avg_user_profile"] = with_(base(), f"SELECT {PROFILE} FROM uf")
    o["user_feature_summary"] = with_(base("orders"), f"SELECT count(*) AS total_users, {PROFILE} FROM uf")
    o["prediction_stats"] = with_(recs(), """SELECT (SELECT count(*) FROM recs) AS recommend,
      greatest((SELECT count(*) FROM itf) - (SELECT count(*) FROM recs), 0) AS not_recommend""")
    o["recommend_count_trend"] = with_(recs(size=30, slide=10), f"""SELECT strftime(make_timestamp(create_time), '%Y-%m-%d %H:%M') AS minute,
      count(*) AS cnt FROM recs WHERE create_time {BETWEEN} GROUP BY 1""")
    o["agg_interactions"] = with_(BEH + ", history AS (SELECT * FROM beh)," + PAST, "SELECT * FROM past")
    o["hot_items_two_phase"] = o["hot_items_unsalted"] = hot(300, 60)
    o["hot_items_two_phase_day"] = hot(REC_SIZE, REC_SLIDE)
    o["hot_items_two_phase_orders"] = hot(ORDER_SIZE, ORDER_SLIDE, "orders")
    o["dataset_profile"] = with_(ORD, """SELECT count(*) AS row_count, count(*) FILTER (WHERE behavior_type = 'buy') AS positive_count,
      count(DISTINCT user_id) AS user_count, count(DISTINCT item_id) AS item_count FROM beh""")
    o["interaction_coverage"] = with_(HALVES + "," + PAST + """,
      p AS (SELECT user_id, item_id, coalesce(pv_count_5min, 0) AS c, coalesce(is_cart_or_fav, 0) AS f
            FROM (SELECT DISTINCT user_id, item_id FROM test) LEFT JOIN past USING (user_id, item_id))""",
      """SELECT count(*) AS pair_count, count(*) FILTER (WHERE c > 0) AS has_interaction,
        round(count(*) FILTER (WHERE c > 0) * 100.0 / count(*), 9) AS coverage_pct,
        round(CAST(sum(c) AS DOUBLE) / count(*), 9) AS mean_pv_count, round(CAST(sum(f) AS DOUBLE) * 100.0 / count(*), 9) AS cart_or_fav_pct FROM p""")
    o["score_summary"] = with_(OFFLINE, """SELECT round(min(predict_score), 9) AS min_score, round(max(predict_score), 9) AS max_score,
      round(avg(predict_score), 9) AS mean_score FROM off""")
    o["ctr_cvr_after_rec"] = with_(recs(), "").rstrip() + ctr()
    o["ctr_cvr_after_rec_orders"] = with_(recs("orders"), "").rstrip() + ctr()
    o["ctr_cvr_naive"] = with_(recs(), "").rstrip() + ctr(later="")
    o["evaluate_online"] = with_(recs(), "").rstrip() + ctr(f"r.create_time {BETWEEN}", f"b.create_time {BETWEEN}")
    purchases = "(SELECT value AS v, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events)"
    o["pr_auc_average_precision"] = with_(ap(purchases, "v", "y"), AP_OUT)
    o["precision_recall_points"] = with_(ap(purchases, "v", "y"), "SELECT round(s, 9) AS s, n, pos, cum_n, cum_pos FROM points")
    o["evaluate_offline"] = with_(OFFLINE + "," + ap("off", "predict_score", "label"), AP_OUT)
    o["classification_report"] = with_(OFFLINE + """,
      c AS (SELECT label AS y, CAST(predict_score > 0.25 AS INT) AS p FROM off),
      k AS (SELECT x AS label, (SELECT count(*) FROM c WHERE y = x AND p = x) AS tp, (SELECT count(*) FROM c WHERE y = x) AS support,
                   (SELECT count(*) FROM c WHERE p = x) AS predicted FROM (VALUES (0), (1)) t(x))""",
      """SELECT label, round(coalesce(tp / CAST(nullif(predicted, 0) AS DOUBLE), 0), 9) AS precision,
        round(coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0), 9) AS recall,
        round(coalesce(2 * tp / CAST(nullif(support + predicted, 0) AS DOUBLE), 0), 9) AS f1, support FROM k""")

    # ranking and look-ups
    o["serving_top50"] = with_(scored + "," + topk(50, rank="serving_rank"), """SELECT user_id, item_id, round(predict_score, 9) AS predict_score,
      round(fs, 12) AS final_score, serving_rank FROM recs""")
    lists = "user_id, rank_no, item_id, round(fs, 12) AS final_score, round(predict_score, 9) AS predict_score"
    o["latest_recommendations"] = with_(recs(), f"SELECT {lists}, {level('fs')} AS popularity FROM recs")
    o["latest_recommendations_fallback"] = with_(
        recs(), f"SELECT {lists}, CASE WHEN user_id % 2 = 0 THEN {level('fs')} ELSE {level('popularity_score')} END AS popularity FROM recs")
    o["latest_recommendations_by_rank"] = with_(
        recs(), f"SELECT {lists}, {level('popularity_score')} AS popularity FROM recs WHERE user_id = {ONE_USER}")
    o["top10_items"] = with_(
        FEED + "," + parsed() + f", beh AS ({good})," + itf(),
        "SELECT item_id, popularity_score, pv_count FROM itf ORDER BY popularity_score DESC, item_id LIMIT 10")
    items = "SELECT item_id, category_id, pv_count FROM itf {} ORDER BY pv_count DESC, item_id LIMIT 50"
    o["item_list"] = with_(base(), items.format(""))
    o["item_list_keyword"] = with_(base("orders"), items.format("WHERE CAST(item_id AS VARCHAR) LIKE '%7%'"))
    o["recent_behaviors"] = with_(BEH, f"""SELECT id, user_id, item_id, category_id, behavior_type, create_time,
      strftime(make_timestamp(create_time), '%Y-%m-%d %H:%M:%S') AS behavior_time_str,
      CASE behavior_type WHEN 'pv' THEN '浏览' WHEN 'cart' THEN '加购' WHEN 'fav' THEN '收藏' ELSE '购买' END AS behavior_type_desc
      FROM beh WHERE user_id = {ONE_USER} ORDER BY create_time DESC, id DESC LIMIT 20""")
    o["category_list"] = with_(base(), "SELECT DISTINCT category_id FROM itf")
    o["user_list"] = with_(base(), "SELECT DISTINCT user_id FROM beh")
    zeros = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("pv_count", "buy_count", "cart_count", "fav_count", "buy_rate", "active_score"))
    o["user_profile"] = with_(base(), f"SELECT c_custkey AS user_id, {zeros} FROM customer LEFT JOIN uf ON c_custkey = user_id")
    met = recs() + METRICS
    newest = "SELECT id, pr_auc, metric_end_time AS create_time FROM metrics WHERE pr_auc <> -1 ORDER BY metric_end_time DESC, id DESC LIMIT {}"
    o["pr_auc_latest"] = with_(met, newest.format(1))
    o["pr_auc_trend"] = with_(met, newest.format(6))
    trend = f"""SELECT id, strftime(make_timestamp(metric_end_time), '%Y-%m-%d %H:%M:%S') AS time, ctr, cvr FROM metrics
      WHERE metric_start_time >= {us(RANGE_START)} AND metric_end_time <= {us(RANGE_END)}"""
    o["ctr_cvr_trend"] = with_(met, trend + " AND ctr <> -1")
    o["ctr_cvr_trend_with_sentinel"] = with_(met, trend)
    one_day = f"{us('2024-01-10 00:00:00')}", f"{us('2024-01-10 23:59:59')}"
    o["ctr_cvr_lookup"] = with_(met + f""",
      found AS (SELECT ctr, cvr FROM metrics WHERE metric_start_time = {one_day[0]} AND metric_end_time = {one_day[1]} ORDER BY id DESC LIMIT 1)""",
      f"""SELECT coalesce((SELECT ctr FROM found), 0.0) AS ctr, coalesce((SELECT cvr FROM found), 0.0) AS cvr,
        (SELECT count(*) FROM recs WHERE create_time BETWEEN {one_day[0]} AND {one_day[1]}) AS recommend_count,
        '2024-01-10 00:00:00' AS start_time, '2024-01-10 23:59:59' AS end_time""")

    # set operations and sampling
    o["distinct_pairs"] = with_(ORD, "SELECT DISTINCT user_id, item_id FROM beh")
    o["union_pos_neg"] = with_(sampled(), f"SELECT {SAMPLE_COLS} FROM samples")
    o["downsample_negatives"] = with_(
        sampled() + "," + hexrank("buy_label"),
        f"SELECT {SAMPLE_COLS} FROM ranked WHERE buy_label = 1 OR rn <= 2 * (SELECT count(*) FROM samples WHERE buy_label = 1)")
    o["train_test_split"] = with_(
        sampled() + "," + hexrank("TRUE"),
        "SELECT user_id, item_id, rn <= ceil((SELECT count(*) FROM samples) * CAST(0.2 AS DOUBLE)) AS is_test FROM ranked")
    for name in ("train_gbt", "train_rf", "train_logreg", "train_fallback_tree", "select_champion"):
        o[name] = with_(
            sampled() + "," + hexrank("TRUE"),
            """SELECT user_id, item_id, buy_label, TRUE AS in_range, TRUE AS beats_chance FROM ranked
            WHERE rn <= ceil((SELECT count(*) FROM samples) * CAST(0.2 AS DOUBLE))""")
    grid = [("GradientBoosting", {"depth": x, "rate": r, "trees": t}) for x in TR.GBT_DEPTH for r in TR.GBT_RATE for t in TR.GBT_TREES]
    grid += [("RandomForest", {"depth": x, "trees": t}) for x in TR.FOREST_DEPTH for t in TR.FOREST_TREES]
    grid += [("LogisticRegression", {"c": c}) for c in TR.LOGREG_C]
    o["grid_search_cv"] = " UNION ALL ".join(
        f"SELECT '{name}' AS family, '{json.dumps(params, sort_keys=True)}' AS params, {TR.FOLDS}::BIGINT AS folds, TRUE AS in_range, TRUE AS place_holds"
        for name, params in grid)
    o["rank_models"] = "SELECT unnest([1, 2, 3])::INT AS place, TRUE AS best_of_family, TRUE AS in_order"
    o["score_batch_champion"] = with_(OFFLINE, "SELECT user_id, item_id, id, label, TRUE AS in_range, TRUE AS as_fitted FROM off")
    o["with_folds"] = with_(sampled(), """SELECT user_id, item_id,
      CAST(('0x' || left(md5(concat_ws('|', 43, user_id, item_id)), 8)) AS BIGINT) % 3 AS fold FROM samples""")
    o["class_balance_weight"] = with_(sampled(), """SELECT user_id, item_id, buy_label,
      round(CAST((SELECT count(*) FROM samples) AS DOUBLE) / (2 * count(*) OVER (PARTITION BY buy_label)), 9) AS weight FROM samples""")
    o["impute_zero"] = o["join_pairs_interactions"]
    o["dedupe_behavior"] = with_(BEH, """SELECT min(id) AS id, user_id, item_id, min_by(category_id, id) AS category_id, behavior_type,
      behavior_time, min_by(create_time, id) AS create_time FROM beh GROUP BY user_id, item_id, behavior_type, behavior_time""")

    # scalars, scoring
    o["final_score"] = with_(scored, """SELECT window_start, user_id, item_id, round(predict_score, 9) AS predict_score, popularity_score,
      round(fs, 12) AS final_score FROM scored""")
    o["behavior_ts"] = with_(BEH, "SELECT id, behavior_time * 1000000 AS event_time FROM beh")
    o["build_training_set"] = with_(sampled("events"), f"SELECT {SAMPLE_COLS} FROM samples")
    o["score_tree_ensemble"] = with_(sampled(), f"SELECT user_id, item_id, round({predict()}, 9) AS predict_score FROM samples")
    for name, model in LARGE.items():
        o[f"score_tree_ensemble_{name}"] = with_(sampled(), predict_large(model))
    o["score_batch"] = with_(OFFLINE, """SELECT user_id, item_id, id, label, buy_rate, active_score, category_match, pv_count_5min,
      is_cart_or_fav, round(predict_score, 9) AS predict_score FROM off""")

    # sinks
    o["sink_append_behavior"] = with_(BEH, "SELECT * FROM beh")
    o["sink_upsert_recommendations"] = o["sink_upsert_levelled"] = o["merge_recommendations"] = upsert(False)
    o["sink_upsert_recommendations_pruned"] = upsert(True)
    o["sink_serving_scores"] = with_(scored + "," + topk(50, rank="serving_rank"), f"""SELECT user_id, item_id,
      round(predict_score, 9) AS predict_score, round(fs, 12) AS final_score, serving_rank, {us(AS_OF)} AS updated_at FROM recs""")
    o["sink_replace_user_features"] = with_(base(), f"SELECT *, {us(AS_OF)} AS update_time FROM uf")
    o["sink_replace_item_features"] = with_(base(), f"SELECT *, {us(AS_OF)} AS update_time FROM itf")
    o["refresh_features"] = with_(base(), """SELECT id, buy_rate, active_score, high_freq_category, itf.category_id AS item_category
      FROM beh JOIN uf USING (user_id) JOIN itf USING (item_id)""")
    online = ctr(f"r.create_time {BETWEEN}", f"b.create_time {BETWEEN}").split("\nSELECT")[0]
    offline_ap = OFFLINE.replace(BEH, "").replace("\nuf AS", "\nufh AS").replace("JOIN uf USING", "JOIN ufh USING")
    o["sink_eval_metrics"] = with_(
        recs() + offline_ap + "," + ap("off", "predict_score", "label") + f", area AS ({AP_OUT})" + online + f", rates AS ({CTR})",
        f"""SELECT 1 AS id, {us(AS_OF)} AS metric_start_time, {us(AS_OF)} AS metric_end_time, round(pr_auc, 4) AS pr_auc,
          -1.0 AS ctr, -1.0 AS cvr, -1 AS recommend_count, {us(AS_OF)} AS create_time FROM area
        UNION ALL SELECT 2, {us(RANGE_START)}, {us(RANGE_END)}, -1.0, round(ctr, 4), round(cvr, 4), recommend_count, {us(AS_OF)} FROM rates""")
    o["sink_rebuild_table"] = with_(BEH, "SELECT count(*) AS expected, count(*) AS loaded, 0 AS failed FROM beh")
    o["expire_serving"] = with_(BEH, f"""SELECT user_id, item_id, max(create_time) AS updated_at FROM beh
      WHERE user_id IN (SELECT user_id FROM beh GROUP BY user_id HAVING max(create_time) > {us('2024-01-30 12:00:00')} - CAST(23 AS BIGINT) * 3600 * 1000000)
      GROUP BY user_id, item_id""")
    o["export_features_csv"] = with_(HALVES + "," + PAST, "SELECT * FROM past")

    # windows and streams
    o["win_sliding_features"] = with_(BEH + "," + win(30, 10), "SELECT * FROM win")
    o["win_hot_items"] = hot(300, 60, ctes=FEED + "," + parsed() + f", beh AS ({good})")
    o["win_sliding_features_day"] = with_(BEH + "," + rw, "SELECT * FROM win")
    o["stream_land_behavior"] = with_(
        LINES + "," + parsed("ev_lines"),
        f"SELECT {TYPED}, strftime(make_timestamp(behavior_time * 1000000), '%Y-%m-%d') AS day FROM parsed WHERE reject_reason IS NULL")
    o["stream_clean_metrics"] = with_(
        LINES + "," + parsed("ev_lines"), "SELECT count(*) AS total_count, count(reject_reason) AS filtered_count FROM parsed")
    o["stream_win_sliding_features"] = with_(BEH + "," + rw, f"SELECT * FROM win WHERE {CLOSED}")
    o["stream_hot_items"] = o["stream_console"] = hot(REC_SIZE, REC_SLIDE, closed=True)
    o["stream_user_features"], o["stream_item_features"] = o["user_features"], o["item_features"]
    o["stream_user_features_levelled"], o["stream_item_features_levelled"] = o["user_features"], o["item_features"]
    o["stream_dedupe_behavior"] = with_(BEH, f"SELECT DISTINCT {TYPED}, behavior_time * 1000000 AS event_time FROM beh")
    closed = f",closed AS (SELECT * FROM win WHERE {CLOSED}),"
    shut = ",".join([base(), rw]) + closed + enriched("closed")
    o["stream_score"] = with_(shut, """SELECT window_start, user_id, item_id, round(predict_score, 9) AS predict_score, popularity_score,
      round(fs, 12) AS final_score FROM scored""")
    o["stream_topk"] = with_(shut + "," + topk(10), f"SELECT {REC_COLS} FROM recs")
    o["stateful_topk"] = o["stateful_topk_salted"] = with_(scored + "," + topk(10), f"SELECT {REC_COLS.replace(', create_time', '')} FROM recs")
    o["late_data"] = with_(
        HALVES + "," + win(REC_SIZE, REC_SLIDE, "win", "test"), f"SELECT * FROM win WHERE {CLOSED}")
    o["late_data_reported"] = with_(
        HALVES + """,
once AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, behavior_type, behavior_time ORDER BY id) AS k
  FROM test) WHERE k = 1),""" + win(REC_SIZE, REC_SLIDE, "win", "once"),
        f"SELECT *, (SELECT count(*) FROM history) AS late_rows FROM win WHERE {CLOSED}")
    o["stream_ctr_cvr_after_rec"] = with_(recs(), "").rstrip() + ctr(
        later=f"AND b.create_time > r.create_time AND b.create_time <= r.create_time + {REC_BOUND_DAYS * 86400} * CAST(1000000 AS BIGINT)")
    steps = "s0 AS (SELECT NULL::BIGINT AS user_id, NULL::BIGINT AS item_id, NULL::DOUBLE AS p, NULL::DOUBLE AS f WHERE FALSE)"
    for n in range(ARRIVALS):
        steps += f""",
b{n} AS (SELECT user_id, item_id, arg_max(predict_score, fs) AS p, max(fs) AS f FROM scored
  WHERE (window_end // 1000000 // {REC_SLIDE}) % {ARRIVALS} = {n} GROUP BY user_id, item_id),
s{n + 1} AS (SELECT user_id, item_id, p, f FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(f, 12) DESC, item_id) AS k FROM
  (SELECT * FROM s{n} WHERE (user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM b{n}) UNION ALL SELECT * FROM b{n})) WHERE k <= 50)"""
    o["stream_serving"] = with_(scored + "," + steps, f"""SELECT user_id, item_id, round(p, 9) AS predict_score, round(f, 12) AS final_score,
      row_number() OVER (PARTITION BY user_id ORDER BY round(f, 12) DESC, item_id) AS serving_rank, {us(AS_OF)} AS updated_at FROM s{ARRIVALS}""")
    o["stream_land_once"] = with_(BEH, f"SELECT DISTINCT {TYPED} FROM beh")
    return o


ORACLE = build()
