"""Running top-k per user with keyed state and a timer, as an alternative to merging tables.

State is one small list of at most k entries per user (see ``merge_topk`` for why that is exact),
so a user with a third of all rows costs state like any other. A list is one value: it is read and, if it changed,
written as a whole, and a batch goes through a key's rows as they come, without a frame for each key. Only with a
time to live are entries kept one by one, as each is forgotten by its own time.

Such a user is still one task's key. ``salted_topk`` deals each user's items to ``salts`` partial lists by a hash
of the item, so that an item's scores meet in one of them; ``merged_lists`` ranks a user's partial lists, at most
k rows each, as table rows. Before either shuffle a task reduces its rows, batch by batch, to the best k items of
a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pathlark import schemas as S
from pathlark.operators.ranking import top_per_user

OUTPUT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("predict_score", T.DoubleType()),
    T.StructField("popularity_score", S.SCORE4),
    T.StructField("final_score", S.SCORE12),
    T.StructField("rank_no", T.IntegerType()),
])
_ENTRY = T.StructType([
    T.StructField("predict_score", T.DoubleType()),
    T.StructField("popularity_score", S.SCORE4),
    T.StructField("final_score", S.SCORE12),
])
_KEY = T.StructType([T.StructField("item_id", T.LongType())])
_LIST = T.StructType([T.StructField("entries", T.ArrayType(T.StructType([*_KEY.fields, *_ENTRY.fields])))])
_DUE = T.StructType([T.StructField("due", T.LongType())])


def fold(best: dict[int, tuple], rows, k: int) -> dict[int, tuple]:
    """Best entry per item, cut to the k highest final scores, ties by item id.

    Of equal final scores the higher predict score counts, as in the batch ranking.
    """
    for item, predict, popular, final in rows:
        old = best.get(item)
        if old is None or (final, predict, popular) > (old[2], old[0], old[1]):
            best[item] = (predict, popular, final)
    keep = sorted(best, key=lambda i: (-best[i][2], i))[:k]
    return {i: best[i] for i in keep}


def _order(entry: tuple) -> tuple:
    """By final, predict and popularity score; a predict score that is none or no number counts as the highest."""
    predict, popular, final = entry
    return (final, True, 0, popular) if predict != predict else (final, False, predict, popular)


class TopKProcessor(StatefulProcessor):
    """Folds scores into a user's list; a processing-time timer emits it every ``flush_ms``.

    With ``flush_ms=0`` the list is emitted after each micro-batch that touched the user, which
    needs no clock and gives the same lists on every replay. ``ttl_ms`` forgets entries that have
    not been written for that long; by default nothing is forgotten.
    """

    def __init__(self, k: int = S.TOP_K, flush_ms: int = 5000, ttl_ms: int | None = None, keys: tuple[str, ...] = ("user_id",)) -> None:
        self.k, self.flush_ms, self.ttl_ms = k, flush_ms, ttl_ms
        self.row = Row(*keys, *OUTPUT.fieldNames()[1:])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getMapState("best", _KEY, _ENTRY, self.ttl_ms) if self.ttl_ms else handle.getValueState("best", _LIST)
        self.due = handle.getValueState("due", _DUE)

    def _load(self) -> dict[int, tuple]:
        if self.ttl_ms:
            return {key[0]: tuple(value) for key, value in self.best.iterator()}
        held = self.best.get()
        return {item: tuple(entry) for item, *entry in held[0]} if held else {}

    def _save(self, before: dict[int, tuple], best: dict[int, tuple]) -> None:
        if not self.ttl_ms:
            if before != best:
                self.best.update(([(i, *entry) for i, entry in best.items()],))
            return
        for item in before.keys() - best.keys():
            self.best.removeKey((item,))
        for item, entry in best.items():
            if before.get(item) != entry:
                self.best.updateValue((item,), entry)

    def _emit(self, key: tuple, best: dict[int, tuple]) -> Iterator[Row]:
        for n, i in enumerate(sorted(best, key=lambda i: (-best[i][2], i)), 1):
            predict, popular, final = best[i]
            yield self.row(*key, i, None if predict != predict else predict, popular, final, n)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, tuple] = {}
        for row in rows:
            predict = float("nan") if row["predict_score"] is None else row["predict_score"]
            entry = (predict, row["popularity_score"], row["final_score"])
            old = new.get(row["item_id"])
            if old is None or _order(entry) >= _order(old):
                new[row["item_id"]] = entry
        before = self._load()
        best = fold(before.copy(), ((i, *entry) for i, entry in new.items()), self.k)
        self._save(before, best)
        if not self.flush_ms:
            yield from self._emit(key, best)
        elif not self.due.exists():
            self._arm(timerValues.getCurrentProcessingTimeInMs())

    def _arm(self, now: int) -> None:
        due = now + self.flush_ms
        self.handle.registerTimer(due)
        self.due.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = self._load()
        if best:
            self._arm(timerValues.getCurrentProcessingTimeInMs())
            yield from self._emit(key, best)
        else:
            self.due.clear()

    def close(self) -> None:
        pass


_SCORES = ["user_id", "item_id", "predict_score", "popularity_score", "final_score"]


def best_of_batches(scored: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Per Arrow batch and key the best row of each of the k best items: whatever else is in it can be on no list."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            part = part.sort_values(["final_score", "predict_score", "popularity_score"]).drop_duplicates([*keys, "item_id"], keep="last")
            part = part.sort_values(["final_score", "item_id"], ascending=[False, True], kind="stable")
            yield part.groupby(keys, sort=False).head(k)

    return scored.mapInPandas(run, scored.schema)


def stateful_topk(scored: DataFrame, k: int = S.TOP_K, flush_ms: int = 5000, ttl_ms: int | None = None) -> DataFrame:
    """Ranked lists from a stream of scores. Needs the RocksDB state store."""
    return best_of_batches(scored.select(*_SCORES), k, ["user_id"]).groupBy("user_id").transformWithState(
        statefulProcessor=TopKProcessor(k, flush_ms, ttl_ms),
        outputStructType=OUTPUT,
        outputMode="Update",
        timeMode="ProcessingTime" if flush_ms or ttl_ms else "None",
    )


def salted_topk(scored: DataFrame, k: int = S.TOP_K, salts: int = 16, flush_ms: int = 5000, ttl_ms: int | None = None) -> DataFrame:
    """Partial lists, ``salts`` for each user at most, with a column ``salt``."""
    salt = F.pmod(F.xxhash64("item_id"), F.lit(salts)).cast("int")
    keys = ["user_id", "salt"]
    output = T.StructType([OUTPUT["user_id"], T.StructField("salt", T.IntegerType()), *OUTPUT.fields[1:]])
    return best_of_batches(scored.select(*_SCORES, salt.alias("salt")), k, keys).groupBy(*keys).transformWithState(
        statefulProcessor=TopKProcessor(k, flush_ms, ttl_ms, tuple(keys)),
        outputStructType=output,
        outputMode="Update",
        timeMode="ProcessingTime" if flush_ms or ttl_ms else "None",
    )


def merged_lists(log: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """Each user's list from a log of partial lists with ``batch_id``: the newest of each, ranked together."""
    newest = log.groupBy("user_id", "salt").agg(F.max("batch_id").alias("batch_id"))
    parts = log.join(newest, ["user_id", "salt", "batch_id"], "left_semi").drop("batch_id", "salt", "rank_no")
    return top_per_user(parts, k)
