"""Number expressions: exact HALF_UP ratios, clamps and the blended score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathlark import schemas as S


def half_up_ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """num/den rounded HALF_UP, exact for non-negative integers; 0 when den is 0.

    Integer division does the rounding, so no intermediate decimal is rounded first.
    """
    scale = 10**digits
    n, d = num.cast("bigint"), den.cast("bigint")
    units = F.call_function("div", n * F.lit(2 * scale) + d, d * F.lit(2))
    exact = units.cast("decimal(18,0)") / F.lit(scale).cast("decimal(18,0)")
    return F.when(d > 0, exact.cast(f"decimal(18,{digits})")).otherwise(
        F.lit(0).cast(f"decimal(18,{digits})")
    )


def safe_ratio(num: Column, den: Column) -> Column:
    """Plain double ratio, 0 for an empty denominator."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def round4(value: Column) -> Column:
    return F.round(value, 4)


def clip_pv(count: Column, cap: int = S.PV_CAP) -> Column:
    return F.least(count, F.lit(cap))


def clamp_probability(p: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def popularity(pv: Column, buy: Column) -> Column:
    """0.3·pv + 0.7·buy in tenths, hence exact; not bounded above."""
    tenths = pv.cast("bigint") * 3 + buy.cast("bigint") * 7
    return (tenths.cast("decimal(18,0)") / F.lit(10).cast("decimal(18,0)")).cast(S.SCORE4)


def active_score(total: Column) -> Column:
    """total/100, at most 1."""
    capped = F.least(total.cast("bigint"), F.lit(100))
    return (capped.cast("decimal(18,0)") / F.lit(100).cast("decimal(18,0)")).cast(S.SCORE4)


def final_score(predict: Column, popular: Column) -> Column:
    """0.7·predict + 0.3·popularity, 12 decimals HALF_UP."""
    p = predict.cast("decimal(27,24)") * F.lit(S.PREDICT_WEIGHT).cast("decimal(2,1)")
    q = popular.cast(S.SCORE4) * F.lit(S.POPULARITY_WEIGHT).cast("decimal(2,1)")
    return F.round(p + q, 12).cast(S.SCORE12)


def behavior_ts(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def epoch_of_ntz(ntz: Column) -> Column:
    """Epoch seconds of a zone-less stamp read as UTC, whatever the session zone is."""
    origin = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_diff("SECOND", origin, ntz)
