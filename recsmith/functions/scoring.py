"""Scalar scoring expressions (FN-01..FN-22).  All are Column expressions that
stay inside whole-stage codegen: no Python UDFs.

Weight vectors are literal ``array<double>`` columns (a few hundred values),
feature vectors are ``array<int>`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith import params as P


FIXED_SCALE = float(1 << 30)  # sums of scores are taken over whole multiples of 1 / FIXED_SCALE


WHOLE_BELOW = float(1 << 52)  # doubles below it have halves, so their whole parts and rests are exact


def whole_units(y: Column) -> Column:
    """``round(y)`` (half away from zero) of doubles below ``WHOLE_BELOW``, as a double: the same number without the decimal
    text that ``round`` makes of each double."""
    a = F.abs(y)
    return F.signum(y) * (F.floor(a).cast("double") + F.when(a - F.floor(a).cast("double") >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


def fixed(x: Column) -> Column:
    """``x`` in whole units of 1 / FIXED_SCALE."""
    y = x * FIXED_SCALE
    return F.when(F.abs(y) < WHOLE_BELOW, whole_units(y).cast("long").cast("decimal(28,0)")).otherwise(F.round(y).cast("decimal(28,0)"))


def fixed_sum(x: Column) -> Column:
    """Sum that does not depend on the order of the rows: equal addends in any order (and in
    any number of partitions) give the same double, so ties stay ties."""
    return F.sum(fixed(x)).cast("double") / FIXED_SCALE


def sigmoid(x: Column) -> Column:
    """FN-01: 1 / (1 + e^-x)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def weights_lit(values) -> Column:
    """A weight vector as a column: from numbers, or from a one-row table with the vector ``w`` (read
    inside the plan, as a scalar subquery)."""
    if isinstance(values, Column):
        return values
    if isinstance(values, DataFrame):
        return values.select("w").scalar()
    return F.array(*[F.lit(float(v)) for v in values])


def dot(w: Column, f: Column, offset: int = 0) -> Column:
    """sum_j w[offset + j] * f[j] over the length of ``f`` (0 for a null ``f``).

    ``zip_with`` pads with nulls, so the weight slice is cut to the feature length.
    """
    n = F.size(f)
    ws = F.slice(w, offset + 1, n)
    prod = F.zip_with(ws, f, lambda a, b: a * b.cast("double"))
    s = F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    return F.when(f.isNull() | (n <= 0), F.lit(0.0)).otherwise(s)


def lr_parts(user_part: Column, item_part: Column, *more: Column,
             missing_item: float = P.MISSING_ITEM_SCORE) -> Column:
    """FN-02..04 from the two halves of the dot product, each computed once per user and once per item:
    sigmoid(user part + item part + more); a null item part (no features) -> ``missing_item``."""
    z = user_part + item_part
    for x in more:
        z = z + x
    return F.when(item_part.isNull(), F.lit(missing_item)).otherwise(sigmoid(z))


def dense_parts(w: Column, user_part: Column, item_part: Column, item_width: Column, rate: Column, lan: Column,
                style: Column, default_width: int, user_width: int = P.USER_WIDTH, bias: float = 0.0) -> Column:
    """FN-05 / FN-06 over the FN-07 layout from the two halves: null parts count as zeros (of ``default_width``
    for the item); -1.0 where the layout's length differs from the weights'."""
    width = F.coalesce(item_width, F.lit(default_width))
    rest = [F.get(w, F.size(w) - k) for k in (3, 2, 1)]
    z = (F.coalesce(user_part, F.lit(0.0)) + F.coalesce(item_part, F.lit(0.0)) + rest[0] * rate + rest[1] * lan
         + rest[2] * style + F.lit(bias))
    return F.when(F.size(w) == user_width + width + 3, sigmoid(z)).otherwise(F.lit(-1.0))


def lr_user_item(w: Column, user_f: Column, item_f: Column, user_width: int = P.USER_WIDTH,
                 missing_item: float = P.MISSING_ITEM_SCORE) -> Column:
    """FN-02: sigmoid(user part + item part); no item features -> ``missing_item``."""
    item = F.when(item_f.isNotNull(), dot(w, item_f, user_width))
    return lr_parts(dot(w, user_f, 0), item, missing_item=missing_item)


def lr_promoted(w: Column, user_f: Column, item_f: Column, rate: Column, item_width: int,
                user_width: int = P.USER_WIDTH, missing_item: float = P.MISSING_ITEM_SCORE) -> Column:
    """FN-03: LR v1 + w[user_width + item_width] * promoted rate."""
    item = F.when(item_f.isNotNull(), dot(w, item_f, user_width))
    return lr_parts(dot(w, user_f, 0), item, w[user_width + item_width] * rate, missing_item=missing_item)


def lr_affinity(w: Column, user_f: Column, item_f: Column, rate: Column, lan: Column, style: Column,
                item_width: int, user_width: int = P.USER_WIDTH,
                missing_item: float = P.MISSING_ITEM_SCORE) -> Column:
    """FN-04: LR v2 + w[.. + 1] * language dot + w[.. + 2] * style dot."""
    b = user_width + item_width
    item = F.when(item_f.isNotNull(), dot(w, item_f, user_width))
    return lr_parts(dot(w, user_f, 0), item, w[b] * rate, w[b + 1] * lan, w[b + 2] * style, missing_item=missing_item)


def dense_lr(w: Column, f: Column, bias: Column | None = None) -> Column:
    """FN-05 / FN-06: sigmoid(w . f [+ b]); a length mismatch gives -1.0."""
    z = dot(w, f, 0)
    if bias is not None:
        z = z + bias
    return F.when(F.size(w) != F.size(f), F.lit(-1.0)).otherwise(sigmoid(z))


def assemble_features(user_f: Column, item_f: Column, rate: Column, lan: Column, style: Column,
                      item_width: int, user_width: int = P.USER_WIDTH) -> Column:
    """FN-07: [user (padded to user_width) | item (item_width) | rate | lan | style]; zeros for missing parts."""
    zeros_u = F.array_repeat(F.lit(0.0), user_width)
    u = F.coalesce(user_f.cast("array<double>"), zeros_u)
    u = F.slice(F.concat(u, zeros_u), 1, user_width)
    i = F.coalesce(item_f.cast("array<double>"), F.array_repeat(F.lit(0.0), item_width))
    return F.concat(u, i, F.array(rate.cast("double"), lan.cast("double"), style.cast("double")))


def impression_penalty(score: Column, visited_score: Column, mode: str = "constant") -> Column:
    """FN-08: items seen but not excluded are divided by 2.5 (``mode='cuberoot'``:
    by 2.5 * count^(1/3) with count = 1 - visited score)."""
    if mode == "cuberoot":
        decay = F.lit(P.IMPRESS_DECAY) * F.pow(F.lit(1) - visited_score, F.lit(1.0 / 3.0))
    else:
        decay = F.lit(P.IMPRESS_DECAY)
    return F.when(visited_score.isNotNull(), score / decay).otherwise(score)


def pay_weight(money: Column, click: Column, money_w: float, click_w: float) -> Column:
    """FN-09 input: money * mw + click * cw; missing or non-finite -> 0 (Q-06)."""
    pay = F.coalesce(money, F.lit(0.0)) * money_w + F.coalesce(click, F.lit(0.0)) * click_w
    finite = ~F.isnan(pay) & (F.abs(pay) != F.lit(float("inf")))
    return F.when(money.isNull() | click.isNull(), F.lit(0.0)).when(finite, pay).otherwise(F.lit(0.0))


def pay_boost(money: Column, click: Column, money_w: float, click_w: float, factor: float) -> Column:
    """FN-09: sigmoid(pay) * 2f - f."""
    return sigmoid(pay_weight(money, click, money_w, click_w)) * (2 * factor) - factor


def in_treatment(user: Column, divisor: int, remainder: int | None) -> Column:
    """FN-10: ``user % divisor == remainder`` (Java sign rule, same as Spark's %)."""
    if remainder is None:
        return F.lit(False)
    return (user % divisor) == remainder


def age_days(as_of_epoch: int, avg_pub_time: Column, default: int = P.DEFAULT_AGE_DAYS) -> Column:
    """FN-14 A: whole days since the average publish time (default 100)."""
    return F.coalesce(((F.lit(as_of_epoch) - avg_pub_time) / 86400).cast("long").cast("int"),
                      F.lit(default))


def pub_index(avg_pub_time: Column, default: int = 0) -> Column:
    """FN-14 B: int(avgPubTime / 1e6) (default 0)."""
    return F.coalesce((avg_pub_time / P.PUB_INDEX_DIV).cast("long").cast("int"), F.lit(default))


def freshness_a(score: Column, new_song_weight: Column, age: Column,
                max_age: int = P.FRESH_AGE_DAYS) -> Column:
    """FN-12: weight > 1 and age < 60 days -> score * weight."""
    return F.when((new_song_weight > 1) & (age < max_age), score * new_song_weight).otherwise(score)


def freshness_b(score: Column, new_song_weight: Column, pub: Column) -> Column:
    """FN-13: weight > 1 and ratio = pub / 1254 > 1 -> score * ratio * weight * 1.5."""
    ratio = pub / F.lit(P.FRESH_RATIO_DIV)
    return F.when((new_song_weight > 1) & pub.isNotNull() & (ratio > 1),
                  score * ratio * new_song_weight * P.FRESH_RATIO_MULT).otherwise(score)


def as_of_date(as_of) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d")).cast("date")


def midnight_threshold(as_of, days: int) -> Column:
    """FN-15: midnight of ``as_of`` minus ``days`` days; ``days <= 0`` -> epoch 0."""
    if days <= 0:
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    midnight = as_of_date(as_of).cast("timestamp_ntz")
    return midnight - F.expr(f"INTERVAL {int(days)} DAYS")


def half_up(x: Column, scale: int = 4) -> Column:
    """FN-16: HALF_UP rounding via decimal (exact on the decimal expansion)."""
    return F.round(x.cast("decimal(38,18)"), scale).cast("double")


def max_impress(as_of) -> Column:
    """FN-22 for a fixed run date."""
    return calendar_cap(as_of_date(as_of))


def calendar_cap(day: Column) -> Column:
    """FN-22: 4 when day-of-month % 3 == 1, else 2."""
    return F.when(F.dayofmonth(day) % 3 == 1, F.lit(4)).otherwise(F.lit(2))


def blended(recall: Column, model: Column, blend: float, treated: Column, boost: Column) -> Column:
    """FN-09 / FN-11: recall * blend + model score, plus the monetisation boost in the treatment arm."""
    return recall * blend + model + F.when(treated, boost).otherwise(F.lit(0.0))


def nonfinite_pay(money: Column, click: Column, money_w: float, click_w: float) -> Column:
    """Q-06 counter input: rows whose raw pay weight is NaN or infinite (scored as 0)."""
    pay = money * money_w + click * click_w
    return money.isNotNull() & click.isNotNull() & (F.isnan(pay) | (F.abs(pay) == F.lit(float("inf"))))
