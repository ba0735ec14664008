"""Recommend items by the user's tags (tag recall with damping -> quality /
age / seen / history / blocklist gates -> 30 per tag -> sum-merge -> freshness
and impression penalty -> per-reason and total caps -> arm-specific LR ->
adaptive quota interleave).

Items that no user may get leave the lists first, and the publishing time of an item comes to its list entries;
the rows of users and tags are written by user, so that expansion, merge, freshness, caps and quota run where they
lie if the heads of the lists can be broadcast.  Join strategies are left to the planner and AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.functions import scoring as S
from recsmith.operators import candidates as C
from recsmith.operators import features as X
from recsmith.operators import filters as FL
from recsmith.operators import recall as RC
from recsmith.operators import rerank as RR
from recsmith.operators.keyed import keyed_load
from recsmith.session import LazyInputs, Stages, materialise


@dataclass
class TagInputs(LazyInputs):
    active: DataFrame           # user, last_ts
    user_tag: DataFrame         # user, tag, pref, pos
    tag_item: DataFrame         # tag, item, quality, pos
    history: DataFrame          # user, packed
    quality: DataFrame          # item, score, create_days
    profile: DataFrame          # item, avg_pub_time
    user_max_age: DataFrame     # user, max_days
    blocklist: DataFrame        # item
    first_block: DataFrame      # rank, item
    visited: DataFrame          # user, item, score
    impressions: DataFrame      # user, item, dt
    new_song_weight: DataFrame  # user, new_song_weight
    item_feat: DataFrame        # item, bits
    user_feat: DataFrame        # user, feats
    rate: DataFrame             # item, src, rate
    user_aff: DataFrame         # user, kind, tag, ratio
    item_aff: DataFrame         # item, kind, tag, ratio


def damped_tags(inp: TagInputs, users: DataFrame) -> DataFrame:
    """FN-17: active users' tags; preference / 2000 for tags in yesterday's first 2."""
    ut = FL.only_active(inp.user_tag, users).where(F.col("tag") != "")
    ht = FL.history_first(inp.history).select("user", "tag").distinct().withColumn("_h", F.lit(True))
    j = ut.join(ht, ["user", "tag"], "left")
    pref = F.when(F.col("_h").isNotNull(), F.col("pref") / P.TAG_DAMPING).otherwise(F.col("pref"))
    return j.withColumn("pref", pref).drop("_h")


def capped_rows(inp: TagInputs, as_of, active_days: int, window, max_impress: int,
                  tag_cap: int = P.TAG_CAP_P3) -> DataFrame:
    """Eligible (user, tag, pref, tag_pos, item, quality, item_pos, avg_pub_time) rows within the cap per tag.

    User-independent gates (quality, blocklist) are applied to the tag lists first;
    the user x tag expansion is then pruned exactly to the first cap + E positions
    (E = the user's excluded pairs), counted over the entries within the user's age limit.
    """
    users = FL.active_users(inp.active, as_of, active_days)
    ut = damped_tags(inp, users)
    hist_items = FL.history_first(inp.history).select("user", "item")
    excl = FL.exclusion_pairs(FL.seen_pairs(inp.visited, max_impress),
                              FL.impression_window(inp.impressions, as_of, window[0], window[1]),
                              hist_items)                          # FLT-09/10/11
    blocked = FL.candidate_items(inp.blocklist.select("item"), FL.first_n(inp.first_block))
    q = keyed_load(inp.quality.select("item", "score", "create_days", *FL.position(inp.quality)), "item")
    good = FL.exclude_items(q.where(F.col("score") != 0).select("item"), blocked)  # FLT-13, FLT-12
    q = q.select("item", "create_days")
    used = inp.tag_item.select("tag", "item", "quality", "pos").join(ut.select("tag").distinct(), "tag", "left_semi")
    prof = keyed_load(inp.profile.select("item", "avg_pub_time", *FL.position(inp.profile)), "item")
    lists = C.renumber(used.join(q, "item").join(prof, "item", "left"), "tag", keep=good, limits=inp.user_max_age, sized=inp.tag_item.select("tag"))
    u = ut.select("user", "tag", "pref", F.col("pos").alias("tag_pos"))
    by = None if C.heavy_keys(inp.user_tag, ["user"]) else "user"  # tags of a user have no bound
    capped = C.capped_expansion(u, lists, "tag", (tag_cap,), excl, group="tag", limits=inp.user_max_age, by=by)  # FLT-17
    return capped.withColumnRenamed("pos", "item_pos")


def candidates(inp: TagInputs, as_of, active_days: int, window, max_impress: int,
               tag_cap: int = P.TAG_CAP_P3, penalty_mode: str = "constant") -> DataFrame:
    """(user, item, score, src) after the per-tag cap, sum-merge, freshness and penalty."""
    return candidate_stages(inp, as_of, active_days, window, max_impress, tag_cap, penalty_mode)["cand"]


def candidate_stages(inp: TagInputs, as_of, active_days: int, window, max_impress: int,
                     tag_cap: int = P.TAG_CAP_P3, penalty_mode: str = "constant") -> dict:
    def cap(_):
        return capped_rows(inp, as_of, active_days, window, max_impress, tag_cap)

    def merge(st):
        # AGG-05 and AGG-07 in one pass over the rows
        return (st["capped"].groupBy("user", "item")
                .agg(S.fixed_sum(F.col("pref") * F.col("quality")).alias("score"), F.min_by("tag", "tag_pos").alias("src"),
                     F.max("avg_pub_time").alias("avg_pub_time")))  # the item's

    def freshened(st):
        nsw = keyed_load(inp.new_song_weight.select("user", "new_song_weight", *FL.position(inp.new_song_weight)), "user")
        seen = FL.only_active(inp.visited, FL.active_users(inp.active, as_of, active_days))
        vis = keyed_load(seen.select("user", "item", F.col("score").alias("_vis"), *FL.position(seen)), "user", "item")
        vis = vis.where((F.col("_vis") < 1) & (F.col("_vis") > -max_impress))  # others were excluded
        x = C.with_marks(st["merged"].join(nsw, "user", "left"), vis, "_vis")
        age = S.age_days(P.epoch(as_of), F.col("avg_pub_time"))
        fresh = S.freshness_a(F.col("score"), F.coalesce("new_song_weight", F.lit(0.0)), age)
        x = x.withColumn("score", S.impression_penalty(fresh, F.col("_vis"), penalty_mode))
        return x.select("user", "item", "score", "src")

    return Stages(capped=cap, merged=merge, cand=freshened)


def score(pool: DataFrame, inp: TagInputs, weights, weights_ab, item_width: int, divisor: int,
          remainder: int | None, rate_default: float = P.RATE_DEFAULT_P3, blend: float = P.BLEND_P3) -> DataFrame:
    """Treatment arm: recall * blend + dense LR over the assembled features (FN-05, FN-07);
    control arm: recall * blend + LR v2 with the second weight vector (FN-03)."""
    x = X.with_affinity(pool, inp.user_aff, inp.item_aff, ignored=(), repeats="last")
    own = X.user_part(inp.user_feat, {"zu_ab": weights_ab}).join(
        X.user_part(inp.user_feat, {"zu": weights}, P.USER_WIDTH), "user")
    x = x.join(own, "user", "left")
    x = x.join(X.item_part(inp.item_feat, {"zi": weights, "zi_ab": weights_ab}, expected=item_width), "item", "left")  # Q-21
    x = X.with_rate(x, inp.rate, rate_default)
    w, w_ab = S.weights_lit(weights), S.weights_lit(weights_ab)
    dense = S.dense_parts(w, F.col("zu"), F.col("zi"), F.col("n_bits"), F.col("rate"), F.col("lan"), F.col("style"), item_width)
    control = S.lr_parts(F.coalesce("zu_ab", F.lit(0.0)), F.col("zi_ab"), w_ab[P.USER_WIDTH + item_width] * F.col("rate"))
    treated = S.in_treatment(F.col("user"), divisor, remainder)
    return x.withColumn("score", F.col("score") * blend + F.when(treated, dense).otherwise(control))


def recommend_by_tag(inp: TagInputs, as_of, weights, weights_ab, item_width: int, divisor: int,
                     remainder: int, active_days: int = 2, window=(2, 90), max_impress: int | None = None,
                     max_rec: int = P.MAX_REC_P3, penalty_mode: str = "constant") -> DataFrame:
    """Ranked lists (user, rank, item, score, src); score rounded HALF_UP to 4 places."""
    mi = max_impress if max_impress is not None else P.max_impress(as_of)
    cand = candidates(inp, as_of, active_days, window, mi, penalty_mode=penalty_mode)
    pool = materialise(C.reason_caps(cand, P.REASON_CAP, P.REASON_TOTAL), by="user")
    nr = C.distinct_reasons(pool)
    scored = score(pool, inp, weights, weights_ab, item_width, divisor, remainder)
    scored = scored.select("user", "item", "score", "src").join(nr, "user")
    inter = RR.quota_interleave(scored, max_rec)
    ranked = RR.top_n(inter, max_rec)
    return ranked.select("user", "rank", "item", S.half_up(F.col("score"), 4).alias("score"), "src")
