"""Recommend items by the user's seed items (recall -> exclusions -> cap ->
budget -> max-merge -> LR + monetisation boost -> harmonic diversity -> head
re-rank -> top-N).

Plan shape: active users are semi-joined into user->seed before the
expansion; the expansion is joined on ``seed`` (AQE splits hot seeds);
everything after the caps is keyed by ``user`` with at most ~budget + cap rows
per user, so the later windows and joins stay small per key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith import session
from recsmith.functions import scoring as S
from recsmith.operators import candidates as C
from recsmith.operators import features as X
from recsmith.operators import filters as FL
from recsmith.operators import recall as RC
from recsmith.operators import rerank as RR
from recsmith.operators.keyed import keyed_load
from recsmith.session import LazyInputs, Stages, materialise


@dataclass
class SeedInputs(LazyInputs):
    active: DataFrame        # user, last_ts
    user_seed: DataFrame     # user, seed, score
    seed_item: DataFrame     # seed, item, sim, pos
    visited: DataFrame       # user, item, score
    impressions: DataFrame   # user, item, dt
    gated: DataFrame         # item
    segment: DataFrame       # user
    item_feat: DataFrame     # item, bits
    user_feat: DataFrame     # user, feats
    rate: DataFrame          # item, src, rate
    user_aff: DataFrame      # user, kind, tag, ratio
    item_aff: DataFrame      # item, kind, tag, ratio
    pay: DataFrame           # item, money, click


def candidates(inp: SeedInputs, as_of, active_days: int, window: tuple[int, int], max_impress: int,
               caps=P.SEED_CAP_P2, many_at: int = P.SEED_CAP_MANY, budget: int = P.SEED_BUDGET,
               penalty_mode: str = "constant") -> DataFrame:
    return candidate_stages(inp, as_of, active_days, window, max_impress, caps, many_at, budget,
                            penalty_mode)["cand"]


def candidate_stages(inp: SeedInputs, as_of, active_days: int, window: tuple[int, int], max_impress: int,
                     caps=P.SEED_CAP_P2, many_at: int = P.SEED_CAP_MANY, budget: int = P.SEED_BUDGET,
                     penalty_mode: str = "constant") -> Stages:
    """(user, item, score, src): merged recall scores after exclusions, caps and budget.

    The expansion is pruned exactly (``headed_expansion``) before the exclusions and
    caps; the reason lookup reads whole lists, cut to the candidates where they are read.
    From the caps on a user has a bounded number of rows, and the stage tables are bucketed by
    user: budget, merge and reasons plan no further exchange of them.
    """
    def ranked_seeds(_):
        users = FL.active_users(inp.active, as_of, active_days)
        with_list = inp.seed_item.select("seed").distinct()
        listed = FL.only_active(inp.user_seed, users).join(with_list, "seed", "left_semi")  # others never count
        return C.seed_rank(listed).select("user", "seed", F.col("score").alias("seed_score"), "i", "n_seeds")

    def cap_eligible(st):
        us, lists = st["us"], inp.seed_item.select("seed", "item", "sim", "pos")
        used = lists.join(us.select("seed").distinct(), "seed", "left_semi")
        gated = inp.gated.select("item").distinct().withColumn("_gated", F.lit(True))
        used = used.join(gated, "item", "left").withColumn("_gated", F.coalesce("_gated", F.lit(False)))
        placed = session.materialise(used, by=None if C.heavy_keys(lists, ["seed"]) else "seed")  # the steps on a list move none
        capped = C.headed_expansion(us, [(F.lit(True), placed)], "seed", caps, st["excl"], inp.gated, inp.segment, many_at)
        return materialise(capped.drop("seed_score", "n_seeds"), by="user")  # the budget reads it twice

    def merge(st):
        vis = st["visited"].withColumnRenamed("score", "_vis")
        # the rows lie by user and stay there
        scored = (C.with_marks(st["kept"], vis, "_vis", written=True)
                  .withColumn("score", S.impression_penalty(F.col("sim"), F.col("_vis"), penalty_mode)))
        return materialise(C.merge_max(scored), by="user")

    return Stages(
        us=ranked_seeds,
        visited=lambda st: keyed_load(inp.visited.select("user", "item", "score", *FL.position(inp.visited)), "user", "item"),
        excl=lambda st: FL.exclusion_pairs(FL.seen_pairs(inp.visited, max_impress),
                                           FL.impression_window(inp.impressions, as_of, window[0], window[1])),
        capped=cap_eligible,
        cut=lambda st: session.materialise(C.budget_cut(st["capped"], budget), by="user"),  # read by budget and reasons
        kept=lambda st: C.seed_budget(st["capped"], budget, st["cut"]),
        merged=merge,
        src=lambda st: reason_over_recalled(st["merged"], st["us"], inp.seed_item, st["cut"]),
        cand=lambda st: materialise(st["src"], by="user"))


def reason_over_recalled(merged: DataFrame, us: DataFrame, seed_item: DataFrame,
                         cut: DataFrame | None = None) -> DataFrame:
    """AGG-07 (P2) over all recalled rows: the candidates (user, item, score) with src = the seed with the highest seed score
    (then lowest id) whose list holds the item, i.e. the lowest seed rank ``i``.

    The lists are read once and cut to the users' candidates in the tasks that read them
    (``recall.likely_rows``); the rows left meet the candidates by user, in one ``min_by`` that drops what is none.
    """
    seeds = us.select("user", "seed", "i")
    if cut is not None:
        # every candidate is first kept at a rank <= the user's budget cut, so later seeds
        # can never hold the lowest rank: drop them before reading their lists
        seeds = (seeds.join(cut, "user", "left")
                 .where(F.col("_cut").isNull() | (F.col("i") <= F.col("_cut"))).drop("_cut"))
    recalled = RC.likely_rows(seeds, seed_item.select("seed", "item"), "seed", merged)
    own = merged.select("user", "item", "score", F.lit(True).alias("_c"))
    rows = own.unionByName(recalled.select("user", "item", "seed", "i"), allowMissingColumns=True).where(F.col("item").isNotNull())
    rows = rows.repartition(session.bucket_count(rows.sparkSession), "user")
    x = rows.groupBy("user", "item").agg(F.max("score").alias("score"), F.min_by("seed", "i").alias("src"), F.bool_or("_c").alias("_c"))
    return x.where(F.col("_c") & F.col("src").isNotNull()).drop("_c")


def score(cand: DataFrame, inp: SeedInputs, weights, item_width: int, divisor: int, remainder: int | None,
          rate_default: float = P.RATE_DEFAULT_P2, pay=P.PAY_P2, blend: float = P.BLEND_P2P4) -> DataFrame:
    """FN-04 + FN-09 + FN-10 + FN-11: score = recall * blend + LR3 (+ boost in the treatment arm)."""
    # what is known of an item first, then the rate of item and seed, so that the candidates go by item once and come back by user once
    x = X.with_pay(cand, inp.pay)
    x = X.with_item_part(x, inp.item_feat, weights)
    x = X.with_item_tags(x, inp.item_aff)
    x = X.with_rate(x, inp.rate, rate_default)
    x = X.with_user_part(x, inp.user_feat, weights)
    x = X.with_user_affinity(x, inp.user_aff)
    w, b = S.weights_lit(weights), P.USER_WIDTH + item_width
    lr = S.lr_parts(F.col("zu"), F.col("zi"), w[b] * F.col("rate"), w[b + 1] * F.col("lan"), w[b + 2] * F.col("style"))
    boost = S.pay_boost(F.col("money"), F.col("click"), *pay)
    treated = S.in_treatment(F.col("user"), divisor, remainder)
    return x.withColumn("score", S.blended(F.col("score"), lr, blend, treated, boost))


def recommend_by_seed(inp: SeedInputs, as_of, weights, item_width: int, divisor: int, remainder: int,
                      remainder_2: int | None = None, active_days: int = 1, window=(1, 60),
                      max_impress: int | None = None, top: int = P.TOP_P2,
                      penalty_mode: str = "constant") -> DataFrame:
    """Ranked lists (user, rank, item, score, src)."""
    mi = max_impress if max_impress is not None else P.max_impress(as_of)
    cand = candidates(inp, as_of, active_days, window, mi, penalty_mode=penalty_mode)
    scored = score(cand, inp, weights, item_width, divisor, remainder)
    div = RR.diversity_harmonic(scored.select("user", "item", "score", "src", "money", "click"))
    head_boost = S.pay_boost(F.col("money"), F.col("click"), *P.PAY_P2_HEAD)
    treated2 = S.in_treatment(F.col("user"), divisor, remainder_2)
    ranked = RR.head_rerank(div, head_boost, treated2, P.HEAD_N, P.PAY_P2_HEAD[2], upto=top)
    return RR.top_n(ranked, top, "rank").select("user", "rank", "item", "score", "src")
