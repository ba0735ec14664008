"""Feature enrichment joins around a (user,item[,src]) candidate table
(JOIN-07, JOIN-10, JOIN-11, FN-02..07 inputs).

Every lookup is keyed first (``keyed_load``): a repeated key never multiplies candidates, and the
last row is in force.  Lookups are plain left joins; the planner (with AQE) broadcasts those that
are small at runtime and keeps the large ones shuffled.

A model score is a sum over the user's vector, the item's vector and a few pair features.  The first
two sums are made once per user and once per item (``user_part``, ``item_part``) and joined as one
number each, so no vector travels with the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith import params as P
from recsmith.functions.scoring import FIXED_SCALE, WHOLE_BELOW, dot, fixed, weights_lit, whole_units
from recsmith.operators.candidates import with_marks
from recsmith.operators.filters import affinity_threshold
from recsmith.operators.filters import position as _position
from recsmith.operators.keyed import keyed_load

AFFINITY_KINDS = ("lan", "style")


def with_rate(cand: DataFrame, rate: DataFrame, default: float, src_col: str = "src") -> DataFrame:
    """JOIN-10: promoted rate of (item, src) with a default."""
    held = keyed_load(rate.select("item", "src", "rate", *_position(rate)), "item", "src")
    r = held.select(F.col("item").alias("_item"), F.col("src").alias("_src"), F.col("rate").alias("_rate"))
    j = cand.join(r, (cand["item"] == r["_item"]) & (cand[src_col].cast("string") == r["_src"]), "left")
    return j.withColumn("rate", F.coalesce("_rate", F.lit(default))).drop("_item", "_src", "_rate")


def with_src_rate(cand: DataFrame, rate: DataFrame, default: float, users: DataFrame | None = None) -> DataFrame:
    """JOIN-10 where the rate of a (item, src) is the same for every item that ``src`` recalls: (src, rate).

    The rates come to each user's few reasons (those of ``users``, a table of the same users and reasons), not to the candidates."""
    held = keyed_load(rate.select("src", "rate", *_position(rate)), "src")
    own = (cand if users is None else users).select("user", "src").distinct().join(held, "src")
    return with_marks(cand, own, "rate", "src").withColumn("rate", F.coalesce("rate", F.lit(default)))


def pair_list(aff: DataFrame, key: str, name: str) -> DataFrame:
    """One row per ``key`` with its (kind, tag, ratio) pairs in order, repeated ones included: a line of a
    few tags, as the input files hold them."""
    pairs = F.array_sort(F.collect_list(F.struct("kind", "tag", "ratio")))
    return aff.groupBy(key).agg(pairs.alias(name))


def _tag_key(tag: Column) -> Column:
    """A tag as a map key: the null tag is a tag of its own."""
    return F.coalesce(F.concat(F.lit("="), tag), F.lit(""))


def tag_maps(aff: DataFrame, key: str, name: str, kinds=AFFINITY_KINDS) -> DataFrame:
    """One row per ``key``: for each kind a map from the tag (``_tag_key``) to its ratios, repeated ones included
    (``<name>_<kind>``), and of these kinds the pairs (``<name>_n``), the largest size of a ratio (``<name>_top``) and whether no
    tag is repeated (``<name>_once``)."""
    pairs = aff.where(F.col("kind").isin(*kinds)).groupBy(key, "kind", "tag").agg(F.collect_list("ratio").alias("_r"))
    pairs = pairs.withColumns({"_k": _tag_key(F.col("tag")), "_s": F.size("_r"), "_t": F.array_max(F.transform("_r", lambda r: F.abs(r.cast("double"))))})
    held = [F.map_from_entries(F.collect_list(F.when(F.col("kind") == k, F.struct("_k", "_r")))).alias(f"{name}_{k}") for k in kinds]
    return pairs.groupBy(key).agg(*held, F.sum("_s").alias(f"{name}_n"), F.max("_t").alias(f"{name}_top"), (F.max("_s") <= 1).alias(f"{name}_once"))


def with_affinity(cand: DataFrame, user_aff: DataFrame, item_aff: DataFrame, ignored=P.AFFINITY_IGNORED,
                  repeats: str = "add") -> DataFrame:
    """JOIN-11: ``lan`` and ``style``: the sum over the user's pairs of user ratio x the item's ratio of the
    same tag, after FLT-16.

    A tag that the user's lines hold twice counts twice (``repeats="last"``: its last ratio only, as
    the tag route reads it); of an item's repeated tag the last ratio is in force.  Two lookups
    (the user's map, the item's list) and, inside the row, a look into the map for each of the item's few tags; the sum runs over
    whole units, so it does not depend on the order of the pairs."""
    return with_user_affinity(with_item_tags(cand, item_aff), user_aff, ignored, repeats)


def item_tags(item_aff: DataFrame) -> DataFrame:
    """(item, _i_<kind> for each kind, _i_top): an item's tags of a kind, as map keys with the ratio in force, and the largest size of its ratios."""
    held = keyed_load(item_aff.select("item", "kind", "tag", "ratio", *_position(item_aff)), "item", "kind", "tag")
    pair = F.struct(_tag_key(F.col("tag")).alias("k"), F.col("ratio").alias("r"))
    return held.groupBy("item").agg(*[F.collect_list(F.when(F.col("kind") == k, pair)).alias(f"_i_{k}") for k in AFFINITY_KINDS],
                                    F.max(F.abs(F.col("ratio").cast("double"))).alias("_i_top"))


def with_item_tags(cand: DataFrame, item_aff: DataFrame) -> DataFrame:
    """JOIN-11, item side (``item_tags``): where the candidates go by item."""
    return cand.join(item_tags(item_aff), "item", "left")


def with_user_affinity(cand: DataFrame, user_aff: DataFrame, ignored=P.AFFINITY_IGNORED, repeats: str = "add") -> DataFrame:
    """JOIN-11, user side, on candidates with the tags of their items: where they lie by user."""
    if repeats == "last":
        user_aff = keyed_load(user_aff.select("user", "kind", "tag", "ratio", *_position(user_aff)), "user", "kind", "tag")
    own = tag_maps(affinity_threshold(user_aff, ignored=ignored), "user", "_u")
    j = cand.join(own, "user", "left")

    def total(kind: str) -> Column:
        tags, mine, no_ratios = F.col(f"_i_{kind}"), F.col(f"_u_{kind}"), F.array().cast(own.schema[f"_u_{kind}"].dataType.valueType)

        def added(start: Column, units, plus) -> Column:
            # each ratio of the user for each tag of the item
            return F.aggregate(tags, start, lambda s, t: F.aggregate(F.coalesce(F.element_at(mine, t["k"]), no_ratios), s,
                                                                     lambda u, r: plus(u, F.coalesce(units(r * t["r"]), F.lit(0)))))

        exact = added(F.lit(0).cast("decimal(38,0)"), fixed, lambda u, v: (u + v).cast("decimal(38,0)")).cast("double")
        # sums of whole doubles this small are exact too
        small = added(F.lit(0.0), lambda x: whole_units(x * FIXED_SCALE), lambda u, v: u + v)
        first = F.get(tags, F.lit(0))
        one = F.coalesce(whole_units(F.get(F.element_at(mine, first["k"]), F.lit(0)) * first["r"] * FIXED_SCALE), F.lit(0.0))
        bound = F.col("_u_n") * F.col("_u_top") * F.col("_i_top") * FIXED_SCALE
        units = F.when(bound < WHOLE_BELOW, F.when(F.col("_u_once") & (F.size(tags) == 1), one).otherwise(small)).otherwise(exact)
        return F.coalesce(units / FIXED_SCALE, F.lit(0.0))

    gone = [c for c in (*own.columns, *[f"_i_{k}" for k in AFFINITY_KINDS], "_i_top") if c != "user"]
    return j.withColumns({k: total(k) for k in AFFINITY_KINDS}).drop(*gone)


def affinity_dot(cand: DataFrame, user_aff: DataFrame, item_aff: DataFrame,
                 ignored=P.AFFINITY_IGNORED) -> DataFrame:
    """(user,item,lan,style) of the candidates that share a tag with their user."""
    pairs = with_affinity(cand.select("user", "item"), user_aff, item_aff, ignored)
    return pairs.where((F.col("lan") != 0) | (F.col("style") != 0))


def user_part(user_feat: DataFrame, name_weights: dict[str, object], width: int | None = None) -> DataFrame:
    """(user, <name> per weight vector): the user's half of the dot product, over the first ``width`` features
    where it is given."""
    f = F.col("feats") if width is None else F.slice("feats", 1, width)
    rows = user_feat.select("user", f.alias("_f"), *_position(user_feat))
    return keyed_load(_dots(rows, name_weights, 0), "user")


def _dots(rows: DataFrame, name_weights: dict[str, object], offset: int) -> DataFrame:
    """``_f`` replaced by its dot product with each weight vector from ``offset`` on."""
    # the vectors come in as columns first: one that a job reads is a subquery, which no lambda may hold
    held = rows.select("*", *[weights_lit(w).alias(f"_w_{n}") for n, w in name_weights.items()])
    rest = [c for c in rows.columns if c != "_f"]
    return held.select(*rest, *[dot(F.col(f"_w_{n}"), F.col("_f"), offset).alias(n) for n in name_weights])


def item_part(item_feat: DataFrame, name_weights: dict[str, object], user_width: int = P.USER_WIDTH,
              expected: int | None = None) -> DataFrame:
    """(item, <name> per weight vector, n_bits): the item's half of the dot product, its weights behind the
    user's.  With ``expected`` an item vector of another width ends the job (Q-21)."""
    bits = F.col("bits")
    if expected is not None:
        wrong = F.raise_error(F.lit(f"item feature width differs from {expected}")).cast("array<int>")
        bits = F.when(F.size("bits") == expected, F.col("bits").cast("array<int>")).otherwise(wrong)
    held = item_feat.select("item", bits.alias("_f"), *_position(item_feat))
    held = held.withColumn("n_bits", F.size("_f"))
    return keyed_load(_dots(held, name_weights, user_width), "item")


def with_parts(cand: DataFrame, user_feat: DataFrame | None, item_feat: DataFrame, weights,
               user_width: int = P.USER_WIDTH) -> DataFrame:
    """JOIN-07 for FN-02..04: ``zu`` (0 without user features) and ``zi`` (null without item features)."""
    return with_item_part(with_user_part(cand, user_feat, weights), item_feat, weights, user_width)


def with_user_part(cand: DataFrame, user_feat: DataFrame | None, weights) -> DataFrame:
    """JOIN-07, user side: ``zu``."""
    if user_feat is None:
        return cand.withColumn("zu", F.lit(0.0))
    return cand.join(user_part(user_feat, {"zu": weights}), "user", "left").withColumn("zu", F.coalesce("zu", F.lit(0.0)))


def with_item_part(cand: DataFrame, item_feat: DataFrame, weights, user_width: int = P.USER_WIDTH) -> DataFrame:
    """JOIN-07, item side: ``zi``."""
    return cand.join(item_part(item_feat, {"zi": weights}, user_width).drop("n_bits"), "item", "left")


def with_pay(cand: DataFrame, pay: DataFrame) -> DataFrame:
    """JOIN-07: ``money`` and ``click`` of the item."""
    return cand.join(keyed_load(pay.select("item", "money", "click", *_position(pay)), "item"), "item", "left")


USER_WIDTH = P.USER_WIDTH
