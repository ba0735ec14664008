"""DuckDB SQL for the canonical views (the oracle side of ``sources.views``).

Each entry is ``name -> (dependencies, SELECT ...)``; ``with_views`` builds a
``WITH`` clause holding the transitive closure a query needs.  The rules are
the same as in ``recsmith.sources.views``, written independently in SQL.
"""

from __future__ import annotations

from recsmith import params as P

AS_OF = P.AS_OF_SQL


UNITS = "CAST(1073741824 AS DOUBLE)"


def fixed_sum(x: str) -> str:
    """Order-independent sum in whole units of 2^-30 (see ``functions.scoring.fixed_sum``)."""
    return f"(CAST(sum(CAST(round(({x}) * {UNITS}) AS HUGEINT)) AS DOUBLE) / {UNITS})"


def _share(column: str, name: str, value: str) -> str:
    """Each user's share of spend per value of a part column."""
    whole = f'CAST(sum(CAST(round(spend * {UNITS}) AS HUGEINT)) OVER (PARTITION BY "user") AS DOUBLE) / {UNITS}'
    return (f'SELECT "user", {name}, spend / ({whole}) AS {value} FROM (SELECT o_custkey AS "user", {column} AS {name}, '
            f'{fixed_sum("l_extendedprice")} AS spend FROM v_order_lines JOIN part ON l_partkey = p_partkey '
            f'GROUP BY o_custkey, {column})')


def _weights_sql(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::DOUBLE[]"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_events": ((), """
        SELECT event_id, ts, user_id AS "user", event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
        FROM events"""),
    "v_clicklog": (("v_events",), """
        SELECT event_id, 'user-playlist' AS scene,
               CASE WHEN event_type = 'click' THEN 'recommendclick' ELSE 'subscribe' END AS action,
               "user", item,
               CASE WHEN event_type = 'click' THEN
                    CASE WHEN event_id % 7 = 0 THEN 'featured'
                         WHEN event_id % 7 = 6 THEN 'bad:alg'
                         ELSE 'alg' || CAST(event_id % 7 AS VARCHAR) END END AS alg,
               ts, CAST(ts AS DATE) AS day,
               CASE WHEN event_id % 3 = 0 THEN 'android' WHEN event_id % 3 = 1 THEN 'iPhone'
                    ELSE 'pc' END AS os
        FROM v_events WHERE event_type IN ('click', 'purchase')"""),
    "v_visited": (("v_events",), """
        SELECT "user", item,
               CASE WHEN sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) > 0
                    THEN CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT)
                    ELSE -CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) END AS score
        FROM v_events WHERE event_type IN ('view', 'click') GROUP BY "user", item"""),
    "v_impress": (("v_events",), """
        SELECT DISTINCT "user", item, CAST(ts AS DATE) AS dt FROM v_events WHERE event_type = 'view'"""),
    "v_active": (("v_events",), """
        SELECT "user", max(ts) AS last_ts FROM v_events GROUP BY "user" """),
    "v_pair_block": (("v_events",), """
        SELECT DISTINCT "user", item FROM v_events WHERE event_type = 'error'"""),
    "v_order_lines": ((), """
        SELECT o_custkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "v_user_seed": (("v_order_lines",), """
        SELECT o_custkey AS "user", l_suppkey AS seed, sum(l_quantity) AS score
        FROM v_order_lines GROUP BY o_custkey, l_suppkey"""),
    "v_seed_item": ((), """
        SELECT seed, item, sim,
               row_number() OVER (PARTITION BY seed ORDER BY sim DESC, item) - 1 AS pos
        FROM (SELECT l_suppkey AS seed, l_partkey AS item,
                     sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_suppkey) AS sim
              FROM lineitem GROUP BY l_suppkey, l_partkey)"""),
    "v_play": (("v_order_lines", "v_events"), f"""
        SELECT o_custkey AS "user", l_partkey AS item, sum(l_quantity) AS score, 0 AS priority
        FROM v_order_lines GROUP BY o_custkey, l_partkey
        UNION ALL
        SELECT DISTINCT "user", item, {P.LOG_PLAY_SCORE} AS score, 1 AS priority
        FROM v_events WHERE event_type = 'view'"""),
    "v_sub": (("v_order_lines", "v_events"), """
        SELECT o_custkey AS "user", l_partkey AS item FROM v_order_lines WHERE l_returnflag <> 'R'
        UNION
        SELECT "user", item FROM v_events WHERE event_type = 'purchase'"""),
    "v_order_parts": ((), "SELECT DISTINCT l_orderkey, l_partkey AS item FROM lineitem"),
    "v_together": (("v_order_parts",), """
        SELECT p.item, p.item2, p.n, a.n AS n1, b.n AS n2
        FROM (SELECT x.item, y.item AS item2, count(*) AS n FROM v_order_parts x
              JOIN v_order_parts y ON x.l_orderkey = y.l_orderkey AND x.item <> y.item GROUP BY x.item, y.item) p
        JOIN (SELECT item, count(*) AS n FROM v_order_parts GROUP BY item) a ON a.item = p.item
        JOIN (SELECT item, count(*) AS n FROM v_order_parts GROUP BY item) b ON b.item = p.item2"""),
    "v_item_sim": (("v_together",), """
        SELECT item, item2, sim, row_number() OVER (PARTITION BY item ORDER BY sim DESC, item2) - 1 AS pos
        FROM (SELECT item, item2, CAST(n AS DOUBLE) / CAST(n1 AS DOUBLE) AS sim FROM v_together)"""),
    "v_item_sim_alt": (("v_together",), """
        SELECT item, item2, sim, row_number() OVER (PARTITION BY item ORDER BY sim DESC, item2) - 1 AS pos
        FROM (SELECT item, item2, CAST(n AS DOUBLE) / CAST(n2 AS DOUBLE) AS sim FROM v_together
              JOIN part ON p_partkey = item WHERE p_type <> 'STANDARD')"""),
    "v_arm_except": ((), 'SELECT c_custkey AS "user" FROM customer WHERE c_nationkey = 1'),
    "v_user_tag": (("v_order_lines",), f"""
        SELECT "user", tag, pref, row_number() OVER (PARTITION BY "user" ORDER BY pref DESC, tag) - 1 AS pos
        FROM ({_share("p_brand", "tag", "pref")})"""),
    "v_tag_item": ((), """
        SELECT tag, item, quality, row_number() OVER (PARTITION BY tag ORDER BY quality DESC, item) - 1 AS pos
        FROM (SELECT p_brand AS tag, p_partkey AS item,
                     p_retailprice / max(p_retailprice) OVER (PARTITION BY p_brand) AS quality FROM part)"""),
    "v_quality": ((), """
        SELECT p_partkey AS item, CASE WHEN p_size <= 5 THEN 0.0 ELSE p_size / 50.0 END AS score,
               CAST(p_size * 10 AS INTEGER) AS create_days FROM part"""),
    "v_profile": ((), f"""
        SELECT p_partkey AS item,
               CAST({P.AS_OF_EPOCH} - CAST(p_size - 1 AS BIGINT) * CAST(p_size - 1 AS BIGINT)
                    * CAST(p_size - 1 AS BIGINT) * 6000 AS BIGINT) AS avg_pub_time FROM part"""),
    "v_history": (("v_user_tag", "v_tag_item"), """
        SELECT "user", string_agg(CAST(ti.item AS VARCHAR) || ':' || CAST(3 - ut.pos AS VARCHAR) || ':' || ut.tag,
                                  ',' ORDER BY ut.pos) AS packed
        FROM v_user_tag ut JOIN v_tag_item ti ON ut.tag = ti.tag AND ti.pos = 0
        WHERE ut.pos < 3 GROUP BY "user" """),
    "v_block": ((), "SELECT p_partkey AS item FROM part WHERE p_size = 50"),
    "v_first_block": ((), f"""
        SELECT row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS rank, p_partkey AS item
        FROM (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT {2 * P.FIRST_BLOCK_N})"""),
    "v_gated": ((), "SELECT p_partkey AS item FROM part WHERE p_type = 'PROMO'"),
    "v_segment": ((), "SELECT c_custkey AS \"user\" FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "v_user_max_age": ((), f"""
        SELECT c_custkey AS "user", {P.AGE_LIMIT_DAYS} AS max_days FROM customer WHERE c_nationkey = 0"""),
    "v_new_song_weight": ((), """
        SELECT c_custkey AS "user", 1.0 + (c_custkey % 4) * 0.25 AS new_song_weight FROM customer"""),
    "v_item_feat": ((), """
        SELECT vec_id AS item, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits
        FROM embeddings"""),
    "v_user_feat": ((), """
        SELECT c_custkey AS "user",
               list_concat([CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END,
                CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END,
                CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END,
                CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END,
                CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END,
                CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END],
               list_transform(range(0, 25), lambda n: CASE WHEN c_nationkey = n THEN 1 ELSE 0 END)) AS feats
        FROM customer"""),
    "v_user_aff": (("v_order_lines",), f"""
        SELECT "user", 'lan' AS kind, tag, ratio FROM ({_share("p_brand", "tag", "ratio")})
        UNION ALL
        SELECT "user", 'style' AS kind, tag, ratio FROM ({_share("p_type", "tag", "ratio")})"""),
    "v_item_aff": ((), """
        SELECT p_partkey AS item, 'lan' AS kind, p_brand AS tag, 1.0 AS ratio FROM part
        UNION ALL
        SELECT p_partkey AS item, 'style' AS kind, p_type AS tag, 1.0 AS ratio FROM part"""),
    "v_rate_seed": ((), """
        SELECT l_partkey AS item, CAST(l_suppkey AS VARCHAR) AS src,
               avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS rate
        FROM lineitem GROUP BY l_partkey, l_suppkey"""),
    "v_rate_tag": ((), """
        SELECT l_partkey AS item, p_brand AS src, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS rate
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_brand"""),
    "v_rate_liked": (("v_item_sim",), """
        SELECT s.item2 AS item, CAST(s.item AS VARCHAR) AS src, o.rate
        FROM v_item_sim s JOIN (SELECT l_partkey AS seed,
                                       avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS rate
                                FROM lineitem GROUP BY l_partkey) o ON o.seed = s.item"""),
    "v_pay": ((), """
        SELECT p_partkey AS item, p_retailprice / 100000.0 AS money, p_size / 10000.0 AS click FROM part"""),
    "v_weights": ((), f"SELECT {_weights_sql(P.WEIGHTS)} AS w"),
    "v_weights_ab": ((), f"SELECT {_weights_sql(P.WEIGHTS_AB)} AS w"),
}


def closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause for the views ``names`` (plus their dependencies) and extra CTEs."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in closure(names)]
    for n, body in extra or []:
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"
