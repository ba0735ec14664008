"""DuckDB CTE chains for the three recall routes (oracle side).

Each builder returns a list of (name, body) CTEs that the catalogue closes with
a final SELECT, so operator-level queries can stop at any stage of a chain.
"""

from __future__ import annotations

from recsmith import params as P
from recsmith.oracle_views import fixed_sum

AS_OF_DATE = "DATE '2024-01-31'"


def _active(days: int) -> str:
    if days <= 0:
        return 'SELECT "user" FROM v_active'
    return (f'SELECT "user" FROM v_active WHERE last_ts >= {P.AS_OF_SQL} - INTERVAL {days} DAY')


def _excl(window, mi: int) -> str:
    lo, hi = window
    return (f'SELECT "user", item FROM v_visited WHERE score >= 1 OR score <= -{mi} '
            f'UNION SELECT "user", item FROM v_impress '
            f'WHERE dt BETWEEN {AS_OF_DATE} - {hi} AND {AS_OF_DATE} - {lo}')


def sigmoid(x: str) -> str:
    return f"(1.0 / (1.0 + exp(-({x}))))"


def dot_user(w: str = "w", f: str = "feats") -> str:
    return f"coalesce(list_dot_product(list_slice({w}, 1, len({f})), CAST({f} AS DOUBLE[])), 0.0)"


def dot_item(w: str = "w", f: str = "bits", off: int = P.USER_WIDTH) -> str:
    return (f"coalesce(list_dot_product(list_slice({w}, {off + 1}, {off} + len({f})), "
            f"CAST({f} AS DOUBLE[])), 0.0)")


def pay_boost(mw: float, cw: float, f: float) -> str:
    pay = f"(CASE WHEN money IS NULL OR click IS NULL THEN 0.0 ELSE money * {mw} + click * {cw} END)"
    return f"({sigmoid(pay)} * {2 * f} - {f})"


def lr3(item_width: int, missing: float = P.MISSING_ITEM_SCORE) -> str:
    b = P.USER_WIDTH + item_width
    z = (f"{dot_user()} + {dot_item()} + w[{b + 1}] * rate + w[{b + 2}] * lan + w[{b + 3}] * style")
    return f"(CASE WHEN bits IS NULL THEN {missing} ELSE {sigmoid(z)} END)"


SEED_VIEWS = ["v_active", "v_user_seed", "v_seed_item", "v_visited", "v_impress", "v_gated", "v_segment",
              "v_item_feat", "v_user_feat", "v_rate_seed", "v_user_aff", "v_item_aff", "v_pay", "v_weights"]


def aff_cte(cand: str = "cand") -> str:
    return f"""
        SELECT c."user", c.item,
               {fixed_sum("CASE WHEN ua.kind = 'lan' THEN ua.ratio * ia.ratio ELSE 0.0 END")} AS lan,
               {fixed_sum("CASE WHEN ua.kind = 'style' THEN ua.ratio * ia.ratio ELSE 0.0 END")} AS style
        FROM (SELECT DISTINCT "user", item FROM {cand}) c
        JOIN v_user_aff ua ON ua."user" = c."user" AND ua.ratio > {P.AFFINITY_MIN}
             AND NOT (ua.kind = 'style' AND ua.tag IN ('unknow', 'null'))
        JOIN v_item_aff ia ON ia.item = c.item AND ia.kind = ua.kind AND ia.tag = ua.tag
        GROUP BY c."user", c.item"""


def seed_chain(active_days=P.ACTIVE_DAYS_P2, window=P.IMPRESS_WINDOW_P2, mi=None,
               caps=P.SEED_CAP_P2, budget=P.SEED_BUDGET, item_width=P.ITEM_WIDTH,
               divisor=P.DIVISOR, remainder=P.REMAINDER, remainder_2=P.REMAINDER_2):
    mi = P.max_impress() if mi is None else mi
    return [
        ("au", _active(active_days)),
        ("us", """SELECT "user", seed, score AS seed_score,
                    row_number() OVER (PARTITION BY "user" ORDER BY score DESC, seed) - 1 AS i,
                    count(*) OVER (PARTITION BY "user") AS n_seeds
                  FROM v_user_seed WHERE "user" IN (SELECT "user" FROM au)
                    AND seed IN (SELECT seed FROM v_seed_item)"""),
        ("exp", "SELECT us.*, si.item, si.sim, si.pos FROM us JOIN v_seed_item si USING (seed)"),
        ("src", """SELECT "user", item, seed AS src FROM (
                    SELECT "user", item, seed, row_number() OVER (PARTITION BY "user", item
                           ORDER BY seed_score DESC, seed) AS rn FROM exp) WHERE rn = 1"""),
        ("excl", _excl(window, mi)),
        ("elig", """SELECT e.* FROM exp e
                    WHERE NOT EXISTS (SELECT 1 FROM excl x WHERE x."user" = e."user" AND x.item = e.item)
                      AND NOT (e.item IN (SELECT item FROM v_gated)
                               AND e."user" NOT IN (SELECT "user" FROM v_segment))"""),
        ("capped", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "user", seed
                         ORDER BY pos) AS rn FROM elig)
                       WHERE rn <= CASE WHEN n_seeds >= {P.SEED_CAP_MANY} THEN {caps[1]} ELSE {caps[0]} END"""),
        ("fr", """SELECT *, CASE WHEN row_number() OVER (PARTITION BY "user", item ORDER BY i) = 1
                               THEN 1 ELSE 0 END AS fresh FROM capped"""),
        ("bud", f"""SELECT * EXCLUDE (fresh, before) FROM (SELECT *, coalesce(sum(fresh) OVER (PARTITION BY "user"
                      ORDER BY i RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fr)
                    WHERE before < {budget}"""),
        ("merged", f"""SELECT b."user", b.item,
                         max(CASE WHEN v.score IS NOT NULL THEN b.sim / {P.IMPRESS_DECAY} ELSE b.sim END) AS recall
                       FROM bud b LEFT JOIN v_visited v ON v."user" = b."user" AND v.item = b.item
                       GROUP BY b."user", b.item"""),
        ("cand", 'SELECT m."user", m.item, m.recall, s.src FROM merged m JOIN src s USING ("user", item)'),
        ("aff", aff_cte("cand")),
        ("feat", f"""SELECT c."user", c.item, c.recall, c.src, coalesce(r.rate, {P.RATE_DEFAULT_P2}) AS rate,
                       coalesce(a.lan, 0.0) AS lan, coalesce(a.style, 0.0) AS style,
                       uf.feats, ib.bits, p.money, p.click, (SELECT w FROM v_weights) AS w
                     FROM cand c
                     LEFT JOIN v_rate_seed r ON r.item = c.item AND r.src = CAST(c.src AS VARCHAR)
                     LEFT JOIN aff a ON a."user" = c."user" AND a.item = c.item
                     LEFT JOIN v_user_feat uf ON uf."user" = c."user"
                     LEFT JOIN v_item_feat ib ON ib.item = c.item
                     LEFT JOIN v_pay p ON p.item = c.item"""),
        ("scored", f"""SELECT "user", item, src, money, click, {lr3(item_width)} AS lr,
                         recall * {P.BLEND_P2P4} + {lr3(item_width)}
                         + CASE WHEN "user" % {divisor} = {remainder} THEN {pay_boost(*P.PAY_P2)} ELSE 0.0 END
                           AS score
                       FROM feat"""),
        ("div", """SELECT "user", item, src, money, click,
                     score / row_number() OVER (PARTITION BY "user", src ORDER BY score DESC, item) AS score
                   FROM scored"""),
        ("hd", f"""SELECT *, CASE WHEN r <= {P.HEAD_N} THEN 1 ELSE 0 END AS head,
                     CASE WHEN "user" % {divisor} = {remainder_2} AND r <= {P.HEAD_N}
                          THEN ({pay_boost(*P.PAY_P2_HEAD)} + score) / {1.0 + P.PAY_P2_HEAD[2]}
                          ELSE score END AS s3
                   FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS r FROM div)"""),
        ("fin", """SELECT "user", item, src, s3 AS score,
                     row_number() OVER (PARTITION BY "user" ORDER BY head DESC, s3 DESC, r) AS rank FROM hd"""),
    ]


TAG_VIEWS = ["v_active", "v_user_tag", "v_tag_item", "v_history", "v_quality", "v_profile", "v_user_max_age",
             "v_block", "v_first_block", "v_visited", "v_impress", "v_new_song_weight", "v_item_feat",
             "v_user_feat", "v_rate_tag", "v_user_aff", "v_item_aff", "v_weights", "v_weights_ab"]


def hist_first() -> str:
    return f"""SELECT "user", TRY_CAST(split_part(e, ':', 1) AS BIGINT) AS item, split_part(e, ':', 3) AS tag, pos
               FROM (SELECT "user", unnest(string_split(packed, ',')) AS e,
                            generate_subscripts(string_split(packed, ','), 1) - 1 AS pos FROM v_history)
               WHERE pos < {P.HISTORY_FIRST}"""


def tag_chain(active_days=P.ACTIVE_DAYS_P3, window=P.IMPRESS_WINDOW_P3, mi=None, item_width=P.ITEM_WIDTH,
              divisor=P.DIVISOR, remainder=P.REMAINDER, max_rec=P.MAX_REC_P3):
    mi = P.max_impress() if mi is None else mi
    b = P.USER_WIDTH + item_width
    feats = (f"list_concat(list_slice(list_concat(coalesce(CAST(feats AS DOUBLE[]), []), "
             f"list_transform(range({P.USER_WIDTH}), lambda k: 0.0)), 1, {P.USER_WIDTH}), "
             f"coalesce(CAST(bits AS DOUBLE[]), list_transform(range({item_width}), lambda k: 0.0)), "
             f"[rate, lan, style])")
    dense = f"(CASE WHEN len(w) <> len(fv) THEN -1.0 ELSE {sigmoid('list_dot_product(w, fv)')} END)"
    z2 = f"{dot_user('wab')} + {dot_item('wab')} + wab[{b + 1}] * rate"
    control = f"(CASE WHEN bits IS NULL THEN {P.MISSING_ITEM_SCORE} ELSE {sigmoid(z2)} END)"
    return [
        ("au", _active(active_days)),
        ("hf", hist_first()),
        ("ut", f"""SELECT u."user", u.tag, u.pos AS tag_pos,
                     CASE WHEN h.tag IS NOT NULL THEN u.pref / {P.TAG_DAMPING} ELSE u.pref END AS pref
                   FROM v_user_tag u
                   LEFT JOIN (SELECT DISTINCT "user", tag FROM hf) h ON h."user" = u."user" AND h.tag = u.tag
                   WHERE u."user" IN (SELECT "user" FROM au) AND u.tag <> ''"""),
        ("exp", """SELECT ut.*, ti.item, ti.quality, ti.pos AS item_pos FROM ut JOIN v_tag_item ti USING (tag)"""),
        ("excl", _excl(window, mi) + ' UNION SELECT "user", item FROM hf'),
        ("blk", f"""SELECT item FROM v_block UNION SELECT item FROM v_first_block WHERE rank < {P.FIRST_BLOCK_N}"""),
        ("elig", """SELECT e.* FROM exp e JOIN v_quality q ON q.item = e.item AND q.score <> 0
                    LEFT JOIN v_user_max_age m ON m."user" = e."user"
                    WHERE (m.max_days IS NULL OR q.create_days <= m.max_days)
                      AND NOT EXISTS (SELECT 1 FROM excl x WHERE x."user" = e."user" AND x.item = e.item)
                      AND e.item NOT IN (SELECT item FROM blk)"""),
        ("capped", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "user", tag
                         ORDER BY item_pos) AS rn FROM elig) WHERE rn <= {P.TAG_CAP_P3}"""),
        ("reason", """SELECT "user", item, tag AS src FROM (SELECT "user", item, tag,
                        row_number() OVER (PARTITION BY "user", item ORDER BY tag_pos) AS rn FROM capped)
                      WHERE rn = 1"""),
        ("merged", f"""SELECT "user", item, {fixed_sum("pref * quality")} AS score FROM capped GROUP BY "user", item"""),
        ("cand", f"""SELECT m."user", m.item, r.src,
                       (CASE WHEN coalesce(n.new_song_weight, 0.0) > 1
                                  AND coalesce(CAST(trunc(({P.AS_OF_EPOCH} - p.avg_pub_time) / 86400) AS INTEGER), 100)
                                      < {P.FRESH_AGE_DAYS}
                             THEN m.score * n.new_song_weight ELSE m.score END)
                       / (CASE WHEN v.score IS NOT NULL THEN {P.IMPRESS_DECAY} ELSE 1.0 END) AS score
                     FROM merged m JOIN reason r USING ("user", item)
                     LEFT JOIN v_profile p ON p.item = m.item
                     LEFT JOIN v_new_song_weight n ON n."user" = m."user"
                     LEFT JOIN v_visited v ON v."user" = m."user" AND v.item = m.item"""),
        ("pool", f"""SELECT * EXCLUDE (r1, r2) FROM (
                       SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS r2 FROM (
                         SELECT *, row_number() OVER (PARTITION BY "user", src ORDER BY score DESC, item) AS r1
                         FROM cand) WHERE r1 <= {P.REASON_CAP})
                     WHERE r2 <= {P.REASON_TOTAL}"""),
        ("nr", 'SELECT "user", count(DISTINCT src) AS n_reasons FROM pool GROUP BY "user"'),
        ("aff", aff_cte("pool").replace("AND NOT (ua.kind = 'style' AND ua.tag IN ('unknow', 'null'))", "")),
        ("feat", f"""SELECT c."user", c.item, c.src, c.score, coalesce(r.rate, {P.RATE_DEFAULT_P3}) AS rate,
                       coalesce(a.lan, 0.0) AS lan, coalesce(a.style, 0.0) AS style, uf.feats, ib.bits,
                       (SELECT w FROM v_weights) AS w, (SELECT w FROM v_weights_ab) AS wab
                     FROM pool c
                     LEFT JOIN v_rate_tag r ON r.item = c.item AND r.src = c.src
                     LEFT JOIN aff a ON a."user" = c."user" AND a.item = c.item
                     LEFT JOIN v_user_feat uf ON uf."user" = c."user"
                     LEFT JOIN v_item_feat ib ON ib.item = c.item"""),
        ("fv", f"SELECT *, {feats} AS fv FROM feat"),
        ("scored", f"""SELECT f."user", f.item, f.src, n.n_reasons,
                         f.score * {P.BLEND_P3} + CASE WHEN f."user" % {divisor} = {remainder}
                                                       THEN {dense} ELSE {control} END AS score
                       FROM fv f JOIN nr n USING ("user")"""),
        ("q1", f"""SELECT *, greatest({P.QUOTA_MIN}, least({P.QUOTA_MAX}, CAST(trunc({max_rec} / n_reasons) AS BIGINT))) AS quota,
                     row_number() OVER (PARTITION BY "user", src ORDER BY score DESC, item) - 1 AS c
                   FROM scored"""),
        ("q2", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS k
                                  FROM q1 WHERE c < quota) WHERE k <= {max_rec}"""),
        ("q3", """SELECT "user", item, src,
                    CASE WHEN c >= 1 THEN -c + score / (c * 10.0) ELSE score END AS score FROM q2"""),
        ("fin", """SELECT "user", item, src, score,
                     row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM q3"""),
    ]


LIKED_VIEWS = ["v_active", "v_play", "v_sub", "v_pair_block", "v_arm_except", "v_item_sim", "v_item_sim_alt", "v_quality",
               "v_profile", "v_block", "v_first_block", "v_gated", "v_segment", "v_visited", "v_impress",
               "v_new_song_weight", "v_item_feat", "v_rate_liked", "v_user_aff", "v_item_aff", "v_pay",
               "v_weights"]


def liked_chain(active_days=P.ACTIVE_DAYS_P4, window=P.IMPRESS_WINDOW_P4, mi=None, caps=P.SEED_CAP_P4,
                budget=P.SEED_BUDGET, item_width=P.ITEM_WIDTH, divisor=P.DIVISOR, remainder=P.REMAINDER):
    mi = P.max_impress() if mi is None else mi
    return [
        ("au", _active(active_days)),
        ("pl", """SELECT "user", item, score FROM (SELECT *, row_number() OVER (PARTITION BY "user", item
                    ORDER BY priority, score DESC) AS rn FROM v_play WHERE "user" IN (SELECT "user" FROM au))
                  WHERE rn = 1"""),
        ("sd", """SELECT p."user", p.item AS seed, p.score FROM pl p
                  WHERE EXISTS (SELECT 1 FROM v_sub s WHERE s."user" = p."user" AND s.item = p.item)
                    AND NOT EXISTS (SELECT 1 FROM v_pair_block b WHERE b."user" = p."user" AND b.item = p.item)"""),
        ("armed", """SELECT s.*, s."user" % 2 = 1 AND s."user" NOT IN (SELECT "user" FROM v_arm_except) AS odd FROM sd s"""),
        # a seed without a base list, or without the list of the user's arm, never gets a rank
        ("rs", """SELECT "user", seed, odd, score AS seed_score,
                    row_number() OVER (PARTITION BY "user" ORDER BY score DESC, seed) - 1 AS i,
                    count(*) OVER (PARTITION BY "user") AS n_seeds FROM armed
                  WHERE seed IN (SELECT item FROM v_item_sim)
                    AND (odd OR seed IN (SELECT item FROM v_item_sim_alt))"""),
        ("lists", """SELECT item AS seed, item2 AS item, sim, pos, true AS odd FROM v_item_sim
                     UNION ALL SELECT item AS seed, item2 AS item, sim, pos, false AS odd FROM v_item_sim_alt"""),
        ("exp", """SELECT rs.*, l.item, l.sim, l.pos FROM rs
                   JOIN lists l ON l.seed = rs.seed AND l.odd = rs.odd"""),
        ("src", """SELECT "user", item, seed AS src FROM (SELECT "user", item, seed, row_number() OVER
                     (PARTITION BY "user", item ORDER BY sim DESC, seed) AS rn FROM exp) WHERE rn = 1"""),
        ("ci", "SELECT item FROM v_item_sim UNION SELECT item2 AS item FROM v_item_sim"),
        ("cov", """SELECT (SELECT count(*) FROM v_quality WHERE item IN (SELECT item FROM ci))
                          > (SELECT count(*) FROM ci) // 2 AS gate_on"""),
        ("excl", _excl(window, mi)),
        ("blk", f"SELECT item FROM v_block UNION SELECT item FROM v_first_block WHERE rank < {P.FIRST_BLOCK_N}"),
        ("elig", """SELECT e.* FROM exp e LEFT JOIN v_quality q ON q.item = e.item
                    WHERE (NOT (SELECT gate_on FROM cov) OR (q.score IS NOT NULL AND q.score <> 0))
                      AND NOT EXISTS (SELECT 1 FROM excl x WHERE x."user" = e."user" AND x.item = e.item)
                      AND e.item NOT IN (SELECT item FROM blk)
                      AND NOT (e.item IN (SELECT item FROM v_gated)
                               AND e."user" NOT IN (SELECT "user" FROM v_segment))"""),
        ("capped", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "user", seed
                         ORDER BY pos) AS rn FROM elig)
                       WHERE rn <= CASE WHEN n_seeds >= {P.SEED_CAP_MANY} THEN {caps[1]} ELSE {caps[0]} END"""),
        ("fr", """SELECT *, CASE WHEN row_number() OVER (PARTITION BY "user", item ORDER BY i) = 1
                               THEN 1 ELSE 0 END AS fresh FROM capped"""),
        ("bud", f"""SELECT * EXCLUDE (fresh, before) FROM (SELECT *, coalesce(sum(fresh) OVER (PARTITION BY "user"
                      ORDER BY i RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fr)
                    WHERE before < {budget}"""),
        ("merged", f"""SELECT b."user", b.item,
                         {fixed_sum(f"b.sim / sqrt(b.i + 1) / (CASE WHEN v.score IS NOT NULL THEN {P.IMPRESS_DECAY} ELSE 1.0 END)")} AS score
                       FROM bud b LEFT JOIN v_visited v ON v."user" = b."user" AND v.item = b.item
                       GROUP BY b."user", b.item"""),
        ("cand", f"""SELECT m."user", m.item, s.src,
                       CASE WHEN coalesce(n.new_song_weight, 0.0) > 1 AND p.avg_pub_time IS NOT NULL
                                 AND CAST(trunc(p.avg_pub_time / 1000000) AS BIGINT) / {P.FRESH_RATIO_DIV} > 1
                            THEN m.score * (CAST(trunc(p.avg_pub_time / 1000000) AS BIGINT) / {P.FRESH_RATIO_DIV})
                                 * n.new_song_weight * {P.FRESH_RATIO_MULT}
                            ELSE m.score END AS recall
                     FROM merged m JOIN src s USING ("user", item)
                     LEFT JOIN v_profile p ON p.item = m.item
                     LEFT JOIN v_new_song_weight n ON n."user" = m."user" """),
        ("aff", aff_cte("cand")),
        ("feat", f"""SELECT c."user", c.item, c.recall, c.src, coalesce(r.rate, {P.RATE_DEFAULT_P4}) AS rate,
                       coalesce(a.lan, 0.0) AS lan, coalesce(a.style, 0.0) AS style,
                       CAST(NULL AS INTEGER[]) AS feats, ib.bits, p.money, p.click, (SELECT w FROM v_weights) AS w
                     FROM cand c
                     LEFT JOIN v_rate_liked r ON r.item = c.item AND r.src = CAST(c.src AS VARCHAR)
                     LEFT JOIN aff a ON a."user" = c."user" AND a.item = c.item
                     LEFT JOIN v_item_feat ib ON ib.item = c.item
                     LEFT JOIN v_pay p ON p.item = c.item"""),
        ("scored", f"""SELECT "user", item, src,
                         recall * {P.BLEND_P2P4} + {lr3(item_width)}
                         + CASE WHEN "user" % {divisor} = {remainder} THEN {pay_boost(*P.PAY_P4)} ELSE 0.0 END
                           AS score
                       FROM feat"""),
        ("div", """SELECT "user", item, src, CASE WHEN c >= 2 THEN score / (c * 1.5) ELSE score END AS score
                   FROM (SELECT *, row_number() OVER (PARTITION BY "user", src ORDER BY score DESC, item) - 1 AS c
                         FROM scored)"""),
        ("fin", """SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM div"""),
    ]
