"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations


def _folded(col: str) -> str:
    return (f"translate(coalesce({col}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_folded('text')}, '{_WORDS}') AS w FROM documents),
     b AS (SELECT row_number() OVER () AS rid, coalesce(CAST(item_id AS VARCHAR), '') AS item,
                  regexp_extract_all({_folded('text')}, '{_WORDS}') AS w FROM benchmark),
     bw AS (SELECT rid, item, least(10, len(w)) AS k, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS s FROM b),
     bs AS (SELECT item, k, n, s, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY s
                   ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS span FROM bw),
     spans AS (SELECT DISTINCT item, k, span FROM bs WHERE s + k <= n),
     dw AS (SELECT rid, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS s FROM d),
     ds AS (SELECT rid, n, s, k, string_agg(word, ' ') OVER (PARTITION BY rid, k ORDER BY s
                   ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING) AS span
            FROM dw, (SELECT DISTINCT k FROM spans)),
     hit AS (SELECT rid, s, k, span FROM ds WHERE s + k <= n AND span IN (SELECT span FROM spans)),
     words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hit) GROUP BY rid),
     held AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT rid, item FROM hit JOIN spans USING (span)) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN held USING (rid)"""

# crc32 bit by bit: DuckDB has no function of that name
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda r, b: list_reduce(list_prepend(xor(r, b), list_transform(range(8), lambda i: i::BIGINT)),
    lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"""

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id
                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
           FROM conversations WHERE conv_id IS NOT NULL),
     cs AS (SELECT c, c - c % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
     shared AS (SELECT cs.c, t.i, t.r, t.x FROM cs JOIN t ON t.c = cs.base AND t.i < cs.h),
     taken AS (SELECT c, count(*) AS n FROM shared GROUP BY c),
     own AS (SELECT c, t.i - cs.h + coalesce(n, 0) AS i, r, x FROM t JOIN cs USING (c) LEFT JOIN taken USING (c) WHERE t.i >= cs.h),
     turns AS (SELECT c, i + 1 AS d, length(x) AS n, md5(length(r) || ':' || r || x) AS k
               FROM (SELECT * FROM shared UNION ALL SELECT * FROM own)),
     m AS (SELECT c, d, n, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM turns
           UNION ALL SELECT c, 0, 0, '' FROM cs),
     nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n FROM m GROUP BY d, k),
     links AS (SELECT DISTINCT a.d, a.k, b.k AS up FROM m a JOIN m b ON a.c = b.c AND b.d = a.d - 1),
     kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM links GROUP BY 1, 2),
     below AS (SELECT DISTINCT a.d, a.k, b.d AS d2, b.k AS k2 FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d),
     totals AS (SELECT below.d, below.k, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves,
                       CAST(sum((nodes.n_convs - 1) * nodes.n) AS BIGINT) AS saved_tokens
                FROM below JOIN nodes ON nodes.d = d2 AND nodes.k = k2 LEFT JOIN kids ON kids.d = d2 AND kids.k = k2 GROUP BY 1, 2),
     ends AS (SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
              FROM m JOIN (SELECT c, max(d) AS d FROM m GROUP BY c) USING (c, d) GROUP BY d, k)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN totals USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN ends USING (d, k)
     LEFT JOIN links USING (d, k) LEFT JOIN nodes up ON up.d = nodes.d - 1 AND up.k = links.up"""

DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_folded('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
     w AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
     kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
     g AS (SELECT DISTINCT lang, source FROM d),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
     dense AS (SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
                      sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS term_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_n, v
               FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
     p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
                  1 + (1000000000::HUGEINT * (term_n + 5)) // (lang_n + 5 * v) AS q FROM dense),
     pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
               UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50"""
