"""SQL for results that plain queries can state, however slow: exact pairs, counts of pairs of words, ordered samples."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS g FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL),
n AS (SELECT rid, doc_id, len(g) AS n, md5(array_to_string(list_sort(g), '|')) AS h FROM s),
e AS (SELECT rid, unnest(g) AS g FROM s),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
l AS (SELECT p.a, p.b, y.h, x.h = y.h AS same FROM p JOIN n x ON x.rid = p.a JOIN n y ON y.rid = p.b WHERE 5 * k >= 4 * (x.n + y.n - k)),
r(rid, root) AS (SELECT rid, rid FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.rid),
c AS (SELECT r.rid, min(n.doc_id) AS class_id FROM r JOIN n ON n.rid = r.root GROUP BY 1),
t AS (SELECT a AS rid, count(*) AS n_links, count(DISTINCT h) FILTER (NOT same) AS n_link_texts, count(*) FILTER (same) AS again FROM l GROUP BY 1)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(t.n_links, 0) AS n_links, coalesce(t.n_link_texts, 0) AS n_link_texts, coalesce(t.again, 0) + 1 AS copies
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""

#: crc32 of a text of ASCII characters, bit by bit.
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"


def _discounts(n1: str, n2: str, n3: str, n4: str) -> str:
    y = f"({n1} / ({n1} + 2.0::DOUBLE * {n2}))"
    d = [f"1 - 2 * {y} * {n2} / {n1}", f"2 - 3 * {y} * {n3} / {n2}", f"CASE WHEN {n3} > 0 THEN 3 - 4 * {y} * {n4} / {n3} ELSE 1.5 END"]
    clip = [f"least(greatest({x}, 0.05::DOUBLE), {k - 0.05}::DOUBLE)" for k, x in enumerate(d, 1)]
    return f"CASE WHEN {n1} > 0 AND {n2} > 0 THEN [0.0::DOUBLE, {', '.join(clip)}] ELSE [0.0::DOUBLE, 0.5, 1.0, 1.5] END"


_FOUR = "count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3, count(*) FILTER (c = 4) AS n4"

LM_SCORE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_CRC} % 7 = 2, false) AS held_out,
        list_append({_WORDS.format(t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, '') AS w FROM documents),
k AS (SELECT rid, held_out, unnest((list_concat([chr(1), chr(1)], w))[1:len(w)]) AS u, unnest((list_concat([chr(1)], w))[1:len(w)]) AS v, unnest(w) AS w FROM d),
c3 AS (SELECT u, v, w, count(*) AS c FROM k WHERE NOT held_out GROUP BY 1, 2, 3),
c2 AS (SELECT v, w, sum(c)::BIGINT AS raw, CASE WHEN v = chr(1) THEN sum(c)::BIGINT ELSE count(*) END AS c FROM c3 GROUP BY 1, 2),
c1 AS (SELECT w, sum(raw)::BIGINT AS seen, count(*) AS c FROM c2 GROUP BY 1),
y3 AS (SELECT u, v, sum(c)::DOUBLE AS total, count(*) FILTER (c = 1) AS k1, count(*) FILTER (c = 2) AS k2, count(*) FILTER (c > 2) AS k3 FROM c3 GROUP BY 1, 2),
y2 AS (SELECT v, sum(c)::DOUBLE AS total, count(*) FILTER (c = 1) AS k1, count(*) FILTER (c = 2) AS k2, count(*) FILTER (c > 2) AS k3 FROM c2 GROUP BY 1),
a3 AS (SELECT {_FOUR} FROM c3), a2 AS (SELECT {_FOUR}, count(*) AS types FROM c2), a1 AS (SELECT {_FOUR}, count(*) AS voc, coalesce(sum(seen), 0)::BIGINT AS n FROM c1),
g AS (SELECT a1.voc, a1.n, a2.types, {_discounts("a3.n1", "a3.n2", "a3.n3", "a3.n4")} AS hi, {_discounts("a2.n1", "a2.n2", "a2.n3", "a2.n4")} AS mid, {_discounts("a1.n1", "a1.n2", "a1.n3", "a1.n4")} AS lo, a1.n1, a1.n2 FROM a1, a2, a3),
f AS (SELECT *, (lo[2] * n1 + lo[3] * n2 + lo[4] * greatest(voc - n1 - n2, 0)) / types AS g1 FROM g),
x AS (SELECT k.rid, coalesce(c1.seen, 0) AS seen, f.n, f.voc,
        greatest(coalesce(c3.c, 0) - f.hi[1 + least(coalesce(c3.c, 0), 3)], 0) / coalesce(y3.total, 1) AS p3,
        CASE WHEN y3.total IS NULL THEN 1 ELSE (f.hi[2] * y3.k1 + f.hi[3] * y3.k2 + f.hi[4] * y3.k3) / y3.total END AS b3,
        greatest(coalesce(c2.c, 0) - f.mid[1 + least(coalesce(c2.c, 0), 3)], 0) / coalesce(y2.total, 1) AS p2,
        CASE WHEN y2.total IS NULL THEN 1 ELSE (f.mid[2] * y2.k1 + f.mid[3] * y2.k2 + f.mid[4] * y2.k3) / y2.total END AS b2,
        greatest(coalesce(c1.c, 0) - f.lo[1 + least(coalesce(c1.c, 0), 3)], 0) / f.types + f.g1 / (f.voc + 1) AS p1
      FROM k CROSS JOIN f LEFT JOIN c1 ON c1.w = k.w LEFT JOIN c2 ON c2.v = k.v AND c2.w = k.w LEFT JOIN c3 ON c3.u = k.u AND c3.v = k.v AND c3.w = k.w LEFT JOIN y2 ON y2.v = k.v LEFT JOIN y3 ON y3.u = k.u AND y3.v = k.v),
s AS (SELECT rid, count(*) AS n_tokens, count(*) FILTER (seen > 0) AS n_known, max(n) AS train_tokens, round(sum(log10((seen + 1) / (n + voc + 1.0::DOUBLE))), 6) AS base_score, round(sum(log10(p3 + b3 * (p2 + b2 * p1))), 6) AS score FROM x GROUP BY 1)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score FROM s JOIN d USING (rid)
"""


def _u(key: str, hexes: int) -> str:
    return f"((CAST(concat('0x', substr(md5({key}), 1, {hexes})) AS BIGINT) + 0.5::DOUBLE) / {16**hexes}::DOUBLE)"


MIXING = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, len({_WORDS.format(t="coalesce(text, '')")}) AS n FROM documents),
so AS (SELECT source, sum(n)::BIGINT AS s FROM d GROUP BY 1),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2.0::DOUBLE * s AS cap FROM so),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
        sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest, 1.5::DOUBLE * sum(s) OVER () AS budget FROM w),
f AS (SELECT *, (budget - spent) / rest AS lev FROM o),
lv AS (SELECT arg_min(lev, cap / w) AS lev FROM f WHERE lev * w <= cap),
g AS (SELECT source, s, CASE WHEN lv.lev IS NULL THEN cap ELSE least(cap, lv.lev * w) END AS target FROM f LEFT JOIN lv ON true),
h AS (SELECT d.source, d.n, count(*) AS m, any_value(g.target - floor(g.target / g.s) * g.s) AS rest FROM d JOIN g ON g.source IS NOT DISTINCT FROM d.source WHERE d.n > 0 GROUP BY 1, 2),
hc AS (SELECT *, (rest - (sum(n * m) OVER (PARTITION BY source ORDER BY n DESC) - n * m)) / (sum(n * n * m) OVER (PARTITION BY source ORDER BY n))::DOUBLE AS c FROM h),
od AS (SELECT source, max(rest) AS rest, arg_max(c, n) FILTER (c * n <= 1) AS c FROM hc GROUP BY 1),
rk AS (SELECT d.*, g.s, g.target, floor(g.target / g.s) AS whole, coalesce(od.rest, 0) AS rest, least(1.0::DOUBLE, coalesce(od.c, 0) * d.n) AS p,
         {_u("concat('9|', coalesce(CAST(d.doc_id AS VARCHAR), '-'), '|', d.n, '|', coalesce(d.source, '-'))", 13)} AS u
       FROM d JOIN g ON g.source IS NOT DISTINCT FROM d.source LEFT JOIN od ON od.source IS NOT DISTINCT FROM d.source),
qk AS (SELECT *, CASE WHEN p = 1 THEN 0 WHEN p > 0 THEN u / (1 - u) * (1 - p) / p END AS q FROM rk),
up AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM qk)
SELECT doc_id, n AS size, s AS source_size, target,
       CAST(CASE WHEN n = 0 THEN 0 ELSE n * (whole + CASE WHEN p = 1 OR p > 0 AND upto - n / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) END AS BIGINT) AS taken, p AS inclusion
FROM up
"""
