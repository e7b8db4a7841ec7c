"""DuckDB SQL of the operators' queries, written from their contracts."""

from __future__ import annotations

from fundflow.llm import url_reputation as urls

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# From links (u, v) in l to (id, root) in c: the smallest id reachable.
_COMPONENTS = """
b AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT u AS id, v AS hop FROM b UNION SELECT r.id, b.v FROM r JOIN b ON r.hop = b.u),
c AS (SELECT id, least(id, min(hop)) AS root FROM r GROUP BY id)"""

#: Shingles of two words, all pairs that share one.
NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT p.doc_id AS u, q.doc_id AS v FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id
      GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),{_COMPONENTS}
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
  coalesce(c.root, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.id = s.doc_id"""

#: Cosines of all pairs.
EMBEDDINGS = f"""
WITH RECURSIVE x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
f AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM x
      WHERE e IS NOT NULL AND len(list_filter(e, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        AND len(list_filter(e, lambda v: v <> 0)) > 0),
l AS (SELECT p.vec_id AS u, q.vec_id AS v FROM f p JOIN f q ON p.vec_id < q.vec_id
      WHERE list_dot_product(p.e, q.e) / (p.n * q.n) >= 0.95),{_COMPONENTS},
k AS (SELECT u AS id, count(*) AS n FROM b GROUP BY u)
SELECT x.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.root, x.vec_id) AS component_id,
  coalesce(c.root, x.vec_id) = x.vec_id AS kept
FROM x LEFT JOIN k ON k.id = x.vec_id LEFT JOIN c ON c.id = x.vec_id"""


def _strength(name: str, groups: str) -> str:
    low, high = urls.STRENGTH
    return f"""{name} AS (
  SELECT p, coalesce(least(greatest(CASE WHEN q > 0 THEN p * (1 - p) / q - 1 ELSE {high} END, {low}), {high}), {high}) AS s
  FROM (SELECT p, (KK - N * p * p - (G - 1) * p * (1 - p)) / nullif(N - NN / N, 0) AS q
        FROM (SELECT *, K / N AS p
              FROM (SELECT sum(n)::DOUBLE AS N, sum(k)::DOUBLE AS K, count(*) AS G, sum(n * n)::DOUBLE AS NN,
                      sum(k * k / n::DOUBLE) AS KK FROM {groups}))))"""


def _rule(what: int) -> str:
    """The longest rule that fits (1), or its verdict (0)."""
    whens = ""
    for rule in sorted(urls.RULES, key=lambda r: -len(r[1])):
        host, path = rule[1].split("/", 1)
        whens += (f" WHEN (p.host = '{host}' OR ends_with(p.host, '.{host}')) AND starts_with(path, '/{path}')"
                  f" THEN '{rule[what]}'")
    return f"CASE{whens} END"


#: Shrinkage level by level; the bounds of a host against the cut.
URLS = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {_LOWER}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
label AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
good AS (SELECT page_id, max(good) AS good FROM (SELECT page_id, nullif(regexp_extract(path, '{urls._NUMBER}', 1), '') AS doc FROM p)
         JOIN label ON label.doc_id = CAST(doc AS BIGINT) GROUP BY 1),
h0 AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', '') AS bare
       FROM p LEFT JOIN good USING (page_id) GROUP BY host),
h1 AS (SELECT *, CASE WHEN regexp_matches(bare, '^[\d.]+$') OR regexp_extract(bare, '([^.]+\.[^.]+)$', 1) = '' THEN bare
         WHEN regexp_extract(bare, '([^.]+\.(?:{"|".join(urls.SECOND_LEVEL)})\.[a-z]{{2}})$', 1) <> ''
           THEN regexp_extract(bare, '([^.]+\.(?:{"|".join(urls.SECOND_LEVEL)})\.[a-z]{{2}})$', 1)
         ELSE regexp_extract(bare, '([^.]+\.[^.]+)$', 1) END AS domain FROM h0),
h AS (SELECT host, n, k, domain, CASE WHEN regexp_matches(domain, '^[\d.]+$') OR NOT contains(domain, '.') THEN ''
        ELSE regexp_extract(domain, '^[^.]*\.(.*)$', 1) END AS suffix FROM h1),
hs AS (SELECT * FROM h WHERE n > 0),
ds AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hs GROUP BY 1, 2),
ss AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM ds GROUP BY 1),
{_strength("sh", "hs")},
{_strength("sd", "ds")},
{_strength("sx", "ss")},
m AS (SELECT h.host, h.n, h.k, sh.s AS s, (coalesce(ds.k, 0) + sd.s * (coalesce(ss.k, 0) + sx.s * coalesce(sh.p, 0.5))
          / (coalesce(ss.n, 0) + sx.s)) / (coalesce(ds.n, 0) + sd.s) AS prior
      FROM h LEFT JOIN ds ON ds.domain = h.domain LEFT JOIN ss ON ss.suffix = h.suffix, sh, sd, sx),
v AS (SELECT host, (k + s * prior) / (n + s) AS mean, n + s AS strength FROM m)
SELECT page_id, p.host, path, {_rule(1)} AS rule,
  coalesce({_rule(0)}, CASE WHEN least(mean + {urls.Z} * sqrt(mean * (1 - mean) / (strength + 1)), 1) < {urls.CUT}
    THEN 'block' ELSE 'allow' END) AS verdict, round(mean, 6) AS reputation
FROM p JOIN v ON v.host = p.host"""
