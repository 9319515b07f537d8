"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

OP3 = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS p, string_split(text, chr(10))[i] AS x
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), worded AS (
  SELECT doc_id, p, x FROM lines WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT doc_id, p AS p0, lead(p, 1) OVER w AS p1, lead(p, 2) OVER w AS p2, x AS x0, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT *, row_number() OVER (PARTITION BY x0, x1, x2 ORDER BY doc_id, p0) AS nth FROM windows WHERE x2 IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, unnest([p0, p1, p2]) AS p FROM later WHERE nth > 1
), stays AS (
  SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.p) AS text, bool_or(regexp_matches(l.x, '[^\x20\x09-\x0D]')) AS worded
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p GROUP BY l.doc_id
), counted AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS removed FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(c.n, 0)::BIGINT AS n_removed, coalesce(c.removed, '') AS removed,
  CASE WHEN c.n IS NULL THEN d.text WHEN s.worded THEN s.text ELSE '' END AS text
FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN stays s USING (doc_id)
"""


LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = rf"regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH dw AS (SELECT doc_id, {ALNUM} AS w FROM documents), iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[i:i + 7], ' ') AS s, least(8, len(w)) AS n FROM iw, unnest(range(1, greatest(1, len(w) - 7) + 1)) u(i) WHERE len(w) > 0),
places AS (SELECT doc_id, i, l.n, array_to_string(w[i:i + l.n - 1], ' ') AS s FROM dw, (SELECT DISTINCT n FROM win) l, unnest(range(1, len(w) - l.n + 2)) u(i)),
hits AS (SELECT doc_id, i, p.n, item FROM places p JOIN win ON p.s = win.s AND p.n = win.n),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) u(j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM dw LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages), g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(body) AS payload_digest, CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to FROM g
"""

OP8 = rf"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM dw, unnest(range(1, greatest(1, len(w) - 3) + 1)) u(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_have JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.other OR l.b = r.other)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) m ON m.id = d.doc_id
"""


def op6() -> str:
    from siltstone.llm.urls import DEFAULT, PATTERN_RULES, SITE_RULES

    def low(x: str) -> str:
        return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    fits = " ".join(f"WHEN ends_with('.' || host, '.{r.split('/', 1)[0]}') AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'" for _, r in sorted(SITE_RULES, key=lambda x: -len(x[1])))
    says = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in SITE_RULES)
    blocked = " OR ".join(f"regexp_matches(low, '{p}')" for _, p, _ in PATTERN_RULES)
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM pages), h AS (SELECT page_id, {low("url")} AS low, {low("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")} AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE {fits} END AS rule FROM h)
SELECT page_id, host, path, rule, CASE rule {says} ELSE CASE WHEN {blocked} THEN 'block' ELSE '{DEFAULT}' END END AS verdict FROM r
"""


OP7 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS m FROM documents),
h AS (SELECT doc_id, source, size, substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR), m)), 1, 15) AS h FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM h GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][i % 3 + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM s),
-- In the order of cap / weight the full sources come first; the level is that of the first source it does not fill.
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held, sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, sum(source_size) OVER () * 1.5::DOUBLE AS want FROM w),
l AS (SELECT min_by((want - held) / open, (cap / w, i)) AS level FROM f WHERE (want - held) / open * w <= cap),
t AS (SELECT source, source_size, i, least(cap, w * coalesce(level, 'infinity'::DOUBLE)) AS target FROM w, l),
p AS (SELECT h.doc_id, h.size, t.source_size, t.target, i, sum(h.size) OVER (PARTITION BY h.source ORDER BY h.h, h.doc_id ROWS UNBOUNDED PRECEDING) - h.size / 2.0::DOUBLE AS middle FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CASE WHEN size > 0 AND middle <= target THEN middle / target END AS a, CASE WHEN size > 0 AND source_size + middle <= target THEN (source_size + middle) / target END AS b FROM p),
-- The inverse of the integral of the schedules 1..1, 2..0.5 and 0.5..2.
x AS (SELECT *, [1.0::DOUBLE, 2.0::DOUBLE, 0.5::DOUBLE][i % 3 + 1] AS c, [0.0::DOUBLE, -1.5::DOUBLE, 1.5::DOUBLE][i % 3 + 1] AS k FROM n)
SELECT doc_id, size, source_size, target, ((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER) * size AS taken,
  round(CASE WHEN a IS NULL OR k = 0 THEN a ELSE least(1.0, greatest(0.0, (sqrt(c * c + 2 * k * 1.25::DOUBLE * a) - c) / k)) END, 9) AS first_position,
  round(CASE WHEN b IS NULL OR k = 0 THEN b ELSE least(1.0, greatest(0.0, (sqrt(c * c + 2 * k * 1.25::DOUBLE * b) - c) / k)) END, 9) AS second_position
FROM x
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2, "op3_line_dedup": OP3, "op5_warc": OP5, "op6_url_filter": op6(), "op7_mixing": OP7, "op8_near_duplicates": OP8}
