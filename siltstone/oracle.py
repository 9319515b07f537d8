"""DuckDB SQL for the queries of the library."""

from __future__ import annotations

IMAGES = """images AS (
  SELECT d.doc_id, md5(d.text) AS image_id, d.source, coalesce(l.toxic = 1, false) AS is_unsafe,
    CAST(('0x' || substr(md5(d.text), 1, 2)) AS INTEGER) % 101 AS ae_relevance, CAST(('0x' || substr(md5(d.text), 3, 2)) AS INTEGER) % 101 AS ae_aesthetic,
    CAST(('0x' || substr(md5(d.text), 5, 2)) AS INTEGER) * 8 + 100 AS w, CAST(('0x' || substr(md5(d.text), 7, 2)) AS INTEGER) * 8 + 100 AS h
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""

#: Votes of the MD5 prefixes of the distinct words, one bit of the hash each; the four lowest bits are 0.
HASHED = """words AS (
  SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS w FROM documents) WHERE w <> ''
), votes AS (
  SELECT doc_id, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) AS x FROM words
), bits AS (
  SELECT doc_id, i, sum(((x >> i) & 1) * 2 - 1) > 0 AS b FROM votes, range(60) r(i) GROUP BY doc_id, i
), hashed AS (
  SELECT doc_id, CAST(sum(CASE WHEN NOT b THEN 0::HUGEINT WHEN i = 59 THEN -(1::HUGEINT << 63) ELSE 1::HUGEINT << CAST(i + 4 AS INTEGER) END) AS BIGINT) AS h FROM bits GROUP BY doc_id
), vals AS (SELECT DISTINCT h FROM hashed)"""


def _pairs(block: str) -> str:
    return f"pairs AS (SELECT x.h AS a, y.h AS b, CAST(bit_count(xor(x.h, y.h)) AS INTEGER) AS distance FROM vals x JOIN vals y ON x.h < y.h AND {block} AND bit_count(xor(x.h, y.h)) <= 3)"


SAME_PREFIX = "(x.h >> 48) = (y.h >> 48)"
LINKED = """reach AS (
  SELECT h AS id, h AS other FROM vals
  UNION SELECT r.id, CASE WHEN p.a = r.other THEN p.b ELSE p.a END FROM reach r JOIN pairs p ON p.a = r.other OR p.b = r.other
), cluster AS (SELECT id AS h, min(other) AS cluster FROM reach GROUP BY id
), sized AS (SELECT hashed.doc_id, hashed.h, cluster, count(*) OVER (PARTITION BY cluster) AS n FROM hashed JOIN cluster USING (h))"""

SIZES = "(SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) * 113 + 100 AS w, l_linenumber * 811 + CAST(l_quantity AS INTEGER) * 7 AS h FROM lineitem)"


def _policy(scale: str) -> str:
    return f"""(SELECT *, CASE WHEN up THEN 1024.0::DOUBLE / short WHEN down THEN {scale} ELSE 1.0::DOUBLE END AS s FROM
      (SELECT *, least(w, h) AS short, greatest(w, h) AS long, least(w, h) < 1024 AS up, least(w, h) > 2048 OR greatest(w, h) > 4096 AS down FROM {SIZES}))"""


ACTION = "CASE WHEN up THEN 'upscale_to_1024' WHEN down THEN 'downscale_to_2048' ELSE 'keep' END"
KERNEL = "CASE WHEN up THEN 'BICUBIC' WHEN down AND s < 0.5 THEN 'AREA' WHEN down THEN 'BICUBIC' ELSE 'KEEP' END"

UPSERT_INPUT = """base AS (
  SELECT doc_id AS image_id, CASE WHEN doc_id % 4 <> 0 THEN 'old ' || source ELSE '' END AS caption, CASE WHEN doc_id % 3 <> 0 THEN lang END AS tags FROM documents
), fresh AS (
  SELECT doc_id AS image_id, CASE WHEN doc_id % 5 <> 0 THEN 'new ' || quality ELSE ' ' END AS c, CASE WHEN doc_id % 7 <> 0 THEN 'fresh' END AS t FROM labels
)"""


def _upsert(take_c: str, take_t: str) -> str:
    return f"""WITH {UPSERT_INPUT} SELECT b.image_id, CASE WHEN {take_c} THEN f.c ELSE b.caption END AS caption, CASE WHEN {take_t} THEN f.t ELSE b.tags END AS tags
      FROM base b LEFT JOIN fresh f USING (image_id)"""


HAS_C, HAS_T = "coalesce(trim(f.c), '') <> ''", "coalesce(trim(f.t), '') <> ''"

SPECIES = """parts AS (
  SELECT CAST(p_partkey AS VARCHAR) AS image_id, p_partkey, list_concat(string_split(lower(p_name), ' '), [lower(p_brand)]) AS names FROM part
), kept AS (
  SELECT image_id, p_partkey, list_transform(names, lambda x: CASE x WHEN 'brand#1' THEN 'brand one' WHEN 'brand#2' THEN 'brand two' WHEN 'brand#11' THEN 'brand eleven' ELSE x END) AS names
  FROM parts WHERE NOT list_has_any(names, ['brand#3', 'brand#33'])
), named AS (SELECT DISTINCT image_id, p_partkey, unnest(names) AS pokemon FROM kept)"""

RANKED = """ranked AS (SELECT pokemon, CAST(row_number() OVER (ORDER BY count DESC, pokemon) AS INTEGER) AS rank FROM (SELECT pokemon, count(*) AS count FROM named GROUP BY pokemon)),
quota AS (SELECT pokemon, rank, CASE WHEN rank <= 5 THEN 2 WHEN rank <= 20 THEN 1 END AS need FROM ranked WHERE rank <= 20)"""

SQL = {
    "gate_topn": f"""WITH {IMAGES} SELECT doc_id, image_id, ae_relevance, ae_aesthetic, round(e, 6) AS effective, w || 'x' || h AS image_size FROM
        (SELECT *, ae_aesthetic * least(1.0::DOUBLE, greatest(0.85::DOUBLE, 0.85::DOUBLE + (1.0::DOUBLE - 0.85::DOUBLE) * (ae_relevance - 60.0::DOUBLE) / 40.0::DOUBLE)) AS e
         FROM images WHERE NOT is_unsafe AND ae_relevance >= 60 AND ae_aesthetic >= 60) ORDER BY e DESC, doc_id LIMIT 100""",
    "flag_antifilter": f"WITH {IMAGES} SELECT doc_id, image_id FROM images WHERE NOT is_unsafe",
    "truthy_normalize": """SELECT doc_id, said, lower(trim(said)) IN ('true', '1', '1.0', 'yes', 'y', 't') AS flag
        FROM (SELECT doc_id, [' TRUE ', '1', 't', '1.0', 'false', '', 'no', 'Y'][doc_id % 8 + 1] AS said FROM labels)""",
    "exact_content_dup": """SELECT * FROM (SELECT doc_id, md5(text) AS image_id, count(*) OVER w AS members, min(doc_id) OVER w AS first_id FROM documents WINDOW w AS (PARTITION BY md5(text))) WHERE members > 1""",
    "near_dup_pairs": f"WITH {HASHED}, {_pairs(SAME_PREFIX)} SELECT * FROM pairs",
    "near_dup_pairs_exact": f"WITH {HASHED}, {_pairs('true')} SELECT * FROM pairs",
    "near_dup_clusters": f"WITH RECURSIVE {HASHED}, {_pairs(SAME_PREFIX)}, {LINKED} SELECT doc_id, h AS hash, cluster FROM sized WHERE n >= 2",
    "near_dup_annotate": f"""WITH RECURSIVE {IMAGES}, {HASHED}, {_pairs(SAME_PREFIX)}, linked_rows AS (SELECT hashed.* FROM hashed JOIN images USING (doc_id) WHERE NOT is_unsafe),
      svals AS (SELECT DISTINCT h FROM linked_rows), spairs AS (SELECT pairs.* FROM pairs WHERE a IN (SELECT h FROM svals) AND b IN (SELECT h FROM svals)),
      sreach AS (SELECT h AS id, h AS other FROM svals UNION SELECT r.id, CASE WHEN p.a = r.other THEN p.b ELSE p.a END FROM sreach r JOIN spairs p ON p.a = r.other OR p.b = r.other),
      member AS (SELECT r.doc_id, r.h, c.cluster, i.image_id, i.ae_aesthetic AS aes, i.w::BIGINT * i.h AS res, count(*) OVER (PARTITION BY c.cluster) AS n
        FROM linked_rows r JOIN (SELECT id, min(other) AS cluster FROM sreach GROUP BY id) c ON c.id = r.h JOIN images i USING (doc_id)),
      best AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY aes DESC, res DESC, doc_id) AS place, max(aes) OVER (PARTITION BY cluster) AS top FROM member WHERE n >= 2),
      ties AS (SELECT cluster, count(*) AS tied FROM best WHERE aes = top GROUP BY cluster), rep AS (SELECT cluster, h AS rh, image_id AS rep_image_id FROM best WHERE place = 1)
      SELECT doc_id, rep_image_id, CASE WHEN place = 1 THEN '' WHEN h = rh THEN 'identical' ELSE 'near' END AS dupe_flag, CAST(bit_count(xor(h, rh)) AS INTEGER) AS ham_to_rep, place = 1 AS kept,
        CASE WHEN place > 1 THEN '' WHEN tied > 1 THEN 'highest_resolution' ELSE 'highest_aesthetic' END AS keep_reason
      FROM best JOIN rep USING (cluster) JOIN ties USING (cluster)""",
    "embedding_bit_pairs": """WITH bits AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
      codes AS (SELECT vec_id, b, array_to_string(b, '') AS s, substr(array_to_string(b, ''), 1, 4) AS block FROM bits)
      SELECT x.vec_id AS vec_a, y.vec_id AS vec_b, CAST(hamming(x.s, y.s) AS INTEGER) AS distance FROM codes x JOIN codes y ON x.block = y.block AND x.vec_id < y.vec_id WHERE hamming(x.s, y.s) BETWEEN 1 AND 20""",
    "url_parts": r"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS domain,
        CASE WHEN lower(regexp_extract(split_part(url, '?', 1), '(\.[^./]*)$', 1)) IN ('.jpg', '.jpeg', '.png', '.webp') THEN lower(regexp_extract(split_part(url, '?', 1), '(\.[^./]*)$', 1)) ELSE '.jpg' END AS ext FROM pages""",
    "url_first_seen": """SELECT min(page_id) AS page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS domain FROM pages GROUP BY 2, split_part(url, '?', 1)""",
    "resize_policy": f"""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN up OR down THEN round_even(w * s, 0) ELSE w END AS INTEGER) AS new_w, CAST(CASE WHEN up OR down THEN round_even(h * s, 0) ELSE h END AS INTEGER) AS new_h,
        round(s, 6) AS scale, {KERNEL} AS kernel, {ACTION} AS action, round(long::DOUBLE / short, 4) AS ar FROM {_policy('2048.0::DOUBLE / short')}""",
    "resize_actions": f"SELECT {ACTION} AS action, {KERNEL} AS kernel, count(*) AS n FROM {_policy('least(2048.0::DOUBLE / short, 4096.0::DOUBLE / long)')} GROUP BY ALL",
    "band_quota": r"""SELECT p_partkey, ['band1', 'band2', 'band3', 'band4'][p_size % 4 + 1] AS band, least(p_size, 20) AS quota,
        lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(4, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') || '_' || regexp_replace(replace(trim(p_name), ' ', '_'), '[^A-Za-z0-9_\-]', '', 'g') AS folder FROM part""",
    "quota_take": """WITH l AS (SELECT l_partkey, l_returnflag = 'A' AS present, l_orderkey * 10 + l_linenumber AS line FROM lineitem), n AS (SELECT l_partkey, line, row_number() OVER (PARTITION BY l_partkey ORDER BY line) AS i FROM l WHERE NOT present)
      SELECT n.l_partkey, n.line FROM n JOIN part p ON p.p_partkey = n.l_partkey LEFT JOIN (SELECT l_partkey, count(*) AS have FROM l WHERE present GROUP BY 1) h ON h.l_partkey = n.l_partkey
      WHERE n.i <= greatest(0, p_size % 5 + 2 - coalesce(have, 0))""",
    "caption_upsert": _upsert(HAS_C, HAS_T),
    "upsert_only_missing": _upsert(f"{HAS_C} AND coalesce(trim(b.caption), '') = ''", f"{HAS_T} AND coalesce(trim(b.tags), '') = ''"),
    "upsert_require_all": _upsert(f"{HAS_C} AND {HAS_T}", f"{HAS_C} AND {HAS_T}"),
    "semi_mark": "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent FROM customer",
    "anti_drop": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "contains_drop": """WITH d AS (SELECT doc_id, md5(text) AS h, CASE WHEN doc_id % 5 = 0 THEN 'ocr' ELSE 'nsfw' END AS stage FROM documents)
      SELECT doc_id, stage FROM d WHERE NOT (stage = 'nsfw' AND h IN (SELECT h FROM d WHERE doc_id % 3 = 0))""",
    "md5_tokens": "SELECT DISTINCT lower(regexp_extract(text, '([a-fA-F0-9]{32})', 1)) AS id FROM documents WHERE regexp_matches(text, '[a-fA-F0-9]{32}')",
    "alias_species": f"WITH {SPECIES} SELECT image_id, array_to_string(list_distinct_ordered, ', ') AS species FROM (SELECT image_id, list_filter(names, lambda x, i: list_position(names, x) = i) AS list_distinct_ordered FROM kept)",
    "deny_species": f"WITH {SPECIES} SELECT image_id FROM parts WHERE list_has_any(names, ['brand#3', 'brand#33'])",
    "species_counts": f"WITH {SPECIES} SELECT pokemon, count(*) AS count FROM named GROUP BY pokemon HAVING count(*) >= 2",
    "rank_quota": f"WITH {SPECIES}, {RANKED} SELECT pokemon, rank, need FROM quota",
    "quota_split": f"""WITH RECURSIVE {SPECIES}, {RANKED},
      drawn AS (SELECT rank, need, list(image_id ORDER BY md5('42:' || image_id), image_id) AS ids FROM quota JOIN named USING (pokemon) GROUP BY rank, need),
      walk AS (SELECT 0 AS rank, []::VARCHAR[] AS taken UNION ALL SELECT d.rank, list_concat(w.taken, list_filter(d.ids, lambda x: NOT list_contains(w.taken, x))[1:d.need]) FROM walk w JOIN drawn d ON d.rank = w.rank + 1),
      chosen AS (SELECT unnest(taken) AS image_id FROM (SELECT taken FROM walk ORDER BY rank DESC LIMIT 1))
      SELECT image_id, CASE WHEN image_id IN (SELECT image_id FROM chosen) THEN 'val' ELSE 'train' END AS split FROM kept""",
    "split_fraction": f"""WITH {SPECIES}, c AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'val' ELSE 'train' END AS split, pokemon, count(*) AS count FROM named GROUP BY ALL)
      SELECT split, pokemon, count, round(count / sum(count) OVER (PARTITION BY split), 9) AS fraction FROM c""",
    "split_totals": f"WITH {SPECIES} SELECT count(*) AS total, count(*) FILTER (p_partkey % 10 <> 0) AS train, count(*) FILTER (p_partkey % 10 = 0) AS val FROM kept",
    "manifest_sha": f"""WITH {SPECIES} SELECT CASE WHEN p_partkey % 10 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS count, sha256(string_agg(image_id, chr(10) ORDER BY image_id) || chr(10)) AS sha256 FROM kept GROUP BY 1""",
    "tags_json_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "score_parse": """WITH r AS (SELECT event_id, event_id % 5 AS kind, greatest(0, least(100, CAST(round_even(CAST(CAST(round(value, 2) AS DECIMAL(12,2)) AS DOUBLE), 0) AS INTEGER))) AS v FROM events)
      SELECT event_id, CASE kind WHEN 0 THEN v WHEN 1 THEN 90 WHEN 4 THEN 1 END AS relevance, CASE kind WHEN 0 THEN v WHEN 1 THEN v WHEN 4 THEN 0 END AS aesthetic FROM r""",
    "sentence_sanitize": r"""WITH a AS (SELECT conv_id, turn, regexp_replace(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '^`+|`+$', '', 'g'), '^"+|"+$', '', 'g') AS s FROM conversations),
      b AS (SELECT conv_id, turn, regexp_replace(regexp_replace(s, '^''+|''+$', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g') AS s FROM a),
      c AS (SELECT conv_id, turn, trim(CASE WHEN regexp_matches(s, '[.!?] +') THEN regexp_extract(s, '^(.*?[.!?]) +', 1) ELSE s END) AS s FROM b),
      d AS (SELECT conv_id, turn, CASE WHEN regexp_matches(s, '[.!?]$') THEN s ELSE s || '.' END AS s FROM c)
      SELECT conv_id, turn, CASE WHEN len(list_filter(string_split(s, ' '), lambda x: x <> '')) > 28 THEN regexp_replace(array_to_string(list_filter(string_split(s, ' '), lambda x: x <> '')[1:28], ' '), '[,;]+$', '') || '.' ELSE s END AS sentence FROM d""",
    "snake_tokens": "SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(p_type || '--' || p_brand)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS token FROM part",
    "hybrid_compose": """WITH t AS (SELECT p_partkey, p_size, 'A ' || p_name || '.' AS s, replace(regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '_', ' ') AS b,
        CASE WHEN p_size % 2 = 0 THEN 'shiny ' ELSE '' END AS sh, string_split(p_name, ' ') AS f, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS pose FROM part)
      SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN s ELSE s || ' | ' || sh || CASE p_partkey % 4 WHEN 0 THEN 'mega ' || b || ' x' WHEN 1 THEN 'hisui ' || b WHEN 2 THEN 'odd_form ' || b ELSE b END
        || ', ' || array_to_string(list_filter(f, lambda x, i: list_position(f, x) = i), ', ') || ', ' || pose || ', multiple' || CASE WHEN p_size > 25 THEN ', multi_panel' ELSE '' END END AS hybrid_caption FROM t""",
    "screen_nameless": "SELECT p_partkey FROM part WHERE p_partkey % 6 IN (0, 1, 2, 3)",
    "max_tag_score": """WITH e AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), m AS (SELECT vec_id, v, greatest(0.0::DOUBLE, list_max(v)) AS best FROM e)
      SELECT vec_id, round(best, 6) AS score, best >= 0.2 AS is_unsafe, CASE WHEN best >= 0.01 THEN 't' || (list_position(v, best) - 1) ELSE '' END AS best_tag FROM m""",
    "seeded_shuffle": "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50",
    "shard_assign": """SELECT doc_id, position, CAST(position // CAST(ceil((SELECT count(*) FROM documents) / 16.0) AS BIGINT) AS INTEGER) AS shard FROM
      (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents)""",
    "status_counts": """SELECT CASE WHEN page_id % 7 = 0 THEN 'http_fail' WHEN page_id % 5 = 0 THEN 'invalid_or_corrupt' WHEN page_id % 11 = 0 THEN 'duplicate_existing' WHEN page_id % 13 = 0 THEN 'io_error' ELSE 'saved' END AS status, count(*) AS n FROM pages GROUP BY 1""",
    "polygon_filter": """WITH b AS (SELECT l_orderkey, l_linenumber, l_discount, l_quantity AS w, l_linenumber * 5.0::DOUBLE AS h, l_tax * 100 AS k FROM lineitem),
      p AS (SELECT *, w * h AS area, 4 * pi() * (w * h) / pow(2 * (w + sqrt(k * k + h * h)), 2) AS circ, (CAST(trunc(w + k) AS INTEGER) + 1)::DOUBLE / (CAST(trunc(h) AS INTEGER) + 1) AS ar FROM b)
      SELECT l_orderkey, l_linenumber, round(area, 4) AS area, l_discount AS conf FROM p WHERE area >= 150 AND l_discount >= 0.035 AND NOT (area > 0 AND circ >= 0.78 AND ar BETWEEN 0.75 AND 1.33)""",
    "size_parse": "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 AND p_size > 0 AND p_partkey > 0 THEN p_size END AS w, CASE WHEN p_partkey % 4 = 0 AND p_size > 0 AND p_partkey > 0 THEN CAST(p_partkey AS INTEGER) END AS h FROM part",
    "keyed_results": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 2 END AS result FROM customer",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
