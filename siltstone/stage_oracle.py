"""DuckDB SQL for the queries of ``stage_queries``."""

from __future__ import annotations

#: The pictures drawn for nations: m eighths of them are black; some files are cut off, one is missing.
PICTURES = "p AS (SELECT CAST(n_nationkey AS BIGINT) AS k, n_nationkey % 8 AS m, n_nationkey <> 20 AS there, n_nationkey % 8 = 7 AS cut, n_nationkey % 9 = 0 AS unsafe FROM nation)"
PART_NAME = "replace(p_name, ' ', '_')"
SNAKE_NAME = "regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"

SQL = {
    "names_and_paths": f"""WITH x AS (SELECT p_partkey, p_name, p_partkey % 3 AS a, p_partkey % 4 AS u, {PART_NAME} AS n, ['.PNG', '.jpeg', '', '.tar.gz', '.bmp'][p_partkey % 5 + 1] AS e, ['.png', '.jpeg', '', '.gz', '.bmp'][p_partkey % 5 + 1] AS suffix,
        ['/data/raw/', 'imgs/a.b/', ''][p_partkey % 3 + 1] AS f FROM part)
      SELECT p_partkey, p_name || ' fan art' AS query, n || e AS file, ['raw', 'a.b', NULL][a + 1] AS folder, CASE WHEN e = '.tar.gz' THEN n || '.tar' ELSE n END AS stem, suffix, CASE WHEN a = 0 THEN '' ELSE '/root/' END || f || n || e AS resolved,
        CASE WHEN u = 0 THEN '.png' WHEN suffix NOT IN ('', '.gz') THEN suffix WHEN a = 0 THEN '.png' ELSE '.jpg' END AS ext FROM x""",
    "safe_casts": """SELECT p_partkey, [7, 0, 0, 0, -3, 1000, 12][p_partkey % 7 + 1] AS whole, [7.9::DOUBLE, -1, -1, -1, -3, 1000, 12][p_partkey % 7 + 1] AS number, ['7.9', 'x', '', '', '-3', '1e3', '12'][p_partkey % 7 + 1] AS said,
        [' 7.9 ', 'x', NULL, NULL, '-3', '1e3', '12'][p_partkey % 7 + 1] AS kept FROM part""",
    "stamps": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ts, strftime(o_orderdate, 'scr_%Y%m%d_%H%M%S') AS run FROM orders",
    "hit_texts": """WITH e AS (SELECT vec_id, label, list_transform([1, 2, 3], lambda i: {'s': CASE WHEN embedding[i] > -0.05 THEN -round(CAST(embedding[i] AS DOUBLE), 2) END, 'i': i}) AS v FROM embeddings)
      SELECT vec_id, array_to_string(list_transform(list_sort(list_filter(v, lambda x: -x.s >= 0.01)), lambda x: ['a', 'b', 'c'][x.i] || ':' || printf('%.3f', -x.s)), ';') AS hits, 'ab|' || label || '|x y' AS names FROM e""",
    "last_blocks": """SELECT p_partkey, p_partkey % 4 < 2 AS has_block, CASE WHEN p_partkey % 4 < 2 THEN p_name || '.' END AS sentence, CASE WHEN p_partkey % 4 < 2 THEN 'sitting_down' END AS pose, CASE WHEN p_partkey % 4 < 2 THEN 'single' END AS subjects FROM part""",
    "coerced_tags": f"""WITH x AS (SELECT p_partkey, p_name, p_partkey % 7 <> 0 AS ok FROM part)
      SELECT p_partkey, CASE WHEN ok THEN {SNAKE_NAME} || '|mew_two' END AS names, CASE WHEN ok THEN CASE WHEN p_partkey % 2 = 0 THEN 'mega_x|-' ELSE '-|-' END END AS forms, CASE WHEN ok THEN p_partkey % 3 = 0 END AS shiny,
        CASE WHEN ok THEN 'chef_hat|-|-' END AS props, CASE WHEN ok THEN 2 END AS n_composition, CASE WHEN ok THEN CASE WHEN p_partkey % 3 = 1 THEN 'multiple' ELSE 'single' END END AS subjects, CASE WHEN ok THEN true END AS trimmed,
        CASE WHEN ok THEN lower(p_name) || '|mew two|' || lower(p_name) ELSE '' END AS listed FROM x""",
    "confidences": "SELECT p_partkey, [0.25::DOUBLE, 0.5, 0.75, 1, 1, 1][p_partkey % 6 + 1] AS conf FROM part",
    "data_urls": "SELECT page_id, md5('data:image/' || ['png', 'webp', 'jpeg'][page_id % 3 + 1] || ';base64,' || to_base64(encode(url))) AS digest FROM pages",
    "aspects": """WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) % 37 AS w, l_linenumber AS h FROM lineitem)
      SELECT l_orderkey, l_linenumber, CASE WHEN least(w, h) > 0 THEN round(greatest(w, h)::DOUBLE / least(w, h), 6) ELSE 0 END AS aspect, CASE WHEN w > 0 AND h > 0 THEN w || 'x' || h ELSE '' END AS size FROM x""",
    "polygon_measures": """WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS w, l_linenumber * 10.0::DOUBLE AS h FROM lineitem)
      SELECT l_orderkey, l_linenumber, round(3 * w * h, 4) AS area, round(12 * pi() * w * h / pow(4 * w + 4 * h, 2), 6) AS circularity, round((trunc(2 * w) + 1) / (trunc(2 * h) + 1), 6) AS aspect, round(3 / 3.5::DOUBLE, 6) AS solidity FROM x""",
    "base_projection": """SELECT CASE WHEN c_custkey % 4 = 0 THEN '/a/' ELSE '/b/' END || c_custkey AS path, 'u' AS source_url, CASE WHEN c_custkey % 5 > 0 THEN (c_custkey % 5 * 100) || 'x64' ELSE '' END AS image_size, c_custkey % 50 AS ae_relevance, c_custkey % 30 AS ae_aesthetic,
        CAST(c_custkey AS VARCHAR) AS image_id, '0f' AS phash FROM customer WHERE c_custkey % 3 <> 0""",
    "source_choice": """WITH x AS (SELECT c_custkey, c_custkey % 40 * 100 + 100 AS w, c_custkey % 7 * 300 + 200 AS h, CASE WHEN c_custkey % 10 IN (2, 4) THEN 'inpainted' WHEN c_custkey % 5 <> 0 THEN 'raw' END AS used FROM customer),
      y AS (SELECT *, CASE WHEN c_custkey % 11 = 0 THEN 'skipped_nsfw' WHEN used IS NULL THEN 'missing' WHEN c_custkey % 13 = 0 THEN 'error_open' ELSE 'ok' END AS status, least(w, h) < 1024 AS up, 1024.0::DOUBLE / least(w, h) AS s FROM x)
      SELECT c_custkey, used AS source_used, CASE used WHEN 'inpainted' THEN '/paint/' || c_custkey WHEN 'raw' THEN '/root/raw/' || c_custkey END AS source_path, status, CASE WHEN status = 'missing' THEN 'source not found' ELSE '' END AS status_msg,
        CASE WHEN status = 'ok' THEN CAST(CASE WHEN up THEN round_even(w * s, 0) ELSE w END AS INTEGER) END AS new_w, CASE WHEN status = 'ok' THEN CAST(CASE WHEN up THEN round_even(h * s, 0) ELSE h END AS INTEGER) END AS new_h,
        CASE WHEN status = 'ok' THEN CASE WHEN up THEN 'upscale_to_1024' ELSE 'keep' END END AS resize_action, CASE WHEN status = 'ok' THEN round(greatest(w, h)::DOUBLE / least(w, h), 6) END AS ar_before FROM y""",
    "hash_inputs": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'raw/' || c_custkey ELSE ['r', NULL, NULL, 'x'][c_custkey % 4 + 1] END AS path FROM customer",
    "unique_ids": """WITH x AS (SELECT CAST(l_partkey AS VARCHAR) AS image_id, CASE WHEN l_linenumber = 1 THEN 'val' ELSE 'train' END AS split, l_orderkey || '/' || l_linenumber AS path FROM lineitem)
      SELECT image_id, split, path FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY split <> 'train', md5('42:' || path)) AS n FROM x) WHERE n = 1""",
    "unflag_keys": "SELECT c_custkey, c_custkey % 4 = 2 AS has_ocr FROM customer",
    "row_upsert": """SELECT n_nationkey, CASE WHEN n_name = 'NATION_7' THEN 'changed.png' ELSE lower(n_name) || '.png' END AS path FROM nation
      UNION ALL SELECT n_nationkey + 1000, 'changed.png' FROM nation WHERE n_name = 'NATION_7'""",
    "ledger_shape": """SELECT CAST(c_custkey AS VARCHAR) AS image_id, c_name AS species, c_mktsegment AS band, 'nsfw' AS stage, 'score' AS drop_reason, CAST(NULL AS VARCHAR) AS url, 'run1' AS run_id FROM customer WHERE c_custkey % 9 = 0""",
    "id_union": "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 10 = 0 UNION SELECT 'x' UNION SELECT '7'",
    "quota_bounds": "SELECT count(*) AS n, sum(least(p_size, 7))::BIGINT AS target FROM part WHERE p_partkey % 4 = 2",
    "quota_table": """SELECT n_nationkey + 1 AS "Ranking", n_name AS "Name", n_nationkey % 4 AS q_r_base, CASE WHEN n_nationkey % 2 = 0 THEN 'band1' ELSE 'band2' END AS band_label FROM nation ORDER BY band_label, "Ranking" LIMIT 10""",
    "resolved_files": """SELECT CASE WHEN c_custkey % 10 = 0 THEN 'no' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS image_id,
        CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN regexp_matches(CAST(c_custkey AS VARCHAR), '[25]') THEN '/x/' || c_custkey || '.webp' WHEN c_custkey % 3 = 0 THEN '/z/' || c_custkey || '.png' ELSE '/y/' || c_custkey || '.jpg' END AS path FROM customer WHERE c_custkey % 2 = 0""",
    "mask_siblings": "SELECT '/m/' || c_custkey || '_mask.png' AS mask, '/m/' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '.PNG' ELSE '.jpg' END AS image FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0",
    "csv_round_trip": "SELECT c_custkey, length(c_name)::INTEGER + 12 AS n, true AS quoted, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance, c_custkey % 2 = 0 AS even FROM customer",
    "text_csv": "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '' END AS name FROM nation",
    "versions": "SELECT n_nationkey, 'one' AS version FROM nation UNION ALL SELECT n_nationkey, 'now' FROM nation WHERE n_nationkey < 10",
    "audit_reruns": "SELECT n_nationkey, 'ocr' AS stage, CASE WHEN n_nationkey < 5 THEN 'r1' ELSE 'r2' END AS run_id FROM nation WHERE n_nationkey < 5 OR n_nationkey > 20",
    "attempt_log": """SELECT ['saved', 'http_fail', 'attempt'][page_id % 3 + 1] AS status, '2024-05-06T07:08:09Z' AS ts, count(*) AS n, count(*) FILTER (page_id % 2 = 0) AS ranked FROM pages GROUP BY 1""",
    "stream_first_seen": "SELECT DISTINCT event_type AS species, 'http://a/' || user_id AS url FROM events",
    "stream_counts": "SELECT (1700000000 + event_id * 7) // 600 * 600 AS window_start, event_type AS status, count(*) AS n FROM events GROUP BY 1, 2",
    "resumed_work": "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN -1 ELSE c_custkey * 3 END AS y FROM customer",
    "written_files": """SELECT 'nsfw/' || CASE WHEN n_nationkey % 2 = 0 THEN 'band1' ELSE 'band2' END || '/' || lower(n_name) || '/' || n_nationkey || '.bin' AS path,
        CASE WHEN n_nationkey % 5 = 0 THEN 'missing' WHEN n_nationkey % 2 = 0 THEN 'duplicate_existing' ELSE 'saved' END AS status, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE length(n_name) END AS length, CASE WHEN n_nationkey % 5 <> 0 THEN length(n_name) END AS listed FROM nation""",
    "packed_shards": """WITH r AS (SELECT c_custkey, length(c_name) AS n, (row_number() OVER (ORDER BY md5('42:' || c_custkey), CAST(c_custkey AS VARCHAR)) - 1) // CAST(ceil((SELECT count(*) FROM customer) / 3.0) AS BIGINT) AS shard FROM customer),
      s AS (SELECT *, 'train-0000' || shard || '.tar' AS path, count(*) OVER (PARTITION BY shard) AS samples FROM r)
      SELECT path, samples, unnest([c_custkey || CASE WHEN c_custkey % 3 = 0 THEN '.png' ELSE '.jpg' END || ':' || n, c_custkey || '.txt:' || n]) AS member FROM s""",
    "sample_documents": """SELECT CAST(p_partkey AS VARCHAR) AS image_id, 'c' AS caption, CASE WHEN p_partkey % 3 = 0 THEN '.webp' ELSE '.jpg' END AS ext, CASE WHEN p_partkey % 2 = 0 THEN 10 END AS width, split_part(lower(p_name), ' ', 2) AS second,
        CASE WHEN p_partkey % 3 = 0 THEN 'ff' END AS phash, true AS blank_score, '' AS url FROM part""",
    "paged_search": """SELECT n_name AS query, p::INTEGER AS page, i::INTEGER AS position, 'http://x/' || n_name || '/' || p || '/' || i AS url, lower(n_name) AS title FROM nation, unnest(range(least(2, length(n_name) % 4))) a(p), unnest(range(3)) b(i)""",
    "fetched_payloads": "SELECT page_id, CASE WHEN length(url) % 3 = 1 THEN md5(url) END AS digest, CASE WHEN length(url) % 3 = 1 THEN 'image/png' END AS content_type FROM pages",
    "collected": "SELECT r_name AS species, 6 AS attempt, 2 AS invalid_or_corrupt, 4 AS saved, least(4, r_regionkey) AS kept FROM region",
    "scored_ledger": """WITH x AS (SELECT c_custkey AS row_id, md5(CAST(c_custkey AS VARCHAR)) AS h, c_custkey % 5 = 0 AS old, c_custkey % 6 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AS asked FROM customer),
      y AS (SELECT *, asked AND CAST('0x' || substr(h, 7, 2) AS INTEGER) % 5 <> 0 AS told FROM x)
      SELECT row_id, CASE WHEN old THEN 1 WHEN told THEN CAST('0x' || substr(h, 1, 2) AS INTEGER) % 101 END AS ae_relevance, CASE WHEN old THEN 2 WHEN told THEN CAST('0x' || substr(h, 3, 2) AS INTEGER) % 101 END AS ae_aesthetic FROM y""",
    "hashed_pictures": f"WITH {PICTURES} SELECT k AS row_id, there AND NOT cut AS hashed, CASE WHEN there AND NOT cut THEN CAST(m AS BIGINT) END AS first FROM p",
    "identified_pictures": f"WITH {PICTURES} SELECT '/r/' || k AS path, CASE WHEN NOT cut THEN 'PNG' END AS fmt, CASE WHEN NOT cut THEN 128 END AS w, CASE WHEN NOT cut THEN 128 END AS h, NOT cut AS valid FROM p WHERE there",
    "flagged_pictures": f"""WITH {PICTURES}, q AS (SELECT *, CASE WHEN there AND NOT cut THEN m / 8.0::DOUBLE END AS score FROM p)
      SELECT k AS row_id, coalesce(score >= 0.5, false) AS is_unsafe, score AS is_unsafe_score, CASE WHEN score > 0 THEN 'dark:' || printf('%.3f', score) WHEN score = 0 THEN '' END AS is_unsafe_tags, CASE WHEN score >= 0.5 THEN printf('%.3f', score) END AS nsfw_score,
        CASE WHEN score >= 0.5 THEN '0.5' END AS threshold FROM q""",
    "unflagged_rows": "SELECT c_custkey AS row_id, c_custkey % 2 = 0 AND c_custkey % 6 <> 0 AS is_unsafe, CASE WHEN c_custkey % 6 <> 0 THEN 0.7::DOUBLE END AS is_unsafe_score, c_custkey % 2 = 0 AND c_custkey % 6 <> 0 AS logged FROM customer",
    "resized_pictures": f"""WITH {PICTURES}, q AS (SELECT CASE WHEN unsafe THEN 'skipped_nsfw' WHEN NOT there THEN 'missing' WHEN cut THEN 'error_open' ELSE 'ok' END AS status FROM p)
      SELECT status, CASE WHEN status = 'ok' THEN 'upscale_to_1024' END AS resize_action, count(*) AS n FROM q GROUP BY 1, 2""",
    "detected_text": f"""WITH {PICTURES}, q AS (SELECT *, there AND NOT cut AND NOT unsafe AND m > 0 AS hit FROM p)
      SELECT k AS row_id, hit AS has_ocr, CASE WHEN hit THEN m * 2048 END AS area, CASE WHEN hit THEN (16 * m + 1) * 128 END AS marked, CASE WHEN hit THEN 0 END AS dark, CASE WHEN hit THEN '128' END AS width FROM q""",
    "rotated_boxes": f"WITH {PICTURES} SELECT '/r/' || k AS path, n::INTEGER AS n, true AS near, true AS read FROM p, unnest(range(4)) r(n) WHERE there AND NOT cut AND m > 0",
    "recognised_boxes": """SELECT l_orderkey, l_linenumber, (l_quantity >= 15 AND l_discount * 10 >= 0.45) OR l_linenumber = 3 AS has_ocr, CASE WHEN l_quantity >= 15 AND l_discount * 10 >= 0.45 THEN 1 ELSE 0 END AS n FROM lineitem""",
    "captioned_rows": """SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 = 0 THEN 'old' WHEN c_custkey % 5 <> 0 THEN 'a cat ' || c_custkey || '.' END AS caption, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 THEN 'on_top' END AS pose FROM customer""",
    "recap_input": "SELECT c_name AS path, CAST(c_custkey AS VARCHAR) AS image_id, '' AS caption, '' AS tags FROM customer WHERE c_custkey % 8 = 0",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
