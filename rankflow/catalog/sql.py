"""The same results as plain SQL over the supplied tables, for an independent engine."""

from __future__ import annotations

_ROLES = """
lines AS (
  SELECT l_orderkey AS id, CAST(substr(p_brand, 7) AS INTEGER) AS item,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS is_booking, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
order_roles AS (
  SELECT o_orderkey AS id, o_custkey AS "user", o_orderdate AS order_date, c_nationkey AS city,
         CAST(round(c_acctbal * 100) AS BIGINT) AS distance_key,
         CAST(floor(o_totalprice / 25) AS BIGINT) AS dest,
         o_orderpriority AS country, c_mktsegment AS market
  FROM orders JOIN customer ON o_custkey = c_custkey
),
interactions AS (
  SELECT r.*, item, is_booking FROM lines JOIN order_roles r ON lines.id = r.id
),
training AS (SELECT * FROM interactions WHERE order_date < TIMESTAMP '1997-01-01'),
requests AS (SELECT * FROM order_roles WHERE order_date >= TIMESTAMP '1997-01-01')
"""


def _top_per_key(source: str, keys: str, score: str, where: str = "TRUE") -> str:
    return f"""
  SELECT * FROM (
    SELECT {keys}, item, CAST({score} AS BIGINT) AS score,
           CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {score} DESC, item) AS INTEGER) AS rn
    FROM {source} WHERE {where} GROUP BY {keys}, item
  ) ranked WHERE rn <= 5
"""


_WEIGHT = "sum(is_booking * 12 + 3)"
_IN_1996 = "order_date >= TIMESTAMP '1996-01-01' AND order_date < TIMESTAMP '1997-01-01'"


def _rule(number: int, source: str) -> str:
    return {
        1: _top_per_key(source, "city, distance_key", "count(*)"),
        2: _top_per_key(source, "dest, country, market", _WEIGHT, _IN_1996),
        3: _top_per_key(source, "dest", _WEIGHT),
    }[number]


_POPULAR = """
  SELECT item, CAST(sum(is_booking * 5 + 3) AS BIGINT) AS score FROM {source}
  GROUP BY item ORDER BY score DESC, item
"""

_CASCADE = f"""
WITH {_ROLES},
rule1 AS ({_rule(1, "training")}),
rule2 AS ({_rule(2, "training")}),
rule3 AS ({_rule(3, "training")}),
top5 AS ({_POPULAR.format(source="training")} LIMIT 5),
hits1 AS (SELECT id, item, rn FROM requests JOIN rule1 USING (city, distance_key)),
hits2 AS (SELECT id, item, rn * 10 AS rn FROM requests JOIN rule2 USING (dest, country, market)),
hits3 AS (SELECT id, item, rn * 100 AS rn FROM requests JOIN rule3 USING (dest)),
unmatched AS (
  SELECT id FROM requests
  EXCEPT SELECT id FROM hits1 EXCEPT SELECT id FROM hits2 EXCEPT SELECT id FROM hits3
),
remainder AS (SELECT id, item, 999 AS rn FROM unmatched CROSS JOIN top5),
merged AS (
  SELECT * FROM hits1 UNION ALL SELECT * FROM hits2
  UNION ALL SELECT * FROM hits3 UNION ALL SELECT * FROM remainder
),
reranked AS (
  SELECT * FROM (
    SELECT id, item, rn,
           CAST(row_number() OVER (PARTITION BY id ORDER BY rn, item) AS INTEGER) AS rn_all
    FROM merged
  ) numbered WHERE rn_all <= 5
),
padding AS (SELECT list(item ORDER BY score DESC, item) AS items FROM top5),
lists AS (
  SELECT id, list_concat(list(item ORDER BY rn_all), (SELECT items FROM padding))[1:5] AS items
  FROM reranked GROUP BY id
)
"""

_DISTINCT_LISTS = f"""
{_CASCADE},
best AS (SELECT id, item, min(rn) AS rn FROM merged GROUP BY id, item),
padded AS (
  SELECT id, 0 AS part, rn, item, item AS tie FROM best
  UNION ALL
  SELECT id, 1, CAST(place AS INTEGER), item, 0
  FROM requests CROSS JOIN (
    SELECT item, row_number() OVER (ORDER BY score DESC, item) AS place FROM top5
  ) numbered
),
first_places AS (
  SELECT *, row_number() OVER (PARTITION BY id, item ORDER BY part, rn) AS nth FROM padded
),
kept AS (
  SELECT id, item, row_number() OVER (PARTITION BY id ORDER BY part, rn, tie) AS place
  FROM first_places WHERE nth = 1
)
SELECT id, string_agg(CAST(item AS VARCHAR), ' ' ORDER BY place) AS items
FROM kept WHERE place <= 5 GROUP BY id
"""

_USER_LISTS = f"""
WITH {_ROLES},
by_count AS ({_top_per_key("training", '"user"', "count(*)")}),
by_weight AS ({_top_per_key("training", '"user"', "sum(is_booking * 5 + 3)")}),
predicted AS (
  SELECT "user", item, CAST(rn AS INTEGER) AS place FROM by_count
  UNION ALL
  SELECT w."user", w.item, w.rn + n.size
  FROM by_weight w JOIN (SELECT "user", max(rn) AS size FROM by_count GROUP BY "user") n
    ON w."user" = n."user"
),
actual AS (
  SELECT DISTINCT "user", item FROM interactions WHERE order_date >= TIMESTAMP '1997-01-01'
),
users AS (SELECT DISTINCT "user" FROM interactions)
"""


def _average_precision(source: str, k: int | None, empty: float) -> str:
    cut = "" if k is None else f"WHERE p.place <= {k}"
    divisor = "n_actual" if k is None else f"least(n_actual, {k})"
    return f"""
marked AS (
  SELECT p."user", p.place, CASE WHEN a.item IS NULL THEN 0 ELSE 1 END AS hit
  FROM {source} p LEFT JOIN actual a ON p."user" = a."user" AND p.item = a.item {cut}
),
gains AS (
  SELECT "user", hit * sum(hit) OVER (PARTITION BY "user" ORDER BY place) / CAST(place AS DOUBLE) AS gain
  FROM marked
),
scores AS (SELECT "user", sum(gain) AS score FROM gains GROUP BY "user"),
sizes AS (SELECT "user", count(*) AS n_actual FROM actual GROUP BY "user"),
precisions AS (
  SELECT u."user",
         CASE WHEN n_actual IS NULL THEN {empty} ELSE coalesce(score, 0) / {divisor} END AS ap
  FROM users u LEFT JOIN scores s ON u."user" = s."user" LEFT JOIN sizes z ON u."user" = z."user"
)
"""


_UNIQUE_PREDICTIONS = """
firsts AS (SELECT "user", item, min(place) AS place FROM predicted GROUP BY "user", item),
unique_predictions AS (
  SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY place) AS place FROM firsts
)
"""

_EVENTS = "SELECT * REPLACE (props || ', \"x\", y' AS props) FROM events"

_AUDITED = """
WITH lines AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
         CASE WHEN substr(o_orderpriority, 1, 2) IN ('1-', '2-', '3-') THEN substr(o_orderpriority, 3) END AS code,
         o_orderstatus AS status, replace(o_orderpriority, ' ', ',') AS priority,
         length(o_orderpriority) - length(replace(o_orderpriority, ' ', '')) AS commas,
         concat_ws(',', o_orderkey, strftime(o_orderdate, '%Y-%m-%d'),
                   CASE WHEN substr(o_orderpriority, 1, 2) IN ('1-', '2-', '3-') THEN substr(o_orderpriority, 3) ELSE '' END,
                   o_orderstatus, replace(o_orderpriority, ' ', ',')) AS line
  FROM orders
)
"""

ORACLES: dict[str, str] = {
    "weighted_popularity": f"WITH {_ROLES} {_POPULAR.format(source='lines')}",
    "global_top5": f"WITH {_ROLES} {_POPULAR.format(source='lines')} LIMIT 5",
    "topk_exact_key": f"WITH {_ROLES} {_rule(1, 'interactions')}",
    "topk_year_rule": f"WITH {_ROLES} {_rule(2, 'interactions')}",
    "topk_single_key": f"WITH {_ROLES} {_rule(3, 'interactions')}",
    "rule_candidates": f"""
{_CASCADE}
SELECT 1 AS rule, city, distance_key, 0 AS dest, '' AS country, '' AS market, item, score, rn FROM rule1
UNION ALL SELECT 2, 0, 0, dest, country, market, item, score, rn FROM rule2
UNION ALL SELECT 3, 0, 0, dest, '', '', item, score, rn FROM rule3
""",
    "join_rule1": f"{_CASCADE} SELECT * FROM hits1",
    "join_rule2": f"{_CASCADE} SELECT * FROM hits2",
    "join_rule3": f"{_CASCADE} SELECT * FROM hits3",
    "unmatched_ids": f"{_CASCADE} SELECT * FROM unmatched",
    "remainder_fill": f"{_CASCADE} SELECT * FROM remainder",
    "union_rerank": f"{_CASCADE} SELECT id, item, CAST(rn AS BIGINT) AS rn, rn_all FROM reranked",
    "ordered_lists": f"{_CASCADE} SELECT id, array_to_string(items, ' ') AS items FROM lists ORDER BY id",
    "cascade_recommend": f"{_CASCADE} SELECT id, array_to_string(items, ' ') AS items FROM lists",
    "cascade_distinct": _DISTINCT_LISTS,
    "topk_null_items": f"WITH {_ROLES} {_rule(3, 'interactions').replace('WHERE TRUE', 'WHERE item > 5')}",
    "cascade_null_items": f"""
{_CASCADE.replace("FROM interactions WHERE", "FROM interactions WHERE item > 5 AND")}
SELECT id, array_to_string(items, ' ') AS items FROM lists
""",
    "hotel_files": f"{_CASCADE} SELECT id, array_to_string(items, ' ') AS hotel_cluster FROM lists",
    "suffix_rename": """
SELECT s_suppkey AS s_suppkey_1, s_name AS s_name_1, s_nationkey AS s_nationkey_1,
       s_acctbal AS s_acctbal_1
FROM supplier
""",
    "text_lengths": "SELECT doc_id, CAST(length(text) AS INTEGER) AS text, n_chars FROM documents",
    "page_lengths": """
SELECT page_id, CAST(length(url) AS INTEGER) AS url, CAST(length(html) AS INTEGER) AS html FROM pages
""",
    "pair_enrich": """
SELECT b.c_nationkey AS "locationID_2", a.c_nationkey AS "locationID_1",
       b.c_custkey AS "itemID_2", a.c_custkey AS "itemID_1",
       CAST(length(a.c_name) AS INTEGER) AS title_1, CAST(length(a.c_mktsegment) AS INTEGER) AS description_1,
       a.c_acctbal AS price_1, na.n_regionkey AS "regionID_1",
       CAST(length(b.c_name) AS INTEGER) AS title_2, CAST(length(b.c_mktsegment) AS INTEGER) AS description_2,
       b.c_acctbal AS price_2, nb.n_regionkey AS "regionID_2"
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
JOIN nation na ON a.c_nationkey = na.n_nationkey JOIN nation nb ON b.c_nationkey = nb.n_nationkey
""",
    "pair_files": """
SELECT a.c_custkey AS "itemID_1", b.c_custkey AS "itemID_2",
       CAST(length(a.c_name) + 6 AS INTEGER) AS title_1, CAST(length(b.c_name) + 6 AS INTEGER) AS title_2,
       a.c_acctbal AS price_1, b.c_acctbal AS price_2, na.n_regionkey AS "regionID_1", nb.n_regionkey AS "regionID_2"
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
JOIN nation na ON a.c_nationkey = na.n_nationkey JOIN nation nb ON b.c_nationkey = nb.n_nationkey
""",
    "joint_mean": """
SELECT round(coalesce(avg(acctbal), 0.0), 6) AS acctbal, round(coalesce(avg(nationkey), 0.0), 6) AS nationkey
FROM (
  SELECT c_acctbal AS acctbal, c_nationkey AS nationkey FROM customer
  UNION ALL SELECT s_acctbal, s_nationkey FROM supplier
) merged
""",
    "impute_mean": """
WITH measured AS (
  SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'train' ELSE 'test' END AS side,
         avg_quantity, avg_tax
  FROM orders LEFT JOIN (
    SELECT l_orderkey, avg(l_quantity) AS avg_quantity, avg(l_tax) AS avg_tax
    FROM lineitem GROUP BY l_orderkey
  ) averages ON o_orderkey = l_orderkey
)
SELECT o_orderkey, side,
       round(coalesce(avg_quantity, (SELECT avg(avg_quantity) FROM measured)), 6) AS quantity,
       round(coalesce(avg_tax, (SELECT avg(avg_tax) FROM measured)), 6) AS tax
FROM measured
""",
    "default_string": """
SELECT o_orderkey, CASE WHEN substr(o_orderpriority, 1, 2) IN ('1-', '2-', '3-')
                        THEN substr(o_orderpriority, 3) ELSE 'S' END AS code
FROM orders
""",
    "regex_title_map": """
SELECT o_orderkey, CASE
         WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fast'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'Normal'
         WHEN NOT regexp_full_match(o_orderpriority, '[1-4]-.*') THEN 'Slow'
         WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS title
FROM orders
""",
    "family_size": """
SELECT l_orderkey, l_linenumber, CAST(l_linenumber + l_quantity + 1 AS INTEGER) AS family_size
FROM lineitem
""",
    "label_cast": """
SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '0') AS label,
       coalesce(CAST(quality AS VARCHAR), '0') AS label_copy
FROM documents LEFT JOIN labels USING (doc_id)
""",
    "ap_at_k": f"""
{_USER_LISTS}, {_average_precision("predicted", 5, 1.0)}
SELECT "user", round(ap, 9) AS ap FROM precisions
""",
    "ap_repeats": f"""
{_USER_LISTS}, {_average_precision("predicted", 8, 1.0)}
SELECT "user", round(ap, 9) AS ap FROM precisions
""",
    "ap_full": f"""
{_USER_LISTS}, {_UNIQUE_PREDICTIONS}, {_average_precision("unique_predictions", None, 0.0)}
SELECT "user", round(ap, 9) AS ap FROM precisions
""",
    "map_at_5": f"""
{_CASCADE},
dearest AS (
  SELECT id, item AS actual FROM (
    SELECT id, item, row_number() OVER (PARTITION BY id ORDER BY l_extendedprice DESC, item DESC) AS nth
    FROM lines
  ) numbered WHERE nth = 1
),
places AS (SELECT id, unnest(items) AS item, generate_subscripts(items, 1) AS place FROM lists),
marked AS (
  SELECT p.id, place, CASE WHEN p.item = d.actual THEN 1 ELSE 0 END AS hit
  FROM places p JOIN dearest d ON p.id = d.id
),
gains AS (
  SELECT hit * sum(hit) OVER (PARTITION BY id ORDER BY place) / CAST(place AS DOUBLE) AS gain FROM marked
)
SELECT round(coalesce(sum(gain), 0) / (SELECT count(*) FROM lists), 9) AS map FROM gains
""",
    "map_file": f"""
{_USER_LISTS},
late_users AS (SELECT DISTINCT "user" FROM actual),
late AS (SELECT * FROM actual),
{_UNIQUE_PREDICTIONS},
truth AS (
  SELECT "user", item FROM late
  UNION ALL
  SELECT "user", item FROM by_count WHERE "user" NOT IN (SELECT "user" FROM late_users)
),
{_average_precision("unique_predictions", None, 0.0).replace("actual a", "truth a").replace("FROM actual", "FROM truth")}
SELECT round(coalesce(avg(ap), 0.0), 9) AS map
FROM precisions WHERE "user" IN (SELECT "user" FROM predicted)
""",
    "list_parse": f"""
WITH {_ROLES},
unique_items AS (SELECT DISTINCT id, item FROM lines)
SELECT CAST(id + 3000000000 AS BIGINT) AS id, CAST(2 * count(*) AS INTEGER) AS n_items,
       string_agg(CAST(item AS VARCHAR), ' ' ORDER BY item) AS distinct_items
FROM unique_items GROUP BY id
""",
    "last_order": """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
  FROM orders
) numbered WHERE nth = 1
""",
    "string_index": """
SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS "index"
FROM documents GROUP BY source
""",
    "category_index": """
SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS "index"
FROM part GROUP BY p_name
""",
    "auc_ranksum": """
WITH counts AS (
  SELECT n_chars, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN quality = 1 THEN 0 ELSE 1 END) AS neg
  FROM labels JOIN documents USING (doc_id) GROUP BY n_chars
),
running AS (SELECT pos, neg, sum(neg) OVER (ORDER BY n_chars) - neg AS below FROM counts)
SELECT round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2.0 * CAST(sum(pos) * sum(neg) AS DOUBLE)), 9) AS auc
FROM running
""",
    "forest_rule": """
SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN '1' ELSE '0' END AS quality
FROM documents ANTI JOIN labels USING (doc_id)
""",
    "head_sample": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000",
    "text_lines": "SELECT o_orderkey, o_orderpriority FROM orders",
    "csv_roundtrip": """
SELECT o_orderpriority, o_orderdate, o_totalprice, o_orderstatus, o_orderkey FROM orders
""",
    "csv_declared": "SELECT * FROM supplier",
    "csv_infer": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""",
    "csv_events": _EVENTS,
    "csv_events_declared": _EVENTS,
    "csv_events_inferred": """
SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value,
       props || ', "x", y' AS props
FROM events
""",
    "csv_types": """
SELECT * FROM (
  VALUES ('event_id', 'bigint', 'bigint,int'), ('user_id', 'double', 'double,int'),
         ('ts', 'timestamp_ntz', 'date,timestamp_ntz'), ('event_type', 'string', '')
) found("column", "type", by_file)
WHERE (SELECT count(DISTINCT event_type < 'm') FROM events) = 2
""",
    "rejected_rows": f"""
{_AUDITED}
SELECT 'code' AS "column", NULL AS value, 'missing' AS reason, FALSE AS kept, o_orderkey FROM lines WHERE code IS NULL
UNION ALL
SELECT 'status', status, 'unparseable', code IS NOT NULL AND commas = 0, o_orderkey FROM lines
UNION ALL
SELECT '_malformed', line, 'wrong number of fields', FALSE, o_orderkey FROM lines WHERE commas > 0
""",
    "accepted_rows": f"""
{_AUDITED}
SELECT o_orderkey, day, code, CAST(NULL AS INTEGER) AS status, priority FROM lines WHERE code IS NOT NULL AND commas = 0
""",
    "passenger_files": """
SELECT CAST(c_custkey AS INTEGER) AS "PassengerId", CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '0' END AS "Survived"
FROM customer WHERE c_acctbal >= 5000
""",
    "label_order": """
WITH means AS (
  SELECT p_name, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS mean
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
)
SELECT p_name, n, mean, dense_rank() OVER (ORDER BY mean) - 1 AS "order" FROM means
""",
    "wide_forest": """
WITH early AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')
SELECT o_orderkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND e.o_custkey IS NOT NULL THEN '1' ELSE '0' END AS label
FROM orders o JOIN customer ON o.o_custkey = c_custkey LEFT JOIN early e ON o.o_custkey = e.o_custkey
WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""",
    "ids_in_no_part": """
SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels EXCEPT SELECT page_id FROM pages
""",
    "rerank_parts": f"""
{_CASCADE},
parts AS (SELECT * FROM hits1 UNION ALL SELECT * FROM hits2 UNION ALL SELECT * FROM hits3),
numbered AS (
  SELECT id, item, rn, CAST(row_number() OVER (PARTITION BY id ORDER BY rn, item) AS INTEGER) AS rn_all FROM parts
)
SELECT id, item, CAST(rn AS BIGINT) AS rn, rn_all FROM numbered WHERE rn_all <= 5
""",
    "csv_quoted": "SELECT * FROM documents",
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "row_audit": """
SELECT 'day' AS "column", CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unparseable
UNION ALL
SELECT 'code', count(*) FILTER (WHERE substr(o_orderpriority, 1, 2) NOT IN ('1-', '2-', '3-')), 0
FROM orders
UNION ALL
SELECT 'status', 0, count(*) FROM orders
UNION ALL
SELECT '_malformed', 0, count(*) FILTER (WHERE o_orderpriority LIKE '% %') FROM orders
""",
}
