"""Independent DuckDB SQL for each binding (tables pre-registered as views).

Written from the operator semantics (SURVEY §2.8) by other means than the
Spark plans and than the usual window-function scripts: ranks by counting
better rows or by positions in sorted lists, gaps by list differences,
sessions by lists of start times, streaks by matching their two ends.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


sql("top_customers_per_month", """
WITH spend AS (
    SELECT make_timestamp(year(o_orderdate), month(o_orderdate), 1, 0, 0, 0) AS month, o_custkey,
           ROUND(SUM(o_totalprice), 2) AS total_spent
    FROM orders GROUP BY ALL
)
SELECT me.month, me.o_custkey, me.total_spent, CAST(COUNT(better.o_custkey) + 1 AS INTEGER) AS rank
FROM spend me LEFT JOIN spend better ON better.month = me.month AND better.total_spent > me.total_spent
GROUP BY ALL HAVING COUNT(better.o_custkey) < 5
""")

sql("burst_events", """
SELECT me.user_id, me.event_id, me.ts, COUNT(*) AS events_in_window
FROM events me JOIN events near
  ON near.user_id = me.user_id AND near.ts <= me.ts AND near.ts >= me.ts - INTERVAL 24 HOUR
GROUP BY me.user_id, me.event_id, me.ts HAVING COUNT(*) >= 8
""")

sql("customer_tiers", """
WITH spend AS (SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS total_revenue FROM orders GROUP BY o_custkey),
sorted AS (
    SELECT list(struct_pack(r := -total_revenue, k := o_custkey) ORDER BY total_revenue DESC, o_custkey) AS l FROM spend
), numbered AS (
    SELECT unnest(l) AS x, generate_subscripts(l, 1) AS place, len(l) AS n FROM sorted
)
-- the first n mod 3 tiers hold one customer more
SELECT x.k AS o_custkey, -x.r AS total_revenue,
       CASE WHEN place <= n // 3 + least(n % 3, 1) THEN 'High Value'
            WHEN place <= 2 * (n // 3) + least(n % 3, 2) THEN 'Medium Value'
            ELSE 'Low Value' END AS customer_segment
FROM numbered
""")

sql("first_purchase", """
SELECT o.* FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_custkey = o.o_custkey
                  AND (e.o_orderdate < o.o_orderdate OR (e.o_orderdate = o.o_orderdate AND e.o_orderkey < o.o_orderkey)))
""")

sql("outliers_sigma", """
WITH means AS (SELECT user_id, SUM(value) / COUNT(value) AS a, COUNT(value) AS n FROM events GROUP BY user_id),
spreads AS (
    SELECT user_id, a, SQRT(SUM((value - a) * (value - a)) / NULLIF(MIN(n) - 1, 0)) AS sd
    FROM events JOIN means USING (user_id) GROUP BY user_id, a
)
SELECT user_id, event_id, ts, value, ROUND(a, 6) AS avg_amount, ROUND(sd, 6) AS std_amount
FROM events JOIN spreads USING (user_id) WHERE value - a > 3 * sd
""")

sql("purchase_funnel", """
WITH per AS (SELECT event_type, approx.n FROM (
    SELECT event_type, len(list_distinct(list(user_id))) AS n FROM events GROUP BY event_type) approx),
wide AS (
    SELECT COALESCE(MAX(n) FILTER (event_type = 'view'), 0) AS a, COALESCE(MAX(n) FILTER (event_type = 'click'), 0) AS b,
           COALESCE(MAX(n) FILTER (event_type = 'purchase'), 0) AS c FROM per
)
SELECT a AS total_visits, b AS total_cart, c AS total_purchases,
       CASE WHEN a > 0 THEN b::DOUBLE / a END AS visits_to_cart_rate,
       CASE WHEN b > 0 THEN c::DOUBLE / b END AS cart_to_purchases_rate
FROM wide
""")

sql("inactive_customers", """
-- inactive: some order, but none within 90 days of the as-of date
SELECT c_custkey, (SELECT MAX(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS last_order,
       CAST(DATE '2001-08-02' - (SELECT MAX(o_orderdate)::DATE FROM orders WHERE o_custkey = c_custkey) AS INTEGER) AS days_inactive
FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-04' AND o_custkey IS NOT NULL)
""")

sql("market_basket_pairs", """
WITH baskets AS (SELECT list(l_partkey) AS held FROM lineitem GROUP BY l_orderkey),
one AS (SELECT held, unnest(held) AS x FROM baskets),
two AS (SELECT x, unnest(list_filter(held, lambda y: y > x)) AS y FROM one),
counts AS (SELECT x AS product_a, y AS product_b, COUNT(*) AS pair_count FROM two GROUP BY ALL),
levels AS (SELECT pair_count, COUNT(*) AS pairs FROM counts GROUP BY pair_count),
ranks AS (
    SELECT l.pair_count, 1 + COALESCE((SELECT SUM(h.pairs) FROM levels h WHERE h.pair_count > l.pair_count), 0) AS r FROM levels l
)
SELECT product_a, product_b, pair_count, CAST(r AS INTEGER) AS rank
FROM counts JOIN ranks USING (pair_count) WHERE r <= 10
""")

sql("monthly_revenue_growth", """
WITH m AS (
    SELECT make_timestamp(year(o_orderdate), month(o_orderdate), 1, 0, 0, 0) AS month, ROUND(SUM(o_totalprice), 2) AS revenue
    FROM orders GROUP BY ALL
)
SELECT m.month, m.revenue, p.revenue AS previous_month,
       ROUND((m.revenue - p.revenue) / NULLIF(p.revenue, 0) * 100, 2) AS growth_percent
FROM m LEFT JOIN m p ON p.month = (SELECT MAX(q.month) FROM m q WHERE q.month < m.month)
""")

sql("churn_risk", """
WITH days AS (SELECT o_custkey, list_sort(list(o_orderdate::DATE)) AS d FROM orders GROUP BY o_custkey),
gaps AS (
    SELECT o_custkey, list_avg(list_transform(range(2, len(d) + 1), lambda i: d[i] - d[i - 1])) AS gap, d[-1] AS latest
    FROM days WHERE len(d) > 1
)
SELECT o_custkey, ROUND(gap, 6) AS avg_gap, CAST(DATE '2001-08-02' - latest AS INTEGER) AS days_since_last_order
FROM gaps WHERE DATE '2001-08-02' - latest > 2 * gap
""")

sql("activity_streaks", """
-- a streak runs from a day without the day before to the next day without the day after
WITH days AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events),
starts AS (SELECT user_id, d FROM days a WHERE NOT EXISTS (SELECT 1 FROM days b WHERE b.user_id = a.user_id AND b.d = a.d - 1)),
stops AS (SELECT user_id, d FROM days a WHERE NOT EXISTS (SELECT 1 FROM days b WHERE b.user_id = a.user_id AND b.d = a.d + 1)),
runs AS (
    SELECT s.user_id, s.d AS start_streak, MIN(e.d) AS end_streak
    FROM starts s JOIN stops e ON e.user_id = s.user_id AND e.d >= s.d GROUP BY ALL
)
SELECT *, CAST(end_streak - start_streak + 1 AS BIGINT) AS streak_length FROM runs WHERE end_streak - start_streak >= 4
""")

_RANKED_LINES = """
SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
FROM lineitem
"""

sql("find_duplicates", """
WITH copies AS (
    SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1
    UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 3 = 0
)
SELECT * EXCLUDE (place) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS place
    FROM copies
) WHERE place > 1
""")
sql("dedup_keep_first", f"SELECT * EXCLUDE (rn) FROM ({_RANKED_LINES}) WHERE rn = 1")

sql("merge_insert_new", f"""
WITH target AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
src AS (SELECT * EXCLUDE (rn) FROM ({_RANKED_LINES}) WHERE rn = 1)
SELECT * FROM target
UNION ALL
SELECT s.* FROM src s
WHERE NOT EXISTS (SELECT 1 FROM target t
                  WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
""")

_INTERVALS = """
SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate AS valid_from,
       COALESCE(LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                TIMESTAMP '9999-12-31') AS valid_to
FROM orders
"""

sql("scd2_intervals", _INTERVALS)

sql("time_between_purchases", """
SELECT o_custkey, o_orderkey, o_orderdate, previous_purchase,
       CAST(date_diff('day', CAST(previous_purchase AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER)
           AS days_between
FROM (
    SELECT *, LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
                  AS previous_purchase
    FROM orders
)
""")

sql("top_n_dense_rank", """
WITH sales AS (
    SELECT r_name AS region, s_name AS salesperson,
           ROUND(SUM(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2))), 2)::DOUBLE AS revenue
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey
         JOIN lineitem ON l_suppkey = s_suppkey
    GROUP BY r_name, s_name, s_suppkey
), levels AS (SELECT region, list_reverse_sort(list_distinct(list(revenue))) AS v FROM sales GROUP BY region)
SELECT region, salesperson, revenue, CAST(list_position(v, revenue) AS INTEGER) AS rank
FROM sales JOIN levels USING (region) WHERE list_contains(v[1:3], revenue)
""")

sql("top_products_by_category", """
WITH sold AS (SELECT l_partkey AS p_partkey, SUM(l_quantity) AS total_sold FROM lineitem GROUP BY l_partkey),
named AS (SELECT p_type, p_partkey, total_sold FROM sold JOIN part USING (p_partkey)),
levels AS (SELECT p_type, list_reverse_sort(list(total_sold)) AS v FROM named GROUP BY p_type)
SELECT p_type, p_partkey, total_sold, CAST(list_position(v, total_sold) AS INTEGER) AS rank_in_category
FROM named JOIN levels USING (p_type) WHERE list_position(v, total_sold) <= 3
""")

sql("sessionize", """
WITH walks AS (SELECT user_id, list(struct_pack(ts := ts, id := event_id) ORDER BY ts, event_id) AS l FROM events GROUP BY user_id),
steps AS (SELECT user_id, unnest(l) AS me, unnest(list_prepend(NULL, l[:-2])) AS prior FROM walks),
opened AS (
    SELECT user_id, me, prior, prior IS NULL OR me.ts > prior.ts + INTERVAL 30 MINUTE AS opens FROM steps
), openings AS (SELECT user_id, list_sort(list(me) FILTER (opens)) AS s FROM opened GROUP BY user_id)
SELECT user_id, me.id AS event_id, me.ts AS ts, prior.ts AS prev_event, CAST(opens AS INTEGER) AS new_session,
       CAST(len(list_filter(s, lambda x: x <= me)) AS BIGINT) AS session_id
FROM opened JOIN openings USING (user_id)
""")

# ------------------------------------------------------------------ quality
sql("null_ratio_check", """
WITH j AS (SELECT d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT COUNT(*) AS total,
             COUNT(*) FILTER (WHERE quality IS NULL) AS n_quality,
             COUNT(*) FILTER (WHERE lang IS NULL) AS n_lang FROM j)
SELECT 'quality' AS column_name, n_quality AS null_count, total AS total_count,
       CASE WHEN total > 0 THEN CAST(n_quality AS DOUBLE) / total END AS null_ratio,
       CAST(0.5 AS DOUBLE) AS threshold,
       CASE WHEN total = 0 THEN 'EMPTY_DF'
            WHEN CAST(n_quality AS DOUBLE) / total > 0.5 THEN 'FAIL' ELSE 'OK' END AS status
FROM c
UNION ALL
SELECT 'lang', n_lang, total,
       CASE WHEN total > 0 THEN CAST(n_lang AS DOUBLE) / total END,
       CAST(0.0 AS DOUBLE),
       CASE WHEN total = 0 THEN 'EMPTY_DF'
            WHEN CAST(n_lang AS DOUBLE) / total > 0.0 THEN 'FAIL' ELSE 'OK' END
FROM c
""")

sql("number_range_check", """
SELECT 'o_totalprice' AS column_name, CAST(0 AS DOUBLE) AS min_value, CAST(400000 AS DOUBLE) AS max_value,
       COUNT(*) FILTER (WHERE o_totalprice < 0) AS below_count,
       COUNT(*) FILTER (WHERE o_totalprice > 400000) AS above_count,
       CAST(MIN(o_totalprice) AS DOUBLE) AS actual_min, CAST(MAX(o_totalprice) AS DOUBLE) AS actual_max,
       CASE WHEN COUNT(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 400000) = 0
            THEN 'OK' ELSE 'FAIL' END AS status
FROM orders
""")

sql("date_range_check", """
SELECT 'o_orderdate' AS column_name, DATE '1996-01-01' AS min_date, DATE '2000-12-31' AS max_date,
       COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01') AS below_count,
       COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) > DATE '2000-12-31') AS above_count,
       COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS invalid_count,
       MIN(CAST(o_orderdate AS DATE)) AS actual_min, MAX(CAST(o_orderdate AS DATE)) AS actual_max,
       CASE WHEN COUNT(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01'
                                   OR CAST(o_orderdate AS DATE) > DATE '2000-12-31') = 0
            THEN 'OK' ELSE 'FAIL' END AS status
FROM orders
""")

sql("partition_skew", """
WITH per AS (SELECT lang, COUNT(*) AS n FROM documents GROUP BY lang),
m AS (SELECT COUNT(*) AS distinct_keys, MAX(n) AS max_count, AVG(n) AS avg_count FROM per)
SELECT 'lang' AS columns, distinct_keys, max_count, avg_count,
       CAST(max_count AS DOUBLE) / NULLIF(avg_count, 0) AS skew_ratio,
       COALESCE(CAST(max_count AS DOUBLE) / NULLIF(avg_count, 0) > 2.0, FALSE) AS is_skewed
FROM m
""")

_STRETCHED = f"""
SELECT o_custkey, o_orderkey, valid_from,
       CASE WHEN o_orderpriority = '1-URGENT' AND valid_to < TIMESTAMP '9999-12-31'
            THEN valid_to + INTERVAL 1 DAY ELSE valid_to END AS valid_to
FROM ({_INTERVALS})
"""

sql("scd2_overlaps", f"""
WITH x AS ({_STRETCHED}),
p AS (
    SELECT *, LAG(valid_to) OVER w AS prev_end, LAG(1) OVER w AS has_prev
    FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey)
)
SELECT o_custkey, o_orderkey, valid_from, valid_to, prev_end
FROM p WHERE has_prev IS NOT NULL AND (prev_end IS NULL OR valid_from < prev_end)
""")

sql("scd2_overlaps_any", f"""
WITH x AS ({_STRETCHED}),
p AS (
    SELECT *,
           MAX(valid_to) OVER w AS prev_end,
           COUNT(*) OVER w AS n_before,
           COUNT(*) FILTER (WHERE valid_to IS NULL) OVER w AS n_open
    FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT o_custkey, o_orderkey, valid_from, valid_to, prev_end
FROM p WHERE n_before > 0 AND (n_open > 0 OR valid_from < prev_end)
""")

sql("scd2_single_current", f"""
WITH iv AS ({_INTERVALS})
SELECT o_custkey,
       CAST(SUM(CASE WHEN valid_to = TIMESTAMP '9999-12-31' OR o_orderpriority = '1-URGENT'
                     THEN 1 ELSE 0 END) AS BIGINT) AS current_count
FROM iv GROUP BY o_custkey
HAVING SUM(CASE WHEN valid_to = TIMESTAMP '9999-12-31' OR o_orderpriority = '1-URGENT'
                THEN 1 ELSE 0 END) <> 1
""")

sql("table_freshness", """
SELECT MAX(o_orderdate) AS last_modified,
       CAST(date_diff('day', CAST(MAX(o_orderdate) AS DATE), DATE '2001-08-02') AS INTEGER) AS age_days
FROM orders
""")

sql("duplicate_check", """
WITH g AS (SELECT text, COUNT(*) AS n FROM documents GROUP BY text)
SELECT COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows,
       CASE WHEN COUNT(*) FILTER (WHERE n > 1) = 0 THEN 'OK' ELSE 'FAIL' END AS status
FROM g
""")

sql("referential_integrity", """
SELECT * FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")

sql("row_count_compare", f"""
WITH s AS (SELECT COUNT(*) AS n FROM lineitem),
t AS (SELECT COUNT(*) AS n FROM ({_RANKED_LINES}) WHERE rn = 1)
SELECT s.n AS source_count, t.n AS target_count, s.n = t.n AS counts_equal
FROM s CROSS JOIN t
""")

# ------------------------------------------------------------------ transforms
sql("add_row_id_and_hash", """
WITH h AS (
    SELECT c_custkey, c_name, c_mktsegment,
           md5(CAST(c_custkey AS VARCHAR)) AS k,
           sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS hash_data
    FROM customer
)
SELECT c_custkey, c_name, c_mktsegment,
       substr(k, 1, 8) || '-' || substr(k, 9, 4) || '-' || substr(k, 13, 4) || '-' ||
       substr(k, 17, 4) || '-' || substr(k, 21, 12) AS uuid,
       hash_data
FROM h
""")

sql("scd2_merge", """
WITH cur AS (
    SELECT c_custkey AS SurrogateKey, c_custkey, c_mktsegment, c_nationkey,
           TIMESTAMP '2020-01-01 00:00:00' AS Start_Date, CAST(NULL AS TIMESTAMP) AS End_Date,
           TRUE AS Flg_Is_Current
    FROM customer WHERE c_nationkey < 20
), incoming AS (
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 THEN c_mktsegment || '_NEW' ELSE c_mktsegment END AS c_mktsegment,
           c_nationkey
    FROM customer
), classified AS (
    SELECT n.*, CASE WHEN c.c_custkey IS NULL THEN 'NEW'
                     WHEN n.c_mktsegment IS DISTINCT FROM c.c_mktsegment
                       OR n.c_nationkey IS DISTINCT FROM c.c_nationkey THEN 'CHANGED'
                     ELSE 'UNCHANGED' END AS status
    FROM incoming n LEFT JOIN cur c ON n.c_custkey = c.c_custkey
), changed AS (SELECT c_custkey FROM classified WHERE status = 'CHANGED'),
mx AS (SELECT COALESCE(MAX(SurrogateKey), 0) AS m FROM cur)
SELECT * FROM cur WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)
UNION ALL
SELECT SurrogateKey, c_custkey, c_mktsegment, c_nationkey, Start_Date,
       TIMESTAMP '2024-01-01 00:00:00', FALSE
FROM cur WHERE c_custkey IN (SELECT c_custkey FROM changed)
UNION ALL
SELECT CAST(mx.m + ROW_NUMBER() OVER (ORDER BY c_custkey) AS BIGINT), c_custkey, c_mktsegment,
       c_nationkey, TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS TIMESTAMP), TRUE
FROM classified CROSS JOIN mx WHERE status IN ('NEW', 'CHANGED')
""")

sql("standardize_table", "SELECT DISTINCT * FROM lineitem")

sql("normalize_by_max", """
SELECT o_orderkey, o_totalprice,
       o_totalprice / NULLIF((SELECT MAX(o_totalprice) FROM orders), 0) AS price_ratio
FROM orders
""")

sql("drop_sensitive_columns", "SELECT * EXCLUDE (c_acctbal) FROM customer")

sql("global_order", """
SELECT *, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders
""")

# ------------------------------------------------------------------ json, text
sql("json_flatten", """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       l.l_partkey AS product_id, l.l_extendedprice AS price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

_TITLE = "array_to_string(list_transform(string_split({s}, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
_FOLDED = "regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')"
_LETTERS = f"regexp_replace({_FOLDED}, '[^A-Za-z\\-\\t\\n\\x0B\\f\\r\\x1C-\\x1F ]', ' ', 'g')"
_NOHYPHEN = f"regexp_replace({_LETTERS}, '-', ' ', 'g')"
_WORDS = f"string_split_regex({_NOHYPHEN}, '[\\t\\n\\x0B\\f\\r\\x1C-\\x1F ]+')"
# fixed values: the stop words of place names
_STOPS = "['uniao', 'das', 'dos', 'de', 'da', 'do', 'freguesia', 'freguesias', 'municipio']"
_NOSTOP = f"array_to_string(list_filter({_WORDS}, lambda x: x <> '' AND NOT list_contains({_STOPS}, lower(x))), ' ')"
sql("clean_place_names", f"""
SELECT doc_id, COALESCE(trim({_TITLE.format(s=_NOSTOP)}), '') AS text_clean FROM documents
""")

sql("strip_control_chars", """
SELECT doc_id,
       trim(regexp_replace(regexp_replace(text, '[\\x00-\\x1F\\x7F-\\x9F]', '', 'g'), '\\x{FFFD}', '', 'g'))
           AS text
FROM documents
""")

sql("sentiment_label", """
WITH tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents),
lex AS (SELECT w, (('0x' || substr(md5(w), 1, 4))::INTEGER % 17 - 8) / 8.0::DOUBLE AS polarity FROM (SELECT DISTINCT w FROM tok WHERE w <> '')),
sc AS (SELECT doc_id, AVG(polarity) AS p FROM tok JOIN lex USING (w) GROUP BY doc_id)
SELECT doc_id, ROUND(COALESCE(p, 0.0), 6) AS polarity,
       CASE WHEN COALESCE(p, 0.0) > 0.1::DOUBLE THEN 'positive'
            WHEN COALESCE(p, 0.0) < -0.1::DOUBLE THEN 'negative' ELSE 'neutral' END AS sentiment
FROM documents LEFT JOIN sc USING (doc_id)
""")

sql("json_to_tables", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")

sql("infer_json_columns", """
WITH kv AS (SELECT unnest(json_keys(props)) AS path, props FROM events WHERE props IS NOT NULL),
typed AS (SELECT path, json_type(props, '$."' || path || '"') AS jt FROM kv),
kinds AS (
    SELECT path,
           CASE WHEN jt IN ('BIGINT', 'UBIGINT', 'INTEGER') THEN 'int'
                WHEN jt = 'DOUBLE' THEN 'float' WHEN jt = 'BOOLEAN' THEN 'boolean'
                WHEN jt = 'NULL' THEN NULL WHEN jt = 'OBJECT' THEN 'object'
                WHEN jt = 'ARRAY' THEN 'array' ELSE 'text' END AS kind
    FROM typed
)
SELECT path, array_to_string(list_sort(list_distinct(list(kind))), ',') AS kinds,
       CASE WHEN COUNT(DISTINCT kind) <> 1 THEN 'VARCHAR(255)'
            WHEN MIN(kind) = 'boolean' THEN 'BOOLEAN' WHEN MIN(kind) = 'int' THEN 'INT'
            WHEN MIN(kind) = 'float' THEN 'FLOAT' WHEN MIN(kind) = 'object' THEN 'OBJECT'
            WHEN MIN(kind) = 'array' THEN 'ARRAY' ELSE 'VARCHAR(255)' END AS sql_type,
       COUNT(DISTINCT kind) > 1 AS conflict, COUNT(*) AS n_values
FROM kinds GROUP BY path
""")

# ------------------------------------------------------------------ graph
sql("bfs_levels", """
WITH RECURSIVE edges AS (
    SELECT l_partkey AS src, -1 - l_suppkey AS dst FROM lineitem
    UNION
    SELECT -1 - l_suppkey AS src, l_partkey AS dst FROM lineitem
), walk(vertex, hops) USING KEY (vertex) AS (
    SELECT CAST(0 AS BIGINT), 0
    UNION
    (SELECT e.dst, MIN(w.hops) + 1 FROM walk w JOIN edges e ON w.vertex = e.src
     WHERE e.dst NOT IN (SELECT vertex FROM recurring.walk) GROUP BY e.dst)
)
SELECT vertex, hops FROM walk
""")

# ------------------------------------------------------------------ sources
sql("read_table", """
SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000
""")

sql("dedup_partition", """
WITH li AS (SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ship_month
            FROM lineitem)
SELECT * FROM li WHERE ship_month <> 199803
UNION ALL
SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
    FROM li WHERE ship_month = 199803
) WHERE rn = 1
""")

sql("ingest_full", "SELECT * EXCLUDE (c_acctbal) FROM customer")
sql("ingest_compare", """
SELECT 1 AS run, 'SUCCESS' AS status, COUNT(*) AS records FROM customer
UNION ALL
SELECT 2, 'SKIPPED', COUNT(*) FROM customer
""")
sql("ingest_incremental", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS changed_at FROM orders
""")
sql("ingest_merge", """
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, CASE WHEN o_totalprice > 400000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
sql("copy_table_if_absent", "SELECT * FROM lineitem")
sql("convert_format", "SELECT * FROM orders")
sql("compact_table", "SELECT * FROM lineitem")

sql("parse_log", """
WITH e AS (
    SELECT *, CASE WHEN event_type = 'error' THEN 'ERROR'
                   WHEN event_type = 'purchase' THEN 'WARNING' ELSE 'INFO' END AS lvl,
              'user ' || CAST(user_id AS VARCHAR) || ' event ' || CAST(event_id AS VARCHAR) AS msg,
              strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' ||
                  lpad(CAST(CAST(floor(microsecond(ts) / 1000) AS INTEGER) % 1000 AS VARCHAR), 3, '0') AS stamp
    FROM events
)
SELECT stamp AS Log_Date, lvl AS Level, 'app.' || event_type AS Logger, msg AS Message,
       CASE WHEN lvl = 'ERROR' THEN msg END AS Exception_Message,
       CASE WHEN lvl = 'ERROR' THEN 'Traceback (most recent call last):' || chr(10) ||
                                    'ValueError: event ' || CAST(event_id AS VARCHAR) END AS Stack_Trace,
       stamp || ' ' || lvl || ' app.' || event_type || ' ' || msg ||
           CASE WHEN lvl = 'ERROR' THEN chr(10) || 'Traceback (most recent call last):' || chr(10) ||
                                        'ValueError: event ' || CAST(event_id AS VARCHAR) ELSE '' END
           AS Raw_Line
FROM e
""")

sql("persist_log", """
WITH e AS (
    SELECT *, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARNING' ELSE 'INFO' END AS lvl,
              event_type = 'purchase' AND user_id % 7 = 0 AS bad
    FROM events
)
SELECT 'test' AS Env, Run_ID, NULL::VARCHAR AS Log_Date, CASE WHEN bad THEN 'PARSE_ERROR' ELSE lower(lvl) END AS Level,
       CASE WHEN NOT bad THEN 'user-' || user_id END AS Logger,
       CASE WHEN bad THEN 'PARSE_FAIL: event ' || event_id ELSE event_id::VARCHAR END AS Message,
       strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || lpad(CAST(CAST(floor(microsecond(ts) / 1000) AS INTEGER) % 1000 AS VARCHAR), 3, '0')
           || ' ' || lvl || ' app.' || event_type || ' user ' || user_id || ' event ' || event_id
           || CASE WHEN lvl = 'ERROR' THEN chr(10) || 'Traceback (most recent call last):' || chr(10) || 'ValueError: event ' || event_id ELSE '' END
           AS Raw_Line
FROM e, (VALUES ('01'), ('a:b/c')) AS r(Run_ID)
""")

sql("schema_check", """
WITH bad AS (
    SELECT count(*) FILTER (o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS INTEGER) IS NULL) AS custkey,
           count(*) FILTER (o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(8, 2)) IS NULL) AS totalprice,
           count(*) FILTER (o_orderdate IS NOT NULL AND TRY_CAST(o_orderdate AS DATE) IS NULL) AS orderdate
    FROM orders
)
SELECT r.column_name, r.expected_type, r.actual_type, r.status,
       CASE r.column_name WHEN 'o_custkey' THEN custkey WHEN 'o_totalprice' THEN totalprice WHEN 'o_orderdate' THEN orderdate END AS uncastable_rows
FROM bad, (VALUES ('o_orderkey', 'bigint', 'bigint', 'OK'), ('o_custkey', 'int', 'bigint', 'TYPE_MISMATCH'),
                  ('o_orderstatus', 'string', 'string', 'OK'), ('o_totalprice', 'decimal(8,2)', 'double', 'TYPE_MISMATCH'),
                  ('o_orderdate', 'date', 'timestamp_ntz', 'TYPE_MISMATCH'), ('o_comment', 'string', NULL, 'MISSING'),
                  ('o_orderpriority', NULL, 'string', 'EXTRA')) AS r(column_name, expected_type, actual_type, status)
""")

_ODD = """CASE ({k}) % 7 WHEN 0 THEN '01' WHEN 1 THEN '1' WHEN 2 THEN 'a:b' WHEN 3 THEN 'x/y' WHEN 4 THEN 'a=b'
          WHEN 5 THEN '2024-01-02' END AS p, '0' || (({k}) % 3) AS q"""
sql("dedup_partition_values", f"""
SELECT o_orderkey, o_custkey, p, q FROM (
    SELECT o_orderkey, o_custkey, {_ODD.format(k='o_orderkey')},
           row_number() OVER (PARTITION BY o_orderkey % 3, o_custkey ORDER BY o_orderdate, o_orderkey) AS nth
    FROM orders)
WHERE q <> '01' OR nth = 1
""")
sql("ingest_merge_values", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 21 = 3 THEN 'L' WHEN o_totalprice > 300000 THEN 'M' ELSE o_orderstatus END AS o_orderstatus,
                  CASE WHEN o_orderkey % 21 = 3 THEN 0 WHEN o_totalprice > 300000 THEN o_orderkey + 1 ELSE o_orderkey END AS place
           FROM orders)
SELECT o_orderkey, o_orderstatus, {_ODD.format(k='place')} FROM o
""")
sql("compact_table_values", f"SELECT o_orderkey, o_totalprice, {_ODD.format(k='o_orderkey')} FROM orders")

# ------------------------------------------------------------------ streaming
sql("session_summary_stream", """
WITH g AS (
    SELECT user_id, event_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
    FROM events
), f AS (
    SELECT *, CASE WHEN prev IS NULL OR ts - prev > INTERVAL '30 minutes' THEN 1 ELSE 0 END AS ns FROM g
), s AS (
    SELECT *, SUM(ns) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM f
), sessions AS (
    SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL '30 minutes' AS session_end,
           COUNT(*) AS event_count
    FROM s GROUP BY user_id, sid
)
SELECT * FROM sessions
WHERE session_end <= (SELECT MAX(ts) FROM events) - INTERVAL '10 minutes'
""")

sql("merge_insert_new_stream", """
SELECT event_id, user_id,
       CASE WHEN event_id % 3 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END
            WHEN event_id % 2 = 0 THEN ts - INTERVAL 9 DAY ELSE ts + INTERVAL 1 DAY END AS ts,
       CASE WHEN event_id % 3 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN value - 1 ELSE value END ELSE value + 1000 END AS value
FROM events
""")

sql("shortest_paths", """
WITH RECURSIVE pairs AS (
    SELECT l_partkey, l_suppkey, MIN(l_quantity) AS w FROM lineitem GROUP BY 1, 2
), edges AS (
    SELECT l_partkey AS src, -1 - l_suppkey AS dst, w FROM pairs
    UNION ALL
    SELECT -1 - l_suppkey AS src, l_partkey AS dst, w FROM pairs
), sp(vertex, distance) USING KEY (vertex) AS (
    SELECT CAST(0 AS BIGINT), CAST(0.0 AS DOUBLE)
    UNION
    (SELECT e.dst, MIN(s.distance + e.w)
     FROM sp s JOIN edges e ON s.vertex = e.src
     LEFT JOIN recurring.sp cur ON cur.vertex = e.dst
     GROUP BY e.dst
     HAVING MIN(s.distance + e.w) < COALESCE(MIN(cur.distance), CAST('inf' AS DOUBLE)))
), vertices AS (
    SELECT src AS vertex FROM edges UNION SELECT dst FROM edges UNION SELECT CAST(0 AS BIGINT)
)
SELECT v.vertex, sp.distance, FALSE AS negative_cycle
FROM vertices v LEFT JOIN sp ON v.vertex = sp.vertex
""")

sql("shortest_paths_chain", """
SELECT o_orderkey AS vertex,
       CAST(date_diff('day', MIN(o_orderdate) OVER (), o_orderdate)
            + row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS DOUBLE) AS distance,
       FALSE AS negative_cycle
FROM orders
""")

sql("json_to_tables_children", """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(CAST(CEIL(l.l_linenumber / 4) AS BIGINT) AS VARCHAR) AS root_id,
       l.l_partkey AS product_id, l.l_extendedprice AS price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

sql("json_data_keys", """
SELECT o_custkey || '-' || CAST(floor(o_orderkey / 64) AS BIGINT) AS root_id, CAST(o_orderkey AS VARCHAR) AS key,
       max(o_totalprice) AS total, arg_max(o_orderstatus, o_totalprice) AS status
FROM orders GROUP BY o_custkey, o_orderkey
""")

sql("small_file_report", """
SELECT l_returnflag, count(DISTINCT strftime(l_shipdate, '%Y%m')) AS num_files, TRUE AS has_bytes, TRUE AS small_files, FALSE AS too_many_files, TRUE AS needs_compaction
FROM lineitem GROUP BY l_returnflag
""")

# nested documents: one per order and 4 lines, see bindings.nested_payloads
_DOCS = """
SELECT l_orderkey AS o, CAST(ceil(l_linenumber / 4) AS BIGINT) AS c, l_orderkey || '-' || CAST(ceil(l_linenumber / 4) AS BIGINT) AS doc,
       list(struct_pack(part := l_partkey, supp := l_suppkey, line := l_linenumber, price := l_extendedprice)
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS held
FROM lineitem GROUP BY ALL
"""
_ELEMENTS = f"SELECT doc, generate_subscripts(held, 1) - 1 AS i, unnest(held) AS x FROM ({_DOCS})"
sql("json_nested_root", f"""
SELECT doc AS doc_key, 2 * o AS twice, o AS id, c AS quoted,
       CASE WHEN o % 2 = 0 THEN o::VARCHAR ELSE '{{"n":' || o || '}}' END AS mixed, 'x' || c AS dotted
FROM ({_DOCS})
""")
sql("json_nested_field_root", f"SELECT doc AS root_id, o % 2 = 0 AS even FROM ({_DOCS})")
sql("json_nested_a_items", f"SELECT doc AS root_id, i::INTEGER AS pos_1, x.part AS value FROM ({_ELEMENTS})")
sql("json_nested_b_items", f"SELECT doc AS root_id, i::INTEGER AS pos_1, x.price AS price FROM ({_ELEMENTS})")
sql("json_nested_tags", f"""
SELECT doc AS root_id, i::INTEGER AS pos_1, j::INTEGER AS pos_2, k::INTEGER AS pos_3,
       CASE WHEN k = 0 THEN x.supp ELSE x.line END AS value
FROM ({_ELEMENTS}), range(2) AS a(j), range(2) AS b(k)
""")
sql("infer_json_columns_nested", f"""
WITH n AS (SELECT COUNT(*) AS docs, SUM(len(held)) AS els FROM ({_DOCS}))
SELECT p.path, p.kinds, p.sql_type, p.conflict, CAST(CASE p.per WHEN 0 THEN docs ELSE els * p.per END AS BIGINT) AS n_values
FROM n, (VALUES ('id', 'int', 'INT', FALSE, 0), ('Id', 'int', 'INT', FALSE, 0), ('`it''s`', 'int', 'INT', FALSE, 0),
                ('`p.q`', 'text', 'VARCHAR(255)', FALSE, 0), ('mixed', 'int,object', 'VARCHAR(255)', TRUE, 0),
                ('root', 'object', 'OBJECT', FALSE, 0), ('root.even', 'boolean', 'BOOLEAN', FALSE, 0),
                ('a', 'object', 'OBJECT', FALSE, 0), ('a.items', 'array', 'ARRAY', FALSE, 0), ('a.items[]', 'int', 'INT', FALSE, 1),
                ('b', 'object', 'OBJECT', FALSE, 0), ('b.items', 'array', 'ARRAY', FALSE, 0), ('b.items[]', 'object', 'OBJECT', FALSE, 1),
                ('b.items[].price', 'float', 'FLOAT', FALSE, 1), ('b.items[].tags', 'array', 'ARRAY', FALSE, 1),
                ('b.items[].tags[]', 'array', 'ARRAY', FALSE, 2), ('b.items[].tags[][]', 'int', 'INT', FALSE, 4)) AS p(path, kinds, sql_type, conflict, per)
""")
