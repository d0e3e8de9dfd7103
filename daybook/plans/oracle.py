"""DuckDB SQL equivalents of the registered queries (same keys, same column names).

The tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views over the
same Parquet files.  Each statement is written from the query's meaning, not
from its Spark plan, so agreement is evidence that both are right.
"""

from __future__ import annotations

_STATION_DAY = """
    SELECT user_id AS station_id, CAST(ts AS DATE) AS day,
           avg(CASE WHEN event_type = 'click' THEN value END) AS click,
           avg(CASE WHEN event_type = 'error' THEN value END) AS error,
           avg(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
           avg(CASE WHEN event_type = 'signup' THEN value END) AS signup,
           avg(CASE WHEN event_type = 'view' THEN value END) AS "view"
    FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL AND ts IS NOT NULL
    GROUP BY 1, 2
"""

_TYPES = ["click", "error", "purchase", "signup", "view"]


def _fill_sql(direction: str) -> str:
    if direction == "backward":
        frame = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
        fn = "first_value"
    else:
        frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        fn = "last_value"
    cols = ",\n           ".join(
        f'{fn}("{t}" IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY day {frame}) AS "{t}"'
        for t in _TYPES)
    return f"""
    WITH p AS ({_STATION_DAY})
    SELECT station_id, day,
           {cols}
    FROM p
    """


ORACLE: dict[str, str] = {
    "q01_json_field": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events WHERE props IS NOT NULL AND json_valid(props)
    """,
    "q02_recode_lookup": """
        WITH cust AS (
            SELECT c_custkey,
                   CASE WHEN 'n' || CAST(c_nationkey AS VARCHAR) = 'n24' THEN 'n4'
                        ELSE 'n' || CAST(c_nationkey AS VARCHAR) END AS state
            FROM customer),
        codes AS (
            SELECT substr(lower('IN-N' || CAST(n_nationkey AS VARCHAR)), 4) AS code,
                   max(n_name) AS state_name
            FROM nation GROUP BY 1)
        SELECT c_custkey, state, state_name FROM cust LEFT JOIN codes ON state = code
    """,
    "q03_day_prefix": """
        SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 10) AS day FROM events
    """,
    "q04_split_cells": """
        WITH t AS (
            SELECT l_orderkey, l_linenumber,
                   CAST(l_orderkey AS VARCHAR) || ' ' || CAST(l_partkey AS VARCHAR) || ' ' ||
                   CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END
                   AS packed
            FROM lineitem)
        SELECT l_orderkey, l_linenumber,
               TRY_CAST(string_split(packed, ' ')[1] AS BIGINT) AS p1,
               TRY_CAST(string_split(packed, ' ')[2] AS BIGINT) AS p2,
               TRY_CAST(string_split(packed, ' ')[3] AS BIGINT) AS p3,
               TRY_CAST(string_split(packed, ' ')[4] AS BIGINT) AS p4
        FROM t
    """,
    "q05_clean_number": """
        SELECT o_orderkey,
               CAST(floor(o_totalprice) AS BIGINT) AS a_num,
               CASE WHEN o_orderstatus IN ('P', 'O') THEN 0 ELSE o_custkey * 1000 END AS b_num,
               CAST(floor(o_totalprice) AS BIGINT)
                 + CASE WHEN o_orderstatus IN ('P', 'O') THEN 0 ELSE o_custkey * 1000 END AS total
        FROM orders
    """,
    "q06_replace_values": """
        WITH r1 AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO'
                                           ELSE c_mktsegment END AS s FROM customer),
             r2 AS (SELECT c_custkey, CASE WHEN s = 'AUTO' THEN 'CAR' ELSE s END AS s FROM r1),
             r3 AS (SELECT c_custkey, CASE WHEN s = 'BUILDING' THEN 'BUILDING*' ELSE s END AS s
                    FROM r2),
             r4 AS (SELECT c_custkey, CASE WHEN s = 'MACHINERY*' THEN 'MACHINE' ELSE s END AS s
                    FROM r3)
        SELECT c_custkey, CASE WHEN c_custkey = 7 THEN 'PATCHED' ELSE s END AS c_mktsegment
        FROM r4
    """,
    "q07_any_column": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
        WHERE NOT coalesce(l_returnflag = 'R' OR l_linestatus = 'R', false)
    """,
    "q08_group_sum": """
        SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag,
               coalesce(sum(l_quantity), 0) AS sum_qty,
               CAST(CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS DOUBLE)
                 AS sum_price,
               count(*) AS n_lines, 'lineitem' AS source
        FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL
        GROUP BY 1, 2
    """,
    "q09_right_join_drop": """
        SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, o.o_totalprice
        FROM lineitem l RIGHT JOIN orders o ON o.o_orderkey = l.l_orderkey
        WHERE l.l_orderkey IS NOT NULL
    """,
    "q10_filter_project": """
        SELECT c_custkey AS custkey,
               coalesce(CASE WHEN c_nationkey = 5 THEN NULL ELSE c_name END, 'UNKNOWN') AS name,
               c_nationkey AS region_key, c_acctbal AS balance
        FROM customer
        WHERE c_mktsegment = 'BUILDING' AND NOT coalesce(c_nationkey = 3 AND c_acctbal < 0, false)
    """,
    "q11_pivot_mean": _STATION_DAY,
    "q12_mean_of_means": f"""
        WITH p AS ({_STATION_DAY})
        SELECT day, CAST(station_id % 7 AS BIGINT) AS station_group,
               avg(click) AS click, avg(error) AS error, avg(purchase) AS purchase,
               avg(signup) AS signup, avg("view") AS "view"
        FROM p GROUP BY 1, 2
    """,
    "q13_station_label": """
        WITH l AS (
            SELECT p_partkey,
                   CASE WHEN p_size < 10 THEN p_name || ', ' || p_brand || ' - ' || p_type
                        WHEN p_size < 20 THEN p_type || ' - ' || p_name || ' - ' || p_brand
                        WHEN p_size < 30 THEN ' ' || p_name || ', ' || p_brand || ' '
                        ELSE p_name || '-' END AS label
            FROM part)
        SELECT p_partkey, label,
               CASE WHEN strpos(label, '-') > 0 AND strpos(label, ',') > 0
                    THEN trim(string_split(string_split(label, '-')[-2], ',')[-1])
                    ELSE label END AS city,
               CASE WHEN strpos(label, '-') > 0 THEN trim(string_split(label, '-')[2])
                    ELSE trim(label) END AS board
        FROM l
    """,
    "q14_fanout_join": """
        SELECT n.n_nationkey, n.n_name, s.s_suppkey, s.s_name
        FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey
    """,
    "q15_fill_backward": _fill_sql("backward"),
    "q16_fill_forward": _fill_sql("forward"),
    "q17_round": """
        SELECT l_orderkey, l_linenumber,
               round_even(l_extendedprice * l_discount * 100, 0) / 100 AS disc_value
        FROM lineitem
    """,
    "q18_impute_mean": f"""
        WITH p AS ({_STATION_DAY})
        SELECT station_id, day,
               coalesce(click, avg(click) OVER (PARTITION BY station_id)) AS click,
               coalesce(error, avg(error) OVER (PARTITION BY station_id)) AS error,
               coalesce(purchase, avg(purchase) OVER (PARTITION BY station_id)) AS purchase,
               coalesce(signup, avg(signup) OVER (PARTITION BY station_id)) AS signup,
               coalesce("view", avg("view") OVER (PARTITION BY station_id)) AS "view"
        FROM p
    """,
    "q19_mixed_rollup": """
        SELECT CAST(o_orderdate AS DATE) AS day,
               CAST(CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS DOUBLE)
                 AS sum_price,
               count(*) AS n_orders, avg(o_totalprice) AS avg_price
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
    """,
    "q20_series_chain": """
        WITH s AS (
            SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS st,
                   CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS DOUBLE) AS total
            FROM orders GROUP BY 1, 2),
        c AS (SELECT CAST(o_orderdate AS DATE) AS "Date", count(*) AS n_orders
              FROM orders GROUP BY 1)
        SELECT f.day, f.total AS total_f, o.total AS total_o, p.total AS total_p, c.n_orders
        FROM (SELECT * FROM s WHERE st = 'F') f
        LEFT JOIN (SELECT * FROM s WHERE st = 'O') o ON f.day = o.day
        LEFT JOIN (SELECT * FROM s WHERE st = 'P') p ON f.day = p.day
        LEFT JOIN c ON f.day = c."Date"
    """,
    "q21_global_ffill": """
        WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
        u AS (SELECT CAST(o_orderdate AS DATE) AS day,
                     CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS DOUBLE)
                       AS urgent_total
              FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
        sparse AS (SELECT d.day, u.urgent_total FROM days d
                   LEFT JOIN u ON d.day = u.day AND dayofweek(u.day) NOT IN (0, 6))
        SELECT day, last_value(urgent_total IGNORE NULLS) OVER (
                   ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS urgent_total
        FROM sparse
    """,
    "q22_date_text": """
        SELECT o_orderkey, strftime(o_orderdate, '%d %b %Y') AS date_text,
               strftime(strptime(strftime(o_orderdate, '%d %b %Y'), '%d %b %Y'), '%Y-%m-%d')
                 AS day_text
        FROM orders
    """,
    "q23_unpivot": f"""
        WITH p AS ({_STATION_DAY})
        SELECT station_id, day, 'click' AS variable, click AS value FROM p
        UNION ALL SELECT station_id, day, 'error', error FROM p
        UNION ALL SELECT station_id, day, 'purchase', purchase FROM p
        UNION ALL SELECT station_id, day, 'signup', signup FROM p
        UNION ALL SELECT station_id, day, 'view', "view" FROM p
    """,
    "q24_quarter_mean": """
        SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)
                 AS quarter,
               avg(o_totalprice) AS avg_price
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1
    """,
    "q25_arg_extremes": """
        WITH per_cust AS (
            SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
            FROM orders GROUP BY 1),
        tot AS (
            SELECT n.n_name AS region, CAST(CAST(sum(p.s) AS DECIMAL(38,2)) AS DOUBLE) AS total
            FROM per_cust p JOIN customer c ON p.o_custkey = c.c_custkey
            LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
            WHERE n.n_name IS NOT NULL GROUP BY 1),
        hi AS (SELECT region, total FROM tot ORDER BY total DESC, region LIMIT 1),
        lo AS (SELECT region, total FROM tot ORDER BY total ASC, region LIMIT 1)
        SELECT (SELECT region FROM hi) AS max_region, (SELECT total FROM hi) AS max_total,
               (SELECT region FROM lo) AS min_region, (SELECT total FROM lo) AS min_total
    """,
    "q26_top_sorted": """
        SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
    """,
    "q27_summary": """
        SELECT count(value) AS n, avg(value) AS mean, stddev_samp(value) AS stddev,
               min(value) AS "min", max(value) AS "max", min(ts) AS first_ts, max(ts) AS last_ts
        FROM events
    """,
    "q28_profile": f"""
        WITH p AS ({_STATION_DAY})
        SELECT 'station_id' AS column_name, 'bigint' AS data_type, count(station_id) AS non_null
        FROM p
        UNION ALL SELECT 'day', 'date', count(day) FROM p
        UNION ALL SELECT 'click', 'double', count(click) FROM p
        UNION ALL SELECT 'error', 'double', count(error) FROM p
        UNION ALL SELECT 'purchase', 'double', count(purchase) FROM p
        UNION ALL SELECT 'signup', 'double', count(signup) FROM p
        UNION ALL SELECT 'view', 'double', count("view") FROM p
    """,
    "q29_distinct": """
        SELECT DISTINCT o_orderstatus FROM orders
    """,
    "q30_union_missing": """
        SELECT o_orderkey AS key, o_orderdate AS day, o_totalprice AS amount,
               CAST(NULL AS DOUBLE) AS qty FROM orders
        UNION ALL
        SELECT l_orderkey, l_shipdate, CAST(NULL AS DOUBLE), l_quantity FROM lineitem
    """,
    "q31_anchor_slice": """
        WITH body AS (SELECT conv_id, turn, role, length(text) AS n_chars
                      FROM conversations WHERE turn >= 1),
        a AS (SELECT conv_id, max(turn) AS anchor FROM body WHERE role = 'user' GROUP BY 1)
        SELECT b.conv_id, b.turn, b.role, b.n_chars
        FROM body b LEFT JOIN a ON b.conv_id = a.conv_id
        WHERE b.turn >= coalesce(a.anchor, 0)
    """,
    "q32_drop_empty_column": f"""
        WITH p AS ({_STATION_DAY}),
        l AS (
            SELECT station_id, CAST(date_trunc('week', day) AS DATE) AS week, day, 'click' AS variable,
                   click AS value FROM p
            UNION ALL SELECT station_id, CAST(date_trunc('week', day) AS DATE), day, 'error', error FROM p
            UNION ALL SELECT station_id, CAST(date_trunc('week', day) AS DATE), day, 'purchase', purchase FROM p
            UNION ALL SELECT station_id, CAST(date_trunc('week', day) AS DATE), day, 'signup', signup FROM p
            UNION ALL SELECT station_id, CAST(date_trunc('week', day) AS DATE), day, 'view', "view" FROM p),
        k AS (SELECT station_id, week, variable FROM l GROUP BY 1, 2, 3 HAVING count(value) > 0)
        SELECT l.* FROM l JOIN k USING (station_id, week, variable)
    """,
    "q33_catalog_sql": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    """,
    "q34_csv_roundtrip": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
    "q35_text_helpers": """
        WITH t AS (SELECT p_partkey, p_brand, p_type, p_name,
                          p_name || chr(13) || '(' || p_type || ' x)' AS two_line FROM part)
        SELECT p_partkey,
               regexp_replace(p_brand, '\\d+', '', 'g') AS brand_letters,
               TRY_CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS DOUBLE) AS brand_no,
               TRY_CAST(p_type AS DOUBLE) AS type_no,
               substr(string_split(p_name, ' ')[1], 2) AS name_tail,
               string_split(two_line, chr(13) || '(')[1] AS head,
               string_split(string_split(two_line, chr(13) || '(')[2], ' ')[1] AS tail
        FROM t
    """,
}


# --------------------------------------------------------------------------- stages T1-T9

_DOSES = ["dose_1", "dose_2", "15_18_years_dose_1", "15_18_years_dose_2",
          "12_14_years_dose_1", "12_14_years_dose_2", "precaution_dose", "total_doses"]
_Q_DOSES = ", ".join(f'"{d}"' for d in _DOSES)

_T1 = """
    t1_cases AS (
        SELECT CAST(o.o_orderdate AS DATE) AS day, c.c_nationkey,
               CAST(sum(floor(o.o_totalprice)) AS BIGINT) AS confirmed,
               count(CASE WHEN o.o_orderstatus = 'O' THEN 1 END) AS cured,
               count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS death
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
    t1_codes AS (
        SELECT substr(lower('IN-N' || CAST(n_nationkey AS VARCHAR)), 4) AS code,
               max(n_name) AS state_name
        FROM nation GROUP BY 1),
    t1 AS (
        SELECT x.report_time, x.state, x.cured, x.death, x.confirmed, k.state_name
        FROM (SELECT day AS report_time,
                     CASE WHEN c_nationkey = 24 THEN 'n4'
                          ELSE 'n' || CAST(c_nationkey AS VARCHAR) END AS state,
                     CAST(cured AS BIGINT) AS cured, CAST(death AS BIGINT) AS death,
                     CAST(confirmed AS BIGINT) AS confirmed
              FROM t1_cases) x
        LEFT JOIN t1_codes k ON x.state = k.code)
"""

_ROWS36 = """
    r36_li AS (
        SELECT CAST(l.l_shipdate AS DATE) AS day,
               CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS doc_index,
               l.l_linenumber AS rel_row, year(l.l_shipdate) AS yr,
               CASE WHEN n.n_nationkey = 24 THEN n.n_name || '*' ELSE n.n_name END AS region,
               CAST(l.l_quantity AS BIGINT) AS d1, CAST(floor(l.l_extendedprice) AS BIGINT) AS d2,
               CAST(round(l.l_discount * 100) AS BIGINT) AS t1,
               CAST(l.l_linenumber AS BIGINT) AS pa, CAST(round(l.l_tax * 100) AS BIGINT) AS pb
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey),
    r36 AS (
        SELECT day, doc_index, rel_row, region,
               d1 AS dose_1, d2 AS dose_2,
               CASE WHEN yr <= 1994 THEN 0 ELSE t1 END AS "15_18_years_dose_1",
               CAST(0 AS BIGINT) AS "15_18_years_dose_2",
               CAST(0 AS BIGINT) AS "12_14_years_dose_1",
               CAST(0 AS BIGINT) AS "12_14_years_dose_2",
               CASE WHEN yr <= 1996 THEN 0 WHEN yr <= 1998 THEN pa + pb ELSE pa END
                 AS precaution_dose,
               CASE WHEN yr <= 1998 THEN d1 + d2 ELSE d1 + d2 + t1 END AS total_doses,
               0 AS rejects
        FROM r36_li)
"""

_T2 = _ROWS36 + """,
    t2_clean AS (
        SELECT day,
               CASE WHEN region = 'NATION_24*' THEN 'NATION_24'
                    WHEN region = 'NATION_23' THEN 'NATION_22' ELSE region END AS region,
               """ + _Q_DOSES + """
        FROM r36),
    t2 AS (
        SELECT day, region, """ + ", ".join(
    f'CAST(coalesce(sum("{d}"), 0) AS BIGINT) AS "{d}"' for d in _DOSES) + """
        FROM t2_clean WHERE day IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2)
"""

_T3 = _T1 + "," + _T2 + """,
    t3 AS (
        SELECT t1.report_time, t1.state_name, t1.cured, t1.death, t1.confirmed, """ + ", ".join(
    f't2."{d}"' for d in _DOSES) + """
        FROM t1 RIGHT JOIN t2 ON t1.report_time = t2.day AND t1.state_name = t2.region)
"""

_T4 = """
    t4_r AS (
        SELECT 'Sector-' || CAST(user_id % 10 AS VARCHAR) || ', Station ' ||
                 CAST(user_id AS VARCHAR) || ' - SPCB' AS location,
               'City ' || CAST(user_id % 10 AS VARCHAR) AS city, 'IN' AS country,
               event_type AS pollutant, value, ts
        FROM events),
    t4_p AS (
        SELECT country, city, location, CAST(ts AS DATE) AS day,
               avg(CASE WHEN pollutant = 'click' THEN value END) AS click,
               avg(CASE WHEN pollutant = 'error' THEN value END) AS error,
               avg(CASE WHEN pollutant = 'purchase' THEN value END) AS purchase,
               avg(CASE WHEN pollutant = 'signup' THEN value END) AS signup,
               avg(CASE WHEN pollutant = 'view' THEN value END) AS "view"
        FROM t4_r WHERE country = 'IN' AND value IS NOT NULL
        GROUP BY 1, 2, 3, 4),
    t4 AS (
        SELECT *,
               CASE WHEN strpos(location, '-') > 0 AND strpos(location, ',') > 0
                    THEN trim(string_split(string_split(location, '-')[-2], ',')[-1])
                    ELSE location END AS city_refined,
               CASE WHEN strpos(location, '-') > 0 THEN trim(string_split(location, '-')[2])
                    ELSE trim(location) END AS pollution_board
        FROM t4_p)
"""

_T5 = _T4 + """,
    t5_cities AS (
        SELECT 'Station ' || CAST(s.s_suppkey AS VARCHAR) AS city, n.n_name AS state
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
    t5_mean AS (
        SELECT t4.day, c.state AS region, """ + ",\n               ".join(
    f'CAST(sum(CAST("{t}" AS DECIMAL(38, 10))) AS DOUBLE) / count("{t}") AS "{t}"' for t in _TYPES) + """
        FROM t4 LEFT JOIN t5_cities c ON t4.city_refined = c.city
        WHERE t4.day IS NOT NULL AND c.state IS NOT NULL GROUP BY 1, 2),
    t5_fill AS (
        SELECT day, region, """ + ",\n               ".join(
    f'first_value("{t}" IGNORE NULLS) OVER (PARTITION BY region ORDER BY day '
    f'ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS "{t}"' for t in _TYPES) + """
        FROM t5_mean),
    t5 AS (
        SELECT day, region, """ + ", ".join(
    f'round_even("{t}" * 100, 0) / 100 AS "{t}"' for t in _TYPES) + """
        FROM t5_fill)
"""

_T6 = _T3 + "," + _T5 + """,
    t6_j AS (
        SELECT t3.*, """ + ", ".join(f't5."{t}"' for t in _TYPES) + """
        FROM t3 LEFT JOIN t5 ON t3.report_time = t5.day AND t3.state_name = t5.region),
    t6 AS (
        SELECT report_time, state_name, cured, death, confirmed, """ + _Q_DOSES + """,
               """ + ", ".join(
    f'coalesce("{t}", CASE WHEN state_name IS NOT NULL THEN avg("{t}") OVER '
    f'(PARTITION BY state_name) END) AS "{t}"' for t in _TYPES) + """
        FROM t6_j)
"""
_T6_FINAL = "(SELECT * FROM t6 WHERE report_time IS NOT NULL)"

_SUMS = ["cured", "death", "confirmed"] + _DOSES

_T7 = _T6 + """,
    t7 AS (
        SELECT report_time, """ + ", ".join(
    f'CAST(coalesce(sum("{c}"), 0) AS BIGINT) AS "{c}"' for c in _SUMS) + ", " + ", ".join(
    f'avg("{t}") AS "{t}"' for t in _TYPES) + """
        FROM """ + _T6_FINAL + """ x WHERE report_time IS NOT NULL GROUP BY 1)
"""

_CLOSES = [("close_nifty_50", "o_orderstatus = 'F'"), ("close_nifty_500", "o_orderstatus = 'O'"),
           ("close_nifty_healthcare", "o_orderstatus = 'P'"),
           ("close_nifty_IT", "o_orderpriority = '1-URGENT'"),
           ("close_nifty_pharma", "o_orderpriority = '5-LOW'")]

_T8 = ",\n".join(
    f"""    t8_{i} AS (SELECT CAST(o_orderdate AS DATE) AS "Date", avg(o_totalprice) AS "{name}"
               FROM orders WHERE {cond} GROUP BY 1)""" for i, (name, cond) in enumerate(_CLOSES)) \
    + """,
    t8 AS (
        SELECT t8_0."Date", """ + ", ".join(f't8_{i}."{n}"' for i, (n, _) in enumerate(_CLOSES)) \
    + """
        FROM t8_0 """ + " ".join(f'LEFT JOIN t8_{i} ON t8_0."Date" = t8_{i}."Date"'
                                for i in range(1, len(_CLOSES))) + ")\n"

_CLOSE_NAMES = [n for n, _ in _CLOSES]

_T9 = _T7 + "," + _T8 + """,
    t9 AS (
        SELECT t7.*, """ + ",\n               ".join(
    f'last_value(t8."{n}" IGNORE NULLS) OVER (ORDER BY t7.report_time '
    f'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "{n}"' for n in _CLOSE_NAMES) + """
        FROM t7 LEFT JOIN t8 ON t7.report_time = t8."Date")
"""

ORACLE.update({
    "q36_layouts": "WITH " + _ROWS36 + " SELECT * FROM r36",
    "q40_case_table": "WITH " + _T1 + " SELECT * FROM t1",
    "q41_vaccination_region": "WITH " + _T2 + " SELECT * FROM t2",
    "q42_cases_vaccination": "WITH " + _T3 + " SELECT * FROM t3",
    "q43_station_day": "WITH " + _T4 + " SELECT * FROM t4",
    "q44_pollution_region": "WITH " + _T5 + " SELECT * FROM t5",
    "q45_combined_region": "WITH " + _T6 + " SELECT * FROM " + _T6_FINAL + " x",
    "q46_country_day": "WITH " + _T7 + " SELECT * FROM t7",
    "q47_closes_day": "WITH " + _T8 + " SELECT * FROM t8",
    "q48_country_closes": "WITH " + _T9 + " SELECT * FROM t9",
    "q50_index_quarterly": "WITH " + _T8 + """,
        l AS (""" + " UNION ALL ".join(
        f"""SELECT "Date", '{n}' AS variable, "{n}" AS value FROM t8""" for n in _CLOSE_NAMES) + """)
        SELECT CAST(year("Date") AS VARCHAR) || 'Q' || CAST(quarter("Date") AS VARCHAR) AS quarter,
               variable, avg(value) AS mean_close
        FROM l GROUP BY 1, 2""",
    "q56_index_performance": "WITH " + _T8 + """,
        l AS (""" + " UNION ALL ".join(
        f"""SELECT "Date", '{n}' AS variable, "{n}" AS value FROM t8""" for n in _CLOSE_NAMES) + """)
        SELECT strftime("Date", '%Y-%m-%d') AS "Date", variable, value,
               CAST(year("Date") AS VARCHAR) || 'Q' || CAST(quarter("Date") AS VARCHAR) AS quarter
        FROM l""",
    "q37_document_position": """
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') || '.csv' AS file_name,
               CAST(dense_rank() OVER (ORDER BY strftime(l_shipdate, '%Y-%m-%d')) - 1 AS INTEGER) AS doc_index
        FROM lineitem
    """,
    "q59_fill_hot_key": """
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount,
               last_value(CASE WHEN l_discount > 0.02 THEN NULL ELSE l_extendedprice END IGNORE NULLS) OVER (
                   PARTITION BY l_returnflag
                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
        FROM lineitem
    """,
    "q60_fill_text_key": """
        SELECT c_custkey, c_name, first_value(CASE WHEN c_acctbal > 4000 THEN c_acctbal END IGNORE NULLS) OVER (
                   ORDER BY c_name, c_custkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c_acctbal
        FROM customer
    """,
    "q61_global_rank": """
        SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders
    """,
    "q62_rejected_records": """
        SELECT 'orders' AS source, CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 <> 0 THEN 'malformed'
                 ELSE 'no value' END AS reason,
               CASE WHEN o_orderkey % 97 = 0 THEN '{"value":{"k":' || o_orderkey
                    WHEN o_orderkey % 89 = 0 THEN '{"other":' || o_orderkey || '},'
                    ELSE '{"value":{"k":"n' || o_orderkey || '"}},' END AS text
        FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0
        UNION ALL
        SELECT 'customers', 'malformed',
               CASE WHEN c_custkey % 50 = 0 THEN c_custkey || '|' || c_name || '|1|extra'
                    WHEN c_custkey % 77 = 0 THEN 'x' || c_custkey || '|' || c_name || '|1'
                    ELSE CAST(c_custkey AS VARCHAR) END
        FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 77 = 0 OR c_custkey % 61 = 0
    """,
    "q63_catalog_series": "WITH " + _T8 + """ SELECT * FROM t8 WHERE year("Date") BETWEEN 1995 AND 1996""",
    "q64_table_summary": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count({c}) AS non_null,
                   {f"avg({c})" if t in ("bigint", "double") else "CAST(NULL AS DOUBLE)"} AS mean,
                   {f"stddev_samp({c})" if t in ("bigint", "double") else "CAST(NULL AS DOUBLE)"} AS stddev,
                   CAST({f"min({c})" if t in ("bigint", "double") else "NULL"} AS DOUBLE) AS min_number,
                   CAST({f"max({c})" if t in ("bigint", "double") else "NULL"} AS DOUBLE) AS max_number,
                   CAST({"NULL" if t in ("bigint", "double") else f"min({c})"} AS VARCHAR) AS min_text,
                   CAST({"NULL" if t in ("bigint", "double") else f"max({c})"} AS VARCHAR) AS max_text
            FROM orders"""
        for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))),
    "q65_skew_join": """
        WITH li AS (SELECT l_orderkey, l_linenumber,
                           CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 17 <> 0 THEN l_suppkey END AS suppkey
                    FROM lineitem)
        SELECT l_orderkey, l_linenumber, suppkey, s_name FROM li LEFT JOIN supplier ON suppkey = s_suppkey
    """,
    "q66_ambiguous_names": """
        SELECT right(c_name, 3) AS name, count(DISTINCT c_nationkey) AS n_values,
               array_to_string(list_sort(list(DISTINCT c_nationkey)), ',') AS nations
        FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 1
    """,
    "q51_measure_series": "WITH " + _T6 + """
        SELECT report_time,
               CAST(year(report_time) AS VARCHAR) || 'Q' || CAST(quarter(report_time) AS VARCHAR)
                 AS quarter, state_name, confirmed, purchase
        FROM """ + _T6_FINAL + " x",
    "q52_doses_cases": "WITH " + _T6 + """
        SELECT report_time, avg(total_doses) AS mean_total_doses, avg(confirmed) AS mean_confirmed
        FROM """ + _T6_FINAL + " x GROUP BY 1",
    "q53_deaths_quarterly": "WITH " + _T6 + """
        SELECT CAST(year(report_time) AS VARCHAR) || 'Q' || CAST(quarter(report_time) AS VARCHAR)
                 AS quarter, avg(death) AS mean_death
        FROM """ + _T6_FINAL + " x GROUP BY 1",
    "q54_region_extremes": "WITH " + _T1 + """,
        tot AS (SELECT state_name, CAST(coalesce(sum(death), 0) AS BIGINT) AS death FROM t1
                WHERE state_name IS NOT NULL GROUP BY 1),
        hi AS (SELECT * FROM tot ORDER BY death DESC, state_name LIMIT 1),
        lo AS (SELECT * FROM tot ORDER BY death ASC, state_name LIMIT 1)
        SELECT (SELECT state_name FROM hi) AS max_state_name, (SELECT death FROM hi) AS max_death,
               (SELECT state_name FROM lo) AS min_state_name,
               (SELECT death FROM lo) AS min_death""",
    "q55_region_ranking": "WITH " + _T1 + """
        SELECT state_name, CAST(coalesce(sum(death), 0) AS BIGINT) AS death FROM t1
        WHERE state_name IS NOT NULL GROUP BY 1""",
})


# --------------------------------------------------------------------------- dates at the edge
# Registered queries render their date columns as yyyy-MM-dd text.
DATE_COLUMNS = {
    "q08_group_sum": ["day"], "q11_pivot_mean": ["day"], "q12_mean_of_means": ["day"],
    "q15_fill_backward": ["day"], "q16_fill_forward": ["day"], "q18_impute_mean": ["day"],
    "q19_mixed_rollup": ["day"], "q20_series_chain": ["day"], "q21_global_ffill": ["day"],
    "q23_unpivot": ["day"], "q32_drop_empty_column": ["week", "day"], "q36_layouts": ["day"],
    "q40_case_table": ["report_time"], "q41_vaccination_region": ["day"],
    "q42_cases_vaccination": ["report_time"], "q43_station_day": ["day"],
    "q44_pollution_region": ["day"], "q45_combined_region": ["report_time"],
    "q46_country_day": ["report_time"], "q47_closes_day": ["Date"],
    "q48_country_closes": ["report_time"], "q51_measure_series": ["report_time"],
    "q52_doses_cases": ["report_time"], "q63_catalog_series": ["Date"],
}


def _dates_as_text(sql: str, cols: list[str]) -> str:
    repl = ", ".join(f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS deliverable"


for _key, _cols in DATE_COLUMNS.items():
    ORACLE[_key] = _dates_as_text(ORACLE[_key], _cols)
