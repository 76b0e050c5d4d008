"""Fixture views over the driver tables (shapes of the reference inputs).

Each text is plain SQL that runs unchanged in Spark and DuckDB; later views read
earlier ones.  The same text is inlined as CTEs in the DuckDB oracles.
"""

from __future__ import annotations

# Fixed fixture definitions, in creation order.
FIXTURE_SQL: dict[str, str] = {
    "fx_person": """
SELECT c_custkey AS patid, DATE '1930-01-01' + CAST((c_custkey*7919) % 25000 AS INT) AS birth_date, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex, CASE c_custkey % 7 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '03' WHEN 3 THEN 'NI' WHEN 4 THEN NULL WHEN 5 THEN '07' ELSE '05' END AS race, CASE c_custkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS hispanic FROM customer
""",
    "fx_person_alt": """
SELECT c_custkey AS patid, CASE c_custkey % 4 WHEN 0 THEN '05' WHEN 1 THEN '03' WHEN 2 THEN NULL ELSE 'UN' END AS race, CASE c_custkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS hispanic, 'F' AS sex FROM customer WHERE c_custkey % 3 <> 0
""",
    "fx_crosswalk": """
SELECT c_custkey AS patid, c_custkey + 1000000 AS ctx_id FROM customer WHERE c_custkey % 10 <> 0
""",
    "fx_coverage": """
SELECT c_custkey AS patid, DATE '1994-06-01' + CAST(c_custkey % 900 AS INT) AS cov_start, DATE '1996-12-01' + CAST((c_custkey*31) % 1800 AS INT) AS cov_end, CASE c_custkey % 6 WHEN 0 THEN 'DUAL' WHEN 1 THEN 'LIS' WHEN 2 THEN 'DUAL_X' ELSE 'OTHER' END AS raw_basis FROM customer
""",
    "fx_death": """
SELECT c_custkey AS patid, DATE '2000-01-01' + CAST(c_custkey % 600 AS INT) AS death_date FROM customer WHERE c_custkey % 20 = 0
""",
    "fx_encounter": """
SELECT o_orderkey AS encounterid, o_custkey AS patid, CAST(o_orderdate AS DATE) AS admit_date, CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) END AS discharge_date, CASE WHEN o_orderkey % 8 <= 3 THEN 'IP' WHEN o_orderkey % 8 = 4 THEN 'EI' WHEN o_orderkey % 8 = 5 THEN 'AV' WHEN o_orderkey % 8 = 6 THEN 'OT' ELSE 'NI' END AS enc_type, CASE o_orderkey % 50 WHEN 0 THEN 'EX' WHEN 1 THEN 'AM' WHEN 2 THEN 'IP' WHEN 3 THEN 'SH' ELSE 'HO' END AS discharge_status, CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'E' ELSE 'A' END AS discharge_disposition, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '0' || CAST(100 + o_orderkey % 12 AS STRING) WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey % 12 AS STRING) ELSE CAST(100 + o_orderkey % 12 AS STRING) || ' ' END AS grp_code, o_orderkey % 30 AS provider_id FROM orders
""",
    "fx_measure": """
SELECT o_custkey AS patid, CAST(o_orderdate AS DATE) AS measure_date, CASE WHEN o_orderkey % 5 = 0 THEN 'HT' ELSE 'BMI' END AS measure_type, 15 + (o_orderkey*37) % 50 AS measure_num FROM orders
""",
    "fx_dx": """
SELECT o_custkey AS patid, l_orderkey AS encounterid, CAST(o_orderdate AS DATE) AS dx_date, CASE WHEN l_returnflag = 'A' THEN '09' ELSE '10' END AS dx_type, CASE WHEN l_returnflag = 'A' THEN LPAD(CAST(100 + l_partkey % 60 AS STRING), 3, '0') || '.' || CAST(l_linenumber AS STRING) ELSE CHR(CAST(65 + l_partkey % 6 AS INT)) || LPAD(CAST(l_partkey % 40 AS STRING), 2, '0') || '.' || CAST(l_linenumber AS STRING) END AS dx, CASE WHEN l_linenumber = 1 THEN 'P' ELSE 'S' END AS pdx FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "fx_dict10": """
SELECT DISTINCT REPLACE(dx, '.', '') AS code, CAST(10 + CAST(SUBSTR(dx, 2, 2) AS INT) AS STRING) AS grp FROM fx_dx WHERE dx_type = '10'
""",
    "fx_dict9": """
SELECT DISTINCT RPAD(REPLACE(dx, '.', ''), 5, '0') AS code, CAST(CAST(SUBSTR(dx, 1, 3) AS INT) - 90 AS STRING) AS grp FROM fx_dx WHERE dx_type = '09'
""",
    "fx_px": """
SELECT o_custkey AS patid, l_orderkey AS encounterid, CAST(o_orderdate AS DATE) AS px_date, CASE l_partkey % 4 WHEN 2 THEN '09' WHEN 3 THEN '10' ELSE 'CH' END AS px_type, CASE l_partkey % 4 WHEN 0 THEN CAST(10000 + (l_partkey*13) % 5000 AS STRING) WHEN 1 THEN 'G' || LPAD(CAST(l_partkey % 300 AS STRING), 4, '0') WHEN 2 THEN LPAD(CAST(l_partkey % 90 AS STRING), 2, '0') || '.' || CAST(l_linenumber AS STRING) ELSE '0' || LPAD(CAST(l_partkey % 500 AS STRING), 3, '0') || 'ZZ' || CAST(l_linenumber AS STRING) END AS px FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "fx_pxdict9": """
SELECT DISTINCT REPLACE(px, '.', '') AS code, CAST(CAST(SUBSTR(px, 1, 2) AS INT) % 20 AS STRING) AS grp FROM fx_px WHERE px_type = '09' AND CAST(SUBSTR(px, 1, 2) AS INT) % 3 <> 0
""",
    "fx_pxdict10": """
SELECT DISTINCT px AS code, CAST(CAST(SUBSTR(px, 2, 3) AS INT) % 20 AS STRING) AS grp FROM fx_px WHERE px_type = '10' AND CAST(SUBSTR(px, 2, 3) AS INT) % 3 <> 1
""",
    "fx_ranges": """
SELECT CAST(10000 + n_nationkey*200 AS STRING) AS lb, CAST(10000 + n_nationkey*200 + 149 AS STRING) AS ub, CAST(n_nationkey AS STRING) AS grp FROM nation
UNION ALL SELECT 'G' || LPAD(CAST(n_nationkey*11 AS STRING), 4, '0'), 'G' || LPAD(CAST(n_nationkey*11 AS STRING), 4, '0'), CAST(n_nationkey + 100 AS STRING) FROM nation
""",
    "fx_prefix_dict": """
SELECT CHR(CAST(65 + n_nationkey % 6 AS INT)) || LPAD(CAST(n_nationkey AS STRING), 2, '0') AS code, '10' AS code_type, 'g' || CAST(n_nationkey % 17 AS STRING) AS code_grp, n_nationkey % 4 AS score FROM nation
UNION ALL SELECT CAST(100 + n_nationkey AS STRING), '9', 'g' || CAST(n_nationkey % 17 AS STRING), 1 + n_nationkey % 3 FROM nation
""",
    "fx_excl": """
SELECT 'index' AS list, 'dx' AS code_kind, CAST(10 + n_nationkey AS STRING) AS grp, CASE WHEN n_nationkey < 3 THEN 'typeA' ELSE 'typeB' END AS excl_type FROM nation WHERE n_nationkey < 6
UNION ALL SELECT 'planned', 'px', CAST(n_nationkey AS STRING), 'planned' FROM nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT 'planned', 'dx', CAST(30 + n_nationkey AS STRING), 'planned' FROM nation WHERE n_nationkey < 2
""",
    "fx_person_geo": """
SELECT ctx_id, '29' || LPAD(CAST(ctx_id % 9 AS STRING), 3, '0') || LPAD(CAST(ctx_id % 25 AS STRING), 6, '0') || CAST(ctx_id % 4 AS STRING) AS block_group FROM fx_crosswalk
""",
    "fx_area": """
SELECT geocode, CASE WHEN CAST(SUBSTR(geocode, 6, 6) AS INT) % 5 = 0 THEN NULL ELSE 'c' || CAST(CAST(SUBSTR(geocode, 6, 6) AS INT) % 3 AS STRING) END AS area_class, LPAD(CAST(CAST(SUBSTR(geocode, 6, 6) AS INT) AS STRING), 4, '0') AS area_rank, CASE WHEN CAST(SUBSTR(geocode, 6, 6) AS INT) % 4 = 0 THEN '-999' WHEN CAST(SUBSTR(geocode, 6, 6) AS INT) % 4 = 1 THEN '0.5' ELSE '12.4' END AS area_share
FROM (SELECT DISTINCT SUBSTR(block_group, 1, 11) AS geocode FROM fx_person_geo UNION SELECT DISTINCT block_group FROM fx_person_geo WHERE block_group LIKE '%3') t
UNION ALL SELECT DISTINCT SUBSTR(block_group, 1, 5), 'county', '0001', '1' FROM fx_person_geo
""",
    "fx_acs": """
SELECT geocode, CASE WHEN n % 2 = 0 THEN 'BG' ELSE 'CT' END AS geo_accuracy, 20000 + n * 100 AS med_income, CASE WHEN n % 4 = 0 THEN NULL ELSE n % 10 END AS pct_pov, 'x' AS note FROM (SELECT DISTINCT block_group AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) + CAST(SUBSTR(block_group, 12, 1) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_adi": """
SELECT geocode, CASE WHEN n % 7 = 0 THEN 'GQ' ELSE LPAD(CAST(n AS STRING), 4, '0') END AS adi_natrank, n % 10 AS adi_staternk FROM (SELECT DISTINCT block_group AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) + CAST(SUBSTR(block_group, 12, 1) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_fara": """
SELECT geocode, CAST(n % 2 AS STRING) AS lila_flag, n % 13 AS pct_pov FROM (SELECT DISTINCT SUBSTR(block_group, 1, 11) AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_mua": """
SELECT geocode, 'CT' AS geo_accuracy, CASE n % 3 WHEN 0 THEN NULL WHEN 1 THEN 'P' ELSE 'A' END AS mua_type FROM (SELECT DISTINCT SUBSTR(block_group, 1, 11) AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) AS n FROM fx_person_geo) t
UNION ALL SELECT DISTINCT SUBSTR(block_group, 1, 5), 'CTY', 'C' FROM fx_person_geo
""",
    "fx_ruca": """
SELECT geocode, 1 + n % 10 AS ruca1, CASE WHEN n % 5 = 0 THEN '10.2' ELSE '1.0' END AS ruca2 FROM (SELECT DISTINCT SUBSTR(block_group, 1, 11) AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_sld": """
SELECT geocode, CASE WHEN n % 6 = 0 THEN '-99999' ELSE CAST(n % 20 AS STRING) || '.5' END AS walk_index FROM (SELECT DISTINCT block_group AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) + CAST(SUBSTR(block_group, 12, 1) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_svi": """
SELECT geocode, n % 100 AS ep_pov, CASE WHEN n % 8 = 0 THEN NULL ELSE n % 30 END AS pct_pov, 'y' AS ep_prec FROM (SELECT DISTINCT SUBSTR(block_group, 1, 11) AS geocode, CAST(SUBSTR(block_group, 6, 6) AS INT) AS n FROM fx_person_geo) t
""",
    "fx_person_attr": """
SELECT c_custkey + 1000000 AS ctx_id, c_mktsegment AS h_segment, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'R' ELSE 'O' END AS h_own_rent, CASE WHEN c_custkey % 9 = 0 THEN '1' ELSE NULL END AS h_flag, LPAD(CAST(c_custkey % 16 AS STRING), 2, '0') AS h_length, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(CAST(ROUND(c_acctbal) AS INT) AS STRING) END AS h_value, 'X' AS h_own_prec FROM customer
""",
    "fx_vital": """
SELECT user_id AS patid, event_id, CAST(ts AS DATE) AS measure_date, CASE WHEN event_id % 7 = 0 THEN NULL ELSE 100 + value END AS systolic, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 60 + value END AS diastolic, CASE event_type WHEN 'view' THEN 'UN' WHEN 'click' THEN ' ' WHEN 'error' THEN NULL ELSE event_type END AS smoking FROM events
""",
    "fx_scores": """
SELECT d.doc_id AS id, l.quality AS actual, CAST((d.n_chars % 1000) AS DOUBLE) / 1000 AS pred FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""",
}
