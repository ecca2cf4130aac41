"""SQL oracles (DuckDB dialect) for the registered queries.

Each statement computes the same result as the Spark query of the same
key, written independently in plain SQL (ranking with window functions,
lookups with VALUES lists) over the driver tables registered as views.
"""

from __future__ import annotations

from gridloom.functions.codes import (
    AK_NAME_TO_FIPS, FIPS_TO_STATE, HI_NAME_TO_FIPS, STATE_TO_FIPS,
)
from gridloom.plans.catalog import MERGE_SPECS


def zf(expr: str, width: int) -> str:
    """zfill without truncation, on the text of ``expr``."""
    t = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({t}) < {width} THEN lpad({t}, {width}, '0') ELSE {t} END)"


def idiv(expr: str, d: int) -> str:
    return f"CAST(floor(({expr}) / {d}) AS BIGINT)"


def xsum(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,2))) AS DOUBLE)"


def ceil_ts(unit: str, expr: str) -> str:
    return f"CAST(date_trunc('{unit}', {expr} + INTERVAL 1 {unit.upper()} - INTERVAL 1 MICROSECOND) AS TIMESTAMP)"


def values(mapping: dict[str, str], cols: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())
    return f"(VALUES {rows}) AS {cols}"


B = f"""b AS (
  SELECT c_custkey AS bldgid,
         'C' || {zf(idiv('c_custkey', 10), 5)} AS county,
         CASE {idiv('c_custkey', 60)} % 3
              WHEN 0 THEN 'A' || CAST({idiv('c_custkey', 5)} AS VARCHAR)
              WHEN 1 THEN 'B' || CAST({idiv('c_custkey', 20)} AS VARCHAR)
              ELSE 'D' || CAST({idiv('c_custkey + 5', 20)} AS VARCHAR) END AS puma,
         CAST(c_acctbal + 1000 AS DECIMAL(18,2)) AS weight
  FROM customer)"""

def zone(county: str) -> str:
    no = f"CAST(substr({county}, 2) AS BIGINT)"
    return f"CASE WHEN {no} % 11 = 0 THEN NULL ELSE 'Z' || CAST({idiv(no, 3)} % 2 AS VARCHAR) END"

# Group assignment (rules 1-6) as SQL: ``labels(county, county_groups)``.
GROUPS = f"""{B},
pairs AS (SELECT county, puma, sum(weight) AS w FROM b
          WHERE county IS NOT NULL AND puma IS NOT NULL GROUP BY county, puma),
multi AS (SELECT puma FROM pairs GROUP BY puma HAVING count(DISTINCT county) > 1),
ranked AS (SELECT p.county, p.puma, p.w,
                  row_number() OVER (PARTITION BY p.county ORDER BY p.w DESC, p.puma) AS rn
           FROM pairs p JOIN multi m ON p.puma = m.puma),
chosen AS (SELECT county, puma FROM ranked WHERE rn = 1),
firsts AS (SELECT county, min(bldgid) AS f FROM b WHERE county IS NOT NULL GROUP BY county),
per_area AS (SELECT c.puma, min(f.f) AS f, count(*) AS size
             FROM chosen c JOIN firsts f ON c.county = f.county GROUP BY c.puma),
numbered AS (SELECT puma, size, row_number() OVER (ORDER BY f, puma) - 1 AS gid FROM per_area),
labels0 AS (SELECT f.county, n.gid, n.size FROM firsts f
            LEFT JOIN chosen c ON f.county = c.county LEFT JOIN numbered n ON c.puma = n.puma),
labels AS (SELECT county,
                  CASE WHEN gid IS NOT NULL AND size > 1 THEN 'county_group_' || CAST(gid AS VARCHAR)
                       ELSE 'independent_county_' || county END AS county_groups
           FROM labels0)"""

SPLIT = f"""{GROUPS},
rows_ AS (SELECT b.bldgid, b.county, b.puma, b.weight, l.county_groups, {zone('b.county')} AS R
          FROM b LEFT JOIN labels l ON b.county = l.county),
level AS (SELECT DISTINCT county, county_groups, coalesce(R, '__MISSING__') AS zkey FROM rows_),
zstats AS (SELECT county_groups, zkey, count(DISTINCT county) AS n FROM level
           WHERE starts_with(county_groups, 'county_group_') GROUP BY county_groups, zkey),
zranked AS (SELECT *, row_number() OVER (PARTITION BY county_groups ORDER BY n DESC, zkey) AS zr FROM zstats),
maxid AS (SELECT max(CAST(regexp_extract(county_groups, '^county_group_(\\d+)$', 1) AS BIGINT)) AS m
          FROM level WHERE regexp_full_match(county_groups, 'county_group_\\d+')),
extra AS (SELECT county_groups, zkey,
                 row_number() OVER (ORDER BY county_groups, zr) - 1
                   + (SELECT coalesce(max(m), -1) + 1 FROM maxid) AS nid
          FROM zranked WHERE zr > 1),
moved AS (SELECT l.county, 'county_group_' || CAST(e.nid AS VARCHAR) AS new_g
          FROM level l JOIN extra e ON l.county_groups = e.county_groups AND l.zkey = e.zkey),
split AS (SELECT r.bldgid, r.county, r.puma, r.weight, r.R,
                 coalesce(m.new_g, r.county_groups) AS county_groups
          FROM rows_ r LEFT JOIN moved m ON r.county = m.county)"""

_SPEC_ROWS = ", ".join(f"('{s}', '{t}', {i})" for i, (s, t) in enumerate(MERGE_SPECS))

MANIFEST = """m AS (
  SELECT doc_id, n_chars AS size,
         CASE WHEN lang = 'en' THEN ts || '.csv'
              WHEN lang = 'fr' THEN 'annual/full/' || st || '_upgrade' || u || '_agg_' || CAST(doc_id AS VARCHAR) || '.csv'
              WHEN lang = 'de' THEN 'annual/basic/upgrade' || u || '_' || CAST(doc_id AS VARCHAR) || '.csv'
              ELSE ts || '.parquet' END AS key
  FROM (SELECT doc_id, lang, n_chars, u, st,
               'timeseries/upgrade=' || u || '/state=' || st || '/' || source || '_' || CAST(doc_id AS VARCHAR) AS ts
        FROM (SELECT doc_id, lang, n_chars, source, CAST(doc_id % 3 AS VARCHAR) AS u,
                     CASE doc_id % 4 WHEN 0 THEN 'AL' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX' ELSE 'NY' END AS st
              FROM documents)))"""


def _fmt_bytes(b: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    parts = []
    for k, u in enumerate(units[:-1]):
        parts.append(f"WHEN {b} < {1024 ** (k + 1)} THEN printf('%6.1f {u}', CAST({b} AS DOUBLE) / {1024 ** k})")
    return f"CASE {' '.join(parts)} ELSE printf('%6.1f PB', CAST({b} AS DOUBLE) / {1024 ** 5}) END"


ORACLE: dict[str, str] = {
    "long_end_use": f"""
WITH m AS (
  SELECT l_shipdate, l_returnflag, l_linestatus, l_discount, 'quantity' AS end_use, l_quantity AS kwh FROM lineitem
  UNION ALL SELECT l_shipdate, l_returnflag, l_linestatus, l_discount, 'extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_shipdate, l_returnflag, l_linestatus, l_discount, 'tax', l_tax FROM lineitem),
s1 AS (
  SELECT {ceil_ts('day', 'l_shipdate')} AS l_shipdate, l_returnflag, l_linestatus, end_use,
         sum(CAST(kwh AS DECIMAL(38,2))) AS kwh, avg(l_discount) AS l_discount
  FROM m GROUP BY 1, 2, 3, 4)
SELECT l_returnflag, end_use, l_shipdate, CAST(sum(kwh) AS DOUBLE) AS kwh,
       round(sum(l_discount), 6) AS l_discount
FROM s1 GROUP BY l_returnflag, end_use, l_shipdate""",

    "melt_measures": """
SELECT l_orderkey, l_linenumber, 'quantity' AS end_use, l_quantity AS kwh FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""",

    "melt_allowlist": """
SELECT l_orderkey, l_linenumber, 'quantity' AS end_use, l_quantity AS kwh FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""",

    "hourly_rollup": f"""
SELECT event_type, {ceil_ts('hour', 'ts')} AS ts, {xsum('value')} AS value,
       {xsum('value')} / count(*) AS mean_value, count(*) AS n_rows
FROM events GROUP BY 1, 2""",

    "two_stage_rollup": f"""
WITH s1 AS (SELECT {ceil_ts('hour', 'ts')} AS ts, event_type,
                   sum(CAST(value AS DECIMAL(38,2))) AS value, avg(value) AS mean_value
            FROM events GROUP BY 1, 2)
SELECT ts, CAST(sum(value) AS DOUBLE) AS value, round(sum(mean_value), 6) AS mean_value
FROM s1 GROUP BY ts""",

    "partial_merge": f"""
SELECT {ceil_ts('hour', 'ts')} AS ts, event_type, {xsum('value')} AS value, count(*) AS n_rows,
       {xsum('value')} / count(*) AS mean_value
FROM events GROUP BY 1, 2""",

    "distinct_keys": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",

    "sum_by_parent_time": f"""
SELECT o.o_orderdate, {xsum('o.o_totalprice')} AS o_totalprice, r.r_name AS region
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, o.o_orderdate""",

    "reject_unknown": """
SELECT c_nationkey, count(*) AS n_rows FROM customer
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)
GROUP BY c_nationkey""",

    "hour_trunc_sum": f"""
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts_hour, {xsum('value')} / 1e6 AS gwh
FROM events GROUP BY 1""",

    "month_hour_profile": f"""
SELECT month(ts) AS month, hour(ts) AS hour, {xsum('value')} / 1e6 AS gwh FROM events GROUP BY 1, 2""",

    "pct_of_total": f"""
WITH a AS (SELECT event_type, month(ts) AS month, hour(ts) AS hour, {xsum('value')} AS value FROM events GROUP BY 1, 2, 3)
SELECT event_type, month, hour, value, round(value / sum(value) OVER (PARTITION BY event_type), 9) AS share FROM a""",

    "drill_rollup": f"""
SELECT r.r_name, n.n_name, c.c_mktsegment, count(*) AS n_customers,
       {xsum('c.c_acctbal')} AS total_acctbal, {xsum('c.c_acctbal')} / count(*) AS mean_acctbal,
       min(c.c_acctbal) AS least_acctbal,
       CAST(grouping(r.r_name) AS INTEGER) AS g_r_name,
       CAST(grouping(n.n_name) AS INTEGER) AS g_n_name,
       CAST(grouping(c.c_mktsegment) AS INTEGER) AS g_c_mktsegment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name, c.c_mktsegment)""",

    "constant_map_lookup": f"""
SELECT x.n_nationkey, x.n_name, x.fips2, t.state
FROM (SELECT n_nationkey, n_name, {zf('n_nationkey', 2)} AS fips2 FROM nation) x
LEFT JOIN {values(FIPS_TO_STATE, 't(fips, state)')} ON x.fips2 = t.fips
WHERE x.fips2 IN (SELECT fips FROM {values(STATE_TO_FIPS, 'd(st, fips)')})""",

    "lookup_left_join": f"""
SELECT {zf('d.doc_id', 7)} AS county_fips5, d.source, 'R' || CAST(l.quality AS VARCHAR) AS R
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",

    "anti_join_missing": """
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",

    "shared_key_self_join": f"""
WITH {B},
pairs AS (SELECT county, puma, sum(weight) AS weight FROM b
          WHERE county IS NOT NULL AND puma IS NOT NULL GROUP BY county, puma)
SELECT puma, county, CAST(weight AS DOUBLE) AS weight FROM pairs
WHERE puma IN (SELECT puma FROM pairs WHERE county = 'C00013')""",

    "full_outer_audit": """
SELECT l.doc_id, p.page_id FROM (SELECT DISTINCT doc_id FROM labels) l
FULL OUTER JOIN (SELECT DISTINCT page_id FROM pages) p ON l.doc_id = p.page_id""",

    "prefix_semi_join": f"""
SELECT c_custkey, 'G' || {zf('c_nationkey', 2)} || '00010' AS county FROM customer
WHERE {zf('c_nationkey', 2)} IN ('01', '02', '04', '06', '08')""",

    "pair_weight": f"""
WITH {B} SELECT county, puma, CAST(sum(weight) AS DOUBLE) AS weight FROM b GROUP BY county, puma""",

    "nunique_having": f"""
WITH {B}
SELECT puma, count(DISTINCT county) AS num_counties FROM b
WHERE county IS NOT NULL AND puma IS NOT NULL GROUP BY puma HAVING count(DISTINCT county) > 1""",

    "forall_group": f"""
WITH {B},
pairs AS (SELECT DISTINCT county, puma FROM b WHERE county IS NOT NULL AND puma IS NOT NULL),
multi AS (SELECT puma FROM pairs GROUP BY puma HAVING count(*) > 1)
SELECT county, count(DISTINCT puma) AS num_pumas FROM pairs
GROUP BY county
HAVING count(DISTINCT puma) > 1 AND bool_and(puma NOT IN (SELECT puma FROM multi))""",

    "argmax_assign": f"""
WITH {GROUPS}
SELECT county, puma, CAST(w AS DOUBLE) AS weight FROM ranked WHERE rn = 1""",

    "singleton_relabel": f"""
WITH {GROUPS},
raw AS (SELECT county, CASE WHEN gid IS NOT NULL THEN 'county_group_' || CAST(gid AS VARCHAR)
                            ELSE 'independent_county_' || county END AS g FROM labels0),
sizes AS (SELECT g, count(DISTINCT county) AS n FROM raw WHERE starts_with(g, 'county_group_') GROUP BY g)
SELECT raw.county, CASE WHEN s.n = 1 THEN 'independent_county_' || raw.county ELSE raw.g END AS county_groups
FROM raw LEFT JOIN sizes s ON raw.g = s.g""",

    "assign_groups": f"""
WITH {GROUPS}
SELECT b.bldgid, b.county, b.puma, l.county_groups FROM b LEFT JOIN labels l ON b.county = l.county""",

    "split_by_attribute": f"""
WITH {SPLIT}
SELECT DISTINCT county, R, county_groups FROM split""",

    "gated_merge": f"""
WITH {SPLIT},
gz AS (SELECT county_groups, R FROM (
         SELECT county_groups, R, row_number() OVER (PARTITION BY county_groups ORDER BY bldgid, R) AS rn
         FROM split WHERE R IS NOT NULL AND county_groups IS NOT NULL) WHERE rn = 1),
specs AS (SELECT * FROM (VALUES {_SPEC_ROWS}) AS s(source_group, target_group, spec_order)),
gated AS (SELECT s.source_group, s.target_group, s.spec_order, a.R AS sz, t.R AS tz FROM specs s
          LEFT JOIN gz a ON s.source_group = a.county_groups
          LEFT JOIN gz t ON s.target_group = t.county_groups),
allowed AS (SELECT source_group, arg_max(target_group, spec_order) AS to_g FROM gated
            WHERE sz IS NOT DISTINCT FROM tz GROUP BY source_group)
SELECT DISTINCT s.county, coalesce(a.to_g, s.county_groups) AS county_groups
FROM split s LEFT JOIN allowed a ON s.county_groups = a.source_group""",

    "impute_missing": f"""
WITH {GROUPS},
rows_ AS (SELECT b.bldgid, b.county, b.puma, b.weight, l.county_groups FROM b LEFT JOIN labels l ON b.county = l.county),
ref AS (SELECT DISTINCT county FROM b UNION SELECT 'C9' || {zf('n_nationkey', 4)} FROM nation),
missing AS (SELECT county FROM ref WHERE county NOT IN (SELECT county FROM rows_ WHERE county IS NOT NULL)),
xw AS (SELECT county AS fips, puma FROM b
       UNION ALL SELECT 'C9' || {zf('c.c_nationkey', 4)}, b.puma FROM customer c JOIN b ON c.c_custkey = b.bldgid),
tc AS (SELECT fips, puma, count(*) AS n FROM xw WHERE fips IS NOT NULL AND puma IS NOT NULL GROUP BY 1, 2),
prim AS (SELECT fips, puma FROM (SELECT *, row_number() OVER (PARTITION BY fips ORDER BY n DESC, puma) AS rn FROM tc) WHERE rn = 1),
pw AS (SELECT puma, county_groups, sum(weight) AS w FROM rows_
       WHERE puma IS NOT NULL AND county_groups IS NOT NULL GROUP BY 1, 2),
maj AS (SELECT puma, county_groups FROM (
          SELECT *, row_number() OVER (PARTITION BY puma ORDER BY w DESC, county_groups) AS rn FROM pw) WHERE rn = 1)
SELECT CAST(bldgid AS VARCHAR) AS bldgid, county, puma, CAST(weight AS DOUBLE) AS weight, county_groups FROM rows_
UNION ALL
SELECT 'dummy_' || m.county, m.county, p.puma, 0.0, coalesce(j.county_groups, 'independent_county_' || m.county)
FROM missing m LEFT JOIN prim p ON m.county = p.fips LEFT JOIN maj j ON p.puma = j.puma""",

    "mapping_distinct": f"""
WITH {SPLIT}
SELECT DISTINCT substr(county, 1, 3) AS state, county, 'County ' || substr(county, 2, 5) AS county_name,
       substr(county, 2, 5) AS county_fips5, R, county_groups FROM split""",

    "collect_members": """
SELECT c_nationkey, page, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members, count(*) AS n_members
FROM (SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 25 AS page FROM customer)
GROUP BY c_nationkey, page""",

    "group_kinds": f"""
WITH {GROUPS},
rows_ AS (SELECT b.county, b.puma, l.county_groups AS g FROM b LEFT JOIN labels l ON b.county = l.county),
areas AS (SELECT county, count(DISTINCT puma) AS n FROM rows_ GROUP BY county)
SELECT CASE WHEN starts_with(g, 'county_group_') THEN 'group' WHEN starts_with(g, 'independent_county_') THEN 'independent'
            ELSE 'none' END AS kind, count(*) AS n_rows, count(DISTINCT g) AS n_groups, count(DISTINCT county) AS n_members
FROM rows_ GROUP BY 1
UNION ALL SELECT 'areas ' || n, NULL, NULL, count(*) FROM areas GROUP BY n""",

    "merge_report": f"""
WITH {SPLIT},
gz AS (SELECT county_groups, R FROM (
         SELECT county_groups, R, row_number() OVER (PARTITION BY county_groups ORDER BY bldgid, R) AS rn
         FROM split WHERE R IS NOT NULL AND county_groups IS NOT NULL) WHERE rn = 1),
specs AS (SELECT * FROM (VALUES {_SPEC_ROWS}) AS s(source_group, target_group, spec_order)),
d AS (SELECT s.source_group, s.target_group, a.R AS source_zone, t.R AS target_zone,
             s.source_group IN (SELECT county_groups FROM split WHERE county_groups IS NOT NULL) AS source_present,
             a.R IS NOT DISTINCT FROM t.R AS merged
      FROM specs s LEFT JOIN gz a ON s.source_group = a.county_groups LEFT JOIN gz t ON s.target_group = t.county_groups)
SELECT *, CASE WHEN NOT merged THEN 'zone mismatch' WHEN NOT source_present THEN 'absent source' ELSE 'merged' END AS decision
FROM d""",

    "zone_violations": f"""
WITH {GROUPS},
z AS (SELECT DISTINCT l.county_groups, {zone('l.county')} AS R FROM labels l)
SELECT county_groups, count(R) AS n_zones, string_agg(R, ',' ORDER BY R) AS zones
FROM z WHERE R IS NOT NULL GROUP BY county_groups HAVING count(R) > 1""",

    "hot_key_join": """
WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, k AS p_partkey, p_name, p_retailprice FROM l LEFT JOIN part ON k = p_partkey""",

    "top1_tiebreak": """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1, 2)
SELECT c_nationkey, c_mktsegment, n_customers FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n_customers DESC, c_mktsegment) AS rn FROM c)
WHERE rn = 1""",

    "weighted_majority": """
WITH c AS (SELECT c_nationkey, c_mktsegment, sum(CAST(c_acctbal AS DECIMAL(38,2))) AS w FROM customer
           WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY 1, 2)
SELECT c_nationkey, c_mktsegment, CAST(w AS DOUBLE) AS total_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY w DESC, c_mktsegment) AS rn FROM c)
WHERE rn = 1""",

    "first_seen_ordinal": """
SELECT o_custkey, min(o_orderkey) AS first_order,
       row_number() OVER (ORDER BY min(o_orderkey), o_custkey) - 1 AS ordinal
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""",

    "numeric_lexical_sort": """
WITH v AS (SELECT DISTINCT value FROM (
             SELECT string_split(p_brand, '#')[-1] AS value FROM part
             UNION ALL SELECT p_type FROM part))
SELECT value, row_number() OVER (
         ORDER BY CASE WHEN regexp_full_match(value, '[0-9]+') THEN 0 ELSE 1 END,
                  CASE WHEN regexp_full_match(value, '[0-9]+') THEN CAST(value AS DECIMAL(38,0)) END NULLS FIRST,
                  value) - 1 AS rank
FROM v""",

    "group_size_topk": """
SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY l_suppkey
ORDER BY n_lines DESC, l_suppkey LIMIT 20""",

    "count_histogram": """
SELECT n_orders, count(*) AS n_customers
FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) GROUP BY n_orders""",

    "conditional_counts": """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS n_building,
       count(*) FILTER (WHERE c_acctbal < 0) AS n_negative,
       count(*) FILTER (WHERE starts_with(c_name, 'Customer#0000001')) AS n_prefix,
       count(DISTINCT c_nationkey) AS n_nations,
       count(DISTINCT c_mktsegment) AS n_segments
FROM customer""",

    "validity_report": """
WITH x AS (SELECT c_mktsegment,
                  CASE WHEN c_acctbal < 0 THEN NULL
                       ELSE CAST(CAST(floor(c_acctbal * 10) AS BIGINT) AS VARCHAR) END AS code
           FROM customer)
SELECT c_mktsegment, count(*) AS n_rows, count(*) FILTER (WHERE code IS NULL) AS n_null,
       count(*) FILTER (WHERE code IS NULL OR length(code) <> 5) AS n_invalid
FROM x GROUP BY c_mktsegment""",

    "sample_per_group": """
SELECT c_mktsegment, c_name, rn FROM (
  SELECT c_mktsegment, c_name, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS rn
  FROM (SELECT DISTINCT c_mktsegment, c_name FROM customer))
WHERE rn <= 5""",

    "group_label": """
WITH x AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'economy part' ELSE p_brand END AS name FROM part),
y AS (SELECT p_partkey, CASE WHEN contains(name, '#') THEN string_split(name, '#')[-1] ELSE 'i' END AS label FROM x)
SELECT p_partkey, label, label = 'i' AS in_set FROM y""",

    "code_fallback": f"""
WITH x AS (
  SELECT c_custkey,
         CASE c_mktsegment
           WHEN 'AUTOMOBILE' THEN 'G' || {zf('c_nationkey', 2)} || substr(c_name, 15, 4) || '0'
           WHEN 'BUILDING' THEN CASE WHEN c_acctbal > 5000 THEN 'AK, Bethel Census Area' ELSE 'AK, Unknown Borough' END
           WHEN 'FURNITURE' THEN 'HI, Maui County'
           WHEN 'HOUSEHOLD' THEN 'XYZ' || CAST(c_custkey AS VARCHAR)
           ELSE 'G' || {zf('c_nationkey', 2)} || substr(c_name, 15, 4) END AS county
  FROM customer),
names AS (SELECT * FROM {values({**AK_NAME_TO_FIPS, **HI_NAME_TO_FIPS}, 't(name, fips)')}),
y AS (SELECT x.c_custkey, x.county,
             coalesce(CASE WHEN regexp_full_match(x.county, 'G[0-9]{{2}}[0-9]{{4}}0')
                           THEN substr(x.county, 2, 2) || substr(x.county, 5, 3) END,
                      names.fips) AS f
      FROM x LEFT JOIN names ON x.county = names.name)
SELECT c_custkey, county, {zf('f', 5)} AS county_fips5 FROM y""",

    "compose_codes": f"""
SELECT n_nationkey,
       {zf('n_regionkey', 2)} || {zf('n_nationkey', 3)} AS county_fips5,
       'G' || {zf('n_regionkey', 2)} || {zf('n_nationkey', 3)} || '0' AS gisjoin,
       'G' || {zf('n_regionkey', 2)} || {zf('n_nationkey * 99991', 6)} AS puma_g
FROM nation""",

    "required_projection": """
SELECT c_custkey AS bldgid, c_name AS county, c_nationkey AS state, c_mktsegment AS puma, c_acctbal AS weight
FROM customer""",

    "resolve_columns": "SELECT ts AS timestamp, event_type AS building_type, value FROM events",

    "scan_filter_project": "SELECT event_id, ts, value FROM events WHERE event_type = 'click'",

    "type_normalise": """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, CAST(embedding[-1] AS DOUBLE) AS last,
       CAST(to_json(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT))) AS VARCHAR) AS milli,
       '{"vec_id":' || CAST(vec_id AS VARCHAR) || ',"dims":' || CAST(len(embedding) AS VARCHAR) || '}' AS pair,
       CAST(CAST(vec_id AS DECIMAL(12,2)) AS VARCHAR) AS dec
FROM embeddings""",

    "union_by_name": """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",

    "append_union_count": "SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n_rows",

    "dedupe_by_key": """
SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",

    "path_partitions": """
SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS section,
       regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
       regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref
FROM pages""",

    "manifest_filter": f"""
WITH {MANIFEST},
p AS (SELECT key, size, string_split(key, '/') AS parts FROM m),
q AS (SELECT key, size, parts[-1] AS fname,
             list_filter(parts[1:-2], lambda x: starts_with(x, 'upgrade=')) AS ups,
             list_filter(parts[1:-2], lambda x: starts_with(x, 'state=')) AS sts
      FROM p),
r AS (SELECT key, size, fname,
             coalesce(substr(ups[-1], 9), nullif(regexp_extract(fname, '(^|_)upgrade([0-9]+)(_|\\.|$)', 2), '')) AS up,
             coalesce(upper(substr(sts[-1], 7)), '') AS st
      FROM q)
SELECT key, size FROM r
WHERE ends_with(key, '.csv')
  AND (up IS NULL OR up IN ('0', '2'))
  AND CASE WHEN st <> '' THEN st IN ('CA', 'TX')
           ELSE contains(upper(fname), 'CA') OR contains(upper(fname), 'TX') END""",

    "manifest_status": f"""
WITH {MANIFEST},
have AS (SELECT DISTINCT m.key FROM labels l JOIN m ON l.doc_id = m.doc_id WHERE l.quality = 1 AND m.size > 0),
fail AS (SELECT DISTINCT m.key FROM labels l JOIN m ON l.doc_id = m.doc_id WHERE l.toxic = 1 AND l.quality = 0),
s AS (SELECT m.key, m.size,
             CASE WHEN m.key IN (SELECT key FROM have) THEN 'skipped'
                  WHEN m.key IN (SELECT key FROM fail) THEN 'error' ELSE 'ok' END AS status
      FROM m)
SELECT status, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_bytes FROM s GROUP BY status""",

    "format_bytes": f"""
WITH d AS (SELECT doc_id, CAST(n_chars * n_chars * 10 AS BIGINT) AS b FROM documents)
SELECT doc_id, b AS size_bytes, {_fmt_bytes('b')} AS size_text FROM d""",

    "scalar_strings": f"""
SELECT c_custkey, upper(c_mktsegment) AS seg_upper, lower(c_name) AS name_lower,
       CAST(length(c_name) AS BIGINT) AS name_len,
       split_part(c_name, '#', 2) AS num,
       rtrim(split_part(c_name, '#', 2), '0') AS num_rstrip,
       substr(c_name, 1, 5) AS head5,
       regexp_replace(c_name, '^Customer', 'C') AS short_name,
       starts_with(c_name, 'Customer#00000001') AS starts,
       ends_with(c_name, '7') AS ends7,
       contains(c_mktsegment, 'URE') AS has_ure,
       c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS seg_nation,
       regexp_full_match(split_part(c_name, '#', 2), '[0-9]+') AS all_digits,
       {zf('c_nationkey', 3)} AS nation3,
       trim('  ' || c_mktsegment || ' ') AS seg_trim
FROM customer""",

    "scalar_dates": f"""
SELECT event_id, {ceil_ts('hour', 'ts')} AS hour_ending, {ceil_ts('day', 'ts')} AS day_ending,
       CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start,
       month(ts) AS month, hour(ts) AS hour, year(ts) AS year,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_parsed
FROM events""",

    "stream_hourly": f"""
SELECT {ceil_ts('hour', 'ts')} AS ts, event_type, {xsum('value')} AS sum_value, count(*) AS n_rows
FROM events GROUP BY 1, 2""",
}
