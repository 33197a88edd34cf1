"""DuckDB twins of the jobs in ``catalog_runs``."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["long_csv"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, 'l_quantity' AS name,
       CAST(CAST(l_quantity AS DECIMAL(15, 2)) AS VARCHAR) AS value FROM lineitem
"""

ORACLE["value_list"] = """
SELECT DISTINCT c_name AS name FROM customer UNION SELECT 'a@x' UNION SELECT 'b@x'
"""

ORACLE["resolve_candidate"] = """
WITH f AS (SELECT l_orderkey AS project, CAST(l_suppkey % 3 + 1 AS INTEGER) AS rank,
             l_partkey || '/' || (['Run_Metric_Summary.draft.csv', 'Run_Metric_Summary.csv', 'notes.txt'])[l_suppkey % 3 + 1] AS path
           FROM lineitem WHERE l_suppkey % 3 < 2)
SELECT project, path, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY project ORDER BY rank, path) AS k FROM f) WHERE k = 1
"""

ORACLE["required_inputs_missing"] = """
WITH f AS (SELECT l_orderkey AS k, max(l_linenumber) AS most, bool_or(l_linenumber = 2) AS fastqs FROM lineitem
           WHERE l_orderkey % 5 > 0 GROUP BY 1)
SELECT o_orderkey AS project_dir, array_to_string(list_filter([
         CASE WHEN o_orderkey % 3 > 0 THEN NULL ELSE '.settings.json' END,
         CASE WHEN coalesce(fastqs, false) THEN NULL ELSE 'fastqs' END,
         CASE WHEN coalesce(most, 0) > 2 THEN NULL ELSE 'Stats.json.unprocessed' END], lambda x: x IS NOT NULL), ',') AS missing
FROM orders LEFT JOIN f ON o_orderkey = k
"""

ORACLE["retention"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-01') > 10 AS expired FROM orders
"""

ORACLE["reset_due"] = """
WITH t AS (SELECT event_type AS application, CAST(max(ts) FILTER (value < 20) AS DATE) AS last_reset FROM events GROUP BY 1)
SELECT application, coalesce(date_diff('day', last_reset, (SELECT CAST(max(ts) AS DATE) FROM events)) >= 10, true) AS reset FROM t
"""

ORACLE["registry_export"] = """
WITH u AS (SELECT c_mktsegment AS grp, 'n' || c_nationkey AS usr, min(c_custkey) AS pos FROM customer GROUP BY 1, 2)
SELECT grp, string_agg(usr, ', ' ORDER BY pos) AS users_text FROM u GROUP BY grp
"""

ORACLE["append_ledger"] = """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS project_dir FROM lineitem
"""

ORACLE["unchanged"] = """
SELECT DISTINCT event_type AS path FROM events WHERE event_type IN ('click', 'view') AND value > 99
"""

ORACLE["snapshot"] = """
WITH a AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
b AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
SELECT '19980101' AS state, * FROM a UNION ALL SELECT '19980102', * FROM b
UNION ALL SELECT 'table', * FROM b UNION ALL SELECT 'version', * FROM b
"""

ORACLE["publish_gate"] = """
WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS even FROM orders),
l AS (SELECT count(*) AS n, count(*) FILTER (l_linenumber < 3) AS few FROM lineitem)
SELECT 'first' AS case_name, o.n AS delta_rows, l.n AS delta_seq_rows, true AS publish FROM o, l
UNION ALL SELECT 'same', 0, 0, false
UNION ALL SELECT 'sequencing', 0, l.n - l.few, l.n <> l.few FROM l
UNION ALL SELECT 'rows', o.n - o.even, 0, o.n <> o.even FROM o
"""

ORACLE["report_rows"] = """
SELECT 'n' || c_nationkey AS path, 's' || c_custkey AS sample, (c_custkey * 1000) || 'x' AS reads,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '9' END AS q FROM customer
"""

ORACLE["run_identity"] = """
SELECT s_suppkey AS path, 'M' || s_nationkey AS "MachineID",
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'FC' || s_suppkey END AS "FlowCellID" FROM supplier
"""

ORACLE["project_listing"] = """
SELECT 'c_mktsegment=BUILDING' AS folder, false AS report
UNION ALL SELECT DISTINCT 'c_mktsegment=BUILDING/c_nationkey=' || c_nationkey || '/c_mktsegment=BUILDING', true
FROM customer WHERE c_mktsegment = 'BUILDING'
"""

ORACLE["digest_append"] = """
SELECT DISTINCT * FROM (
  SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier
  UNION ALL SELECT c_name, c_nationkey, NULL::DOUBLE, c_mktsegment FROM customer)
"""

ORACLE["stream_changed"] = """
SELECT DISTINCT c_nationkey, CASE WHEN c_nationkey = 4 THEN 2 ELSE 1 END::BIGINT AS times FROM customer
"""

ORACLE["app_index_increments"] = """
SELECT o_orderpriority AS "Application", o_orderstatus AS "Investigator_Folder",
       count(DISTINCT CASE WHEN o_custkey % 11 > 0 THEN o_custkey END) AS "Sample_Count"
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL
"""

ORACLE["ordered_report"] = """
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey NULLS FIRST, o_orderkey NULLS FIRST) AS place FROM orders
"""

ORACLE["quarantine"] = """
WITH r AS (SELECT CASE WHEN l_linenumber = 6 THEN 'Reads is not bigint' ELSE 'extra fields' END AS reason FROM lineitem
  WHERE l_linenumber = 6 AND l_returnflag = 'N' OR l_linenumber = 5 AND l_returnflag IN ('R', 'A'))
SELECT reason, count(*) AS rows, (SELECT count(*) FROM r) AS observed FROM r GROUP BY reason
"""

ORACLE["settings_files"] = """
SELECT 's' || s_suppkey || '/PacBio' AS folder, s_suppkey % 3 > 0 AS has_settings, s_suppkey % 3 > 0 AND s_suppkey % 2 = 0 AS named FROM supplier
"""

ORACLE["log_files"] = """
WITH c AS (SELECT 'p' || c_custkey AS project, CASE WHEN c_custkey % 2 = 0 THEN 'basic' ELSE 'rnaseq' END AS pipeline,
                  CASE WHEN c_custkey % 2 = 0 THEN 'package' ELSE 'run' END AS stage, c_custkey, c_nationkey FROM customer)
SELECT project, pipeline, stage, 'n ' || c_nationkey AS line FROM c UNION ALL SELECT project, pipeline, stage, 'k ' || c_custkey FROM c
"""

ORACLE["export_tsv"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
"""

ORACLE["table_totals"] = """
SELECT count(*) AS rows, count(DISTINCT o_custkey) AS samples FROM orders
"""

ORACLE["add_metadata"] = """
SELECT n_name AS "Investigator_Folder", c_custkey, c_name, n_regionkey AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
"""

ORACLE["explode_cells"] = """
SELECT p_partkey, 1 AS col_no, 'brand' AS name, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 2, 'size', CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END FROM part
"""

ORACLE["scalar_rules"] = """
SELECT o_orderkey, '/r/' || o_orderkey AS after, NULL::VARCHAR AS no_label, o_orderkey || '%' AS percent,
       strftime(o_orderdate, '%Y%m%d') AS day, CASE WHEN o_orderkey % 3 = 1 THEN 'h' || o_orderkey END AS hostname,
       CASE o_orderkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'h' || o_orderkey ELSE 'folder' END AS instrument, o_orderpriority AS bare
FROM orders
"""

ORACLE["lane_block_reader"] = """
SELECT s_suppkey AS path, unnest(['1', '2']) AS "Lane", '95' AS "Cluster_PF_PCT", CAST(s_suppkey AS VARCHAR) AS "Reads_Cluster_number_Mb",
       CAST(s_nationkey AS VARCHAR) AS "Reads_Cluster_number_PF_Mb", '91' AS "Q30_or_higher_PCT", '12' AS "Yield_Gb",
       '1.1' AS "Aligned_PhiX_PCT", '0.2' AS "Error_rate_PhiX_alignment" FROM supplier
"""

# FIXED VALUES: the same date formats as in functions/fixed.py, in strftime's spelling.
_DATE_FORMATS = ("%Y-%m-%d", "%Y/%m/%d", "%Y%m%d", "%m/%d/%Y", "%-m/%-d/%Y", "%d-%b-%Y", "%b %-d %Y", "%B %-d %Y", "%b %-d, %Y",
                 "%B %-d, %Y", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S")
ORACLE["release_date_formats"] = f"""
SELECT o_orderkey, CASE o_orderkey % 14 {" ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, f in enumerate(_DATE_FORMATS))}
       WHEN 12 THEN 'soon' ELSE strftime(o_orderdate, '%d.%m.%y') END AS raw_date,
       CASE WHEN o_orderkey % 14 < 12 THEN strftime(o_orderdate, '%Y-%m-%d') END AS "Release_Date"
FROM orders
"""

ORACLE["status_overlay"] = """
WITH s AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS Sample_Name FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS Sample_Name, o_orderpriority AS Project_run_type,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus
            WHEN o_orderpriority = '2-HIGH' THEN 'U'
            WHEN CAST(o_custkey AS VARCHAR) NOT IN (SELECT Sample_Name FROM s) THEN 'O'
            WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 1 THEN 'X'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'U' ELSE 'O' END AS ProjStatus
FROM orders
"""
