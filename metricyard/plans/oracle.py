"""DuckDB SQL twins of the registered jobs (same column names, same values).

These strings are the independent statement of each job's meaning; the Spark
side never runs them.
"""

from __future__ import annotations

_LINEITEM_LONG = """
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus{extra}, name, value
  FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus{extra},
                        CAST(l_quantity AS VARCHAR) AS l_quantity,
                        CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
                        CAST(l_discount AS VARCHAR) AS l_discount,
                        CAST(l_tax AS VARCHAR) AS l_tax
                 FROM lineitem)
        ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME name VALUE value)
  WHERE value IS NOT NULL AND trim(value) <> '' AND lower(trim(value)) NOT IN ('nan', 'null', 'n.a.')
"""

ORACLE: dict[str, str] = {}

ORACLE["pivot_long_measures"] = _LINEITEM_LONG.format(extra="")

ORACLE["metrics_index"] = f"""
WITH long AS ({_LINEITEM_LONG.format(extra=", l_shipdate")}),
stored AS (
  SELECT * FROM long WHERE l_shipdate < TIMESTAMP '1996-01-01'
  UNION
  SELECT * FROM long
)
SELECT l_returnflag AS Application, name AS Investigator_Folder,
       count(DISTINCT l_orderkey) AS Sample_Count
FROM stored
WHERE l_returnflag IS NOT NULL AND name IS NOT NULL
GROUP BY l_returnflag, name
"""

ORACLE["append_if_absent"] = """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
  FROM orders
),
target AS (SELECT * FROM o WHERE o_orderdate < '1998-01-01'),
batch AS (
  SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, 0 AS copy_no FROM o WHERE o_orderdate >= '1997-07-01'
  UNION ALL
  SELECT o_orderkey, o_custkey, 'X', o_totalprice, o_orderdate, o_orderpriority, 1
  FROM o WHERE o_orderdate >= '1997-07-01'
),
first_copy AS (
  SELECT o_orderkey, o_custkey, arg_min(o_orderstatus, copy_no) AS o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  FROM batch GROUP BY o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
)
SELECT * FROM target
UNION ALL
SELECT b.* FROM first_copy b
WHERE NOT EXISTS (
  SELECT 1 FROM target t
  WHERE t.o_orderkey IS NOT DISTINCT FROM b.o_orderkey AND t.o_custkey IS NOT DISTINCT FROM b.o_custkey
    AND t.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AND t.o_orderdate IS NOT DISTINCT FROM b.o_orderdate
    AND t.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority)
"""

ORACLE["app_index"] = """
SELECT event_type AS Application, strftime(ts, '%Y-%m') AS Investigator_Folder,
       count(DISTINCT user_id) AS Sample_Count
FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT lang, source, count(DISTINCT doc_id) FROM documents
WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT 'conversations', role, count(DISTINCT conv_id) FROM conversations
WHERE role IS NOT NULL GROUP BY 1, 2
"""

ORACLE["pivot_long_numeric"] = """
WITH r AS (
  SELECT o_orderpriority AS file, o_orderkey AS row_no, 'o' || o_orderkey AS Sample_ID,
         o_orderstatus AS Status,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE 'n.a' END AS Lot,
         CAST(o_custkey AS VARCHAR) AS Plate_Number, printf('%.2f', o_totalprice) AS Total,
         strftime(o_orderdate, '%Y-%m-%d') AS Date
  FROM orders),
f AS (SELECT file, arg_min(Status, row_no) = 'F' AS lot_first FROM r GROUP BY file)
SELECT r.file, Sample_ID, Plate_Number, 'Lot' AS name,
       CASE WHEN lower(Lot) IN ('nan', 'n.a', 'n.a.') THEN NULL ELSE Lot END AS value
FROM r JOIN f ON r.file = f.file WHERE f.lot_first
UNION ALL SELECT file, Sample_ID, Plate_Number, 'Total', Total FROM r
UNION ALL SELECT file, Sample_ID, Plate_Number, 'Date', Date FROM r
"""

ORACLE["append_except"] = """
WITH target AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal < 5000),
one AS (SELECT c_custkey, c_name,
               CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
        FROM customer),
batch AS (SELECT * FROM one UNION ALL SELECT * FROM one)
SELECT * FROM target
UNION ALL
SELECT c_custkey, c_name, c_mktsegment, NULL::INTEGER AS c_nationkey FROM (
  SELECT c_custkey, c_name, c_mktsegment FROM batch
  EXCEPT
  SELECT c_custkey, c_name, c_mktsegment FROM target)
"""

ORACLE["append_distinct_all"] = """
SELECT DISTINCT * FROM (
  SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier
  UNION ALL SELECT c_name, c_nationkey, NULL::DOUBLE, c_mktsegment FROM customer
  UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL::VARCHAR FROM supplier)
"""

ORACLE["evolve_append"] = """
WITH r AS (SELECT r_name AS Investigator_Folder, CAST(r_regionkey AS VARCHAR) AS Project_ID,
                  'region' AS name, r_name AS value,
                  NULL::VARCHAR AS Nation_Key_n, NULL::VARCHAR AS n_region FROM region),
n AS (SELECT n_name AS Investigator_Folder, CAST(n_nationkey AS VARCHAR) AS Project_ID,
             'nation' AS name, n_name AS value,
             CAST(n_nationkey AS VARCHAR) AS Nation_Key_n, CAST(n_regionkey AS VARCHAR) AS n_region FROM nation)
SELECT * FROM r
UNION ALL
(SELECT * FROM n EXCEPT SELECT * FROM r)
"""

ORACLE["batch_probe_skip"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity, l_shipdate,
                   l_partkey, l_suppkey FROM lineitem),
target AS (SELECT l_orderkey, l_linenumber, l_quantity FROM li WHERE l_shipdate < TIMESTAMP '1995-07-01'),
probe AS (
  SELECT l_orderkey, l_linenumber, l_quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn FROM li) WHERE rn = 2),
seen AS (SELECT DISTINCT p.l_orderkey FROM probe p JOIN target t
         ON p.l_orderkey IS NOT DISTINCT FROM t.l_orderkey AND p.l_linenumber IS NOT DISTINCT FROM t.l_linenumber
        AND p.l_quantity IS NOT DISTINCT FROM t.l_quantity)
SELECT l_orderkey, l_linenumber, l_quantity FROM li WHERE l_orderkey NOT IN (SELECT l_orderkey FROM seen)
"""

ORACLE["publish_delta"] = """
WITH a AS (SELECT count(*) AS after_rows, count(DISTINCT o_custkey) AS after_samples FROM orders),
b AS (SELECT count(*) AS before_rows, count(DISTINCT o_custkey) AS before_samples
      FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
sa AS (SELECT count(*) AS after_seq_rows FROM lineitem),
sb AS (SELECT count(*) AS before_seq_rows FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')
SELECT after_rows, before_rows, after_rows - before_rows AS delta_rows,
       after_samples, before_samples, after_samples - before_samples AS delta_samples,
       after_seq_rows, before_seq_rows, after_seq_rows - before_seq_rows AS delta_seq_rows,
       NOT (after_rows - before_rows = 0 AND after_seq_rows - before_seq_rows = 0) AS publish
FROM a, b, sa, sb
"""

ORACLE["import_stats"] = """
WITH b AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
n AS (SELECT DISTINCT o_orderkey, o_custkey, o_orderdate FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = o.o_orderkey AND b.o_custkey = o.o_custkey
                        AND b.o_orderdate = o.o_orderdate))
SELECT (SELECT count(*) FROM b) AS before,
       (SELECT count(*) FROM b) + (SELECT count(*) FROM n) AS after,
       greatest((SELECT count(*) FROM n), 0) AS new,
       (SELECT count(DISTINCT CAST(o_custkey AS VARCHAR)) FROM n) AS sample_size
"""

_STATUS = """
WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS Sample_Name, o_orderpriority AS Project_run_type,
                  o_orderstatus AS ProjStatus FROM orders),
s AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS Sample_Name FROM customer WHERE c_mktsegment = 'BUILDING')
"""

ORACLE["count_to_update"] = _STATUS + """
SELECT count(*) AS n_to_update FROM t
WHERE Project_run_type = '1-URGENT' AND ProjStatus = 'O' AND Sample_Name IN (SELECT Sample_Name FROM s)
"""

ORACLE["status_update"] = _STATUS + """
SELECT o_orderkey, Sample_Name, Project_run_type,
       CASE WHEN Project_run_type = '1-URGENT' AND ProjStatus = 'O' AND Sample_Name IN (SELECT Sample_Name FROM s)
            THEN 'U' ELSE ProjStatus END AS ProjStatus
FROM t
"""

ORACLE["export_scope"] = _STATUS + """
SELECT o_orderkey, Sample_Name, Project_run_type,
       CASE WHEN ProjStatus = 'O' THEN 'U' ELSE ProjStatus END AS ProjStatus
FROM t WHERE Project_run_type = '1-URGENT' AND Sample_Name IN (SELECT Sample_Name FROM s)
"""

_THREE = """
WITH ev AS (SELECT event_type AS Application, strftime(ts, '%Y-%m') AS Investigator_Folder FROM events),
docs AS (SELECT lang AS Application, source AS Investigator_Folder FROM documents),
conv AS (SELECT role AS Application, 'conversations' AS Investigator_Folder FROM conversations)
"""

ORACLE["unified_view"] = _THREE + """
SELECT Application, Investigator_Folder, 'events' AS Source FROM ev
UNION SELECT Application, Investigator_Folder, 'documents' FROM docs
UNION SELECT Application, Investigator_Folder, 'conversations' FROM conv
"""

ORACLE["app_present"] = _THREE + """,
known AS (SELECT Application FROM ev UNION SELECT Application FROM docs UNION SELECT Application FROM conv),
cand AS (SELECT DISTINCT CASE WHEN starts_with(url, 'https') THEN upper(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1))
                          ELSE regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END AS Application FROM pages)
SELECT c.Application,
       EXISTS (SELECT 1 FROM known k WHERE lower(k.Application) = lower(c.Application)) AS present_ignore_case,
       EXISTS (SELECT 1 FROM known k WHERE k.Application = c.Application) AS present_exact
FROM cand c
"""

_ENRICHED = """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS Sample_Name,
                   CAST(l_suppkey AS VARCHAR) AS GT_QC_Sample_ID FROM lineitem),
p AS (SELECT CASE WHEN p_size <= 25 THEN CAST(p_partkey AS VARCHAR) END AS name_key,
             CAST(p_size AS VARCHAR) AS id_key, p_partkey AS row_no, p_brand AS Domain1, p_type AS Species1 FROM part),
by_name AS (SELECT name_key AS k, arg_max(Domain1, row_no) AS d, arg_max(Species1, row_no) AS s FROM p
            WHERE name_key IS NOT NULL AND lower(trim(name_key)) NOT IN ('', 'null', 'nan', 'n.a.') GROUP BY name_key),
by_id AS (SELECT id_key AS k, arg_max(Domain1, row_no) AS d, arg_max(Species1, row_no) AS s FROM p
          WHERE id_key IS NOT NULL AND lower(trim(id_key)) NOT IN ('', 'null', 'nan', 'n.a.') GROUP BY id_key),
e AS (
  SELECT li.*,
         CASE WHEN n.k IS NOT NULL THEN n.d WHEN i.k IS NOT NULL THEN i.d ELSE 'NaN' END AS Domain1,
         CASE WHEN n.k IS NOT NULL THEN n.s WHEN i.k IS NOT NULL THEN i.s ELSE 'NaN' END AS Species1,
         CASE WHEN n.k IS NOT NULL THEN 'name' WHEN i.k IS NOT NULL THEN 'id' END AS matched_by
  FROM li LEFT JOIN by_name n ON li.Sample_Name = n.k LEFT JOIN by_id i ON li.GT_QC_Sample_ID = i.k)
"""

ORACLE["enrich_two_key"] = _ENRICHED + "SELECT * FROM e"

ORACLE["unmatched"] = _ENRICHED + """
SELECT l_orderkey, l_linenumber, Sample_Name, GT_QC_Sample_ID FROM e
WHERE matched_by IS NULL
  AND Sample_Name IS NOT NULL AND lower(trim(Sample_Name)) NOT IN ('', 'null', 'nan', 'n.a.')
  AND GT_QC_Sample_ID IS NOT NULL AND lower(trim(GT_QC_Sample_ID)) NOT IN ('', 'null', 'nan', 'n.a.')
"""

ORACLE["lanes_x_samples"] = """
WITH samples AS (SELECT n.n_regionkey AS Project_ID, s.s_suppkey, s.s_name
                 FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
lanes AS (SELECT n_regionkey AS Project_ID, n_nationkey AS Lane, n_name AS Lane_Name FROM nation)
SELECT s.Project_ID, s.s_suppkey, s.s_name, l.Lane, l.Lane_Name
FROM samples s LEFT JOIN lanes l ON s.Project_ID = l.Project_ID
"""

ORACLE["percent_two_decimals"] = """
SELECT l_orderkey, l_linenumber, printf('%.2f', l_discount * 100) AS discount_pct FROM lineitem
"""

ORACLE["path_parts"] = """
WITH p AS (SELECT page_id, url, regexp_replace(url, '^/+|/+$', '', 'g') AS t FROM pages),
q AS (SELECT *, string_split(t, '/') AS parts FROM p)
SELECT page_id,
       nullif(trim(CASE WHEN instr(t, '/') > 0 THEN (CASE WHEN len(parts) >= 2 THEN parts[-2] END) ELSE t END), '')
         AS delivery_folder,
       nullif(trim(CASE WHEN instr(t, '/') > 0 THEN (CASE WHEN len(parts) >= 3 THEN parts[-3] END) ELSE t END), '')
         AS delivery_folder_pacbio,
       regexp_extract(url, '^(.*)/[^/]*$', 1) AS parent_dir,
       string_split(url, '/')[-1] AS base_name,
       string_split(url, '_')[-1] AS last_token,
       split_part(url, '.', 1) AS first_token
FROM q
"""

_SANITIZE = """regexp_replace(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace({x}, '>=', '_GE_'), '<=', '_LE_'), '>', '_GT_'), '<', '_LT_'), '%', 'PCT'), ':', ''),
  '[ \\t\\n\\r\\f\\x0B]+', '_', 'g'), '__+', '_', 'g'), '_$', '')"""

ORACLE["sanitize_header"] = f"""
WITH p AS (SELECT page_id, html, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)
SELECT page_id,
       {_SANITIZE.format(x='title')} AS title_sanitized,
       regexp_replace(regexp_replace(regexp_replace(title, '[^a-zA-Z0-9_]', '_', 'g'), '__', '_', 'g'), '_$', '') AS title_clean,
       translate(title, ' ()', '___') AS title_pacbio,
       md5({_SANITIZE.format(x='html')}) AS html_sanitized_md5,
       length({_SANITIZE.format(x='html')}) AS html_sanitized_len
FROM p
"""

ORACLE["species_names"] = """
SELECT doc_id,
       regexp_replace(regexp_replace(
         (CASE lang WHEN 'en' THEN 'human' WHEN 'de' THEN 'Human' WHEN 'fr' THEN 'homo sapiens' ELSE 'marmoset' END)
         || ' ' || source, 'homo sapiens|Human|human', 'Homo sapiens', 'g'), 'marmoset', 'Callithrix jacchus', 'g') AS Species,
       md5(regexp_replace(regexp_replace(text, 'homo sapiens|Human|human', 'Homo sapiens', 'g'),
                          'marmoset', 'Callithrix jacchus', 'g')) AS text_md5
FROM documents
"""

ORACLE["strip_commas"] = """
WITH c AS (SELECT c_custkey, '"' || format('{:,.2f}', c_acctbal) || '",' || c_name || ',"' || c_mktsegment || ', x"' AS raw
           FROM customer)
SELECT c_custkey, raw,
       array_to_string(list_transform(string_split(raw, '"'),
                       lambda x, i: CASE WHEN i % 2 = 0 THEN replace(x, ',', '') ELSE x END), '') AS cleaned
FROM c
"""

ORACLE["lists"] = """
WITH d AS (SELECT doc_id, text,
                  list_distinct(list_filter(list_transform(string_split(regexp_replace(text, '[.;]', ',', 'g'), ','),
                                                           lambda x: trim(x)), lambda x: x <> '')) AS items
           FROM documents)
SELECT doc_id, len(items) AS n_items, md5(array_to_string(list_sort(items), '|')) AS items_md5,
       md5(trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ')) AS collapsed_md5
FROM d
"""

ORACLE["missing_values"] = """
WITH e AS (
  SELECT event_id, event_type,
         CASE WHEN event_type = 'error' THEN 'NaN' WHEN event_type = 'view' THEN ' n.a. '
              WHEN value < 1 THEN '' WHEN event_type = 'signup' THEN 'NULL' WHEN event_type = 'click' THEN 'n.a'
              ELSE printf('%.2f', value) END AS raw
  FROM events)
SELECT event_id, raw,
       raw IS NULL OR lower(trim(raw)) IN ('', 'null', 'nan', 'n.a.') AS is_missing,
       raw IS NULL OR lower(trim(raw)) IN ('nan', 'null', 'n.a.') OR trim(raw) = '' AS dropped,
       CASE WHEN lower(raw) IN ('nan', 'n.a', 'n.a.') THEN NULL ELSE raw END AS nullified,
       nullif(raw, '') AS coalesced,
       greatest(len(string_split(event_type || ',' || raw, ',')), 4) AS padded_width
FROM e
"""

ORACLE["json_lookup"] = """
WITH e AS (SELECT event_id, event_type, user_id, nullif(trim(json_extract_string(props, '$.k')), '') AS k FROM events)
SELECT event_id, k, event_type AS application, '/runs/' || user_id AS first_path,
       upper(event_type[1]) || lower(event_type[2:]) AS organism,
       k AS Polymerase_Reads_raw,
       printf('%.2f', CAST('0.' || k AS DOUBLE) * 100) AS Q30_base_PCT_ccs_raw,
       NULL::VARCHAR AS Polymerase_Read_Bases_raw
FROM e
"""

ORACLE["proj_status"] = """
SELECT event_id,
       CASE WHEN event_type = 'error' OR value > 40 THEN 'Undelivered' ELSE 'Delivered' END AS ProjStatus
FROM events
"""

ORACLE["release_date"] = """
WITH d AS (
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
                              WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y/%m/%d')
                              WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y%m%d')
                              WHEN '4-NOT SPECIFIED' THEN '' ELSE 'not a date' END AS raw_date
  FROM orders)
SELECT o_orderkey, raw_date,
       strftime(coalesce(try_strptime(raw_date, '%Y-%m-%d'), try_strptime(raw_date, '%Y/%m/%d'),
                         try_strptime(raw_date, '%Y%m%d')), '%Y-%m-%d') AS Release_Date
FROM d
"""

ORACLE["age_filters"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day_stamp,
       date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS days_old,
       date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) > 10 AS expired
FROM orders
"""

_LINES = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(generate_series(1, len(parts))) AS line_no, unnest(parts) AS line FROM d)
"""

ORACLE["header_marker_report"] = _LINES + """,
h AS (SELECT doc_id, min(line_no) AS header_line_no FROM lines WHERE contains(line, '###') GROUP BY doc_id),
s AS (SELECT l.doc_id, h.header_line_no,
             count(*) FILTER (WHERE l.line_no > h.header_line_no) AS data_rows,
             max(CASE WHEN l.line_no = h.header_line_no THEN md5(l.line) END) AS header_md5
      FROM lines l JOIN h ON l.doc_id = h.doc_id GROUP BY l.doc_id, h.header_line_no)
SELECT d.doc_id, s.header_line_no, coalesce(s.data_rows, 0) AS data_rows, s.header_md5
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id
"""

ORACLE["lane_block"] = _LINES + """,
st AS (SELECT doc_id, min(line_no) AS s FROM lines WHERE contains(line, 'License') GROUP BY doc_id),
sp AS (SELECT l.doc_id, min(l.line_no) AS e FROM lines l JOIN st ON l.doc_id = st.doc_id
       WHERE contains(l.line, '###') AND l.line_no > st.s GROUP BY l.doc_id)
SELECT l.doc_id, l.line_no, md5(l.line) AS line_md5
FROM lines l JOIN st ON l.doc_id = st.doc_id LEFT JOIN sp ON l.doc_id = sp.doc_id
WHERE l.line_no >= st.s AND (sp.e IS NULL OR l.line_no < sp.e)
"""

ORACLE["line_after_marker"] = _LINES + """,
st AS (SELECT doc_id, min(line_no) AS s FROM lines WHERE contains(line, '###') GROUP BY doc_id)
SELECT l.doc_id, l.line_no, md5(l.line) AS line_md5 FROM lines l JOIN st ON l.doc_id = st.doc_id
WHERE l.line_no = st.s + 1
"""

ORACLE["marker_block"] = _LINES + """,
sig AS (SELECT *, CASE WHEN contains(line, 'token') THEN 1 WHEN contains(line, '##') THEN 0 END AS s FROM lines),
st AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state_before FROM sig)
SELECT doc_id, line_no, md5(line) AS line_md5 FROM st WHERE state_before = 1 AND NOT contains(line, '##')
"""

_DOC_LOGS = """
WITH d AS (
  SELECT doc_id, 'doc' || doc_id AS project, lang AS pipeline,
         CASE WHEN n_chars > 5000 THEN 'gather' WHEN n_chars > 2000 THEN 'package' ELSE 'run' END AS stage,
         string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT project, pipeline, stage, unnest(parts) AS line FROM d)
"""

# Written out here: the twin must not read the rules it checks.
_LAB_RULES = [("run", "Unrecognized platform by QiFa"), ("run", "Program aborted"),
              ("run", "ERROR: Please complete basic QC before"), ("run", "0 .gz file(s) found"),
              ("run", "ERROR: loadQCParametersSetting organism"), ("package", "Program aborted"),
              ("release", "Program aborted"), ("gather", "!!!WARNING!!!"),
              ("gather", "ERROR: Could not locate output from QC pipeline")]
_RULES = _LAB_RULES + [("run", "Released under"), ("run", "Licensed under"), ("run", 'token = "'),
                       ("gather", "###"), ("package", "$$$"), ("gather", "%%%")]
_TOOL_LINE = """(['x Unrecognized platform by QiFa y', 'Program aborted.', 'ERROR: Please complete basic QC before proceeding',
  'Please complete basic QC before proceeding', '0 .gz file(s) found', 'ERROR: loadQCParametersSetting organism',
  'loadQCParametersSetting organism', '!!!WARNING!!!', 'ERROR: Could not locate output from QC pipeline',
  'Could not locate output from QC pipeline', 'fine'])[doc_id % 11 + 1]"""

_RANK = "CASE " + " ".join(
    f"WHEN stage = '{st}' AND contains(line, '{pat}') THEN {i}" for i, (st, pat) in enumerate(_RULES, 1)) + " END"
_PATTERN = "CASE r " + " ".join(f"WHEN {i} THEN '{pat}'" for i, (_, pat) in enumerate(_RULES, 1)) + " END"

ORACLE["log_triage"] = _DOC_LOGS + f"""
SELECT project, pipeline, stage, {_PATTERN} AS error_class FROM (
  SELECT project, pipeline, stage, min({_RANK}) AS r
  FROM (SELECT * FROM lines UNION ALL SELECT project, pipeline, stage, {_TOOL_LINE} AS line FROM d)
  GROUP BY project, pipeline, stage)
"""

_LAB_RANK = "CASE " + " ".join(
    f"WHEN stage = '{st}' AND contains(line, '{pat}') THEN {i}" for i, (st, pat) in enumerate(_LAB_RULES, 1)) + " END"
_LAB_PATTERN = "CASE r " + " ".join(f"WHEN {i} THEN '{pat}'" for i, (_, pat) in enumerate(_LAB_RULES, 1)) + " END"

ORACLE["first_error"] = f"""
WITH l AS (
  SELECT source || '-' || (n_chars % 50) AS project, CASE lang WHEN 'en' THEN 'basic' WHEN 'fr' THEN 'main' ELSE lang END AS pipeline,
         (['run', 'package', 'release', 'gather'])[doc_id % 4 + 1] AS stage, {_TOOL_LINE} AS line FROM documents),
c AS (SELECT project, pipeline, stage, min({_LAB_RANK}) AS r FROM l GROUP BY ALL),
h AS (SELECT project, pipeline, stage, {_LAB_PATTERN} AS error_class,
        row_number() OVER (PARTITION BY project ORDER BY
          CASE pipeline WHEN 'basic' THEN 0 WHEN 'main' THEN 1 ELSE 2 END,
          CASE WHEN pipeline = 'basic' THEN CASE stage WHEN 'run' THEN 0 WHEN 'package' THEN 1 WHEN 'release' THEN 2 ELSE 3 END
               ELSE CASE stage WHEN 'run' THEN 0 WHEN 'gather' THEN 1 WHEN 'package' THEN 2 ELSE 3 END END, pipeline) AS k
      FROM c WHERE r IS NOT NULL)
SELECT project, pipeline, stage, error_class FROM h WHERE k = 1
"""

ORACLE["stage_status"] = _DOC_LOGS + """
SELECT project, pipeline,
       CASE WHEN bool_or(contains(line, '###')) THEN 'failed' WHEN bool_or(contains(line, '$$$')) THEN 'incomplete'
            WHEN bool_or(contains(line, 'License')) THEN 'gathered' END AS status
FROM lines GROUP BY project, pipeline
"""

ORACLE["manifest_counts"] = """
WITH p AS (SELECT url, regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS lang FROM pages),
f AS (SELECT (CASE WHEN contains(url, '?') THEN 'Undetermined_S0_' ELSE 'S1_' END)
             || (CASE lang WHEN 'en' THEN 'R1_' WHEN 'fr' THEN 'R2_' WHEN 'de' THEN 'I1_' WHEN 'es' THEN 'I2_' ELSE 'R3_' END)
             || '001' || (CASE WHEN contains(url, '#') THEN '.html' ELSE '.fastq.gz' END) AS name FROM p)
SELECT regexp_extract(name, '(R1_|R2_|R3_|I1_|I2_)', 1) AS tag, count(*) AS fastq_total,
       count(*) FILTER (WHERE contains(name, 'Undetermined')) AS undetermined_total
FROM f WHERE regexp_matches(name, '\\.f(ast)?q(\\.gz)?$') GROUP BY 1
UNION ALL
SELECT 'all', count(*), count(*) FILTER (WHERE contains(name, 'Undetermined'))
FROM f WHERE regexp_matches(name, '\\.f(ast)?q(\\.gz)?$')
"""

ORACLE["known_names"] = """
WITH req AS (SELECT DISTINCT trim(x) AS name FROM (VALUES ('  src3 '), ('# src4'), (''), ('src1'), ('srcX'),
                                                         ('src12'), ('src3'), ('#')) t(x)
             WHERE trim(x) <> '' AND NOT starts_with(trim(x), '#')),
cat AS (SELECT source AS name, min(doc_id) AS pos FROM documents GROUP BY source),
rel AS (SELECT arg_min(c.name, c.pos) AS name FROM cat c WHERE c.name IN (SELECT name FROM req))
SELECT r.name, c.pos IS NOT NULL AS known, coalesce(r.name = (SELECT name FROM rel), false) AS is_release
FROM req r LEFT JOIN cat c ON r.name = c.name
"""

ORACLE["route_application"] = """
WITH d AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'mRNA' WHEN 'de' THEN 'PDX-WGS' WHEN 'fr' THEN 'Other'
                          ELSE 'ATACSeq,ATAC' END AS application FROM documents),
r(pipeline, application) AS (VALUES ('atacseq','ATACSeq'), ('atacseq','ATAC'), ('chic','Other'), ('hic','HiC'),
  ('ctp','PDX-WGS'), ('pdxrnaseqR2','cellranger'), ('rnaseq','mRNA'), ('rnaseq','Total-RNA'), ('rrbs','RRBS'),
  ('wgbs','WGBS'), ('chipseq','ChiP'), ('chipseq','ChIPSeq'), ('pdxrnaseq','PDX-mRNA'), ('pdxrnaseq','pdxrnaseq'),
  ('pdxwgs','PDX-WGS'), ('rnaseqR2','cellranger'), ('wes','WES'), ('wgs','WGS'), ('wgs','ChIA-PET'),
  ('basic','Amplicon'), ('basic','Other'), ('ONT','ONT'), ('PacBio','PacBio'))
SELECT d.doc_id, d.application, r.pipeline FROM d JOIN r ON d.application = r.application
"""

ORACLE["instrument_rules"] = """
WITH p AS (SELECT p_partkey, p_size,
  ['m84148_240101', 'm64119e_230101', 'r64039_x', 'SQ65039', 'GXB02036', 'PCA100115', 'GXB03074',
   'P2S-01535', 'GXB01025', 'GXB01102', 'GXB01186', 'PC24B149', 'PCT0053', 'other-host', ''][(p_size % 15) + 1]
  AS instrument_name FROM part)
SELECT p_partkey, instrument_name, CASE WHEN p_size <= 25 THEN 'PacBio' ELSE 'ONT' END AS platform,
  CASE WHEN p_size <= 25 THEN
    CASE WHEN contains(instrument_name, '84148') THEN 'CT_Revio_84148'
         WHEN contains(instrument_name, 'SQ65119') OR contains(instrument_name, '64119') THEN 'CT_Sequel_SQ65119'
         WHEN contains(instrument_name, 'SQ65039') OR contains(instrument_name, 'r64039') THEN 'CT_Sequel_SQ65039'
         ELSE nullif(instrument_name, '') END
  ELSE
    CASE WHEN contains(instrument_name, 'GXB02036') THEN 'CT_GridIONX5_GXB02036'
         WHEN contains(instrument_name, 'PCA100115') THEN 'CT_PromethION_PCA100115'
         WHEN contains(instrument_name, 'GXB03074') THEN 'BH_GridIONX5_GXB03074'
         WHEN contains(instrument_name, 'P2S-01535') THEN 'BH_P2_Solo_P2S-01535'
         WHEN contains(instrument_name, 'GXB01025') THEN 'CT_GridIONX5_GXB01025'
         WHEN contains(instrument_name, 'GXB01102') THEN 'CT_GridIONX5_GXB01102'
         WHEN contains(instrument_name, 'GXB01186') THEN 'CT_GridIONX5_GXB01186'
         WHEN contains(instrument_name, 'PC24B149') THEN 'CT_PromethION_PC24B149'
         WHEN contains(instrument_name, 'PCT0053') THEN 'CT_PromethION_PCT0053'
         ELSE nullif(instrument_name, '') END
  END AS InstrumentID
FROM p
"""

ORACLE["select_drop_split"] = """
WITH p AS (SELECT *, first_value(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS first_size,
             CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE 'none' END AS lot,
             CAST(CAST(p_retailprice AS DECIMAL(15, 2)) AS VARCHAR) AS price FROM part),
c AS (SELECT *, p_partkey || ',' || p_name || ',' || p_brand || ',' || p_type AS front FROM p)
SELECT p_brand AS file, p_partkey AS row_no,
       'GT_QC_Sample_ID,Sample_Name,Domain1,Species2=' || front AS species_cells,
       'GT_QC_Sample_ID,Sample_Name,Domain1,Species2,Lot,Size,Price=' || front || ',' || lot || ',' || p_size || ',' || price AS kept_cells,
       CASE WHEN first_size > 25 THEN 'Sample_Name,Domain1,Species2=' || p_name || ',' || p_brand || ',' || p_type
            ELSE 'Sample_Name,Domain1,Species2,Lot=' || p_name || ',' || p_brand || ',' || p_type || ',' || lot END AS id_cells,
       CASE WHEN first_size > 25 THEN 'GT_QC_Sample_ID,Lot,Size,Price=' || p_partkey || ',' || lot || ',' || p_size || ',' || price
            ELSE 'GT_QC_Sample_ID,Size,Price=' || p_partkey || ',' || p_size || ',' || price END AS value_cells
FROM c
"""

ORACLE["scan_scope"] = """
WITH apps AS (SELECT DISTINCT event_type AS application FROM events),
tr AS (SELECT event_type AS application, CAST(max(ts) AS DATE) AS last_archive_scan FROM events
       WHERE value < 10 GROUP BY 1),
pr AS (SELECT DISTINCT event_type AS application FROM events WHERE value > 95),
hl AS (SELECT DISTINCT event_type AS application FROM events WHERE value >= 50 AND value < 51),
x AS (SELECT a.application,
             date_diff('day', tr.last_archive_scan, CAST((SELECT max(ts) FROM events) AS DATE)) AS d,
             pr.application IS NOT NULL AS p, hl.application IS NOT NULL AS h
      FROM apps a LEFT JOIN tr ON a.application = tr.application LEFT JOIN pr ON a.application = pr.application
      LEFT JOIN hl ON a.application = hl.application)
SELECT application, d AS days_since_archive_scan,
       CASE WHEN d >= 5 THEN 'archive' WHEN p AND h THEN 'active' ELSE 'all' END AS scope,
       CASE WHEN d >= 5 THEN 'archive' WHEN p AND h THEN 'active' ELSE 'all' END = 'archive' AS allow_undelivered
FROM x
"""

ORACLE["new_projects"] = """
SELECT page_id AS project_id, url FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)
"""

ORACLE["requeue"] = """
SELECT doc_id AS project_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
"""

ORACLE["candidate_counts"] = """
WITH c AS (SELECT regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS application,
                  page_id NOT IN (SELECT doc_id FROM labels) AS eligible FROM pages),
a AS (SELECT DISTINCT lang AS application FROM documents),
k AS (SELECT application, count(*) AS found, count(*) FILTER (WHERE eligible) AS eligible FROM c GROUP BY 1)
SELECT a.application, coalesce(k.found, 0) AS found, coalesce(k.eligible, 0) AS eligible,
       coalesce(k.eligible, 0) = 0 AS skip
FROM a LEFT JOIN k ON a.application = k.application
"""

_VALIDATE = """
WITH d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
v AS (SELECT doc_id,
        CASE WHEN quality IS NULL THEN 'settings missing' WHEN toxic = 1 THEN 'metadata incomplete'
             WHEN n_chars < 200 THEN 'report missing' WHEN source IN ('src0', 'src1') THEN 'flowcell missing'
             WHEN NOT contains(text, '###') THEN 'parse failed' END AS reason FROM d)
"""

ORACLE["validate_project"] = _VALIDATE + "SELECT doc_id, reason FROM v"

ORACLE["failure_summary"] = _VALIDATE + """
SELECT reason, count(*) AS projects FROM v WHERE reason IS NOT NULL GROUP BY reason
"""

ORACLE["delivery_gate"] = """
SELECT doc_id, NOT (lang = 'es' OR n_chars < 500) AS ready FROM documents
"""

ORACLE["width_check"] = """
SELECT doc_id, len(string_split(string_split(text, chr(10))[1], ' ')) AS width,
       len(string_split(string_split(text, chr(10))[1], ' ')) < 14 AS rejected
FROM documents
"""

ORACLE["registry_ops"] = """
WITH adds AS (SELECT role AS grp, 'u' || conv_id || '@lab.org' AS "user", min(conv_id * 1000 + turn) + 1 AS pos
              FROM conversations GROUP BY 1, 2),
rm AS (SELECT DISTINCT role AS grp, 'u' || conv_id || '@lab.org' AS "user" FROM conversations WHERE length(text) < 100),
kept AS (SELECT a.* FROM adds a WHERE NOT EXISTS (SELECT 1 FROM rm WHERE rm.grp = a.grp AND rm."user" = a."user"))
SELECT grp, "user", pos FROM kept
UNION ALL
SELECT grp, NULL, NULL FROM (SELECT DISTINCT trim(role) AS grp FROM conversations) g
WHERE grp NOT IN (SELECT grp FROM kept)
"""

ORACLE["stream_append"] = """
SELECT DISTINCT event_id, user_id, event_type FROM events
"""

ORACLE["stream_groups"] = """
SELECT DISTINCT trim(event_type) AS grp, NULL::VARCHAR AS "user", NULL::BIGINT AS pos FROM events
WHERE trim(event_type) <> '' AND trim(event_type) <> 'Investigator_Folder'
"""

ORACLE["typed_csv"] = """
SELECT DISTINCT
  CAST(month(l_shipdate) AS INTEGER) AS Month, CAST(year(l_shipdate) AS INTEGER) AS Year,
  'P' || l_orderkey AS Project, l_returnflag AS Site, l_linestatus AS InstrumentID,
  'run' || l_linenumber AS RunFolder, 'g' || l_suppkey AS groupFolder, 'wgs' AS Application,
  '/data/' || l_orderkey AS FullPath, 'NovaSeq' AS Platform, CAST(floor(l_quantity) AS BIGINT) AS Reads,
  CAST(floor(l_extendedprice) AS BIGINT) AS Bases, l_partkey AS Bytes, '/deliver/' || l_orderkey AS DeliveryDirectory,
  l_linenumber AS SampleSize,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS PolymeraseReadLength_bp_Mean
FROM lineitem
WHERE NOT (l_linenumber = 6 AND l_returnflag = 'N') AND NOT (l_linenumber = 5 AND l_returnflag IN ('R', 'A'))
"""

ORACLE["clustered_write"] = """
SELECT l_returnflag AS Application, l_linestatus AS Release_Date, CAST(l_orderkey AS VARCHAR) AS Investigator_Folder,
       CAST(l_linenumber AS VARCHAR) AS Project_ID, 'run' AS Project_run_type, name, value
FROM (""" + _LINEITEM_LONG.format(extra="") + """) WHERE l_returnflag <> 'A'
"""

ORACLE["sniffed"] = """
SELECT DISTINCT 'grp' || c_nationkey AS grp FROM customer
"""

_C2 = "regexp_replace(regexp_replace(regexp_replace({x}, '[^a-zA-Z0-9_]', '_', 'g'), '__', '_', 'g'), '_$', '')"

ORACLE["clean_column_name"] = f"""
WITH w AS (SELECT DISTINCT word FROM (
             SELECT unnest(string_split(html, ' ')) AS word FROM pages)
           WHERE word <> '')
SELECT word, {_C2.format(x='word')} AS cleaned,
       {_C2.format(x=_SANITIZE.format(x='word'))} AS sanitized_cleaned
FROM w
"""
