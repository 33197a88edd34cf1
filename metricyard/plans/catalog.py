"""Registered jobs over the Parquet tables (one per operator family of SURVEY §2).

Each job maps the lab's data model onto a given table (projects, samples,
applications, reports ...) and then runs the library operators unchanged. The
jobs read whole tables; there is no row cap, sample or id subset anywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import marts, merge, shape
from ..session import cut_lineage
from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ R1/R3 + M1 + A1
TASK_ROWS = 200_000       # rows of a batch that a task groups in memory


def dealt(df: DataFrame, key) -> DataFrame:
    """``df`` dealt once by ``key`` for several appends, to as many tasks as its rows need (a stored table is counted by its footers)."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // TASK_ROWS + 1)
    return df.repartition(n, *key)


def lineitem_long(spark: SparkSession, sf_dir: str, extra_ids=(), appended: bool = False) -> DataFrame:
    """lineitem as a wide report: ids left of the anchor, four measures right of it. To be ``appended``, the wide rows, a
    fourth as many as the long ones, are dealt by their ids; then long rows need no shuffle by a key that holds these."""
    ids = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", *extra_ids]
    li = read_table(spark, sf_dir, "lineitem").select(*ids, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    long = shape.pivot_long_from(dealt(li, ids) if appended else li, anchor="l_quantity")
    return long.filter(~clean.value_is_dropped("value"))


@register("pivot_long_measures")
def pivot_long_measures(spark, sf_dir):
    """R1 + R3 + F7: wide rows -> (ids, name, value) with missing values removed."""
    return lineitem_long(spark, sf_dir)


@register("metrics_index")
def metrics_index(spark, sf_dir):
    """Flagship: long rows appended twice with append-if-absent, then the distinct-sample index.

    target = rows of lines shipped before 1996; batch = every row (overlapping the target).
    Key = every column (first writer wins); the index counts distinct orders per
    (Application = return flag, Investigator_Folder = metric name).
    """
    long = lineitem_long(spark, sf_dir, extra_ids=("l_shipdate",), appended=True)
    target = long.filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    stored = merge.append_if_absent(target, long, key=long.columns)   # dealt as its inputs are, so neither append shuffles
    stored = merge.append_if_absent(stored, long, key=long.columns)   # second run adds nothing
    table = stored.select(F.col("l_returnflag").alias("Application"),
                          F.col("name").alias("Investigator_Folder"),
                          F.col("l_orderkey").alias("Sample_Name"))
    return marts.app_index([(table, "Sample_Name")])


@register("append_if_absent")
def append_if_absent_q(spark, sf_dir):
    """M1 + M5: orders before 1998 are stored; the batch is every order from mid-1997 on, twice.

    The first copy carries lower-case status, the second 'X'; status is not part of the key,
    so stored rows keep theirs and new rows take the first copy's.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    target = o.filter(F.col("o_orderdate") < "1998-01-01")
    recent = o.filter(F.col("o_orderdate") >= "1997-07-01")
    batch = (recent.withColumn("o_orderstatus", F.lower("o_orderstatus")).withColumn("copy_no", F.lit(0))
             .unionByName(recent.withColumn("o_orderstatus", F.lit("X")).withColumn("copy_no", F.lit(1))))
    key = [c for c in o.columns if c != "o_orderstatus"]
    new = merge.new_rows_if_absent(target, batch, key, order_col="copy_no").drop("copy_no")
    return target.unionByName(new)


@register("app_index")
def app_index_q(spark, sf_dir):
    """A1 + O1: distinct samples per (Application, Investigator_Folder) over three sources."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("Application"), F.date_format("ts", "yyyy-MM").alias("Investigator_Folder"),
        F.col("user_id").alias("Sample_Name"))
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("lang").alias("Application"), F.col("source").alias("Investigator_Folder"),
        F.col("doc_id").alias("Sample_Name"))
    conv = read_table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("Application"), F.col("role").alias("Investigator_Folder"),
        F.col("conv_id").alias("Sample_ID"))
    return marts.app_index([(ev, "Sample_Name"), (docs, "Sample_Name"), (conv, "Sample_ID")])


# ------------------------------------------------------------------ R2 numeric pivot
def orders_report(spark, sf_dir) -> DataFrame:
    """orders as report files: one file per priority, header + cells arrays, row_no = orderkey."""
    o = read_table(spark, sf_dir, "orders")
    header = F.array(*[F.lit(x) for x in ("Sample_ID", "Status", "Lot", "Plate_Number", "Total", "Date")])
    cells = F.array(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")),
        F.col("o_orderstatus"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise(F.lit("n.a")),
        F.col("o_custkey").cast("string"),
        F.format_string("%.2f", F.col("o_totalprice")),
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(F.col("o_orderpriority").alias("file"), F.col("o_orderkey").alias("row_no"),
                    header.alias("header"), cells.alias("cells"))


@register("pivot_long_numeric")
def pivot_long_numeric(spark, sf_dir):
    """R2 + F8: per file, the first column whose first-row cell is numeric starts the metrics;
    Plate_Number stays an id; missing spellings become NULL but the row stays."""
    from ..operators import ordered
    rep = orders_report(spark, sf_dir)
    first = ordered.first_by_group(rep, ["file"], "row_no", F.col("cells"), "first_cells")
    start = first.select("file", shape.first_numeric_position(F.col("first_cells")).alias("start"))
    staged = ordered.attach_per_group(rep, start, ["file"])
    long = shape.pivot_long_array(staged, F.col("start"), id_exceptions=("Plate_Number",))
    from ..sources.reports import cell
    return long.select("file", cell(F.col("header"), F.col("cells"), "Sample_ID").alias("Sample_ID"),
                       cell(F.col("header"), F.col("cells"), "Plate_Number").alias("Plate_Number"), "name",
                       clean.nullify_missing("value").alias("value"))


# ------------------------------------------------------------------ M2 / M3 / M4 / M6
@register("append_except")
def append_except_q(spark, sf_dir):
    """M2 + O4 + J7: target = customers with balance under 5000; batch = every customer (twice),
    with the status column lower-cased for negative balances and an extra batch-only column.
    Inserted: batch rows over the common columns EXCEPT the target's."""
    c = read_table(spark, sf_dir, "customer")
    target = c.filter(F.col("c_acctbal") < 5000).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    changed = F.when(F.col("c_acctbal") < 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    one = c.select("c_custkey", "c_name", changed.alias("c_mktsegment"), "c_acctbal")
    batch = one.unionByName(one)
    return merge.append_except(target, batch)


@register("append_distinct_all")
def append_distinct_all_q(spark, sf_dir):
    """M3 + O7: stored suppliers, new rows = customers and the suppliers again; union by name
    with missing columns as NULL, full duplicates dropped."""
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    return merge.append_distinct_all(s, c.unionByName(s, allowMissingColumns=True))


@register("evolve_append")
def evolve_append_q(spark, sf_dir):
    """M4 + M2: region rows stored; nation rows arrive with two extra, oddly spelt columns that
    are cleaned (C2) and added to the table."""
    r = read_table(spark, sf_dir, "region").select(
        F.col("r_name").alias("Investigator_Folder"), F.col("r_regionkey").cast("string").alias("Project_ID"),
        F.lit("region").alias("name"), F.col("r_name").alias("value"))
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("Investigator_Folder"), F.col("n_nationkey").cast("string").alias("Project_ID"),
        F.col("n_nationkey").cast("string").alias("Nation Key(n)"), F.col("n_regionkey").cast("string").alias("n.region"),
        F.lit("nation").alias("name"), F.col("n_name").alias("value"))
    return merge.evolve_append(r, n, fixed_cols=("Investigator_Folder", "Project_ID", "name", "value"))


@register("batch_probe_skip")
def batch_probe_skip(spark, sf_dir):
    """M6 + W3: the batch is every line item; an order is skipped when its 2nd line (by line
    number) is already stored (stored = lines shipped before 1995-07-01)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("l_quantity"), "l_shipdate",
        "l_partkey", "l_suppkey")
    target = li.filter(F.col("l_shipdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
    # file order = line number, then the remaining columns (line numbers repeat in this table)
    order = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    kept = merge.batch_seen_by_probe(li, target, ["l_orderkey"], order,
                                     key=["l_orderkey", "l_linenumber", "l_quantity"])
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


# ------------------------------------------------------------------ A2-A5, U1-U2
@register("publish_delta")
def publish_delta_q(spark, sf_dir):
    """A3 (+A2): snapshot = orders before 1997 and lines shipped before 1997; now = all."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    return marts.publish_delta(o.filter(F.col("o_orderdate") < cut), o, "o_custkey",
                               seq_before=li.filter(F.col("l_shipdate") < cut), seq_after=li)


@register("import_stats")
def import_stats_q(spark, sf_dir):
    """A4: orders before 1997 stored; batch = all orders; counts from the anti-join result."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    before = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    new = merge.new_rows_if_absent(before, o, ["o_orderkey", "o_custkey", "o_orderdate"])
    return marts.import_stats(before, new, "o_custkey")


def status_table(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("Sample_Name"),
                    F.col("o_orderpriority").alias("Project_run_type"), F.col("o_orderstatus").alias("ProjStatus"))


def sample_list(spark, sf_dir) -> DataFrame:
    """Names of BUILDING customers written padded, with blank entries, as a text list."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    raw = c.select(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ,, ")).alias("line"))
    return (raw.select(F.explode(clean.split_list("line")).alias("Sample_Name")).distinct())


@register("count_to_update")
def count_to_update(spark, sf_dir):
    """A5 + F14: rows of run type '1-URGENT', status 'O' (the 'Delivered' of this table), sample in list."""
    t = merge.status_scope(status_table(spark, sf_dir), "Project_run_type", "1-URGENT", sample_list(spark, sf_dir))
    return t.filter(F.col("ProjStatus") == "O").agg(F.count(F.lit(1)).alias("n_to_update"))


@register("status_update")
def status_update(spark, sf_dir):
    """Matching rows with status 'O' become 'U'; every other row unchanged."""
    return merge.update_status(status_table(spark, sf_dir), "Project_run_type", "1-URGENT",
                               sample_list(spark, sf_dir), from_status="O", to_status="U")


@register("export_scope")
def export_scope(spark, sf_dir):
    """After the update, all rows of the run type and samples whatever their status."""
    updated = merge.update_status(status_table(spark, sf_dir), "Project_run_type", "1-URGENT",
                                  sample_list(spark, sf_dir), from_status="O", to_status="U")
    return merge.status_scope(updated, "Project_run_type", "1-URGENT", sample_list(spark, sf_dir))


# ------------------------------------------------------------------ O2/O3/J8
def three_sources(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("Application"), F.date_format("ts", "yyyy-MM").alias("Investigator_Folder"))
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("lang").alias("Application"), F.col("source").alias("Investigator_Folder"))
    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("role").alias("Application"), F.lit("conversations").alias("Investigator_Folder"))
    return ev, docs, conv


@register("unified_view")
def unified_view_q(spark, sf_dir):
    """O2 + K4: distinct (Application, Investigator_Folder, Source) over three tables."""
    ev, docs, conv = three_sources(spark, sf_dir)
    return marts.unified_view([(ev, "events"), (docs, "documents"), (conv, "conversations")],
                              name="unified_qc_view")


@register("app_present")
def app_present_q(spark, sf_dir):
    """J8 + O3: candidate applications = page languages (upper-cased when the url is https);
    present when any table holds them, ignoring case, and exactly."""
    ev, docs, conv = three_sources(spark, sf_dir)
    p = read_table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    cand = p.select(F.when(F.col("url").startswith("https"), F.upper(lang)).otherwise(lang).alias("Application")).distinct()
    return marts.app_present([ev, docs, conv], cand)


# ------------------------------------------------------------------ J3/J4/J5
def enriched_lines(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("Sample_Name"),
        F.col("l_suppkey").cast("string").alias("GT_QC_Sample_ID"))
    part = read_table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") <= 25, F.col("p_partkey").cast("string")).alias("name_key"),
        F.col("p_size").cast("string").alias("id_key"), F.col("p_partkey").alias("row_no"),
        F.col("p_brand").alias("Domain1"), F.col("p_type").alias("Species1"))
    from ..operators import enrich
    return enrich.enrich_two_key(li, part, ("Sample_Name", "name_key"), ("GT_QC_Sample_ID", "id_key"),
                                 "row_no", ["Domain1", "Species1"])


@register("enrich_two_key")
def enrich_two_key_q(spark, sf_dir):
    """J3 + W2: line items enriched by part -- by part key (parts of size <= 25), else by
    supplier key = part size (last part of that size wins), else 'NaN'."""
    return enriched_lines(spark, sf_dir)


@register("unmatched")
def unmatched_q(spark, sf_dir):
    """Rows with no match whose two keys are present."""
    from ..operators import enrich
    return enrich.unmatched_report(enriched_lines(spark, sf_dir), "Sample_Name", "GT_QC_Sample_ID").select(
        "l_orderkey", "l_linenumber", "Sample_Name", "GT_QC_Sample_ID")


@register("lanes_x_samples")
def lanes_x_samples_q(spark, sf_dir):
    """J5 + J6 + F1: project = region; samples = suppliers (with their nation's region); lanes =
    the nations of the region. Every sample repeated per lane; each region holds a fifth of the
    suppliers, so every region is a hot key and is split over the shuffle partitions."""
    from ..operators import enrich
    n = read_table(spark, sf_dir, "nation")
    s = read_table(spark, sf_dir, "supplier")
    samples = s.join(n.select("n_nationkey", "n_regionkey"), s["s_nationkey"] == n["n_nationkey"], "inner").select(
        F.col("n_regionkey").alias("Project_ID"), "s_suppkey", "s_name")
    lanes = n.select(F.col("n_regionkey").alias("Project_ID"), F.col("n_nationkey").alias("Lane"),
                     F.col("n_name").alias("Lane_Name"))
    return enrich.lanes_x_samples(samples, lanes, ["Project_ID"], salt_from=["s_suppkey"])


# ------------------------------------------------------------------ scalar functions
@register("percent_two_decimals")
def percent_two_decimals(spark, sf_dir):
    """Fraction -> percent text with two decimals."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", clean.fraction_to_percent("l_discount").alias("discount_pct"))


@register("path_parts")
def path_parts(spark, sf_dir):
    """C5 + C6 + C7 over page urls."""
    p = read_table(spark, sf_dir, "pages")
    u = F.col("url")
    return p.select("page_id",
                    clean.delivery_folder(u).alias("delivery_folder"),
                    clean.delivery_folder(u, "PacBio").alias("delivery_folder_pacbio"),
                    clean.parent_dir(u).alias("parent_dir"), clean.base_name(u).alias("base_name"),
                    clean.last_token(u, "_").alias("last_token"), clean.first_token(u, ".").alias("first_token"))


@register("sanitize_header")
def sanitize_header_q(spark, sf_dir):
    """C1-C3 on each page title, and C1 over the whole page text (digest + length)."""
    p = read_table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    whole = clean.sanitize_header("html")
    return p.select("page_id", clean.sanitize_header(title).alias("title_sanitized"),
                    clean.clean_column_name(title).alias("title_clean"),
                    clean.pacbio_header(title).alias("title_pacbio"),
                    F.md5(whole).alias("html_sanitized_md5"), F.length(whole).cast("bigint").alias("html_sanitized_len"))


@register("species_names")
def species_names(spark, sf_dir):
    """C8 on a species field built from each document, and over the whole text (digest)."""
    d = read_table(spark, sf_dir, "documents")
    sp = F.concat(F.when(F.col("lang") == "en", "human").when(F.col("lang") == "de", "Human")
                   .when(F.col("lang") == "fr", "homo sapiens").otherwise("marmoset"), F.lit(" "), F.col("source"))
    return d.select("doc_id", clean.normalize_species(sp).alias("Species"),
                    F.md5(clean.normalize_species("text")).alias("text_md5"))


@register("strip_commas")
def strip_commas(spark, sf_dir):
    """C4: a CSV line with a quoted thousands-separated number and a quoted text cell."""
    c = read_table(spark, sf_dir, "customer")
    line = F.concat(F.lit('"'), F.format_number("c_acctbal", 2), F.lit('",'), F.col("c_name"),
                    F.lit(',"'), F.col("c_mktsegment"), F.lit(', x"'))
    return c.select("c_custkey", line.alias("raw"), clean.strip_inner_commas_line(line).alias("cleaned"))


@register("lists")
def lists(spark, sf_dir):
    """C11 + C16 + S15 over whole documents: distinct trimmed non-blank items of a comma list
    (sentences split at '.'), and the collapsed text digest."""
    d = read_table(spark, sf_dir, "documents")
    items = clean.split_list(F.regexp_replace("text", r"[.;]", ","))
    return d.select("doc_id", F.size(items).cast("bigint").alias("n_items"),
                    F.md5(F.array_join(F.array_sort(items), "|")).alias("items_md5"),
                    F.md5(clean.collapse_spaces("text")).alias("collapsed_md5"))


@register("missing_values")
def missing_values(spark, sf_dir):
    """F5-F9 + X1: event values written as text with missing spellings by event type."""
    e = read_table(spark, sf_dir, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit("NaN"))
            .when(F.col("event_type") == "view", F.lit(" n.a. "))
            .when(F.col("value") < 1, F.lit(""))
            .when(F.col("event_type") == "signup", F.lit("NULL"))
            .when(F.col("event_type") == "click", F.lit("n.a"))
            .otherwise(F.format_string("%.2f", F.col("value"))))
    cells = F.split(F.concat_ws(",", F.col("event_type"), raw), ",", -1)
    return e.select("event_id", raw.alias("raw"), clean.is_missing(raw).alias("is_missing"),
                    clean.value_is_dropped(raw).alias("dropped"), clean.nullify_missing(raw).alias("nullified"),
                    clean.coalesce_missing(raw).alias("coalesced"),
                    F.size(clean.pad_array(cells, 4)).cast("bigint").alias("padded_width"))


@register("json_lookup")
def json_lookup(spark, sf_dir):
    """Q1-Q5 + S10 on event props and on settings-like JSON built from each event."""
    e = read_table(spark, sf_dir, "events")
    k = clean.json_value("props", "k")
    settings = F.concat(F.lit('{"application": "'), F.col("event_type"), F.lit('", "run": {"path": "/runs/'),
                        F.col("user_id").cast("string"), F.lit('"}, "path": "/top", "organism": ["'),
                        F.initcap("event_type"), F.lit('", "x"]}'))
    attrs = F.concat(F.lit('{"attributes": [{"id": "raw_data_report.nreads", "value": "'), k,
                     F.lit('"}, {"id": "ccs2.percent_ccs_bases_q30", "value": "0.'), k,
                     F.lit('"}, {"value": "7"}]}'))
    from ..sources.reports import attribute_value, parse_attributes
    staged = e.select("event_id", k.alias("k"), settings.alias("settings"), clean.parse_json(settings).alias("v"),
                      parse_attributes(attrs).alias("attrs"))
    a = F.col("attrs")
    return staged.select("event_id", "k", clean.variant_value("v", "settings", "application").alias("application"),
                         clean.json_first_path("settings").alias("first_path"),
                         clean.variant_first_element("v", "organism").alias("organism"),
                         attribute_value(a, "raw_data_report.nreads", parsed=True).alias("Polymerase_Reads_raw"),
                         clean.fraction_to_percent(attribute_value(a, "ccs2.percent_ccs_bases_q30", parsed=True))
                         .alias("Q30_base_PCT_ccs_raw"),
                         attribute_value(a, "raw_data_report.nbases", parsed=True).alias("Polymerase_Read_Bases_raw"))


@register("proj_status")
def proj_status_q(spark, sf_dir):
    """Undelivered when the folder or the release date is missing."""
    e = read_table(spark, sf_dir, "events")
    folder = F.when(F.col("event_type") == "error", F.lit("NULL")).otherwise(F.col("user_id").cast("string"))
    date = F.when(F.col("value") > 40, F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", clean.proj_status(folder, date).alias("ProjStatus"))


def date_text(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "yyyy/MM/dd"))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyyMMdd"))
             .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
             .otherwise(F.lit("not a date")))
    return o.select("o_orderkey", "o_orderdate", text.alias("raw_date"))


@register("release_date")
def release_date_q(spark, sf_dir):
    """Free-form text to YYYY-MM-DD; empty and unparsable text is missing (ledger L-9)."""
    return date_text(spark, sf_dir).select("o_orderkey", "raw_date",
                                           clean.release_date_text("raw_date").alias("Release_Date"))


@register("age_filters")
def age_filters(spark, sf_dir):
    """D2-D4 + T8: whole days to the newest order, day stamp, and the retention flag."""
    o = read_table(spark, sf_dir, "orders")
    newest = o.select(F.max("o_orderdate")).scalar()   # scalar subquery, evaluated once
    j = o.withColumn("_newest", newest)
    return j.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day_stamp"),
                    clean.days_between(F.to_date("_newest"), F.to_date("o_orderdate")).cast("bigint").alias("days_old"),
                    (clean.days_between(F.to_date("_newest"), F.to_date("o_orderdate")) > 10).alias("expired"))


# ------------------------------------------------------------------ lines of whole texts
def doc_lines(spark, sf_dir) -> DataFrame:
    from ..operators import ordered
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ordered.number_lines(d, "text", ["doc_id"])


def text_arrays(spark, sf_dir) -> DataFrame:
    from ..operators import ordered
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", ordered.text_lines(F.col("text")).alias("lines"))


@register("header_marker_report")
def header_marker_report(spark, sf_dir):
    """S5 + W1: the header of each text is the first line holding the marker ('###'); the rows
    after it are data rows. Texts without the marker are failed (NULL header)."""
    from ..operators import ordered
    d = text_arrays(spark, sf_dir)
    at = ordered.first_line(F.col("lines"), lambda x: F.instr(x, "###") > 0)
    d = d.withColumn("header_line_no", F.when(at > 0, at))
    return d.select("doc_id", "header_line_no",
                    F.coalesce(F.size("lines") - F.col("header_line_no"), F.lit(0)).cast("bigint").alias("data_rows"),
                    F.md5(F.get("lines", (F.col("header_line_no") - 1).cast("int"))).alias("header_md5"))


@register("lane_block")
def lane_block(spark, sf_dir):
    """From the first line holding 'License' up to (not including) the first '###' line after it."""
    from ..operators import ordered
    d = text_arrays(spark, sf_dir).withColumn("b", ordered.lines_between_first(
        F.col("lines"), lambda x: F.instr(x, "License") > 0, lambda x: F.instr(x, "###") > 0))
    block = d.where("b.block is not null").select("doc_id", F.col("b.first").alias("first"), F.posexplode("b.block").alias("i", "line"))
    return block.select("doc_id", (F.col("first") + F.col("i")).alias("line_no"), F.md5("line").alias("line_md5"))


@register("line_after_marker")
def line_after_marker(spark, sf_dir):
    """W4 + S8: the line right after the first line holding '###' (per text)."""
    from ..operators import ordered
    d = text_arrays(spark, sf_dir).withColumn("at", ordered.first_line(F.col("lines"), lambda x: F.instr(x, "###") > 0))
    return d.where("at > 0 and at < size(lines)").select(
        "doc_id", (F.col("at") + 1).alias("line_no"), F.md5(F.get("lines", F.col("at").cast("int"))).alias("line_md5"))


@register("marker_block")
def marker_block(spark, sf_dir):
    """W5 + L3: lines after a line holding 'token' until a line holding '##' (start line and
    stop line excluded), over every text."""
    from ..operators import ordered
    lines = doc_lines(spark, sf_dir)
    block = ordered.block_lines(lines, ["doc_id"], "line_no", "line", "token", "##")
    return block.select("doc_id", "line_no", F.md5("line").alias("line_md5"))


# FIXED VALUES: extra triage rules for texts used as tool logs (stage, pattern).
TEXT_LOG_RULES = (
    ("run", "Released under"),
    ("run", "Licensed under"),
    ("run", 'token = "'),
    ("gather", "###"),
    ("package", "$$$"),
    ("gather", "%%%"),
)


# Lines as tools write them (test data of the log jobs).
TOOL_LINES = ("x Unrecognized platform by QiFa y", "Program aborted.", "ERROR: Please complete basic QC before proceeding",
              "Please complete basic QC before proceeding", "0 .gz file(s) found", "ERROR: loadQCParametersSetting organism",
              "loadQCParametersSetting organism", "!!!WARNING!!!", "ERROR: Could not locate output from QC pipeline",
              "Could not locate output from QC pipeline", "fine")


def doc_logs(spark, sf_dir, text=None) -> DataFrame:
    """Each text (or the given one) as a tool log named <project>_QCreport.<pipeline>[.<stage>].log."""
    from ..operators import triage
    d = read_table(spark, sf_dir, "documents")
    if text is not None:
        d = d.withColumn("text", text)
    stage = (F.when(F.col("n_chars") > 5000, F.lit(".gather")).when(F.col("n_chars") > 2000, F.lit(".package"))
              .otherwise(F.lit("")))
    path = F.concat(F.lit("/logs/"), F.col("source"), F.lit("/doc"), F.col("doc_id").cast("string"),
                    F.lit("_QCreport."), F.col("lang"), stage, F.lit(".log"))
    parts = triage.parse_log_path(F.col("path"))
    from ..operators import ordered
    lines = ordered.number_lines(d.select("doc_id", path.alias("path"), "text"), "text", ["path"])
    return lines.select(parts["project"].alias("project"), parts["pipeline"].alias("pipeline"),
                        parts["stage"].alias("stage"), "line_no", "line")


@register("log_triage")
def log_triage(spark, sf_dir):
    """L1 + S16: per log file, the first rule of its stage that any line holds. Every log has one
    line of a tool's output added; some of these lines miss a rule by their first word only."""
    from ..functions import fixed as fx
    from ..operators import triage
    logs = doc_logs(spark, sf_dir).select("project", "pipeline", "stage", "line")
    line = F.element_at(F.array(*[F.lit(x) for x in TOOL_LINES]),
                        (F.pmod("doc_id", F.lit(len(TOOL_LINES))) + 1).cast("int"))
    extra = doc_logs(spark, sf_dir, line).select("project", "pipeline", "stage", "line")
    return triage.classify_logs(logs.unionByName(extra), rules=fx.LOG_RULES + TEXT_LOG_RULES)


@register("first_error")
def first_error_q(spark, sf_dir):
    """L1: per project (source) the first failing log in trying order: basic, the main pipeline, others."""
    from ..operators import triage
    d = read_table(spark, sf_dir, "documents")
    pipeline = F.when(F.col("lang") == "en", "basic").when(F.col("lang") == "fr", "main").otherwise(F.col("lang"))
    stage = F.element_at(F.array(*[F.lit(x) for x in ("run", "package", "release", "gather")]),
                         (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    line = F.element_at(F.array(*[F.lit(x) for x in TOOL_LINES]),
                        (F.pmod("doc_id", F.lit(len(TOOL_LINES))) + 1).cast("int"))
    project = F.concat("source", F.lit("-"), F.pmod("n_chars", F.lit(50)).cast("string"))
    lines = d.select(project.alias("project"), pipeline.alias("pipeline"), stage.alias("stage"), line.alias("line"))
    return triage.first_error(triage.classify_logs(lines), main_pipeline="main")


@register("stage_status")
def stage_status_q(spark, sf_dir):
    """L2: status per (project, pipeline) from marker lines, markers checked in order."""
    from ..operators import triage
    markers = (("failed", "###"), ("incomplete", "$$$"), ("gathered", "License"))
    return triage.stage_status(doc_logs(spark, sf_dir), markers=markers)


@register("manifest_counts")
def manifest_counts_q(spark, sf_dir):
    """FASTQ file names derived from page urls; totals and Undetermined per read tag and overall."""
    from ..operators import triage
    p = read_table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    tag = (F.when(lang == "en", "R1_").when(lang == "fr", "R2_").when(lang == "de", "I1_")
            .when(lang == "es", "I2_").otherwise("R3_"))
    name = F.concat(F.when(F.instr("url", "?") > 0, F.lit("Undetermined_S0_")).otherwise(F.lit("S1_")), tag,
                    F.lit("001"), F.when(F.instr("url", "#") > 0, F.lit(".html")).otherwise(F.lit(".fastq.gz")))
    files = p.select(F.concat(F.lit("/deliver/"), F.col("page_id").cast("string"), F.lit("/"), name).alias("path"))
    return triage.manifest_counts(files)


@register("known_names")
def known_names_q(spark, sf_dir):
    """F15 + F16: a requested name list (padding, comments, blanks, repeats) against the catalog
    of document sources in first-appearance order."""
    from ..operators import triage
    d = read_table(spark, sf_dir, "documents")
    catalog = d.select(F.col("source").alias("name"), F.col("doc_id").alias("pos"))
    # FIXED VALUES: the requested list as typed by a user.
    requested_text = ("  src3 ", "# src4", "", "src1", "srcX", "src12", "src3", "#")
    req = spark.createDataFrame([(x,) for x in requested_text], "line string")
    return triage.known_names(triage.clean_name_list(req), catalog)


@register("route_application")
def route_application_q(spark, sf_dir):
    """each text is a project whose settings application comes from its language; routed
    to every pipeline that accepts that value (exact, case-sensitive)."""
    from ..operators import enrich
    d = read_table(spark, sf_dir, "documents")
    app = (F.when(F.col("lang") == "en", "mRNA").when(F.col("lang") == "de", "PDX-WGS")
            .when(F.col("lang") == "fr", "Other").otherwise("ATACSeq,ATAC"))
    projects = d.select("doc_id", app.alias("application"))
    return enrich.route_application(projects).select("doc_id", "application", "pipeline")


@register("instrument_rules")
def instrument_rules(spark, sf_dir):
    """Instrument id from the first matching substring rule of the platform, else the name."""
    p = read_table(spark, sf_dir, "part")
    # FIXED VALUES: instrument host names assigned to parts by size.
    hosts = ("m84148_240101", "m64119e_230101", "r64039_x", "SQ65039", "GXB02036", "PCA100115", "GXB03074",
             "P2S-01535", "GXB01025", "GXB01102", "GXB01186", "PC24B149", "PCT0053", "other-host", "")
    name = F.element_at(F.array(*[F.lit(h) for h in hosts]), (F.col("p_size") % len(hosts)) + 1)
    platform = F.when(F.col("p_size") <= 25, F.lit("PacBio")).otherwise(F.lit("ONT"))
    iid = F.when(platform == "PacBio", clean.instrument_id(name, "PacBio")).otherwise(clean.instrument_id(name, "ONT"))
    return p.select("p_partkey", name.alias("instrument_name"), platform.alias("platform"), iid.alias("InstrumentID"))


@register("select_drop_split")
def select_drop_split(spark, sf_dir):
    """F2 + F3 + F4 on part rows as report files (one file per brand, header/cells arrays), every
    row's cells: species-report columns kept by pattern, PacBio columns dropped, and the rest
    split into ids and values by the file's first row."""
    from ..functions import fixed as fx
    from ..operators import ordered
    p = read_table(spark, sf_dir, "part")
    header = F.array(*[F.lit(x) for x in ("GT_QC_Sample_ID", "Sample_Name", "Domain1", "Species2", "Sample_Well",
                                          "Lot", "Size", "Price")])
    cells = F.array(F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_brand"), F.col("p_type"),
                    F.lit("A1"), F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.lit("none")),
                    F.col("p_size").cast("string"), F.format_string("%.2f", F.col("p_retailprice")))
    rep = p.select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("row_no"), header.alias("header"),
                   cells.alias("cells"))
    first = rep.groupBy("file").agg(F.min_by("cells", F.col("row_no")).alias("first"))
    rep = rep.join(first, "file")
    split = shape.split_id_and_value_names(F.col("header"), F.col("first"), fx.PACBIO_DROPPED_COLUMNS)

    def text(names):
        at = F.transform(names, lambda n: F.element_at("cells", F.array_position("header", n).cast("int")))
        return F.concat(F.array_join(names, ","), F.lit("="), F.array_join(at, ","))

    return rep.select(
        "file", "row_no", text(shape.select_matching_names(F.col("header"), fx.SPECIES_ID_COLUMNS_RE)).alias("species_cells"),
        text(shape.drop_names(F.col("header"), fx.PACBIO_DROPPED_COLUMNS)).alias("kept_cells"),
        text(split["ids"]).alias("id_cells"), text(split["values"]).alias("value_cells"))


# ------------------------------------------------------------------ incremental scope
@register("scan_scope")
def scan_scope_q(spark, sf_dir):
    """T4: per application (event type): archive scan when the last one is 5+ days old, else
    active when the warehouse knows it and an earlier list exists, else all."""
    from ..operators import incremental
    e = read_table(spark, sf_dir, "events")
    apps = e.select(F.col("event_type").alias("application")).distinct()
    tracker = (e.filter(F.col("value") < 10).groupBy(F.col("event_type").alias("application"))
                .agg(F.to_date(F.max("ts")).alias("last_archive_scan")))
    present = e.filter(F.col("value") > 95).select(F.col("event_type").alias("application"))
    has_list = e.filter((F.col("value") >= 50) & (F.col("value") < 51)).select(F.col("event_type").alias("application"))
    run_date = F.to_date(e.select(F.max("ts")).scalar())
    return incremental.scan_scope(apps, tracker, present, has_list, run_date)


@register("new_projects")
def new_projects_q(spark, sf_dir):
    """Pages are found project folders; labels is the processed ledger (by id)."""
    from ..operators import incremental
    p = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("project_id"), "url")
    ledger = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("project_id"))
    return incremental.new_projects(p, ledger, ["project_id"])


@register("requeue")
def requeue_q(spark, sf_dir):
    """Recorded projects minus the failed ones (toxic = 1), which are tried again."""
    from ..operators import incremental
    lab = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("project_id"), "toxic")
    return incremental.requeue(lab.select("project_id"), lab.filter(F.col("toxic") == 1), ["project_id"])


@register("candidate_counts")
def candidate_counts_q(spark, sf_dir):
    """Folders found and eligible (not in the ledger) per application; skip when none."""
    p = read_table(spark, sf_dir, "pages")
    ledger = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.lit(True).alias("_done"))
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    cand = p.select("page_id", lang.alias("application")).join(ledger, "page_id", "left").select(
        "application", F.col("_done").isNull().alias("eligible"))
    apps = read_table(spark, sf_dir, "documents").select(F.col("lang").alias("application"))
    return marts.candidate_counts(cand, apps, "application", "eligible")


def doc_projects(spark, sf_dir) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


@register("validate_project")
def validate_project_q(spark, sf_dir):
    """first failed check in order: settings missing -> metadata incomplete -> report
    missing -> flowcell missing -> parse failed."""
    from ..operators import incremental
    d = doc_projects(spark, sf_dir)
    checks = [("settings missing", F.col("quality").isNull()),
              ("metadata incomplete", F.col("toxic") == 1),
              ("report missing", F.col("n_chars") < 200),
              ("flowcell missing", F.col("source").isin("src0", "src1")),
              ("parse failed", F.instr("text", "###") == 0)]
    return incremental.validate_project(d, checks).select("doc_id", "reason")


@register("failure_summary")
def failure_summary_q(spark, sf_dir):
    """Failed projects de-duplicated and counted per reason."""
    v = validate_project_q(spark, sf_dir).filter(F.col("reason").isNotNull())
    return marts.failure_summary(v.unionByName(v))


@register("delivery_gate")
def delivery_gate_q(spark, sf_dir):
    """ready when delivery folder and release date are present (no archive scope)."""
    from ..operators import incremental
    d = read_table(spark, sf_dir, "documents")
    proj = d.select("doc_id",
                    F.when(F.col("lang") == "es", F.lit("NULL")).otherwise(F.col("source")).alias("Investigator_Folder"),
                    F.when(F.col("n_chars") < 500, F.lit("")).otherwise(F.lit("2024-03-05")).alias("Release_Date"))
    return incremental.delivery_gate(proj).select("doc_id", "ready")


@register("width_check")
def width_check_q(spark, sf_dir):
    """a text whose first line has fewer than 14 space-separated fields is rejected."""
    from ..operators import incremental
    d = read_table(spark, sf_dir, "documents")
    first = d.select("doc_id", F.split(F.element_at(F.split("text", "\n", -1), 1), " ", -1).alias("cells"))
    return incremental.width_check(first, "cells").select("doc_id", F.size("cells").cast("bigint").alias("width"),
                                                          "rejected")


# ------------------------------------------------------------------ registry
@register("registry_ops")
def registry_ops(spark, sf_dir):
    """U3 + U4 + U5 + A7: groups = conversation roles; users = one address per conversation, in
    first-seen order; users of short turns are then removed (groups stay)."""
    from ..operators import registry
    c = read_table(spark, sf_dir, "conversations")
    user = F.concat(F.lit("u"), F.col("conv_id").cast("string"), F.lit("@lab.org"))
    reg = spark.createDataFrame([], registry.REGISTRY_SCHEMA)
    reg = registry.register_groups(reg, registry.distinct_groups(c, "role"))
    adds = c.select(F.col("role").alias("grp"), user.alias("user"),
                    (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"))
    reg = registry.add_users(reg, adds)
    rm = c.filter(F.length("text") < 100).select(F.col("role").alias("grp"), user.alias("user"))
    return registry.remove_users(reg, rm)


# ------------------------------------------------------------------ streams
def _events_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                 .option("pathGlobFilter", "events.parquet").parquet(sf_dir))


@register("stream_append")
def stream_append(spark, sf_dir):
    """T3 + M1: the events file as a stream (read twice, so every row arrives twice) appended to
    a table that already holds the low-value events; rows already stored are never re-added."""
    from ..streaming import jobs
    root = jobs.scratch_dir(spark, "stream_append")
    table = f"{root}/table"
    cols = ["event_id", "user_id", "event_type"]
    seed = read_table(spark, sf_dir, "events").filter(F.col("value") < 10).select(*cols)
    seed.write.mode("overwrite").parquet(table)
    s = _events_stream(spark, sf_dir).select(*cols)
    q = jobs.dedupe_stream(s.unionByName(s), table, cols, f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(table)


@register("stream_groups")
def stream_groups(spark, sf_dir):
    """T1 + A7 + U3: event types arriving on a file stream are registered as groups."""
    from ..streaming import jobs
    root = jobs.scratch_dir(spark, "stream_groups")
    s = _events_stream(spark, sf_dir).select(F.col("event_type").alias("Investigator_Folder"))
    q = jobs.watch_groups(s, f"{root}/registry", f"{root}/checkpoint", parse=lambda b: b)
    q.awaitTermination()
    return jobs.current_registry(spark, f"{root}/registry")


# ------------------------------------------------------------------ S12 typed CSV round trip
def sequencing_lines(spark, sf_dir) -> DataFrame:
    """Sequencing-metrics CSV text written from line items: short rows (line 7), rows with a
    word in a number (line 6 of 'N' items) and rows with an extra field (line 5 of 'R' items, and
    line 5 of 'A' items, whose last declared field is empty)."""
    from ..functions import fixed as fx
    li = read_table(spark, sf_dir, "lineitem")
    reads = F.when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "N"), F.lit("abc")).otherwise(
        F.floor("l_quantity").cast("string"))
    fields = [F.month("l_shipdate").cast("string"), F.year("l_shipdate").cast("string"),
              F.concat(F.lit("P"), F.col("l_orderkey").cast("string")), F.col("l_returnflag"), F.col("l_linestatus"),
              F.concat(F.lit("run"), F.col("l_linenumber").cast("string")),
              F.concat(F.lit("g"), F.col("l_suppkey").cast("string")), F.lit("wgs"),
              F.concat(F.lit("/data/"), F.col("l_orderkey").cast("string")), F.lit("NovaSeq"), reads,
              F.floor("l_extendedprice").cast("string"), F.col("l_partkey").cast("string"),
              F.concat(F.lit("/deliver/"), F.col("l_orderkey").cast("string")), F.col("l_linenumber").cast("string")]
    last = F.col("l_discount").cast("string")
    body = F.concat_ws(",", *fields)
    line = (F.when(F.col("l_linenumber") == 7, body)
             .when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "R"), F.concat_ws(",", body, last, F.lit("x")))
             .when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "A"), F.concat(body, F.lit(",,x")))
             .otherwise(F.concat_ws(",", body, last)))
    header = spark.createDataFrame([(",".join(n for n, _ in fx.SEQUENCING_SCHEMA),)], "line string")
    return header.unionByName(li.select(line.alias("line")))


@register("typed_csv")
def typed_csv(spark, sf_dir):
    """S12 + M1 (+ K1): CSV written to the shared scratch folder, read back all-text, short rows
    padded, bad rows left out, typed with try_cast, then appended twice with a null-safe key."""
    from ..functions import fixed as fx
    from ..sources.delimited import read_typed_csv
    from ..streaming.jobs import scratch_dir
    root = scratch_dir(spark, "typed_csv")
    sequencing_lines(spark, sf_dir).write.mode("overwrite").text(f"{root}/csv")
    typed = read_typed_csv(spark, f"{root}/csv", fx.SEQUENCING_SCHEMA, header=False, drop_header_lines=True)
    key = [n for n, _ in fx.SEQUENCING_SCHEMA]
    typed = dealt(cut_lineage(typed), key)   # parsed once into the shared checkpoint folder, read by both appends
    stored = merge.append_if_absent(typed.limit(0), typed, key)
    return merge.append_if_absent(stored, typed, key)


# ------------------------------------------------------------------ K5 / S11 round trips
@register("clustered_write")
def clustered_write(spark, sf_dir):
    """K5 + K1: long rows written partitioned by Application and range-sorted for file
    skipping, then read back with a partition filter (pruned to one application folder)."""
    from ..operators import sinks
    from ..streaming.jobs import scratch_dir
    long = lineitem_long(spark, sf_dir).select(
        F.col("l_returnflag").alias("Application"), F.col("l_linestatus").alias("Release_Date"),
        F.col("l_orderkey").cast("string").alias("Investigator_Folder"),
        F.col("l_linenumber").cast("string").alias("Project_ID"), F.lit("run").alias("Project_run_type"),
        "name", "value")
    path = f"{scratch_dir(spark, 'clustered')}/table"
    sinks.write_clustered(long, path, mode="overwrite")
    back = spark.read.parquet(path)
    return back.filter(F.col("Application") != "A")


@register("sniffed")
def sniffed(spark, sf_dir):
    """S11 + A7: customers written as metrics files -- tab-separated for BUILDING customers,
    comma-separated otherwise, every file with its header line -- then read back, each file's
    delimiter and column position found from its own header line."""
    from ..operators import registry
    from ..sources import delimited
    from ..streaming.jobs import scratch_dir
    c = read_table(spark, sf_dir, "customer")
    tab = F.col("c_mktsegment") == "BUILDING"
    sep = F.when(tab, F.lit("\t")).otherwise(F.lit(","))
    spread = 8   # a segment is written by up to 8 tasks; each (segment, slot) gets its header line
    # every third name is quoted and holds the file's own delimiter
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"'), F.col("c_name"), sep, F.lit(' Jr"'))).otherwise(F.col("c_name"))
    rows = c.select("c_mktsegment", F.pmod(F.xxhash64("c_custkey"), F.lit(spread)).alias("_slot"),
                    F.lit(1).alias("_o"),
                    F.concat_ws("", name, sep, F.concat(F.lit(" grp"), F.col("c_nationkey").cast("string"),
                                                                    F.lit(" ")), sep, F.lit("x")).alias("line"))
    header = (c.select("c_mktsegment").distinct()
               .withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))))
               .select("c_mktsegment", "_slot", F.lit(0).alias("_o"),
                       F.concat_ws("", F.lit("Name"), sep, F.lit("Investigator_Folder"), sep, F.lit("Other")).alias("line")))
    root = f"{scratch_dir(spark, 'sniffed')}/in"
    (header.unionByName(rows).repartition("c_mktsegment", "_slot").sortWithinPartitions("_o")
           .drop("_o", "_slot").write.partitionBy("c_mktsegment").text(root))
    lines = delimited.read_metric_files(spark, root, glob="part-*")
    vals = delimited.column_values_sniffed(lines, "Investigator_Folder").withColumnRenamed("value", "Investigator_Folder")
    return registry.distinct_groups(vals)


@register("clean_column_name")
def clean_column_name_q(spark, sf_dir):
    """C2 (+ C1 first, as a header passes both before a schema-evolving insert) on every
    distinct word of the whole pages."""
    p = read_table(spark, sf_dir, "pages")
    words = p.select(F.explode(F.split("html", " ", -1)).alias("word")).filter(F.col("word") != "").distinct()
    by_word = words.select("word", clean.clean_column_name("word").alias("cleaned"),
                           clean.clean_column_name(clean.sanitize_header("word")).alias("sanitized_cleaned"))
    return by_word
