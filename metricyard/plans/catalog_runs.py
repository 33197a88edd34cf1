"""Registered jobs over the readers and sinks that runs use: files are written from the given
tables into the shared scratch folder and read back by the library's own readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import enrich, incremental, marts, merge, registry, shape, sinks, triage
from ..operators.appindex import AppIndex
from ..operators.keyindex import KeyIndex
from ..operators.numbering import numbered
from ..operators.quarantine import REJECTS, quarantine
from ..operators.status import StatusOverlay
from ..session import cut_lineage
from ..sources import delimited, files, reports
from ..sources.listing import changed_files, list_tree
from ..sources.tables import read_evolving, read_table, read_version, write_version
from ..streaming.jobs import scratch_dir
from .catalog import register, sample_list, sequencing_lines, status_table


@register("long_csv")
def long_csv(spark, sf_dir):
    """Line items as a headerless long CSV of several files, bound by position, all text."""
    li = read_table(spark, sf_dir, "lineitem")
    path = scratch_dir(spark, "long_csv")
    li.select("l_orderkey", "l_linenumber", F.lit("l_quantity").alias("name"),
              F.format_string("%.2f", F.col("l_quantity").cast("double")).alias("value")).write.option("header", False).csv(path)
    return delimited.read_long_csv(spark, path, ["l_orderkey", "l_linenumber", "name", "value"])


@register("value_list")
def value_list(spark, sf_dir):
    """Customer names in files (padded, repeated, with blank lines) and an inline list."""
    c = read_table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "value_list")
    line = F.when(F.col("c_custkey") % 7 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    c.select(line.alias("line")).unionAll(c.select(F.col("c_name"))).write.text(path)
    return delimited.read_value_list(spark, " a@x , ,b@x,a@x", path)


@register("resolve_candidate")
def resolve_candidate_q(spark, sf_dir):
    """Per order the first of an ordered list of candidate files, ties to the smallest path."""
    li = read_table(spark, sf_dir, "lineitem")
    name = F.element_at(F.array(*[F.lit(x) for x in ("Run_Metric_Summary.draft.csv", "Run_Metric_Summary.csv", "notes.txt")]),
                        (F.col("l_suppkey") % 3 + 1).cast("int"))
    listing = li.select(F.col("l_orderkey").alias("project"), F.concat(F.col("l_partkey").cast("string"), F.lit("/"), name).alias("path"))
    base = clean.base_name(F.col("path"))
    rank = F.when(base == "Run_Metric_Summary.draft.csv", 1).when(base == "Run_Metric_Summary.csv", 2)
    return files.resolve_candidate(listing, "project", rank)


@register("required_inputs_missing")
def required_inputs_q(spark, sf_dir):
    """L4: orders as projects; their visible files by line, settings for some, no file at all for others."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("project_dir"))
    li = read_table(spark, sf_dir, "lineitem").where("l_orderkey % 5 > 0")
    path = F.concat(F.lit("/q/"), F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") == 1, F.lit("/a.csv"))
                    .when(F.col("l_linenumber") == 2, F.lit("/fastqs/s.fastq.gz")).otherwise(F.lit("/Stats.json.unprocessed")))
    listing = li.select(F.col("l_orderkey").alias("project_dir"), path.alias("path"))
    settings = o.select("project_dir", F.when(F.col("project_dir") % 3 > 0, F.lit("{}")).alias("json"))
    out = triage.required_inputs_missing(o, listing, settings)
    return out.select("project_dir", F.array_join("missing", ",").alias("missing"))


@register("retention")
def retention_q(spark, sf_dir):
    """Order days as snapshot days, expired after the retention counted from the newest."""
    o = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return incremental.retention(o, "day", today="1998-08-01")


@register("reset_due")
def reset_due_q(spark, sf_dir):
    """T5: event types as applications, last reset on the day of their newest small event."""
    e = read_table(spark, sf_dir, "events")
    tracker = e.groupBy(F.col("event_type").alias("application")).agg(
        F.to_date(F.max(F.when(F.col("value") < 20, F.col("ts")))).alias("last_reset"))
    return incremental.reset_due(tracker, F.to_date(e.select(F.max("ts")).scalar())).select("application", "reset")


@register("registry_export")
def registry_export_q(spark, sf_dir):
    """K8: market segments as groups with their first customers in order, exported and read back."""
    c = read_table(spark, sf_dir, "customer")
    adds = c.select(F.col("c_mktsegment").alias("grp"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("user"),
                    F.col("c_custkey").alias("pos"))
    reg = registry.add_users(spark.createDataFrame([], registry.REGISTRY_SCHEMA), adds)
    path = scratch_dir(spark, "registry")
    sinks.registry_export(reg, path)
    return spark.read.schema("grp string, users_text string").json(path)


@register("append_ledger")
def append_ledger_q(spark, sf_dir):
    """K7 + T7: shipped orders recorded, then all orders appended: each order once."""
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("project_dir"), "l_linenumber")
    path = scratch_dir(spark, "ledger")
    li.where("l_linenumber > 2").select("project_dir").distinct().write.parquet(path)
    sinks.append_ledger(spark.read.parquet(path), li.select("project_dir"), path)
    return spark.read.parquet(path)


@register("unchanged")
def unchanged(spark, sf_dir):
    """M7: events as files by type; the files of the next day differ for types with large values."""
    e = read_table(spark, sf_dir, "events").select("event_type", F.concat_ws(",", "event_id", "user_id").alias("line"), "value")
    root = scratch_dir(spark, "unchanged")
    e.drop("value").write.partitionBy("event_type").text(f"{root}/day1")
    more = e.where("event_type in ('click', 'view') and value > 99").select("event_type", F.concat("line", F.lit("!")).alias("line"))
    e.drop("value").unionByName(more).write.partitionBy("event_type").text(f"{root}/day2")

    def by_type(day):
        h = sinks.content_hash(spark, f"{root}/{day}").select(F.regexp_extract("path", "event_type=([^/]*)", 1).alias("path"), "sha256")
        return h.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("sha256")), "").alias("sha256"))

    return merge.changed_since(by_type("day2"), by_type("day1")).select("path")


@register("snapshot")
def snapshot_q(spark, sf_dir):
    """K2 + K6 + S14: a summary rebuilt twice, kept as snapshots of two days, and as table versions."""
    o = read_table(spark, sf_dir, "orders")
    root = scratch_dir(spark, "snapshot")
    for day, part in (("1998-01-01", o.where("o_orderkey % 2 = 0")), ("1998-01-02", o)):
        state = part.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
        sinks.replace_table(state, f"{root}/table")
        sinks.snapshot(state, f"{root}/days", day)
        write_version(state, f"{root}/versions")
    days = spark.read.parquet(f"{root}/days").select(F.col("snapshot_date").cast("string").alias("state"), "o_orderpriority", "n")
    now = spark.read.parquet(f"{root}/table").select(F.lit("table").alias("state"), "o_orderpriority", "n")
    newest = read_version(spark, f"{root}/versions", "o_orderpriority string, n bigint").select(
        F.lit("version").alias("state"), "o_orderpriority", "n")
    return days.unionByName(now).unionByName(newest)


@register("publish_gate")
def publish_gate(spark, sf_dir):
    """A3: the gate in its four cases: no snapshot, nothing new, only sequencing rows new, rows new."""
    o, li = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    old = o.where("o_orderkey % 2 = 0")
    cases = {"first": (None, o, None, li), "same": (o, o, li, li),
             "sequencing": (o, o, li.where("l_linenumber < 3"), li), "rows": (old, o, li, li)}
    out = None
    for name, (before, after, seq_before, seq_after) in cases.items():
        d = marts.publish_delta(before, after, "o_custkey", seq_before, seq_after).select(
            F.lit(name).alias("case_name"), "delta_rows", "delta_seq_rows", "publish")
        out = d if out is None else out.unionByName(d)
    return out


REPORT_KEYS = 25_000        # customer keys whose rows of one nation share a report file


def _report_texts(spark, sf_dir, keys=REPORT_KEYS):
    """Customers by nation and block of keys as report files: a preamble, a header, quoted cells and short rows."""
    c = read_table(spark, sf_dir, "customer")
    row = F.concat(F.lit("s"), F.col("c_custkey").cast("string"), F.lit(","), F.col("c_name"), F.lit(',"'),
                   (F.col("c_custkey") * 1000).cast("string"), F.lit(',x"'),
                   F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.lit(",9")))
    body = c.groupBy("c_nationkey", F.floor(F.col("c_custkey") / keys).alias("block")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))).alias("rows"))
    return body.select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit("/"), F.col("block").cast("string")).alias("path"),
        F.concat(F.lit("made by a tool\n\nGT_QC_Sample_ID,Sample_Name,Reads,Q\n"),
                 F.array_join(F.transform("rows", lambda r: r["row"]), "\n"), F.lit("\n")).alias("text"))


@register("report_rows")
def report_rows_q(spark, sf_dir):
    """S5 + F5 + C4: rows under the header of preamble reports, by column name; ``path`` is the nation's folder."""
    rep = reports.report_rows(_report_texts(spark, sf_dir), ["GT_QC_Sample_ID"])
    h, c = F.col("header"), clean.pad_array(F.col("cells"), F.size("header"))
    return rep.select(F.substring_index("path", "/", 1).alias("path"), reports.cell(h, c, "GT_QC_Sample_ID").alias("sample"),
                      clean.strip_inner_commas(reports.cell(h, c, "Reads")).alias("reads"), reports.cell(h, c, "Q").alias("q"))


@register("run_identity")
def run_identity_q(spark, sf_dir):
    """S8 + S9: machine and flowcell from run summaries made of suppliers; TBD flowcells are missing."""
    s = read_table(spark, sf_dir, "supplier")
    flow = F.when(F.col("s_suppkey") % 3 == 0, F.lit("!!!TBD!!!")).otherwise(F.concat(F.lit("FC"), F.col("s_suppkey").cast("string")))
    text = F.concat(F.lit("Run Summary\nFlowCellID,Date, MachineID \n"), flow, F.lit(",2024,M"), F.col("s_nationkey").cast("string"),
                    F.lit("\nFC9,2024,M9\n"))
    return reports.run_identity(s.select(F.col("s_suppkey").alias("path"), text.alias("text")))


@register("project_listing")
def project_listing(spark, sf_dir):
    """S1 + S3: customers written as folders by nation and segment; the tree is listed by tasks, and the folders of
    one name are found with the number of files in each."""
    root = scratch_dir(spark, "listing")
    c = read_table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", F.col("c_custkey").cast("string").alias("value"))
    c.repartition("c_nationkey", "c_mktsegment").write.partitionBy("c_nationkey", "c_mktsegment").text(f"{root}/c_mktsegment=BUILDING")
    tree = cut_lineage(list_tree(spark, [root]))
    projects = files.list_projects(tree, "c_mktsegment=BUILDING")
    held = files.find_reports(files.only_files(tree), ".txt").withColumn("report", F.lit(True))
    out = projects.join(held, "project_dir", "left").select(
        F.substring(F.col("project_dir"), F.length(F.lit(root)) + 2, 1 << 20).alias("folder"), F.coalesce("report", F.lit(False)).alias("report"))
    return out


@register("digest_append")
def digest_append(spark, sf_dir):
    """M3 + O7 by row digests: suppliers are stored, then customers and the suppliers again, twice; each run
    appends files, with its own columns, and the table is read with the union of all schemas."""
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    path = f"{scratch_dir(spark, 'digest_append')}/table"
    index = KeyIndex(spark, path).ensure()
    for batch in (s, c.unionByName(s, allowMissingColumns=True), c):
        index.append(cut_lineage(batch))
    return read_evolving(spark, path, "name string").select("name", "nationkey", "acctbal", "segment")


@register("stream_changed")
def stream_changed(spark, sf_dir):
    """T2's source: customers as folders by nation, the even nations first; the stream of changed files is read, the
    odd ones are written and one even one again, and the stream goes on where it stopped. Files come once, the edited ones twice."""
    root = scratch_dir(spark, "changed")
    c = read_table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_custkey").cast("string").alias("value"))

    def write(which, mode):
        c.filter(which).repartition("c_nationkey").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
            "c_nationkey").text(f"{root}/in")

    def take():
        seen = changed_files(spark, [f"{root}/in"], "*.txt", settle=0).select("path")
        q = seen.writeStream.foreachBatch(lambda b, _: b.write.mode("append").parquet(f"{root}/seen")).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()

    write("c_nationkey % 2 = 0", "append")
    take()
    write("c_nationkey % 2 = 1 OR c_nationkey = 4", "overwrite")
    take()
    nation = F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int")
    return spark.read.schema("path string").parquet(f"{root}/seen").groupBy(nation.alias("c_nationkey")).agg(F.count("*").alias("times"))


@register("app_index_increments")
def app_index_increments(spark, sf_dir):
    """A1 by increments: orders as rows of an application (priority) and folder (status) with customers as samples,
    some missing, taken in three overlapping batches; the index comes from bitmaps alone."""
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Application"), F.col("o_orderstatus").alias("Investigator_Folder"),
        F.when(F.col("o_custkey") % 11 > 0, F.col("o_custkey")).alias("Sample_Name"), "o_orderkey")
    state = AppIndex(spark, f"{scratch_dir(spark, 'app_index')}/state")
    for batch in (o.filter("o_orderkey % 3 = 0"), o.filter("o_orderkey % 3 < 2 AND Application < '4'"), o):
        state.add("orders", batch, "Sample_Name")
    return state.index()


@register("ordered_report")
def ordered_report(spark, sf_dir):
    """Every order with its place by customer and key, from ranges and their offsets."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return numbered(o, ["o_custkey", "o_orderkey"], col="place")


def _write_files(df):
    """Writes (path, text) rows as files with exactly these names, hidden ones among them, by tasks."""
    def work(batches):
        import os
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"]):
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "w", encoding="utf-8") as fh:
                    fh.write(text)
            yield pdf[["path"]]
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select("path", "text").repartition(spread, "path").mapInPandas(work, "path string").count()


@register("quarantine")
def quarantine_q(spark, sf_dir):
    """S12 + F10: the rows of the sequencing CSV that cannot be taken, counted by reason; a run writes them with an
    observed counter, which stands beside."""
    from ..functions import fixed as fx
    root = scratch_dir(spark, "quarantine")
    sequencing_lines(spark, sf_dir).write.text(f"{root}/csv")
    rows = cut_lineage(delimited.typed_csv_rows(spark, f"{root}/csv", fx.SEQUENCING_SCHEMA, header=False, drop_header_lines=True))
    bad = rows.filter("_reason IS NOT NULL").select(F.lit("csv").alias("source"), F.col("_reason").alias("reason"), F.col("_line").alias("line"))
    counted = quarantine(bad, f"{root}/rejected", "sequencing", "2024-01-01")
    return (spark.read.schema(REJECTS).parquet(f"{root}/rejected").groupBy("reason").agg(F.count("*").alias("rows"))
            .withColumn("observed", F.lit(counted).cast("bigint")))


@register("settings_files")
def settings_files(spark, sf_dir):
    """S2 + S4: a hidden settings file for two of three suppliers; read on executors, and the folders that their
    settings give to one application (case ignored)."""
    root = scratch_dir(spark, "settings")
    s = read_table(spark, sf_dir, "supplier").select(F.concat(F.lit(f"{root}/s"), F.col("s_suppkey").cast("string")).alias("project_dir"), "s_suppkey")
    app = F.when(F.col("s_suppkey") % 2 == 0, F.lit("pacbio")).otherwise(F.lit("ONT"))
    _write_files(s.filter("s_suppkey % 3 > 0").select(F.concat("project_dir", F.lit("/.settings.json")).alias("path"),
                                                      F.concat(F.lit('{"application": "'), app, F.lit('"}')).alias("text")))
    settings = cut_lineage(files.read_settings(s))
    named = files.settings_by_application(settings, "PacBio").select("project_dir").withColumn("named", F.lit(True))
    out = settings.withColumn("project_dir", F.concat("project_dir", F.lit("/PacBio"))).join(named, "project_dir", "left")
    return out.select(F.substring("project_dir", len(root) + 2, 1 << 20).alias("folder"), F.col("json").isNotNull().alias("has_settings"),
                      F.coalesce("named", F.lit(False)).alias("named"))


@register("log_files")
def log_files(spark, sf_dir):
    """S16 + L3: a log file for each customer and pipeline, read by name; the lines of its report block."""
    root = scratch_dir(spark, "logs")
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    pipe = F.when(F.col("c_custkey") % 2 == 0, F.lit("basic.package")).otherwise(F.lit("rnaseq"))
    text = F.concat_ws("\n", F.lit("start"), F.lit("Report @ x"), F.concat(F.lit("n "), F.col("c_nationkey").cast("string")), F.lit(""),
                       F.lit("Internal note"), F.concat(F.lit("k "), key), F.lit("##"), F.lit("after"))
    _write_files(c.select(F.concat(F.lit(f"{root}/p"), key, F.lit("_QCreport."), pipe, F.lit(".log")).alias("path"), text.alias("text")))
    lines = cut_lineage(files.read_logs(spark, root))         # the files are read once, the block's state passes over them thrice
    block = triage.report_block(lines, ["path", "project", "pipeline", "stage"])
    return block.select("project", "pipeline", "stage", "line")


@register("lane_block_reader")
def lane_block_reader(spark, sf_dir):
    """Run summaries of two lanes for each supplier, the columns in another order for odd ones."""
    s = read_table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    even = F.col("s_suppkey") % 2 == 0
    head = F.when(even, F.lit("Lane,Surface,Cluster PF,Reads,Reads PF,%>=Q30,Yield,Error,Aligned")).otherwise(
        F.lit("Lane,Surface,Aligned,Error,Yield,%>=Q30,Reads PF,Reads,Cluster PF"))
    lane = lambda n: F.when(even, F.concat_ws(",", F.lit(n), F.lit("-"), F.lit("95"), key, nation, F.lit("91"), F.lit("12"), F.lit("0.2"), F.lit("1.1"))).otherwise(
        F.concat_ws(",", F.lit(n), F.lit("-"), F.lit("1.1"), F.lit("0.2"), F.lit("12"), F.lit("91"), nation, key, F.lit("95")))
    text = F.concat_ws("\n", F.lit("Run Summary,,"), head, lane("1"), F.lit("1,1,9,9,9,9,9,9,9"), lane("2"), F.lit("Read 2 (I),,"), lane("3"))
    return reports.lane_block(s.select(F.col("s_suppkey").alias("path"), text.alias("text")))


@register("export_tsv")
def export_tsv(spark, sf_dir):
    """K3 + U2: one segment's customers exported as TSV with a header and read back as text."""
    path = f"{scratch_dir(spark, 'export')}/tsv"
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    sinks.export_csv(merge.status_scope(c, "c_mktsegment", "BUILDING"), path, sep="\t")
    return spark.read.option("header", True).option("sep", "\t").csv(path).select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@register("table_totals")
def table_totals_q(spark, sf_dir):
    """A2: rows and distinct samples of the orders."""
    return marts.table_totals(read_table(spark, sf_dir, "orders"), "o_custkey")


@register("add_metadata")
def add_metadata_q(spark, sf_dir):
    """customers with their nation's name in front and its region behind."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("project"), "c_custkey", "c_name")
    n = read_table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(
        F.col("n_nationkey").alias("project"), F.col("n_name").alias("Investigator_Folder"), F.col("n_regionkey").alias("region"))
    return enrich.add_metadata(c, n, ["project"], ["Investigator_Folder"], ["region"])


@register("explode_cells")
def explode_cells_q(spark, sf_dir):
    """Parts as rows of cells under one header, exploded from the second column on; every fifth row is short."""
    p = read_table(spark, sf_dir, "part")
    cells = F.array(F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_size").cast("string"))
    rows = p.select("p_partkey", F.array(F.lit("id"), F.lit("brand"), F.lit("size")).alias("header"),
                    F.when(F.col("p_partkey") % 5 == 0, F.slice(cells, 1, 2)).otherwise(cells).alias("cells"))
    return shape.explode_cells(rows, start=F.lit(2))


@register("scalar_rules")
def scalar_rules(spark, sf_dir):
    """C10, C11, C12, C14, D4 and Q2 on text made from orders."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    host = F.when(F.col("o_orderkey") % 3 == 0, F.lit('{"hostname": "", "host_product_serial_number": "S"}')).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit('{"hostname": "h'), key, F.lit('"}')))
    return o.select("o_orderkey", clean.extract_after(F.concat(F.lit("INFO: Release path = /r/"), key, F.lit(" ")), "INFO: Release path =").alias("after"),
                    clean.extract_after(key, "=").alias("no_label"), clean.percent_value(F.concat(key, F.lit("%%"))).alias("percent"),
                    clean.day_stamp("o_orderdate").alias("day"), clean.json_regex(host, "hostname").alias("hostname"),
                    enrich.instrument_name("ONT", F.lit("folder"), host).alias("instrument"),
                    clean.strip_quotes(F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"'))).alias("bare"))


@register("release_date_formats")
def release_date_formats(spark, sf_dir):
    """Order dates written in each of the known formats in turn, and in two that are none."""
    from ..functions import fixed as fx
    o = read_table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % (len(fx.RELEASE_DATE_FORMATS) + 2)
    text = F.when(kind == len(fx.RELEASE_DATE_FORMATS), F.lit("soon")).when(kind > len(fx.RELEASE_DATE_FORMATS), F.date_format("o_orderdate", "dd.MM.yy"))
    for i, fmt in enumerate(fx.RELEASE_DATE_FORMATS):
        text = text.when(kind == i, F.date_format("o_orderdate", fmt))
    raw = o.select("o_orderkey", text.alias("raw_date"))
    return raw.select("o_orderkey", "raw_date", clean.release_date_text("raw_date").alias("Release_Date"))


@register("status_overlay")
def status_overlay(spark, sf_dir):
    """U1, U2 as events: orders are stored in two batches (odd keys, then even ones) as a table by run type. After the first
    batch the listed samples' open urgent orders become 'U'; after the second, open orders of high priority. Those
    'U' of urgent orders become 'X', the events are folded in, and another update stays an event."""
    path, samples = f"{scratch_dir(spark, 'status_overlay')}/table", sample_list(spark, sf_dir)
    t = status_table(spark, sf_dir)
    overlay = StatusOverlay(spark, path)
    sinks.append_rows(t.filter("o_orderkey % 2 = 1"), path, ["Project_run_type"])
    overlay.update("1-URGENT", samples, "O", "U")
    sinks.append_rows(t.filter("o_orderkey % 2 = 0"), path, ["Project_run_type"])
    overlay.update("2-HIGH", None, "O", "U")
    overlay.update("1-URGENT", samples, "U", "X")
    overlay.fold(["Project_run_type"])
    overlay.update("3-MEDIUM", samples, "O", "U")
    return overlay.read().select("o_orderkey", "Sample_Name", "Project_run_type", "ProjStatus")
