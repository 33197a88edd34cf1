"""Enrichment joins (J3-J6, F1, F13, C9/C10 rule application).

Lookup sides are de-duplicated first ("last row wins" as ``max_by`` over the
row number -- a partial aggregation) so the probe side joins a key-unique
table: AQE turns the join into a broadcast when the measured lookup is small,
and otherwise splits a hot probe key without multiplying rows. Rule tables of
fixed literal size are broadcast directly (their size is bounded by the literals).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, fixed
from .joins import salted_left_join


def last_wins_lookup(lookup: DataFrame, key_col: str, order_col: str, payload: Sequence[str],
                     name: str = "match") -> DataFrame:
    """One row per key with the payload of the last row (largest ``order_col``); rows whose
    key is missing (F9) cannot be matched and are left out."""
    usable = lookup.filter(~clean.is_missing(F.col(key_col)))
    return usable.groupBy(F.col(key_col).alias("_key")).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(order_col)).alias(name))


def enrich_two_key(rows: DataFrame, lookup: DataFrame, name_key: tuple[str, str], id_key: tuple[str, str],
                   order_col: str, payload: Sequence[str], missing_value: str = "NaN") -> DataFrame:
    """Attach the payload matched by the name key, else by the id key, else ``missing_value``
    in every payload column. The choice is made on the matched *struct*, never field by field.

    ``name_key``/``id_key`` are (rows column, lookup column). Adds ``matched_by`` in
    {'name', 'id', None}.
    """
    by_name = last_wins_lookup(lookup, name_key[1], order_col, payload, "_m_name")
    by_id = last_wins_lookup(lookup, id_key[1], order_col, payload, "_m_id")
    j = (rows.join(by_name, rows[name_key[0]] == by_name["_key"], "left").drop("_key"))
    j = j.join(by_id, j[id_key[0]] == by_id["_key"], "left").drop("_key")
    chosen = F.coalesce(F.col("_m_name"), F.col("_m_id"))
    out = j.withColumn("_m", chosen).withColumn(
        "matched_by", F.when(F.col("_m_name").isNotNull(), F.lit("name")).when(F.col("_m_id").isNotNull(), F.lit("id")))
    for c in payload:
        out = out.withColumn(c, F.coalesce(F.col("_m")[c].cast("string"), F.lit(missing_value)))
    return out.drop("_m", "_m_name", "_m_id")


def unmatched_report(enriched: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Rows without a match whose both keys are present."""
    return enriched.filter(F.col("matched_by").isNull() & ~clean.is_missing(F.col(name_col))
                           & ~clean.is_missing(F.col(id_col)))


def lanes_x_samples(samples: DataFrame, lanes: DataFrame, project_cols: Sequence[str], salt: int | None = None,
                    salt_from: Sequence[str] | None = None, hot_share: float = 0.01) -> DataFrame:
    """Every sample row repeated for each lane of its project; projects without lanes keep
    one row with NULL lane fields. A project may hold a large share of all samples: such hot
    projects (over ``hot_share`` of the samples) are split ``salt`` ways and only their few
    lane rows are replicated."""
    return salted_left_join(samples, lanes, project_cols, salt, salt_from, hot_share)


def add_metadata(rows: DataFrame, meta: DataFrame, on: Sequence[str], before: Sequence[str],
                 after: Sequence[str] = (), how: str = "left") -> DataFrame:
    """project-level metadata joined on the project key; ``before`` columns first, the row's
    own columns next, ``after`` columns last (Spark broadcasts the one-row-per-project side if it is small)."""
    own = [c for c in rows.columns if c not in on and c not in before and c not in after]
    j = rows.join(meta, list(on), how)
    return j.select(*before, *own, *after)


def routing_table(spark: SparkSession) -> DataFrame:
    """§2.12 routing rules as a DataFrame (pipeline, application) -- fixed size."""
    rows = [(pipe, app) for pipe, apps in fixed.ROUTING for app in apps]
    return spark.createDataFrame(rows, "pipeline string, application string")


def route_application(projects: DataFrame, app_col: str = "application", pipelines: Sequence[str] | None = None) -> DataFrame:
    """keep (project, pipeline) pairs whose settings application is allowed for the
    pipeline; exact, case-sensitive membership (ledger L-28). One value may feed several
    pipelines. The rule table has a fixed, literal size and is broadcast."""
    rules = routing_table(projects.sparkSession)
    if pipelines is not None:
        rules = rules.filter(F.col("pipeline").isin(list(pipelines)))
    r = F.broadcast(rules.withColumnRenamed("application", "_rule_app"))
    return projects.join(r, projects[app_col] == r["_rule_app"], "inner").drop("_rule_app")


def instrument_name(platform: str, parent_folder, ont_json=None) -> "F.Column":
    """PacBio -> parent folder name; ONT -> hostname, else serial, else NULL when the
    instrument JSON exists, else the parent folder name."""
    parent = clean._c(parent_folder)
    if platform != "ONT" or ont_json is None:
        return F.nullif(parent, F.lit(""))
    j = clean._c(ont_json)
    host = F.nullif(clean.json_regex(j, "hostname"), F.lit(""))
    serial = F.nullif(clean.json_regex(j, "host_product_serial_number"), F.lit(""))
    return F.when(j.isNotNull(), F.coalesce(host, serial)).otherwise(F.nullif(parent, F.lit("")))
