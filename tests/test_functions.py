"""Scalar functions on literal inputs."""
import pytest
from pyspark.sql import functions as F

from metricyard.functions import clean


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("raw,want", [
    ("%>=Q30", "PCT_GE_Q30"), ("a <= b", "a_LE_b"), ("Yield (Gb):", "Yield_(Gb)"), ("x  >  y_", "x_GT_y"),
    ("Mean  QV", "Mean_QV"), ("<5%", "_LT_5PCT"), ("Movie_Time__hours_", "Movie_Time_hours")])
def test_sanitize_header(spark, raw, want):
    assert one(spark, clean.sanitize_header, raw) == want
    assert clean.sanitize_header_py(raw) == want


@pytest.mark.parametrize("raw,want", [("Nation Key(n)", "Nation_Key_n"), ("a___b", "a__b"), ("x.y", "x_y")])
def test_clean_column_name(spark, raw, want):
    assert one(spark, clean.clean_column_name, raw) == want
    assert clean.clean_column_name_py(raw) == want


@pytest.mark.parametrize("raw,app,want", [
    ("/x/labA/p1/", None, "labA"), ("labA", None, "labA"), ("/labA/", None, "labA"), ("", None, None),
    ("/d/labP/sub/projF/", "PacBio", "labP"), ("a/b", "PacBio", None),          # L-8: too few parts
    ("a/b", None, "a")])
def test_delivery_folder(spark, raw, app, want):
    assert one(spark, lambda c: clean.delivery_folder(c, app), raw) == want


@pytest.mark.parametrize("raw,want", [
    ("2024-03-05", "2024-03-05"), ("2024/03/05", "2024-03-05"), ("20240305", "2024-03-05"),
    ("03/05/2024", "2024-03-05"), ("", None), ("  ", None), ("soon", None), (None, None)])
def test_release_date(spark, raw, want):
    assert one(spark, clean.release_date_text, raw) == want   # L-9: empty is missing, not today


def test_missing_predicates(spark):
    vals = ["", "NULL", "NaN", "n.a.", "n.a", " n.a. ", "1.5", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = df.select("v", clean.is_missing("v").alias("m"), clean.value_is_dropped("v").alias("d"),
                    clean.nullify_missing("v").alias("n")).collect()
    m = {r["v"]: (r["m"], r["d"], r["n"]) for r in got}
    assert m["NaN"] == (True, True, None) and m["n.a"] == (False, False, None)
    assert m[" n.a. "] == (True, True, " n.a. ") and m["1.5"] == (False, False, "1.5")
    assert m[""][0] and m[""][1] and m["NULL"][2] == "NULL"


def test_proj_status_and_percent(spark):
    df = spark.createDataFrame([("labA", "2024-01-01"), ("NULL", "2024-01-01"), ("labA", None)], "f string, d string")
    assert [r[0] for r in df.select(clean.proj_status("f", "d")).collect()] == ["Delivered", "Undelivered", "Undelivered"]
    assert one(spark, clean.fraction_to_percent, "0.9512") == "95.12"
    assert one(spark, clean.fraction_to_percent, "n.a.") is None


def test_json_lookup_fallback(spark):
    broken = '{"projectId": "p9", "deliveryFolder": "/a/b/", oops'
    assert one(spark, lambda c: clean.json_value(c, "projectId"), broken) == "p9"
    ok = '{"projectId": null, "x": {"path": "/p/1"}, "path": "/p/2", "organism": ["Homo sapiens"]}'
    assert one(spark, lambda c: clean.json_value(c, "projectId"), ok) is None
    assert one(spark, clean.json_first_path, ok) == "/p/1"
    assert one(spark, lambda c: clean.json_first_element(c, "organism"), ok) == "Homo sapiens"


def test_text_helpers(spark):
    assert one(spark, clean.strip_inner_commas_line, 's1,"1,234",x') == "s1,1234,x"
    assert one(spark, clean.normalize_species, "human; Human; homo sapiens; marmoset") == \
        "Homo sapiens; Homo sapiens; Homo sapiens; Callithrix jacchus"
    assert one(spark, clean.parent_dir, "/a/b/c.txt") == "/a/b"
    assert one(spark, clean.base_name, "/a/b/c.txt") == "c.txt"
    assert one(spark, lambda c: clean.last_token(c, "_"), "run_x_HXYZ") == "HXYZ"
    assert one(spark, lambda c: clean.extract_after(c, "INFO: Release path ="), "INFO: Release path = /r/p ") == "/r/p"
    assert one(spark, lambda c: F.array_join(clean.split_list(c), "|"), " a, b,,a ,c") == "a|b|c"
    assert one(spark, lambda c: clean.instrument_id(c, "ONT"), "host-GXB02036") == "CT_GridIONX5_GXB02036"
    assert one(spark, lambda c: clean.instrument_id(c, "PacBio"), "m64119e") == "CT_Sequel_SQ65119"
    assert one(spark, lambda c: clean.instrument_id(c, "PacBio"), "") is None
    assert one(spark, lambda c: clean.is_numeric(clean.percent_value(c), "sci"), "-1.5e3%") is True
