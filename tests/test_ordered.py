"""Order-dependent operators against a plain Python scan (chunked carry, markers, first/last)."""
import random

from pyspark.sql import functions as F

from metricyard.operators import ordered


def brute_block(lines, start, stop):
    out, p = [], False
    for i, line in enumerate(lines, 1):
        if stop in line:
            p = False
        if p:
            out.append(i)
        if start in line:
            p = True
    return out


def test_block_lines_across_chunks(spark):
    rng = random.Random(7)
    docs = {}
    for d in range(6):
        docs[d] = [rng.choice(["x", "x", "x", "S start", "## stop", "S and ## both", "y"]) for _ in range(rng.randint(0, 40))]
    rows = [(d, i + 1, line) for d, ls in docs.items() for i, line in enumerate(ls)]
    df = spark.createDataFrame(rows, "doc int, line_no int, line string")
    for chunk in (1, 2, 3, 7, 65536):
        st = ordered.state_before(df, ["doc"], "line_no",
                                  F.when(F.instr("line", "S") > 0, F.lit(1)).when(F.instr("line", "##") > 0, F.lit(0)),
                                  chunk=chunk)
        got = {}
        for r in st.filter((F.col("state_before") == 1) & (F.instr("line", "##") == 0)).collect():
            got.setdefault(r["doc"], []).append(r["line_no"])
        for d, ls in docs.items():
            assert sorted(got.get(d, [])) == brute_block(ls, "S", "##"), (chunk, d)


def test_rows_between_and_after(spark):
    lines = ["pre", "Cluster PF head", "a", "b", "Read 2 (I)", "c", "Cluster PF again"]
    df = spark.createDataFrame([(1, i + 1, t) for i, t in enumerate(lines)], "f int, n int, line string")
    blk = ordered.rows_between_first(df, ["f"], "n", F.instr("line", "Cluster PF") > 0, F.instr("line", "Read 2 (I)") > 0)
    assert [r["line"] for r in blk.orderBy("n").collect()] == ["Cluster PF head", "a", "b"]
    nxt = ordered.rows_after_marker(df, ["f"], "n", F.instr("line", "Cluster PF") > 0)
    assert [r["line"] for r in nxt.collect()] == ["a"]
    first = ordered.first_by_group(df, ["f"], "n", F.col("line"), "v").collect()[0]["v"]
    last = ordered.last_by_group(df, ["f"], "n", F.col("line"), "v").collect()[0]["v"]
    assert (first, last) == ("pre", "Cluster PF again")
