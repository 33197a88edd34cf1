"""Training-data operators: edge cases with defined results, and brute-force versions."""
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metricyard.llm import chat, exact, html_text, induced, jaccard, mixing, packing, rules, spherical, suffix, unigram
from metricyard.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, h string, th int, size int"


def docs_frame(spark, rows):
    """Rows (doc_id, text[, source]) with extra columns whose names the operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, "x", 1, 2) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


EDGE = [(1, None), (2, ""), (3, "  \n"), (4, "a"), (5, "a"), (5, "a"), (None, "a"), (None, None), (6, "x" * 50_000),
        (7, "ab " * 20_000), (8, "Ünï cödé \U0001F600 text"), (9, "one two three"), (10, "one two three four five six")]


# ------------------------------------------------------------------ 1 chat
def test_chat_parts_placeholders_and_round_trip(spark):
    nasty = ["", "\\", "\\\\<turn x>", "</turn>\n\n</turn>\n", "<|image:1|> <turn user>", "a\n\nb", "\\### Assistant: </turn> ok"]
    rows, parts = [], "array<struct<kind:string,text:string,ref:string,units:double>>"
    for i, t in enumerate(nasty):
        rows.append((1, i, "assistant" if i % 2 else "us er>\n", [("text", t, None, None)]))
    rows += [(2, 0, "user", [("text", "see ", None, None), ("image", None, "a.png", 2.0), ("text", " and", None, None),
                             ("audio", None, "b.wav", 1.5), ("odd", "kept", None, None)]),
             (2, 1, "assistant", [("document", None, "c.pdf", None), ("text", "done", None, None)]),
             (3, None, None, None), (None, 0, "user", [None, ("text", None, None, None)])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(df)).collect()}
    assert [t["text"] for t in out[1]["turns"]] == nasty and out[1]["turns"][0]["role"] == "us er>\n"
    assert out[1]["loss_text"] == [t for i, t in enumerate(nasty) if i % 2]
    for s in out[1]["loss"]:                      # the offsets in the whole text agree with those in the turn
        piece = out[1]["formatted"][s["from_"]: s["to_"]]
        assert len(piece) == s["chars"]
    two = out[2]
    assert two["turns"][0]["text"] == "see <|image:1|> and<|audio:2|>kept" and two["turns"][1]["text"] == "<|document:3|>done"
    assert [(a["no"], a["turn_no"], a["ref"], a["n_tokens"]) for a in two["attachments"]] == [
        (1, 1, "a.png", 85 + 340), (2, 1, "b.wav", 2 + 50), (3, 2, "c.pdf", 4 + 600)]
    assert two["media_tokens"] == 425 + 52 + 604 and two["text_words"] == 4
    assert out[3]["turns"] == [("", "")] and out[None]["turns"][0]["text"] == ""
    assert chat.format_chat(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 2 html
def test_html_blocks():
    page = ('<html><head><title>T</title></head><body><header>Top</header><div class="site-nav">n</div><form>f</form>'
            '<article><header><h1>A &lt;b&gt; &amp; c</h1></header><p>One<br>two  <b>b</b><p>Three'
            '<div id="comments"><p>no</div><script>if(a<b){"</p>"}</script>tail</article><footer>&copy;</footer><a href="x')
    main = [t for k, t in html_text.page_blocks(page) if k == 2]
    assert main == ["A <b> & c", "One two b", "Three", "tail"]
    assert html_text.page_blocks(None) == [] and html_text.page_blocks("a < b <<>") == [(1, "a < b <<>")]
    assert html_text.page_blocks('<p title="a>b">q') == [(1, "q")]
    assert html_text.page_blocks("<!-- x") == [] and html_text.page_blocks("<p>x</div></p>y") == [(1, "x"), (1, "y")]


def test_tags_are_read_to_their_end():
    data = "x>y 'z' " * 5000
    assert html_text.page_blocks(f'<article data-json="{data}"><p>a</p></article>') == [(2, "a")]
    assert html_text.page_blocks(f'<div data-json="{data}" class="ad">no</div><p>b') == [(0, "no"), (1, "b")]
    assert html_text.page_blocks(f'<div title={"t" * 9000} hidden>no</div><p data-a=\'{data.replace("'", "")}\'>c') == [(0, "no"), (1, "c")]
    assert html_text.page_blocks('<p data-class="ad" class=x>d</p><p title="e>f</p>') == [(1, "d"), (1, "f")]
    assert html_text.page_blocks("<p a='" * 20_000) == [] and html_text.page_blocks('<p a="x' + "<p>y" * 50_000)[0] == (1, "y")


def test_host_suffix_array_against_brute_force(spark):
    rnd = random.Random(5)
    pages = [[rnd.randrange(4) for _ in range(rnd.randrange(0, 60))] for _ in range(9)]
    got = html_text.covered_tokens(pages, run=5, least=3)
    where = {}
    for i, p in enumerate(pages):
        for j in range(len(p) - 4):
            where.setdefault(tuple(p[j: j + 5]), set()).add(i)
    for p, flags in zip(pages, got):
        want = [False] * len(p)
        for j in range(len(p) - 4):
            if len(where[tuple(p[j: j + 5])]) >= 3:
                want[j: j + 5] = [True] * 5
        assert want == flags.tolist()
    menu = "Home About us Contact the team Site map Legal notes and more"
    rows = [(i, f"http://h/{i}", f"<p>{menu}</p><p>{prose(i, 30)}</p>") for i in range(6)]
    rows += [(90, None, None), (91, "http://h/9", ""), (91, "http://h/9", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_text.extract_text(df).collect()
    text = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) and all(text[i] == prose(i, 30) for i in range(6)) and text[90] == text[91] == ""
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_shards_of_a_host_add_up(spark):
    notice = "Our shop is closed on public holidays and on every second Sunday of the month"
    rows = [(i, f"http://big/{i}", f"<p>{prose(100 + i, 60)}</p>" + (f"<p>{notice}</p>" if i % 10 == 0 else "")) for i in range(40)]
    rows += [(50 + i, f"http://other/{i}", f"<p>{notice}</p>") for i in range(2)]           # two pages: not shared there
    want = {i: prose(100 + i, 60) for i in range(40)} | {50: notice, 51: notice}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for frame in (df.coalesce(1), df.repartition(7), df.orderBy(F.desc("page_id"))):
        for shard_tokens in (100, 1000, 400_000):
            out = html_text.extract_text(frame, shard_tokens=shard_tokens).collect()
            assert {r["page_id"]: r["text"] for r in out} == want and len(out) == len(rows)


def test_runs_of_marked_pages_count_and_marks_only_protect(spark):
    notice = "Our shop is closed on public holidays and on every second Sunday of the month"
    rows = [(i, f"http://h/{i}", f"<div>{notice}</div><div>{prose(200 + i, 20)}</div><article><p>{prose(300 + i, 30)}</p>"
             f"<p>{notice}</p></article>") for i in range(3)]
    rows += [(3, "http://h/3", f"<p>{prose(203, 20)}</p><p>{notice}</p>"), (4, "http://h/4", f"<main>{notice}</main>"),
             (5, "http://k/5", f"<main>{notice}</main><nav>n</nav>")]
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = {i: f"{prose(200 + i, 20)}\n\n{prose(300 + i, 30)}\n\n{notice}" for i in range(3)}
    assert {r["page_id"]: r["text"] for r in out} == want | {3: prose(203, 20), 4: notice, 5: notice} and len(out) == 6


def test_runs_are_found_on_hosts_whose_pages_are_all_marked(spark):
    notice = "Our shop is closed on public holidays and on every second Sunday of the month"
    rows = [(i, f"http://h/{i}", f"<nav>{notice}</nav><article><p>{notice}</p><p>{prose(400 + i, 30)}</p></article>") for i in range(4)]
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert "CoGroupsInArrow" in out._jdf.queryExecution().executedPlan().toString()
    assert {r["page_id"]: r["text"] for r in out.collect()} == {i: f"{notice}\n\n{prose(400 + i, 30)}" for i in range(4)}


def test_runs_travel_in_few_bytes_and_pages_by_one_exchange(spark):
    names = np.unique(np.random.default_rng(7).integers(0, 2 ** 64, 50_000, np.uint64))
    assert (html_text._unpack(len(names), html_text._pack(names)) == names).all()
    assert len(html_text._unpack(0, html_text._pack(names[:0]))) == 0
    shard = html_text._shard([(i, None, "h", [(1, prose(500 + i, 400))]) for i in range(100)], pa.int64())
    slots, pages = html_text.ShardRuns(shard).slots(24)
    sent = html_text._send(1, slots << np.uint64(40), pages, 4, 3)
    assert sum(len(x) + len(y) for x, y in zip(sent["names"].to_pylist(), sent["pages"].to_pylist())) < 3 * len(slots)
    rnd = random.Random(11)
    texts = [[rnd.choice("abc") for _ in range(rnd.randrange(1, 60))] for _ in range(60)]
    rows = [(i, f"http://h{i % 3}/{i}", f"<p>{' '.join(t)}</p>") for i, t in enumerate(texts)]
    want = {}
    for h in range(3):
        flags = html_text.covered_tokens([[ord(w) for w in t] + [0] for t in texts[h::3]])
        want |= {h + 3 * k: " ".join(w for w, c in zip(texts[h + 3 * k], f) if not c) for k, f in enumerate(flags)}
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_tokens=150)
    assert {r["page_id"]: r["text"] for r in out.collect()} == want and any(len(want[i]) < len(" ".join(t)) for i, t in enumerate(texts))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2 and plan.count("MapInArrow") == 1


def test_pages_dealt_otherwise_on_a_second_reading_are_an_error():
    table = pa.table({"shard": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})
    with pytest.raises(RuntimeError, match="changed while they were read"):
        html_text._data(table, pa.table({"shard": [1]}))


# ------------------------------------------------------------------ 3 exact
@pytest.mark.parametrize("digest", [exact.sha_digest, lambda body: F.encode(F.substring(body, 1, 1), "UTF-8")])
def test_exact_dedup(spark, digest):
    """The second digest makes different texts collide, so full content has to decide."""
    rows = EDGE + [(20 + i, "ab") for i in range(300)] + [(400, "ac")]
    out = exact.exact_dedup(docs_frame(spark, rows), salts=3, digest=digest).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep) for i in ids]
    assert sorted((tuple(r)[:4] for r in out), key=str) == sorted(want, key=str)
    assert exact.exact_dedup(docs_frame(spark, rows).limit(0)).count() == 0
    kept = exact.keep_one_copy(spark, docs_frame(spark, rows), "")
    assert kept.columns == docs_frame(spark, rows).columns and kept.count() == len(groups)


# ------------------------------------------------------------------ 4 packing
def test_optimal_buckets_against_all_choices():
    from itertools import combinations
    rnd = random.Random(1)
    for _ in range(30):
        x = sorted(rnd.sample(range(0, 60), rnd.randrange(1, 8)))
        c = [rnd.randrange(1, 9) for _ in x]

        def padding(bounds):
            return sum(n * (min(b for b in bounds if b >= v) - v) for v, n in zip(x, c))

        for k in (1, 2, 3):
            best = min(padding([*cut, x[-1]]) for m in range(k) for cut in combinations(x[:-1], m))
            bounds = packing.optimal_buckets(x, c, k)
            assert len(bounds) <= k and padding(bounds) == best
    assert packing.optimal_buckets([], [], 4) == []


def test_packing_keeps_every_token(spark):
    rows = EDGE + [(100 + i, prose(i, i % 90)) for i in range(400)]
    df = docs_frame(spark, rows)
    out = packing.pack(df, max_len=50, token_budget=200, buckets=4, chunk_rows=37).collect()
    words = sum(len((t or "").encode().split()) for _, t in rows)
    assert sum(r["n_tokens"] for r in out) == words and {r["doc_id"] for r in out} == {i for i, _ in rows}
    batches = {}
    for r in out:
        assert r["n_tokens"] <= r["bucket_len"]
        batches.setdefault((r["bucket_len"], r["batch_no"]), []).append(r["row_no"])
    for (length, no), places in batches.items():
        most = max(1, 200 // max(length, 1))
        assert sorted(places) == list(range(len(places))) and len(places) <= most
        if (length, no + 1) in batches:
            assert len(places) == most                          # only the last batch of a bucket may be short
    assert packing.pack(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 5 embeddings
def test_spherical_dedup_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 24))
    vectors = [b + rng.standard_normal(24) * s for b in base for s in (0, 0.05, 0.15, 0.2, 0.3, 0.35)]
    vectors += [vectors[7]] * 30
    rows = [(i, [float(x) for x in v], i % 2 if i < 240 else 1) for i, v in enumerate(vectors)]
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 24, 1), (n + 3, [float("nan")] * 24, 1), (n + 4, [None] + [1.0] * 23, 1),
           (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (n + 8, [float("inf")] * 24, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    a = np.array(vectors)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    links = (a @ a.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(n, dtype=bool)
    for group_rows, large_bytes in ((2048, 8 << 20), (20, 8 << 20), (20, -1)):
        monkeypatch.setattr(spherical, "LARGE_BYTES", large_bytes)
        out = {r["vec_id"]: r for r in spherical.spherical_dedup(df, group_rows=group_rows).collect()}
        assert len(out) == n + len(odd)
        found = sum(out[i]["n_links"] for i in range(n))
        assert all(out[i]["n_links"] <= links[i].sum() for i in range(n)) and found >= 0.99 * links.sum()
        assert out[n + 6]["n_links"] == out[n + 7]["n_links"] == 1 and out[n + 7]["component_id"] == n + 6
        for i in (0, 1, 2, 3, 4, 5, 8):
            assert (out[n + i]["n_links"], out[n + i]["component_id"], out[n + i]["kept"]) == (0, n + i, True)
    assert spherical.spherical_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [8, 12, 16, 18])
def test_filters_of_close_pairs_meet(spark, bits):
    rng = np.random.default_rng(40 + bits)
    n, cosine = 600, 0.9301
    u, w = rng.standard_normal((2, n, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    vectors = np.concatenate([u, cosine * u + np.sqrt(1 - cosine ** 2) * w])
    df = spark.createDataFrame([("a", i, 1, [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "label string, cid long, copies long, v array<double>")
    held = [set() for _ in vectors]
    for cid, own in spherical._filters(df, bits, spherical.LISTS, parts=3).select("cid", "own").collect():
        held[cid].update(own)
    near = np.argwhere(np.triu(vectors @ vectors.T >= 0.93, 1))                  # brute force
    assert len(near) >= n and min(map(len, held)) >= spherical.LISTS
    assert sum(bool(held[i] & held[j]) for i, j in near) >= 0.99 * len(near)


def test_spherical_query_on_the_given_table_with_planted_links(spark, tmpdir_path):
    """The given vectors, which have no links of their own, and near copies of some of them: the query against brute force."""
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rng, rows = np.random.default_rng(9), [tuple(r) for r in given]
    whole = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None for x in r[1])]
    for n, (_, v, label) in enumerate(whole[::3]):
        v = np.array(v)
        noise = rng.standard_normal(len(v))
        noise *= np.linalg.norm(v) / np.linalg.norm(noise) * (0, 0.1, 0.3, 0.39, 0.5)[n % 5]
        rows.append((10_000_000 + n, [float(np.float32(x)) for x in v + noise], label if n % 7 else label + 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit("x")).withColumn("cid", F.lit(1))
    df.repartition(5).write.parquet(f"{tmpdir_path}/embeddings.parquet")
    out = {r["vec_id"]: r for r in spherical.op5_spherical_dedup(spark, tmpdir_path).collect()}
    usable = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    a = np.array([r[1] for r in usable])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    label, ids = np.array([r[2] for r in usable]), [r[0] for r in usable]
    links = (a @ a.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(len(a), dtype=bool)
    assert len(out) == len(rows) and links.sum() > 100
    assert all(out[i]["n_links"] <= n for i, n in zip(ids, links.sum(axis=1)))
    assert sum(out[i]["n_links"] for i in ids) >= 0.99 * links.sum()
    least = [min([ids[i], *(ids[j] for j in np.flatnonzero(links[i]))]) for i in range(len(ids))]
    assert sum(out[i]["component_id"] <= n for i, n in zip(ids, least)) >= 0.99 * len(ids)


def test_directions_of_small_dimensions_and_wide_angles():
    for dim in (1, 2, 3):
        made = spherical.directions(dim, 8)
        codes = made.decode(np.eye(dim))
        assert all(len(set(c)) == len(c) for c in codes.tolist())
    assert spherical.directions(64, 12, cosine=0.3).needed(0.3, 0.01) <= spherical.MOST_LISTS


# ------------------------------------------------------------------ 6 quality
def test_rule_ensemble(spark):
    good = [(i, prose(i, 60 + i % 40, 4000)) for i in range(300)]
    bad = [(1000 + i, " ".join(f"WORD{i}!!" for _ in range(30 + i % 50))) for i in range(150)]
    edge = [(i and 5000 + i, t) for i, t in EDGE]         # ids of their own: no label, no good document
    df = docs_frame(spark, good + bad + edge)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 0, 0), (5003, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = rules.fit_rules(df, labels)
    assert model["rules"]
    out = {r["__doc"]["doc_id"]: r for r in rules.score_documents(df, model).collect()}
    assert all(out[i]["predicted"] == 1 for i, _ in good) and all(out[i]["predicted"] == 0 for i, _ in bad)
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[5001]["score"] == out[5002]["score"]
    held = {r["doc_id"]: r["x"] for r in df.select("doc_id", rules.held_out().alias("x")).collect()}
    assert all(x == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, x in held.items())
    assert not [r for r in rules.training_rows(df, labels).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert rules.fit_rules(df, labels.limit(0))["rules"] == [] and rules.score_documents(df.limit(0), model).count() == 0
    one = rules.score_documents(df, rules.fit_rules(df, labels.where("quality = 1"))).where("predicted = 0")
    assert one.count() == 0


def test_all_paths_of_all_trees_become_rules():
    class Tree:
        def __init__(self, feature):
            self.toDebugString, at = "", iter(range(99))

            def grow(depth):
                cut = f"(feature {feature} %s {next(at)}.0)"
                for word, sign in (("If", "<="), ("Else", ">")):
                    self.toDebugString += "  " + " " * depth + f"{word} {cut % sign}\n"
                    if depth < rules.TREE_DEPTH - 1:
                        grow(depth + 1)
                    else:
                        self.toDebugString += "  " + " " * (depth + 1) + "Predict: 0.0\n"

            grow(0)

    class Forest:
        trees = [Tree(i) for i in range(rules.TREES)]

    found = rules.tree_rules(Forest)
    assert len(found) == len(set(found)) == 168 and {r[0][0] for r in found} == set(range(rules.TREES))


# ------------------------------------------------------------------ 7 suffixes
def removed_by_brute_force(rows, window=100):
    seen, out = set(), {}
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - window + 1):
            piece = data[j: j + window]
            if piece in seen:
                gone[j: j + window] = b"\1" * window
            seen.add(piece)
        spans = sum(1 for j, x in enumerate(gone) if x and (not j or not gone[j - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest())
    return out


def test_induced_sorting_in_memory_and_on_disk():
    rnd = random.Random(2)
    for trial in range(12):
        base = bytes(rnd.choice(b"ab\0" if trial % 2 else b"abcdef ") for _ in range(400))
        pieces = []
        for _ in range(rnd.randint(1, 9)):
            a = rnd.randint(0, 250)
            p = bytearray(base[a: a + rnd.randint(100, 160)])
            p[rnd.randrange(len(p))] = 97
            pieces.append(bytes(p))
        pieces.append(b"a" * 130)
        text = np.concatenate([[0], *[np.append(np.frombuffer(p, np.uint8).astype(np.uint16) + 1, 0) for p in pieces]]).astype(np.uint16)
        position, common = induced.sort_suffixes(text, 500 if trial % 3 == 0 else 1 << 26)
        flat = text.tolist()
        whole = [flat[p: p + 101] for p in position.tolist() if 0 not in flat[p: p + 100] and p + 100 <= len(flat)]
        assert [x[:100] for x in whole] == sorted((x[:100] for x in whole), reverse=True)
        late = suffix.repeated_windows(pieces)
        seen = set()
        for p, offsets in zip(pieces, late):
            want = []
            for j in range(len(p) - 99):
                if p[j: j + 100] in seen:
                    want.append(j)
                seen.add(p[j: j + 100])
            assert offsets.tolist() == want


def test_suffix_dedup_against_brute_force(spark):
    rnd = random.Random(9)
    passage = prose(77, 60)
    rows = [(i, prose(i, 80) + (" " + passage[rnd.randrange(40):] if i % 3 == 0 else "")) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1][:500] + "!" + rows[3][1][501:]), (102, "é" * 300), (103, "a" * 1000),
             (104, "abcdefg " * 100), (105, None), (106, ""), (107, "x" * 99), (108, "x" * 100), (109, "x" * 100)]
    want = removed_by_brute_force(rows)
    for shard in (3 << 20, 2000):
        out = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(docs_frame(spark, rows), shard_bytes=shard).collect()}
        assert out == want
    twice = suffix.remove_repeats(docs_frame(spark, rows[:5] * 2)).collect()
    assert len(twice) == 10 and {tuple(r) for r in twice} == {(i, *v) for i, v in removed_by_brute_force(rows[:5]).items()}
    last = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(docs_frame(spark, [(None, passage), (5, passage)])).collect()}
    assert last == {5: 0, None: len(passage)}
    assert suffix.remove_repeats(docs_frame(spark, rows).limit(0)).count() == 0


def test_suffix_dedup_with_few_buckets_and_no_broadcast(spark, monkeypatch):
    """Spark's limit of buckets bounds their number, no catalog table is left, and names may be joined by a shuffle."""
    monkeypatch.setattr(suffix, "FEW_NAMES", 0)
    rows = [(i, prose(i, 80) + " " + prose(77, 60)[i % 40:]) for i in range(40)]
    most = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(most)
    spark.conf.set(most, "3")
    try:
        out = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(docs_frame(spark, rows), bucket_bytes=100, shard_bytes=500).collect()}
    finally:
        spark.conf.set(most, before)
    assert out == removed_by_brute_force(rows)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("llm_texts")]


@pytest.mark.parametrize("length", [45, 70, 99])
def test_sorted_shards_stay_bounded_with_a_phrase_in_most_documents(spark, length):
    phrase = prose(500, 60)[:length]
    rows = [(i, f"{prose(600 + i, 25)}{phrase}{prose(700 + i // 2, 25)}") for i in range(300)]
    rows += [(300 + i, rows[i][1] + " tail") for i in range(0, 60, 7)]
    shard, want = 1500, removed_by_brute_force(rows)
    out = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(docs_frame(spark, rows), shard_bytes=shard).collect()}
    assert out == want
    texts = suffix._unique_texts(docs_frame(spark, rows).select("doc_id", "text"), 100, 4)
    pieces = suffix._pieces(texts, suffix._repeated_anchors(texts, 100, 32, 4), 100, 32)
    whole = pieces.groupBy("h").agg(F.sum(F.octet_length("piece"))).agg(F.max("sum(octet_length(piece))")).first()[0]
    parts, _ = suffix._bounded(pieces, 100, 32, shard)
    apart = [list(g) for g in parts.where("piece is not null").groupBy("h").agg(
        F.sum(F.octet_length("piece")), F.collect_set("piece")).toLocalIterator()]
    assert whole > shard and all(size <= shard or len(set(map(bytes, distinct))) == 1 for _, size, distinct in apart)


# ------------------------------------------------------------------ 8 unigram
def test_trie_counts_against_every_segmentation():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -2.6, "▁a": -2.2, "ba": -3.9, "aba": -4.0, "bb": -5.0}
    words = sorted("▁" + "".join(random.Random(i).choice("abé") for _ in range(i % 7)) for i in range(120))

    def best(word):
        if not word:
            return 0.0, 0
        found = []
        for k in range(1, len(word) + 1):
            s, n = best(word[k:])
            if word[:k] in scores:
                found.append((-(scores[word[:k]] + s), n + 1))
            elif k == 1:
                b = len(word[0].encode())
                found.append((-(b * unigram.BYTE_SCORE + s), n + b))
        return (-min(found, key=lambda x: (round(x[0], 9), x[1]))[0], min(found, key=lambda x: (round(x[0], 9), x[1]))[1])

    trie = unigram.TrieCounter(scores)
    assert trie.count(words) == [best(w)[1] for w in words]
    assert trie.nodes < sum(map(len, words))                    # shared prefixes are scored once


def test_token_counts(spark):
    out = {}
    for r in unigram.token_counts(docs_frame(spark, EDGE)).collect():
        out.setdefault(r["doc_id"], []).append((r["n_pretokens"], r["n_tokens"]))
    assert out[1] == out[2] == out[3] == [(0, 0)] and len(out[5]) == 2 and out[7][0][0] == 20_000
    assert unigram.token_counts(docs_frame(spark, EDGE).limit(0)).count() == 0


# ------------------------------------------------------------------ 9 jaccard
def components_by_brute_force(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and 100 * c >= percent * len(a | sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(r)) for (i, _), s, r in zip(rows, sets, root)]


@pytest.mark.parametrize("limits", [{}, {"max_members": 6, "depth": 1}, {"max_members": 4, "depth": 0}])
def test_jaccard_join_against_all_pairs(spark, limits):
    rnd = random.Random(4)
    rows = list(EDGE)
    for g in range(8):
        words = prose(g, 120 + 15 * g, 5000).split()
        for m in range(7):
            w = list(words)
            for _ in range(m):
                w[rnd.randrange(len(w))] = f"new{rnd.randrange(10 ** 6)}"
            rows.append((1000 + 10 * g + m, " ".join(w).upper() if m == 1 else " ".join(w)))
    for words, percent in ((4, 85), (5, 80)):
        out = jaccard.jaccard_join(docs_frame(spark, rows), words, percent, **limits).collect()
        got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str)
        assert got == sorted(components_by_brute_force(rows, words, percent), key=str)
    assert jaccard.jaccard_join(docs_frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("piece", [500_000, 25])
def test_components(spark, monkeypatch, piece):
    from metricyard.llm import common
    monkeypatch.setattr(common, "FOREST_EDGES", piece)
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(40)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {}
    for a, b in edges * 70:
        low = min(group.get(a, a), group.get(b, b))
        group[a] = group[b] = low
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert set(out) == linked and len({(group[v], out[v]) for v in linked}) == len({group[v] for v in linked})


# ------------------------------------------------------------------ 10 mixing
def test_targets_are_reshared(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10_000), (None, 500), ("d", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    weight, size = dict(zip(["a", "b", "c", "d", None], (5, 2, 1, 5, 2))), {"a": 100, "b": 1000, "c": 10_000, "d": 0, None: 500}
    want, over = {}, set()
    while True:                                       # the rule as stated: stop at the cap, share the excess again
        rest = 11_600 - sum(3 * size[s] for s in over)
        free = sum(w for s, w in weight.items() if s not in over)
        want = {s: 3 * size[s] if s in over else rest * weight[s] / free for s in weight}
        more = {s for s in weight if s not in over and want[s] > 3 * size[s]}
        if not more:
            break
        over |= more
    assert all(math.isclose(got[s], want[s]) for s in want)


def test_pareto_mix(spark, monkeypatch):
    rows = [(i, prose(i, 20 + i % 200), f"s{i % 4}" if i % 9 else None) for i in range(900)] + [(5, None, "s1"), (None, "a b", "s0")]
    df = docs_frame(spark, rows)
    first = mixing.mix_sources(df).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix_sources(df.repartition(5)).collect()))
    taken, target = {}, {}
    for r in first:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    uneven = mixing.mix_sources(df, tilt=mixing.TILT).collect()
    copies = lambda low, high: [r["copies"] for r in uneven if low <= r["size"] < high and r["source"] == "s1"]
    short, long_ = copies(20, 60), copies(160, 220)
    assert sum(short) / len(short) > 1.3 * sum(long_) / len(long_)            # odds fall with the size
    assert max(r["copies"] for r in uneven) <= 3
    assert all(abs(sum(r["taken"] for r in uneven if r["source"] == s) - target[s]) <= 0.01 * target[s] for s in target)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)                             # the way for many sources
    assert sorted(map(str, mixing.mix_sources(df).collect())) == sorted(map(str, first))
    monkeypatch.undo()
    tilted = mixing.mix_sources(df.withColumn("w", F.when(F.col("doc_id") % 5 == 0, 8.0).otherwise(1.0)), weight_col="w").collect()
    heavy = [r["copies"] for r in tilted if r["doc_id"] is not None and r["doc_id"] % 5 == 0]
    light = [r["copies"] for r in tilted if r["doc_id"] is not None and r["doc_id"] % 5]
    assert sum(heavy) / len(heavy) > 2 * sum(light) / len(light) and max(heavy + light) <= 3
    mixed = mixing.mix_documents(spark, df, "")
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in first)
    assert mixing.mix_sources(df.limit(0)).count() == 0
