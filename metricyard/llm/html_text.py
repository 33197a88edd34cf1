"""Operator 2, main text of HTML pages with a host suffix array.

Each page is cut into blocks of text (character references decoded, white space collapsed). Navigation, footers,
forms, adverts, notices, comments, scripts and the like hold no main text. All other text of every page is open
and the host decides: the token streams of all pages of the host, with all their blocks, are concatenated, their
suffixes are sorted, and a run of at least ``RUN`` tokens that ``PAGES`` distinct pages share is boilerplate.
Covered tokens go; the runs that are left stay. Marks only protect: text inside an ``article``, ``main`` or
``role=main`` element is never removed, though many pages share it. The runs of every host are found, and every page
gets its text from them, also where marks settle all of it.

Pages are dealt in shards of about ``SHARD_TOKENS`` tokens, so a host with a third of all pages is many tasks; a
shard travels as one compressed row, by one exchange that all later steps read. Shards add up what they hold in two
rounds. At first each counts its pages by the top bits of a 64-bit key of host and run; a run that ``PAGES`` pages
share is in a slot that counts as many, and few others are. Then the suffixes of each shard with such slots are
sorted, by prefix doubling up to the run length, which is all that the coverage needs (suffixes with a common prefix
of ``RUN`` tokens are then of equal rank); the distinct runs in these slots go out with their whole key and their
number of pages, the numbers of all shards are added, and each shard gets back those of its runs that ``PAGES`` pages
of the whole host share. So neither the size of a host nor the order of the input changes a result. Keys travel
sorted, as compressed planes of the bytes of their differences: about 1.5 bytes a run in the first round.

Defined results: null and empty html give an empty text. Unclosed and stray tags, comments and entities never
fail; a page cut off inside a tag ends there. A null url is a host of its own. Repeated rows and null ids each
give a row. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN, PAGES, SHARD_TOKENS, BUCKET_RUNS = 8, 3, 400_000, 2_000_000
SLOT_BITS = 26                # a bucket of the first round holds at most 2 ** SLOT_BITS slots, of a byte each

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "select", "math",
       "canvas", "xmp", "noembed", "noframes"}
SKIP = {"head", "nav", "footer", "aside", "form", "button", "dialog", "menu", "audio", "video", "label", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
         "table", "tbody", "tfoot", "thead", "tr", "caption", "ul"}
HOLDS = BLOCK - {"p", "li", "dd", "dt", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "html"}
SKIP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo",
              "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead",
              "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter",
              "subscribe", "social", "share", "sharing", "related", "recommended", "comment", "comments", "disqus",
              "respond", "replies", "widget", "pagination", "pager", "copyright", "login", "signup", "search", "toolbar"}
SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
GAP, KEY, EQUALS, BARE = re.compile(r"[\s/]*"), re.compile(r"=?[^\s/>=]*"), re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _read_tag(page: str, at: int, last_quote: dict[str, int]) -> tuple[int, dict[str, str]]:
    """(place of the ``>`` that ends the tag or -1, its attributes) from the end of the tag's name on. Of attributes
    with one name the first counts. A quote that nothing closes is part of a bare value."""
    attributes: dict[str, str] = {}
    while True:
        at = GAP.match(page, at).end()
        if at >= len(page):
            return -1, attributes
        if page[at] == ">":
            return at, attributes
        m = KEY.match(page, at)
        key, value, at = m[0].lower(), "", m.end()
        if m := EQUALS.match(page, at):
            at = m.end()
            if at < last_quote.get(page[at: at + 1], -1):
                close = page.find(page[at], at + 1)
                value, at = page[at + 1: close], close + 1
            else:
                m = BARE.match(page, at)
                value, at = m[0], m.end()
        attributes.setdefault(key, value)


def _judge(name: str, attributes: dict[str, str], in_main: bool) -> tuple[bool, bool]:
    """(skip, main) of an opening tag."""
    if name in SKIP or name == "header" and not in_main:
        return True, False
    main = name in ("article", "main")
    for key, value in attributes.items():
        value = value.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
            return True, False
        if key == "role":
            if value in SKIP_ROLES:
                return True, False
            main |= value == "main"
        elif key in ("class", "id") and name not in ("body", "html", "article", "main"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & SKIP_WORDS or "header" in words and not in_main:
                return True, False
    return False, main


def page_blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order; kind 2: in a main element, 1: open, 0: in a skipped one."""
    page = page or ""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool]] = []         # name, inside skipped, inside main
    skip = main = False
    parts: list[str] = []

    def flush():
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((0 if skip else 2 if main else 1, text))
            parts.clear()

    lower = None
    last_quote = {q: page.rfind(q) for q in "\"'"}
    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            parts.append(page[at:])
            break
        if lt > at:
            parts.append(page[at:lt])
        head = page[lt + 1: lt + 2]
        if head == "!" or head == "?":
            if page.startswith("<!--", lt):
                close = page.find("-->", lt + 4)
                at = end if close < 0 else close + 3
            else:
                close = page.find(">", lt)
                at = end if close < 0 else close + 1
            continue
        m = NAME.match(page, lt)
        if not m:
            parts.append("<")
            at = lt + 1
            continue
        gt, attributes = _read_tag(page, m.end(), last_quote)
        if gt < 0:
            break                                    # cut off inside a tag
        at = gt + 1
        name = m[1].lower()
        if page[lt + 1] == "/":
            if name in BLOCK:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    flush()
                    del stack[i:]
                    _, skip, main = stack[-1] if stack else ("", False, False)
                    break
            continue
        if name in RAW and page[gt - 1] != "/":
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else re.sub("[A-Z]", lambda c: c[0].lower(), page)
            close = lower.find(f"</{name}", at)
            close = page.find(">", close) if close >= 0 else -1
            at = end if close < 0 else close + 1
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            elif name == "br":
                parts.append(" ")
            continue
        if name in ("td", "th"):
            parts.append(" ")
        if name in BLOCK:
            flush()
        if page[gt - 1] == "/":
            continue
        skips, mains = _judge(name, attributes, main)
        if name in HOLDS or skips or mains:
            if skips:
                flush()
            stack.append((name, skip or skips, main or mains))
            skip, main = skip or skips, main or mains
    flush()
    return out


def sorted_runs(tokens: np.ndarray, sizes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the pages in one stream, ranks of its suffixes by their first ``run`` tokens, whether these
    lie in one page, number of distinct pages by rank) of pages with ``sizes`` of ``tokens``."""
    # one stream; a separator of its own ends each page, so no common prefix crosses pages
    starts, owner, place, whole = _stream(sizes, run)
    stream = np.empty(len(owner), np.int64)
    stream[place] = tokens
    stream[starts[1:] - 1] = tokens.max(initial=0) + 1 + np.arange(len(sizes))
    rank, length = np.unique(stream, return_inverse=True)[1], 1
    while length < run:
        step = min(length, run - length)
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        rank, length = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1], length + step
    pages = np.sort(rank * len(sizes) + owner)
    pages = pages[np.concatenate([[True], np.diff(pages) != 0])]
    return starts, rank, whole, np.bincount(pages // len(sizes))


def _stream(sizes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the pages, page of each place, places of the tokens, whether a run from there lies in its page) in a
    stream where one more place ends each page."""
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    starts = np.cumsum(np.concatenate([[0], sizes + 1]))
    ends = starts[1:] - 1
    place = np.ones(len(owner), bool)
    place[ends] = False
    return starts, owner, np.flatnonzero(place), np.arange(len(owner)) + run <= ends[owner]


def cover(starts: np.ndarray, hit: np.ndarray, run: int) -> list[np.ndarray]:
    """For each page's tokens, which lie in a run that starts at a place of ``hit``."""
    count = np.zeros(len(hit) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(count, at, 1)
    np.add.at(count, at + run, -1)
    covered = np.cumsum(count)[:-1] > 0
    return [covered[a: b - 1] for a, b in zip(starts, starts[1:])]


def covered_tokens(pages: list[list[int]], run: int = RUN, least: int = PAGES) -> list[np.ndarray]:
    """For each page's token stream, which tokens lie in a run of ``run`` tokens that ``least`` pages hold."""
    if not any(map(len, pages)):
        return [np.zeros(0, bool) for _ in pages]
    starts, rank, whole, support = sorted_runs(np.concatenate([np.array(p, np.int64) for p in pages]),
                                               np.array([len(p) for p in pages]), run)
    return cover(starts, (support[rank] >= least) & whole, run)


END = "\n"                    # the token that ends a block; white space inside of blocks is one space


def _shard(rows: list[tuple], ids: pa.DataType) -> bytes:
    """Pages (page_id, url, host, blocks) as a compressed Arrow table."""
    page_ids, urls, hosts, blocks = zip(*rows)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(page_ids, ids), pa.array(urls, pa.string()), pa.array(hosts, pa.string()),
         pa.array([[k for k, _ in b] for b in blocks], pa.list_(pa.int8())),
         pa.array(["".join(f"{t} {END} " for _, t in b)[:-1] if b else None for b in blocks], pa.large_string())],
        ["page_id", "url", "host", "kinds", "text"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


class ShardRuns:
    """The token streams of a shard's pages and a key of host and run for each place."""

    def __init__(self, data: bytes, run: int = RUN):
        self.pages, self.run = pa.ipc.open_stream(data).read_all().combine_chunks(), run
        words = pc.split_pattern(self.pages["text"].combine_chunks(), " ")
        self.sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)
        words = words.flatten().dictionary_encode()
        self.words, self.vocabulary = words.indices.to_numpy().astype(np.int64), words.dictionary
        self.starts, self.owner, self.place, self.whole = _stream(self.sizes, run)
        hosts = self.pages["host"].combine_chunks().dictionary_encode()
        self.hosts = hosts.indices.to_numpy().astype(np.int64)
        stream = np.zeros(len(self.owner) + run, np.uint64)
        stream[self.place] = _hashes(self.vocabulary)[self.words]
        key = _hashes(hosts.dictionary)[self.hosts][self.owner]
        for j in range(run):
            key = (key ^ stream[j: j + len(key)]) * np.uint64(0xBF58476D1CE4E5B9)
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            key ^= key >> np.uint64(32)
        self.keys = key

    def slots(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(slots of the runs, least first; number of pages in each): top ``bits`` of the keys."""
        pages = (self.keys[self.whole] >> np.uint64(64 - bits)) * np.uint64(len(self.sizes)) + self.owner[self.whole].astype(np.uint64)
        pages = np.sort(pages)
        pages = pages[np.concatenate([[True], np.diff(pages) != 0])] if len(pages) else pages
        slots, counts = np.unique(pages // np.uint64(len(self.sizes)), return_counts=True)
        return slots, counts

    def runs(self, slots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys of the distinct runs in ``slots``, least first; number of pages that hold each)."""
        # a word of two hosts is two tokens, so that no run is common to hosts
        tokens = self.words + self.hosts[self.owner[self.place]] * len(self.vocabulary)
        _, rank, whole, support = sorted_runs(tokens, self.sizes, self.run)
        at = np.flatnonzero(whole)
        at = at[_among(self.keys[at] >> np.uint64(64 - bits), slots)]
        ranks, first = np.unique(rank[at], return_index=True)
        keys = self.keys[at[first]]
        order = np.argsort(keys)
        return keys[order], support[ranks][order]

    def texts(self, shared: np.ndarray) -> list[str]:
        """Main text of each page without the runs whose key is in ``shared``."""
        hit = self.whole.copy()
        hit[hit] = _among(self.keys[hit], shared)
        return ["\n\n".join(_left(kinds, text[:-2].split(f" {END} ") if kinds else [], covered)) for kinds, text, covered in
                zip(self.pages["kinds"].to_pylist(), self.pages["text"].to_pylist(), cover(self.starts, hit, self.run))]


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, least first."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as compressed planes of the bytes of their differences."""
    steps = np.diff(values.astype("<u8"), prepend=np.zeros(1, "<u8"))
    return pa.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(n: int, data: bytes) -> np.ndarray:
    planes = pa.decompress(data, 8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view("<u8").ravel(), dtype=np.uint64)


PACKED = "bucket long, shard long, n long, names binary, pages binary"


def _send(shard: int, names: np.ndarray, pages: np.ndarray, bits: int, least: int) -> pa.Table:
    """A shard's sorted names and their numbers of pages, cut at the top ``bits`` of all 64."""
    bucket = (names >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
    buckets, ends = np.unique(bucket, return_index=True)
    ends = [*ends.tolist(), len(names)]
    pieces = [slice(a, b) for a, b in zip(ends, ends[1:])]
    return pa.table({
        "bucket": pa.array(buckets, pa.int64()), "shard": pa.array([shard] * len(pieces), pa.int64()),
        "n": pa.array([p.stop - p.start for p in pieces], pa.int64()),
        "names": pa.array([_pack(names[p]) for p in pieces], pa.binary()),
        "pages": pa.array([pa.compress(np.minimum(pages[p], least).astype("<i4").tobytes(), codec="zstd", asbytes=True) for p in pieces],
                          pa.binary())})


def _received(table: pa.Table):
    """(names, pages) of each row that shards sent."""
    for n, names, pages in zip(*(table[c].to_pylist() for c in ("n", "names", "pages"))):
        yield _unpack(n, names), np.frombuffer(pa.decompress(pages, 4 * n, codec="zstd", asbytes=True), "<i4")


def _names(table: pa.Table) -> np.ndarray:
    """All names that a shard gets back, least first."""
    parts = [_unpack(n, names) for n, names in zip(table["n"].to_pylist(), table["names"].to_pylist())]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *parts]))


def _back(table: pa.Table, kept: list[np.ndarray]) -> pa.Table:
    """The names that are kept of each row, to its shard."""
    return pa.table({"shard": table["shard"], "n": pa.array([len(k) for k in kept], pa.int64()),
                     "names": pa.array([_pack(k) for k in kept], pa.binary())})


def _data(left: pa.Table, right: pa.Table) -> bytes:
    if left.num_rows != 1:
        raise RuntimeError(f"{left.num_rows} shards of a name that {right.num_rows} rows came back for: the pages changed while they were read")
    return left["data"][0].as_py()


def shared_runs(shards: DataFrame, size: int, run: int, least: int, bucket_runs: int = BUCKET_RUNS) -> DataFrame:
    """(shard, n, names): keys of those runs of the shard that ``least`` distinct pages of the whole host hold.
    ``size`` is the number of bytes of all pages, some 8 for a token."""
    bits = min(40, max(8, math.ceil(math.log2(max(1, size / 2)))))
    coarse = max(bits - SLOT_BITS, 4)
    fine = max(0, math.ceil(math.log2(max(1, size / 8 / bucket_runs))))
    back = "shard long, n long, names binary"

    def send_slots(table):
        slots, pages = ShardRuns(table["data"][0].as_py(), run).slots(bits)
        return _send(table["shard"][0].as_py(), slots << np.uint64(64 - bits), pages, coarse, least)

    def add_slots(table):
        # a bucket's slots differ in the bits after its own; counts stop at ``least``
        count = np.zeros(1 << (bits - coarse), np.min_scalar_type(least))

        def slots(names):
            return ((names << np.uint64(coarse)) >> np.uint64(64 - bits + coarse)).astype(np.int64)

        for names, pages in _received(table):
            at = slots(names)
            count[at] = np.minimum(count[at].astype(np.int64) + pages, least)
        return _back(table, [names[count[slots(names)] >= least] for names, _ in _received(table)])

    def send_runs(left, right):
        data = _data(left, right) if right.num_rows else None
        if data is None:
            return _send(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), fine, least)
        keys, pages = ShardRuns(data, run).runs(_names(right) >> np.uint64(64 - bits), bits)
        return _send(left["shard"][0].as_py(), keys, pages, fine, least)

    def add_runs(table):
        parts, pages = zip(*_received(table))
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        shared = np.bincount(place, weights=np.concatenate(pages), minlength=len(keys)) >= least
        ends = np.cumsum([0, *map(len, parts)])
        return _back(table, [part[shared[place[a:b]]] for part, a, b in zip(parts, ends, ends[1:])])

    slots = (shards.groupBy("shard").applyInArrow(send_slots, PACKED)
             .groupBy("bucket").applyInArrow(add_slots, back).where("n > 0"))
    runs = shards.groupBy("shard").cogroup(slots.groupBy("shard")).applyInArrow(send_runs, PACKED)
    return runs.groupBy("bucket").applyInArrow(add_runs, back).where("n > 0")


def extract_text(pages: DataFrame, run: int = RUN, least: int = PAGES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per page: page_id, url, text. The pages are read twice, at first for their number of bytes alone."""
    rows = pages.select("page_id", "url", F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][^:/?#]*:)?//([^/?#]*)", 1)),
                                                    F.lit("")).alias("host"), "html")

    def parse(batches):
        # a shard's name tells what it holds, so pages that a second reading deals otherwise are noticed
        def shard():
            data = _shard(dealt, ids)
            digest = hashlib.blake2b(f"{TaskContext.get().partitionId()} {made} ".encode() + data, digest_size=8).digest()
            return pa.RecordBatch.from_arrays([pa.array([int.from_bytes(digest, "little", signed=True)], pa.int64()),
                                               pa.array([data], pa.binary())], ["shard", "data"])

        dealt, held, made = [], 0, 0
        for batch in batches:
            ids = batch.column(0).type
            for page_id, url, host, page in zip(*batch.columns):
                blocks = page_blocks(page.as_py())
                tokens = 1 + sum(t.count(" ") + 2 for _, t in blocks)
                if dealt and held + tokens > shard_tokens:
                    yield shard()
                    dealt, held, made = [], 0, made + 1
                dealt.append((page_id.as_py(), url.as_py(), host.as_py(), blocks))
                held += tokens
        if dealt:
            yield shard()

    def keep_unique(left, right):
        runs = ShardRuns(_data(left, right), run)
        return pa.table({"page_id": runs.pages["page_id"], "url": runs.pages["url"],
                         "text": pa.array(runs.texts(_names(right)), pa.string())})

    size = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    shards = rows.mapInArrow(parse, "shard long, data binary")
    return shards.groupBy("shard").cogroup(shared_runs(shards, size, run, least).groupBy("shard")).applyInArrow(
        keep_unique, "page_id long, url string, text string")


def _left(kinds: list[int], blocks: list[str], covered: np.ndarray) -> list[str]:
    """Texts of the protected blocks, and of the open ones without their covered words."""
    if 1 not in kinds or not covered.any():
        return [text for kind, text in zip(kinds, blocks) if kind]
    kept, at = [], 0
    for kind, text in zip(kinds, blocks):
        words = text.split(" ")
        left = [w for w, c in zip(words, covered[at: at + len(words)]) if kind == 2 or not c]
        at += len(words) + 1
        if kind and left:
            kept.append(" ".join(left))
    return kept


def op2_html_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))
