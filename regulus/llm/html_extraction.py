"""Main text of web pages: suffix arrays over the pages of a host, checked against the structure of the page.

A page is read into blocks of text. The token streams of all pages of a host are concatenated and the suffixes sorted; long substrings that stand
on distinct pages are taken for boilerplate. The structure then checks every page: blocks that are menus, adverts and the like by their markup go
in any case, and where a page marks its article, the prose in it stays although other pages repeat it; of its other blocks (bare divisions, lists of
links) those that are repeated go, as share lines and notices without a telling class do. Where no article is marked the runs in between repeats are
kept. Hosts with many pages are split into shards of bounded size, and what no shard could see is settled by a count of their windows over the whole host.
"""
from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, ByteType, StringType, StructField, StructType

from regulus.llm.store import row_key, written
from regulus.llm.words import grams, words_of

#: Tokens of a long substring (a power of two), tokens of a shard, and the share of repeated tokens that makes a page a copy.
RUN, SHARD, COPY = 16, 500_000, 0.8
#: Kinds of blocks: out by the markup, of a page without a marked article, prose of a marked article, anything else in one.
CLOSED, OPEN, PROSE, DOUBTFUL = range(4)

#: A quoted value stands behind an equals sign and may hold anything; a quote elsewhere, or one that nothing closes, is a character.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
#: The tags of what follows a tag that does not end so: up to the first angle bracket, so that no byte is read for two of them.
_SHORT_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search section select summary table
    tbody td tfoot th thead tr ul""".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never part of an article.
_ASIDE = frozenset("nav footer aside form button select option template noscript dialog menu object svg canvas audio video map search fieldset head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status".split())
#: Words in a class or id that mark what is not the article.
_HINTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion sidebar sidebars sidenav aside
    menu menus nav navbar navigation navi breadcrumb breadcrumbs footer foot masthead topbar cookie cookies consent gdpr notice notices notification
    notifications alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations
    comment comments commentlist discussion disqus reply replies respond widget widgets toolbar pagination pager skip search searchbox tags
    banner outbrain taboola""".split())
#: Elements whose text in an article is the article's.
_PROSE = _HEADING | frozenset("p li dd dt blockquote pre td th caption figcaption summary".split())
_CONTENT = frozenset("article articlebody post entry story content main maincontent".split())


class Page(NamedTuple):
    main: str | None         # the text by structure alone, where the page marks its article
    blocks: list[str]        # all blocks in page order
    kinds: list[int]         # and what the structure says of each


class _Nodes:
    """The elements of a page: parent, tag, whether not of the article, whether only by its class, whether a candidate (2: article or main, 1: by its class)."""

    def __init__(self) -> None:
        self.parent, self.tag, self.aside, self.hinted, self.candidate = [-1], [""], [False], [False], [0]

    def add(self, parent: int, tag: str, attributes: str) -> int:
        aside, candidate = tag in _ASIDE, 2 if tag in ("article", "main") else 0
        hint = whole = content = False
        sure = tag == "main"
        if attributes and not attributes.isspace():
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name == "role":
                    aside |= value.lower() in _ROLES
                    candidate = 2 if value.lower() in ("main", "article") else candidate
                    sure |= value.lower() == "main"
                elif name in ("class", "id") and tag not in ("html", "body"):
                    words = set(re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
                    hint |= not words.isdisjoint(_HINTS)
                    whole |= not _HINTS.isdisjoint(value.lower().split())
                    content |= tag not in _HEADING and not words.isdisjoint(_CONTENT)
                elif name == "itemprop" and value == "articleBody":
                    candidate, sure = 2, True
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    aside = True
        candidate = candidate or int(content)
        if candidate == 2:
            # the element says what it is: only an article whose class is just such a word, and no word for content, is none
            hint = whole and not content and not sure
        self.hinted.append(hint and not aside)
        aside |= hint
        self.parent.append(parent)
        self.tag.append(tag)
        self.aside.append(aside)
        self.candidate.append(candidate)
        return len(self.tag) - 1

    def above(self, node: int):
        while node > 0:
            yield node
            node = self.parent[node]


def _read(html: str) -> tuple[_Nodes, list[list[tuple[int, str]]]]:
    """The elements, and the blocks as pieces of text with their element."""
    nodes, stack, blocks, block, at, tags = _Nodes(), [0], [], [], 0, _TAG
    while True:
        match = tags.search(html, at)
        if match and tags is _TAG and match[2] and not match[4]:
            tags = _SHORT_TAG
            match = tags.search(html, match.start())
        text = html[at:match.start() if match else len(html)]
        if text:
            block.append((stack[-1], unescape(text) if "&" in text else text))
        if match is None:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in _BLOCK and block:
            blocks.append(block)
            block = []
        if match[1]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes.tag[stack[k]] == tag:
                    del stack[k:]
                    break
        elif tag in _RAW:
            end = _RAW[tag].search(html, at)
            at = end.end() if end else len(html)
        elif tag == "br":
            block.append((stack[-1], " "))
        elif tag not in _VOID:
            if tag in ("p", "li", "option") and nodes.tag[stack[-1]] == tag:
                stack.pop()
            node = nodes.add(stack[-1], tag, match[3])
            if not match[3].endswith("/") or tag not in ("svg", "path"):
                stack.append(node)
    if block:
        blocks.append(block)
    return nodes, blocks


def _joined(pieces) -> str:
    return " ".join("".join(pieces).split())


def parse(html: str | None) -> Page:
    """Read one page."""
    nodes, blocks = _read(html or "")
    n = len(nodes.tag)
    aside = list(nodes.aside)
    for i in range(1, n):  # parents come first
        # a header is left out, but not the headings of an article's own header
        aside[i] = aside[i] or aside[nodes.parent[i]]
    lost = [False] * n  # left out of the candidate it stands in
    for i in range(1, n):
        lost[i] = not nodes.candidate[i] and (lost[nodes.parent[i]] or nodes.aside[i])
    size = [0] * n
    for block in blocks:
        for node, text in block:
            if not lost[node]:
                size[node] += len(text)
    for i in range(n - 1, 0, -1):
        size[nodes.parent[i]] += size[i]
    chosen = _chosen(nodes, aside, size)
    found, prose, bare, linked = [], [False] * n, [False] * n, [False] * n
    if chosen:
        wrapped = {a for c in chosen for a in nodes.above(c)}
        state = [0] * n  # 0 outside, 1 in the article, 2 left out
        for i in range(1, n):
            up = state[nodes.parent[i]]
            state[i] = 1 if i in chosen else up if i in wrapped else 2 if nodes.aside[i] else up
            if nodes.tag[i] == "header" and up == 1:
                state[i] = 3
            if up == 3:
                state[i] = 1 if nodes.tag[i] in _HEADING else 3
            # bare: in the article itself, and in no block below
            bare[i] = i in chosen or nodes.candidate[i] > 0 or nodes.tag[i] not in _BLOCK and bare[nodes.parent[i]]
            prose[i] = nodes.tag[i] in _PROSE or prose[nodes.parent[i]]
    for i in range(1, n):
        linked[i] = nodes.tag[i] == "a" or linked[nodes.parent[i]]
    for block in blocks:
        links = _joined(t for node, t in block if linked[node])
        if chosen:
            text = _joined(t for node, t in block if state[node] == 1)
            rest = _joined(t for node, t in block if state[node] != 1)
            sure = len(links) < 0.8 * len(text) and any(prose[node] or bare[node] for node, t in block if state[node] == 1 and not t.isspace())
            found.append((text, PROSE if sure else DOUBTFUL))
        else:
            free = _joined(t for node, t in block if not _left_out(nodes, aside, node))
            rest = _joined(t for node, t in block if _left_out(nodes, aside, node))
            found.append((free, OPEN if len(links) < 0.8 * len(free) else CLOSED))
        found.append((rest, CLOSED))
    found = [(text, kind) for text, kind in found if text]
    main = "\n".join(text for text, kind in found if kind in (PROSE, DOUBTFUL)) if chosen else None
    return Page(main, [text for text, _ in found], [kind for _, kind in found])


def _left_out(nodes: _Nodes, aside: list[bool], node: int) -> bool:
    return aside[node] or any(nodes.tag[a] == "header" for a in nodes.above(node))


def _chosen(nodes: _Nodes, aside: list[bool], size: list[int]) -> set[int]:
    """The elements that hold the article: all marked ones that stand in no other, whatever their length."""
    # what stands in a form, sidebar or the like only counts where nothing else does
    for kind, barred in ((2, aside), (1, aside), (2, nodes.aside), (2, [a and not h for a, h in zip(nodes.aside, nodes.hinted)])):
        free = [i for i in range(1, len(nodes.tag)) if nodes.candidate[i] == kind and size[i] and not barred[i]]
        if not free:
            continue
        own = set(free)
        return {i for i in free if not any(a in own for a in nodes.above(nodes.parent[i]))}
    return set()


def _covered(pages: list[list[str]], run: int = RUN, inner: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """For each page, a flag for every token: whether it lies in a substring of at least ``run`` tokens that stands on another page too.

    Suffixes of the concatenated streams are sorted by their first ``run`` tokens by doubling the sorted prefix. ``inner`` flags the tokens of marked
    articles: a substring without such tokens has to stand on another page outside of its article, as an article is no boilerplate of the pages that quote it.
    """
    lengths = np.array([len(p) for p in pages])
    if not lengths.sum():
        return [np.zeros(n, dtype=bool) for n in lengths]
    codes, _ = pd.factorize(np.array([t for p in pages for t in p], dtype=object))
    n = len(codes)
    page = np.repeat(np.arange(len(pages)), lengths)
    left = np.cumsum(lengths)[page] - np.arange(n)
    rank, step = codes.astype(np.int64), 1
    while step < run:
        after = np.zeros(n, dtype=np.int64)
        after[:max(n - step, 0)] = rank[step:] + 1
        after[left <= step] = 0  # a suffix ends with its page
        _, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
        step *= 2
    whole = np.flatnonzero(left >= run)
    order = whole[np.argsort(rank[whole], kind="stable")]  # equal ones by page
    r, p = rank[order], page[order]
    starts = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, dtype=np.int64)
    depth = np.zeros(n + 1, dtype=np.int64)
    if len(starts):
        sizes = np.diff(np.append(starts, len(r)))
        shared = np.repeat(p[starts] != p[starts + sizes - 1], sizes)
        if inner is not None:
            inside = _any_of_run(np.concatenate(inner), run)[order]
            first = np.minimum.reduceat(np.where(inside, len(pages), p), starts)
            last = np.maximum.reduceat(np.where(inside, -1, p), starts)
            shared &= inside | np.repeat(first < last, sizes)
        np.add.at(depth, order[shared], 1)
        np.add.at(depth, order[shared] + run, -1)
    flags = np.cumsum(depth)[:-1] > 0
    return np.split(flags, np.cumsum(lengths)[:-1])


def _any_of_run(flags: np.ndarray, run: int) -> np.ndarray:
    """Whether any of the ``run`` tokens from each place on is flagged."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    at = np.arange(len(flags))
    return sums[np.minimum(at + run, len(flags))] > sums[at]


def tokens_of(blocks: list[str]) -> list[str]:
    """The words of the blocks with a mark behind each block."""
    return [t for b in blocks for t in (*b.split(), "\n")]


def _inner(blocks: list[str], kinds: list[int]) -> np.ndarray:
    """Which tokens belong to a marked article."""
    return np.repeat(np.array(kinds, dtype=np.int64) >= PROSE, np.array([b.count(" ") + 2 for b in blocks], dtype=np.int64))


def _text(blocks: list[str], kinds: list[int], covered: np.ndarray) -> str:
    """What the structure leaves without what is covered; whole, if nearly all of it is covered and the page is a copy of another.

    Of open blocks the covered words go. Of a marked article the prose stays, and doubtful blocks go that are covered from end to end.
    """
    words, flags, own, at = [], [], [], 0
    for block, kind in zip(blocks, kinds):
        n = block.count(" ") + 1
        if kind != CLOSED:
            words.append(block.split(" "))
            flags.append(covered[at:at + n])
            own.append(kind)
        at += n + 1
    total = sum(map(len, words))
    if total and sum(int(f.sum()) for f in flags) >= COPY * total:
        return "\n".join(" ".join(w) for w in words)
    kept = (" ".join(w for w, f in zip(ws, fs.tolist()) if not f) if kind == OPEN else "" if kind == DOUBTFUL and fs.all() else " ".join(ws)
            for ws, fs, kind in zip(words, flags, own))
    return "\n".join(k for k in kept if k)


def extract(df: DataFrame, html: str = "html", url: str = "url", carry: tuple[str, ...] = ("page_id", "url"), run: int = RUN, shard: int = SHARD) -> DataFrame:
    """One row per row of ``df``: the columns named in ``carry`` and ``text``, the main text (empty if there is none).

    Null html is an empty page; a null url is a host of its own name. Repeated rows are one page to the suffix arrays, and get the same text.
    Other columns are not read, so their names cannot clash. An empty table gives an empty one.
    """
    if run & (run - 1):
        raise ValueError("run has to be a power of two")
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = df.select(*carry, host.alias("host"), F.col(html).cast("string").alias("__html"), row_key(url, html).alias("key"))
    fields = [pages.schema[c] for c in carry]
    schema = StructType([*[StructField(f.name, f.dataType) for f in fields], StructField("key", BinaryType()), StructField("host", StringType()),
                         StructField("blocks", ArrayType(StringType())), StructField("kinds", ArrayType(ByteType())),
                         StructField("asked", BooleanType()), StructField("out", BooleanType())])

    def read(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                found = [parse(x) if brings else None for x, brings in zip(part.column("__html").to_pylist(), part.column("brings").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in (*carry, "key", "host")], pa.array([p and p.blocks for p in found], pa.list_(pa.string())),
                     pa.array([p and p.kinds for p in found], pa.list_(pa.int8())),
                     pa.array([bool(p) and (OPEN in p.kinds or DOUBTFUL in p.kinds) for p in found], pa.bool_()), part.column("out")], names=schema.names)

    # the marks and white space of a page are at least about as many as its tokens
    near_n = F.length("__html") - F.length(F.translate("__html", " \t\r\n<", "")) + 1
    heads = written(pages.groupBy("host", "key").agg(F.count("*").alias("rows"), F.max(F.coalesce(near_n, F.lit(1))).alias("n")), "heads")
    repeated = written(heads.where("rows > 1").select("key", F.lit(True).alias("again")), "repeated")
    # every one of these hosts holds more than a shard, so they are few
    large = written(heads.groupBy("host").agg(F.sum("n").alias("size")).where(F.col("size") > shard).select("host", F.ceil(F.col("size") / shard).alias("shards")), "large")
    rows = pages.withColumns({"brings": F.lit(True), "out": F.lit(True)})
    if not repeated.isEmpty():
        # repeated rows travel without their page, which one more row brings
        one = (pages.join(repeated, "key", "left_semi").groupBy("key", "host").agg(F.first("__html").alias("__html"))
               .withColumns({"brings": F.lit(True), "out": F.lit(False)}))
        again = pages.join(repeated, "key", "left").withColumns({"brings": F.col("again").isNull(), "out": F.lit(True)})
        rows = again.withColumn("__html", F.when(F.col("brings"), F.col("__html"))).drop("again").unionByName(one, allowMissingColumns=True)

    def parsed(some: DataFrame) -> DataFrame:
        return some.select(*carry, "host", "__html", "key", "brings", "out").mapInArrow(read, schema)

    placed = (parsed(rows).join(F.broadcast(large), "host", "left")
              .withColumn("shard", F.pmod(F.xxhash64("key"), F.coalesce("shards", F.lit(1)))).withColumn("far", F.lit(None).cast("array<int>")))
    split = rows.where("brings").join(F.broadcast(large), "host", "left_semi")
    if not large.isEmpty():
        unsettled = written(parsed(split).where("asked").select("host").distinct(), "unsettled")
        if not unsettled.isEmpty():
            asking = parsed(split.join(F.broadcast(unsettled), "host", "left_semi")).select("key", "host", "blocks", "kinds", "asked")
            asking = written(asking.withColumn("row", F.monotonically_increasing_id()), "asking")
            far = written(_far(asking, run).join(asking.select("row", "key"), "row").select("key", "far"), "far")
            placed = placed.drop("far").join(far, "key", "left")

    def judge(group: pa.Table) -> pa.Table:
        blocks, kinds, far, keys = (group[c].to_pylist() for c in ("blocks", "kinds", "far", "key"))
        heads = [i for i, own in enumerate(blocks) if own is not None]
        flags = _covered([tokens_of(blocks[i]) for i in heads], run, [_inner(blocks[i], kinds[i]) for i in heads])
        texts = {}
        for i, covered in zip(heads, flags):
            if far[i]:
                covered[far[i]] = True
            texts[keys[i]] = _text(blocks[i], kinds[i], covered)
        out = group.filter(group["out"])
        return pa.table([*[out[c] for c in carry], pa.array([texts[k] for k in out["key"].to_pylist()], pa.string())], names=[*carry, "text"])

    return (placed.select(*carry, "key", "host", "shard", "blocks", "kinds", "out", "far").groupBy("host", "shard")
            .applyInArrow(judge, StructType([*fields, StructField("text", StringType())])))


def _far(pages: DataFrame, run: int) -> DataFrame:
    """(row, far) of the pages that ask: the places of their tokens that lie in a run on any other page of the host.

    A run is known by two 64-bit hashes of its tokens. Runs outside of articles ask for others such, as in ``_covered``.
    """
    def windows(batches):
        for batch in batches:
            blocks, kinds = batch.column("blocks").to_pylist(), batch.column("kinds").to_pylist()
            for words in words_of(pa.array([" ".join(f"{b} \x1c" for b in own) for own in blocks], pa.string())):
                page = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
                hashes = words.hashes()
                at = np.flatnonzero(words.bounds[1:][page] - np.arange(len(page)) >= run)
                inner = np.concatenate([_inner(blocks[words.first + i], kinds[words.first + i]) for i in range(len(words.bounds) - 1)])
                rows = pa.array(page[at] + words.first)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(rows) for c in ("host", "row", "asked")], pa.array((at - words.bounds[page[at]]).astype(np.int32)),
                     pa.array(grams(hashes, run)[at].view(np.int64)), pa.array(grams(hashes[::-1], run)[::-1][at].view(np.int64)), pa.array(_any_of_run(inner, run)[at])],
                    names=["host", "row", "asked", "place", "window", "back", "inner"])

    name = ["host", "window", "back"]
    every = pages.withColumn("host", F.xxhash64("host")).mapInArrow(windows, "host long, row long, asked boolean, place int, window long, back long, inner boolean")
    outer = F.when(~F.col("inner"), F.col("row"))
    shared = (every.groupBy(*name).agg(F.min("row").alias("a"), F.max("row").alias("b"), F.coalesce(F.min(outer) < F.max(outer), F.lit(False)).alias("outside"))
              .where("a < b").select(*name, "outside"))
    hits = every.where("asked").join(shared, name).where(F.col("inner") | F.col("outside")).groupBy("row").agg(F.collect_set("place").alias("places"))
    return hits.select("row", F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + run - 1)))).alias("far"))
