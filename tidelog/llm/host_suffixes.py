"""Main text of pages: the marked article, or what suffix arrays over a host's pages leave as unique.

Markup decides where it can: text in an article or main element is the article, and menus, headers,
footers, sidebars, notices, adverts, forms and comments are furniture. The rest of a page without such
a container is settled by repetition, and so is a part of any article whose name only hints at furniture. The token streams of
all that may be furniture, on every page, are concatenated and a suffix array of
each bounded run of pages is sorted by prefix doubling up to ``LONG`` tokens; neighbours with a
common prefix of that length are a repeated substring. Its prefixes go out once per run, with their
number of pages, so one grouping by host and prefix counts the distinct pages anywhere
on the host, and no host's pages are ever gathered in one task.

A token's width is the largest number of pages that a repeated substring over it stands on. From the
widest down, tokens are boilerplate while the narrower ones make ``OWN`` of what is left of the page: then
the substring recurs on pages whose other text differs. Where less is narrower, the pages that share it are
copies but for a line or two, and it stays with all that is narrower still. Boilerplate is cut out of the
blocks; a piece of fewer than ``LONG`` tokens goes only with its whole block, because the end of a
substring from the next block may agree by chance. Of a hinted part, tokens are boilerplate where a repeated substring covers them;
a short one goes if it stands on another page as it is. The rest of an article is never cut: articles share lines, also
with the furniture of their host.

Null and empty pages give an empty text. Rows without a URL share one host, the empty one. Repeated
rows and rows without an id give a row each; a row never counts as two pages. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import landed, mixed, ship, texts, words_of
from tidelog.llm.components import key_filter, passes
from tidelog.llm.page_blocks import blocks_of

#: Tokens of a long substring (a power of two), and tokens whose suffixes are sorted together.
LONG, RUN = 8, 1 << 19
#: Share of a page's tokens up to some width that must be narrower for those of that width to be boilerplate.
OWN = 0.25
_BLOCK_TYPE = pa.list_(pa.struct([("text", pa.string()), ("furniture", pa.bool_())]))
_HINT_TYPE = pa.list_(pa.struct([("text", pa.string()), ("hint", pa.bool_())]))


def _read(pages: DataFrame) -> DataFrame:
    """``row, id, url, article`` (null where the page has no container), its blocks where one is ``hinted`` at (else null), and those ``outside`` it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                cut = batch.slice(start, 512)
                article, hinted, outside = [], [], []
                for html in texts(cut.column(3)):
                    found = blocks_of(html)
                    inner = [b for b in found if b.inside and not b.furniture]
                    article.append("\n".join(b.text for b in inner) if any(b.inside for b in found) else None)
                    hinted.append([{"text": b.text, "hint": b.hint} for b in inner] if any(b.hint for b in inner) else None)
                    outside.append([{"text": b.text, "furniture": b.furniture} for b in found if not b.inside])
                yield pa.RecordBatch.from_arrays([*cut.columns[:3], pa.array(article, pa.string()), pa.array(hinted, _HINT_TYPE), pa.array(outside, _BLOCK_TYPE)], ["row", "id", "url", "article", "hinted", "outside"])

    kind = dict(pages.dtypes)["id"]
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "id", "url", "html")
    return rows.mapInArrow(run, f"row long, id {kind}, url string, article string, hinted array<struct<text:string,hint:boolean>>, outside array<struct<text:string,furniture:boolean>>")


def prefix_names(tokens: np.ndarray, length: int) -> np.ndarray:
    """Prefix doubling: a name for the first ``length`` tokens (a power of two) of every suffix that has them.

    The name of 2n tokens comes from those of the two halves. Names are hashes instead of ranks, so that
    they agree between suffix arrays that are sorted apart.
    """
    names, step = tokens, 1
    while step < length and len(names) > step:
        names = mixed(names[:-step] * np.uint64(0x9FB21C651E98DF25) + names[step:])
        step *= 2
    return names if step == length else names[:0]


def _suffixes(streams: list[tuple[int, int, list[bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes of page streams (row, host hash, blocks): name of host and prefix, row, and place on the page.

    Suffixes that would run into the next page are left out.
    """
    tokens, owner, _, _ = words_of([b" ".join(b) for _, _, b in streams])
    rows = np.array([r for r, _, _ in streams], dtype=np.int64)
    hosts = np.array([h for _, h, _ in streams], dtype=np.int64).astype(np.uint64)
    names = prefix_names(tokens, LONG)
    own = owner[: len(names)]
    whole = np.flatnonzero(own == owner[len(owner) - len(names) :])
    place = np.arange(len(names)) - np.searchsorted(owner, own)
    return mixed(names[whole] ^ hosts[own[whole]]), rows[own[whole]], place[whole]


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Runs of page streams of about ``RUN`` tokens."""
    held, size = [], 0
    for batch in batches:
        for row, host, blocks in zip(*batch.columns, strict=True):
            data = [b["text"].encode() for b in blocks.as_py()]
            held.append((row.as_py(), host.as_py(), data))
            size += sum(b.count(b" ") + 1 for b in data)
            if size >= RUN:
                yield held
                held, size = [], 0
    if held:
        yield held


def _repeated(streams: DataFrame) -> DataFrame:
    """``key`` and number of ``pages`` of every host and prefix of ``LONG`` tokens that stands on two pages of the host or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _streams(batches):
            key, row, _ = _suffixes(held)
            if not len(key):
                continue
            # The suffix array by host and prefix: neighbours with equal names share a long substring.
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            first = np.append(True, key[1:] != key[:-1])
            heads = np.flatnonzero(first)
            first[1:] |= row[1:] != row[:-1]
            pages = np.add.reduceat(first.astype(np.int64), heads)
            yield pa.RecordBatch.from_arrays([pa.array(key[heads].astype(np.int64)), pa.array(pages)], ["key", "pages"])

    # A page is in one run only, so the runs' numbers add up to that of the distinct pages.
    found = streams.mapInArrow(run, "key long, pages long")
    return found.groupBy("key").agg(F.sum("pages").alias("pages")).where("pages > 1")


def _boilerplate(width: np.ndarray, is_open: np.ndarray) -> np.ndarray:
    """Which tokens of a page are boilerplate, by their widths and whether they stand outside furniture."""
    values, counts = np.unique(width[is_open], return_counts=True)
    up_to = np.cumsum(counts)
    least = None
    for i in range(len(values) - 1, 0, -1):
        if up_to[i - 1] < OWN * up_to[i]:
            break
        least = values[i]
    return width >= least if least is not None else np.zeros(len(width), dtype=bool)


def _uncut(text: str, hit: np.ndarray) -> str:
    """A block's text without its boilerplate tokens; pieces of fewer than ``LONG`` tokens stay if other tokens do."""
    if hit.all() or not hit.any():
        return "" if hit.all() else text
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
    stays = np.ones(len(hit), dtype=bool)
    for begin, end in zip(edges[::2], edges[1::2], strict=True):
        stays[begin:end] = end - begin < LONG
    return " ".join(w for w, s in zip(text.split(" "), stays, strict=True) if s)


def _left(rows: DataFrame, covered: DataFrame) -> DataFrame:
    """``row`` and ``text`` of pages without a container: what repetition leaves of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for outside, places in zip(*batch.columns[1:], strict=True):
                found = outside.as_py()
                counts = [b["text"].count(" ") + 1 for b in found]
                width = np.zeros(sum(counts), dtype=np.int64)
                if places.is_valid:
                    at, pages = (places.values.field(f).to_numpy() for f in ("place", "pages"))
                    for step in range(LONG):
                        width[at + step] = np.maximum(width[at + step], pages)
                hit = _boilerplate(width, np.repeat([not b["furniture"] for b in found], counts).astype(bool))
                ends = np.cumsum(counts)
                open_blocks = [(b["text"], hit[e - c : e]) for b, c, e in zip(found, counts, ends, strict=True) if not b["furniture"]]
                out.append("\n".join(filter(None, (_uncut(t, h) for t, h in open_blocks))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])

    joined = rows.join(covered, "row", "left").select("row", "outside", "places")
    return joined.mapInArrow(run, "row long, text string")


def _cut_hints(rows: DataFrame, covered: DataFrame) -> DataFrame:
    """``row``, ``host`` and the ``hinted`` blocks of articles without what repetition covers of those that are hinted at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hinted, places in zip(*batch.columns[2:], strict=True):
                found = hinted.as_py()
                hit = np.zeros(sum(b["text"].count(" ") + 1 for b in found if b["hint"]) + LONG, dtype=bool)
                for at in places.as_py() or ():
                    hit[at : at + LONG] = True
                end, left = 0, []
                for b in found:
                    text = b["text"]
                    if b["hint"]:
                        begin, end = end, end + text.count(" ") + 1
                        text = _uncut(text, hit[begin:end])
                    if text:
                        left.append({"text": text, "hint": b["hint"]})
                out.append(left)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, _HINT_TYPE)], ["row", "host", "hinted"])

    joined = rows.join(covered, "row", "left").select("row", "host", "hinted", "places")
    return joined.mapInArrow(run, "row long, host long, hinted array<struct<text:string,hint:boolean>>")


def _without_repeated_hints(rows: DataFrame) -> DataFrame:
    """``row`` and ``text`` of articles with hints: a block whose name hints at furniture goes if it stands on another page of the host too."""
    blocks = rows.select("row", "host", F.posexplode("hinted").alias("place", "block"))
    named = blocks.select("row", "host", "place", "block.text", "block.hint", F.xxhash64("block.text").alias("print"))
    on = named.where("hint").select("row", "host", "print").distinct().groupBy("host", "print").agg(F.count("*").alias("pages"))
    left = named.join(on.where("pages > 1"), ["host", "print"], "left").where(~F.col("hint") | F.col("pages").isNull())
    kept = left.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("kept"))
    return kept.select("row", F.array_join(F.transform("kept", lambda b: b["text"]), "\n").alias("cut"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, url, text and n_chars for every page."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    read = landed(_read(rows), "pages")
    host = F.xxhash64(F.coalesce(F.regexp_extract(F.lower("url"), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))
    text_of, empty = lambda b: F.struct(b["text"].alias("text")), F.array().cast("array<struct<text:string>>")
    hints = F.transform(F.filter("hinted", lambda b: b["hint"]), text_of)
    blocks = F.concat(F.transform("outside", text_of), F.coalesce(hints, empty))
    streams = read.select("row", host.alias("host"), blocks.alias("blocks")).where(F.size("blocks") > 0)
    # Pages whose text markup does not settle, and articles with parts that it only hints at; the streams of all pages tell
    # what repeats on them.
    unsettled = read.where("article is null").select("row", host.alias("host"), "outside")
    settled = read.where("article is not null and hinted is null").select("row", "id", "url", F.col("article").alias("text"))
    repeated = landed(_repeated(streams), "repeated")
    bitmap = key_filter(repeated, "key")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _streams(batches):
            keys, row, place = _suffixes(held)
            likely = passes(bitmap.value, keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys[likely].astype(np.int64)), pa.array(row[likely]), pa.array(place[likely])], ["key", "row", "place"])

    def covering(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(places, "key long, row long, place long").join(repeated, "key")

    doubtful = read.where("hinted is not null").select("row", host.alias("host"), "hinted")
    covered = covering(doubtful.select("row", "host", hints.alias("blocks"))).groupBy("row").agg(F.collect_list("place").alias("places"))
    left = _without_repeated_hints(_cut_hints(doubtful, covered))
    hinted = read.where("hinted is not null").select("row", "id", "url").join(left, "row", "left")
    settled = settled.unionByName(hinted.select("row", "id", "url", F.coalesce("cut", F.lit("")).alias("text")))
    covered = covering(unsettled).groupBy("row").agg(F.collect_list(F.struct("place", "pages")).alias("places"))
    left = _left(unsettled, covered)
    named = read.where("article is null").select("row", "id", "url")
    result = settled.unionByName(named.join(left, "row"))
    return result.select(F.col("id").alias(key), "url", "text", F.length("text").cast("long").alias("n_chars"))
