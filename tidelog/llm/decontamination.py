"""Benchmark decontamination: BM25 over an inverted index of test items with block-max bounds.

The index holds, for every word of the test items, the items with the word's BM25 impact on them. Items
stand in blocks of ``BLOCK``; each word also has its largest impact in each block. Every training text
is cut into passages (two adjacent strides of words; a stride is as long as the longest item, so each
item fits into some passage) and every passage queries the index: the sums of the block maxima bound
the scores in a block, blocks whose bound is below all their items' thresholds are skipped, the others
are scored. An item's threshold is ``SCORE`` times the score of its own text. All items at or above it
are retrieved and then verified: of both the question's and the answer's five-word shingles a share of
``OVERLAP`` must stand in the passage; a question or answer with fewer words must stand there as a whole.
An item without fields of its own counts its first half as question. An item of fewer than ``LEAST``
words must stand word for word: both its fields as whole runs, or its whole text where it has none.

Items are indexed in shards of at most ``SHARD`` items, each with its own pass over the texts; word
statistics cover all items. Words are runs of ASCII letters, digits and non-ASCII characters of the lower-cased text;
each character of a script that is written without blanks (Han, kana, Thai, Lao, Tibetan, Burmese, Khmer
and others) is a word of its own, so its shingles are character n-grams, and the punctuation of these scripts separates words.

Null and empty texts match nothing; items with a null text or without a word are not indexed. Repeated rows and ties give a row each, equal items too; rows with a null id are reported
with it. Ids of both sides may have any type that text can hold. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import blocks, landed, mixed, ship, words_of

BLOCK, SHARD, LEAST = 4, 1024, 8
SCORE, OVERLAP, SHINGLE = 0.5, 0.5, 5
#: The usual BM25 parameters.
K1, B = 1.2, 0.75

_SEPARATORS = np.ones(256, dtype=bool)
_SEPARATORS[128:] = False
for _span in (b"09", b"AZ", b"az"):
    _SEPARATORS[_span[0] : _span[1] + 1] = False
_FACTOR = np.uint64(0x9FB21C651E98DF25)
#: Punctuation of the scripts without blanks and full-width punctuation; their characters.
_STOPS = "\u0e2f\u0e46\u0e4f\u0e5a\u0e5b\u0f04-\u0f14\u104a-\u104f\u17d4-\u17da\u3000-\u3004\u3008-\u3020\u3030\u303d-\u303f\u30a0\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65"
_UNSPACED = (
    "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u302f\u3031-\u303c\u3040-\u312f\u31a0-\u4dbf\u4e00-\ua4cf"
    "\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00016fe0-\U00018dff\U0001aff0-\U0001b2ff\U00020000-\U0003ffff"
)
_STOP, _CHARACTER = re.compile(f"[{_STOPS}]"), re.compile(f"[{_UNSPACED}]")
#: Bytes with which these characters begin in UTF-8.
_LEAD = re.compile(rb"[\xe0-\xea\xef\xf0]")


def _spaced(document: bytes) -> bytes:
    """The text with blanks around each character of a script without blanks."""
    if document.isascii() or not _LEAD.search(document):
        return document
    return _CHARACTER.sub(r" \g<0> ", _STOP.sub(" ", document.decode(errors="surrogateescape"))).encode(errors="surrogateescape")


def _split(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes, owner, _, _ = words_of([_spaced(d) for d in documents], _SEPARATORS)
    return hashes, owner


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of runs of ``size`` words, none where there are fewer."""
    if not 0 < size <= len(words):
        return np.zeros(0, dtype=np.uint64)
    joined = words[: len(words) - size + 1].copy()
    for step in range(1, size):
        joined = mixed(joined * _FACTOR + words[step : len(words) - size + 1 + step])
    return np.unique(joined)


def postings(items: DataFrame) -> DataFrame:
    """``item, word, impact``: the BM25 weight of each word of each item, with statistics over all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, held in blocks(batch.column(1)):
                hashes, owner = _split(held)
                length = np.bincount(owner, minlength=len(held))
                pairs, count = np.unique(np.column_stack([owner.astype(np.uint64), hashes]), axis=0, return_counts=True)
                row = pairs[:, 0].astype(np.int64)
                item = batch.column(0).slice(start, len(held)).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [item, pa.array(pairs[:, 1].astype(np.int64)), pa.array(count.astype(np.int64)), pa.array(length[row])], ["item", "word", "tf", "length"]
                )

    terms = landed(items.mapInArrow(run, "item long, word long, tf long, length long"), "terms")
    total = terms.select("item", "length").distinct().agg(F.count("*").alias("items"), F.avg("length").alias("mean"))
    frequency = terms.groupBy("word").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("items") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    saturated = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    weighted = terms.join(frequency, "word").join(F.broadcast(total))  # one row of totals
    return weighted.select("item", "word", "length", (idf * saturated).alias("impact"))


class Index:
    """One shard: words with their impacts by block, block maxima, and the items' thresholds and shingles."""

    def __init__(self, rows: list[tuple[str, str, str]], kind: str, words: np.ndarray, owners: np.ndarray, impacts: np.ndarray, halved: bool) -> None:
        # Item ids as text, and their type.
        self.names, self.kind = [name for name, _, _ in rows], kind
        parts = [(_split([q.encode()])[0], _split([a.encode()])[0]) for _, q, a in rows]
        short = [len(q) + len(a) < LEAST for q, a in parts]
        if halved:
            parts = [(np.concatenate([q, a]), a[:0]) if s else (q, a) for (q, a), s in zip(parts, short, strict=True)]
        # The size of each part's shingles, and the shingles: a part with fewer words than one, or of a short item, is a shingle itself.
        self.parts = [[(size := len(part) if s else min(SHINGLE, len(part)), shingles(part, size)) for part in pair] for pair, s in zip(parts, short, strict=True)]
        self.stride = max(32, *(len(q) + len(a) for q, a in parts))
        self.blocks = -(-len(rows) // BLOCK)
        self.words, place = np.unique(words, return_inverse=True)
        # Postings by word and block, with the impacts on the block's items side by side.
        self.keys, at = np.unique(place * self.blocks + owners // BLOCK, return_inverse=True)
        self.impacts = np.zeros((len(self.keys), BLOCK), dtype=np.float32)
        self.impacts[at, owners % BLOCK] = impacts
        self.maxima = np.zeros((len(self.words), self.blocks), dtype=np.float32)
        self.maxima[self.keys // self.blocks, self.keys % self.blocks] = self.impacts.max(axis=1)
        own = np.bincount(owners, weights=impacts, minlength=self.blocks * BLOCK)
        own[len(rows) :] = np.inf
        self.own = own.reshape(self.blocks, BLOCK)
        self.present = np.zeros(1 << 16, dtype=bool)
        self.present[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the index, -1 for none."""
        place = np.full(len(hashes), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.present[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, hashes[maybe]), len(self.words) - 1)
        hit = self.words[at] == hashes[maybe]
        place[maybe[hit]] = at[hit]
        return place

    def retrieve(self, passage: np.ndarray, word: np.ndarray) -> list[tuple[int, int, float]]:
        """Passage, item and share of the item's own score, for all that reach ``SCORE``.

        ``passage`` and ``word`` list the distinct known words of each passage, in order of the passage.
        """
        heads = np.flatnonzero(np.diff(passage, prepend=-1))
        ends = np.append(heads[1:], len(passage))
        found = []
        step = max(1, (4 << 20) // (self.blocks * 64))
        for begin in range(0, len(heads), step):
            first, last = heads[begin : begin + step], ends[begin : begin + step]
            low = first[0]
            bounds = np.add.reduceat(self.maxima[word[low : last[-1]]], first - low, axis=0)
            row, block = np.nonzero(bounds * 1.0001 >= SCORE * self.own.min(axis=1))
            if not len(row):
                continue
            size = (last - first)[row]
            inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            wanted = word[np.repeat(first[row], size) + inner] * self.blocks + np.repeat(block, size)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            held = np.where((self.keys[at] == wanted)[:, None], self.impacts[at], np.float32(0))
            share = np.add.reduceat(held, np.cumsum(size) - size, axis=0) / self.own[block]
            over, lane = np.nonzero(share * 1.0001 >= SCORE)
            found += zip(passage[first[row[over]]].tolist(), (block[over] * self.own.shape[1] + lane).tolist(), share[over, lane].tolist(), strict=True)
        return found

    def matches(self, documents: list[bytes]) -> list[tuple[int, int, float, float, float, int]]:
        """Text, item, share of the item's own score, both overlaps, first word: the best passage of each text and item."""
        hashes, owner = _split(documents)
        if not len(hashes) or not len(self.words):
            return []
        count = np.bincount(owner, minlength=len(documents))
        begins = np.cumsum(count) - count
        strides = -(-count // self.stride)
        first = np.cumsum(strides) - strides
        text_of = np.repeat(np.arange(len(documents)), strides)
        stride = first[owner] + (np.arange(len(hashes)) - begins[owner]) // self.stride
        place = self.lookup(hashes)
        known = np.flatnonzero(place >= 0)
        # Passage p holds the strides p and p + 1 of its text.
        own, back = stride[known], stride[known] - 1
        inside = (back >= 0) & (text_of[np.maximum(back, 0)] == text_of[own])
        keys = np.concatenate([own * len(self.words) + place[known], back[inside] * len(self.words) + place[known][inside]])
        keys.sort()
        keys = keys[np.flatnonzero(np.diff(keys, prepend=-1))]
        found: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        seen: dict[int, np.ndarray] = {}
        latest = -1
        for p, item, share in self.retrieve(keys // len(self.words), keys % len(self.words)):
            text = int(text_of[p])
            begin = int(begins[text] + (p - first[text]) * self.stride)
            if p != latest:
                seen, latest = {}, p
            for size in {size for size, _ in self.parts[item]} - seen.keys():
                seen[size] = shingles(hashes[begin : min(begin + 2 * self.stride, int(begins[text] + count[text]))], size)
            overlaps = [float(np.isin(part, seen[size], assume_unique=True).mean()) if size else 1.0 for size, part in self.parts[item]]
            if min(overlaps) >= OVERLAP:
                row = (share, *overlaps, begin - int(begins[text]))
                if row[:3] > found.get((text, item), (0.0,))[:3]:
                    found[text, item] = row
        return [(text, item, *row) for (text, item), row in sorted(found.items())]


def indexes(items: DataFrame, key: str = "item_id", text: str = "text", question: str | None = None, answer: str | None = None) -> Iterator[Broadcast]:
    """The shards of the index over all items, each with about ``SHARD`` items."""
    spark = ship(items.sparkSession)
    halved = not (question and answer)
    if not halved:
        asked, told = F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit(""))
    else:
        # The item's words in two halves: the first is the question.
        parts = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+"), F.lit(0))
        half = F.ceil(F.size(parts) / 2).cast("int")
        asked, told = F.array_join(F.slice(parts, F.lit(1), half), " "), F.array_join(F.slice(parts, half + 1, F.size(parts)), " ")
    tests = items.select(F.col(key).cast("string").alias("name"), F.lower(asked).alias("question"), F.lower(told).alias("answer"))
    tests = landed(tests.withColumn("item", F.monotonically_increasing_id()), "items")
    weights = landed(postings(tests.select("item", F.concat_ws(" ", "question", "answer").alias("text"))), "postings")
    shards = -(-tests.count() // SHARD)
    for shard in range(shards):
        mine = F.pmod(F.xxhash64("item"), F.lit(shards)) == shard
        # About SHARD items and their postings: bounded, whatever the number of items.
        terms = weights.where(mine).select("item", "word", "impact").orderBy("item", "word").toPandas()
        kept = set(terms["item"].tolist())
        held = [r for r in tests.where(mine).orderBy("item").collect() if r["item"] in kept]
        if held:
            number = {r["item"]: i for i, r in enumerate(held)}
            owners = terms["item"].map(number).to_numpy(dtype=np.int64)
            rows = [(r["name"], r["question"], r["answer"]) for r in held]
            yield spark.sparkContext.broadcast(Index(rows, dict(items.dtypes)[key], terms["word"].to_numpy().astype(np.uint64), owners, terms["impact"].to_numpy(), halved))


def contaminated(docs: DataFrame, shards: Iterable[Broadcast], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, item_id, score (share of the item's own), both overlaps and the passage's first word, for every text and item that match."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.lower(text).alias("text"))
    schema = f"id {dict(docs.dtypes)[key]}, item_id string, score double, question_overlap double, answer_overlap double, first_word long"
    found, kind = spark.createDataFrame([], schema), "long"
    for shard in shards:
        kind = shard.value.kind
        found = found.unionByName(rows.mapInArrow(_search(shard), schema))
    found = found.withColumn("item_id", F.col("item_id").cast(kind))
    return found.withColumnRenamed("id", key)


def clean(docs: DataFrame, shards: Iterable[Broadcast], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item matches, with their columns."""
    for shard in shards:
        docs = docs.where(~F.coalesce(_holds(shard)(F.lower(text)), F.lit(False)))
    return docs


def _holds(shared: Broadcast) -> Callable[[Column], Column]:
    @F.arrow_udf("boolean")
    def holds(column: pa.Array) -> pa.Array:
        hit = np.zeros(len(column), dtype=bool)
        for start, held in blocks(column):
            hit[[start + row[0] for row in shared.value.matches(held)]] = True
        return pa.array(hit)

    return holds


def _search(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for start, held in blocks(batch.column(1)):
                found = index.matches(held)
                if not found:
                    continue
                text, item, *rest = zip(*found, strict=True)
                names = pa.array([index.names[i] for i in item], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([start + t for t in text])), names, *(pa.array(r, pa.float64()) for r in rest[:3]), pa.array(rest[3], pa.int64())],
                    ["id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"],
                )

    return run
