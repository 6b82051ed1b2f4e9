"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). Where a token of A
and one of B end at the same byte the two are linked, and the text is cut into groups there. A
corpus-wide count of linked id pairs then tells for every link whether its pair is the commonest of its B id.

The merge runs in lockstep. The texts of a block are laid end to end and cut into lanes of ``LANE``
bytes; a lane owns the token ends inside its bytes, so one lane of a text needs nothing from another and a very long text is
many lanes. One NumPy vector holds every lane's pair of pointers. A step compares the two token ends of all
lanes, emits a link and cut where they agree, moves the pointer of the smaller end (both if
equal), and lanes that have run out of tokens are compacted away.

Counting is a job over blocks of texts (``BLOCK`` bytes, a longer text alone): a block keeps its
distinct pairs once and links as numbers into that list. Pairs meet their corpus-wide counts in one
shuffle, where a pair occurs once per block however often it stands in it, and go back to their block
in another. No table of pairs is broadcast or held whole.

Null and empty texts have no tokens, nor do texts whose joined token bytes of A or B differ from a
blank and the text (B changes some texts): all numbers are 0 and the groups an empty text. Special
strings inside texts are plain text. Rows are independent: ties, repeated rows and null keys give a row each and
count each time, an empty table gives an empty one. Texts are read whole. Columns other than the key
and the text are ignored; keys of any type are carried along.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import landed, ship
from tidelog.llm.merges import byte_letters
from tidelog.llm.splitting import splitter
from tidelog.llm.token_prefixes import WORDS

#: Bytes of text that a block of the counting job and a lane of the merge hold.
BLOCK, LANE = 1 << 19, 1 << 10
#: Distinct words whose tokens a worker keeps before it starts again.
CACHE = 150_000
#: Bytes of a row group of the table of blocks; readers and writers hold one at a time.
ROW_GROUP = 16 << 20


class ByteTokens(dict):
    """Token ids of words, as bytes, in a byte-level vocabulary, worked out when first asked for."""

    def __init__(self, content: bytes) -> None:
        from tiktoken import Encoding

        model = json.loads(content)["model"]
        letters = {c: b for b, c in byte_letters().items()}
        self.bytes = [b""] * (1 + max(model["vocab"].values()))
        for token, i in model["vocab"].items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)
        # Single bytes come first, then tokens in the order of the merges that make them.
        order = [c for c in letters if c in model["vocab"]]
        order += ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        order = [model["vocab"][t] for t in dict.fromkeys(order)]
        self._ids = np.array(order, dtype=np.uint32)
        # Each word is one piece: the pattern takes it whole.
        ranks = {self.bytes[i]: rank for rank, i in enumerate(order)}
        self._merge = Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._words = splitter(WORDS)

    def __missing__(self, word: str) -> bytes:
        ids = self._ids[self._merge(word)].tobytes()
        self[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a blank and each text; the words are the text cut up, so their bytes are always the text's."""
        if len(self) > CACHE:
            self.clear()
        look = self.__getitem__
        return [np.frombuffer(b"".join(map(look, self._words(" " + t))), dtype=np.uint32) for t in texts]


class PieceTokens:
    """Token ids of texts in a piece vocabulary, which puts a blank before each text."""

    def __init__(self, content: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_proto=content)
        self.bytes = []
        for i in range(self._model.vocab_size()):
            piece = self._model.id_to_piece(i)
            if self._model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self._model.is_control(i) or self._model.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, none where their bytes are not a blank and the text."""
        out, spelled = [], self.bytes.__getitem__
        for text in texts:
            ids = self._model.encode(text)
            if b"".join(map(spelled, ids)) != b" " + text.encode():
                ids = []
            out.append(np.array(ids, dtype=np.uint32))
        return out


class Pair:
    """Both vocabularies and what the merge needs of them."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        self.size_a, self.size_b = (np.array([len(t) for t in side.bytes], dtype=np.int64) for side in (self.a, self.b))
        # How an id is written where a token, a side of a group, or a group follows.
        n = max(len(self.size_a), len(self.size_b))
        self.written = [str(i) + mark for i in range(n) for mark in ",|;"]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text in A and in B; none where the bytes of B differ from the text's."""
        a, b = self.a.encode(texts), self.b.encode(texts)
        none = np.zeros(0, dtype=np.uint32)
        unequal = [not text or not len(right) for text, right in zip(texts, b, strict=True)]
        return tuple([none if skip else ids for skip, ids in zip(unequal, side, strict=True)] for side in (a, b))


@lru_cache(maxsize=2)
def pair_of(a: bytes, b: bytes) -> Pair:
    return Pair(a, b)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and of B that end at the same byte, in order; ends are ascending."""
    none = np.zeros(0, dtype=np.int64)
    if not len(ends_a) or not len(ends_b):
        return none, none
    borders = np.arange(0, max(ends_a[-1], ends_b[-1]) + lane, lane)
    first_a, first_b = np.searchsorted(ends_a, borders, side="right"), np.searchsorted(ends_b, borders, side="right")
    at_a, stop_a, at_b, stop_b = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    linked_a, linked_b = [none], [none]
    going = (at_a < stop_a) & (at_b < stop_b)
    while going.any():
        at_a, stop_a, at_b, stop_b = at_a[going], stop_a[going], at_b[going], stop_b[going]
        here_a, here_b = ends_a[at_a], ends_b[at_b]
        same = here_a == here_b
        linked_a.append(at_a[same])
        linked_b.append(at_b[same])
        at_a, at_b = at_a + (here_a <= here_b), at_b + (here_b <= here_a)
        going = (at_a < stop_a) & (at_b < stop_b)
    return np.sort(np.concatenate(linked_a)), np.sort(np.concatenate(linked_b))


class Aligned:
    """The tokens of several texts, laid end to end, and their links."""

    def __init__(self, pair: Pair, texts: list[str]) -> None:
        self._pair = pair
        ids = pair.encode(texts)
        self.n_a, self.n_b = (np.array([len(t) for t in side], dtype=np.int64) for side in ids)
        self.a, self.b = (np.concatenate(side).astype(np.int64) if side else np.zeros(0, dtype=np.int64) for side in ids)
        self.at_a, self.at_b = lockstep(np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b]))
        # Both sides of a text have the same bytes, so its last tokens are always linked.
        self.n_links = np.diff(np.searchsorted(self.at_a, np.concatenate(([0], np.cumsum(self.n_a)))))

    def groups(self) -> list[str]:
        """For each text its groups of ids, written ``a1,a2|b1;a3|b2``."""
        last_a, last_b = np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64)
        last_a[self.at_a], last_b[self.at_b] = 1, 2
        # A token's place: its own number and that of the other side's tokens before it, group by group.
        group_a, group_b = np.cumsum(last_a) - last_a, (np.cumsum(last_b) - last_b) // 2
        ends_a, ends_b = np.concatenate((self.at_a + 1, [len(self.a)])), np.concatenate(([0], self.at_b + 1))
        place_a, place_b = np.arange(len(self.a)) + ends_b[group_a], np.arange(len(self.b)) + ends_a[group_b]
        order = np.zeros(len(self.a) + len(self.b), dtype=np.int64)
        order[place_a], order[place_b] = self.a * 3 + last_a, self.b * 3 + last_b
        written, look, at = [], self._pair.written.__getitem__, 0
        for n in (self.n_a + self.n_b).tolist():
            written.append("".join(map(look, order[at : at + n].tolist()))[:-1])
            at += n
        return written


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of consecutive rows with about ``BLOCK`` bytes."""
    for batch in batches:
        start, held, size = 0, [], 0
        for i, value in enumerate(batch.column(1)):
            held.append(value.as_py() or "")
            size += len(held[-1])
            if size >= BLOCK:
                yield batch.column(0).slice(start, i + 1 - start), held
                start, held, size = i + 1, [], 0
        if held:
            yield batch.column(0).slice(start, len(held)), held


def aligned(df: DataFrame, a: bytes, b: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the ids of both sides, and links: the 0-based numbers of the tokens of A and of B that end together.

    ``links_a[i]`` and ``links_b[i]`` are one link and end one group.
    """
    shared = ship(df.sparkSession).sparkContext.broadcast((a, b))  # two vocabulary files, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*shared.value)

        def lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int32()))

        for keys, texts in _blocks(batches):
            found = Aligned(pair, texts)
            before_a, before_b = (np.repeat(np.cumsum(n) - n, found.n_links) for n in (found.n_a, found.n_b))
            columns = [keys, lists(found.a, found.n_a), lists(found.b, found.n_b), lists(found.at_a - before_a, found.n_links), lists(found.at_b - before_b, found.n_links)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids_a", "ids_b", "links_a", "links_b"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {dict(df.dtypes)[key]}, ids_a array<int>, ids_b array<int>, links_a array<int>, links_b array<int>"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _block_table(df: DataFrame, a: bytes, b: bytes, key: str, text: str) -> DataFrame:
    """A row per block: per text its key, counts, digest of groups and links, and the block's distinct pairs and their counts.

    ``links`` are numbers into ``pairs``, of all texts one after the other; a pair is ``a << 32 | b``.
    """
    shared = ship(df.sparkSession).sparkContext.broadcast((a, b))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*shared.value)
        names = ["keys", "n_a", "n_b", "n_links", "groups_sha256", "links", "pairs", "counts"]

        def one(values) -> pa.Array:
            values = values if isinstance(values, pa.Array) else pa.array(values)
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        for keys, texts in _blocks(batches):
            found = Aligned(pair, texts)
            pairs, links, counts = np.unique(found.a[found.at_a] << 32 | found.b[found.at_b], return_inverse=True, return_counts=True)
            digests = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups()])
            numbers = found.n_a, found.n_b, found.n_links, digests, links.astype(np.int32), pairs, counts
            yield pa.RecordBatch.from_arrays([one(keys), *map(one, numbers)], names)

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    longs = ", ".join(f"{n} array<long>" for n in ("n_a", "n_b", "n_links"))
    schema = f"keys array<{kind}>, {longs}, groups_sha256 array<string>, links array<int>, pairs array<long>, counts array<long>"
    return rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, how often it is linked in the corpus (n), and whether no pair of its B id is linked oftener (best)."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = counts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    # One B id has no more partners than the vocabulary of A has ids.
    most = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1)))
    return counts.withColumn("best", F.col("n") == most)


def statistics(df: DataFrame, a: bytes, b: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text."""
    kind = dict(df.dtypes)[key]
    blocks = landed(_block_table(df, a, b, key, text), "aligned", {"parquet.block.size": ROW_GROUP})
    asked = blocks.select("block", F.posexplode("pairs").alias("number", "pair"))
    found = asked.join(pair_counts(blocks), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("number", "n", "best"))).alias("found"))
    found = found.select("block", F.transform("found", lambda p: p["n"]).alias("n"), F.transform("found", lambda p: p["best"]).alias("best"))
    rows = blocks.select("block", "keys", "n_a", "n_b", "n_links", "groups_sha256", "links").join(found, "block", "left").drop("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n_a, n_b, n_links, digests, links, n, best = (
                    column.slice(i, 1).flatten() for column in batch.columns
                )
                ends = np.concatenate(([0], np.cumsum(n_links.to_numpy())))
                links = links.to_numpy()

                def sums(values: np.ndarray, ends: np.ndarray = ends, links: np.ndarray = links) -> pa.Array:
                    before = np.concatenate(([0], np.cumsum(values[links])))
                    return pa.array(np.diff(before[ends]), pa.int64())

                n_best = sums(best.to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([keys, n_a, n_b, n_links, n_links, n_best, sums(n.to_numpy()), digests], names)

    longs = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return rows.mapInArrow(run, f"key {kind}, {longs}, groups_sha256 string").withColumnRenamed("key", key)
