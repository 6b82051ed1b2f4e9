"""Byte-pair encoding by speculation: guess by longest match, test all seams at once, merge what fails.

For each word not seen before, the longest matching tokens from the left are proposed. A sequence is
the exact encoding if and only if every adjacent pair of its tokens is compatible (merging the letters
of both gives the two back), so all seams of a batch are tested together as arrays, each distinct pair
once. Words with a seam that fails, and no others, are merged exactly.

Null and empty texts have no ids and decode to the empty text. Texts of any length are encoded whole.
Rows are independent: ties and repeated rows give a row each, an empty table an empty one. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ship, texts
from tidelog.llm.merges import Vocabulary, vocabulary
from tidelog.llm.splitting import splitter

#: Distinct words whose ids a worker keeps.
CACHE = 600_000
#: Code points of text whose words are encoded together.
BATCH = 4 << 20
#: Fixed value: how the vocabulary splits normalised text into words; what lies between is dropped.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[LETTER]+|[DIGIT]|[^BLANKLETTERDIGIT]+"""


class Encoder:
    """Encodes and decodes texts as the vocabulary's own library does."""

    def __init__(self, known: Vocabulary) -> None:
        self.known = known
        self.ids: dict[str, bytes] = {s: np.uint32(i).astype("<u4").tobytes() for s, i in known.specials.items()}
        self._fresh = dict(self.ids)
        self._seams = np.zeros(0, dtype=np.int64)
        self._fits = np.zeros(0, dtype=bool)
        self._special = regex.compile("|".join(map(regex.escape, known.specials)) or "(?!)")
        self._words = splitter(WORDS)

    def words(self, text: str) -> list[str]:
        """Special strings of the raw text, and the words of the normalised text between them."""
        if not any(s in text for s in self.known.specials):
            return self._plain(text)
        found, at = [], 0
        for m in self._special.finditer(text):
            found += [*self._plain(text[at : m.start()]), m[0]]
            at = m.end()
        return found + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        # Lower case letter by letter: the final form of sigma depends on the context and is not wanted.
        return self._words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def propose(self, word: str) -> list[int] | None:
        """Longest matching tokens from the left; None where the vocabulary has no match."""
        known, letters = self.known, word.encode("utf-8", "surrogatepass")
        child, token_at, last_at, n = known.child.get, known.token_at, known.last_at, len(letters)
        at, found = 0, []
        while at < n:
            node, best, past = 0, -1, at
            for end in range(at, n):
                node = child(node << 9 | letters[end])
                if node is None:
                    break
                token = token_at[node] if end < n - 1 else last_at[node]
                if token >= 0:
                    best, past = token, end + 1
            if best < 0:
                return None
            found.append(best)
            at = past
        return found

    def learn(self, words: list[str]) -> None:
        """Work out the ids of new words together."""
        proposals = [self.propose(w) for w in words]
        sizes = np.array([len(p) if p else 0 for p in proposals], dtype=np.int64)
        flat = np.array([t for p in proposals if p for t in p], dtype=np.int64)
        good = sizes > 0
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), sizes)
            inner = owner[1:] == owner[:-1]
            fits = self._fitting(flat[:-1][inner], flat[1:][inner])
            good[owner[1:][inner][~fits]] = False
        data = flat.astype("<u4").tobytes()
        ends = np.cumsum(sizes) * 4
        for word, ok, size, end in zip(words, good.tolist(), (sizes * 4).tolist(), ends.tolist(), strict=True):
            self.ids[word] = data[end - size : end] if ok else np.array(self.exact(word), dtype="<u4").tobytes()

    def exact(self, word: str) -> list[int]:
        return self.known.merge(self.known.symbols(self.known.spelled(word) + self.known.suffix))

    def _fitting(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 20 | b
        if len(self._seams):
            i = np.minimum(np.searchsorted(self._seams, pair), len(self._seams) - 1)
            missing = np.unique(pair[self._seams[i] != pair])
        else:
            missing = np.unique(pair)
        if len(missing):
            fits = self.known.all_compatible(missing >> 20, missing & ((1 << 20) - 1))
            seams, both = np.concatenate((self._seams, missing)), np.concatenate((self._fits, fits))
            order = np.argsort(seams, kind="stable")
            self._seams, self._fits = seams[order], both[order]
        return self._fits[np.searchsorted(self._seams, pair)]

    def encode(self, many: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.words(t) for t in many]
        if len(self.ids) > CACHE:
            self.ids = dict(self._fresh)
        new = set().union(*split).difference(self.ids)
        if new:
            self.learn(list(new))
        look = self.ids.__getitem__
        return [b"".join(map(look, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a blank between, as a vocabulary without a decoder has it."""
        return " ".join(map(self.known.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def encoder(content: bytes) -> Encoder:
    return Encoder(vocabulary(content))


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, held, size = 0, [], 0
    for i, text in enumerate(texts(column)):
        held.append(text)
        size += len(text)
        if size >= BATCH:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def encode(df: DataFrame, content: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the token ids of each text, for a vocabulary file's content."""
    shared = ship(df.sparkSession).sparkContext.broadcast(content)  # one vocabulary file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            for start, held in _groups(batch.column(1)):
                coded = coder.encode(held)
                offsets = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(held)), pa.ListArray.from_arrays(pa.array(offsets), ids)], ["key", "ids"])

    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, content: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text that the token ids stand for; null ids give the empty text."""
    shared = ship(df.sparkSession).sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            out = [coder.decode(np.array(v.as_py() or [], dtype="<u4").tobytes()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])

    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(df: DataFrame, content: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, and digests of the ids and of the text decoded from them, in one pass over the texts."""
    shared = ship(df.sparkSession).sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            for start, held in _groups(batch.column(1)):
                coded = coder.encode(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(held)),
                        pa.array([len(c) // 4 for c in coded], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                        pa.array([hashlib.sha256(coder.decode(c).encode()).hexdigest() for c in coded]),
                    ],
                    ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
