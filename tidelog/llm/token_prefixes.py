"""Exact token counts at every prefix of a text, by dynamic programming over token ends.

Merging has one property that makes prefixes cheap: the encoding of a word ends in exactly one token
that is compatible with the encoding of what stands before it. So the last token of every prefix
follows from those of shorter prefixes, and count[i] = count[i - len(token)] + 1. The tables of
distinct words are kept (up to ``CACHE`` of them in a worker); a text only adds up their ends.

``prefix_store`` keeps for each text where its words end and how many tokens stand before. A token
limit is then a search in that list, and only the last word's table is looked at again.

Null and empty texts have no tokens. Texts of any length are read whole, in time linear in their
length. Rows are independent: ties and repeated rows give a row each, an empty table an empty one.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ship, texts
from tidelog.llm.merges import Vocabulary, vocabulary
from tidelog.llm.splitting import splitter

#: Distinct words whose counts a worker keeps.
CACHE = 600_000
#: Fixed value: how the byte-level vocabularies split text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[LETTER]+| ?[DIGIT]+| ?[^BLANKLETTERDIGIT]+|[BLANK]+(?![^BLANK])|[BLANK]+"""


class WordCounts(dict):
    """Token count of each word asked for; a word not known yet is worked out."""

    def __init__(self, known: Vocabulary) -> None:
        self._known = known
        self._seams: dict[int, bool] = {}
        for special in known.specials:
            self[special] = 1

    def __missing__(self, word: str) -> int:
        n = self.prefixes(word)[-1]
        if len(self) < CACHE:
            self[word] = n
        return n

    def prefixes(self, word: str) -> list[int]:
        """Token counts of the word's first 0, 1, 2, ... bytes."""
        known, seams, letters = self._known, self._seams, word.encode("utf-8", "surrogatepass")
        child, token_at, n = known.child.get, known.token_at, len(letters)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            before, node = last[start], 0
            for end in range(start, n):
                node = child(node << 9 | letters[end])
                if node is None:
                    break
                token = token_at[node]
                if token < 0 or last[end + 1] >= 0:
                    continue
                if start:
                    seam = before << 20 | token
                    fits = seams.get(seam)
                    if fits is None:
                        if len(seams) >= CACHE:
                            seams.clear()
                        fits = seams[seam] = known.compatible(before, token)
                    if not fits:
                        continue
                last[end + 1], count[end + 1] = token, count[start] + 1
        return count


@lru_cache(maxsize=4)
def word_counts(content: bytes) -> WordCounts:
    return WordCounts(vocabulary(content))


class TextCounter:
    """Splits texts as the vocabulary does, special strings first, and counts their tokens."""

    def __init__(self, content: bytes) -> None:
        self.counts = word_counts(content)
        self._specials = list(vocabulary(content).specials)
        self._special = regex.compile("|".join(map(regex.escape, self._specials)) or "(?!)")
        self._words = splitter(WORDS)

    def words(self, text: str) -> list[str]:
        if not any(s in text for s in self._specials):
            return self._words(text)
        found, at = [], 0
        for m in self._special.finditer(text):
            found += [*self._words(text[at : m.start()]), m[0]]
            at = m.end()
        return found + self._words(text[at:])

    def total(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.words(text)))

    def store(self, text: str) -> tuple[list[int], list[int]]:
        """For each word its end in code points and the tokens up to there."""
        words = self.words(text)
        return list(accumulate(map(len, words))), list(accumulate(map(self.counts.__getitem__, words)))

    def at(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Token count of the first ``length`` code points.

        A cut changes how the word it falls into and the white space before it (two words at most) are
        split, never what stands before them, so only those are looked at again.
        """
        k = max(0, bisect_right(ends, length) - 2)
        begin, before = (ends[k - 1], counts[k - 1]) if k else (0, 0)
        return before + self.total(text[begin:length])

    def fitting(self, text: str, ends: list[int], counts: list[int], limit: int) -> int:
        """Code points of the longest run of whole words from the start that has at most ``limit`` tokens."""
        k = bisect_right(counts, limit)
        return ends[k - 1] if k else 0


def count_tokens(df: DataFrame, content: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes and n_tokens of each text, for a vocabulary file's content."""
    shared = ship(df.sparkSession).sparkContext.broadcast(content)  # one vocabulary file, a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter(shared.value)
        for batch in batches:
            n = [counter.total(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["key", "n_bytes", "n_tokens"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(df.dtypes)[key]
    return rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long").withColumnRenamed("key", key)


def prefix_store(df: DataFrame, content: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the text, and for each of its words the end in code points and the tokens up to there."""
    shared = ship(df.sparkSession).sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter(shared.value)
        for batch in batches:
            for i, value in enumerate(texts(batch.column(1))):
                ends, counts = counter.store(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([value]), pa.array([ends], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))],
                    ["key", "text", "ends", "counts"],
                )

    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, text string, ends array<long>, counts array<long>").withColumnRenamed("key", key)


def truncated(store: DataFrame, limit: int) -> DataFrame:
    """Each text of a prefix store cut after the last whole word that keeps it within ``limit`` tokens."""
    n = F.size(F.filter("counts", lambda c: c <= limit))
    kept = F.when(n > 0, F.substring("text", F.lit(1), F.element_at("ends", n).cast("int"))).otherwise("")
    return store.withColumns({"text": kept, "n_tokens": F.when(n > 0, F.element_at("counts", n)).otherwise(F.lit(0))}).drop("ends", "counts")
