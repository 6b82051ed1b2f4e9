"""Order MinHash fingerprints with DataFrame functions only.

A text's k-mers are runs of ``K`` words (white-space-separated; of a word of more than 16 code points, as in text without
blanks, the overlapping pieces of four), numbered among equal ones. Their hashes fall into ``SLOTS`` slots; of each slot the ``TUPLE`` smallest
are kept, where it has fewer also those of the slots after it, put back into the order of the text and hashed as one tuple.
Words that change places change the tuple, so slots agree as far as texts agree up to edits. The likeness of two
fingerprints is the share of equal slots.

The next text comes from a window over buckets of ids; the first text of each bucket is also sent to
the bucket before it, so no window spans all rows.

A null text counts as empty and fills no slot; two empty texts have likeness 1. A text with fewer than
``K`` words is one k-mer. Texts of any length are read whole. Rows that repeat an id follow each
other in the order of their texts' hashes; rows with a null id come first. Ids must be whole numbers. The text after the last is the first, also
for a single row. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import landed, whole_number_key

K, SLOTS, TUPLE = 2, 32, 2
#: Code points of text for each bucket of ids, and the most buckets (a square).
BUCKET_CHARS, MOST_BUCKETS = 1 << 20, 1 << 16
#: A k-mer is packed as 33 bits of hash and 30 bits of place, which order by hash and then by place.
_PLACE_BITS, _HASH_BITS = 30, 33
#: Words of up to 16 code points, and in longer ones, such as text without blanks, the piece of four that begins at each place.
_WORDS = r"(?=((?<!\S)\S{1,16}(?!\S)|\S{4}))(?:(?<!\S)\S{1,16}(?!\S)|\S)"
_PLACE_MASK, _SLOT_SHIFT = (1 << _PLACE_BITS) - 1, _PLACE_BITS + _HASH_BITS - 5


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _span(first: Column, last: Column) -> Column:
    """first, first + 1, ..., last; empty where last is smaller."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, 64 - _HASH_BITS), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _heads(values: Column, group: Callable[[Column], Column]) -> Column:
    """Places in a sorted array where a group of values begins."""
    return F.filter(_span(F.lit(0), F.size(values) - 1), lambda j: (j == 0) | (group(F.get(values, j)) != group(F.get(values, j - 1))))


def _kmers(words: Column) -> Column:
    """Packed k-mers in order of hash and place."""
    last = F.when(F.size(words) > 0, F.greatest(F.size(words) - K, F.lit(0))).otherwise(F.lit(-1))
    return F.sort_array(F.transform(_span(F.lit(0), last), lambda i: _packed(F.xxhash64(*(F.get(words, i + step) for step in range(K))), i)))


def _numbered(kmers: Column) -> Column:
    """The same with the number among equal k-mers in the hash; the first of them keeps its hash."""

    def runs(heads: Column) -> Column:
        def run(head: Column, q: Column) -> Column:
            size = F.coalesce(F.get(heads, q + 1), F.size(kmers)) - head
            again = F.transform(
                F.sequence(F.lit(0), size - 1),
                lambda o: F.when(o == 0, F.get(kmers, head)).otherwise(
                    _packed(F.xxhash64(_hash(F.get(kmers, head)), o), F.get(kmers, head + o).bitwiseAND(F.lit(_PLACE_MASK)))
                ),
            )
            return F.when(size == 1, F.array(F.get(kmers, head))).otherwise(again)

        return F.flatten(F.transform(heads, run))

    return F.sort_array(_with(_heads(kmers, _hash), runs))


def _slots(kmers: Column) -> Column:
    """Hash of the tuple of each slot, -1 for all where there are no k-mers.

    A tuple begins with the first k-mer of its slot; what the slot lacks comes from the slots after it, the first after the
    last. So every tuple of a text with ``TUPLE`` k-mers has an order, however short the text.
    """

    def slot_of(packed: Column) -> Column:
        return F.shiftright(packed, _SLOT_SHIFT)

    def signature(start: Column) -> Column:
        size = F.size(kmers)
        least = [F.get(kmers, (start + t) % size) for t in range(TUPLE)]
        held = F.slice(F.array(*least), F.lit(1), F.least(size, F.lit(TUPLE)))
        placed = F.transform(held, lambda v: F.shiftleft(v.bitwiseAND(F.lit(_PLACE_MASK)), _HASH_BITS).bitwiseOR(_hash(v)))
        in_order = F.transform(F.sort_array(placed), lambda v: v.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))
        return F.xxhash64(in_order).bitwiseAND(F.lit(0xFFFFFFFF))

    def tuples(heads: Column) -> Column:
        filled = F.transform(heads, lambda h: slot_of(F.get(kmers, h)))
        starts = _with(
            filled,
            lambda slots: F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.coalesce(F.get(heads, F.size(F.filter(slots, lambda x: x < s))), F.lit(0))),
        )
        return F.transform(starts, signature)

    empty = F.array_repeat(F.lit(-1).cast("long"), SLOTS)
    return F.when(F.size(kmers) == 0, empty).otherwise(_with(_heads(kmers, slot_of), tuples))


def fingerprint(text: Column) -> Column:
    """The slots of a text as an array of ``SLOTS`` numbers."""
    words = F.regexp_extract_all(text, F.lit(_WORDS), F.lit(1))
    return _with(_with(_with(words, _kmers), _numbered), _slots)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those that one of two fingerprints fills, 1 where none does."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    filled = F.size(F.filter(pairs, lambda p: (p["a"] >= 0) | (p["b"] >= 0)))
    equal = F.size(F.filter(pairs, lambda p: (p["a"] >= 0) & (p["a"] == p["b"])))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


def written(slots: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for a slot, dashes for an empty one."""
    return F.array_join(F.transform(slots, lambda s: F.when(s < 0, F.lit("-" * 8)).otherwise(F.lower(F.lpad(F.hex(s), 8, "0")))), "")


def _bucketed(rows: DataFrame) -> DataFrame:
    """Rows with the number of their ``bucket``: ranges of ids with about equally many rows, in order."""
    total = rows.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    wide = ceil(sqrt(max(1, min(MOST_BUCKETS, ceil(total / BUCKET_CHARS)))))
    shares = [(i + 1) / wide**2 for i in range(wide**2)]
    cuts = rows.agg(F.percentile_approx("id", shares, max(10_000, 20 * wide**2)).alias("cuts")).first()["cuts"] or [0]

    def numbers(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    def below(limits: Column) -> Column:
        return F.size(F.filter(limits, lambda c: c < F.col("id")))

    # Two steps of a search: among every wide-th cut, then among the cuts between two of those.
    part = F.least(below(numbers(cuts[wide - 1 :: wide])), F.lit(wide - 1))
    inner = below(F.slice(numbers(cuts), F.col("part") * wide + 1, F.lit(wide)))
    placed = rows.withColumn("part", part).withColumn("bucket", F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.col("part") * wide + inner))
    return placed.drop("part")


def _with_next(rows: DataFrame) -> DataFrame:
    """Rows ``id, text, slots`` with ``next_text`` and ``next_slots`` of the row that follows."""
    placed = _bucketed(rows)
    firsts = landed(placed.groupBy("bucket").agg(F.min("id").alias("first")), "firsts")  # MOST_BUCKETS rows at most
    order = Window.orderBy("bucket")
    earlier = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    before = firsts.select(F.col("bucket").alias("own"), "first", earlier.alias("before"))
    placed = placed.join(F.broadcast(before), (F.col("bucket") == F.col("own")) & F.col("id").eqNullSafe(F.col("first")), "left")
    here = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    there = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.explode(F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there)))
    seated = placed.select("id", "text", "slots", seats.alias("seat"))
    follow = Window.partitionBy("seat.bucket").orderBy("seat.guest", "id", F.xxhash64("text"))
    return seated.select("id", "text", "slots", "seat", F.lead("text").over(follow).alias("next_text"), F.lead("slots").over(follow).alias("next_slots")).where(
        "not seat.guest"
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_chars, edited_sha256, both fingerprints, near_edited and near_next of every text.

    The edited text has its last quarter replaced by as many code points from the start of the next text.
    """
    whole_number_key(docs, key)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = _with_next(rows.withColumn("slots", fingerprint(F.col("text"))))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", n - cut), F.left("next_text", cut)))
    rows = rows.withColumn("edited_slots", fingerprint(F.col("edited")))
    return rows.select(
        F.col("id").alias(key),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("slots")).alias("fingerprint"),
        written(F.col("edited_slots")).alias("edited_fingerprint"),
        likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
        likeness(F.col("slots"), F.col("next_slots")).alias("near_next"),
    )
