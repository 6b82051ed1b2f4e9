"""Near-duplicate documents by MinHash with tensored banding, and their components.

Two collections of ``HALF`` short keys (``WIDTH`` minima each) are computed per document; every pair of
a key of the first and a key of the second names one table. So HALF * HALF tables of 2 * WIDTH minima
cost 2 * HALF * WIDTH minima instead of HALF times as many. Two documents of similarity s share no table with
chance 2 (1 - s^WIDTH)^HALF at most: 7e-5 at 0.8, 2e-6 at 0.85.

Documents with equal shingle sets form a class first and go on as one. In each bucket, split by set
size, every class is compared with the first one. Buckets whose classes are then still in different
components go on with the classes that can have a link at all (enough of their shingles stand in
others). These are compared with the most central class of their group. What that leaves apart meets by its rarest
shingles (prefix filtering), so a template that very many texts share brings no two of them together; pairs across
components that share a table and that sizes and sketches allow are compared, each pair once. Each candidate pair is confirmed on the full shingle sets.

Null texts, empty texts and texts without words have an empty set and are linked with nothing. Rows
that repeat an id are rows of one document: each gets its row, and the smallest id names a component.
Rows with a null id are left out of groups and are kept. Ids must be whole numbers. An empty table gives an empty result. Columns other than
id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import blocks, landed, mixed, ship, whole_number_key, words_of
from tidelog.llm.components import components, key_filter, passes

#: Keys in each of the two collections, and minima in a key.
HALF, WIDTH = 10, 2
#: Bits kept of each minimum in the sketch, and how many may differ between near documents. At
#: similarity 0.8 the mean is 24 of 240 and more than 72 has a chance below 1e-6.
_BITS, _FAR = 6, 72
#: A finer sketch for classes that are still apart: minima, their bits, and how many of all bits may
#: differ. At similarity 0.8 the mean is 51 of 512, and more than 106 has a chance below 1e-6.
_FINE, _FINE_BITS, _FINE_FAR = 128, 4, 106
_FUNCTIONS = 2 * HALF * WIDTH
_FACTORS = mixed(np.arange(1, _FUNCTIONS + _FINE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_FIRST, _SECOND = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(documents: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text with fewer words is one shingle."""
    hashes, owner, _, _ = words_of(documents)
    bounds = np.searchsorted(owner, np.arange(len(documents) + 1))
    joined = hashes.copy()
    for step in range(1, size):
        joined[:-step] = mixed(joined[:-step] * _FIRST + hashes[step:] * _SECOND)
    sets = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - begin >= size:
            sets.append(np.unique(joined[begin : end - size + 1]))
        elif end > begin:
            whole = np.array([end - begin], dtype=np.uint64)
            for i in range(begin, end):
                whole = mixed(whole * _FIRST + hashes[i : i + 1] * _SECOND + np.uint64(1))
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _minima(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each of some non-empty sets."""
    every = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    begins = np.cumsum(sizes) - sizes
    minima = np.empty((len(sets), len(factors)), dtype=np.uint64)
    for i, factor in enumerate(factors):
        value = every * factor
        value ^= value >> np.uint64(32)
        value *= _SECOND
        minima[:, i] = np.minimum.reduceat(value, begins)
    return mixed(minima)


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The lowest bits of the minima, side by side in 64-bit numbers."""
    per = 64 // bits
    low = minima & np.uint64((1 << bits) - 1)
    parts = [low[:, k : k + per] << (np.arange(low[:, k : k + per].shape[1], dtype=np.uint64) * np.uint64(bits)) for k in range(0, low.shape[1], per)]
    return np.column_stack([np.bitwise_or.reduce(p, axis=1) for p in parts])


def _sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty sets: two fingerprints (n x 2), the short keys (n x 2 HALF) and the packed sketch."""
    sizes = np.array([len(s) for s in sets])
    every, begins = np.concatenate(sets), np.cumsum(sizes) - sizes
    prints = np.column_stack([np.add.reduceat(mixed(every * _FIRST), begins), np.add.reduceat(mixed(every * _SECOND), begins)])
    minima = _minima(sets, _FACTORS[:_FUNCTIONS])
    keys = minima[:, ::WIDTH]
    for j in range(1, WIDTH):
        keys = mixed(keys * _FIRST + minima[:, j::WIDTH] * _SECOND)
    return prints, keys, _packed(minima, _BITS)


def _longs(values: np.ndarray) -> pa.Array:
    """A two-dimensional array of unsigned numbers as lists of longs."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.astype(np.int64).ravel()))


def _described(docs: DataFrame, size: int) -> DataFrame:
    """Each document's set size, set fingerprint, short keys and sketch; empty sets have no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, held in blocks(batch.column(1)):
                sets = shingle_sets(held, size)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                prints, keys, packed = (np.zeros((len(held), w), dtype=np.uint64) for w in (2, 2 * HALF, -(-_FUNCTIONS // (64 // _BITS))))
                if len(full):
                    prints[full], keys[full], packed[full] = _sketches([sets[i] for i in full])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(held)), pa.array(n), _longs(prints), _longs(keys), _longs(packed)], ["id", "n", "print", "keys", "sketch"]
                )

    return docs.mapInArrow(run, "id long, n long, print array<long>, keys array<long>, sketch array<long>")


def _table_keys(keys: np.ndarray) -> np.ndarray:
    """Every pair of a key of the first collection and one of the second, with the number of its table."""
    a, b = keys[:, :HALF, None], keys[:, None, HALF:]
    table = np.arange(HALF * HALF, dtype=np.uint64).reshape(1, HALF, HALF)
    return mixed(mixed(a * _FIRST + table) + b * _SECOND).reshape(len(keys), HALF * HALF)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, width)


def _buckets(classes: DataFrame) -> DataFrame:
    """``key, table, id, n`` for every class and table whose bucket holds several classes."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _table_keys(_matrix(batch.column(0), 2 * HALF))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().astype(np.int64))], ["key"])

    shared_keys = classes.select("keys").mapInArrow(every, "key long").groupBy("key").count().where("count > 1").select("key")
    shared_keys = landed(shared_keys, "bucket_keys")
    bitmap = key_filter(shared_keys, "key")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _table_keys(_matrix(batch.column(2), 2 * HALF))
            row, table = np.nonzero(passes(bitmap.value, keys.ravel()).reshape(keys.shape))
            cut = batch.select(["id", "n"]).take(pa.array(row))
            key, number = pa.array(keys[row, table].astype(np.int64)), pa.array(table.astype(np.int32))
            yield pa.RecordBatch.from_arrays([key, number, *cut.columns], ["key", "table", "id", "n"])

    rows = classes.select("id", "n", "keys").mapInArrow(likely, "key long, table int, id long, n long")
    return landed(rows.join(shared_keys, "key", "left_semi"), "buckets")


def _band(n: Column, similarity: int) -> Column:
    """Size class of a set. Sets whose sizes allow the similarity are in the same class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / similarity)) + F.lit(1e-9)).cast("int")


def _sizes_allow(a: str, b: str, similarity: int) -> Column:
    return 100 * F.least(a, b) >= similarity * F.greatest(a, b)


def _sets(ids: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``id, shingles, fine`` (the finer sketch) of some documents, worked out again from their texts."""
    bitmap = key_filter(ids, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(keep))
            for start, held in blocks(batch.column(1)):
                sets = [s if len(s) else np.zeros(1, dtype=np.uint64) for s in shingle_sets(held, size)]
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).astype(np.int64)))
                fine = _packed(_minima(sets, _FACTORS[_FUNCTIONS:]), _FINE_BITS)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(held)), values, _longs(fine)], ["id", "shingles", "fine"])

    return landed(docs.where("id is not null").mapInArrow(run, "id long, shingles array<long>, fine array<long>").join(ids, "id", "left_semi"), "sets")


def _compared(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The pairs ``a, b`` with the sizes of their full shingle sets and of the intersection, ``common``."""
    ids = landed(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidates")
    sets = _sets(ids, docs, size)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right")).alias("common")
    return landed(pairs.join(left, "a").join(right, "b").select("a", "b", common, F.size("left").alias("left"), F.size("right").alias("right")), "compared")


def _similar(compared: DataFrame, similarity: int) -> DataFrame:
    return compared.where(100 * F.col("common") >= similarity * (F.col("left") + F.col("right") - F.col("common"))).select("a", "b")


def _linkable(ids: DataFrame, docs: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """The documents that can have a link with another of them at all.

    Returns ``id, shared, fine`` and the rows ``id, n, shingle`` of their shared shingles. ``shared`` counts the shingles that some other of them has too. A link needs it to be at least the
    similarity's share of the set, so the others leave, and then the count is taken again without them.
    """
    sets = _sets(ids, docs, size)
    rows = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    for _ in range(2):
        common = landed(rows.groupBy("shingle").count().where("count > 1").select("shingle"), "common")
        rows = rows.join(common, "shingle", "left_semi")
        shared = rows.groupBy("id").agg(F.first("n").alias("n"), F.count("*").alias("shared"))
        shared = landed(shared.where(100 * F.col("shared") >= similarity * F.col("n")).select("id", "shared"), "linkable")
        rows = rows.join(shared, "id", "left_semi")
    return landed(shared.join(sets.select("id", "fine"), "id"), "linkable"), rows


def _with_hubs(rest: DataFrame) -> DataFrame:
    """Rows with the ``hub`` of their bucket: its most central class, whose shingles others share most."""
    central = F.max_by(F.col("id"), F.struct(F.col("shared") / F.col("n"), -F.col("id"))).alias("hub")
    return landed(rest.join(landed(rest.groupBy("key").agg(central), "hubs"), "key"), "rest")


def _prefixes(rows: DataFrame, similarity: int) -> DataFrame:
    """``id, n, shingle, place, short``: the rarest shingles of each set, of which two similar sets share one.

    With all sets in one order, rare shingles first, sets of n <= m shingles that have a part of them in common meet in the
    first shingles of both: of the larger one all but ``similarity`` percent and one more, of the smaller one,
    whose partner is no smaller, fewer (``short``). Shingles that stand in one set only come first and are passed over.
    """
    shared = rows.join(rows.groupBy("shingle").agg(F.count("*").alias("sets")).where("sets > 1"), "shingle")
    of_set = Window.partitionBy("id")  # one document's shingles
    place = F.row_number().over(of_set.orderBy("sets", "shingle")) + F.col("n") - F.count("*").over(of_set)
    long = F.col("n") - F.ceil(F.col("n") * similarity / 100) + 1
    short = F.col("n") - F.ceil(F.col("n") * 2 * similarity / (100 + similarity)) + 1
    return shared.withColumn("place", place).where(F.col("place") <= long).select("id", "n", "shingle", "place", (F.col("place") <= short).alias("short"))


def _across(prefixes: DataFrame, components_of: DataFrame, traits: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of a bucket that are in different components and may be similar enough, each pair once.

    Classes meet by the shingles of their prefixes. At least one class of such a pair is not in the shingle's most frequent
    component ``main``, so only those look for partners. What follows a common shingle bounds what two sets have in common,
    if it is their first one. Of the pairs that are left, those stay that share a table of the banding and whose sketches allow it.
    """
    rows = landed(prefixes.join(components_of, "id"), "prefixes")
    counts = rows.groupBy("shingle", "component").agg(F.count("*").alias("members"))
    spans = counts.groupBy("shingle").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("members", "component")).alias("main"))
    rows = landed(rows.join(spans.where("parts > 1").drop("parts"), "shingle"), "prefixes")
    small = rows.where("short").select("shingle", *(F.col(c) for c in ("id", "n", "place", "component", "main")))
    large = rows.select("shingle", *(F.col(c).alias(f"other_{c}") for c in ("id", "n", "place", "component", "main")))
    most = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")) + 1
    fits = (
        (F.col("component") != F.col("other_component"))
        & (F.col("n") <= F.col("other_n"))
        & _sizes_allow("n", "other_n", similarity)
        & (100 * most >= similarity * (F.col("n") + F.col("other_n") - most))
    )
    met = small.where("component <> main").join(large, "shingle").where(fits)
    met = met.unionByName(small.where("component = main").join(large.where("other_component <> other_main"), "shingle").where(fits))
    pairs = landed(met.select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct(), "met")

    def far(sketch: str, count: int) -> Column:
        return sum((F.bit_count(F.col(f"a_{sketch}")[i].bitwiseXOR(F.col(f"b_{sketch}")[i])) for i in range(count)), F.lit(0))

    def met_in(begin: int) -> Column:
        equal = F.zip_with(F.slice("a_keys", begin + 1, HALF), F.slice("b_keys", begin + 1, HALF), lambda x, y: x == y)
        return F.exists(equal, lambda e: e)

    for side in ("a", "b"):
        pairs = pairs.join(traits.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("keys", "sketch", "fine"))), side)
    near = (far("sketch", -(-_FUNCTIONS // (64 // _BITS))) <= _FAR) & (far("fine", _FINE * _FINE_BITS // 64) <= _FINE_FAR)
    return pairs.where(near & met_in(0) & met_in(HALF)).select("a", "b")


def _apart(placed: DataFrame) -> DataFrame:
    """The buckets that hold classes of more than one component, with the most frequent one, ``main``."""
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("members"))
    spans = counts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("members", "component")).alias("main"))
    return landed(spans.where("parts > 1").drop("parts"), "apart")


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the component of their class, which is its own where it has no link so far."""
    return landed(rows.join(found, rows["id"] == found["node"], "left").withColumn("component", F.coalesce("component", "id")).drop("node"), "placed")


def near_duplicates(docs: DataFrame, size: int = 5, similarity: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_shingles, component_id and kept for every row; ``similarity`` is a percentage of at least 80."""
    ship(docs.sparkSession)
    whole_number_key(docs, key)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = landed(_described(rows, size), "described")
    named = described.where("id is not null and n > 0")
    classes = named.groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    classes = landed(classes, "classes")
    buckets = _buckets(classes)

    band = _band(F.col("n"), similarity)
    sized = buckets.select("key", "id", F.explode(F.array(band, band + 1)).alias("class"))
    heads = landed(sized.groupBy("key", "class").agg(F.min("id").alias("head"), F.count("*").alias("members")).where("members > 1"), "heads")
    stars = sized.join(heads, ["key", "class"]).where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    links = _similar(_compared(landed(stars, "stars"), rows, size), similarity)
    found = components(links)

    # What the first comparison left apart goes on with the classes that can have a link at all, which
    # are compared with the most central one of their bucket; then the pairs across what is still apart.
    # Tables by bucket stay narrow; what belongs to a class is joined at the end.
    placed = _placed(buckets, found)
    apart = landed(placed.join(_apart(placed).drop("main"), "key"), "apart")
    linkable, shingles = _linkable(apart.select("id").distinct(), rows, size, similarity)
    able = landed(apart.join(linkable.select("id", "shared"), "id"), "able")
    rest = _with_hubs(able.join(_apart(able).drop("main"), "key"))
    spokes = rest.where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    compared = _compared(landed(spokes, "spokes"), rows, size)
    links = links.unionByName(_similar(compared, similarity))
    found = components(links)
    rest = _placed(rest.drop("component"), found)
    rest = landed(rest.join(_apart(rest).drop("main"), "key").select("id", "component").distinct(), "rest")
    prefixes = _prefixes(shingles.join(rest, "id", "left_semi"), similarity)
    # Keys need only be told apart: their low halves do, but for a chance of 1e-8 a pair.
    traits = classes.join(linkable.select("id", "fine"), "id").select("id", F.transform("keys", lambda k: k.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("keys"), "sketch", "fine")
    across = landed(_across(prefixes, rest, landed(traits, "traits"), similarity), "across")
    more = _similar(_compared(across, rows, size), similarity)
    if not more.isEmpty():
        found = components(links.unionByName(more))

    members = landed(classes.select("print", F.col("id").alias("class_id")).join(found, F.col("class_id") == F.col("node"), "left"), "members")
    members = members.select("print", F.coalesce("component", "class_id").alias("component_id"))
    linked = described.where("n > 0 and id is not null").select("id", "n", "print").join(members, "print").drop("print")
    alone = described.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
