"""Which offsets of a topic are landed, kept apart from the landed rows.

Offsets are kept per chunk of ``CHUNK`` consecutive ones, as bits, or as a run of whole chunks once all
their offsets are there. So the ledger of a long history without holes is a few rows per topic partition, and at
worst one bit for each offset. Looking records up reads the ledger rows of their own chunks; the landed
table is never read for it.

The ledger follows the table: a run notes that it begins, appends its rows, and then notes the offsets of the rows that are
really there. A run that broke off between the two left its first note, and the next run makes up for it by reading the
rows of that run alone, told by their run time. One writer at a time.

Notes are appended as small files of the current generation. ``compact`` merges them into a new generation,
which counts only once it is sealed by a last file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Offsets per chunk: the number of bits in one of Spark's bitmaps.
CHUNK = 32768
#: Bits of the filter that leaves landed rows out before rows are moved: 16 MB, whatever the size of the ledger.
SLOTS = 1 << 27
#: Runs noted in one generation before they are merged into the next.
RUNS = 64

PARTITION = ("topic", "partition")
SCHEMA = "topic string, partition int, first long, last long, bits binary, run string, state string, generation int"
_MARK = "topic string, partition int, first long, last long, bits binary, run string, state string"


def chunk_of(offset: Column) -> Column:
    return F.floor(offset / F.lit(CHUNK)).cast("bigint")


def _has(bits: Column, offset: Column) -> Column:
    """Whether the bit of an offset is set."""
    place = F.pmod(offset, F.lit(CHUNK)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


def marked(rows: DataFrame) -> DataFrame:
    """Ledger rows of the offsets that occur in ``rows``; repeated offsets count once."""
    chunk = chunk_of(F.col("offset"))
    return (
        rows.groupBy(*PARTITION, chunk.alias("first"))
        .agg(F.bitmap_construct_agg(F.pmod("offset", F.lit(CHUNK))).alias("bits"))
        .select(*PARTITION, "first", F.col("first").alias("last"), "bits")
    )


def merged(notes: DataFrame) -> DataFrame:
    """One row per chunk that is there in part, and one without bits per longest run of whole chunks."""
    parts = notes.where("bits is not null").groupBy(*PARTITION, "first").agg(F.bitmap_or_agg("bits").alias("bits"))
    parts = parts.withColumn("_whole", F.bitmap_count("bits") == CHUNK)
    runs = notes.where("first is not null and bits is null").select(*PARTITION, "first", "last")
    runs = runs.unionByName(parts.where("_whole").select(*PARTITION, "first", F.col("first").alias("last")))
    # A row per run of whole chunks: few, since every compaction joins neighbours.
    earlier = Window.partitionBy(*PARTITION).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*PARTITION).orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.coalesce(F.col("first") > F.max("last").over(earlier) + 1, F.lit(True))
    runs = runs.withColumn("_begins", begins.cast("int")).withColumn("_island", F.sum("_begins").over(upto))
    runs = runs.groupBy(*PARTITION, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    runs = runs.select(*PARTITION, "first", "last", F.lit(None).cast("binary").alias("bits"))
    # Offsets that came again lie in chunks that are whole by now. The bits stay out of the ordered pass, which has a
    # task per topic partition.
    loose = parts.where("not _whole").select(*PARTITION, "first", F.col("first").alias("last"), "bits")
    again = _with_whole(loose.select(*PARTITION, F.col("first").alias("chunk")), runs).where("whole")
    return loose.join(again.select(*PARTITION, F.col("chunk").alias("first")), [*PARTITION, "first"], "left_anti").unionByName(runs)


def _with_whole(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """``chunks`` with ``whole``, whether a run has them, by one ordered pass over both."""
    begins = runs.select(*PARTITION, F.col("first").alias("chunk"), "last", F.lit(0).alias("_asked"))
    asked = chunks.withColumns({"last": F.lit(None).cast("bigint"), "_asked": F.lit(1)})
    upto = Window.partitionBy(*PARTITION).orderBy("chunk", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    reached = asked.unionByName(begins, allowMissingColumns=True).withColumn("_upto", F.max("last").over(upto)).where("_asked = 1")
    return reached.select(*chunks.columns, F.coalesce(F.col("_upto") >= F.col("chunk"), F.lit(False)).alias("whole"))


def coverage(asked: DataFrame, state: DataFrame) -> DataFrame:
    """``asked`` chunks (topic, partition, chunk) with ``whole`` or their ``bits``."""
    whole = _with_whole(asked.select(*PARTITION, "chunk"), state.where("bits is null"))
    bits = state.where("bits is not null").select(*PARTITION, F.col("first").alias("chunk"), "bits")
    return whole.join(bits, [*PARTITION, "chunk"], "left")


def _chunked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("chunk", chunk_of(F.col("offset")))


def _left(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Chunked rows whose offset their chunk's coverage does not have."""
    joined = rows.join(known, [*PARTITION, "chunk"], "left")
    seen = F.col("whole") | F.coalesce(_has(F.col("bits"), F.col("offset")), F.lit(False))
    return joined.where(~F.coalesce(seen, F.lit(False))).select(*rows.columns)


def _probable(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """``rows`` without most of those that are not among ``fresh``, by one bit for the hash of each fresh record."""
    slot = F.pmod(F.xxhash64(*PARTITION, "offset"), F.lit(SLOTS))
    pages = fresh.select(slot.alias("_slot")).groupBy(chunk_of(F.col("_slot")).alias("_page"))
    pages = pages.agg(F.bitmap_construct_agg(F.pmod("_slot", F.lit(CHUNK))).alias("_set"))
    asked = rows.withColumn("_slot", slot).withColumn("_page", chunk_of(F.col("_slot")))
    found = asked.join(F.broadcast(pages), "_page")  # SLOTS bits at most
    return found.where(_has(F.col("_set"), F.col("_slot"))).select(*rows.columns)


def not_covered(rows: DataFrame, state: DataFrame, repeats: bool = False, landed: bool = False) -> DataFrame:
    """Rows whose offset the ledger state does not have; with ``repeats``, one of those with the same identity.

    Rows move once, by chunk, and repeated ones are told in the same place. With ``landed``, where many may be there
    already, their offsets alone are looked up first, and most landed rows are left out before any is moved.
    """
    rows = _chunked(rows)
    known = coverage(rows.select(*PARTITION, "chunk").distinct(), state)
    if landed:
        rows = _probable(rows, _left(rows.select(*PARTITION, "chunk", "offset"), known))
    left = _left(rows, known)
    if repeats:
        left = left.dropDuplicates([*PARTITION, "chunk", "offset"])
    return left.drop("chunk")


def intervals(state: DataFrame) -> DataFrame:
    """The landed offsets of each topic partition as longest intervals: first_offset, last_offset."""
    # Plain generators, which are compiled: the bytes of a chunk, then the bits of those that have any.
    octet = F.conv(F.hex(F.substring("bits", F.col("_octet") + 1, F.lit(1))), 16, 10).cast("int")
    octets = state.where("bits is not null").select(*PARTITION, "first", "bits", F.explode(F.sequence(F.lit(0), F.lit(CHUNK // 8 - 1))).alias("_octet"))
    octets = octets.select(*PARTITION, "first", "_octet", octet.alias("_byte")).where("_byte <> 0")
    loose = octets.select(*PARTITION, "first", "_octet", "_byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    loose = loose.where(F.getbit("_byte", F.col("_bit")) == 1).select(*PARTITION, "first", (F.col("_octet") * 8 + F.col("_bit")).alias("_place"))
    offset = F.col("first") * CHUNK + F.col("_place")
    inside = Window.partitionBy(*PARTITION, "first").orderBy("_place")  # one chunk at most
    loose = loose.withColumn("_island", F.col("_place") - F.row_number().over(inside)).groupBy(*PARTITION, "first", "_island")
    pieces = loose.agg(F.min(offset).alias("first_offset"), F.max(offset).alias("last_offset")).drop("first", "_island")
    whole = state.where("bits is null").select(
        *PARTITION, (F.col("first") * CHUNK).alias("first_offset"), (F.col("last") * CHUNK + CHUNK - 1).alias("last_offset")
    )
    pieces = pieces.unionByName(whole)
    # Only pieces at the edge of a chunk, two per chunk, can go on in the next one.
    edge = (F.pmod("first_offset", F.lit(CHUNK)) == 0) | (F.pmod("last_offset", F.lit(CHUNK)) == CHUNK - 1)
    order = Window.partitionBy(*PARTITION).orderBy("first_offset")
    begins = F.coalesce(F.col("first_offset") > F.lag("last_offset").over(order) + 1, F.lit(True)).cast("int")
    joined = pieces.where(edge).withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(order))
    joined = joined.groupBy(*PARTITION, "_island").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    return pieces.where(~edge).unionByName(joined.drop("_island"))


@dataclass(frozen=True)
class Ledger:
    """The ledger at a path."""

    spark: SparkSession
    path: str

    def _all(self) -> DataFrame:
        """Notes of every generation; none where nothing was noted yet."""
        from tidelog.sources.tables import existing

        found = existing(self.spark, self.path, SCHEMA)
        return self.spark.createDataFrame([], SCHEMA) if found is None else found

    def generation(self) -> int:
        """The last generation that is sealed; 0 before the first one."""
        return self._all().where("state = 'sealed'").agg(F.max("generation")).first()[0] or 0

    def notes(self) -> DataFrame:
        """Notes of the current generation."""
        every = self._all()
        current = every.where("state = 'sealed'").agg(F.max("generation").alias("generation"))
        return every.join(F.broadcast(current), "generation").drop("generation")  # one number

    def state(self) -> DataFrame:
        return merged(self.notes())

    def missing(self, rows: DataFrame, repeats: bool = False) -> DataFrame:
        """Rows (with topic, partition and offset) that are not landed; with ``repeats``, one of those that came again."""
        landed = not self._all().where("first is not null").isEmpty()
        return not_covered(rows, self.state(), repeats, landed)

    def unfinished(self) -> list[str]:
        """Runs that began and noted no end; more than one only if every run since then broke off."""
        open_ends = F.sum(F.when(F.col("state") == "begun", 1).otherwise(-1))
        runs = self.notes().where("run is not null").groupBy("run").agg(open_ends.alias("open"))
        return [r.run for r in runs.where("open > 0").collect()]

    def _append(self, rows: DataFrame, generation: int) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/generation={generation}")

    def _mark(self, generation: int, run: str | None, state: str) -> None:
        self._append(self.spark.createDataFrame([(None, None, None, None, None, run, state)], _MARK), generation)

    def begin(self, run: str) -> None:
        generation = self.generation()
        if not generation:
            self._mark(generation := 1, None, "sealed")
        self._mark(generation, run, "begun")

    def end(self, run: str, landed: DataFrame) -> None:
        """Note the offsets of a run's landed rows, and in the same file that it has ended."""
        done = self.spark.createDataFrame([(None, None, None, None, None, run, "ended")], _MARK)
        rows = marked(landed).withColumns({"run": F.lit(None).cast("string"), "state": F.lit(None).cast("string")})
        self._append(done.unionByName(rows), self.generation())
        if self.notes().where("state = 'ended'").count() >= RUNS:
            self.compact()

    def compact(self) -> None:
        """Merge the notes into a new generation; broken attempts at one are left behind unsealed."""
        after = 1 + (self._all().agg(F.max("generation")).first()[0] or 0)
        rows = self.state().withColumns({"run": F.lit(None).cast("string"), "state": F.lit(None).cast("string")})
        rows = rows.repartitionByRange(*PARTITION, "first").sortWithinPartitions(*PARTITION, "first")
        rows.write.mode("append").parquet(f"{self.path}/generation={after}")
        for run in self.unfinished():
            self._mark(after, run, "begun")
        self._mark(after, None, "sealed")
