"""Declared expectations and their evaluation over a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import new_folder, setting

GROUPED = ("unique", "unique_share", "compound_unique")

#: Bytes of a file that a task counts values of. Nearly all values may differ, and a task holds its own until it spills.
SPLIT = "16m"


@dataclass(frozen=True)
class Expectation:
    """``kind`` with its columns and bounds; ``mostly`` is the share of good values required.

    NULLs count as bad for ``not_null`` only and are left out everywhere else.
    """

    kind: str
    columns: tuple[str, ...] = ()
    mostly: float = 1.0
    low: object = None
    high: object = None
    values: tuple = ()
    pattern: str = ""

    @property
    def label(self) -> str:
        return ",".join(self.columns) if self.kind != "columns" else ""


def row_count(low: int) -> Expectation:
    return Expectation("row_count", low=low)


def columns(*names: str) -> Expectation:
    return Expectation("columns", names)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", (column,), mostly)


def unique(column: str) -> Expectation:
    return Expectation("unique", (column,))


def matches(column: str, pattern: str, mostly: float = 1.0) -> Expectation:
    return Expectation("matches", (column,), mostly, pattern=pattern)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", (column,), mostly, values=tuple(values))


def between(column: str, low=None, high=None, mostly: float = 1.0) -> Expectation:
    return Expectation("between", (column,), mostly, low, high)


def length_between(column: str, low=None, high=None, mostly: float = 1.0) -> Expectation:
    return Expectation("length_between", (column,), mostly, low, high)


def unique_share(column: str, low: float, high: float) -> Expectation:
    return Expectation("unique_share", (column,), low=low, high=high)


def max_between(column: str, low=None, high=None) -> Expectation:
    return Expectation("max_between", (column,), low=low, high=high)


def compound_unique(*names: str) -> Expectation:
    return Expectation("compound_unique", names)


def at_least(a: str, b: str, mostly: float = 1.0) -> Expectation:
    """Column ``a`` is greater than or equal to column ``b``."""
    return Expectation("at_least", (a, b), mostly)


def _inside(value: Column, low, high) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return inside


def _good(e: Expectation) -> Column:
    """Whether a row meets a row-level rule; NULL where the rule does not look at the row."""
    value = F.col(e.columns[0])
    if e.kind == "not_null":
        return value.isNotNull()
    if e.kind == "matches":
        return value.rlike(e.pattern)
    if e.kind == "in_set":
        return value.isin(*e.values)
    if e.kind == "between":
        return F.when(value.isNotNull(), _inside(value, e.low, e.high))
    if e.kind == "length_between":
        return F.when(value.isNotNull(), _inside(F.length(value), e.low, e.high))
    if e.kind == "at_least":
        return value >= F.col(e.columns[1])
    raise ValueError(f"unknown expectation {e.kind!r}")


def _verdict(position: int, e: Expectation, evaluated: Column, unexpected: Column, ok: Column):
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.label).alias("column"),
        evaluated.cast("bigint").alias("evaluated"),
        unexpected.cast("bigint").alias("unexpected"),
        F.coalesce(ok, F.lit(False)).alias("success"),
    )


def _whole_table(position: int, e: Expectation, ok: Column):
    bad = F.when(ok, 0).otherwise(1)
    return _verdict(position, e, F.lit(1), bad, ok)


Numbered = list[tuple[int, Expectation]]

#: Numbers of a column set: values, values that stand there more than once, distinct values.
KEY_NUMBERS = ("seen", "repeated", "distinct")


def _rows(where: Column | None = None, weight: Column | None = None) -> Column:
    """Number of rows that meet a condition, each counted ``weight`` times."""
    if weight is None:
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    return F.coalesce(F.sum(weight if where is None else F.when(where, weight)), F.lit(0))


def measures(rules: Numbered, weight: Column | None = None) -> dict[str, tuple[Column, Callable[[str], Column]]]:
    """What row-level and whole-table rules need of a table, by name, and how parts of a table are put together.

    With ``weight``, a row stands for that many equal ones.
    """
    found: dict[str, tuple[Column, Callable[[str], Column]]] = {"rows": (_rows(weight=weight), F.sum)}
    for position, e in rules:
        if e.kind == "max_between":
            found[f"max_{position}"] = (F.max(e.columns[0]), F.max)
        elif e.kind not in ("columns", "row_count"):
            good = _good(e)
            found[f"seen_{position}"] = (_rows(good.isNotNull(), weight), F.sum)
            found[f"bad_{position}"] = (_rows(~good, weight), F.sum)
    return found


def verdicts(measured: DataFrame, rules: Numbered, names: Sequence[str]) -> DataFrame:
    """Results of the rules from one row of measures of a table with these columns."""
    types = dict(measured.dtypes)
    found: list[Column] = []
    for position, e in rules:
        if e.kind == "columns":
            found.append(_whole_table(position, e, F.lit(tuple(names) == e.columns)))
        elif e.kind == "row_count":
            found.append(_whole_table(position, e, _inside(F.col("rows"), e.low, e.high)))
        elif e.kind == "max_between":
            largest, kind = F.col(f"max_{position}"), types[f"max_{position}"]
            low, high = [None if bound is None else F.lit(bound).cast(kind) for bound in (e.low, e.high)]
            found.append(_whole_table(position, e, F.coalesce(_inside(largest, low, high), F.lit(False))))
        else:
            seen, bad = F.col(f"seen_{position}"), F.col(f"bad_{position}")
            ok = F.when(seen == 0, True).otherwise((seen - bad) / seen >= e.mostly)
            found.append(_verdict(position, e, seen, bad, ok))
    return measured.select(F.inline(F.array(*found)))


def _scan(df: DataFrame, rules: Numbered, names: Sequence[str], weight: Column | None = None) -> DataFrame:
    """All row-level and whole-table rules in one aggregation; ``names`` are the columns of the table."""
    measured = df.agg(*[value.alias(name) for name, (value, _) in measures(rules, weight).items()])
    return verdicts(measured, rules, names)


def key_counts(df: DataFrame, names: tuple[str, ...], weight: Column | None = None) -> DataFrame:
    """Rows of each value of a column set (``_n``), leaving out those where all columns are NULL."""
    present = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])
    return df.filter(present).groupBy(*names).agg(_rows(weight=weight).alias("_n"))


def key_numbers(counts: DataFrame, sign: Column | None = None) -> DataFrame:
    """The ``KEY_NUMBERS`` of counted values; signed counts give the change."""
    unit = F.lit(1) if sign is None else sign
    seen, repeated, distinct = KEY_NUMBERS
    return counts.agg(
        F.coalesce(F.sum(unit * F.col("_n")), F.lit(0)).alias(seen),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, unit * F.col("_n"))), F.lit(0)).alias(repeated),
        F.coalesce(F.sum(unit), F.lit(0)).cast("bigint").alias(distinct),
    )


def key_verdicts(numbers: DataFrame, rules: Numbered) -> DataFrame:
    """Results of the uniqueness rules over one column set, from its numbers."""
    seen, repeated, distinct = map(F.col, KEY_NUMBERS)
    found = []
    for position, e in rules:
        if e.kind == "unique_share":
            share = F.when(seen == 0, 0.0).otherwise(distinct / seen)
            found.append(_verdict(position, e, seen, seen - distinct, _inside(share, e.low, e.high)))
        else:
            found.append(_verdict(position, e, seen, repeated, repeated == 0))
    return numbers.select(F.inline(F.array(*found)))


def split_rules(rules: Sequence[Expectation]) -> tuple[Numbered, dict[tuple[str, ...], Numbered]]:
    """Numbered rules that one scan settles, and those over each column set that must be unique."""
    numbered = list(enumerate(rules))
    keys: dict[tuple[str, ...], Numbered] = {}
    for i, e in numbered:
        if e.kind in GROUPED:
            keys.setdefault(e.columns, []).append((i, e))
    return [(i, e) for i, e in numbered if e.kind not in GROUPED], keys


def evaluate(df: DataFrame, name: str, rules: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: one pass for all row rules, one grouped pass per unique key."""
    scanned, keys = split_rules(rules)
    results = [_scan(df, scanned, df.columns)] if scanned else []
    results += [key_verdicts(key_numbers(key_counts(df, key)), same) for key, same in keys.items()]
    return reduce(DataFrame.unionByName, results).select(F.lit(name).alias("suite"), "*")


@dataclass(frozen=True)
class Lookup:
    """A table of ``names``: ``rows`` with the columns that a left join with ``found`` on ``key`` adds."""

    rows: DataFrame
    found: DataFrame
    key: str
    names: tuple[str, ...]

    @property
    def added(self) -> set[str]:
        return set(self.found.columns) - {self.key}

    def table(self) -> DataFrame:
        return self.rows.join(self.found, self.key, "left").select(*self.names)

    def counted(self, columns: Sequence[str]) -> DataFrame:
        """These columns with how many equal rows stand behind each (``_rows``), counted before the join."""
        own = [c for c in dict.fromkeys((self.key, *columns)) if c not in self.added]
        counts = self.rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_rows"))
        return counts.join(self.found.select(self.key, *sorted(self.added.intersection(columns))), self.key, "left")

    def weighted(self) -> DataFrame:
        """``rows`` with how many rows of the table each becomes (``_rows``).

        Only keys that ``found`` has more than once count, and these are landed, so that ``rows`` stay in place where
        they are few.
        """
        spark = self.rows.sparkSession
        path = new_folder(spark, "repeated")
        self.found.groupBy(self.key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").write.parquet(path)
        return self.rows.join(spark.read.parquet(path), self.key, "left").withColumn("_rows", F.coalesce("_rows", F.lit(1)))


def lookup_results(table: Lookup, name: str, rules: Sequence[Expectation]) -> DataFrame:
    """``evaluate`` of a joined table without the join of all its rows.

    Rules over the rows alone scan them in place. Those that look at an added column join counts per value of the key,
    which a key with many rows does not skew.
    """
    weight = F.col("_rows")
    scanned, keys = split_rules(rules)

    def joins(e: Expectation) -> bool:
        return e.kind != "columns" and not table.added.isdisjoint(e.columns)

    rows = table.weighted()
    here, there = [(i, e) for i, e in scanned if not joins(e)], [(i, e) for i, e in scanned if joins(e)]
    results = [_scan(rows, here, table.names, weight)] if here else []
    if there:
        results.append(_scan(table.counted([c for _, e in there for c in e.columns]), there, table.names, weight))
    for key, same in keys.items():
        df = rows if table.added.isdisjoint(key) else table.counted(key)
        results.append(key_verdicts(key_numbers(key_counts(df, key, weight)), same))
    return reduce(DataFrame.unionByName, results).select(F.lit(name).alias("suite"), "*")


def evaluate_lookup(table: Lookup, name: str, rules: Sequence[Expectation]) -> DataFrame:
    """``lookup_results``, landed, since files are read by ``SPLIT`` for the length of this call only."""
    spark = table.rows.sparkSession
    path = new_folder(spark, "suite-results")
    with setting(spark, "spark.sql.files.maxPartitionBytes", SPLIT):
        lookup_results(table, name, rules).write.parquet(path)
    return spark.read.parquet(path)
