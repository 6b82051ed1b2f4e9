"""Payload contracts: violations per image, schema evolution and freshness."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog import rules

# Fixed formats of the payload contracts.
DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

INTEGER, TEXT, AMOUNT = "integer", "string", "amount"


@dataclass(frozen=True)
class Field:
    """A required payload field; ``amount`` is a number or a text that holds one."""

    name: str
    kind: str
    enum: tuple[str, ...] = ()
    minimum: int | None = None
    max_length: int | None = None
    format: str = ""


ORDER_CONTRACT = (
    Field("order_id", INTEGER),
    Field("customer_id", INTEGER),
    Field("status", TEXT, enum=rules.ORDER_STATUSES),
    Field("total_amount", AMOUNT),
    Field("created_at", TEXT, format="date-time"),
    Field("updated_at", TEXT, format="date-time"),
)

CUSTOMER_CONTRACT = (
    Field("customer_id", INTEGER),
    Field("name", TEXT, max_length=255),
    Field("email", TEXT, max_length=255, format="email"),
    Field("created_at", TEXT, format="date-time"),
    Field("updated_at", TEXT, format="date-time"),
)

ORDER_ITEM_CONTRACT = (
    Field("item_id", INTEGER),
    Field("order_id", INTEGER),
    Field("product_id", INTEGER),
    Field("quantity", INTEGER, minimum=1),
    Field("unit_price", AMOUNT),
    Field("created_at", TEXT, format="date-time"),
)

Contract = tuple[Field, ...]


def _opened(images: DataFrame, image: str, contract: Contract) -> DataFrame:
    """Type and text of every contract field, and the field names; each image is parsed once."""

    def value(field: Field) -> Column:
        return F.col("_m").getItem(field.name)

    return images.withColumn("_m", F.from_json(image, "map<string, variant>")).select(
        *images.columns,
        F.col("_m").isNotNull().alias("_object"),
        F.coalesce(F.map_keys("_m"), F.array().cast("array<string>")).alias("_keys"),
        *[F.schema_of_variant(value(f)).alias(f"_t_{f.name}") for f in contract],
        *[F.try_variant_get(value(f), "$", "string").alias(f"_x_{f.name}") for f in contract],
    )


def _type_ok(field: Field) -> Column:
    kind, text = F.col(f"_t_{field.name}"), F.col(f"_x_{field.name}")
    if field.kind == INTEGER:
        return kind == "BIGINT"
    if field.kind == TEXT:
        return kind == "STRING"
    numeric = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    return numeric | ((kind == "STRING") & text.try_cast("decimal(38,10)").isNotNull())


def _rule_failures(field: Field) -> list[Column]:
    """One nullable (field, rule) struct per rule of the field, set where the rule is broken."""
    text = F.col(f"_x_{field.name}")
    present = F.array_contains("_keys", field.name)

    def failed(rule: str, broken: Column) -> Column:
        return F.when(broken, F.struct(F.lit(field.name).alias("field"), F.lit(rule).alias("rule")))

    typed = present & F.coalesce(_type_ok(field), F.lit(False))
    checks = [failed("required", ~present), failed("type", present & ~typed)]
    if field.enum:
        checks.append(failed("enum", typed & ~text.isin(*field.enum)))
    if field.minimum is not None:
        checks.append(failed("minimum", typed & (text.try_cast("bigint") < field.minimum)))
    if field.max_length is not None:
        checks.append(failed("max_length", typed & (F.length(text) > field.max_length)))
    if field.format == "email":
        checks.append(failed("format", typed & ~text.rlike(EMAIL)))
    if field.format == "date-time":
        valid = text.rlike(DATE_TIME) & text.try_cast("timestamp").isNotNull()
        checks.append(failed("format", typed & ~valid))
    return checks


def violations(images: DataFrame, image: str, contract: Contract) -> DataFrame:
    """One row per broken rule of each non-NULL image: ``field`` and ``rule`` next to the input.

    Rules that hold are rows without a field, left out behind the generator. Taking them out of the array first would
    have every rule interpreted, row by row, instead of compiled.
    """
    kept = [c for c in images.columns if c != image]
    known = F.array(*[F.lit(f.name) for f in contract])
    unexpected = F.array_except("_keys", known)
    extra = F.transform(unexpected, lambda name: F.struct(name.alias("field"), F.lit("unexpected").alias("rule")))
    whole = F.array(F.struct(F.lit("").alias("field"), F.lit("not an object").alias("rule")))
    rules_of = F.array(*[c for f in contract for c in _rule_failures(f)])
    checked = F.when(F.size(unexpected) > 0, F.concat(rules_of, extra)).otherwise(rules_of)
    opened = _opened(images.filter(F.col(image).isNotNull()), image, contract)
    return opened.select(*kept, F.inline(F.when(F.col("_object"), checked).otherwise(whole))).filter(F.col("field").isNotNull())


def observed_evolution(images: DataFrame, image: str, contract: Contract) -> DataFrame:
    """Fields seen in the images against the contract, with the verdict on each difference.

    A new field is compatible; a field that is gone everywhere, or present with another type, is
    breaking.
    """
    opened = _opened(images.filter(F.col(image).isNotNull()), image, contract)
    counts = opened.agg(
        *[
            measure
            for f in contract
            for measure in (
                F.count_if(F.array_contains("_keys", f.name)).alias(f"_n_{f.name}"),
                F.count_if(
                    F.array_contains("_keys", f.name) & ~F.coalesce(_type_ok(f), F.lit(False))
                ).alias(f"_bad_{f.name}"),
            )
        ]
    )

    def row(f: Field) -> Column:
        seen, bad = F.col(f"_n_{f.name}"), F.col(f"_bad_{f.name}")
        change = F.when(seen == 0, "removed").when(bad > 0, "retyped").otherwise("unchanged")
        return F.struct(
            F.lit(f.name).alias("field"),
            seen.alias("records"),
            bad.alias("mistyped"),
            change.alias("change"),
        )

    known = counts.select(F.inline(F.array(*[row(f) for f in contract])))
    names = F.array(*[F.lit(f.name) for f in contract])
    added = (
        opened.select(F.explode(F.array_except("_keys", names)).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(
            "field",
            "records",
            F.lit(0).cast("bigint").alias("mistyped"),
            F.lit("added").alias("change"),
        )
    )
    return known.unionByName(added).withColumn(
        "compatible", F.col("change").isin("unchanged", "added")
    )


def schema_changes(old: StructType, new: StructType) -> list[tuple[str, str, bool]]:
    """(column, change, compatible) for every difference; metadata only.

    An added nullable column is compatible. A removed or retyped one is breaking, and a rename
    shows as one removed and one added.
    """
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    changes = [(name, "removed", False) for name in before if name not in after]
    changes += [(name, "added", f.nullable) for name, f in after.items() if name not in before]
    changes += [
        (name, "retyped", False)
        for name, f in after.items()
        if name in before and before[name].dataType != f.dataType
    ]
    return changes


def check_compatible(old: StructType, new: StructType) -> None:
    """Raise before a write that would break readers of the old schema."""
    breaking = [f"{name} {change}" for name, change, fine in schema_changes(old, new) if not fine]
    if breaking:
        raise ValueError("breaking schema change: " + ", ".join(breaking))


def freshness(
    windows: DataFrame, closed: str = "window_end", emitted: str = "emitted_at", limit_s: int = 120
) -> DataFrame:
    """How many windows came out within the limit after their end, and the longest delay."""
    delay = F.unix_micros(emitted) - F.unix_micros(closed)
    return windows.agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(delay < limit_s * 1_000_000).alias("in_time"),
        F.count_if(delay >= limit_s * 1_000_000).alias("late"),
        F.max(delay).alias("longest_us"),
    )
