"""Change logs and event topics that Spark derives from the given tables.

The rules are fixed, so the expected state of every entity can be written as plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.columns import money
from tidelog.operators.envelope import parse_envelope, topic_values
from workload.domain import RUN_TS, email_of, item_id, order_status, table

KEEP_NULLS = {"ignoreNullFields": "false"}
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def number(value: Column) -> Column:
    """JSON text of a whole number."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def quoted(value: Column) -> Column:
    """JSON text of a string that needs no escapes: a code, an amount, a time, a list of numbers."""
    return F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null"))


def json_object(**members: Column) -> Column:
    """JSON text of an object from the texts of its members, as ``to_json`` writes it.

    Plain concatenation compiles with the rest of the plan, and a text that stands in several records is made once.
    """
    parts = [part for name, text in members.items() for part in (F.lit(f',"{name}":'), text)]
    return F.concat(F.lit(f'{{"{next(iter(members))}":'), *parts[1:], F.lit("}"))


def envelope(op: str | Column, ts_ms: Column, source_table: str, txn: Column, before, after) -> Column:
    """Text of a change event; the images are JSON texts."""
    source = json_object(db=F.lit('"shop"'), table=F.lit(f'"{source_table}"'), txId=number(txn))
    parts = {"before": before, "after": after, "op": quoted(F.lit(op) if isinstance(op, str) else op), "ts_ms": number(ts_ms), "source": source}
    # A missing side is left out of the text, which reads the same as a JSON null.
    return json_object(**{name: text for name, text in parts.items() if text is not None})


def version(i: int, value: Column | None, when: Column | None = None) -> Column:
    text = F.lit(None).cast("string") if value is None else value
    row = F.struct(F.lit(i).alias("i"), text.alias("value"))
    return row if when is None else F.when(when, row)


def present(rows: DataFrame) -> DataFrame:
    """Without the versions that an entity does not have: a function that dropped them from the array would run uncompiled."""
    return rows.where("i is not null")


#: Tasks per core that write JSON texts: several, so that no core waits long for the last one.
TASKS_PER_CORE = 4
#: Tasks per core of a scan from which its rows stay where they are.
SCANS_PER_CORE = 3


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores by their keys: writing the JSON text is the heavy part here.

    The number is given, since adaptive execution would otherwise merge the tasks by the size of the short rows before
    the text, into about one per core and a second round for the rest. The scan of a large table has enough tasks as it
    is, and moving its rows would only take disk.
    """
    if rows.rdd.getNumPartitions() >= SCANS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def as_records(rows: DataFrame, topic: str, key: Column, offset: Column, ts: Column) -> DataFrame:
    """``rows`` with entity number ``k`` and text ``value`` as topic records."""
    return rows.select(
        F.to_json(F.struct(key)).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("k"), F.lit(3)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        ts.alias("timestamp"),
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic of order changes; see FIXTURES.md, section 3, for the rule of each version."""
    k, t0, created = F.col("k"), F.col("t0"), F.col("created")
    ordered = F.col("o_orderdate").cast("timestamp")
    rows = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"), "o_orderkey")
    base = rows.select(
        F.col("o_orderkey").alias("k"),
        number(F.col("o_custkey")).alias("customer"),
        order_status(F.col("o_orderstatus")).alias("final"),
        quoted(money(F.col("o_totalprice")).cast("string")).alias("amount"),
        ordered.alias("created"),
        F.unix_millis(ordered).alias("t0"),
        *[quoted(iso(ordered + F.expr(f"INTERVAL {n} SECONDS"))).alias(f"plus_{n}") for n in (0, 30, 60)],
    )

    def image(status: Column, amount: Column, seconds: int) -> Column:
        return json_object(
            order_id=number(k),
            customer_id=F.col("customer"),
            status=quoted(status),
            total_amount=amount,
            created_at=F.col("plus_0"),
            updated_at=F.col(f"plus_{seconds}"),
        )

    def change(op, delay_ms: int, before, after) -> Column:
        return envelope(op, t0 + delay_ms, "orders", k, before, after)

    pending = F.lit("pending")
    moved, removed, spoilt = F.col("final") != "pending", k % 10 == 0, k % 101 == 0
    images = {
        "opened": image(pending, F.lit('"0.00"'), 0),
        "priced": image(pending, F.col("amount"), 0),
        "broken": image(pending, F.lit('"abc"'), 30),
        "settled": image(F.col("final"), F.col("amount"), 60),
    }
    texts = base.select("k", "created", "t0", "final", *[text.alias(name) for name, text in images.items()])
    opened, priced, broken, settled = map(F.col, images)
    # Images chain: what follows a broken version names it as its before image.
    chained = texts.withColumn("second", F.when(spoilt, broken).otherwise(priced))
    chained = chained.withColumn("last", F.when(moved, settled).otherwise(F.col("second")))
    second, last = F.col("second"), F.col("last")
    repriced = change("u", 0, opened, priced)
    versions = F.array(
        version(0, change(F.when(k % 7 == 0, "r").otherwise("c"), 0, None, opened)),
        version(1, repriced),
        version(2, change("u", 30_000, priced, broken), spoilt),
        version(3, change("u", 60_000, second, settled), moved),
        version(4, change("d", 120_000, last, None), removed),
        version(5, None, removed),
        version(6, F.lit("not a change event"), k % 97 == 0),
        version(7, change("u", 90_000, last, None), k % 103 == 0),
        version(1, repriced, k % 13 == 0),
    )
    return as_records(
        present(chained.select("k", "created", F.inline(versions))),
        "cdc.orders",
        k.alias("order_id"),
        k * 8 + F.col("i"),
        created + F.make_interval(secs=F.col("i")),
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: create, for every third a new e-mail and an added phone, every 20th deleted."""
    k = F.col("k")
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"),
        email_of(F.col("c_name")).alias("email"),
        F.timestamp_seconds(F.lit(788918400) + F.col("c_custkey") * 60).alias("created"),
    )
    created, t0 = F.col("created"), F.unix_millis("created")

    def image(email: Column, days: int, *more: Column) -> Column:
        fields = F.struct(
            k.alias("customer_id"),
            F.col("name").alias("name"),
            email.alias("email"),
            iso(created).alias("created_at"),
            iso(created + F.expr(f"INTERVAL {days} DAYS")).alias("updated_at"),
            *more,
        )
        return F.to_json(fields, KEEP_NULLS)

    first = image(F.col("email"), 0)
    second = image(
        F.concat(F.lit("new."), F.col("email")), 1, F.concat(F.lit("+1-"), k).alias("phone")
    )
    day = 86_400_000
    versions = F.array(
        version(
            0,
            envelope(F.when(k % 7 == 0, "r").otherwise("c"), t0, "customers", k, None, first),
        ),
        version(1, envelope("u", t0 + day, "customers", k, first, second), k % 3 == 0),
        version(2, envelope("d", t0 + 2 * day, "customers", k, first, None), k % 20 == 0),
    )
    rows = present(spread(base, "k").select("k", "created", F.inline(versions)))
    return as_records(rows, "cdc.customers", k.alias("customer_id"), k * 4 + F.col("i"), created)


def item_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One create per line-item row, committed at the ship date."""
    items = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_shipdate",
        ),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    shipped = F.col("l_shipdate").cast("timestamp")
    image = json_object(
        item_id=quoted(item_id()),
        order_id=number(F.col("l_orderkey")),
        product_id=number(F.col("l_partkey")),
        quantity=number(F.col("l_quantity").cast("int")),
        unit_price=quoted(money(F.col("l_extendedprice")).cast("string")),
        created_at=quoted(iso(shipped)),
    )
    rows = items.select(
        F.col("l_orderkey").alias("k"),
        item_id().alias("id"),
        shipped.alias("shipped"),
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
        .bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
        .alias("position"),
        # A generator, so that filters on the text do not build it a second time.
        F.inline(
            F.array(
                version(
                    0,
                    envelope(
                        "c", F.unix_millis(shipped), "order_items", F.col("l_orderkey"), None, image
                    ),
                )
            )
        ),
    )
    return as_records(
        rows, "cdc.order_items", F.col("id").alias("item_id"), F.col("position"), F.col("shipped")
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic events topic: key is the user, payload the JSON properties."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("raw.events").alias("topic"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_amount_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic with the measured value as its payload."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").cast("binary").alias("key"),
        money(F.col("value")).cast("string").cast("binary").alias("value"),
        F.lit("raw.events").alias("topic"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def bronze(records: DataFrame) -> DataFrame:
    return parse_envelope(topic_values(records), RUN_TS)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(order_records(spark, sf_dir))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(customer_records(spark, sf_dir))


def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(item_records(spark, sf_dir))


def rate_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per nation and order day: the day's quotes of five codes and one other.

    Base is the nation; every rate comes from the order's own numbers.
    """
    codes = ("USD", "GBP", "CHF", "JPY", "CAD", "SEK")
    quotes = F.map_from_arrays(
        F.array(*[F.lit(c) for c in codes]),
        F.array(*[(F.col("c_custkey") * 7 + n + 1) / F.lit(8.0) for n, _ in enumerate(codes)]),
    )
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.to_json(
            F.struct(
                F.lit(1.0).alias("amount"),
                F.col("n_name").alias("base"),
                F.date_format(
                    F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_custkey").cast("int")),
                    "yyyy-MM-dd",
                ).alias("date"),
                quotes.alias("rates"),
            )
        ).alias("payload")
    )
