"""Silver and Gold kept up to date batch by batch, in time that follows the batch and not the history.

Silver holds the last version of each entity in hashed tables. What a batch changed there, as signed rows, moves
through three kinds of sums: per order (its image and the sums of its items), per day and currency, and per customer
(purchases per day, so that the first day can be taken back). Every sum is a hashed table too, so a batch reads the
buckets of the orders, customers and days that it changes.

All tables make one version per batch. A batch that broke off is finished by handing it in again under its run name:
tables that have it already are passed over. Readers take the last version that all tables have.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog import schemas
from tidelog.operators import gold
from tidelog.operators.changelog import VERSION_ORDER
from tidelog.operators.envelope import accepted, upserts
from tidelog.operators.silver import line_total, shaped
from tidelog.session import SCRATCH, new_folder
from tidelog.sources.hashed import ROWS, HashedTable, Resolve, added


def _new_facts(old: Column, new: Column) -> Column:
    """An order's last image, and its item sums with their changes."""
    image = schemas.ORDER_IMAGE.fieldNames()
    sums = added(tuple(schemas.ITEM_SUMS.fieldNames()), ("order_id",))(old, new)
    sided = [F.when(new["imaged"], new[n]).otherwise(old[n]).alias(n) for n in image]
    return F.struct(sums["order_id"].alias("order_id"), *sided, *[sums[n].alias(n) for n in schemas.ITEM_SUMS.fieldNames()])


def _new_buyer(old: Column, new: Column) -> Column:
    """A customer's sums with their changes; days on which nothing is left go."""
    sums = added(("orders", "revenue"), ("customer_id",))(old, new)
    empty = F.array().cast(schemas.BUYER_DAYS["days"].dataType)
    before, after = (F.map_from_entries(F.coalesce(side["days"], empty)) for side in (old, new))
    both = F.map_zip_with(before, after, lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    days = F.array_sort(F.map_entries(F.map_filter(both, lambda _, n: n != 0)))
    days = F.transform(days, lambda d: F.struct(d["key"].alias("day"), d["value"].alias("n")))
    return F.struct(*[sums[n].alias(n) for n in ("customer_id", "orders", "revenue")], days.alias("days"))


def _first_day(side: str = "days") -> Column:
    return F.get(side, F.lit(0))["day"]


@dataclass(frozen=True)
class Views:
    """The tables below a folder; ``rows`` is the target of their buckets."""

    spark: SparkSession
    root: str
    rows: int = ROWS

    def _table(self, name: str, schema: StructType, *key: str) -> HashedTable:
        return HashedTable(self.spark, f"{self.root}/{name}", schema, key, self.rows)

    def silver(self, entity: schemas.Entity) -> HashedTable:
        return self._table(f"silver-{entity.name}", schemas.image_schema(entity), entity.key)

    @property
    def facts(self) -> HashedTable:
        return self._table("order-facts", schemas.ORDER_FACTS, "order_id")

    @property
    def days(self) -> HashedTable:
        return self._table("day-sums", schemas.DAY_SUMS, "report_date", "currency")

    @property
    def buyers(self) -> HashedTable:
        return self._table("buyers", schemas.BUYER_DAYS, "customer_id")

    @property
    def newcomers(self) -> HashedTable:
        return self._table("newcomers", schemas.NEWCOMERS, "report_date")

    def tables(self) -> Iterator[HashedTable]:
        yield from map(self.silver, (schemas.ORDERS, schemas.CUSTOMERS, schemas.ORDER_ITEMS))
        yield from (self.facts, self.days, self.buyers, self.newcomers)

    def version(self) -> int:
        """The last version that all tables have."""
        return min(table.version() for table in self.tables())

    def _make(self, table: HashedTable, version: int, run: str | None, changes: DataFrame, resolve: Resolve, order: Sequence[str] = ()) -> None:
        """Merge changes unless the table has the version already; changes land first, they are read more than once."""
        last = table.directory()
        if last.version >= version:
            if last.run != run:
                raise ValueError(f"version {version} of {table.path} was begun by run {last.run!r}, not {run!r}; finish that one first")
            return
        path = new_folder(self.spark, "changes")
        changes.write.options(**SCRATCH).parquet(path)
        table.merge(self.spark.read.schema(changes.schema).parquet(path), resolve, run, order)

    def refresh(self, batch: Mapping[str, DataFrame], run: str | None = None) -> int:
        """Take in a batch of Bronze rows per entity name (orders, customers, order_items) and return the new version.

        Rows that came before are harmless, and so is any order of delivery across batches: the version order decides.
        """
        version = self.version() + 1
        for entity in (schemas.ORDERS, schemas.CUSTOMERS, schemas.ORDER_ITEMS):
            self.refresh_silver(entity, batch.get(entity.name), version, run)
        self._make(self.facts, version, run, self._fact_changes(version), _new_facts)
        self._make(self.days, version, run, self._day_changes(version), added(("orders", "items", "revenue"), ("report_date", "currency")))
        self._make(self.buyers, version, run, self._buyer_changes(version), _new_buyer)
        self._make(self.newcomers, version, run, self._newcomer_changes(version), added(("customers",), ("report_date",)))
        return version

    def refresh_silver(self, entity: schemas.Entity, rows: DataFrame | None, version: int, run: str | None = None) -> None:
        """Make a version of one Silver table from a batch of Bronze rows."""
        table = self.silver(entity)
        if rows is None:
            changes = self.spark.createDataFrame([], table.schema)
        else:
            changes = accepted(rows, entity).select(*table.schema.fieldNames())
        self._make(table, version, run, changes, table.newest(VERSION_ORDER), VERSION_ORDER)

    def _fact_changes(self, version: int) -> DataFrame:
        orders = self.silver(schemas.ORDERS).changes(version).where("sign = 1").withColumnRenamed("op", "_source_op")
        images = orders.select("order_id", *schemas.ORDER_IMAGE.fieldNames(), F.lit(True).alias("imaged"))
        items = self.silver(schemas.ORDER_ITEMS).changes(version).where(upserts())
        sums = gold.item_sums(items.select("*", line_total()), F.col("sign"))
        return images.join(sums, "order_id", "full_outer").withColumn("imaged", F.coalesce("imaged", F.lit(False)))

    def _revenue_changes(self, version: int) -> DataFrame:
        return gold.revenue_orders(self.facts.changes(version)).withColumn("currency", F.lit(None).cast("string"))

    def _day_changes(self, version: int) -> DataFrame:
        return gold.day_sums(self._revenue_changes(version), F.col("sign"))

    def _buyer_changes(self, version: int) -> DataFrame:
        """Signed purchases per customer and day, then per customer: at most one entry for each day there is."""
        sign = F.col("sign")
        by_day = self._revenue_changes(version).groupBy("customer_id", F.to_date("created_at").alias("day")).agg(
            F.sum(sign).alias("n"), F.sum(sign * F.coalesce("total_amount", F.lit(0))).alias("revenue")
        )
        entry = F.when(F.col("day").isNotNull(), F.struct("day", "n"))
        return by_day.groupBy("customer_id").agg(
            F.sum("n").alias("orders"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.collect_list(entry).alias("days")
        )

    def _newcomer_changes(self, version: int) -> DataFrame:
        first = self.buyers.changes(version).where("customer_id is not null").select("sign", _first_day().alias("report_date"))
        return first.groupBy("report_date").agg(F.sum("sign").alias("customers"))

    def silver_table(self, entity: schemas.Entity, version: int | None = None) -> DataFrame:
        """Live entities of a version in the shape of their Silver table; items without the time of their order."""
        target = {"orders": schemas.SILVER_ORDERS, "customers": schemas.SILVER_CUSTOMERS, "order_items": schemas.SILVER_ORDER_ITEMS}
        state = self.silver(entity).state(self.version() if version is None else version).where(upserts())
        if entity == schemas.ORDER_ITEMS:
            state = state.select("*", line_total())
        return shaped(state, target[entity.name])

    def daily_revenue(self, run_ts: str | None = None, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return gold.published_days(self.days.state(version).where("orders <> 0"), self.newcomers.state(version), run_ts)

    def customer_metrics(self, as_of: str, run_ts: str | None = None, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        buying = self.buyers.state(version).where("orders <> 0").select(
            "customer_id", "orders", "revenue", _first_day().alias("first_day"), F.try_element_at("days", F.lit(-1))["day"].alias("last_day")
        )
        customers = self.silver_table(schemas.CUSTOMERS, version)
        return gold.published_customers(customers, gold.recency(buying, as_of), run_ts)
