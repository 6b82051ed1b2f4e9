"""Work that is done once, spread over all cores and bounded by more than the size of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import history
from workload import logs

SMALL = "/root/testdata/sf0.001"


def test_records_are_written_by_several_tasks_per_core(spark):
    cores = spark.sparkContext.defaultParallelism
    for build in (logs.order_records, logs.customer_records, logs.item_records):
        assert build(spark, SMALL).rdd.getNumPartitions() == logs.TASKS_PER_CORE * cores


def counted(spark, rows, name):
    """``rows`` and a counter of how often a row was worked out."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def passed(value):
        seen.add(1)
        return value

    return rows.withColumn(name, passed.asNondeterministic()(name)), seen


def test_history_works_its_rows_out_once(spark, monkeypatch):
    monkeypatch.setattr(history, "RANGE", 20)  # several ranges, whose bounds are looked for first
    versions = spark.range(50).select(
        (F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("ts_ms"), F.col("id").alias("txn_id"), F.col("id").alias("offset"), F.lit("u").alias("op")
    )
    once, seen = counted(spark, versions, "offset")
    assert history.history(once, "k").where("valid_to is null").count() == 7
    assert seen.value == 50
    facts = versions.select("k", F.col("ts_ms").alias("at"))
    once, seen = counted(spark, versions, "offset")
    assert history.as_of_join(facts, once, "k", "at").where("version.ts_ms = at").count() == 50
    assert seen.value == 50


def test_rules_that_hold_are_not_taken_out_by_an_interpreted_filter(spark, capsys):
    from tidelog.operators import contracts

    images = spark.createDataFrame([(1, "{}"), (2, "[1]"), (3, '{"order_id": 1, "more": 2}')], "n int, after string")
    found = contracts.violations(images, "after", contracts.ORDER_CONTRACT)
    assert sorted((r.n, r.field) for r in found.collect() if r.rule != "required") == [(2, ""), (3, "more")]
    found.explain("extended")
    optimized = capsys.readouterr().out.split("Optimized Logical Plan")[1]
    assert "isnotnull(lambda" not in optimized


def test_state_stores_do_not_look_keys_up_to_count_them(spark):
    from tidelog.session import configure

    store = "spark.sql.streaming.stateStore.rocksdb."
    assert configure(spark).conf.get(f"{store}trackTotalNumberOfRows") == "false"
    assert spark.conf.get(f"{store}changelogCheckpointing.enabled") == "true"


def test_only_new_records_are_parsed_and_repeated_ones_count_once(spark, tmp_path):
    from changes import change, order, records

    from tidelog.operators.envelope import filled, parse_envelope, topic_values
    from tidelog.plans.medallion import append_new

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(value):
        seen.add(1)
        return value

    def parse(raw):
        return parse_envelope(raw.withColumn("raw_json", read.asNondeterministic()("raw_json")), "2024-06-01 00:00:00")

    path = str(tmp_path / "raw")
    raw = filled(topic_values(records(spark, [change("c", after=order(n)) for n in range(20)] + [None])))
    with_repeats = raw.unionByName(raw.where("offset < 9"))
    assert append_new(with_repeats.where("offset < 15"), "raw.cdc_orders", path, "2024-06-01 00:00:00", parse, True) == 15
    assert seen.value == 15
    assert append_new(with_repeats, "raw.cdc_orders", path, "2024-06-02 00:00:00", parse, True) == 5
    assert seen.value == 20
    assert sorted(r.offset for r in spark.read.parquet(path).collect()) == list(range(20))


def test_records_move_once_by_chunk_where_the_ledger_is_large(spark, capsys):
    from tidelog.session import setting
    from tidelog.sources.ledger import marked, merged, not_covered

    rows = spark.range(0, 200_000, 3).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("text").alias("payload"))
    state = merged(marked(rows.where("offset % 2 = 0")))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        fresh = not_covered(rows.unionByName(rows), state, repeats=True, landed=True)
        assert fresh.count() == rows.where("offset % 2 = 1").count()
        fresh.explain()
    moved = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line and "chunk" in line and "offset" in line.split("hashpartitioning(")[1].split(")")[0]]
    assert moved == []


def test_intervals_come_from_compiled_generators(spark, capsys):
    from tidelog.sources.ledger import intervals, marked, merged

    rows = spark.range(5, 70_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    found = intervals(merged(marked(rows.where("offset not in (9, 40000)"))))
    assert sorted((r.first_offset, r.last_offset) for r in found.collect()) == [(5, 8), (10, 39_999), (40_001, 69_999)]
    found.explain("extended")
    assert "lambda" not in capsys.readouterr().out


def test_the_settled_lane_keeps_images_in_a_table_and_not_in_calls_per_entity(spark):
    from changes import change, order, records

    from tidelog.session import new_folder
    from tidelog.sources.topics import Topic
    from tidelog.streaming.settled import SettledWindows, start_settled_windows

    root = new_folder(spark, "lane")
    topic, lane = Topic("cdc.orders", path=f"{root}/in"), SettledWindows(spark, f"{root}/lane", rows=2)
    first = [change("c", after=order(1), ts_ms=1), change("u", order(1), order(1, amount="7.00"), ts_ms=2), change("d", before=order(2), ts_ms=2)]
    second = [change("c", after=order(1), ts_ms=1), change("c", after=order(2), ts_ms=1), change("u", order(1), order(1, amount="8.00", minute=30), ts_ms=3)]
    operators = []
    for n, values in enumerate((first, second)):
        records(spark, values, offsets=range(3 * n, 3 * n + 3)).write.mode("append").parquet(topic.path)
        query = start_settled_windows(spark, topic, lane, f"{root}/checkpoint")
        query.awaitTermination()
        operators += [s for p in query.recentProgress for s in p["stateOperators"]]
    assert operators == []
    assert sorted((r.sign, r.updated_at.minute, str(r.total_amount)) for r in lane.images.changes(2).collect()) == [(-1, 0, "7.00"), (1, 30, "8.00")]


def test_the_classifier_describes_texts_in_small_blocks():
    import tracemalloc

    from tidelog.llm import pu_quality
    from tidelog.llm.common import blocks
    import pyarrow as pa

    column = pa.array(["some words of a text " * 50] * 8_000)
    tracemalloc.start()
    for _, held in blocks(column, pu_quality.BLOCK):
        pu_quality.features(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def method_sizes(df, capsys):
    """Largest method of each fused stage of a plan, in bytes."""
    from tidelog.session import setting

    capsys.readouterr()
    with setting(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        df.select("*").explain("codegen")
    return [int(text.split(";")[0]) for text in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]]


def test_merges_of_silver_images_are_short_enough_to_be_compiled(spark, tmp_path, capsys):
    from tidelog import schemas
    from tidelog.operators.changelog import VERSION_ORDER
    from tidelog.plans.incremental import Views
    from tidelog.session import setting
    from tidelog.sources.hashed import Directory

    views = Views(spark, str(tmp_path))
    with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        for entity in (schemas.ORDERS, schemas.CUSTOMERS, schemas.ORDER_ITEMS):
            table = views.silver(entity)
            changes = spark.createDataFrame([], table.schema)
            rebuilt = table._rebuilt(Directory(), 1, [0], changes, table.newest(VERSION_ORDER), 4, 4)
            sizes = method_sizes(rebuilt, capsys)
            assert sizes and max(sizes) < 8000


def test_longer_stages_are_not_fused(spark):
    from tidelog.session import configure

    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_record_texts_are_made_by_compiled_expressions(spark, capsys):
    for build in (logs.order_records, logs.customer_records, logs.item_records):
        capsys.readouterr()
        build(spark, SMALL).explain("extended")
        assert "lambda" not in capsys.readouterr().out.split("Optimized Logical Plan")[1]


def test_record_texts_are_those_of_the_json_writer(spark, tmp_path):
    """NULLs in every column; each text reads and writes back as it is."""
    for name in ("orders", "lineitem"):
        given = spark.read.parquet(f"{SMALL}/{name}.parquet").limit(300)
        holes = [F.when(F.pmod(F.xxhash64(*given.columns), F.lit(5 + n)) != 0, F.col(c)).alias(c) for n, c in enumerate(given.columns)]
        given.select(*holes).write.parquet(f"{tmp_path}/{name}.parquet")
    source = "source: struct<db: string, table: string, txId: bigint>"
    order = "struct<order_id: bigint, customer_id: bigint, status: string, total_amount: string, created_at: string, updated_at: string>"
    item = "struct<item_id: string, order_id: bigint, product_id: bigint, quantity: int, unit_price: string, created_at: string>"
    for build, image in ((logs.order_records, order), (logs.item_records, item)):
        texts = build(spark, str(tmp_path)).select(F.col("value").cast("string").alias("text")).where("text like '{%'")
        sides = (("before", "after"), ("after",), ("before",))
        found = 0
        for present in sides:
            schema = ", ".join([*[f"{side}: {image}" for side in present], "op: string, ts_ms: bigint", source])
            again = F.to_json(F.from_json("text", f"struct<{schema}>"), {"ignoreNullFields": "false"})
            written = texts.select("text", again.alias("again"))
            found += written.where("text = again").count()
        assert found == texts.count() >= 300


def test_scans_with_enough_tasks_stay_where_they_are(spark):
    from workload.logs import SCANS_PER_CORE, TASKS_PER_CORE, spread

    cores = spark.sparkContext.defaultParallelism
    few, many = (spread(spark.range(0, 1000, 1, n), "id") for n in (cores, SCANS_PER_CORE * cores))
    assert few.rdd.getNumPartitions() == TASKS_PER_CORE * cores and many.rdd.getNumPartitions() == SCANS_PER_CORE * cores
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()


def test_batches_of_bronze_rows_keep_their_record_ids(spark):
    from changes import bronze, change, order
    from workload.queries import _batches

    rows = bronze(spark, [change("c", after=order(n), ts_ms=n * 100_000_000_000) for n in range(12)])
    landed = [r for batch in _batches(rows) for r in batch.collect()]
    given = {r.offset: r for r in rows.collect()}
    assert {r.offset for r in landed} == set(given) and all(r == given[r.offset] for r in landed)
