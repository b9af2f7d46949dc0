"""Batch tables: golden reports, repeated loads, merges, retention, compaction."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import revenue
from millrace.operators.merge import merge_rows
from millrace.sources import files, keyed, tables


def test_golden_reports(spark):
    sales = tables.sample_sales(spark)
    by_category = [(r["category"], str(r["revenue"]), r["order_count"]) for r in revenue.sales_by_category(sales).collect()]
    assert by_category == [("audio", "387.00", 2), ("peripherals", "378.92", 5), ("accessories", "215.90", 3)]
    top = [(r["customer_id"], str(r["total_spend"])) for r in revenue.top_customers(sales).collect()]
    assert top == [("CUST-01", "270.98"), ("CUST-04", "258.00"), ("CUST-02", "238.99")]


def test_plain_append_twice_doubles_and_reload_does_not(spark, folder):
    table = tables.LoadedTable(spark, folder("sales"))
    sales = tables.sample_sales(spark)
    table.append(sales)
    table.append(sales)
    assert table.read().count() == 20
    assert revenue.load_check(table.read(), "order_id").first()["surplus_rows"] == 10
    assert revenue.repeated_keys(table.read(), "order_id").count() == 10
    table.refresh(sales)
    table.refresh(sales)
    assert table.read().count() == 10
    operations = [row["operation"] for row in table.history().collect()]
    assert operations == ["append", "append", "delete", "append", "delete", "append"]
    assert table.expire() == 2
    assert table.read().count() == 10


def test_failed_reload_leaves_the_old_rows(spark, folder):
    table = tables.LoadedTable(spark, folder("sales"))
    sales = tables.sample_sales(spark)
    table.refresh(sales)
    broken = sales.withColumn("product", F.raise_error(F.lit("source broke")).cast("string"))
    with pytest.raises(Exception, match="source broke"):
        table.refresh(broken)
    assert table.read().count() == 10
    # Files of an attempt that was never committed do not come back later.
    tables.write_partitioned(sales, f"{table.data}/load_id=2", "category", "append")
    table.refresh(sales)
    assert table.read().count() == 10


def test_unwritten_table_raises(spark, folder):
    with pytest.raises(FileNotFoundError):
        tables.LoadedTable(spark, folder("nothing")).read()


def test_reports_read_only_their_columns_and_partitions(spark, folder):
    path = folder("pruned")
    tables.write_partitioned(tables.sample_sales(spark), path, "category", "append")
    sales = spark.read.schema(tables.SALES_SCHEMA).parquet(path)
    plan = revenue.spend_by_customer(sales.filter("category = 'audio'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    assert "ReadSchema: struct<customer_id:string,quantity:int,unit_price:decimal(10,2)>" in plan


CHANGES = [
    ("ORD-1006", "CUST-04", "noise-cancelling-headset", "clearance", 2, "99.00"),
    ("ORD-1007", "CUST-01", "noise-cancelling-headset", "clearance", 1, "99.00"),
    ("ORD-2000", "CUST-09", "usb-c-hub", "accessories", 1, "34.00"),
]


def changes_frame(spark):
    rows = spark.createDataFrame(CHANGES, "order_id string, customer_id string, product string, category string, quantity int, unit_price string")
    return rows.withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).withColumn("order_date", F.lit("2026-02-01").cast("date"))


def test_merge_moves_rows_between_partitions(spark, folder):
    path = folder("merge")
    sales = tables.sample_sales(spark)
    tables.write_partitioned(sales, path, "category", "append")
    untouched = spark.read.parquet(f"{path}/category=peripherals").inputFiles()
    wanted = sorted(map(tuple, merge_rows(sales, changes_frame(spark), "order_id").collect()))

    def stored():
        columns = sales.columns
        return sorted(map(tuple, spark.read.schema(tables.SALES_SCHEMA).parquet(path).select(*columns).collect()))

    touched = tables.merge_into_path(spark, path, changes_frame(spark), tables.SALES_SCHEMA, "order_id", "category")
    assert touched == ["accessories", "audio", "clearance"]
    assert stored() == wanted and len(wanted) == 11
    # The partition that lost all its rows is gone, and the others were left alone.
    assert "audio" not in files.partition_values(spark, path, "category")
    assert spark.read.parquet(f"{path}/category=peripherals").inputFiles() == untouched
    tables.merge_into_path(spark, path, changes_frame(spark), tables.SALES_SCHEMA, "order_id", "category")
    assert stored() == wanted


def test_merge_keeps_rows_without_a_category(spark, folder):
    path = folder("merge-null")
    schema = "id int, n int, category string"
    target = spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 1, "a"), (4, 1, "")], schema)
    tables.write_partitioned(target, path, "category", "append")
    changes = spark.createDataFrame([(1, 2, "a"), (3, 2, None), (5, 2, None)], schema)
    wanted = {(1, 2, "a"), (2, 1, None), (3, 2, None), (4, 1, None), (5, 2, None)}
    for _ in range(2):
        touched = tables.merge_into_path(spark, path, changes, schema, "id", "category")
        assert touched == ["a", None]
        assert {tuple(row) for row in spark.read.schema(schema).parquet(path).collect()} == wanted
    moved = spark.createDataFrame([(n, 3, "b") for n in (2, 3, 4, 5)], schema)
    tables.merge_into_path(spark, path, moved, schema, "id", "category")
    assert files.partition_values(spark, path, "category") == ["a", "b"]


def test_catalog_table_is_created_once(spark, folder):
    location = folder("catalog")
    for _ in range(2):
        tables.create_table(spark, "sales_created_once", location)
    names = spark.table("sales_created_once").columns
    assert names[-1] == "category"
    for _ in range(2):
        tables.sample_sales(spark).select(*names).write.insertInto("sales_created_once", overwrite=True)
    assert spark.table("sales_created_once").count() == 10


def test_retention_drops_days_of_that_age(spark, folder):
    path = folder("days")
    days = spark.sql("SELECT explode(array('2024.01.23', '2024.01.24', '2024.01.25', '2024.01.31')) AS day, 'x' AS message")
    tables.write_partitioned(days, path, "day", "append")
    assert tables.drop_expired_days(spark, path, "2024-01-31") == ["2024.01.23", "2024.01.24"]
    assert files.partition_values(spark, path, "day") == ["2024.01.25", "2024.01.31"]
    assert tables.drop_expired_days(spark, path, "2024-01-31") == []
    # Lines without a time have no age and do not stand in the way.
    undated = spark.sql("SELECT CAST(NULL AS STRING) AS day, 'x' AS message UNION ALL SELECT '2024.01.20', 'y'")
    tables.write_partitioned(undated, path, "day", "append")
    assert tables.drop_expired_days(spark, path, "2024-01-31") == ["2024.01.20"]
    assert spark.read.parquet(path).filter("day IS NULL").count() == 1


def test_compaction_keeps_rows_in_fewer_files(spark, folder):
    path = folder("compact")
    tables.sample_sales(spark).repartition(5).write.partitionBy("category").parquet(path)
    rows = sorted(map(tuple, spark.read.parquet(path).collect()))
    files_before = len(spark.read.parquet(f"{path}/category=peripherals").inputFiles())
    tables.compact_partition(spark, path, "category", "peripherals")
    spark.catalog.refreshByPath(path)
    assert files_before > 1
    assert len(spark.read.parquet(f"{path}/category=peripherals").inputFiles()) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows


def test_partition_names_with_special_characters(spark, folder):
    path = folder("names")
    rows = spark.createDataFrame([("a/b c", 1), ("x=y", 2)], "category string, n int")
    rows.write.partitionBy("category").parquet(path)
    assert files.partition_values(spark, path, "category") == ["a/b c", "x=y"]
    files.drop_partition(spark, path, "category", "a/b c")
    assert files.partition_values(spark, path, "category") == ["x=y"]


def test_csv_report(spark, folder):
    path = folder("csv")
    tables.write_csv(revenue.sales_by_category(tables.sample_sales(spark)), path)
    lines = [row["value"] for row in spark.read.text(path).collect()]
    assert "audio,387.00,2" in lines


def test_small_files_of_all_partitions_are_packed_in_one_job(spark, folder):
    path = folder("compacted")
    rows = spark.range(4000).selectExpr("id", "repeat(cast(id as string), 20) AS filler", "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a b' WHEN 2 THEN 'b' ELSE 'c' END AS kind")
    for part in range(6):
        rows.filter(f"(kind IS NULL OR kind <> 'c') AND id % 6 = {part}").write.mode("append").partitionBy("kind").parquet(path)
    rows.filter("kind = 'c'").coalesce(1).write.mode("append").partitionBy("kind").parquet(path)
    before = {r["f"] for r in spark.read.parquet(path).filter("kind = 'c'").selectExpr("_metadata.file_path AS f").distinct().collect()}
    assert tables.compact_table(spark, path, "kind") == ["a b", "b", None]
    found = spark.read.schema("id long, filler string, kind string").parquet(path)
    sizes = {r["kind"]: r["n"] for r in found.selectExpr("kind", "_metadata.file_path AS f").groupBy("kind").agg(F.count_distinct("f").alias("n")).collect()}
    assert sizes == {None: 1, "a b": 1, "b": 1, "c": 1}
    assert before == {r["f"] for r in found.filter("kind = 'c'").selectExpr("_metadata.file_path AS f").distinct().collect()}
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))
    assert tables.compact_table(spark, path, "kind") == []


def test_files_are_packed_up_to_the_size_asked_for(spark, folder):
    path = folder("grouped")
    spark.range(8000).selectExpr("id", "uuid() AS filler", "'x' AS kind").repartition(8).write.partitionBy("kind").parquet(path)
    size = tables.files.folder_bytes(spark, path)
    tables.compact_table(spark, path, "kind", file_bytes=size // 3)
    found = spark.read.parquet(path)
    assert found.count() == 8000
    assert found.selectExpr("_metadata.file_path AS f").distinct().count() in (1, 2, 3, 4)


def test_fifty_batches_leave_few_folders_and_the_same_rows(spark, folder):
    path, plain = folder("folded"), folder("plain")
    schema, key = "k int NOT NULL, v string NOT NULL", ["k"]
    writers = [keyed.upsert_writer(path, schema, key, fold_every=4), keyed.upsert_writer(plain, schema, key, fold_every=1000)]
    for batch_id in range(18):
        batch = spark.createDataFrame([(k, f"{batch_id}") for k in range(12) if (k + batch_id) % 5 == 0], "k int, v string")
        for write in writers:
            write(batch, batch_id)
        writers[0](batch, batch_id)  # a repeat, as after a crash
    found, wanted = (sorted(map(tuple, keyed.read_latest(spark, p, schema, key).collect())) for p in (path, plain))
    assert found == wanted and len(found) == 12
    assert len(keyed.files.partition_values(spark, plain, "batch_id")) == 18
    assert keyed.files.partition_values(spark, path, "batch_id") == ["15", "16", "17"]


def test_the_first_copy_stays_through_folds(spark, folder):
    path = folder("first")
    schema, key = "k int NOT NULL, v string NOT NULL, received_at timestamp NOT NULL", ["k"]
    write = keyed.insert_writer(path, schema, key, fold_every=2)
    for batch_id in range(7):
        write(spark.createDataFrame([(0, f"{batch_id}"), (batch_id, "own")][: 1 + (batch_id > 0)], "k int, v string"), batch_id)
    rows = {r["k"]: r["v"] for r in keyed.read_first(spark, path, schema, key).collect()}
    assert rows == {0: "0", **{n: "own" for n in range(1, 7)}}


def test_a_batch_that_became_empty_leaves_nothing(spark, folder):
    path = folder("emptied")
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    keyed.write_batch(rows, path, 0)
    keyed.write_batch(rows, path, 1)
    keyed.write_batch(rows.filter("k > 1"), path, 1)
    assert keyed.files.partition_values(spark, path, "batch_id") == ["0"]


def test_retention_by_creation_counts_from_the_first_write(spark, folder):
    path, registry = folder("shipped"), folder("created")

    def ship(days, as_of):
        rows = spark.createDataFrame([(day, "x") for day in days], "day string, message string")
        tables.write_partitioned(rows, path, "day", "append")
        return tables.note_partitions(spark, path, registry, "day", as_of)

    assert ship(["2024.01.01", "2024.01.20", None], "2024-01-20") == ["2024.01.01", "2024.01.20", files.NO_VALUE]
    assert tables.note_partitions(spark, path, registry, "day", "2024-01-21") == []
    # An old day written late is new; a day that gains rows keeps its age.
    assert ship(["2024.01.02", "2024.01.20"], "2024-01-27") == ["2024.01.02"]
    assert tables.drop_by_creation(spark, path, registry, "day", "2024-01-26") == []
    assert tables.drop_by_creation(spark, path, registry, "day", "2024-01-27") == ["2024.01.01", "2024.01.20", None]
    assert files.partition_values(spark, path, "day") == ["2024.01.02"] == files.partition_values(spark, registry, "day")
    # A dropped day that is written again has a new age.
    assert ship(["2024.01.20"], "2024-01-30") == ["2024.01.20"]
    assert tables.drop_by_creation(spark, path, registry, "day", "2024-02-03") == ["2024.01.02"]
    # Negative control: by its name that day would go too.
    assert tables.drop_expired_days(spark, path, "2024-02-03") == ["2024.01.20"]


def test_splits_without_rows_do_not_count_as_tasks(spark, folder):
    """A row group lies in one split; a table of one group is dealt out however many splits it has."""
    path = folder("one-group")
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    try:
        for name, value in zip(names, ("262144", "0")):
            spark.conf.set(name, value)
        whole = spark.read.parquet(path)
        assert whole.rdd.getNumPartitions() > 8 and whole.groupBy(F.spark_partition_id()).count().count() == 1
        for options, tasks in (({}, 4), ({"task_bytes": 1 << 20}, files.folder_bytes(spark, path) >> 20)):
            found = tables.read_spread(spark, path, **options)
            sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) == tasks >= 4 and max(sizes) < 1.1 * 200_000 / tasks and sum(sizes) == 200_000
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
