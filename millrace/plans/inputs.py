"""Inputs of the registered queries, derived from the given tables.

The derivations use arithmetic and text functions only, so that the SQL twin of each query
can repeat them without sharing any code with the operators under test.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import token_runs, tokens
from millrace.sources.tables import read_spread

RETENTION_AS_OF = "2024-01-31"
LOG_PHRASES = ("CLICK log-line", "Line 77", "log click")
FIRST_SHIPPED, SECOND_SHIPPED = "2024-01-20", "2024-01-28"
OUTAGE = ("2024-01-10 00:00:00", "2024-01-12 00:00:00")
CACHE_TTL = timedelta(days=1)
CACHE_SNAPSHOT = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
STREAM_END = datetime(2030, 1, 1)
# A task of messages gets about so much of the events file, some 200,000 rows.
EVENT_TASK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, task_bytes: int | None = None) -> DataFrame:
    """A table whose rows are costly to work on, over all cores even when it is one small file."""
    return read_spread(spark, f"{sf_dir}/{name}.parquet", task_bytes=task_bytes)


def iso_utc(ts: Column) -> Column:
    """A zoned ISO-8601 text, as an order producer writes it."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order messages, 12 of 20 well formed and one of each of eight malformed kinds.

    Among the well-formed ones are very large and very small line totals, among the others some
    of more than 12,000 characters. Columns are those of a message log (topic, partition, offset,
    value) and ``ts``, the time by which a stream replays them.
    """
    event_id = F.col("event_id")
    kind = event_id % 20
    order_id = F.concat(F.lit('"order_id": "o'), event_id.cast("string"), F.lit('"'))
    product = F.concat(F.lit('"product": "'), F.col("event_type"), F.lit('"'))
    rare = event_id % 100
    amount = F.when(rare == 28, F.lit("4.5")).when(rare == 29, F.lit("4e-7")).otherwise(F.col("value").cast("string"))
    count = F.when(rare == 28, F.lit(2147483647)).when(rare == 29, F.lit(1_000_000_000)).otherwise(1 + event_id % 4)
    price = F.concat(F.lit('"price": '), amount)
    quantity = F.concat(F.lit('"quantity": '), count.cast("string"))
    note = F.when(event_id % 500 == 3, F.concat(F.lit('"note": "'), F.repeat(F.lit("x"), 12_000), F.lit('"')))
    stamp = F.concat(F.lit('"ts": "'), iso_utc(F.col("ts")), F.lit('"'))

    def document(*fields: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))

    value = (
        F.when(kind == 0, F.concat(F.lit("this is not json "), event_id.cast("string")))
        .when(kind == 1, document(order_id, price, quantity, stamp))
        .when(kind == 2, document(order_id, product, price, quantity))
        .when(kind == 3, document(order_id, product, F.lit('"price": "x"'), quantity, stamp, note))
        .when(kind == 4, document(order_id, product, price, quantity, F.lit('"ts": "garbage"')))
        .when(kind == 5, F.lit("[1]"))
        .when(kind == 6, document(order_id, F.lit('"product": ""'), price, quantity, stamp))
        .when(kind == 7, F.lit(""))
        .otherwise(document(order_id, product, price, quantity, stamp))
    )
    return spread_table(spark, sf_dir, "events", EVENT_TASK_BYTES).select(
        F.lit("orders").alias("topic"),
        (event_id % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        value.alias("value"),
        "ts",
    )


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2a: one row per order line, with the sales columns."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )
    )


def _category(part_type: Column, order_key: Column) -> Column:
    """The category of an order; some have none."""
    return F.when(order_key % 11 != 0, part_type)


def _orders_with_part(spark: SparkSession, sf_dir: str, part_shift: Column, order_id: Column, quantity: Column) -> DataFrame:
    """Orders with the part whose key is theirs plus ``part_shift``, modulo the number of parts."""
    n_parts = table(spark, sf_dir, "part").count()
    part_key = (F.col("o_orderkey") + part_shift) % n_parts
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").withColumn("part_key", part_key)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return orders.join(parts, F.col("part_key") == F.col("p_partkey")).select(
        order_id.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("p_name").alias("product"),
        _category(F.col("p_type"), F.col("o_orderkey") + part_shift).alias("category"),
        quantity.cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderkey"),
    )


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2b: sales orders with a unique ``order_id``."""
    key = F.col("o_orderkey")
    return _orders_with_part(spark, sf_dir, F.lit(0), key, 1 + key % 5).drop("o_orderkey")


def sales_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes to F2b: corrected orders, some of which gain, lose or change their category, and new orders."""
    key = F.col("o_orderkey")
    moved = F.when(key % 9 == 0, 1).otherwise(0)
    corrected = _orders_with_part(spark, sf_dir, moved, key, 2 + key % 5).filter(key % 3 == 0)
    added = _orders_with_part(spark, sf_dir, F.lit(0), key + 1_000_000_000, 1 + key % 5).filter(key % 50 == 0)
    return corrected.unionByName(added).drop("o_orderkey")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """queue messages with JSON bodies and headers whose values are JSON literals."""
    event_id = F.col("event_id")
    text_id = event_id.cast("string")
    failures = (event_id % 6).cast("string")
    body = (
        F.when(event_id % 17 == 0, F.lit("{this is not json"))
        .when(event_id % 17 == 1, F.concat(F.lit('{"simulate_failures": '), failures, F.lit("}")))
        .when(event_id % 17 == 2, F.lit("[1]"))
        .when(event_id % 17 == 3, F.concat(F.lit('{"order_id": "o'), text_id, F.lit('", "simulate_failures": "abc"}')))
        .otherwise(F.concat(F.lit('{"order_id": "o'), text_id, F.lit('", "simulate_failures": '), failures, F.lit("}")))
    )
    headers = (
        F.when(event_id % 23 == 0, F.create_map(F.lit("x-retry-count"), F.lit('"bad"')))
        .when(event_id % 23 == 1, F.create_map(F.lit("x-retry-count"), F.lit("-1")))
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    return spread_table(spark, sf_dir, "events", EVENT_TASK_BYTES).select(
        event_id.alias("message_id"), body.alias("body"), headers.alias("headers"), F.col("ts").alias("delivered_at")
    )


def cache_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reads of a key, and invalidations of it, in time order."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        "ts",
        F.col("event_id").alias("seq"),
        (F.col("event_type") != "error").alias("is_read"),
    )


def fenced_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """writes to a key, each under the fence its lease was granted with."""
    event_id = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        "ts",
        event_id.alias("seq"),
        (event_id * 7919 % 10007).alias("fence"),
        "value",
    )


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slow source behind the cache: one value per key."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))


def customer_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cache holds: one market segment, loaded and expiring at fixed times."""
    loaded, expires = CACHE_SNAPSHOT
    return (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(
            F.col("c_custkey").alias("key"),
            F.concat(F.lit("cached "), F.col("c_name")).alias("value"),
            F.lit(loaded).cast("timestamp_ntz").alias("loaded_at"),
            F.lit(expires).cast("timestamp_ntz").alias("expires_at"),
        )
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log lines by container; some have lost their time."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("container_id"),
        F.concat(F.col("event_type"), F.lit(" log line "), F.col("event_id").cast("string")).alias("message"),
        F.lit("stdout").alias("stream"),
        F.when(F.col("event_id") % 97 != 5, F.col("ts")).alias("ts"),
    )


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as a runtime writes them when it cuts each into one to five parts.

    ``value`` is the text of a part's row; rows go by (container_id, event_id, number).
    """
    event_id = F.col("event_id")
    message = F.concat(F.col("event_type"), F.lit(" log line "), event_id.cast("string"))
    lines = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("container_id"), "event_id", message.alias("message"), "ts", (1 + event_id % 5).alias("parts"))
    parts = lines.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    start = lambda n: F.call_function("div", F.length("message") * n, F.col("parts"))
    piece = F.substring("message", (start(F.col("number")) + 1).cast("int"), (start(F.col("number") + 1) - start(F.col("number"))).cast("int"))
    last = F.col("number") == F.col("parts") - 1
    row = F.struct(
        F.concat(piece, F.when(last, F.lit("\n")).otherwise(F.lit(""))).alias("log"),
        F.when(event_id % 2 == 0, F.lit("stdout")).otherwise(F.lit("stderr")).alias("stream"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("time"),
        "container_id",
    )
    return parts.select("container_id", "event_id", "number", F.to_json(row).alias("value"))


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """container metadata, one row per container that ever logged.

    The service of a container is the first event type it logged.
    """
    user = F.col("user_id")
    first_type = F.min_by("event_type", F.struct("ts", "event_id"))
    project = F.when(user % 2 == 0, F.lit("project")).otherwise(F.lit("other"))
    label = F.when(user % 3 == 0, F.lit("true")).when(user % 3 == 1, F.lit("false"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(first_type.alias("service"))
        .select(
            user.cast("string").alias("container_id"),
            F.concat_ws("-", project, "service", user.cast("string")).alias("container_name"),
            F.when(label.isNotNull(), F.create_map(F.lit("co.elastic.logs/enabled"), label))
            .otherwise(F.create_map().cast("map<string,string>"))
            .alias("labels"),
        )
    )


def benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the two-word phrases found in the benchmark texts."""
    runs = token_runs(tokens(F.col("text")), 2)
    return table(spark, sf_dir, "benchmark").select(F.explode(runs).alias("phrase")).distinct()
