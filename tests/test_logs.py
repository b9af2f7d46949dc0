"""Log collection: opt-in, filters, phrase search, files and daily partitions."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import logs
from millrace.sources import container_logs, files
from millrace.streaming.drain import drain

CONTAINERS = [
    ("c1", "shop-demo-1", {logs.OPT_IN_LABEL: "true"}),
    ("c2", "shop-quiet-1", {}),
    ("c3", "shop-off-1", {logs.OPT_IN_LABEL: "false"}),
    ("c4", "other-demo-1", {logs.OPT_IN_LABEL: "True"}),
]


@pytest.fixture
def containers(spark):
    return spark.createDataFrame(CONTAINERS, "container_id string, container_name string, labels map<string,string>")


@pytest.fixture
def lines(spark):
    rows = [("c1", "demo log line 1"), ("c2", "quiet log line 1"), ("c3", "off log line 1"), ("c4", "loud"), ("c9", "unknown")]
    return spark.createDataFrame(rows, "container_id string, message string")


def test_only_opted_in_containers_are_collected(lines, containers):
    kept = logs.collect_opted_in(lines, containers)
    assert [row["message"] for row in kept.collect()] == ["demo log line 1"]
    assert logs.phrase_count(kept, "quiet log line").first()["n"] == 0
    # Negative control: collecting everything lets the unlabelled line through.
    assert logs.phrase_count(logs.collect_all(lines, containers), "quiet log line").first()["n"] == 1


def test_metadata_keeps_lines_of_unknown_containers(lines, containers):
    named = {row["message"]: row["container_name"] for row in logs.attach_metadata(lines, containers).collect()}
    assert named["unknown"] is None and named["loud"] == "other-demo-1" and len(named) == 5


def test_missing_label_is_dropped(lines, containers):
    named = logs.attach_metadata(lines, containers)
    kept = named.filter(logs.label_equals(logs.OPT_IN_LABEL, "false"))
    assert [row["container_id"] for row in kept.collect()] == ["c3"]


@pytest.mark.parametrize(
    "name, project, kept",
    [("a.b-web-1", "a.b", True), ("axb-web-1", "a.b", False), ("shop-web", "shop", False), ("my-shop-web-1", "shop", False), ("shop-web-12", "shop", True)],
)
def test_project_names_are_taken_literally(spark, name, project, kept):
    rows = spark.createDataFrame([(name,)], "container_name string")
    assert rows.filter(logs.in_project(project)).count() == int(kept)


@pytest.mark.parametrize(
    "message, found",
    [("Demo LOG line", True), ("demo, log: line!", True), ("demo log lines", False), ("demo the log line", False), ("xdemo log line", False)],
)
def test_phrase_needs_consecutive_words(spark, message, found):
    rows = spark.createDataFrame([(message,)], "message string")
    assert logs.phrase_count(rows, "demo log line").first()["n"] == int(found)


def test_phrases_are_counted_once_per_text(spark):
    texts = spark.createDataFrame([("a b a b c",), ("B C",), (None,), ("a",)], "text string")
    phrases = spark.createDataFrame([("a b",), ("b c",), ("c d",)], "phrase string")
    rows = {row["phrase"]: row["n"] for row in logs.phrase_counts(texts, phrases, 2).collect()}
    assert rows == {"a b": 1, "b c": 2, "c d": 0}


def write_log(spark, root, container, name, messages):
    body = "\n".join(json.dumps({"log": f"{text}\n", "stream": "stdout", "time": stamp}) for text, stamp in messages)
    path = files._path(spark, f"{root}/{container}/{name}")
    out = files._system(spark, root).create(path)
    out.write((body + "\nnot json\n").encode())
    out.close()


def test_files_are_read_with_their_container(spark, folder):
    root = folder("containers")
    write_log(spark, root, "c1", "c1-json.log", [("hello", "2024-01-01T10:00:00.5Z")])
    rows = container_logs.scan(spark, root).orderBy("message").collect()
    assert [(row["container_id"], row["message"], row["ts"]) for row in rows] == [
        ("c1", "hello", datetime(2024, 1, 1, 10, 0, 0, 500000)),
        ("c1", "not json", None),
    ]


def test_missing_folder_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        container_logs.scan(spark, folder("nowhere")).count()


def test_stream_reads_each_file_once_across_restarts(spark, folder):
    root, out, checkpoint = folder("containers"), folder("out"), folder("checkpoint")

    def run():
        found = container_logs.stream(spark, root).filter("ts IS NOT NULL")
        writer = found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        drain(writer.format("parquet").start(out), 120)

    write_log(spark, root, "c1", "a.log", [("one", "2024-01-01T10:00:00Z")])
    run()
    write_log(spark, root, "c2", "b.log", [("two", "2024-01-01T10:00:00Z")])
    run()
    assert sorted(row["message"] for row in spark.read.parquet(out).collect()) == ["one", "two"]


def test_daily_partitions(spark, folder):
    path = folder("daily")
    rows = spark.sql("SELECT 'c1' AS container_id, timestamp'2024-01-02 23:59:59' + make_dt_interval(0, 0, 0, id) AS ts FROM range(2)")
    container_logs.write_daily(rows, path)
    assert files.partition_values(spark, path, "day") == ["2024.01.02", "2024.01.03"]
    expired = spark.sql("SELECT '2024.01.24' AS day UNION ALL SELECT '2024.01.25'").filter(logs.expired(F.col("day"), "2024-01-31"))
    assert [row["day"] for row in expired.collect()] == ["2024.01.24"]


def test_forwarded_lines_are_read_as_those_of_container_folders(spark, folder):
    line = '{"log": "demo line\\n", "stream": "stdout", "time": "2024-01-31T10:00:00.000001Z"}'
    # A raw line may look like a forwarder's; a line may be empty.
    rows = [("c1", line), ("c1", "no json"), ("c2", '{"container_id": "c9", "line": "x"}'), ("c2", ""), ("a=b/c", line)]
    lines = spark.createDataFrame(rows, "container_id string, value string")
    apart, together = folder("apart"), folder("together")
    lines.filter("container_id <> 'a=b/c'").write.partitionBy("container_id").text(apart)
    container_logs.write_forwarded(lines, together)
    read = [sorted(map(str, container_logs.scan(spark, root, "*/*.txt").collect())) for root in (apart, together)]
    assert len(read[0]) == 4 and len(read[1]) == 5 and set(read[0]) < set(read[1])
    assert {r["message"] for r in container_logs.scan(spark, together, "*/*.txt").filter("container_id = 'c2'").collect()} == {"", rows[2][1]}


def test_forwarded_files_do_not_grow_in_number_with_containers(spark, folder):
    root = folder("many")
    lines = spark.range(3000).selectExpr("cast(id as string) as container_id", "concat('line ', id) as value")
    container_logs.write_forwarded(lines, root)
    assert len(spark.read.text(f"{root}/*/*.txt").inputFiles()) < 20
    found = container_logs.scan(spark, root, "*/*.txt")
    assert found.filter("message = concat('line ', container_id)").count() == 3000
