"""Log lines in parts: joined within splits, across splits and files, and across micro-batches."""

import json
import os
import random

import pytest

from millrace.operators import lines
from millrace.sources import container_logs
from millrace.streaming.drain import drain


def part(text, stream="stdout", at="2024-01-01T00:00:00Z"):
    return json.dumps({"log": text, "stream": stream, "time": at})


def land(root, container, name, *rows):
    os.makedirs(f"{root}/{container}", exist_ok=True)
    with open(f"{root}/{container}/{name}", "w") as file:
        file.writelines(f"{row}\n" for row in rows)


def found(df):
    return sorted(((r["container_id"], r["stream"], r["message"], r["parts"]) for r in df.filter("ended").collect()), key=str)


def test_outputs_of_a_container_are_joined_apart(spark, tmp_path):
    land(tmp_path, "a", "0.log", part("one "), part("err ", "stderr"), part("line\n"), part("or\n", "stderr"), "not json", part("open"))
    land(tmp_path, "b", "0.log", part("whole\n"), part("\n"), part("x\r\n"))
    joined = container_logs.scan_joined(spark, str(tmp_path))
    assert found(joined) == sorted(
        [("a", "stdout", "one line", 2), ("a", "stderr", "err or", 2), ("a", None, "not json", 1), ("b", "stdout", "whole", 1), ("b", "stdout", "", 1), ("b", "stdout", "x", 1)], key=str
    )
    assert [(r["message"], r["parts"]) for r in joined.filter("NOT ended").collect()] == [("open", 1)]


@pytest.mark.parametrize("split_bytes", ["200", "1000", "10m"])
def test_lines_over_many_splits_and_files(spark, tmp_path, split_bytes):
    """Splits of a few rows cut lines at any place, also lines that span several splits and files."""
    rng = random.Random(3)
    wanted, rows = [], []
    for n in range(150):
        pieces = [f"{n}-{k};" for k in range(rng.choice((1, 1, 2, 5, 40)))]
        rows += [part(p) for p in pieces[:-1]] + [part(pieces[-1] + "\n")]
        wanted.append(("c", "stdout", "".join(pieces), len(pieces)))
    for number in range(4):
        land(tmp_path, "c", f"{number}.log", *rows[number * len(rows) // 4 : (number + 1) * len(rows) // 4])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert found(container_logs.scan_joined(spark, str(tmp_path))) == sorted(wanted, key=str)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_line_without_a_mark_joined_by_time_alone_would_be_wrong(spark, tmp_path):
    """Negative control: parts share their time, so sorting by it does not restore a line."""
    land(tmp_path, "a", "0.log", part("b"), part("a\n"))
    assert found(container_logs.scan_joined(spark, str(tmp_path))) == [("a", "stdout", "ba", 2)]


def test_an_open_line_is_carried_over_batches_and_restarts(spark, tmp_path, folder):
    root, base = tmp_path / "in", folder("joined")
    batches = [
        [("a", part("one ")), ("b", part("whole\n"))],
        [("a", part("two "))],
        [("b", part("b only\n"))],
        [("a", part("three\n")), ("a", part("next")), ("b", part("open"))],
        [("a", part(" line\n"))],
    ]
    for number, rows in enumerate(batches):
        for container in "ab":
            own = [row for c, row in rows if c == container]
            if own:
                land(root, container, f"{number}.log", *own)
        stream = container_logs.stream_parts(spark, str(root))
        writer = stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        drain(writer.foreachBatch(container_logs.joined_writer(spark, base)).start(), 120)
    got = [(r["container_id"], r["message"], r["parts"]) for r in container_logs.read_joined(spark, base).collect()]
    assert sorted(got) == [("a", "next line", 2), ("a", "one two three", 3), ("b", "b only", 1), ("b", "whole", 1)]
    assert len(os.listdir(f"{base}/carry")) <= 3


def test_a_repeated_batch_joins_the_same_lines(spark, tmp_path, folder):
    path = folder("joined")
    land(tmp_path, "a", "0.log", part("one "))
    land(tmp_path, "b", "1.log", part("two\n"))
    write = container_logs.joined_writer(spark, path)
    first, second = (container_logs._read(spark.read.text(f"{tmp_path}/{c}")) for c in "ab")
    for batch_id, rows in ((0, first), (0, first), (1, second), (1, second)):
        write(rows, batch_id)
    assert [(r["container_id"], r["message"]) for r in container_logs.read_joined(spark, path).collect()] == [("b", "two")]


def test_no_task_gets_all_of_a_container(spark, tmp_path):
    land(tmp_path, "a", "0.log", part("x\n"))
    text = lines.join_parts(container_logs.parts_of(container_logs._read(spark.read.text(f"{tmp_path}/a"))))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
