"""The spool source: byte offsets, torn lines, ranges, restarts."""

import json
import os

import pytest

from clickloom.sources.spool import SpoolReader, spool_feed
from clickloom.streaming.run import append_files, keep_running, start_batches
from clickloom.streaming.report import RunReport, observed, totals
from pyspark.sql import functions as F
from tests.conftest import SAMPLE, click


def read_all(reader, start, end):
    """Lines and places of all ranges between two offsets."""
    return [(p.name, at, event) for p in reader.partitions(start, end) for batch in reader.read(p)
            for event, at in zip(batch.column("event").to_pylist(), batch.column("at").to_pylist())]


@pytest.mark.parametrize("range_bytes", [1, 3, 7, 64, 1 << 20])
@pytest.mark.parametrize("block", [2, 5, 1 << 20])
def test_ranges_hold_every_line_once(tmp_path, monkeypatch, range_bytes, block):
    monkeypatch.setattr("clickloom.sources.spool.BLOCK_BYTES", block)
    texts = ["", "a", "bb", "", "c" * 40, "é" * 9, "last", "x\ry"]
    data = "".join(t + "\n" for t in texts).encode()
    (tmp_path / "b.jsonl").write_bytes(data + b"torn li")
    (tmp_path / "a.jsonl").write_bytes(b"no end yet")
    (tmp_path / ".hidden").write_bytes(b"x\n")
    reader = SpoolReader(str(tmp_path), range_bytes)
    end = reader.latestOffset()
    assert end == {"a.jsonl": 0, "b.jsonl": len(data)}
    found = read_all(reader, {}, end)
    assert [event for _, _, event in found] == texts
    assert all(data[at:].startswith(event.encode() + b"\n") for _, at, event in found)
    with open(tmp_path / "b.jsonl", "ab") as file:
        file.write(b"ne\nmore\n")
    later = reader.latestOffset()
    assert [event for _, _, event in read_all(reader, end, later)] == ["torn line", "more"]
    assert read_all(reader, later, later) == []


def test_an_empty_or_missing_spool(tmp_path):
    assert SpoolReader(str(tmp_path / "none")).latestOffset() == {}
    assert SpoolReader(str(tmp_path)).latestOffset() == {}


def line(**changes):
    return json.dumps(click(**changes), separators=(",", ":"), ensure_ascii=False)


def test_restarts_lose_and_repeat_nothing(spark, folder):
    path, out, state = folder("spool"), folder("out"), folder("state")
    os.makedirs(path)
    failures = [1]

    def start():
        def write(batch, n):
            rows = batch.select("event", F.lit(n).alias("n"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("n").parquet(out)
            if n == 1 and failures:
                failures.pop()
                raise OSError("the connection broke")
        return start_batches(spool_feed(spark, path, range_bytes=100), write, state)

    def add(name, text):
        with open(f"{path}/{name}", "a", encoding="utf-8") as file:
            file.write(text)

    add("one.jsonl", line(_id="1") + "\n" + line(_id="2")[:30])
    keep_running(start)
    add("one.jsonl", line(_id="2")[30:] + "\n")
    add("two.jsonl", "".join(line(_id=str(k)) + "\n" for k in range(3, 40)))
    keep_running(start, tries=2, pause=0)
    assert not failures
    keep_running(start)
    got = [json.loads(row.event) for row in spark.read.parquet(out).collect()]
    assert sorted(int(e["_id"]) for e in got) == list(range(1, 40))
    assert got[0]["cy"] == SAMPLE["cy"]


def test_failures_are_raised_in_the_end(spark, folder):
    path = folder("spool")
    os.makedirs(path)
    with open(f"{path}/one.jsonl", "w") as file:
        file.write(line() + "\n")
    state, tried = folder("state"), []

    def fail(batch, n):
        tried.append(n)
        raise OSError("broken for good")

    with pytest.raises(Exception, match="broken for good"):
        keep_running(lambda: start_batches(spool_feed(spark, path), fail, state), tries=2, pause=0)
    assert tried == [0, 0]


def test_run_report(spark, folder):
    path, report, state, out = folder("spool"), RunReport(), folder("state"), folder("out")
    os.makedirs(path)
    spark.streams.addListener(report)
    try:
        for k, texts in enumerate([[line(), '{"_note":1}'], [line(), line(), "", "x"]]):
            with open(f"{path}/{k}.jsonl", "w", encoding="utf-8") as file:
                file.write("".join(t + "\n" for t in texts))
            rows = observed(spool_feed(spark, path)).select(F.lit("d").alias("date"), "event")
            query = append_files(rows, out, state)
            query.awaitTermination()
            report.wait(query)
    finally:
        spark.streams.removeListener(report)
    assert [(r.batch, r.lines, r.clicks) for r in report.rows(spark).orderBy("batch").collect()] == [(0, 2, 1), (1, 4, 2)]
    done = totals(report.rows(spark)).first()
    assert (done.batches, done.lines, done.clicks) == (2, 6, 3) and done.clicks_per_second > 0
    assert totals(RunReport().rows(spark)).first().lines == 0
