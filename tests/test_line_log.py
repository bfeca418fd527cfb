"""The line log: every line once, whatever the ranges, restarts and half-written ends."""

import json
import random
from collections import Counter

import pytest

from trisketch.streaming import line_log as ll


def reader(path, **options):
    return ll.LineLogReader({"path": str(path), **{k: str(v) for k, v in options.items()}})


def read(log, start, end):
    return [v.as_py() for part in log.partitions(start, end) for batch in log.read(part) for v in batch.column(0)]


@pytest.mark.parametrize("task_bytes", [1, 2, 7, 64, 10**6])
def test_ranges_hold_every_line_once(tmp_path, monkeypatch, task_bytes):
    monkeypatch.setattr(ll, "READ_BYTES", 5)
    rng = random.Random(task_bytes)
    files = [["x" * rng.randint(0, 12) for _ in range(rng.randint(0, 15))] for _ in range(4)]
    for i, lines in enumerate(files):
        (tmp_path / f"{i}.txt").write_text("".join(line + "\n" for line in lines))
    log = reader(tmp_path, taskBytes=task_bytes)
    assert read(log, log.initialOffset(), log.latestOffset()) == [line for lines in files for line in lines]


def test_a_half_written_line_waits(tmp_path):
    log = reader(tmp_path / "log")
    assert log.latestOffset() == log.initialOffset()
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "_note").write_text("no line\n")
    file = tmp_path / "log" / "a"
    file.write_text("1\n2\n3")
    first = log.latestOffset()
    assert read(log, log.initialOffset(), first) == ["1", "2"]
    assert log.latestOffset() == first and read(log, first, first) == []
    file.write_text("1\n2\n34\n\n5")
    second = log.latestOffset()
    assert read(log, first, second) == ["34", ""] and read(log, log.initialOffset(), second) == ["1", "2", "34", ""]
    (tmp_path / "log" / "b").write_text("6\n")  # closes the file before, with its last line
    assert read(log, second, log.latestOffset()) == ["5", "6"]


def test_landings_are_offered_one_by_one_and_again_after_a_restart(tmp_path):
    for landing in "abc":
        for file in "12":
            (tmp_path / "log" / landing).mkdir(parents=True, exist_ok=True)
            (tmp_path / "log" / landing / file).write_text(f"{landing}{file}\n")
    offered = tmp_path / "offered" / "at.json"
    log = reader(tmp_path / "log", landingsPerBatch=1, offered=offered)
    a, b = log.latestOffset(), log.latestOffset()
    assert read(log, log.initialOffset(), a) == ["a1", "a2"] and read(log, a, b) == ["b1", "b2"]
    assert json.loads(offered.read_text()) == b
    again = reader(tmp_path / "log", landingsPerBatch=1, offered=offered)
    assert again.latestOffset() == b  # it may have been planned already
    c = again.latestOffset()
    assert read(again, b, c) == ["c1", "c2"] and again.latestOffset() == c


def test_a_limit_needs_its_file(tmp_path):
    with pytest.raises(ValueError, match="offered"):
        reader(tmp_path, landingsPerBatch=1)


@pytest.mark.parametrize("limit", [None, 2])
def test_a_restarted_query_reads_each_line_once(spark, tmp_path, limit):
    log, out, checkpoint, offered = (str(tmp_path / x) for x in ("log", "out", "checkpoint", "offered/at"))
    wanted = Counter()
    for run in range(3):
        rows = [(f"{run}-{i}", run * 3 + i % 3) for i in range(9)]
        new = spark.createDataFrame(rows, "value string, number int")
        ll.write_log(new, f"{log}/{run}" if limit is None else f"{tmp_path}/new{run}", "number")
        if limit:
            (tmp_path / "log").mkdir(exist_ok=True)
            for folder in (tmp_path / f"new{run}").glob("landing=*"):
                folder.rename(tmp_path / "log" / folder.name)
        wanted.update(v for v, _ in rows)
        lines = ll.log_lines(spark, log, limit, offered if limit else None)
        query = lines.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start(out)
        for _ in range(200):
            query.processAllAvailable()
            got = Counter(r.value for r in spark.read.schema("value string").parquet(out).collect())
            if got == wanted:
                break
        query.stop()
        assert got == wanted
