import random
from collections import Counter

import pytest
from brute import sketch
from pyspark.sql import functions as F

from trisketch.functions.hashing import ROWS, P
from trisketch.plans import stream_queries as sq
from trisketch.session import shared_folder
from trisketch.sources.items import batch_bounds, parse_items
from trisketch.streaming import ledger as lg
from trisketch.streaming import progress as pg
from trisketch.streaming import sources as ss
from trisketch.streaming import state as st

ONCE = {"availableNow": True}
LEFT, RIGHT, WIDTH = 0, 60, 8


def landings(count, size, seed):
    rng = random.Random(seed)
    return [[rng.choice([5, rng.randint(-20, 90)]) for _ in range(size)] for _ in range(count)]


def land(spark, batch, path):
    ss.land(spark.createDataFrame([(str(v),) for v in batch], "value string"), path)


def run(state, checkpoint):
    query = st.start_updates(state, checkpoint, ONCE)
    query.awaitTermination()
    return query


def expected_freq(batches):
    return Counter(v for b in batches for v in b if LEFT <= v <= RIGHT)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def items(spark, path):
    return parse_items(ss.text_lines(spark, path))


def read_freq(spark, checkpoint):
    return {r.item: r.f for r in st.current_state(spark, checkpoint, "f").collect()}


def test_state_spans_micro_batches_and_survives_restarts(spark, folder):
    batches = landings(4, 60, seed=1)
    for number, batch in enumerate(batches):
        land(spark, batch, folder("in"))
        query = run(st.frequency_state(items(spark, folder("in")), LEFT, RIGHT), folder("ckpt"))
        assert query.lastProgress["batchId"] >= number
        got = read_freq(spark, folder("ckpt"))
        outside = got.pop(None)
        assert got == expected_freq(batches[: number + 1]) and outside + sum(got.values()) == 60 * (number + 1)


def test_sketch_of_state_equals_the_batch_sketch(spark, folder):
    batches = landings(3, 50, seed=2)
    for batch in batches:
        land(spark, batch, folder("in"))
        run(st.residue_state(items(spark, folder("in")), LEFT, RIGHT), folder("ckpt"))
    counts = st.current_state(spark, folder("ckpt"), "f")
    got = {(r.j, r.c): r.val for r in st.sketch_of_state(counts, ROWS, WIDTH).collect()}
    assert got == sketch(expected_freq(batches), ROWS, WIDTH)


def test_a_batch_updates_a_key_per_residue(spark, folder):
    land(spark, [3, 3 + P, 3 - P, 4, 4, 10**6], folder("in"))
    query = run(st.residue_state(items(spark, folder("in")), -(10**5), 10**5), folder("ckpt"))
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == 2
    assert read_freq(spark, folder("ckpt")) == {3: 3, 4: 2}


def test_what_is_read_does_not_grow_with_the_number_of_batches(spark, folder):
    sizes = []
    for _ in range(4):
        land(spark, [7, 8, 9, 100], folder("in"))
        run(st.frequency_state(items(spark, folder("in")), LEFT, RIGHT), folder("ckpt"))
        sizes.append(spark.read.format("statestore").load(folder("ckpt")).count())
    assert sizes == [4] * 4


def folded(spark, batches, path, checkpoint, threshold):
    for batch in batches:
        land(spark, batch, path("in"))
        ledger = lg.start_ledger(items(spark, path("in")), path("out"), checkpoint, LEFT, RIGHT, threshold, ONCE)
        ledger.wait()
        assert not ledger.query.isActive
    return sorted(tuple(r) for r in lg.ledger(spark, path("out")).collect())


@pytest.mark.parametrize("threshold,n", [(1, 1), (60, 2), (61, 3), (10**6, 4)])
def test_ledger_stops_at_the_threshold(spark, folder, threshold, n):
    batches = landings(4, 30, seed=4)
    rows = folded(spark, batches, folder, folder("ckpt"), threshold)
    assert rows == [(i, 30, 30 * i) for i in range(n)]
    counts = lg.folded_counts(spark, folder("out")).where("item IS NOT NULL")
    expected = {(i, v): c for i in range(n) for v, c in expected_freq([batches[i]]).items()}
    assert {(r.batch_id, r.item): r.f for r in counts.collect()} == expected


def test_replayed_batches_do_not_count_twice(spark, folder):
    land(spark, [1, 2, 2], folder("in"))
    for attempt in ("first", "second"):  # a fresh checkpoint replays the batch into the same ledger
        lg.start_ledger(items(spark, folder("in")), folder("out"), folder(attempt), LEFT, RIGHT, 100, ONCE).wait()
    assert [tuple(r) for r in lg.ledger(spark, folder("out")).collect()] == [(0, 3, 0)]


def test_landings_of_one_row_do_not_mix(spark, folder):
    rows = folded(spark, [[i] for i in range(6)], folder, folder("ckpt"), 100)
    assert rows == [(i, 1, i) for i in range(6)]


@pytest.mark.parametrize("n", [3, 19, 1005])
@pytest.mark.parametrize("percent", [55, 100])
def test_batch_and_stream_form_of_the_threshold_agree(spark, folder, monkeypatch, n, percent):
    monkeypatch.setattr(sq, "STOP_PERCENT", percent)
    spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id")).write.parquet(
        folder("events.parquet")
    )
    batch = sorted(tuple(r) for r in sq.QUERIES["threshold_batches"](spark, folder("")).collect())
    stream = sorted(tuple(r) for r in sq.stream_ledger(spark, folder("")).collect())
    assert batch == stream and len(batch) <= min(n, sq.BATCHES)
    if percent == 100:
        assert sum(r[1] for r in batch) == n and len(batch) == min(n, sq.BATCHES)
    assert [(r[0], r[1]) for r in batch] == [
        (i, high - low) for i, (low, high) in enumerate(batch_bounds(n, sq.BATCHES))
    ][: len(batch)]


def test_a_running_ledger_is_stopped(spark, folder):
    for batch in landings(3, 30, seed=5):
        land(spark, batch, folder("in"))
    one_file = parse_items(ss.text_lines(spark, folder("in"), files_per_batch=1))
    ledger = lg.start_ledger(one_file, folder("out"), folder("ckpt"), LEFT, RIGHT, 5)
    ledger.wait()
    assert ledger.reached.is_set() and not ledger.query.isActive


def test_a_bad_line_fails_the_query(spark, folder):
    spark.createDataFrame([("1",), ("x",)], "value string").write.text(folder("in"))
    ledger = lg.start_ledger(items(spark, folder("in")), folder("out"), folder("ckpt"), LEFT, RIGHT, 10, ONCE)
    with pytest.raises(Exception):
        ledger.wait()


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_streams_as_one_file_or_as_a_folder(spark, folder, tmp_path, files):
    spark.range(10).repartition(files).write.parquet(folder("written"))
    path = folder("written")
    if files == 1:  # the table is the file itself, next to another one
        [part] = tmp_path.glob("written/part-*")
        path = folder("t.parquet")
        (tmp_path / "t.parquet").write_bytes(part.read_bytes())
        (tmp_path / "u.parquet").write_bytes(part.read_bytes())
    run(st.frequency_state(parse_items(ss.column_lines(spark, path, "id", files_per_batch=2)), 3, 5), folder("ckpt"))
    assert read_freq(spark, folder("ckpt")) == {3: 1, 4: 1, 5: 1, None: 7}


@pytest.mark.parametrize("name", ["stream_item_frequency", "stream_count_sketch", "stream_report_from_state"])
def test_state_queries_on_a_folder_table(spark, folder, name):
    rows = spark.range(400).select(F.col("id").alias("event_id"), (F.col("id") * 7 % 130).alias("user_id"))
    rows.repartition(3).write.parquet(folder("many/events.parquet"))
    rows.coalesce(1).write.parquet(folder("one/events.parquet"))
    many, one = (Counter(map(tuple, sq.QUERIES[name](spark, folder(d)).collect())) for d in ("many", "one"))
    assert many == one and sum(one.values()) > 0


def test_a_timed_run_reports_its_batches(spark, folder):
    batches = landings(3, 20, seed=6)
    for batch in batches:
        land(spark, batch, folder("in"))
    lines = pg.counted(ss.text_lines(spark, folder("in"), files_per_batch=1))
    state = st.frequency_state(parse_items(lines), LEFT, RIGHT)
    seen = pg.run_until(spark, lambda: st.start_updates(state, folder("ckpt")), 60)
    rows = pg.batch_times(spark, seen).collect()
    assert [r.batch_id for r in rows] == list(range(len(rows))) and sum(r.n for r in rows) == 60 and len(rows) >= 3
    assert all(r.milliseconds > 0 for r in rows) and sorted(r.started for r in rows) == [r.started for r in rows]


def test_a_failing_timed_run_raises(spark, folder):
    spark.createDataFrame([("x",)], "value string").write.text(folder("in"))
    state = st.frequency_state(parse_items(pg.counted(ss.text_lines(spark, folder("in")))), LEFT, RIGHT)
    with pytest.raises(Exception, match="x"):
        pg.run_until(spark, lambda: st.start_updates(state, folder("ckpt")), 5)


def spans(path):
    return sorted(p.name for p in (path / "spans").iterdir())


def test_spans_are_merged(spark, folder, tmp_path):
    batches = landings(5, 10, seed=7)
    for number, batch in enumerate(batches):
        land(spark, batch, folder("in"))
        lg.start_ledger(items(spark, folder("in")), folder("out"), folder("ckpt"), LEFT, RIGHT, 1000, ONCE, fan=2).wait()
        assert [tuple(r) for r in lg.ledger(spark, folder("out")).orderBy("batch_id").collect()] == [(i, 10, 10 * i) for i in range(number + 1)]
    assert spans(tmp_path / "out") == [lg._name(0, 3), lg._name(4, 4)]
    counts = {(r.batch_id, r.item): r.f for r in lg.folded_counts(spark, folder("out")).where("item IS NOT NULL").collect()}
    assert counts == {(i, v): c for i in range(5) for v, c in expected_freq([batches[i]]).items()}


@pytest.mark.parametrize("crash", ["before the merged span is valid", "before parts are removed"])
def test_a_crash_while_merging_loses_and_doubles_nothing(spark, folder, tmp_path, monkeypatch, crash):
    one_file = lambda: parse_items(ss.text_lines(spark, folder("in"), files_per_batch=1))
    for batch in landings(2, 10, seed=8):
        land(spark, batch, folder("in"))
    lg.start_ledger(one_file(), folder("out"), folder("ckpt"), LEFT, RIGHT, 1000, ONCE, fan=100).wait()
    before = sorted(map(tuple, lg.folded_counts(spark, folder("out")).collect()), key=str)
    n = len(spans(tmp_path / "out"))

    def fail(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(lg, "write_small" if "valid" in crash else "remove_folder", fail)
        with pytest.raises(RuntimeError):
            lg.merge_spans(spark, folder("out"), 0, n - 1)
    for _ in range(2):
        assert sorted(map(tuple, lg.folded_counts(spark, folder("out")).collect()), key=str) == before
        assert lg.ledger(spark, folder("out")).agg(F.sum("n")).first()[0] == 20
        lg.merge_spans(spark, folder("out"), 0, n - 1)
    assert spans(tmp_path / "out") == [lg._name(0, n - 1)]


def test_the_shared_folder_is_new_each_time(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
