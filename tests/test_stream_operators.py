import random
from collections import Counter

import pytest
from brute import estimate, median, sketch
from pyspark.sql import functions as F

from trisketch.functions.hashing import ROWS, draw_rows
from trisketch.operators import frequency as fr
from trisketch.operators import packed_sketch as ps
from trisketch.operators import sketch as sk
from trisketch.plans.stream_queries import ALL_PARTS
from trisketch.plans import reports as rp

RNG = random.Random(9)
# One item holds a third of the stream; some items are negative.
VALUES = [7] * 400 + [RNG.randint(-60, 200) for _ in range(800)]
LEFT, RIGHT, WIDTH = -40, 150, 16
FREQ = Counter(v for v in VALUES if LEFT <= v <= RIGHT)


@pytest.fixture
def in_range(items_of):
    return fr.items_in_range(items_of(VALUES), LEFT, RIGHT)


@pytest.fixture
def freq(in_range):
    return fr.frequencies(in_range)


def cells(df):
    return {(r.j, r.c): r.val for r in df.collect()}


def test_frequencies_and_totals(items_of, freq):
    assert {r.item: r.f for r in freq.collect()} == FREQ
    assert fr.stream_length(items_of(VALUES)).first().n_items == len(VALUES)
    assert tuple(fr.range_totals(freq).first()) == (sum(FREQ.values()), len(FREQ))
    f2 = sum(f * f for f in FREQ.values())
    row = fr.second_moment(freq).first()
    assert int(row.f2) == f2 and row.f2_norm == pytest.approx(f2 / sum(FREQ.values()) ** 2)


@pytest.mark.parametrize("k", [1, 2, 5, 20, 10_000])
def test_top_k_keeps_ties(freq, k):
    ranked = sorted(FREQ.values(), reverse=True)
    phi = ranked[min(k, len(ranked)) - 1]
    assert fr.phi_k(freq, k).first().phi == phi
    assert {r.item for r in fr.top_k_with_ties(freq, k).collect()} == {i for i, f in FREQ.items() if f >= phi}


def test_no_k_no_items(freq):
    assert fr.phi_k(freq, 0).first().phi is None
    assert fr.top_k_with_ties(freq, 0).count() == 0


def test_items_by_frequency(freq):
    got = [(r.item, r.f) for r in fr.items_by_frequency(freq).collect()]
    assert got == sorted(FREQ.items(), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("rows", [ROWS, ROWS[:4], ROWS[:1], draw_rows(6, 2)])
def test_sketch_estimates_and_moments(in_range, freq, rows):
    expected = sketch(FREQ, rows, WIDTH)
    built = sk.count_sketch(in_range, rows, WIDTH)
    assert cells(built) == expected
    assert cells(sk.count_sketch_of_frequencies(freq, rows, WIDTH)) == expected
    got = {r.item: (r.f, r.f_est) for r in sk.estimate_frequencies(freq, built, rows, WIDTH).collect()}
    assert got == {i: (f, estimate(i, expected, rows, WIDTH)) for i, f in FREQ.items()}
    squares = [sum(v * v for (j, _), v in expected.items() if j == row) for row in range(len(rows))]
    assert [int(r.f2_row) for r in sk.second_moment_rows(built).orderBy("j").collect()] == squares
    assert int(sk.second_moment_estimate(built, len(rows)).first().f2_est) == median(squares)


def test_a_sketch_too_large_to_broadcast_gives_the_same_estimates(freq, in_range, monkeypatch):
    built = sk.count_sketch(in_range, ROWS, WIDTH)
    small = {tuple(r) for r in sk.estimate_frequencies(freq, built, ROWS, WIDTH).collect()}
    monkeypatch.setattr(sk, "BROADCAST_CELLS", 0)
    assert {tuple(r) for r in sk.estimate_frequencies(freq, built, ROWS, WIDTH).collect()} == small


def test_ids_beyond_the_prime_share_counters_exactly(items_of):
    values = [5, 5 + 8191, 5 - 8191, 8191 * 10**12 + 6, -6, 2**63 - 1]
    built = sk.count_sketch(items_of(values), ROWS, 97)
    assert cells(built) == sketch(Counter(values), ROWS, 97)


def test_unseen_items_are_estimated_from_their_cells(spark, in_range):
    built = sk.count_sketch(in_range, ROWS, 10_000)
    unseen = spark.createDataFrame([(10**12 + 3, 0)], "item bigint, f bigint")
    expected = estimate(10**12 + 3, sketch(FREQ, ROWS, 10_000), ROWS, 10_000)
    assert sk.estimate_frequencies(unseen, built, ROWS, 10_000).first().f_est == expected


def test_a_wide_sketch_of_few_items_is_exact(items_of):
    items = items_of([3] * 5 + [800] * 9)
    freq = fr.frequencies(items)
    got = sk.estimate_frequencies(freq, sk.count_sketch(items, ROWS, 8191), ROWS, 8191).collect()
    assert all(r.f == r.f_est for r in got)
    assert int(sk.second_moment_estimate(sk.count_sketch(items, ROWS, 8191), 5).first().f2_est) == 25 + 81


def test_dense_sketch_adds_zero_cells(in_range):
    built = sk.count_sketch(in_range, ROWS, 512)
    dense = cells(sk.dense_sketch(built, len(ROWS), 512))
    assert set(dense) == {(j, c) for j in range(len(ROWS)) for c in range(512)}
    assert {k: v for k, v in dense.items() if v} == {k: v for k, v in cells(built).items() if v}


def test_batches_merge_to_the_whole(spark, in_range):
    batched = spark.createDataFrame([(i % 7, v) for i, v in enumerate(VALUES)], "batch_id bigint, item bigint")
    inside = fr.items_in_range(batched, LEFT, RIGHT)
    merged = fr.merge_batch_counts(fr.batch_item_counts(inside))
    assert {r.item: r.f for r in merged.collect()} == FREQ
    per_batch = sk.count_sketch(inside, ROWS, WIDTH, by=["batch_id"])
    assert cells(sk.merge_sketches(per_batch)) == cells(sk.count_sketch(in_range, ROWS, WIDTH))
    sizes = {r.batch_id: r.n for r in fr.batch_sizes(batched).collect()}
    assert sizes == Counter(i % 7 for i in range(len(VALUES)))


@pytest.mark.parametrize("block", [1, 3, 10_000])
@pytest.mark.parametrize("threshold", [0, 1, 95, 100, 101, 10**6])
def test_threshold_includes_the_batch_that_reaches_it(spark, block, threshold):
    sizes = [10, 0, 35, 5, 50, 50, 1, 40]
    ledger = spark.createDataFrame(list(enumerate(sizes)), "batch_id bigint, n bigint")
    expected = {(i, n, sum(sizes[:i])) for i, n in enumerate(sizes) if sum(sizes[:i]) < threshold}
    assert {tuple(r) for r in fr.threshold_batches(ledger, threshold, block).collect()} == expected


def test_report(items_of, in_range, freq):
    built = sk.count_sketch(in_range, ROWS, WIDTH)
    row = rp.stream_report(fr.stream_length(items_of(VALUES)), freq, built, ROWS, WIDTH, LEFT, RIGHT, 5).first()
    expected = sketch(FREQ, ROWS, WIDTH)
    phi = sorted(FREQ.values(), reverse=True)[4]
    top = {i: f for i, f in FREQ.items() if f >= phi}
    errors = [abs(f - estimate(i, expected, ROWS, WIDTH)) / f for i, f in top.items()]
    assert (row.n_items, row.n_in_range, row.n_distinct) == (len(VALUES), sum(FREQ.values()), len(FREQ))
    assert (row.phi, row.n_top) == (phi, len(top))
    assert row.avg_rel_error == pytest.approx(sum(errors) / len(errors))


def test_empty_range_gives_nulls_not_errors(items_of):
    items = items_of(VALUES)
    nothing = fr.items_in_range(items, 1000, 2000)
    freq, built = fr.frequencies(nothing), sk.count_sketch(nothing, ROWS, WIDTH)
    row = rp.stream_report(fr.stream_length(items), freq, built, ROWS, WIDTH, 1000, 2000, 5).first()
    assert (row.n_items, row.n_in_range, row.n_distinct, row.n_top) == (len(VALUES), 0, 0, 0)
    assert (row.phi, row.avg_rel_error, row.f2_norm, row.f2_est_norm) == (None, None, None, None)


def test_squares_beyond_bigint(spark):
    big = 10**13
    freq = spark.createDataFrame([(1, big), (2, big)], "item bigint, f bigint")
    assert int(fr.second_moment(freq).first().f2) == 2 * big * big
    built = sk.count_sketch_of_frequencies(freq.where("item = 1"), ROWS, 64)
    assert int(sk.second_moment_estimate(built, len(ROWS)).first().f2_est) == big * big


def test_an_unseen_item_has_no_relative_error(spark):
    estimates = spark.createDataFrame([(1, 4, 5), (2, 0, 3)], "item bigint, f bigint, f_est bigint")
    assert sk.avg_relative_error(estimates).first().avg_rel_error == 0.25


def test_lines_of_more_than_twenty_items(spark, tmp_path):
    spark.range(400).selectExpr("id AS l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert ALL_PARTS.k > 20 and ALL_PARTS.heavy(spark, str(tmp_path)).count() == 400  # all tie


def test_parameters_are_validated(in_range, freq):
    for bad in (
        lambda: sk.count_sketch(in_range, ROWS, 0),
        lambda: sk.count_sketch(in_range, [], 4),
        lambda: sk.dense_sketch(sk.count_sketch(in_range, ROWS, 4), 0, 4),
    ):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1]])
@pytest.mark.parametrize("tasks,fan", [(1, 2), (7, 2), (7, 32)])
def test_packed_sketches_merge(spark, rows, tasks, fan, monkeypatch):
    monkeypatch.setattr(ps, "HELD", 2)
    values = [(i % 5 if i % 11 else None, i * i % 400 - 200 if i % 7 else None) for i in range(500)]
    items = spark.createDataFrame(values, "batch bigint, item bigint").repartition(tasks)
    packed = ps.packed_sketch(items, rows, WIDTH, "batch")
    freq = Counter(v for b, v in values if b is not None and v is not None)
    expected = sketch(freq, rows, WIDTH)
    got = {(r.j, r.c): r.val for r in ps.unpacked(ps.merge_packed(packed, len(rows), WIDTH, fan), WIDTH).collect()}
    assert len(got) == len(rows) * WIDTH and {k: v for k, v in got.items() if v} == {k: v for k, v in expected.items() if v}


def test_no_packed_sketch_gives_zeros(spark):
    none = ps.packed_sketch(spark.createDataFrame([], "batch bigint, item bigint"), ROWS, WIDTH, "batch")
    assert none.count() == 0
    assert [r.val for r in ps.unpacked(ps.merge_packed(none, len(ROWS), WIDTH), WIDTH).collect()] == [0] * len(ROWS) * WIDTH


def test_merging_shuffles_arrays_and_not_cells(spark):
    items = spark.range(0, 1000, 1, 64).selectExpr("id % 8 AS batch", "id AS item")
    merged = ps.merge_packed(ps.packed_sketch(items, ROWS, WIDTH, "batch"), len(ROWS), WIDTH)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "HashAggregate" not in plan
