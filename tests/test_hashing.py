import pytest
from brute import color
from pyspark.sql import functions as F

from trisketch.functions.hashing import RUNS, affine_hash, draw_rows, draw_runs, edge_hash, run_table, sign_hash
from trisketch.functions.medians import truncated_decimal_median, truncated_median

IDS = [0, 1, 8190, 8191, 8192, 262_209, -1, -5, -8191, 2**31, 2**63 - 1, -(2**63)]


@pytest.mark.parametrize("a,b", RUNS)
@pytest.mark.parametrize("buckets", [1, 2, 4, 97])
def test_affine_hash_stays_in_range_for_any_bigint(spark, a, b, buckets):
    df = spark.createDataFrame([(x,) for x in IDS], "x bigint")
    rows = df.select("x", affine_hash(F.col("x"), a, b, buckets).alias("h"), sign_hash(F.col("x"), a, b).alias("s")).collect()
    assert {r.x: r.h for r in rows} == {x: color(x, a, b, buckets) for x in IDS}
    assert {r.x: r.s for r in rows} == {x: color(x, a, b, 2) * 2 - 1 for x in IDS}


def test_edge_hash(spark):
    df = spark.createDataFrame([(-5, 7), (1, 2**62)], "u bigint, v bigint")
    got = [r.h for r in df.select(edge_hash(F.col("u"), F.col("v"), 4, 1955, 6184, 4010).alias("h")).collect()]
    assert got == [((1955 * u + 6184 * v + 4010) % 8191) % 4 for u, v in [(-5, 7), (1, 2**62)]]


def test_drawn_parameters_are_reproducible_and_in_range():
    assert draw_runs(5, 20230406)[0] == (1955, 4010)
    assert draw_rows(3, 1) == draw_rows(3, 1) and len(draw_rows(3, 1)) == 3
    for a, b in draw_runs(500, 3):
        assert 1 <= a <= 8190 and 0 <= b <= 8190


def test_parameters_are_validated():
    for bad in (lambda: draw_runs(0, 1), lambda: run_table([])):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize(
    "values,expected",
    [([3], 3), ([5, 1, 3], 3), ([1, 2], 1), ([-1, -2], -1), ([-3, 0], -1), ([4, 1, 3, 2], 2), ([2**63 - 1, 2**63 - 1], 2**63 - 1)],
)
def test_truncated_median(spark, values, expected):
    df = spark.createDataFrame([(values,)], "x array<bigint>")
    assert df.select(truncated_median(F.col("x")).alias("m")).first().m == expected


def test_decimal_median_beyond_bigint(spark):
    df = spark.sql("SELECT array(100000000000000000000000001BD, 100000000000000000000000004BD) AS x")
    df = df.select(F.col("x").cast("array<decimal(38,0)>").alias("x"))
    assert int(df.select(truncated_decimal_median(F.col("x")).alias("m")).first().m) == 100000000000000000000000002
