"""Registered item-stream queries, each next to the SQL that must give the same rows.

Stream 1 (plain names): events.user_id, also in ten equal batches by event_id.
Stream 2 (`_parts`): lineitem.l_partkey.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisketch.functions.hashing import ROWS
from trisketch.operators import frequency as fr
from trisketch.operators import packed_sketch as ps
from trisketch.operators import sketch as sk
from trisketch.plans import reports as rp
from trisketch.session import remove_folder, shared_folder
from trisketch.sources import items as src
from trisketch.streaming import ledger as lg
from trisketch.streaming import line_log as ll
from trisketch.streaming import progress as pg
from trisketch.streaming import sources as ss
from trisketch.streaming import state as st

BATCHES = 10
STOP_PERCENT = 55
STATE_BATCHES = 4
TIMED_BATCHES = 12
ONCE = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str) -> None:
    QUERIES[name] = query
    ORACLES[name] = sql


@dataclass(frozen=True)
class Stream:
    table: str
    column: str
    left: int
    right: int
    width: int
    k: int

    def read(self, spark: SparkSession, sf: str) -> DataFrame:
        return spark.read.parquet(f"{sf}/{self.table}.parquet")

    def items(self, spark: SparkSession, sf: str) -> DataFrame:
        return src.items_from_column(self.read(spark, sf), self.column)

    def in_range(self, spark: SparkSession, sf: str) -> DataFrame:
        return fr.items_in_range(self.items(spark, sf), self.left, self.right)

    def freq(self, spark: SparkSession, sf: str) -> DataFrame:
        return fr.frequencies(self.in_range(spark, sf))

    def sketch(self, spark: SparkSession, sf: str, rows: sk.Rows = ROWS) -> DataFrame:
        return sk.count_sketch(self.in_range(spark, sf), rows, self.width)

    def folded_sketch(self, freq: DataFrame, rows: sk.Rows = ROWS) -> DataFrame:
        return sk.count_sketch_of_frequencies(freq, rows, self.width)

    def heavy(self, spark: SparkSession, sf: str, rows: sk.Rows = ROWS) -> DataFrame:
        freq = self.freq(spark, sf)
        return rp.heavy_hitters(freq, self.folded_sketch(freq, rows), rows, self.width, self.k)

    def row_estimates(self, spark: SparkSession, sf: str) -> DataFrame:
        freq = self.freq(spark, sf)
        return sk.row_estimates(fr.top_k_with_ties(freq, self.k), self.folded_sketch(freq), ROWS, self.width)

    def moments(self, spark: SparkSession, sf: str) -> DataFrame:
        freq = self.freq(spark, sf)
        return rp.second_moments(freq, self.folded_sketch(freq), len(ROWS))

    def report(self, length: DataFrame, freq: DataFrame, sketch: DataFrame) -> DataFrame:
        return rounded(
            rp.stream_report(length, freq, sketch, ROWS, self.width, self.left, self.right, self.k), "avg_rel_error"
        )

    # The SQL side: freq(item, f), rows(j, ...), cells(item, f, j, c, s), sketch(j, c, val),
    # est(item, f, j, est), phi(phi), heavy(item, f, f_est).

    def ctes(self, depth: int = len(ROWS), source: str | None = None, filtered: str = "") -> str:
        rows = ", ".join(f"({j}, {ah}, {bh}, {ag}, {bg})" for j, (ah, bh, ag, bg) in enumerate(ROWS[:depth]))
        middle = (
            f"x[{(depth + 1) // 2}]" if depth % 2 else f"CAST(trunc((x[{depth // 2}] + x[{depth // 2 + 1}]) / 2) AS BIGINT)"
        )
        return f"""items AS (SELECT {self.column} AS item FROM {source or self.table} {filtered}),
freq AS (SELECT item, count(*) AS f FROM items WHERE item BETWEEN {self.left} AND {self.right} GROUP BY item),
hash_rows(j, ah, bh, ag, bg) AS (VALUES {rows}),
cells AS (SELECT item, f, CAST(j AS INTEGER) AS j, CAST(((ah * item + bh) % 8191) % {self.width} AS INTEGER) AS c,
  CAST(((ag * item + bg) % 8191) % 2 * 2 - 1 AS INTEGER) AS s FROM freq CROSS JOIN hash_rows),
sketch AS (SELECT j, c, CAST(sum(f * s) AS BIGINT) AS val FROM cells GROUP BY j, c),
phi AS (SELECT min(f) AS phi FROM (SELECT f FROM freq ORDER BY f DESC LIMIT {self.k})),
top AS (SELECT item, f FROM freq WHERE f >= (SELECT phi FROM phi)),
est AS (SELECT item, f, j, CAST(val * s AS BIGINT) AS est FROM cells JOIN sketch USING (j, c)
  WHERE item IN (SELECT item FROM top)),
heavy AS (SELECT item, f, {middle} AS f_est
  FROM (SELECT item, max(f) AS f, list_sort(list(est)) AS x FROM est GROUP BY item)),
f2_rows AS (SELECT j, CAST(sum(val * val) AS HUGEINT) AS f2 FROM sketch GROUP BY j),
f2_median AS (SELECT {middle} AS f2 FROM (SELECT list_sort(list(CAST(f2 AS BIGINT))) AS x FROM f2_rows)),
n AS (SELECT CAST(sum(f) AS DOUBLE) AS n FROM freq)"""

    def report_sql(self, source: str | None = None, filtered: str = "") -> str:
        return f"""WITH {self.ctes(source=source, filtered=filtered)}
SELECT CAST({len(ROWS)} AS BIGINT) AS depth, CAST({self.width} AS BIGINT) AS width, CAST({self.left} AS BIGINT) AS range_left,
  CAST({self.right} AS BIGINT) AS range_right, CAST({self.k} AS BIGINT) AS k,
  (SELECT count(*) FROM items) AS n_items, (SELECT CAST(sum(f) AS BIGINT) FROM freq) AS n_in_range,
  (SELECT count(*) FROM freq) AS n_distinct, (SELECT phi FROM phi) AS phi, (SELECT count(*) FROM heavy) AS n_top,
  (SELECT round(avg(abs(f - f_est) / CAST(f AS DOUBLE)), 9) FROM heavy) AS avg_rel_error,
  (SELECT CAST(sum(f * f) AS DOUBLE) FROM freq) / (n * n) AS f2_norm,
  (SELECT CAST(f2 AS DOUBLE) FROM f2_median) / (n * n) AS f2_est_norm
FROM n"""


USERS = Stream("events", "user_id", left=10, right=120, width=32, k=10)
PARTS = Stream("lineitem", "l_partkey", left=100, right=1500, width=256, k=20)
# The interval holds every part, so the distinct items grow with the table.
ALL_PARTS = Stream("lineitem", "l_partkey", left=0, right=2**40, width=1024, k=25)


def rounded(df: DataFrame, column: str) -> DataFrame:
    """A mean of doubles depends on the order of rows in its last digits."""
    return df.withColumn(column, F.round(column, 9))


def batched(spark: SparkSession, sf: str) -> DataFrame:
    events = USERS.read(spark, sf)
    return events.select(
        src.equal_batches(events, "event_id", BATCHES).alias("batch_id"), F.col("user_id").alias("item")
    )


def batched_in_range(spark: SparkSession, sf: str) -> DataFrame:
    return fr.items_in_range(batched(spark, sf), USERS.left, USERS.right)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of squares are exact DECIMAL(38,0); DOUBLE is the type both engines report alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return USERS.read(spark, sf).select("event_id", F.col("user_id").cast("string").alias("value"))


def batch_report(stream: Stream, spark: SparkSession, sf: str) -> DataFrame:
    freq = stream.freq(spark, sf)
    return stream.report(fr.stream_length(stream.items(spark, sf)), freq, stream.folded_sketch(freq))


# ---- all streams ----------------------------------------------------------

for suffix, S in (("", USERS), ("_parts", PARTS), ("_all_parts", ALL_PARTS)):
    C = S.ctes()
    register(
        f"item_frequency{suffix}",
        lambda s, d, S=S: S.freq(s, d),
        f"WITH {C} SELECT item, f FROM freq",
    )
    register(
        f"stream_length{suffix}",
        lambda s, d, S=S: fr.stream_length(S.items(s, d)),
        f"SELECT count(*) AS n_items FROM {S.table}",
    )
    register(
        f"range_totals{suffix}",
        lambda s, d, S=S: fr.range_totals(S.freq(s, d)),
        f"WITH {C} SELECT CAST(sum(f) AS BIGINT) AS n_in_range, count(*) AS n_distinct FROM freq",
    )
    register(
        f"sketch_cell_updates{suffix}",
        lambda s, d, S=S: sk.cell_updates(S.freq(s, d), ROWS, S.width),
        f"WITH {C} SELECT item, f, j, c, s FROM cells",
    )
    register(
        f"count_sketch{suffix}",
        lambda s, d, S=S: S.sketch(s, d),
        f"WITH {C} SELECT j, c, val FROM sketch",
    )
    register(
        f"sketch_row_estimates{suffix}",
        lambda s, d, S=S: S.row_estimates(s, d),
        f"WITH {C} SELECT item, f, j, est FROM est",
    )
    register(
        f"heavy_hitter_estimates{suffix}",
        lambda s, d, S=S: S.heavy(s, d),
        f"WITH {C} SELECT item, f, f_est FROM heavy",
    )
    register(
        f"avg_relative_error{suffix}",
        lambda s, d, S=S: rounded(sk.avg_relative_error(S.heavy(s, d)), "avg_rel_error"),
        f"WITH {C} SELECT round(avg(abs(f - f_est) / CAST(f AS DOUBLE)), 9) AS avg_rel_error FROM heavy",
    )
    register(
        f"second_moment_true{suffix}",
        lambda s, d, S=S: as_double(fr.second_moment(S.freq(s, d)), "f2"),
        f"""WITH {C} SELECT CAST(sum(f * f) AS DOUBLE) AS f2,
  CAST(sum(f * f) AS DOUBLE) / ((SELECT n FROM n) * (SELECT n FROM n)) AS f2_norm FROM freq""",
    )
    register(
        f"second_moment_rows{suffix}",
        lambda s, d, S=S: as_double(sk.second_moment_rows(S.sketch(s, d)), "f2_row"),
        f"WITH {C} SELECT j, CAST(f2 AS DOUBLE) AS f2_row FROM f2_rows",
    )
    register(
        f"second_moment_estimate{suffix}",
        lambda s, d, S=S: as_double(S.moments(s, d), "f2_est"),
        f"""WITH {C} SELECT CAST(f2 AS DOUBLE) AS f2_est,
  CAST(f2 AS DOUBLE) / ((SELECT n FROM n) * (SELECT n FROM n)) AS f2_est_norm FROM f2_median""",
    )
    register(
        f"items_by_frequency{suffix}",
        lambda s, d, S=S: fr.items_by_frequency(S.freq(s, d)),
        f"WITH {C} SELECT item, f FROM freq ORDER BY f DESC, item",
    )
    register(f"phi_k{suffix}", lambda s, d, S=S: fr.phi_k(S.freq(s, d), S.k), f"WITH {C} SELECT phi FROM phi")
    register(
        f"top_k_with_ties{suffix}",
        lambda s, d, S=S: fr.top_k_with_ties(S.freq(s, d), S.k),
        f"WITH {C} SELECT item, f FROM top",
    )
    register(
        f"stream_report{suffix}",
        lambda s, d, S=S: batch_report(S, s, d),
        S.report_sql(),
    )

# ---- stream 1 only ---------------------------------------------------------

IN_RANGE = f"user_id BETWEEN {USERS.left} AND {USERS.right}"


def batch_id(batches: int) -> str:
    return f"event_id * (SELECT least({batches}, count(*)) FROM events) // (SELECT count(*) FROM events)"


BATCH_ID = batch_id(BATCHES)
EVEN = USERS.ctes(depth=4)

register(
    "item_parse",
    lambda s, d: src.parse_items(lines(s, d)),
    "SELECT event_id, user_id AS item FROM events",
)
register(
    "items_in_range",
    lambda s, d: fr.items_in_range(
        src.items_from_column(USERS.read(s, d), "user_id", "event_id"), USERS.left, USERS.right
    ),
    f"SELECT event_id, user_id AS item FROM events WHERE {IN_RANGE}",
)
register(
    "batch_item_counts",
    lambda s, d: fr.batch_item_counts(batched_in_range(s, d)),
    f"SELECT {BATCH_ID} AS batch_id, user_id AS item, count(*) AS f FROM events WHERE {IN_RANGE} GROUP BY ALL",
)
register(
    "batch_sizes",
    lambda s, d: fr.batch_sizes(batched(s, d)),
    f"SELECT {BATCH_ID} AS batch_id, count(*) AS n FROM events GROUP BY ALL",
)
register(
    "count_sketch_dense",
    lambda s, d: sk.dense_sketch(USERS.sketch(s, d), len(ROWS), USERS.width),
    f"""WITH {USERS.ctes()}
SELECT CAST(a.j AS INTEGER) AS j, CAST(b.c AS INTEGER) AS c, coalesce(val, 0) AS val
FROM range({len(ROWS)}) a(j) CROSS JOIN range({USERS.width}) b(c) LEFT JOIN sketch k ON k.j = a.j AND k.c = b.c""",
)
register(
    "count_sketch_merge",
    lambda s, d: sk.merge_sketches(sk.count_sketch(batched_in_range(s, d), ROWS, USERS.width, by=["batch_id"])),
    f"WITH {USERS.ctes()} SELECT j, c, val FROM sketch",
)
register(
    "count_sketch_packed_merge",
    lambda s, d: ps.unpacked(
        ps.merge_packed(ps.packed_sketch(batched_in_range(s, d), ROWS, USERS.width, "batch_id"), len(ROWS), USERS.width),
        USERS.width,
    ),
    f"""WITH {USERS.ctes()}
SELECT CAST(a.j AS INTEGER) AS j, CAST(b.c AS INTEGER) AS c, coalesce(val, 0) AS val
FROM range({len(ROWS)}) a(j) CROSS JOIN range({USERS.width}) b(c) LEFT JOIN sketch k ON k.j = a.j AND k.c = b.c""",
)
register(
    "heavy_hitter_lines",
    lambda s, d: USERS.heavy(s, d).orderBy(F.col("f").desc(), "item"),
    f"WITH {USERS.ctes()} SELECT item, f, f_est FROM heavy ORDER BY f DESC, item",
)
register(
    "heavy_hitter_estimates_even",
    lambda s, d: USERS.heavy(s, d, ROWS[:4]),
    f"WITH {EVEN} SELECT item, f, f_est FROM heavy",
)
register(
    "second_moment_estimate_even",
    lambda s, d: as_double(sk.second_moment_estimate(USERS.sketch(s, d, ROWS[:4]), 4), "f2_est"),
    f"WITH {EVEN} SELECT CAST(f2 AS DOUBLE) AS f2_est FROM f2_median",
)

# ---- stop threshold --------------------------------------------------------


def stop_after(spark: SparkSession, sf: str) -> DataFrame:
    return USERS.read(spark, sf).selectExpr(f"count(1) * {STOP_PERCENT} div 100 AS threshold")


THRESHOLD = f"""b AS (SELECT {BATCH_ID} AS batch_id, count(*) AS n FROM events GROUP BY ALL),
w AS (SELECT batch_id, n, CAST(coalesce(sum(n) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS BIGINT) AS total_before FROM b),
folded AS (SELECT batch_id, n, total_before FROM w WHERE total_before < (SELECT count(*) * {STOP_PERCENT} // 100 FROM events))"""

register(
    "threshold_batches",
    lambda s, d: fr.threshold_batches(fr.batch_sizes(batched(s, d)), stop_after(s, d).scalar()),
    f"WITH {THRESHOLD} SELECT batch_id, n, total_before FROM folded",
)

# ---- Structured Streaming --------------------------------------------------


def land_events(spark: SparkSession, sf: str, batches: int) -> str:
    """The events' lines as a log with a landing for each range of event ids."""
    log, rows = shared_folder(spark, "log"), USERS.read(spark, sf)
    landing = src.equal_batches(rows, "event_id", batches).alias("landing")
    ll.write_log(rows.select(F.col(USERS.column).cast("string").alias("value"), landing), log, "landing")
    return log


def logged(spark: SparkSession, sf: str, batches: int) -> DataFrame:
    """The events as a stream of log lines: one landing is one micro-batch, whatever its files are."""
    log, offered = land_events(spark, sf, batches), f"{shared_folder(spark, 'offered')}/offset.json"
    return pg.counted(ll.log_lines(spark, log, 1, offered))


def timed_run(spark: SparkSession, sf: str, state: DataFrame) -> tuple[str, list[pg.Batch]]:
    """One query under a timed trigger until it has read all events; its checkpoint and its batches."""
    checkpoint = shared_folder(spark, "checkpoint")
    return checkpoint, pg.run_until(spark, lambda: st.start_updates(state, checkpoint), USERS.read(spark, sf).count())


def state_over_files(spark: SparkSession, sf: str, state_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The state after several timed micro-batches of one query, each with its share of the landed files."""
    log = land_events(spark, sf, STATE_BATCHES)
    files = len(spark.read.option("recursiveFileLookup", "true").text(log).inputFiles())
    lines = pg.counted(ss.text_lines(spark, log, files_per_batch=max(1, files // STATE_BATCHES)))
    checkpoint, _ = timed_run(spark, sf, state_of(src.parse_items(lines)))
    remove_folder(spark, log)
    return st.current_state(spark, checkpoint, "f")


def stream_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return state_over_files(spark, sf, lambda items: st.frequency_state(items, USERS.left, USERS.right))


def stream_sketch(spark: SparkSession, sf: str) -> DataFrame:
    counts = state_over_files(spark, sf, lambda items: st.residue_state(items, USERS.left, USERS.right))
    return st.sketch_of_state(counts, ROWS, USERS.width)


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of a timed run with the number of their lines, from the metrics that the run reports."""
    items = src.parse_items(logged(spark, sf, TIMED_BATCHES))
    _, batches = timed_run(spark, sf, st.frequency_state(items, USERS.left, USERS.right))
    return pg.batch_times(spark, batches).select("batch_id", "n")


def report_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """One query over the table's column; length, frequencies and sketch all come from its state."""
    items = src.parse_items(ss.column_lines(spark, f"{sf}/{USERS.table}.parquet", USERS.column))
    checkpoint = shared_folder(spark, "checkpoint")
    st.start_updates(st.frequency_state(items, USERS.left, USERS.right), checkpoint, ONCE).awaitTermination()
    counts = st.current_state(spark, checkpoint, "f")
    freq = counts.where("item IS NOT NULL")
    return USERS.report(counts.agg(F.sum("f").alias("n_items")), freq, USERS.folded_sketch(freq))


def ledger_run(spark: SparkSession, sf: str) -> str:
    """One query under a timed trigger over ten landings, each a micro-batch, until the threshold."""
    path, checkpoint = shared_folder(spark, "ledger"), shared_folder(spark, "checkpoint")
    threshold = stop_after(spark, sf).first()["threshold"]
    if threshold:
        items = src.parse_items(logged(spark, sf, BATCHES))
        lg.start_ledger(items, path, checkpoint, USERS.left, USERS.right, threshold).wait()
        remove_folder(spark, checkpoint)
    return path


def stream_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return lg.ledger(spark, ledger_run(spark, sf))


def stream_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return lg.folded_counts(spark, ledger_run(spark, sf)).where("item IS NOT NULL")


def report_at_threshold(spark: SparkSession, sf: str) -> DataFrame:
    counts = lg.folded_counts(spark, ledger_run(spark, sf))
    freq = fr.merge_batch_counts(counts.where("item IS NOT NULL"))
    length = counts.agg(F.sum("f").alias("n_items"))
    return USERS.report(length, freq, USERS.folded_sketch(freq))


register(
    "stream_item_frequency",
    lambda s, d: stream_frequency(s, d).where("item IS NOT NULL"),
    f"WITH {USERS.ctes()} SELECT item, f FROM freq",
)
register("stream_count_sketch", stream_sketch, f"WITH {USERS.ctes()} SELECT j, c, val FROM sketch")
register(
    "stream_batch_progress",
    stream_progress,
    f"SELECT {batch_id(TIMED_BATCHES)} AS batch_id, count(*) AS n FROM events GROUP BY ALL",
)
register("stream_report_from_state", report_from_state, USERS.report_sql())
register(
    "stream_batch_ledger",
    stream_ledger,
    f"WITH {THRESHOLD} SELECT batch_id, n, total_before FROM folded",
)
register(
    "stream_threshold",
    stream_threshold,
    f"""WITH {THRESHOLD} SELECT {BATCH_ID} AS batch_id, user_id AS item, count(*) AS f FROM events
WHERE {IN_RANGE} AND {BATCH_ID} IN (SELECT batch_id FROM folded) GROUP BY ALL""",
)
register(
    "stream_report_at_threshold",
    report_at_threshold,
    f"WITH {THRESHOLD}, {USERS.report_sql(filtered=f'WHERE {BATCH_ID} IN (SELECT batch_id FROM folded)')[5:]}",
)
