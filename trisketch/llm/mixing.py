"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's target over its size is the number of copies each of its documents should have. The
whole part is taken as it is; the fractions are rounded together. In a duel of two documents,
random mass moves from one fraction to the other until one is 0 or 1; the other goes on. Duels
run in blocks of documents of one source and like size, each block leaves one open fraction, and
the open ones duel on the next level of a reduction tree, so the sum of copies stays what it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trisketch.llm.keys import with_keys
from trisketch.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
BLOCK = 64
BROADCAST_ROWS = 1_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) from (source, size); a null source is one more, the last.

    Targets are in proportion to the weights but for those that stop at MOST_COPIES times their
    size. Such sources are the first ones in the order of size / weight, so one running sum finds
    the level that the others share. One row per source goes through the windows.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(x)) for x in weights])
    rank = F.row_number().over(in_order) - 1
    capped = sums.withColumn("weight", F.get(pattern, rank % len(weights))).withColumn(
        "most", F.col("source_size").cast("double") * MOST_COPIES
    )
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    leveled = capped.withColumn("level", left / F.sum("weight").over(after))
    # Taking out a source that stops raises the level of the others; taking out one that does not lowers it.
    shared = F.max("level").over(every)
    return leveled.select(
        "source",
        "source_size",
        F.least("most", F.coalesce(shared, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that only depends on these values, so reruns and retries agree."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / float(1 << 52)


def _duels(members: Column, seed: int) -> Column:
    """One block: struct(won ARRAY<key>, key, p); the last two are the fraction left open.

    `members` is an ordered array of struct(key, p) with 0 < p < 1.
    """
    # A new block starts with its first member; p null means that nothing is open any more.
    nothing = F.struct(
        F.array().cast("array<bigint>").alias("won"),
        F.lit(None).cast("bigint").alias("key"),
        F.lit(None).cast("double").alias("p"),
    )

    def result(won: Column, key: Column, p: Column) -> Column:
        return F.struct(won.alias("won"), key.alias("key"), F.when((p > 1e-12) & (p < 1 - 1e-12), p).alias("p"))

    def duel(acc: Column, one: Column) -> Column:
        total = acc["p"] + one["p"]
        draw = _uniform(F.lit(seed), acc["key"], one["key"])
        # Below 1 one of them drops out; from 1 on one of them is taken, the other keeps the rest.
        stays = draw * total < acc["p"]
        takes = draw * (2 - total) < 1 - one["p"]
        below = result(acc["won"], F.when(stays, acc["key"]).otherwise(one["key"]), total)
        above = result(
            F.array_append(acc["won"], F.when(takes, acc["key"]).otherwise(one["key"])),
            F.when(takes, one["key"]).otherwise(acc["key"]),
            total - 1,
        )
        # A sum that is 1 but for rounding errors settles both.
        exact = result(F.array_append(acc["won"], F.when(stays, acc["key"]).otherwise(one["key"])), acc["key"], F.lit(0.0))
        return (
            F.when(acc["p"].isNull(), result(acc["won"], one["key"], one["p"]))
            .when(F.abs(total - 1) < 1e-9, exact)
            .when(total < 1, below)
            .otherwise(above)
        )

    return F.aggregate(members, nothing, duel)


def rounded_up(fractions: DataFrame, seed: int = 0) -> DataFrame:
    """(key): the documents that get one copy more.

    `fractions` has (key, source, size, p) with 0 < p < 1. Blocks hold about BLOCK documents of
    one source and size class, placed by a hash of the key; each level has one row per block of
    the last, until each source has one open fraction, which a last draw settles.
    """
    level = fractions.select(
        "key", "source", "p", F.floor(4 * F.log2(F.col("size"))).cast("int").alias("class"), F.col("size")
    )
    counts = level.groupBy("source", "class").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    wide = counts.select(
        F.col("source").alias("__source"), F.col("class").alias("__class"), F.ceil(F.col("n") / BLOCK).alias("blocks")
    )
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("class") == F.col("__class"))
    level = level.join(wide, same).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks")))
    level = level.select("key", "source", "p", "class", "size", "block")
    won = []
    for step in range(100):
        by_block = most > 1
        group = ["source", "class", "block"] if by_block else ["source"]
        member = F.struct("class", "size", "key", "p")
        rows = level.groupBy(*group).agg(F.sort_array(F.collect_list(member)).alias("members"))
        settled = rows.withColumn("out", _duels(F.col("members"), seed * 100 + step))
        done = materialize(settled.select(*group, "members", "out"), "duels").withColumn("key", F.col("out.key"))
        won.append(done.select(F.explode("out.won").alias("key")))
        still = done.where("out.p IS NOT NULL").withColumn(
            "size", F.filter("members", lambda m: m["key"] == F.col("out.key"))[0]["size"]
        )
        if not by_block:
            last = _uniform(F.lit(seed), F.lit("last"), F.col("key")) < F.col("out.p")
            won.append(still.where(last).select("key"))
            break
        most = -(-most // BLOCK)
        level = still.select(
            "key", "source", F.col("out.p").alias("p"), "class", "size", F.floor(F.col("block") / BLOCK).alias("block")
        )
    result = won[0]
    for more in won[1:]:
        result = result.unionByName(more)
    return result


def mixture(
    documents: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(key, doc_id, source, size, source_size, target, copies) of every document.

    size counts the words of the whole text (null: 0). A document without words has no effect on
    any sum and gets 0 copies. Null sources are one source, the last. If a doc_id is null or
    repeated, each row counts as a document. The result depends on the rows and the seed only, not
    on partitions. Other columns are ignored; an empty table gives an empty result.
    """
    return _mixture(with_keys(documents, "__key", doc_id, text), seed, doc_id, text, source)


def _mixture(keyed: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    sized = materialize(
        keyed.select(
            F.col("__key").alias("key"),
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        ),
        "sizes",
    )
    targets = materialize(source_targets(sized), "targets").withColumnRenamed("source", "__source")
    rates = sized.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    base = F.when(F.col("size") > 0, F.floor(rate + 1e-12)).otherwise(0)
    rated = rates.withColumns({"base": base, "p": rate - F.floor(rate + 1e-12)})
    open_ones = rated.where("size > 0 AND p > 1e-12").select("key", "source", "size", "p")
    more = rounded_up(open_ones, seed).select("key", F.lit(1).alias("one"))
    return rated.join(more, "key", "left").select(
        "key", "doc_id", "source", "size", "source_size", "target", (F.col("base") + F.coalesce("one", F.lit(0))).alias("copies")
    )


def mixed(documents: DataFrame, seed: int = 0) -> DataFrame:
    """The documents as the mix takes them: each row as often as it has copies."""
    keyed = with_keys(documents)
    mix = _mixture(keyed, seed, "doc_id", "text", "source").where("copies > 0")
    copies = materialize(mix.select(F.col("key").alias("__key"), "copies"), "copies")
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    repeated = keyed.join(copies, "__key").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*documents.columns)
