"""Merkle manifest of a table of documents, by a rollup of nested structs.

The leaves of a group are numbered, and the hexadecimal digits of the numbers are grouped away one
after the other, lowest first: what shares the higher digits becomes one struct that nests its
children. A block nests three digits, so at most 4096 leaves; its roots are the leaves of the next
round, until each group has one. Proofs come out by transform and explode alone, level by level from
the top of a block to its leaves. The one join is between blocks: every block, a single row, meets
the path of its root. Digests are made over hexadecimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.session import materialize

WIDTH = 16
LEVELS = 3
BLOCK = WIDTH**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAVES_A_TASK = 50_000
GROUP, RANK, SIZE, HASH, KIDS, PATH, CARRY = "group", "rank", "size", "hash", "kids", "path", "carry"
TOP = (PATH, "subroot", "root")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(documents: DataFrame, text: Column | None = None) -> Column:
    """The leaf digest of a document, with another text in place of its own if given."""
    values = [text if name == "text" and text is not None else documents[name] for name in FIELDS]
    return digest(*map(field, values))


def lower_cased(text: Column) -> Column:
    return F.translate(text, LETTERS, LETTERS.lower())


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, level: digest(level.before, h, level.after))


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a path, from the leaf to the root, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda level: F.concat(level.before, level.after))), 256)


def _ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `rank` from 0 and `size` within each group, in the order of the given columns.

    Rows are sorted over all groups at once, so a group may be as large as the table. A task numbers
    its own rows, and a row for each task and group says where the group begins there. `order` must
    tell rows apart that a task may not hold together.
    """
    tasks = max(nodes.sparkSession.sparkContext.defaultParallelism, nodes.count() // LEAVES_A_TASK + 1)
    by = [GROUP, *order]
    numbered = nodes.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    numbered = materialize(numbered, "merkle-ranked").withColumn("task", F.shiftright("at", 33))
    runs = numbered.groupBy("task", GROUP).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.expr(f"sum(n) OVER (PARTITION BY {GROUP} ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    whole = F.expr(f"sum(n) OVER (PARTITION BY {GROUP})")
    runs = runs.select("task", GROUP, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), whole.alias(SIZE))
    return numbered.join(runs, ["task", GROUP]).withColumn(RANK, F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _blocks(nodes: DataFrame) -> DataFrame:
    """(group, size, rank, hash, kids): nodes nested by blocks; `rank` is the block's, `hash` its root.

    All digits are grouped away inside the distribution by block, after a single shuffle. A level
    is passed through where the group has one node left.
    """
    keys = [GROUP, SIZE, "block", *[f"d{i}" for i in range(LEVELS - 1, -1, -1)]]
    digits = [F.expr(f"CAST(rank div {WIDTH**i} % {WIDTH} AS TINYINT)").alias(f"d{i}") for i in range(LEVELS)]
    level = nodes.select(GROUP, SIZE, F.expr(f"rank div {BLOCK}").alias("block"), *digits, HASH, CARRY)
    level = level.repartition(GROUP, "block")
    nested = [HASH, CARRY]
    for i in range(LEVELS):
        keys = keys[:-1]
        level = level.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"d{i}", *nested))).alias(KIDS))
        hashes = F.col(KIDS)[HASH]
        one = F.when(F.col(SIZE) > WIDTH**i, F.sha2(F.concat_ws("", hashes), 256)).otherwise(hashes[0])
        level, nested = level.withColumn(HASH, one), [HASH, KIDS]
    return level.withColumnRenamed("block", RANK)


def _with_siblings(kids: Column, i: int) -> Column:
    """Nodes of level `i` under one parent, each with what stands before and after it, as rows."""
    hashes, rest = kids[HASH], KIDS if i else CARRY

    def row(kid: Column, place: Column) -> Column:
        left = F.concat_ws("", F.slice(hashes, F.lit(1), place))
        right = F.concat_ws("", F.slice(hashes, place + 2, F.lit(WIDTH)))
        return F.struct(kid[f"d{i}"].alias("digit"), kid[HASH].alias(HASH), left.alias("before"), right.alias("after"), kid[rest].alias(rest))

    return F.inline(F.transform(kids, row))


def _proved(blocks: DataFrame) -> DataFrame:
    """The nodes in blocks, (group, size, rank, hash, carry, path, subroot, root); a block has its root's path."""
    nodes = blocks
    for i in range(LEVELS - 1, -1, -1):
        rows = nodes.select(GROUP, SIZE, F.col(RANK).alias("parent"), *TOP, _with_siblings(F.col(KIDS), i))
        longer = F.concat(F.array(F.struct("before", "after")), F.col(PATH))
        nodes = rows.select(
            GROUP,
            SIZE,
            (F.col("parent") * WIDTH + F.col("digit")).alias(RANK),
            HASH,
            KIDS if i else CARRY,
            F.when(F.col(SIZE) > WIDTH**i, longer).otherwise(F.col(PATH)).alias(PATH),
            "subroot",
            "root",
        )
    return nodes


def _rounds(ranked: DataFrame) -> list[DataFrame]:
    """Written blocks of every round; the last round has one block a group."""
    largest = ranked.agg(F.max(SIZE)).first()[0] or 0
    rounds, nodes = [], ranked
    while True:
        rounds.append(materialize(_blocks(nodes), "merkle-blocks"))
        if largest <= BLOCK:
            return rounds
        largest = -(-largest // BLOCK)
        nodes = rounds[-1].select(
            GROUP, F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias(SIZE), RANK, HASH, F.lit("").alias(CARRY)
        )


def _all_proved(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves of the first round; `tops` has (group, path, subroot, root) of every group's root."""
    tops = tops.withColumn(RANK, F.lit(0).cast("bigint"))
    for blocks in reversed(rounds):
        nodes = _proved(blocks.drop(HASH).join(tops.select(GROUP, RANK, *TOP).hint("merge"), [GROUP, RANK]))
        tops = nodes
    return nodes


def leaves(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, claim): the leaf digests, and those over another text where it is given."""
    claim = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf(documents, tampered))
    return documents.select("source", "doc_id", leaf(documents).alias("leaf"), claim.alias("claim"))


def prove(leaves: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, claim, subroot, root, path) of the leaves (source, doc_id, leaf, claim).

    The leaves of a source ascend by doc_id, nulls first, then by digest; equal ones are alike, so
    only which of their rows has which place is open. 16 nodes in a row, or at the end fewer, become
    one until one is left; the sources' nodes, null first, then bytewise, become the root the same
    way. `path` holds the text of the siblings before and after the node, level by level from the
    leaf to the root; `claim` is any text that travels with a leaf. No leaves give no rows.
    """
    named = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    rows = leaves.select(
        named.alias(GROUP),
        "doc_id",
        F.col("leaf").alias(HASH),
        F.struct("source", "doc_id", "claim").alias(CARRY),
        F.monotonically_increasing_id().alias("row"),
    )
    rounds = _rounds(_ranked(materialize(rows, "merkle-leaves"), ["doc_id", HASH, "row"]))
    sources = rounds[-1].select(F.lit("").alias(GROUP), HASH, F.col(GROUP).alias(CARRY))
    above = _rounds(_ranked(sources, [CARRY]))
    nothing = F.array().cast("array<struct<before: string, after: string>>")
    root = above[-1].select(GROUP, nothing.alias(PATH), F.col(HASH).alias("subroot"), F.col(HASH).alias("root"))
    tops = _all_proved(above, root).select(F.col(CARRY).alias(GROUP), PATH, F.col(HASH).alias("subroot"), "root")
    return _all_proved(rounds, tops).select(f"{CARRY}.*", F.col(HASH).alias("leaf"), "subroot", "root", PATH)
