"""Benchmark decontamination: which documents contain a test item, wholly or almost.

Containment of an item in a document is the fraction of the item's distinct five-word shingles
that the document has. The search is by MinHash: of each item only a bottom sketch, the shingles
with the smallest hashes, is looked for. Items are partitioned by size, and the size fixes how
long a sketch is and how many of its hashes a document must hold, so that no document above the
threshold can be missed. Found pairs are verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trisketch.llm.keys import with_keys
from trisketch.session import materialize

WORDS = 5
THRESHOLD = 0.75
WHITE_SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_ROWS = 1_000_000
"""Sketch hashes, item shingles or candidate ids that are broadcast at most (about 16 MB); more go by shuffle."""


def words_of(text: Column) -> Column:
    """Lower-cased words between white space; null or blank text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE_SPACE), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Five-word shingles as text; fewer words make one shingle, no words none."""
    whole = F.array_join(words, " ")
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
        F.when(F.size(words) < WORDS, F.array(whole)).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(words) - (WORDS - 1), F.lit(1))),
                lambda i: F.array_join(F.slice(words, i, WORDS), " "),
            )
        )
    )


def shingle_hashes(hashes: Column) -> Column:
    """One 64-bit hash per shingle, in the order of `shingles`, from the hashes of the words."""
    size = F.size(hashes)
    return F.when(size == 0, F.array().cast("array<bigint>")).otherwise(
        F.when(size < WORDS, F.array(F.xxhash64(hashes))).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(size - WORDS, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WORDS)]),
            )
        )
    )


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _small(df: DataFrame) -> DataFrame:
    """A side of a join, broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, h, shingle, n): the distinct shingles of each item; n is their number.

    Rows of one item_id are one item with the shingles of all of them; null ids and items
    without words are left out.
    """
    words = items.where("item_id IS NOT NULL").select("item_id", words_of(F.col("text")).alias("words"))
    zipped = words.select("item_id", F.arrays_zip(shingle_hashes(_hashed(F.col("words"))).alias("h"), shingles(F.col("words")).alias("shingle")).alias("z"))
    rows = zipped.select("item_id", F.inline("z")).distinct()
    return rows.withColumn("n", F.count("*").over(Window.partitionBy("item_id")))


def bottom_sketches(shingled: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(h, item_id, hits): the bottom sketch of each item and the hits a document needs.

    An item of n shingles may lack floor((1 - threshold) n) of them. A sketch longer than that by
    `hits` keeps at least `hits` in any document above the threshold. `hits` grows with the size
    class (a power of two), so long items do not become candidates by one common phrase.
    """
    in_order = Window.partitionBy("item_id").orderBy("h", "shingle")
    lower = F.pow(F.lit(2), F.floor(F.log2(F.col("n"))))
    missing = F.floor(F.col("n") - F.ceil(F.col("n") * threshold - 1e-9))
    hits = F.least(1 + F.floor(lower / 16), F.col("n") - missing)
    return (
        shingled.withColumns({"place": F.row_number().over(in_order), "hits": hits, "missing": missing})
        .where(F.col("place") <= F.col("missing") + F.col("hits"))
        .select("h", "item_id", "hits")
    )


def contamination(
    documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) with containment >= threshold.

    Whole texts are searched. Null and empty texts contain nothing. An item of fewer than five
    words is found in documents of exactly its words. A document whose id is null or repeated is
    taken row by row: each such row has pairs of its own. Empty tables give no pair. Columns
    other than the ids and texts are ignored.
    """
    keyed = with_keys(documents, "__key", doc_id, text).select("__key", F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shingled = materialize(item_shingles(items), "items")
    sketches = materialize(bottom_sketches(shingled, threshold), "sketches")

    hashed = keyed.select("__key", _hashed(words_of(F.col("text"))).alias("words"))
    probes = hashed.select("__key", F.explode(shingle_hashes(F.col("words"))).alias("h"))
    found = probes.join(_small(sketches), "h").groupBy("__key", "item_id").agg(
        F.count_distinct("h").alias("found"), F.first("hits").alias("hits")
    )
    candidates = materialize(found.where("found >= hits").select("__key", "item_id"), "candidates")

    suspects = keyed.join(_small(candidates.select("__key").distinct()), "__key").select(
        "__key", "doc_id", words_of(F.col("text")).alias("words")
    )
    rows = suspects.select("__key", "doc_id", F.explode(F.array_distinct(shingles(F.col("words")))).alias("shingle"))
    shared = (
        rows.join(_small(shingled.select("item_id", "shingle", "n")), "shingle")
        .groupBy("__key", "doc_id", "item_id", "n")
        .agg(F.count("*").alias("n_shared"))
        .where(F.col("n_shared") >= F.ceil(F.col("n") * threshold - 1e-9))
    )
    return shared.join(candidates, ["__key", "item_id"], "left_semi").select(
        "doc_id",
        "item_id",
        F.col("n").alias("n_item"),
        "n_shared",
        (F.col("n_shared") / F.col("n")).alias("containment"),
    )


def decontaminated(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no test item; all rows of a contaminated id go, other rows stay."""
    hit = materialize(contamination(documents, items, threshold).select("doc_id").distinct(), "contaminated")
    return documents.join(_small(hit), documents["doc_id"].eqNullSafe(hit["doc_id"]), "left_anti")
