"""Registered queries of the operators in this folder, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trisketch.llm import decontamination as dc
from trisketch.llm import embedding_dedup as ed
from trisketch.llm import langid as li
from trisketch.llm import lm
from trisketch.llm import merkle as mk
from trisketch.llm import mixing as mx
from trisketch.llm import ngram_join as nj
from trisketch.llm import pii
from trisketch.llm import prefix_trie as pt
from trisketch.llm import quality as ql
from trisketch.llm import substring_dedup as sd
from trisketch.llm import token_counts as tc
from trisketch.llm import toxicity as tx
from trisketch.llm.shipping import ship

PII_KEY = "public test key"  # a production run takes it from its secret store


def crc32_sql(text: str) -> str:
    """crc32 over the bytes of an ASCII text, in DuckDB's SQL."""
    bits = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))"
    letters = f"list_transform(range(1, len({text}) + 1), lambda k: ascii({text}[k])::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {bits}), 4294967295)"


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = tc.token_counts(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


QUERIES["op1_token_counts"] = op1_token_counts


def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf), PII_KEY).select("doc_id", "text", "n_personal")


QUERIES["op7_pii"] = op7_pii


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    scored = tx.toxicity(docs.select("doc_id", "text"), tx.train_on(docs, labels))
    return scored.select(
        "doc_id",
        tx.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES["op3_toxicity"] = op3_toxicity


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return dc.contamination(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


QUERIES["op2_decontamination"] = op2_decontamination
ORACLES["op2_decontamination"] = r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
  UNION ALL
  SELECT 1, item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') FROM benchmark),
shingles AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words WHERE len(w) > 0),
items AS (SELECT id, shingle, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 1)
SELECT d.id AS doc_id, i.id AS item_id, i.n AS n_item, count(*) AS n_shared, count(*) / i.n AS containment
FROM (SELECT * FROM shingles WHERE kind = 0) d JOIN items i USING (shingle)
GROUP BY d.id, i.id, i.n HAVING 4 * count(*) >= 3 * i.n"""


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = sd.remove_repeated(documents(spark, sf))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES["op5_substring_dedup"] = op5_substring_dedup
ORACLES["op5_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
kept AS (
  SELECT u.doc_id, count(*) AS n, string_agg(u.x, ' ' ORDER BY u.i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words) u
  ANTI JOIN removed r ON u.doc_id = r.doc_id AND u.i = r.i GROUP BY u.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)"""


def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return nj.near_duplicates(documents(spark, sf))


QUERIES["op4_ngram_join"] = op4_ngram_join


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mix = mx.mixture(documents(spark, sf))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES["op8_mixing"] = op8_mixing


def op6_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return ed.near_duplicate_vectors(ship(spark).read.parquet(f"{sf}/embeddings.parquet"))


QUERIES["op6_embedding_dedup"] = op6_embedding_dedup


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.log_probabilities(documents(spark, sf))


QUERIES["op10_lm_scoring"] = op10_lm_scoring


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(~ql.held_out(F.col("doc_id")))
    return ql.quality(documents(spark, sf), labels).select(
        "doc_id",
        ql.held_out(F.col("doc_id")).alias("held_out"),
        "evidence",
        "host_rate",
        "path_rate",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES["op9_quality"] = op9_quality


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    tampered = F.when(F.crc32(docs.doc_id.cast("string")) % 5 == 0, mk.lower_cased(docs.text))
    proved = mk.prove(mk.leaves(docs, tampered))
    folded = mk.fold(F.coalesce("claim", "leaf"), F.col("path"))
    proof = mk.proof_digest(F.col("path")).alias("proof_sha256")
    checked = proved.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES["op12_merkle_manifest"] = op12_merkle_manifest


def manifest_sql(levels: int = 6) -> str:
    """SQL over groups of up to 16^levels nodes: runs of 16 level by level, then the path of each leaf."""

    def field(x: str) -> str:
        return f"coalesce(octet_length(encode({x}::VARCHAR)) || ':' || {x}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def rise(name: str) -> str:
        return "".join(
            f"""
{name}_r{k + 1} AS (SELECT g, run, hs, n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM (
  SELECT g, p // 16 AS run, list(h ORDER BY p) AS hs, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}_l{k}) GROUP BY ALL)),
{name}_l{k + 1} AS (SELECT g, run AS p, h FROM {name}_r{k + 1}),"""
            for k in range(levels)
        )

    def walk(steps: str, name: str, k: int) -> str:
        before, after = "array_to_string(r.hs[1:d.p % 16], '')", "array_to_string(r.hs[d.p % 16 + 2:], '')"
        return f"""
{name}_d{k + 1} AS (SELECT d.* EXCLUDE (p, proof, folded), d.p // 16 AS p, CASE WHEN r.n > 1 THEN d.proof || {before} || {after} ELSE d.proof END AS proof,
  CASE WHEN r.n > 1 THEN sha256({before} || d.folded || {after}) ELSE d.folded END AS folded
  FROM {steps} d JOIN {name}_r{k + 1} r ON d.g IS NOT DISTINCT FROM r.g AND r.run = d.p // 16),"""

    def walks(name: str) -> str:
        return "".join(walk(f"{name}_d{k}", name, k) for k in range(levels))

    crc = crc32_sql("(doc_id::VARCHAR)")
    lower = f"translate(text, '{mk.LETTERS}', '{mk.LETTERS.lower()}')"
    return f"""
WITH leaves AS (
  SELECT doc_id, source AS g, {leaf("text")} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS claim FROM documents),
x_d0 AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, '' AS proof, coalesce(claim, leaf) AS folded FROM leaves),
x_l0 AS (SELECT g, p, leaf AS h FROM x_d0),{rise("x")}{walks("x")}
subs AS (SELECT g AS source, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p FROM x_l{levels}),
y_l0 AS (SELECT 0 AS g, p, h FROM subs),{rise("y")}
y_d0 AS (
  SELECT d.doc_id, d.leaf, s.h AS subroot, 0 AS g, s.p, d.proof, d.folded FROM x_d{levels} d JOIN subs s ON d.g IS NOT DISTINCT FROM s.source),{walks("y")}
top AS (SELECT h AS root FROM y_l{levels})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM y_d{levels}, top"""


ORACLES["op12_merkle_manifest"] = manifest_sql()


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    conversations = ship(spark).read.parquet(f"{sf}/conversations.parquet")
    return pt.prefix_trie(pt.rebuilt(conversations)).drop("hi", "lo")


QUERIES["op13_prefix_trie"] = op13_prefix_trie
ORACLES["op13_prefix_trie"] = rf"""
WITH said AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS x,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, x, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(x)) - 1 AS place FROM said),
convs AS (SELECT conv_id AS c, conv_id - conv_id % 20 AS first, {crc32_sql("(conv_id::VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c, place, x, n FROM convs JOIN turns ON conv_id = first WHERE place < h
  UNION ALL SELECT c, place, x, n FROM convs JOIN turns ON conv_id = c WHERE place >= h),
members AS (
  SELECT c, row_number() OVER w AS d, sha256(string_agg(octet_length(encode(x)) || ':' || x, '') OVER w) AS k, n FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY place) UNION ALL SELECT c, 0, 'root', 0 FROM convs),
chained AS (SELECT c, d, k, n, lag(k) OVER (PARTITION BY c ORDER BY d) AS above, lead(k) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends FROM members),
nodes AS (
  SELECT k, d, min(c) AS c, count(*) AS n_convs, any_value(above) AS above, (count(*) - 1) * any_value(n) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM chained GROUP BY k, d),
children AS (SELECT above AS k, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
sums AS (
  SELECT m.k, count(*) FILTER (n.n_children = 0) AS n_leaves, sum(n.saved) AS saved
  FROM counted n JOIN members m ON m.c = n.c AND m.d <= n.d GROUP BY m.k)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.k = n.k LEFT JOIN nodes p ON p.k = n.above"""


def op11_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    pieces = li.read_pieces(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    model = li.learn(docs.where(~li.held_out(F.col("doc_id"))), pieces)
    found = li.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", li.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES["op11_language_id"] = op11_language_id
