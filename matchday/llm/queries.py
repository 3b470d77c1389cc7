"""The registered queries of the operators, each with its SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchday.llm import byte_bpe, byte_cnn, cqf, crf, flat_graph, hash_tree, kneser_ney, lsh_forest, periodic, pivotal, suffix, trie, warc
from matchday.llm.common import held_out
from matchday.workspace import materialise

#: The vocabulary of the token queries; another rank file may take its place.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SHARDS = 8


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = lsh_forest.near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "kept")


def op2_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = byte_cnn.train(docs, ~held_out(F.col("doc_id")))
    found = byte_cnn.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_flat_graph(spark: SparkSession, folder: str) -> DataFrame:
    found = flat_graph.near_duplicates(_table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op4_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _table(spark, folder, "labels").where("quality = 1").select("doc_id")
    scored = kneser_ney.perplexities(_table(spark, folder, "documents"), trusted, set_apart=kneser_ney.SET_APART)
    found = kneser_ney.judged(materialise(scored, "quality-scores"))
    return found.select(F.col("id").alias("doc_id"), "lang", "n_bytes", "perplexity", "shrunk", "threshold", "kept")


def op5_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = pivotal.mixed(_table(spark, folder, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(_table(spark, folder, "documents"), RANKS, PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS, PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(_table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxic_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = crf.train(docs, _table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    found = crf.tag(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes = cqf.exact_classes(_table(spark, folder, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op10_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    tree = hash_tree.even_tree(SHARDS)
    placed = hash_tree.place(_table(spark, folder, "documents"), tree, hash_tree.grown(tree, SHARDS))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths = trie.turn_paths(_table(spark, folder, "conversations"))
    return trie.prefix_trie(trie.rebuilt(materialise(paths, "conversations")))


def op12_suffix(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.without_repeats(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic.with_planted_runs(_table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, "id")
    # runs come by start and period, so of equal quotients the first stays
    best = F.reduce("runs", F.element_at("runs", 1), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("best", F.when(F.size("runs") > 0, best))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP7_SQL = """
WITH paid AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), first AS (
    SELECT html, min(page_id) AS page FROM paid WHERE payload_bytes >= 100 GROUP BY html
)
SELECT page_id, payload_bytes, sha256(paid.html) AS payload_digest,
       CASE WHEN page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page <> page_id THEN page END AS refers_to
FROM paid LEFT JOIN first USING (html)
"""

OP9_SQL = r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
    FROM documents
), ranked AS (
    SELECT doc_id, t, count(*) OVER (PARTITION BY t) AS group_size,
           first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id
    FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM ranked
"""

#: The crc32 of a decimal id, bit by bit: a byte is mixed in and eight steps follow (-1).
CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({id}::VARCHAR, ''),
    lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295)"""

OP11_SQL = rf"""
WITH numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32_SQL.format(id="conv_id")} % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM numbered)
), built AS (
    SELECT c.conv_id, 0 AS part, i, role, text FROM convs c JOIN numbered n ON n.conv_id = base AND i <= h
    UNION ALL
    SELECT c.conv_id, 1, i, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND i > h
), members AS (
    SELECT conv_id, row_number() OVER path AS depth, string_agg(md5(role) || md5(text), '') OVER path AS key,
           len(regexp_extract_all(text, '[^ 	-
]+')) AS words
    FROM built WINDOW path AS (PARTITION BY conv_id ORDER BY part, i)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
), last AS (
    SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id
), ends AS (
    SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM members JOIN last USING (conv_id, depth) GROUP BY key
), nodes AS (
    SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words,
           CASE WHEN any_value(depth) > 0 THEN key[:-65] END AS above
    FROM members GROUP BY key
), children AS (
    SELECT above AS key, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (key)
), below AS (
    SELECT left(key, 64 * j) AS key, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS j FROM counted) GROUP BY 1
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted c JOIN below ON below.key = c.key LEFT JOIN nodes p ON p.key = c.above LEFT JOIN ends ON ends.key = c.key
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_lsh_forest": (op1_lsh_forest, None),
    "op2_byte_cnn": (op2_byte_cnn, None),
    "op3_flat_graph": (op3_flat_graph, None),
    "op4_kneser_ney": (op4_kneser_ney, None),
    "op5_pivotal_mix": (op5_pivotal_mix, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_warc": (op7_warc, OP7_SQL),
    "op8_toxic_crf": (op8_toxic_crf, None),
    "op9_exact_dedup": (op9_exact_dedup, OP9_SQL),
    "op10_hash_tree": (op10_hash_tree, None),
    "op11_trie": (op11_trie, OP11_SQL),
    "op12_suffix": (op12_suffix, None),
    "op13_periodic": (op13_periodic, None),
}
