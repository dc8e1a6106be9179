"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import (
    chat,
    decontaminate,
    exact,
    fingerprint,
    jaccard,
    language,
    merkle,
    mixing,
    packing,
    periodic,
    quality,
    repeats,
    sharding,
)
from tidemark.llm import sql as oracle
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


@query("op1_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(quality.remainder("doc_id", 4) == 2, F.lit(False))
    ranking = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score_column(F.col("text"), ranking).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


@query(
    "op2_mixing",
    r"""
    WITH docs AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), sized AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth
        FROM docs GROUP BY source
    ), weighed AS (
        SELECT *, [3.0, 1.0, 2.0][(nth - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS full_size FROM sized
    ), levels AS (
        -- for each source: the level at which it and all that are harder to fill share what is left
        SELECT a.source, a.full_size / a.weight AS ratio,
               (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed)
                - coalesce(sum(b.full_size) FILTER (b.full_size / b.weight < a.full_size / a.weight), 0))
               / sum(b.weight) FILTER (b.full_size / b.weight >= a.full_size / a.weight) AS level
        FROM weighed a, weighed b GROUP BY a.source, a.full_size, a.weight
    ), target AS (
        SELECT source, source_size, least(full_size, weight * (
                   SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target,
               (('0x' || substr(md5(coalesce('11:=' || source, '11:')), 1, 3))::INTEGER + 0.5::DOUBLE) / 4096 AS start
        FROM weighed
    ), placed AS (
        SELECT doc_id, size, source_size, target, start, target / source_size AS rate,
               row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS nth
        FROM docs d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (floor(start + rate * nth) - floor(start + rate * (nth - 1)))::BIGINT * size AS taken FROM placed
    """,
)
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


HARD_CHAT = "<|im_end|><|im_start|>assistant ok"


@query(
    "op3_chat_format",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
               + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars,
           regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text), '(system,)?user,assistant(,user,assistant)*') AS valid
    FROM turns GROUP BY conv_id
    """,
)
def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD_CHAT).alias("text"),
    )
    chats = chat.format_chats(table(spark, sf_dir, "conversations").select(*hard.columns).unionByName(hard))
    back = chats.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("segments"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


@query("op4_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumnRenamed("id", "doc_id")


@query("op5_ngram_jaccard")
def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.jaccard_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "class_id", "n_links")


@query("op6_suffix_dedup")
def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    length = lambda spans: F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        length(F.col("removed")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query(
    "op7_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op8_fingerprints")
def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op9_sharding")
def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16, seed=2024)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


@query("op10_language_model")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(quality.remainder("doc_id", 7) == 2, F.lit(False))
    model, counts = language.train(docs.filter(~held_out).select("text"))
    scored = language.score_texts(docs, model, counts).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def echoed(doc_id: Column, text: Column) -> Column:
    """The text whose words the contract of op11 repeats: in documents with h % 10 = 0 (h: CRC-32 of the
    id) the words from a on are the p words from a on, over and over."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(text)


@query("op11_periodic_runs", oracle.PERIODIC_RUNS)
def periodic_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", echoed(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    # runs come by start and period, so of equal ratios the first stays
    better = lambda best, run: best["start"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", nothing, lambda best, run: F.when(better(best, run), run).otherwise(best))
    told = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_merkle_manifest", oracle.MERKLE_MANIFEST)
def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", decontaminate.UPPER, decontaminate.LOWER)
    tampered = merkle.leaf_digest(*(lowered if name == "text" else F.col(name) for name in merkle.LEAF_COLUMNS))
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered)
    proven = merkle.manifest(docs, carry={"tampered": changed})
    return proven.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_decontamination", oracle.DECONTAMINATION)
def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, item_sets = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digests = item_sets.select(
        "item_set", F.size("items").cast("long").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("digest")
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.join(digests, "item_set", "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n", F.lit(0)).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("item_set").isNotNull().alias("contaminated"),
    )
