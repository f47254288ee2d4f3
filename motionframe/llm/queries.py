"""The queries of this subpackage, opN_<name>, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.llm import chat, decontaminate, gnat_codes, hyperlang, licences, merkle, minhash, prefix_bpe, quality_lines, repair_files, secrets, slots, whitening
from motionframe.session import shared_folder, ship, table, written


def op1_hyperlang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", hyperlang.held_out().alias("held_out"))
    known = hyperlang.prototypes(docs.where(~F.col("held_out") & F.col("lang").isNotNull()))
    return hyperlang.identify(docs, known, ["doc_id", "held_out"])


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = repair_files.write_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), shared_folder(spark))
    return repair_files.read_documents(spark, path)


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_rows(table(spark, sf_dir, "documents"))


def op4_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a copy of the archives in which some records have a byte changed and some archives lost their end."""
    records = merkle.archived(table(spark, sf_dir, "pages"))
    original = written(merkle.leaves(records), "original")
    at = original.select("row", "archive", "ordinal", "start")
    ends = at.groupBy("archive").agg(F.max("ordinal").alias("last"))
    kept = (F.col("archive") % 29 != 3) | (F.col("ordinal") + 5 <= F.col("last"))
    middle = (F.octet_length("bytes") / 2).cast("int")
    hit = F.crc32(F.col("record_id").cast("string").cast("binary")) % 97 == 0
    damaged = F.when(hit, F.overlay("bytes", F.unhex(F.lit("00")), middle)).otherwise(F.col("bytes"))
    found = records.select("row", F.sha2(damaged, 256).alias("digest"))  # where the bytes are: only digests are shuffled
    copy = found.join(at.join(ends, "archive").where(kept), "row").select("archive", "start", "digest")
    copy = written(merkle.copied(original, copy), "copy")
    shape = merkle.shape(original, copy)
    return merkle.audit(merkle.tree(original, *shape), merkle.tree(copy, *shape))


def op5_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.read_back(written(chat.format_conversations(rows.unionByName(extra)), "chat"))


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_lines.measure_lines(table(spark, sf_dir, "documents"), source_col="source")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "n_lost_words")


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 of a new map deals the slots in turn, version 2 is edited by the bytes; first_shard is version 1's."""
    folder, n_shards = f"{shared_folder(spark)}/slot_map-{uuid.uuid4().hex}", 40
    docs = slots.measured(table(spark, sf_dir, "documents"))
    slots.start(spark, folder, n_shards)
    slots.rebalance(docs, folder, n_shards)
    rows = slots.place(docs, folder)
    one, _ = slots.read_map(spark, folder, 1)
    first = spark.createDataFrame([(s, k) for (s, _), k in one.items()], "vslot int, first_shard int")  # a row a slot
    grown = F.lit(None).cast("int").alias("grown_shard")
    return rows.join(F.broadcast(first), "vslot").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown, "vslot", "piece", "first_shard")


def op9_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.judged(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "opaque")
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
        F.array_join("spans.n_owners", ",").alias("n_owners"),
        F.array_join("spans.n_repos", ",").alias("n_repos"),
        F.array_join("spans.class", ",").alias("classes"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = decontaminate.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return seen.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op11_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def op13_licence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hyperlang": op1_hyperlang,
    "op2_repair_ids": op2_repair_ids,
    "op3_circulant_minhash": op3_circulant_minhash,
    "op4_merkle_audit": op4_merkle_audit,
    "op5_chat_round_trip": op5_chat_round_trip,
    "op6_prefix_bpe": op6_prefix_bpe,
    "op7_line_quality": op7_line_quality,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_secret_ownership": op9_secret_ownership,
    "op10_decontaminate": op10_decontaminate,
    "op11_gnat_codes": op11_gnat_codes,
    "op12_exact_whitening": op12_exact_whitening,
    "op13_licence_index": op13_licence_index,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {k: shipped(f) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op11_gnat_codes": gnat_codes.sql(), "op13_licence_index": licences.sql()}
