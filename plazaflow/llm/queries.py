"""One thin query per operator, over whole tables, in the columns each is compared by."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.llm import (
    bpe,
    chat,
    decontaminate,
    jaccard,
    language,
    licenses,
    merkle,
    packing,
    phrases,
    pseudo,
    quality,
    recount,
    toxicity,
)
from plazaflow.llm.tables import load


def hex_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded_col="decoded")
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def op2_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language.train(docs.where(~held_out))
    return language.identified(docs.drop("lang"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.to_json("language.proportions").alias("proportions"),
    )


def op3_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    scores = pseudo.scored(docs, pseudo.train(docs)).select("doc_id", "lm.*")
    return scores.select("doc_id", "n_tokens", "log_likelihood", "mean")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(load(spark, folder, "documents"))


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    examples = chat.formatted(load(spark, folder, "conversations").unionByName(extra))
    read = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "place").alias("whole"),
        F.array_sort(F.collect_list(F.struct("place", chat.target_of().alias("said")))).alias("targets"),
        F.sum(F.char_length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    read = read.select(
        "conv_id",
        "formatted_chars",
        chat.turns_of(F.col("whole")).alias("turns"),
        F.array_join("targets.said", "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        hex_digest(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        hex_digest(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


def own_edits(doc_id: Column, text: Column) -> Column:
    """Three edits of a text made of itself: a stretch replaced, one deleted, one put in."""
    n = F.char_length(text)

    def place(salt: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(salt)), n + 1)

    def edit(start: Column, length: int, new: Column) -> Column:
        return F.struct(
            start.cast("bigint").alias("start"), F.lit(length).cast("bigint").alias("length"), new.alias("text")
        )

    return F.array(
        edit(place(1), 7, F.substr(text, (place(2) + 1).cast("int"), F.lit(19))),
        edit(place(3), 45, F.lit("")),
        edit(place(4), 0, F.concat(F.lit("\n"), F.substr(text, (place(5) + 1).cast("int"), F.lit(150)))),
    )


def op6_edit_recount(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("edits", own_edits(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    counted = recount.edited(docs, RANKS, public_tokenizers.PATTERN)
    return counted.select(
        "doc_id",
        F.col("recount.n_tokens").alias("n_tokens"),
        F.col("recount.n_tokens_after").alias("n_tokens_after"),
        (F.col("recount.encoded_chars") - F.coalesce(F.char_length("text"), F.lit(0)))
        .cast("bigint")
        .alias("reencoded_chars"),
        hex_digest(F.col("recount.text")).alias("edited_sha256"),
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    labels = load(spark, folder, "labels").where(fold(F.col("doc_id"), 5) != 0)
    score = F.col("toxicity.score")
    return toxicity.scored(docs, toxicity.train(docs, labels)).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("toxicity.passages").cast("bigint").alias("n_passages"),
    )


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(load(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    best = F.get("licenses", F.lit(0))
    return licenses.scanned(docs).select(
        "doc_id",
        best["license"].alias("license"),
        best["coverage"].alias("coverage"),
        best["first"].alias("first_word"),
        best["last"].alias("last_word"),
        F.size("licenses").cast("bigint").alias("n_found"),
    )


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    hits = decontaminate.marked(docs, load(spark, folder, "benchmark"))
    items = F.array_join(F.array_sort(F.col("hit.items").cast("array<string>")), ",")
    return hits.select(
        "doc_id",
        F.col("hit.n_words").alias("n_words"),
        F.col("hit.n_hit").alias("n_hit"),
        F.size("hit.items").cast("bigint").alias("n_items"),
        hex_digest(items).alias("items_sha256"),
        (F.col("hit.n_hit") > 0).alias("contaminated"),
    )


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(load(spark, folder, "documents"))


WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_OF_DOCUMENT = 1


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return packing.packed(docs, WORD_TOKENIZER, END_OF_DOCUMENT).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_id",
    )


LEAF_VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF_VALUES]
    tampered = F.when((fold(F.col("doc_id"), 7) == 0) & F.col("n_chars").isNotNull(), merkle.leaf_of(*changed))
    docs = docs.withColumn("tampered", tampered)
    rows = merkle.proofs(merkle.manifest(docs, LEAF_VALUES, carried=("tampered",)))
    path, shown = F.col("path"), F.coalesce("carried.tampered", "leaf")
    rows = rows.withColumn("folded_root", merkle.folded(shown, path))
    return rows.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.digest(F.array_join(merkle.siblings(path), "")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_language_mixture": op2_language_mixture,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_quality_rules": op4_quality_rules,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_edit_recount": op6_edit_recount,
    "op7_toxicity": op7_toxicity,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_license_scan": op9_license_scan,
    "op10_decontaminate": op10_decontaminate,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_packing": op12_packing,
    "op13_merkle_manifest": op13_merkle_manifest,
}
