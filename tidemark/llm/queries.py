"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations,
    decontaminate,
    language,
    main_text,
    phrases,
    pii,
    piece_bpe,
    quality,
    simhash,
    suffixes,
    toxicity,
    url_filter,
    whitening,
)
from tidemark.llm.deploy import workers_find_package
from tidemark.llm.language import held_out
from tidemark.llm.oracles import ORACLE_SQL as ORACLE_SQL
from tidemark.scratch import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    """The vocabulary file of the public tokenizer that is used unless another is given."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents")).drop("clean_text")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, or an edited copy of one; others have no row."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxicity_index(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Index:
    """Learned from labels outside the held-out quarter and the texts of ``docs``."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.train(labels.where(~held_out("doc_id", 4, 2)), docs)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_index(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


def op6_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = phrases.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0)))
    predicted = language.predict(docs, model)
    return predicted.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_bpe.digests(piece_bpe.encode_decode(docs, model_path()))


# The rules of the contract.
URL_RULES = (
    url_filter.Rule("org", "/", block=False),
    url_filter.Rule("example.org", "/es/", block=True),
    url_filter.Rule("example.org", "/en/1", block=True),
    url_filter.Rule("com", "/fr/", block=False),
    url_filter.Rule("com", "/de/", block=True),
)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, url_filter.train(pages, URL_RULES)).drop("url")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults of the contract, by the CRC-32 of conversation and turn modulo 20."""
    conv, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    stripped = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        stripped.alias("text"),
        F.explode(F.array_repeat(F.lit(True), copies)).alias("copy"),
    ).drop("copy")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    broken = damaged(turns)
    repaired, edits = conversations.repair(broken)
    digests = conversations.digests(broken, edits)
    found = repaired.withColumnRenamed("conv", "_conv").join(
        digests, F.col("_conv").eqNullSafe(F.col("conv")), "left"
    ).drop("conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        turns.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pii": op2_pii,
    "op3_main_text": op3_main_text,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_phrases": op6_phrases,
    "op7_suffixes": op7_suffixes,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_conversations": op13_conversations,
}
