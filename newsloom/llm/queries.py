"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    factors,
    line_dedup,
    minhash,
    mixing,
    multi_index,
    neighbours,
    packing,
    periodic,
    pii,
    spelling,
    toxicity,
    url_rules,
    warc,
)
from newsloom.llm.common import WORD, table

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"
    )


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, count=20)


def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def line_dedup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs)


def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return factors.dedup(docs, keep_first=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, a tenth of which are first made periodic from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(hashed / 10), F.size("words").cast("bigint")
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8))
    at = docs.withColumn(
        "words",
        F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))),
    ).withColumns({
        "start": F.when(n > 0, start), "period": F.when(n > 0, period)
    })
    repeated = F.transform("words", lambda word, i: F.when(i < F.col("start"), word).otherwise(
        F.get("words", (F.col("start") + (i - F.col("start")) % F.col("period")).cast("int"))
    ))
    made = F.when(F.col("start").isNotNull(), F.array_join(repeated, " "))
    found = periodic.collapse(at.select("doc_id", F.coalesce(made, "text").alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(
            F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"),
            256,
        ).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of the documents, some of which first lose a letter."""
    found = spelling.tokens(table(spark, sf_dir, "documents"))
    named = F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))
    hashed = F.crc32(named.cast("binary"))
    at = (hashed % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))
    )
    words = found.select(F.when(hashed % 97 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return spelling.group(spelling.count(words))


QUERIES = {
    "op11_repeated_bytes": repeated_bytes,
    "op12_periodic_runs": periodic_runs,
    "op13_spelling_groups": spelling_groups,
    "op9_warc_derivatives": warc_derivatives,
    "op5_line_dedup": line_dedup_texts,
    "op1_nearest_vectors": nearest_vectors,
    "op8_vector_dedup": vector_dedup,
    "op6_toxicity_scores": toxicity_scores,
    "op2_pii_spans": pii_spans,
    "op7_pack_sequences": pack_sequences,
    "op3_minhash_dedup": minhash_dedup,
    "op4_url_filter": url_filter,
    "op10_mix_sources": mix_sources,
}
