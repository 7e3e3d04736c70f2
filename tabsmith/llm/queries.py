"""The operators of this package over the supplied tables, with the parameters
of production; each query derives its digest columns from the operator's own
output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import decontaminate, embedding_dedup, html_text, language, license_scan, merkle, oracle_sql, packing, periodic_runs, quality, simhash_dedup, substring_dedup, token_files, toxicity
from tabsmith.llm.common import held_out, table
from tabsmith.session import scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~held_out("doc_id")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), length=4096, end_id=2, special_as_text=False)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs.filter(~held_out("doc_id"))))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=0, special_as_text=False)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the periodic passages that the query's contract asks for:
    where crc32 of the id ends in 0, the words from the ``a``-th on repeat the
    first ``p`` of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise("")), F.lit(0))
    return docs.withColumn("text", F.when(h % 10 == 0, changed).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_periods(table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs, least=6, times=4, keep=lambda text: F.sha2(text, 256))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = periodic_runs.longest(F.col("runs"))
    milli = 1000 * best["length"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        ((milli - milli % best["period"]) / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=35, keep=lambda text: F.sha2(text, 256))
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, merkle.leaf_digest([*columns, F.translate("text", "\n", "")]))
    made = merkle.manifest(docs.withColumn("tampered", tampered), [*columns, "text"], carry=["tampered"])
    folded = merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("proof"))
    return made.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_token_files": op10_token_files,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op12_substring_dedup": oracle_sql.SUBSTRING_DEDUP,
    "op13_merkle_manifest": oracle_sql.MERKLE_MANIFEST,
}
