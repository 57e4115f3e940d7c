"""Queries of the training-data operators: (function, oracle SQL or None) by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import (alignment, jaccard, langid, lm, manifest, mixing, quadratic, quality, suffixdedup, superkmer, tiling,
                          toxicity, urlfilter)
from stayflow.llm.common import fold, maybe_listed, prepare, read, staged

#: A page with less html than this is thin; op7 lists the URLs of thin pages.
THIN_HTML = 4000


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every document."""
    out = quality.quality_rules(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", *[F.col(f"_{s}").alias(s) for s in quality.STATS],
                      F.col("_base_failed").alias("base_failed"), F.col("_p_good").alias("p_good"),
                      F.col("_kept").alias("kept"))


def op1_sql() -> str:
    ctes, table = quality.oracle_sql()
    return f"WITH {ctes}\nSELECT doc_id, {', '.join(quality.STATS)}, base_failed, p_good, kept FROM {table}"


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word windows cut from every document."""
    return superkmer.dedup_substrings(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document, learned from those outside fold 2 of 7."""
    docs = read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    out = lm.score(docs, docs.filter(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to temperature weights of their sources, in global shuffle order."""
    out = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "n_chars", "text", F.round("_rate", 6).alias("rate"),
                      F.col("_copy").alias("copy"), F.col("_key").alias("shuffle_key"))


def op4_sql() -> str:
    return (f"WITH {mixing.oracle_sql()}\nSELECT doc_id, source, lang, n_chars, text, round(rate, 6) AS rate, copy, "
            "shuffle_key FROM mixed ORDER BY shuffle_key, copy")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows outside fold 0 of 5."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    known = labels.filter("toxic IS NOT NULL").filter(fold(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")
    train = maybe_listed(docs.select("doc_id", "text"), ["doc_id"], known).join(known, "doc_id")
    weights, intercept = toxicity.train(train)
    out = toxicity.score(docs, weights, intercept)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a similarity of 0.8 or more."""
    return jaccard.jaccard_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def listed_urls(pages: DataFrame) -> DataFrame:
    return pages.filter(F.length("html") < THIN_HTML).select("url")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and path rules, then the list of thin pages' canonical URLs, over every page."""
    pages = read(spark, sf_dir, "pages")
    out = urlfilter.filter_urls(pages.select("page_id", "url"), listed_urls(pages))
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                      F.col("_verdict").alias("verdict"))


def op7_sql() -> str:
    return (f"WITH {urlfilter.oracle_sql(f'SELECT url FROM pages WHERE length(html) < {THIN_HTML}')}\n"
            "SELECT page_id, host, path, rule, verdict FROM judged")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that its passages cover."""
    return tiling.contaminated_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside fold 2 of 4."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    out = langid.identify(docs, langid.learn_dictionaries(docs.filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings cut from every document."""
    return suffixdedup.dedup_bytes(read(spark, sf_dir, "documents")).drop("kept")


#: Vocabulary files of the two tokenizers that op11 aligns.
TOKENIZER_A, TOKENIZER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, for every document."""
    return alignment.align_documents(read(spark, sf_dir, "documents"), alignment.Tokenizers.read(path_a, path_b))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows outside fold 0 of 5."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    rows = staged(quadratic.with_statistics(docs), "statistics")
    known = labels.filter(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    out = quadratic.score(rows, quadratic.train(rows.join(known, "doc_id")))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash trees of every language and their proofs, checked against a tampered copy."""
    out = manifest.manifest(read(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 0)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_REGISTERED = {
    "op1_quality_rules": (op1_quality_rules, op1_sql),
    "op2_substring_dedup": (op2_substring_dedup, None),
    "op3_lm_scoring": (op3_lm_scoring, None),
    "op4_mix_sources": (op4_mix_sources, op4_sql),
    "op5_toxicity": (op5_toxicity, None),
    "op6_ngram_jaccard_join": (op6_ngram_jaccard_join, None),
    "op7_url_filters": (op7_url_filters, op7_sql),
    "op8_benchmark_decontamination": (op8_benchmark_decontamination, None),
    "op9_language_id": (op9_language_id, None),
    "op10_suffix_dedup": (op10_suffix_dedup, None),
    "op11_cross_tokenizer_alignment": (op11_cross_tokenizer_alignment, None),
    "op12_quality_classifier": (op12_quality_classifier, None),
    "op13_merkle_manifest": (op13_merkle_manifest, manifest.oracle_sql),
}


def _session(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict:
    return {name: _session(fn) for name, (fn, _) in _REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, (_, sql) in _REGISTERED.items() if sql}
