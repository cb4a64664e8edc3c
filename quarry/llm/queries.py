"""The operators over the tables of a data directory, with production parameters: ``fn(spark, data_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import best_fit, context_tree, id_matrix, lattice, page_text, periodic_runs, phrase_automata, secrets, segment_lid, shingle_tree, site_lines, spaced_seeds, target_sampling, tokens


def read(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(data_dir).rstrip('/')}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every document in as few sequences of 1024 tokens as vector best-fit finds."""
    return best_fit.pack_documents(read(spark, d, "documents"), tokens.default_path())


def op2_spaced_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Every document and benchmark item that overlap, substitutions tolerated."""
    return spaced_seeds.overlaps(read(spark, d, "documents"), read(spark, d, "benchmark"))


def op3_lattice(spark: SparkSession, d: str) -> DataFrame:
    """Links and components of all vectors of a label at cosine 0.93 and above."""
    return lattice.near_vectors(read(spark, d, "embeddings"))


def op4_segment_lid(spark: SparkSession, d: str) -> DataFrame:
    """The language of every document by segmentation-marginalised unigrams."""
    return segment_lid.identify_documents(read(spark, d, "documents"))


def op5_id_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Every document in packed rows of 1024 ids, with cumulative lengths and position resets."""
    return id_matrix.pack_rows(read(spark, d, "documents"), tokens.default_path())


def op6_shingle_tree(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate components of all documents at a shingle Jaccard of 0.75 and above."""
    return shingle_tree.near_documents(read(spark, d, "documents"))


def op7_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """Secrets in every whole text: base rules, further credential formats, and their spans."""
    return secrets.digest(secrets.scan(read(spark, d, "documents")))


def op8_page_text(spark: SparkSession, d: str) -> DataFrame:
    """The main text of every page."""
    return page_text.extract(read(spark, d, "pages"))


def op9_site_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every document without the lines that over one in 200 of its source's documents hold."""
    out = site_lines.drop_site_lines(read(spark, d, "documents"), F.col("source"), counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")


def op10_context_tree(spark: SparkSession, d: str) -> DataFrame:
    """Every document scored by context-tree weighting learnt from nine tenths of them."""
    return context_tree.score(read(spark, d, "documents"), segment_lid.held_out(folds=10, fold=0))


def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of repeated words in every text, a tenth of the texts with repeats planted, and digests of the collapsed texts."""
    docs = periodic_runs.with_planted_repeats(read(spark, d, "documents").select("doc_id", "text"), F.crc32(F.col("doc_id").cast("string")))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(docs))


def op12_phrase_automata(spark: SparkSession, d: str) -> DataFrame:
    """Every document without the words of windows of 13 words that also start in a document with a smaller id."""
    out = phrase_automata.drop_recurring(read(spark, d, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_target_sampling(spark: SparkSession, d: str) -> DataFrame:
    """Every document's weight towards the benchmark's word pairs, its noisy score, and its rank among the quarter drawn."""
    return target_sampling.resample(read(spark, d, "documents"), read(spark, d, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_spaced_seeds": op2_spaced_seeds,
    "op3_lattice": op3_lattice,
    "op4_segment_lid": op4_segment_lid,
    "op5_id_matrix": op5_id_matrix,
    "op6_shingle_tree": op6_shingle_tree,
    "op7_secret_scan": op7_secret_scan,
    "op8_page_text": op8_page_text,
    "op9_site_lines": op9_site_lines,
    "op10_context_tree": op10_context_tree,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_target_sampling": op13_target_sampling,
}

SQL: dict[str, str] = {
    "op9_site_lines": site_lines.SITE_LINES_SQL,
    "op12_phrase_automata": phrase_automata.RECURRING_SQL,
    "op13_target_sampling": target_sampling.RESAMPLE_SQL,
}
