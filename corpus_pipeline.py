"""Documents to token files in stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm import decontaminate, langid, mixing, near, token_files
from relayframe.session import cut_lineage

#: Near duplicates share this many hundredths of their sets of so many words in a row.
SHINGLE_WORDS, PERCENT = 5, 80
#: The rarest source is passed over at most this often; none loses a document.
REPEATS = 1.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learned language: those without a letter, those in a script that none of
    them uses, and those that score below ``langid.bar`` go."""
    learned = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id")))
    model = langid.learn(learned)
    found = langid.predict(docs.select(*COLUMNS), model)
    sure = F.col("score") > langid.bar(learned, model)
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & sure).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates."""
    return near.one_of_each(docs.select(*COLUMNS), SHINGLE_WORDS, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_tests(docs.select(*COLUMNS), benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of rare sources, up to ``REPEATS`` passes, by temperature weights."""
    return mixing.mixture(docs.select(*COLUMNS), mixing.Target(repeats=REPEATS, cover=True))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what is read back from them."""
    import public_tokenizers

    return token_files.token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mix), ("tokens", tokens)]

#: No SQL can express tokenizing, span labelling or bit streams; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages in order to ``documents`` and returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
