"""From raw documents to training tokens in five stages.

Each stage takes (spark, docs, sf_dir), with the columns of ``documents``, and
returns what it keeps of them with its decisions applied; the last one returns
the index of the token files it wrote.  Between stages the documents are written
as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm import byte_cnn, decontamination, jaccard_join, mixing, token_files
from sightline.llm import jobs as J

#: file of the tokenizer that the last stage uses, among the public ones
TOKENIZER = "word_bpe_49k.json"
#: no stage after the classifier is expressible in SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not reject."""
    return byte_cnn.accepted(docs, byte_cnn.train(docs, J.table(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest document, of each group of near-duplicates: five words to a shingle, similarity 0.8 or more."""
    J.configure(spark)
    return jaccard_join.one_row_of_each(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of test items; documents that are mostly such passages go."""
    return decontamination.decontaminate(docs, J.table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    J.configure(spark)
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder; a row for each document in them."""
    import public_tokenizers

    J.configure(spark)
    return token_files.tokenized(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = J.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = J.cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
