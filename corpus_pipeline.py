"""From documents to training sequences: quality rules, exact and near deduplication, repeated passages, packing.

Every stage takes all that its predecessor kept, as a table of its own, and returns what it keeps; the last one returns
the packed pieces.
"""

from pyspark.sql import functions as F

from forecourt.llm.decision_list import drop_low_quality
from forecourt.llm.exact_dedup import drop_copies
from forecourt.llm.jaccard import drop_similar
from forecourt.llm.packing import pack_documents
from forecourt.llm.queries import table, tokenizer
from forecourt.llm.shared import folder, importable
from forecourt.llm.suffix_dedup import drop_passages


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules and the list learned from ``labels`` keep."""
    return drop_low_quality(docs, table(importable(spark), sf_dir, "labels"))


def exact_copies(spark, docs, sf_dir):
    """One document of each group of texts that are equal but for white space."""
    importable(spark)
    return drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group of near duplicates: those whose five-word shingles have a Jaccard similarity of 0.8, the
    almost equal ones of them found by SimHash, the others by prefixes."""
    importable(spark)
    return drop_similar(docs)


def passages(spark, docs, sf_dir):
    """All documents, without the passages that a document with a smaller id has; n_chars is that of the new text."""
    importable(spark)
    return drop_passages(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark, docs, sf_dir):
    """The pieces of all documents in sequences of 4096 tokens."""
    importable(spark)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("suffix_dedup", passages),
    ("packing", packed),
]

#: The learned list, the shingles and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies the stages to ``documents``; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs
