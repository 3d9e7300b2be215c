"""Corpus pipeline: quality rules, exact and near deduplication, mixing, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""
from __future__ import annotations

from hourcast.llm import exact_dedup, mixing, near_dedup, packing, quality
from hourcast.llm.common import documents, materialize
from hourcast.llm.queries import tokenizer_file


def quality_rules(spark, docs, sf_dir):
    """Documents that the weighted rules do not reject."""
    return quality.keep_good(docs)


def exact_duplicates(spark, docs, sf_dir):
    """One document of each group of identical texts: the largest doc_id."""
    return exact_dedup.drop_duplicates(docs, keep="max")


def near_duplicates(spark, docs, sf_dir):
    """One document of each component of near duplicates (five-word shingles,
    similarity 0.8 or more): the smallest doc_id."""
    return near_dedup.drop_near_duplicates(docs, percent=80)


def mix_sources(spark, docs, sf_dir):
    """Documents repeated or left out so that sources meet their weights."""
    return mixing.mixture(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents in training sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: weighted rules, sketches and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
