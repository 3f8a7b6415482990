"""The corpus pipeline: rules, language, near duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of docs. A null or empty text fails the rules. Rows are judged by their doc_id and text:
those that repeat both stay or go together, those that repeat a doc_id with another text don't, and rows without a
doc_id are judged by their text; extra columns pass through the first four stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import bpe, langid, ngram_join, rules, winnow
from claimweave.llm.common import row_name, stored, table

#: How far from the language's usual rate of phrases a letter to 1, where each letter stands alone, a text may
#: lie: beyond it no learned language explains the text. Where prose needs a fifth of a phrase that is 0.5.
MAX_EXCESS = 0.375


KEY = "__document"


#: Names of rejected rows that are broadcast: 88 bytes each at most, so 18 MB.
BROADCAST_NAMES = 200_000


def _without(named: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `named` but those named in `gone`.

    The rejected names are stored and counted: up to a bound they are broadcast, so that no text is
    shuffled; beyond it both sides are.
    """
    gone = stored(gone.select(KEY).distinct(), "rejected")
    if gone.count() <= BROADCAST_NAMES:
        gone = F.broadcast(gone)
    return named.join(gone, KEY, "left_anti").drop(KEY)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rules.apply_cascade(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those that are `und` or that no language explains go."""
    named = docs.withColumn(KEY, row_name())
    found = langid.predict(named, carried=(KEY,))
    return _without(named, found.where(f"lang_pred = 'und' OR rate > usual_rate + {MAX_EXCESS} * (1 - usual_rate)"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id and text of each class."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    named = docs.withColumn(KEY, row_name())
    found = winnow.hits(named.withColumn("doc_id", F.col(KEY)), table(spark, sf_dir, "benchmark"))
    return _without(named, found.withColumnRenamed("doc_id", KEY))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and digests."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Language ID, the near-duplicate join and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
