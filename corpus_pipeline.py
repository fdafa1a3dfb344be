"""Corpus pipeline: documents -> cleaned, deduplicated, mixed and encoded.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next stage's docs.
All stages but the last return the columns of ``documents``. ``run`` applies them in
order. The stages learn models from the corpus, so there is no SQL form
(``ORACLE_SQL`` is None); ``tests/llm/test_pipeline.py`` checks them by brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.llm import mixing, near_dedup, rule_ensemble, sentencepieces, weak_rules
from uvlens.llm.common import crc_mod, fresh, materialize
from uvlens.llm.queries import MIX_SEED, MIX_WEIGHTS
from uvlens.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the rule ensemble (operator 9), which learns
    from the same rows as op9."""
    model = rule_ensemble.fit(docs, read_table(spark, sf_dir, "labels"), learn_from=crc_mod("id", 3) != 1)
    score = fresh(docs, "score")
    return rule_ensemble.score(docs, model, out=score).where(F.col(score) >= 0.5).select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-supervision rules keep (operator 3)."""
    judged = weak_rules.judge(docs)
    return judged.where(fresh(docs, "rule_kept")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near-duplicates: five-word
    shingles, Jaccard 0.8 or more (operator 5)."""
    return near_dedup.keep_one(docs, threshold=0.8, k=5).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources (operator 7)."""
    return mixing.mix(docs, MIX_WEIGHTS, seed=MIX_SEED).select(docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document copy as piece ids (operator 2, with its N of 3): doc_id, lang,
    source, ids, n_pieces, nbest_scores."""
    got = sentencepieces.encode(docs, n=3, out=fresh(docs, "pieces"))
    pieces = F.col(fresh(docs, "pieces"))
    return got.select("doc_id", "lang", "source", pieces["ids"].alias("ids"),
                      F.size(pieces["ids"]).cast("bigint").alias("n_pieces"),
                      pieces["nbest_scores"].alias("nbest_scores"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("source mix", source_mix),
    ("SentencePiece ids", sentencepiece_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
