"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame;
all but the last return the columns of ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, langid, near_dedup, packing, suffix_dedup
from .columns import carrying
from .ship import ship

#: Shingles and similarity of near-duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go.  The classifier learns from the labelled rows of
    ``docs`` outside the held-out quarter; without any such row nothing can be judged and all stay."""
    ship(spark)
    train = docs.filter(~langid.held_out())
    if train.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(langid.has_letter()).isEmpty():
        return docs
    return _known_language(docs, langid.fit(train))


@carrying("doc_id", "text", "lang")
def _known_language(docs: DataFrame, model: object) -> DataFrame:
    return langid.predict(docs, model).filter("NOT rejected").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    ship(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the row with the smallest doc_id stays."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs, SHINGLE_WORDS, SIMILARITY)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of texts."""
    ship(spark)
    return suffix_dedup.kept_text(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1,024 ids with the documents they hold."""
    ship(spark)
    return packing.sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near),
          ("suffix_dedup", passages), ("packing", pack)]
