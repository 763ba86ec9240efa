"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next one's ``docs``.  All but the last
return the columns of ``documents``:

1. ``language_id``: documents whose language is rejected go;
2. ``exact_dedup``: of equal texts the one with the largest doc_id stays;
3. ``near_dedup``: of near-duplicates (five-word shingles, similarity 0.8 or
   more, transitively) the one with the smallest doc_id stays;
4. ``suffix_dedup``: passages of 50 bytes or more that occur in an earlier
   document are cut out;
5. ``packing``: texts become token sequences of at most 1,024 ids.

Ids: a null doc_id sorts first; texts may be null or empty; rows that repeat
one another are exact copies; an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import scratch, stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = stages.STAGES

#: The first stage is a trained classifier and the fifth runs a tokenizer: no SQL has their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
