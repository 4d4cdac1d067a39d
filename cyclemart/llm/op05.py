"""Token counts of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclemart.llm.tables import query, read
from cyclemart.llm.token_counts import token_counts, zipf_vocabulary

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op5_token_counts")
def counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), zipf_vocabulary(vocabulary))
