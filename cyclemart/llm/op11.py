"""``documents`` encoded by a public byte-level vocabulary and decoded again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.byte_bpe import encoded, load_vocabulary
from cyclemart.llm.tables import query, read


@query("op11_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    known = load_vocabulary(vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = encoded(docs, known, public_tokenizers.PATTERN, outputs=("packed", "decoded"))
    return found.select(
        "doc_id", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
