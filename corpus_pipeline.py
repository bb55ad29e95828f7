"""From raw documents to packed training sequences: the stages and their order.

Every stage takes all rows that its predecessor kept and gives back the columns
of its input, the last one the packed pieces. A stage's result is written to the
shared folder as Parquet and read again, so a lost executor never repeats more than one stage.

| stage | operator | what goes, or changes |
|---|---|---|
| quality rules | host rules | documents that fail the base rules, or the strict ones on a bad host |
| exact dedup | block naming | all but one of equal texts |
| near dedup | LSH forest, 5-word shingles, similarity 0.8 | all but one document of a component |
| pseudonyms | format-preserving permutation | personal values, within their format; n_chars follows the text |
| packing | shortest pack first | texts become pieces of sequences of 1,024 ids |

Defined cases are those of the operators. Further columns of the documents pass through the first four
stages, whatever their names; the last stage does not read them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldspark.llm import blocknames, forest, packing, pii, rules
from foldspark.llm.queries import PII_KEY
from foldspark.llm.shared import prepare, shared_folder, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host rules keep."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text", "source")
    return rules.host_rules(rows, columns=["_row"]).filter("kept").select("_row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return blocknames.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return forest.keep_one(docs, words=5, percent=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal values replaced."""
    rows = pii.pseudonymise(docs.select(F.struct(*docs.columns).alias("_row"), "text"), PII_KEY)
    own = {c: F.col(f"_row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("n_pii") > 0, F.char_length("text").cast("long")).otherwise(own["n_chars"])
    return rows.select(*[own[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("pseudonyms", pseudonyms),
    ("packing", packed),
]

#: Near duplicates, pseudonyms and ids cannot be stated in SQL; tests/llm hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.schema(docs.schema).parquet(f"{folder}/{k}")
    return docs
