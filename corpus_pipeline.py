"""The corpus pipeline: language, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept. The first four return the columns of
`documents`: documents without a known language go; of near-duplicates one stays; documents that share ten words in
a row with a benchmark item go; secrets are replaced in the text. The last returns the packed pieces.

Null and empty texts, having no language, go in the first stage, as do texts without a letter; if no row has a language to learn
from, all texts with a letter stay. Rows that repeat leave one. Long texts are taken whole by each stage. Null ids and null
values elsewhere stay as they are, other columns too, whatever their names. An empty table gives no pieces.
"""

from pyspark.sql import DataFrame, SparkSession

from txguard.llm import decontam, language, minhash, packing, secrets
from txguard.llm.queries import tokenizer_file
from txguard.plans.workspace import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("near duplicates", one_of_near_duplicates),
    ("benchmark", no_benchmark_passages),
    ("secrets", no_secrets),
    ("packing", packed),
]

#: Learned weights, weighted sampling and packing have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
