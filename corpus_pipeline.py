"""The corpus pipeline: documents to packed training sequences.

Each stage takes what its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's documents:

1. ``quality``: documents that the byte network rejects go;
2. ``near_dups``: one document of each SimHash group stays;
3. ``secrets``: secrets are replaced by a mark (texts without one stay as they are);
4. ``mixing``: documents are taken at the rates that bring the domains to their target weights;
5. ``packing``: the result's pieces in sequences of at most 1024 tokens.

Empty documents, null texts and ids, repeated rows and further columns are
treated as each operator states; all but the last stage return the columns of
their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm.common import table, written
from churnspark.llm.mixing import mix
from churnspark.llm.packing import pack
from churnspark.llm.quality_net import keep_quality
from churnspark.llm.queries import tokenizer_file
from churnspark.llm.secrets import redact
from churnspark.llm.simhash import keep_one

# No SQL states a fitted network, a SimHash trie or a packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, shingle=3, budget=3, id_once=False)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


#: Shares of the mix's tokens.  Low quality is no domain here: the first stage has taken it out,
#: and a target that the corpus cannot supply would hold back clean documents.
MIX_TARGETS = {"plain": 0.95, "toxic": 0.05}


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, mix_domains(table(spark, sf_dir, "labels")), MIX_TARGETS)


def mix_domains(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("plain").alias("domain"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_file(), capacity=1024)


STAGES = [("quality", quality), ("near_dups", near_dups), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
