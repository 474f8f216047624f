"""From documents to token files: quality, near-duplicates, benchmark leaks, source mix, packed token ids.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns a DataFrame. run() writes
each result as Parquet and reads it again for the next stage. All but the last return the columns of documents.

Of every stage: texts of any length count whole; an empty table gives an empty one; extra columns pass through whatever their names (the last stage drops them).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents, keep
from tidemark.llm.decontaminate import decontaminated
from tidemark.llm.mixing import mixed
from tidemark.llm.near_dedup import representatives
from tidemark.llm.quality import accepted
from tidemark.llm.queries import VOCABULARY, tokenizer_path
from tidemark.llm.token_file import token_file

#: Least Jaccard similarity of near-duplicates.
SIMILARITY = Fraction(4, 5)
#: Seed of the draw of copies.
DRAW = 12
#: Pieces whose ids a task of the last stage remembers at once: fewer than the token file's own, as workers keep the memory of the stages before. Ids are the same.
KEPT = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are scored like any other; rows with equal texts go or stay together, with or without an id."""
    # written here, as keep() gives Python workers small batches and the writer of the stage's result may not
    return keep(accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "accepted")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id; groups are linked by five-word shingles of Jaccard similarity 0.8 or more.

    Null and empty texts are one group. Rows with a null id stay. Of rows that repeat both id and text one stays.
    """
    return representatives(docs, similarity=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts stay; rows that share an id, a null one too, go together."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them, at most twice, the rest of a document's share drawn by a hash.

    Null and empty texts are never taken; rows that share an id share the ratio of all of them.
    """
    return mixed(docs, draw=DRAW)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from the token files, in order of ids, null ones first; null texts are the end id alone."""
    return token_file(docs, tokenizer_path(), VOCABULARY, kept=KEPT)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_ids", token_ids)]

#: No SQL expresses boosted trees, 64-bit fingerprints or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    name, last = STAGES[-1]
    return keep(last(spark, docs, sf_dir), name)
