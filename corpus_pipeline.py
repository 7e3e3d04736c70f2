"""The corpus pipeline: every stage's operator over what the stage before kept.

Documents of poor quality go, then toxic ones, then all but one document of each
near-duplicate group, then those that hold a benchmark item; the rest is packed
into sequences. Each stage's result is written as Parquet into the shared
scratch folder and read again by the next, so a lost executor costs at most
tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import decontaminate, packing, quality, simhash_dedup, toxicity
from tabsmith.llm.common import held_out, table, written
from tabsmith.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows, all columns, that the quality scorer takes for good; it is trained
    on the stage's own input, without labels. Null and empty texts are scored as
    texts without words; rows that repeat are judged alike; an empty table stays
    empty. Columns of any name stay.
    """
    return quality.good_documents(docs, quality.train(docs))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows, all columns, that score below the threshold; the labels of held-out
    ids are not learned from. A null or empty text is scored as one without words;
    rows that repeat are judged alike; an empty table stays empty; without labels of
    both kinds every text scores the share of toxic ones. Columns of any name stay.
    """
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates, with all columns: the smallest id's,
    and of several the first as written. Null and wordless texts are one group; a
    row without an id always stays; an empty table stays empty. Columns of any
    name stay.
    """
    return simhash_dedup.near_duplicates(docs, shingle=4, max_bits=4)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows, all columns, in which no benchmark item occurs within its error
    budget. A null or empty text holds none and stays; so does everything where the
    benchmark is empty or its items are null; rows that repeat are judged alike.
    Columns of any name stay.
    """
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of at most 4096 ids, as ``op3_packing``
    has them. A null text is empty and packs its end id; rows that repeat are packed
    each; an empty table gives no pieces; other columns are ignored.
    """
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), length=4096, end_id=2, special_as_text=False)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("simhash_dedup", one_of_each),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: SQL can express neither the trained classifiers nor the tokenizer; the
#: pipeline is tested against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents`` in ``sf_dir``. Each stage
    reads what the one before has written; nulls, empty texts, repeated rows and
    empty tables are as the stages state.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
