"""The pipeline from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it back as the next stage's ``docs``.

Every stage keeps the columns it got, whatever their names, gives an empty table for an empty one, and looks at all rows
and whole texts. A NULL text counts as one without words, a NULL source as a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import line_frequency, pareto_mix, positional_index, segment_join, tensored_minhash
from stratum.llm.common import read
from stratum.scratch import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that too many documents of their source hold.

    Documents of fewer than 20 words go, those without text among them. Repeated rows are judged alike.
    """
    return line_frequency.filtered(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only the first of lines that are at most a few edits apart; documents left without a word go.

    First is the line of the smallest document id, then place; rows without text stay as they are.
    """
    return segment_join.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 80% of the five-word shingles in common.

    It is the one with the smallest id. Documents without words are like no other and stay. Rows that repeat an id and
    text stay or go together.
    """
    return tensored_minhash.deduplicated(docs, tensored_minhash.Settings(shingle=5, threshold_percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no large part of a benchmark item.

    Documents without words hold none and stay; items without text are none.
    """
    return positional_index.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the words it takes of each (copies counted).

    Documents without words are never taken. Rows that repeat an id and text share one place in the order.
    """
    return pareto_mix.mixed(docs).filter("taken > 0")


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination), ("mixing", mix),
]

#: Several stages have no SQL form; tests hold each one against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
