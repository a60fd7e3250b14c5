"""From raw documents to packed training windows, in five stages.

Each stage takes all rows that its predecessor kept, as a table, and gives documents again, with the
columns of ``documents``; the last one gives the pieces of packed windows. Further columns may have
any names; a stage on an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.llm import jaccard, language, mixing, repeats
from clickstar.llm.queries import language_model, packed
from clickstar.llm.tables import ROW_GROUP, read, written


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells; those that it rejects go, among them those with a
    null text or one without a letter. Rows stay as they are, repeated ones too."""
    return language.identified(docs, language_model(docs))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id, and of rows that repeat it one.
    Rows without an id or without words stay, as they are near to nothing."""
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; ``n_chars`` counts what is left. A null
    text stays null; one of which nothing is left stays as an empty one."""
    left = repeats.without_repeats(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources has it, which may be never. The null source is a
    source, a null text has no words, and repeated rows are rows of their own."""
    return mixing.mixed(docs, mixing.word_count(F.col("text")))


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in training windows; an empty or null text is its end token alone.
    Workers let go of their memos of words, which the memory of other stages would miss."""
    return packed(docs, keep_memo=False)


STAGES = [
    ("language", told_language),
    ("near_duplicates", one_of_near_duplicates),
    ("repeats", without_repeats),
    ("mixing", mixed_sources),
    ("packing", packed_windows),
]

#: SQL has no words for trained models, rounding by draws and tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each result but the last written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", ROW_GROUP)
    return STAGES[-1][1](spark, docs, sf_dir)
