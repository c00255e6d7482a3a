"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of documents, whatever their names. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import decontaminate, linededup, packing, quality, simhash
from claimloom.llm.common import materialise, private, table

#: Pieces of text that a packing worker remembers: fewer than alone, as the workers of this pipeline hold other things too.
REMEMBER = 120_000
#: SQL can't express the quality model, the fingerprints or the tokenizer: the stages are tested one by one instead.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good; without usable labels, all of them. Each row is judged by its text: repeated rows alike, null and empty texts as empty ones."""
    names = docs.columns
    score = private(names, "score")
    scored = quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")), score)
    return scored.where(F.col(score) >= 0.5).select(*names)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them (rows, repeated ones too) hold; n_chars is that of the text that is left. Null texts stay null, and documents of which no line is left stay
    with an empty text."""
    names = docs.columns
    before, dropped = private(names, "lines"), private(names, "dropped")
    cut = linededup.LineIndex.build(docs).apply(docs, out=(before, dropped))
    if "n_chars" in names:
        n_chars = F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*names)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingle sets with a Jaccard similarity of 0.8 or more. Texts without words are copies of each other; rows without doc_id stay."""
    return simhash.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the rule of op9. Texts without words (null, empty) stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids and places in the sequences. A null or empty text is one piece, its separator; repeated rows are packed as often as they are there."""
    return packing.pack(docs, remember=REMEMBER)


STAGES = [
    ("quality classifier", good),
    ("line dedup", fresh_lines),
    ("SimHash near-dedup", distinct_texts),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
