"""From raw documents to training tokens: five stages, each one of the corpus operators.

Every stage but the last keeps the columns of ``documents`` and works on all rows that
the stage before kept. ``run`` writes each stage's result as Parquet in the shared
folder and reads it again, so a lost executor costs one stage at most.

Nulls and repeats: a null text counts as empty for quality and fingerprints and passes lines and
decontamination; rows with a null id match no label and are decided like any other, and in a group of near
duplicates they come after those with an id; rows repeated in full share their decision, and
near-duplicate removal keeps one of them; rows with one id and different texts are documents of their own, in
every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from smogline.llm import bpe, common, decontam, lines, quality, simhash
from smogline.session import pin_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    # what a decision depends on, so that rows of one place share theirs
    place = common.row_place("doc_id", "text", "source", "lang")
    scored = quality.classify(docs, common.table(spark, sf_dir, "labels"), reject=quality.REJECT, row=place)
    gone = scored.filter(~F.col("keep")).select(F.col("row").alias("_gone")).distinct()
    return docs.join(gone, place == F.col("_gone"), "left_anti")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; one of which nothing is left goes."""
    got = lines.drop_repeated(docs)
    got = got.filter((F.col("n_removed") <= 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return got.select(*(F.when(changed, new[c]).otherwise(F.col(f"doc.{quoted(c)}")).alias(c) if c in new
                        else F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns))


def quoted(name: str) -> str:
    """A column's name as one word, whatever dots or marks it has."""
    return f"`{name.replace('`', '``')}`"


def one_of_each(docs: DataFrame, places: DataFrame) -> DataFrame:
    """A row of ``docs`` for each of ``places`` that it has. Rows of one place are reduced first, by an
    aggregate, so such rows are combined before they are shuffled."""
    plain = [quoted(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    one = F.min_by(F.struct(*map(quoted, docs.columns)), F.xxhash64(*plain)).alias("row")
    rows = docs.groupBy(common.row_place("doc_id", "text").alias("place")).agg(one)
    return rows.join(places, "place", "left_semi").select(*(F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id, and of several with that id the
    one with the smallest hash. Rows that share an id but are in no group together all stay."""
    return one_of_each(docs, simhash.representatives(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontam.without_overlaps(docs, common.table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of each document."""
    return bpe.encode_decode(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: Classifier, fingerprints and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the tokens of what is left."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
