"""Documents to packed training sequences, in five stages.

Each stage gets all that its predecessor kept and returns the columns of documents; the last
returns the pieces of the packed sequences with their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.llm import chosenpath, curriculum, feistel, fm, packing
from specfold.llm.common import prepared_session, staged, work_dir
from specfold.llm.queries import GOOD, pii_key, tokenizer_path


#: What the operators read; all other columns of a stage's input go beside them in one struct, so that no name can clash.
READ = ("doc_id", "text", "source", "n_chars")


def carried(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and a struct of all others."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in READ]
    return docs.select(*READ, *([F.struct(*rest).alias("carried")] if rest else []))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows with the columns of docs again; n_chars as the text has them now."""
    return rows.select(*[F.col(c) if c in READ else F.col("carried").getField(c).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores below GOOD.

    Null and empty texts are scored by what is left, as is a null n_chars; long texts are read whole; repeated rows
    score alike, so all or none of them stay; an empty table gives no rows. No other column has a part in it.
    """
    labels = prepared_session(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return restored(fm.score_columns(carried(docs), fm.train(docs, labels)).where(F.col("score") >= GOOD), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that links of Jaccard similarity join: the one with the smallest doc_id.

    Rows without doc_id stay, and so do null and empty texts, which nothing is linked with. Where rows share a doc_id,
    those of one text stay once, if any row of that doc_id does; which of them, if other columns differ, is not fixed. Long texts
    are compared whole; an empty table gives no rows. Columns but doc_id and text are not read, whatever their names.
    """
    prepared_session(spark)
    found = staged(chosenpath.join(docs), work_dir(spark), "groups").where("doc_id is not null")
    stay = found.where("kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").hint("merge").join(stay, "doc_id", "left_semi")
    n, distinct = found.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n != distinct:
        named = named.dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in place of personal data; n_chars follows the text.

    A null text stays null, with null n_chars, an empty one empty. Long texts are read whole; repeated rows are
    treated alike; an empty table gives no rows.
    """
    done = feistel.pseudonymize_columns(carried(docs), pii_key(prepared_session(spark)))
    return restored(done.withColumn("n_chars", F.length("text").cast("long")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the words of each source that its target asks for; a document stands once for each time that it is taken.

    Null and empty texts have no words and are not taken; a null source is one of its own, the last. A text is cut
    where its source's target ends, and n_chars with it. Repeated rows count each; an empty table gives no rows.
    """
    mixed = curriculum.mix(carried(docs))
    return restored(mixed.withColumn("n_chars", F.length("text").cast("long")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all tokens into sequences of 1024.

    A null or empty text is its end token alone; long texts are cut into whole sequences; repeated rows are packed each; an
    empty table gives no rows. The result has the operator's own columns and none of the documents' but doc_id.
    """
    prepared_session(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", pack),
]
#: Tokenizers and models have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's rows are written as Parquet and read again as the next one's documents."""
    docs = prepared_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), folder, f"{i}-{name}")
    return docs
