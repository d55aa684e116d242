"""The queries of this subpackage's operators, with their production parameters, and SQL for those that have it."""

from __future__ import annotations

import secrets
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.llm import chosenpath, curriculum, feistel, fm, imatch, infill, merkle, multiindex, packing, records, sharding, trigrams, warc
from specfold.llm.common import prepared_session, work_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.plan(table(spark, sf_dir, "documents"))
    narrow = rows.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("long").alias("n_copies"), F.get("copies", F.lit(0))["position"].alias("position"))
    return narrow.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    records = warc.read(spark, folder)
    return records.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"))


def pii_key(spark: SparkSession) -> bytes:
    """The key that spark.specfold.pii.key or spark.specfold.pii.secret names; where none is set, one drawn at random for this session and kept as the latter, a name that Spark leaves out of logs and pages."""
    key = spark.conf.get("spark.specfold.pii.key", None) or spark.conf.get("spark.specfold.pii.secret", None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set("spark.specfold.pii.secret", key)
    return key.encode()


def listed(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = feistel.pseudonymize(table(spark, sf_dir, "documents"), pii_key(spark))
    return done.select("doc_id", "text", F.size("spans").cast("long").alias("n_values"), F.array_join(F.transform("spans", listed), ",").alias("spans"))


def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark)
    records.write(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    return records.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


#: From this score on a document counts as good.
GOOD = 0.3


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = fm.score(docs, fm.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", fm.held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in trigrams.BASE]
    found = trigrams.scan(table(spark, sf_dir, "documents"))
    own = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    joined = lambda spans: F.array_join(F.transform(spans, listed), ",")
    return found.select(
        "doc_id",
        *[F.size(own([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(own(base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.join(table(spark, sf_dir, "documents"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.arrange(table(spark, sf_dir, "documents"))
    chars = lambda part: F.char_length(part).cast("long").alias(f"{part}_chars")
    back = infill.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", chars("prefix"), chars("middle"), F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark)
    sharding.write(table(spark, sf_dir, "documents"), folder)
    text = F.coalesce(F.col("record.text"), F.lit("")).cast("binary")
    rows = sharding.read(spark, folder).select(F.col("record.doc_id").alias("doc_id"), text.alias("text"), "shard", "slot")
    return rows.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf and its proof; documents whose doc_id has a CRC-32 divisible by 3 are proved with their text in lower case."""
    folder = work_dir(spark)
    tampered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, tampered).otherwise(F.col("text"))
    seen = merkle.digest([shown if c == "text" else F.col(c) for c in merkle.COLUMNS])
    merkle.write(table(spark, sf_dir, "documents"), folder, beside={"seen": seen})
    rows = merkle.proofs(spark, folder)
    rows = rows.select(F.col("doc").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), merkle.folded(F.col("path"), F.col("beside.seen")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_imatch": op2_imatch,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_embeddings": op5_embeddings,
    "op6_pii": op6_pii,
    "op7_records": op7_records,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_jaccard": op10_jaccard,
    "op11_infill": op11_infill,
    "op12_sharding": op12_sharding,
    "op13_manifest": op13_manifest,
}
ORACLES: dict[str, str] = {"op2_imatch": imatch.ORACLE, "op3_mixing": curriculum.ORACLE, "op4_warc": warc.ORACLE, "op5_embeddings": multiindex.ORACLE, "op9_secrets": trigrams.ORACLE, "op10_jaccard": chosenpath.ORACLE, "op11_infill": infill.ORACLE, "op12_sharding": sharding.ORACLE, "op13_manifest": merkle.ORACLE}
