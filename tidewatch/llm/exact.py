"""Operator 7: exact deduplication as a stateful stream.

Fingerprints (digest, row, id) arrive in micro-batches. The stream's keyed state, held
on disk by the RocksDB state store and never expired, keeps per digest the stable
identifier, the content locator of the row that stays, and the number of rows. Every
batch emits the keys it changed. Partial aggregation before the shuffle turns the copies
of a hot text into one row per task.

Hits are then checked on full bytes: texts are folded per digest to their least and
greatest. A digest with two different texts is split by text and streamed again.

Defined results: null counts as the empty text; a null id loses against any id; repeated
rows (same id and text) form one group and exactly one of them is kept; ties are broken by
the row's place in the written fingerprints; an empty table gives an empty result; further
columns are passed through by ``deduplicated`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import BLANK, new_folder, stored, table

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # A store is closed and its local files removed once its part of a batch is in the shared folder.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
FILES_PER_BATCH = 200


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def keyed_state(stream: DataFrame) -> DataFrame:
    """The stateful core: (digest, keep, group_size) of a stream or table of (digest, doc_id, row).

    ``keep`` is the stable identifier with the locator of its row. Without a watermark nothing expires.
    """
    return stream.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"))


def run_stream(spark: SparkSession, prints: DataFrame, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream all fingerprints under ``path`` through the keyed state; the last state of every digest.

    Batches are written under their number, so a batch that is repeated after a failure overwrites itself.
    """
    out, session = new_folder(spark, "dedup-changes"), spark.newSession()
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    stream = session.readStream.schema(prints.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    query = (
        keyed_state(stream).writeStream.outputMode("update").option("checkpointLocation", new_folder(spark, "dedup-state"))
        .foreachBatch(lambda changed, batch: changed.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
        .trigger(availableNow=True).start())
    query.awaitTermination()
    changes = spark.read.schema("digest string, keep struct<no_id:boolean,doc_id:bigint,row:bigint>, group_size bigint").parquet(out)
    # The count only grows, so a digest's greatest count is its last state.
    return changes.groupBy("digest").agg(F.max(F.struct("group_size", "keep")).alias("s")).select("digest", "s.group_size", "s.keep")


def exact_groups(docs: DataFrame, digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(doc_id, row, text_sha256, keep_id, group_size, kept) of every row, in groups of equal normalised texts."""
    spark = docs.sparkSession
    text = docs.select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("digest", digest(F.col("norm")))
    folded = text.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"), F.count(F.lit(1)).alias("n"))
    torn = stored(folded.filter((F.col("n") > 1) & (F.col("low") != F.col("high"))).select("digest"), "dedup-torn")
    if torn.count():  # different texts under one digest: name the texts apart by their order
        # Not expected of a full digest. Every text of a torn digest becomes its own key, whole.
        apart = text.join(torn.withColumn("torn", F.lit(True)), "digest", "left").withColumn(
            "digest", F.when(F.col("torn"), F.concat(F.col("digest"), F.lit(" "), F.col("norm"))).otherwise(F.col("digest")))
    else:
        apart = text
    path = new_folder(spark, "dedup-prints")
    sha = F.col("digest") if digest is sha256 and not torn.count() else sha256(F.col("norm"))
    apart.select("doc_id", "digest", sha.alias("text_sha256"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    prints = spark.read.parquet(path)
    groups = run_stream(spark, prints, path, files_per_batch)
    return prints.join(groups, "digest", "left").select(
        "doc_id", "row", "text_sha256", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Ids name documents here: of rows that repeat an id (or lack it) with equal normalised texts, one stays.
    """
    held = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_digest"))
    own = docs.withColumn("_row_digest", sha256(normalised(F.col("text"))))
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_row_digest") == F.col("_kept_digest"))
    return own.join(held, same, "left_semi").dropDuplicates(["doc_id", "_row_digest"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_stream_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

QUERIES = {"op7_stream_dedup": op7_stream_dedup}
ORACLES = {"op7_stream_dedup": _SQL}
