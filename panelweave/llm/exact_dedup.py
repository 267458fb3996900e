"""Exact deduplication through a stateful stream over text digests.

A file stream of fingerprints (digest, stable id, content locator) is aggregated by
digest in RocksDB state that never expires: per digest it keeps the number of rows, the
largest id, and the locator of the row that carries it. The state survives with its
checkpoint, so a later run continues with new files only (:func:`ingest`). Digest hits are
checked on full texts afterwards, the copies of a large group in shares of about ``SHARE``
rows; a digest that covers different texts is resolved by the texts themselves.

Texts are equal when identical after lower-casing A-Z; missing text is empty text. The
row with the largest ``doc_id`` stays, a missing id counts as smallest, and among equal
ids the row that lies first by locator. Repeated rows are rows of their own: exactly one
of them stays. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelweave.llm.rows import from_files, located, without
from panelweave.llm.text import ASCII_UPPER
from panelweave.sources.scratch import materialize, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "4",
    # Many small states: do not reserve disk for each one's logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Fingerprints taken into one micro-batch.
BATCH_BYTES = 4 << 30
FINGERPRINT = "digest binary, doc_id long, file string, place long"
#: Copies of one text that are checked together; larger groups are dealt to several tasks.
SHARE = 256


def normalised(text: Column | str) -> Column:
    """Text with A-Z in lower case; missing text is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def digest(text: Column | str) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


@contextmanager
def state_settings(spark: SparkSession):
    """The session settings under which the state is written and read."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ingest(spark: SparkSession, fingerprints: str, state: str) -> None:
    """Bring the state at ``state`` up to date with the fingerprint files at a path."""
    with state_settings(spark):
        stream = (
            spark.readStream.schema(FINGERPRINT)
            .option("maxBytesPerTrigger", BATCH_BYTES)
            .parquet(fingerprints)
        )
        seen = stream.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.min(_precedence()).alias("keeper")
        )
        query = (
            seen.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def _precedence() -> Column:
    """Smallest for the row that stays: largest id first, then the first place."""
    return F.struct(
        F.bitwise_not(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("rank"),
        F.col("file").alias("file"),
        F.col("place").alias("place"),
        F.col("doc_id").alias("doc_id"),
    )


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, group_size, keep_id, keep_file, keep_place`` of every digest ever seen."""
    with state_settings(spark):
        value = spark.read.format("statestore").load(state).select("key.*", "value.*")
        _, size, keeper = value.columns
        return _written_state(value, size, keeper)


def _written_state(value: DataFrame, size: str, keeper: str) -> DataFrame:
    wanted = value.select(
        "digest",
        F.col(size).alias("group_size"),
        F.col(f"{keeper}.doc_id").alias("keep_id"),
        F.col(f"{keeper}.file").alias("keep_file"),
        F.col(f"{keeper}.place").alias("keep_place"),
    )
    return materialize(wanted, "exact-groups")


def _resolved(rows: DataFrame) -> DataFrame:
    """Groups by full text, for rows of digests that cover different texts."""
    same = Window.partitionBy("digest", "whole")
    first = F.min(_precedence()).over(same)
    return rows.select(
        "digest", "doc_id", "file", "place",
        F.count(F.lit(1)).over(same).alias("group_size"),
        first["doc_id"].alias("keep_id"), first["file"].alias("keep_file"),
        first["place"].alias("keep_place"),
    )


def group_copies(docs: DataFrame, hashed=digest) -> DataFrame:
    """One row per input row: its place, its group and whether it stays.

    ``hashed`` turns a text column into its digest; another one serves to test
    digests that collide. Returns ``digest, doc_id, file, place, group_size, keep_id,
    kept``.
    """
    spark = docs.sparkSession
    rows = located(docs, "doc_id", "text")
    prints = scratch_path(spark, "exact-fingerprints")
    state = scratch_path(spark, "exact-state")
    rows.select(hashed("text").alias("digest"), "doc_id", "file", "place").write.parquet(prints)
    ingest(spark, prints, state)
    groups = read_state(spark, state)
    marked = spark.read.schema(FINGERPRINT).parquet(prints).join(groups, "digest")

    # Full texts of hits against the text of the row that stays.
    hits = groups.where("group_size > 1")
    copies = materialize(
        rows.select("doc_id", "file", "place", normalised("text").alias("whole"),
                    hashed("text").alias("digest"))
        .join(hits, "digest"),
        "exact-hits",
    )
    shares = F.ceil(F.col("group_size") / SHARE).cast("int")
    dealt = copies.select(
        "digest", "whole", F.pmod(F.xxhash64("file", "place"), shares).cast("int").alias("share")
    )
    keepers = copies.where("file = keep_file AND place = keep_place").select(
        "digest", F.col("whole").alias("keep_whole"),
        F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"),
    )
    unequal = materialize(
        dealt.join(keepers, ["digest", "share"])
        .where("whole <> keep_whole").select("digest").distinct(),
        "exact-unequal",
    )
    if not unequal.isEmpty():
        several = _resolved(copies.join(unequal, "digest", "left_semi"))
        marked = marked.join(unequal, "digest", "left_anti").unionByName(several)
    return marked.select(
        "digest", "doc_id", "file", "place", "group_size", "keep_id",
        F.expr("file = keep_file AND place = keep_place").alias("kept"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = from_files(docs)
    return without(docs, group_copies(docs).where("NOT kept"))
