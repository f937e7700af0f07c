"""Exact deduplication by a stateful stream.

Documents land as records of a digest of the normalised text, the stable identifier and a locator of the
content (file and identifier).  A Structured Streaming query keeps keyed state on disk (RocksDB), which
never expires: for each digest the smallest identifier, its locator and the number of copies.  Records are
combined before they are shuffled, so a text that a third of all rows share is one record a task.  Copies
found this way (hits) are then compared with the retained document in full, byte for byte; if any two texts
of a digest differ, the digests are widened and everything is decided again.

Texts are equal when they are identical after each run of blanks has become one space; null counts as empty.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plycask.llm.scratch import Scratch
from plycask.llm.words import collapse

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: One budget of native memory for all of an executor's state partitions.
_BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
_MEMORY_MB = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
#: Whether each state partition reserves disk ahead, some megabytes however few keys it has.
_RESERVE = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"

#: Most digests, of 32 bytes and an identifier, that are sent to all executors.
MAX_BROADCAST = 200_000


@contextmanager
def _settings(spark: SparkSession, **wanted: str):
    names = {"provider": _PROVIDER, "bounded": _BOUNDED, "memory": _MEMORY_MB, "reserve": _RESERVE}
    before = {names[k]: spark.conf.get(names[k], None) for k in wanted}
    for k, value in wanted.items():
        spark.conf.set(names[k], value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def digest_of(text: Column, digest_bytes: int = 32) -> Column:
    """The first bytes of the SHA-256 of the normalised text; beyond 32, its MD5 follows."""
    data = F.encode(collapse(text), "UTF-8")
    whole = F.unhex(F.sha2(data, 256))
    if digest_bytes > 32:
        return F.concat(whole, F.unhex(F.md5(data)))
    return F.substring(whole, 1, digest_bytes) if digest_bytes < 32 else whole


def update_state(spark: SparkSession, landing: str, schema, checkpoint: str, sink: str) -> None:
    """Runs the stream over what has landed since the checkpoint, and ends.

    Each micro-batch writes the changed digests under sink, in a folder of its own that a repeated
    batch replaces.  State lives in the checkpoint and its working copy on the executors' disks.
    """
    records = spark.readStream.schema(schema).parquet(landing)
    state = records.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.min_by("file", "doc_id").alias("keep_file"), F.count(F.lit(1)).alias("group_size"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    with _settings(spark, provider=_ROCKS, bounded="true", memory="128", reserve="false"):
        query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
        query.awaitTermination()


def _sent(rows: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """rows for a join with texts: to all executors where they are few, so that texts are not shuffled."""
    return F.broadcast(rows) if rows.count() <= most else rows


def decide(docs: DataFrame, scratch: Scratch, digest_bytes: int = 32) -> tuple[DataFrame, DataFrame, int]:
    """Tables of the landed records and of the final state (digest, keep_id, keep_file, group_size), and the bytes of a digest with which every copy was confirmed in full."""
    spark, name = docs.sparkSession, f"of{digest_bytes}"
    text = F.col("text")
    landed = scratch.save(docs.select("doc_id", digest_of(text, digest_bytes).alias("digest"), F.input_file_name().alias("file")), f"landing-{name}")
    sink = scratch.at(f"changes-{name}")
    update_state(spark, scratch.at(f"landing-{name}"), landed.schema, scratch.at(f"checkpoint-{name}"), sink)
    kinds = "digest binary, keep_id long, keep_file string, group_size long, batch int"
    if docs.sparkSession.read.parquet(scratch.at(f"landing-{name}")).isEmpty():
        state = spark.createDataFrame([], kinds).drop("batch")
    else:
        changes = spark.read.schema(kinds).parquet(sink)
        state = changes.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.max_by("keep_file", "batch").alias("keep_file"), F.max("group_size").alias("group_size"))
    state = scratch.save(state, f"state-{name}")

    hits = state.where("group_size > 1").select("digest", "keep_id")
    contents = docs.select("doc_id", collapse(text).alias("content"), digest_of(text, digest_bytes).alias("digest"))
    copies = scratch.save(contents.join(_sent(hits), "digest"), f"copies-{name}")
    retained = copies.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(F.min("content").alias("retained"))
    retained = scratch.save(retained, f"retained-{name}")
    differing = copies.join(retained, "digest", "left").where(~F.col("content").eqNullSafe(F.col("retained"))).limit(1)
    confirmed = differing.isEmpty()
    scratch.drop(f"copies-{name}")
    scratch.drop(f"retained-{name}")
    scratch.collect_garbage()
    if confirmed:
        return landed, state, digest_bytes
    if digest_bytes > 32:
        raise ValueError("two texts have the same SHA-256 and MD5")
    return decide(docs, scratch, 32 if digest_bytes < 32 else 48)


def groups(docs: DataFrame) -> DataFrame:
    """For every row, dropped ones too, the document that stays of those with an equal text.

    Columns: doc_id, keep_id (smallest doc_id of the group), group_size, kept (doc_id is keep_id),
    text_sha256 (lower-case hex, of the normalised text in UTF-8).  A null doc_id comes after all others
    and stays only where the group has none that is not null; rows that repeat the doc_id that stays are
    all kept here, as nothing tells them apart.  An empty table gives no row.  Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    landed, state, _ = decide(docs, scratch)
    return landed.join(state, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256")
    )


def add_batch(docs: DataFrame, folder: str) -> DataFrame:
    """The decisions on a new batch of documents, with all that were added to the folder before.

    folder, in storage that all executors share, keeps the landed records, the stream's checkpoint and the changes of its state
    from call to call and from session to session.  Columns are those of ``groups``, and keep_file.  docs must be read from
    Parquet files with doc_id and text that stay where they are: copies are compared in full with the retained
    document, which is fetched through its locator, and a ValueError tells of one that differs or is gone.  Documents
    of earlier batches whose group has got a smaller identifier since are not told of again.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-batch")
    landed = scratch.save(docs.select("doc_id", digest_of(F.col("text")).alias("digest"), F.input_file_name().alias("file")), "landed")
    landed.write.mode("append").parquet(f"{folder}/landing")
    update_state(spark, f"{folder}/landing", landed.schema, f"{folder}/checkpoint", f"{folder}/changes")
    changes = spark.read.schema("digest binary, keep_id long, keep_file string, group_size long, batch int").parquet(f"{folder}/changes")
    state = changes.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.max_by("keep_file", "batch").alias("keep_file"), F.max("group_size").alias("group_size"))
    decided = scratch.save(landed.join(state, "digest"), "decided")
    hits = scratch.save(decided.where("group_size > 1").select("digest", "keep_id", "keep_file").distinct(), "hits")
    files = [row.keep_file for row in hits.select("keep_file").distinct().collect()]  # names of files, not of documents
    if files:
        if not all(files):
            raise ValueError("documents without a file cannot be fetched again")
        wanted = hits.withColumnRenamed("keep_id", "doc_id")
        there = spark.read.parquet(*files).select("doc_id", collapse(F.col("text")).alias("retained"), F.input_file_name().alias("keep_file"))
        there = there.join(_sent(wanted), (there.doc_id.eqNullSafe(wanted.doc_id)) & (there.keep_file == wanted.keep_file)).select("digest", "retained")
        # A file may hold the identifier more than once; the document is the one of the digest.
        retained = there.where(digest_of(F.col("retained")) == F.col("digest")).groupBy("digest").agg(F.min("retained").alias("retained"))
        contents = docs.select(digest_of(F.col("text")).alias("digest"), collapse(F.col("text")).alias("content")).join(_sent(hits.select("digest")), "digest", "left_semi")
        if not contents.join(retained, "digest", "left").where(~F.col("content").eqNullSafe(F.col("retained"))).isEmpty():
            raise ValueError("a document differs from the retained one of the same digest, or that one is gone")
    return decided.select("doc_id", "keep_id", "keep_file", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """One row of each group of equal texts, with the columns of docs: the one with the smallest doc_id."""
    scratch = Scratch(docs.sparkSession, "exact")
    _, state, width = decide(docs, scratch, digest_bytes)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    at = dict(zip(docs.columns, names, strict=True))
    keyed = own.withColumn("digest", digest_of(F.col(at["text"]), width))
    kept = keyed.join(state.select("digest", "keep_id"), "digest").where(F.col(at["doc_id"]).eqNullSafe(F.col("keep_id"))).dropDuplicates(["digest"])
    return kept.select(*(F.col(name).alias(own_name) for name, own_name in zip(names, docs.columns, strict=True)))
