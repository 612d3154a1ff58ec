"""Streams of questions, pages and feedback events.

Every micro-batch writes its own folder, named by the stream's run and the
batch, with overwrite: a batch that runs again after a failure replaces its
earlier output, and a stream with a fresh checkpoint is another run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lectern.functions.urls import strip_anchor
from lectern.session import matches, materialize, path_exists
from lectern.sources.records import answer_log_rows


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to; it lies beside the checkpoint's own files."""
    path = f"{checkpoint.rstrip('/')}/lectern-run"
    if not path_exists(spark, path):
        spark.range(1).select(F.lit(f"r{uuid.uuid4().hex}").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def write_batch(rows: DataFrame, path: str, batch_id: int, run: str = "r0", partition_by: str | None = None) -> None:
    """The batch's own folder, replaced if the batch runs again."""
    writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
    writer.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")


def stream_answer_queries(
    questions: DataFrame, answer: Callable[[DataFrame], DataFrame], log_path: str, checkpoint: str
) -> StreamingQuery:
    """Answer streamed questions (``qid, question``) and log one row per answer.

    ``answer`` maps a question table to ``question, document_ids, llm, answer``.
    """
    run = run_id(questions.sparkSession, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(answer_log_rows(answer(batch)), log_path, batch_id, run)

    return (
        questions.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Folders of one batch's chunks; a page's chunks are spread over them by position.
SOURCE_BUCKETS = 256
PAGES_SCHEMA = "page string, version bigint, stored_at timestamp, run string, batch_id bigint"


def stored_pages(spark: SparkSession, path: str) -> DataFrame:
    """All versions of pages that were stored, without their texts."""
    return spark.read.schema(PAGES_SCHEMA).option("basePath", f"{path}/pages").parquet(f"{path}/pages/run=*")


def latest_pages(stored: DataFrame) -> DataFrame:
    """``page, version, run, batch_id``: of each page the version that was stored last."""
    newest = F.max(F.struct("stored_at", "run", "batch_id", "version")).alias("newest")
    return stored.groupBy("page").agg(newest).select("page", "newest.version", "newest.run", "newest.batch_id")


def read_streamed_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of the latest version of every page, with all their columns and a unique ``id``."""
    latest = latest_pages(stored_pages(spark, path)).withColumnRenamed("page", "_page")
    chunks = spark.read.option("basePath", f"{path}/chunks").parquet(f"{path}/chunks/run=*").withColumn("run", F.col("run").cast("string"))
    return chunks.join(latest, ["run", "batch_id", "version", "_page"], "left_semi").drop("_page", "version", "run", "batch_id", "bucket")


def compact_streamed_index(spark: SparkSession, path: str, target: str) -> None:
    """Write the current index to a new folder of the same form, as one batch without superseded chunks."""
    latest = latest_pages(stored_pages(spark, path))
    chunks = spark.read.option("basePath", f"{path}/chunks").parquet(f"{path}/chunks/run=*").withColumn("run", F.col("run").cast("string"))
    current = chunks.join(latest.withColumnRenamed("page", "_page"), ["run", "batch_id", "version", "_page"], "left_semi")
    write_batch(current.drop("run", "batch_id"), f"{target}/chunks", 0, "compacted", partition_by="bucket")
    write_batch(latest.select("page", "version", F.current_timestamp().alias("stored_at")), f"{target}/pages", 0, "compacted")


# How the state is kept: in RocksDB, of which a micro-batch uploads its changes alone.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Keys of the state; each holds a map of the versions of its pages. A checkpoint keeps to this number.
STATE_KEYS = 1024


class NewVersions(StatefulProcessor):
    """Keeps the version of each page in a map and lets a page through when it changes.

    Pages share a key with others, as a call for each page costs more than its look-ups.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getMapState("versions", "page string", "version bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for page, version in zip(initialState["page"], initialState["version"]):
            self.versions.updateValue((page,), (int(version),))

    def handleInputRows(self, key, rows, timerValues):
        arrived = pd.concat(list(rows), ignore_index=True)
        # Of several versions in one micro-batch the greatest hash decides.
        arrived = arrived.sort_values("version", kind="stable").drop_duplicates("page", keep="last")
        changed = []
        for page, version in zip(arrived["page"], arrived["version"].tolist()):
            new = self.versions.getValue((page,)) != (version,)
            if new:
                self.versions.updateValue((page,), (version,))
            changed.append(new)
        yield arrived[changed]

    def close(self) -> None:
        pass


def stream_index_pages(
    pages: DataFrame,
    chunk: Callable[[DataFrame], DataFrame],
    embed: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    buckets: int = SOURCE_BUCKETS,
) -> StreamingQuery:
    """Chunk, embed and store streamed pages (``url, html``); read them with ``read_streamed_index``.

    The version of every page is keyed state beside the checkpoint (RocksDB), so a
    micro-batch costs what it brings, however much is stored. A page whose latest
    version is the same is left out. A changed page supersedes its former
    version, with all its chunks; a page that comes several times in one
    micro-batch counts once (the greatest hash of its content decides). A run with
    a fresh checkpoint takes the versions stored at ``path`` as its first state.
    ``chunk`` maps pages to ``source, section_pos, chunk_pos, text``; ``embed`` adds
    the vector, only to chunks of new versions.
    """
    spark = pages.sparkSession
    run = run_id(spark, checkpoint)
    stored = stored_pages(spark, path) if matches(spark, f"{path}/pages/run=*") else spark.createDataFrame([], PAGES_SCHEMA)
    named = pages.select(strip_anchor(F.col("url")).alias("page"), F.xxhash64("html").alias("version"), "url", "html")
    key = F.pmod(F.xxhash64("page"), F.lit(STATE_KEYS)).alias("key")
    known = latest_pages(stored).select(key, "page", "version").groupBy("key")
    fresh = (
        named.where("page is not null")
        .select(key, "*")
        .groupBy("key")
        .transformWithStateInPandas(NewVersions(), "key bigint, page string, version bigint, url string, html string", "Update", "None", initialState=known)
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Written once: the state is not gone through again for the second table.
        arrived = materialize(batch, "arrived-pages")
        rows = chunk(arrived.select("url", "html")).withColumn("_page", strip_anchor(F.col("source")))
        rows = rows.join(arrived.select(F.col("page").alias("_page"), "version"), "_page")
        numbered = rows.withColumn("id", F.xxhash64("source", "section_pos", "chunk_pos", "version")).withColumn(
            "bucket", F.pmod(F.xxhash64("_page", "section_pos", "chunk_pos"), F.lit(buckets)).cast("int")
        )
        # Vectors are made last, where chunks are written: they are never shuffled.
        write_batch(embed(numbered.repartition("bucket")), f"{path}/chunks", batch_id, run, partition_by="bucket")
        # Pages come last: a version without its row here was not finished and does not count.
        write_batch(arrived.select("page", "version", F.current_timestamp().alias("stored_at")), f"{path}/pages", batch_id, run)

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return (
            fresh.writeStream.foreachBatch(handle)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def feedback_rollup(events: DataFrame, window: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Counts and mean value per window and signal; works on streams and tables."""
    timed = events.withWatermark("ts", lateness) if events.isStreaming else events
    return (
        timed.groupBy(F.window("ts", window), "event_type")
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n", "mean_value")
    )
