"""HTML files below a folder."""

from __future__ import annotations

import math
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.urls import path_to_uri

# Splits that one task reads: Spark makes a split of a few small files already.
SPLITS_TOGETHER = 32
# Most tasks that list folders; Spark makes one for each of up to 10,000 folders.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def scan_html_pages(spark: SparkSession, folder: str, domain: str | None = None, pattern: str = "*.html") -> DataFrame:
    """``(path, url, html)``: one row per file at any depth whose name fits ``pattern``.

    ``url`` is built from the part of the path after ``domain``; without one it is the path.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        # The files are listed here, not when rows are read.
        found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True)
    finally:
        spark.conf.set(LISTING_TASKS, before)
    files = few_tasks(found.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")))
    url = path_to_uri(F.col("path"), domain) if domain else F.col("path")
    return files.select("path", url.alias("url"), "html")


def few_tasks(files: DataFrame) -> DataFrame:
    """The same rows in tasks of many small files; some for each core at least."""
    splits = files.rdd.getNumPartitions()
    wanted = max(4 * files.sparkSession.sparkContext.defaultParallelism, math.ceil(splits / SPLITS_TOGETHER))
    return files.coalesce(wanted) if wanted < splits else files


def write_html_pages(pages: DataFrame, folder: str) -> int:
    """Write each page (``name, html``) to ``folder/<name>.html``; the number of files.

    ``name`` may have folders in it. Tasks write their files themselves, a task that
    runs again writes the same ones. Rows of one name become lines of one file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        made, n, out, current = set(), 0, None, None
        for batch in batches:
            for name, html in zip(batch["name"].to_pylist(), batch["html"].to_pylist()):
                if out is None or name != current:
                    if out is not None:
                        out.close()
                    path = f"{root}/{name}.html"
                    if (parent := posixpath.dirname(path)) not in made:
                        store.create_dir(parent)
                        made = {parent}
                    out, current, n = store.open_output_stream(path), name, n + 1
                out.write(f"{html or ''}\n".encode())
        if out is not None:
            out.close()
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    named = pages.select("name", "html").where("name is not null").repartition("name").sortWithinPartitions("name")
    return named.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
