"""Pages to sections, blocks and element texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.html import block_texts, read_elements, strip_markup
from lectern.functions.urls import anchor_of, strip_anchor
from lectern.operators.batches import pieces
from lectern.operators.joins import broadcast_if_small
from lectern.session import materialize

# Pages parsed before their rows are handed on.
PAGES_AT_ONCE = 256

ELEMENTS_SCHEMA = "url string, pos int, tag string, element_id string, direct_text string, full_text string"
ELEMENTS = pa.schema([("url", pa.string()), ("pos", pa.int32()), *((c, pa.string()) for c in ("tag", "element_id", "direct_text", "full_text"))])


def read_page_elements(pages: DataFrame, section_tag: str = "section", only_sections: bool = False) -> DataFrame:
    """One row per element with an id.

    With ``only_sections`` the sections and their direct texts; else all
    elements with their full texts, and the page itself as ``pos`` 0.
    """

    def page_rows(url, html):
        elements, whole = read_elements(html or "", section_tag)
        if only_sections:
            return [(url, pos, tag, i, direct, None) for pos, tag, i, direct, _ in elements if tag == section_tag]
        return [(url, 0, "", None, None, whole), *[(url, pos, tag, i, None, full) for pos, tag, i, _, full in elements]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                for some in pieces(batch.slice(start, PAGES_AT_ONCE)):
                    rows = [row for url, html in zip(some["url"].to_pylist(), some["html"].to_pylist()) for row in page_rows(url, html)]
                    columns = zip(*rows) if rows else [()] * len(ELEMENTS)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ELEMENTS)], schema=ELEMENTS)

    return pages.select("url", "html").mapInArrow(read, ELEMENTS_SCHEMA)


def extract_sections(pages: DataFrame, section_tag: str = "section") -> DataFrame:
    """``(source, pos, text)`` for each section with an id; empty texts are kept."""
    sections = read_page_elements(pages, section_tag, only_sections=True)
    return filter_sections_with_id(sections, "element_id").select(
        F.concat("url", F.lit("#"), "element_id").alias("source"), "pos", F.col("direct_text").alias("text")
    )


def filter_sections_with_id(df: DataFrame, column: str = "section_id") -> DataFrame:
    """Sections that have a non-empty id."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def page_text(pages: DataFrame) -> DataFrame:
    """``(page_id, text)``: pages as plain text."""
    return pages.select("page_id", strip_markup(F.col("html")).alias("text"))


def page_blocks(pages: DataFrame, tag: str = "p") -> DataFrame:
    """``(page_id, url, pos, text)``: one row per paragraph block."""
    blocks = pages.select("page_id", "url", F.posexplode_outer(block_texts(F.col("html"), tag)).alias("pos", "text"))
    return blocks.where(F.col("pos").isNotNull())


def fetch_text(questions: DataFrame, pages: DataFrame, source: str = "source") -> DataFrame:
    """Adds ``source_text``: the anchored element's text, else the whole page's.

    Only pages that some question names are parsed, each once, and only the
    elements asked for leave the parser's stage.
    """
    asked = questions.withColumn("_url", strip_anchor(F.col(source))).withColumn("_anchor", anchor_of(F.col(source)))
    wanted = asked.select("_url", F.coalesce("_anchor", F.lit("")).alias("_anchor")).distinct()
    named = pages.join(broadcast_if_small(wanted.select(F.col("_url").alias("url")).distinct()), "url", "left_semi")
    elements = read_page_elements(named).select(
        F.col("url").alias("_url"), F.coalesce("element_id", F.lit("")).alias("_anchor"), "pos", "full_text"
    )
    # The page itself has no anchor; every question may fall back to it.
    keys = wanted.unionByName(wanted.select("_url", F.lit("").alias("_anchor"))).distinct()
    texts = elements.join(broadcast_if_small(keys), ["_url", "_anchor"], "left_semi")
    texts = materialize(texts.groupBy("_url", "_anchor").agg(F.min_by("full_text", "pos").alias("_text")), "texts")

    anchored = texts.where("_anchor <> ''").withColumnRenamed("_text", "_element_text")
    whole = texts.where("_anchor = ''").select("_url", F.col("_text").alias("_page_text"))
    joined = asked.join(anchored, ["_url", "_anchor"], "left")
    # Page texts only travel to the questions whose anchor was not found.
    found = joined.where("_element_text is not null").withColumnRenamed("_element_text", "source_text")
    rest = joined.where("_element_text is null").drop("_element_text").join(whole, "_url", "left")
    rest = rest.withColumnRenamed("_page_text", "source_text")
    return found.unionByName(rest).drop("_url", "_anchor")


def training_pairs(questions: DataFrame, pages: DataFrame) -> DataFrame:
    """``(question, source_text)`` pairs for training an encoder."""
    return fetch_text(questions, pages).select("question", "source_text")


def section_lengths(sections: DataFrame, text: str = "text", by: list[Column | str] | None = None) -> DataFrame:
    """Profile of section lengths: count, mean, median, 90th percentile and maximum in characters."""
    length = F.length(text)
    return sections.groupBy(*(by or [])).agg(
        F.count(length).alias("n_sections"),
        F.round(F.avg(length), 6).alias("mean_length"),
        F.percentile(length, 0.5).alias("median_length"),
        F.percentile(length, 0.9).alias("p90_length"),
        F.max(length).cast("bigint").alias("max_length"),
    )
