"""Pages to an embedded, numbered chunk table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.operators.chunking import chunk_sections
from lectern.operators.embedding import HashedWords, embed_chunks
from lectern.operators.ranking import assign_chunk_id
from lectern.operators.sections import extract_sections
from lectern.session import materialize


def section_chunks(pages: DataFrame, chunk_size: int = 700, chunk_overlap: int = 50) -> DataFrame:
    """``(source, section_pos, chunk_pos, text)``."""
    sections = extract_sections(pages).withColumnRenamed("pos", "section_pos")
    return chunk_sections(sections, chunk_size, chunk_overlap)


def build_index(pages: DataFrame, chunk_size: int = 700, chunk_overlap: int = 50, encoder_factory=None) -> DataFrame:
    """``(id, text, source, embedding)`` of all sections of all pages.

    The chunks are written once before they are numbered, as numbering reads
    them twice and parsing pages is the costly part.
    """
    chunks = materialize(section_chunks(pages, chunk_size, chunk_overlap), "chunks")
    numbered = assign_chunk_id(chunks, ["source", "section_pos", "chunk_pos"])
    rows = numbered.withColumnRenamed("chunk_id", "id").select("id", "text", "source")
    return embed_chunks(rows, encoder_factory or HashedWords())
