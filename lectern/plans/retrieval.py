"""Retrieval for a table of questions as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.urls import url_tag
from lectern.operators.classifier import predict_tag
from lectern.operators.hybrid import attach_documents, hybrid_merge
from lectern.operators.lexical import LexicalIndex, lexical_topk
from lectern.operators.rerank import rerank_by_tag, rerank_truncate
from lectern.operators.semantic import semantic_topk


@dataclass
class RetrievalConfig:
    num_chunks: int = 5
    use_lexical_search: bool = True
    lexical_search_k: int = 1
    use_reranking: bool = True
    rerank_threshold: float = 0.2
    rerank_k: int = 7
    tag_prefix: str = ""
    normalize_query: bool = False


def retrieve_contexts(
    questions: DataFrame,
    documents: DataFrame,
    vectors: DataFrame,
    lexical_index: LexicalIndex | None,
    predictions: DataFrame | None,
    config: RetrievalConfig,
) -> DataFrame:
    """``(qid, pos, doc_id, text, source)``: the ordered context of each question.

    ``questions``: qid, question, embedding. ``documents``: doc_id, text, source.
    ``vectors``: doc_id, embedding. ``predictions``: qid, predicted_tag.
    """
    found = semantic_topk(vectors, questions, config.num_chunks)
    results = found.select("qid", "pos", "doc_id")
    if config.use_lexical_search and lexical_index is not None:
        lexical = lexical_topk(lexical_index, questions, config.lexical_search_k, config.normalize_query)
        results = hybrid_merge(found, lexical, config.lexical_search_k).drop("origin")
    contexts = attach_documents(results, documents.select("doc_id", "text", "source"))
    if config.use_reranking and predictions is not None:
        tagged = contexts.withColumn("tag", url_tag(F.col("source"), config.tag_prefix))
        contexts = rerank_truncate(rerank_by_tag(tagged, predictions).drop("tag"), config.rerank_k)
    return contexts.select("qid", "pos", "doc_id", "text", "source")


def distinct_sources(contexts: DataFrame) -> DataFrame:
    """``(qid, sources)``: sorted, without duplicates."""
    return contexts.groupBy("qid").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def gather_contexts(questions: DataFrame, contexts: DataFrame, keys: tuple[str, ...] = ("qid",)) -> DataFrame:
    """One row per question: its columns and ``document_ids, texts, sources`` in rank order.

    A question's context is at most its ``k`` rows; one without any keeps empty lists.
    """
    lists = contexts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "doc_id", "text"))).alias("_c"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )
    none = F.array().cast("array<string>")
    asked = questions.select(*keys, "question")
    return asked.join(lists, list(keys), "left").select(
        *keys,
        "question",
        F.coalesce("_c.doc_id", none.cast("array<bigint>")).alias("document_ids"),
        F.coalesce("_c.text", none).alias("texts"),
        F.coalesce("sources", none).alias("sources"),
    )


def retrieve(questions, documents, vectors, lexical_index=None, predictions=None, config=None, tag_model=None) -> DataFrame:
    """One row per question with its ordered documents, their texts and its distinct sources.

    Without ``predictions`` a ``tag_model`` predicts each question's tag, by ``config.rerank_threshold``.
    """
    config = config or RetrievalConfig()
    if predictions is None and tag_model is not None and config.use_reranking:
        predictions = predict_tag(tag_model, questions.select("qid", "question"), config.rerank_threshold, text="question").drop("question")
    contexts = retrieve_contexts(questions, documents, vectors, lexical_index, predictions, config)
    return gather_contexts(questions, contexts)
