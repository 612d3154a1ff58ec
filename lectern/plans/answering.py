"""Answers for a table of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.catalogue import context_length
from lectern.functions.parsing import parse_qa_pairs, parse_questions, parse_reference_response
from lectern.functions.prompts import context_budget, messages, output_cap, user_prompt
from lectern.functions.text import token_count, trim_to_budget
from lectern.operators.conversations import conversation_messages, route_conversations
from lectern.operators.evaluation import filter_nonempty_response
from lectern.operators.generation import batch_generate, question_writer, reference_model
from lectern.operators.sections import fetch_text
from lectern.session import materialize


def with_messages(rows: DataFrame, prompt, max_context: Column | int, system: str = "", assistant: str = "", tokens=token_count) -> DataFrame:
    """Adds ``messages`` with the prompt cut to half the model's context."""
    longest = max_context if isinstance(max_context, Column) else F.lit(max_context)
    budget = context_budget(longest, F.lit(system + assistant), tokens=tokens)
    return rows.withColumn("messages", messages(F.lit(system), F.lit(assistant), trim_to_budget(prompt, budget)))


def answer_batch(
    retrieved: DataFrame,
    model_factory,
    llm: str | Column,
    max_context: int | None = None,
    system: str = "",
    assistant: str = "",
    tokens=token_count,
    **calls,
) -> DataFrame:
    """``qid, question, sources, document_ids, answer, llm, attempts, error`` from ``retrieve``'s rows.

    ``llm`` is one model or a column that names each row's. Prompt and answer have half of the
    model's context each, by the catalogue unless ``max_context`` says otherwise.
    """
    named = retrieved.withColumn("llm", F.lit(llm) if isinstance(llm, str) else llm)
    context = context_length(F.col("llm")) if max_context is None else F.lit(max_context)
    prompt = user_prompt(F.col("question"), F.col("texts"))
    ready = with_messages(named, prompt, context, system, assistant, tokens)
    return batch_generate(ready.drop("texts"), model_factory, llm=F.col("llm"), max_tokens=output_cap(context), **calls)


def answer_routed(retrieved: DataFrame, router: Callable[[DataFrame], DataFrame], model_factory, **answering) -> DataFrame:
    """``answer_batch`` with the model that ``router`` puts into the column ``llm`` of each question."""
    return answer_batch(router(retrieved), model_factory, F.col("llm"), **answering)


def answer_conversations(
    turns: DataFrame, answer_queries: Callable[[DataFrame], DataFrame], model_factory, open_model: str, **calls
) -> DataFrame:
    """``conv_id, question, sources, document_ids, answer, llm`` for every conversation.

    A single message is answered by ``answer_queries`` (``qid, question`` to
    ``qid, sources, document_ids, answer, llm``); a longer conversation by the
    open model from all its messages, without sources.
    """
    routed = route_conversations(turns, open_model)
    queries = routed.where("use_retrieval").select(F.col("conv_id").alias("qid"), F.col("query").alias("question"))
    single = answer_queries(queries).select(F.col("qid").alias("conv_id"), "question", "sources", "document_ids", "answer", "llm")
    longer = routed.where("not use_retrieval").select("conv_id", "llm").join(conversation_messages(turns), "conv_id")
    last = F.element_at("messages", -1)["content"]
    asked = longer.withColumns(
        {"question": last, "sources": F.array().cast("array<string>"), "document_ids": F.array().cast("array<bigint>")}
    )
    cap = output_cap(context_length(F.col("llm")))
    answered = batch_generate(asked, model_factory, llm=F.col("llm"), max_tokens=cap, **calls)
    return single.unionByName(answered.select(*single.columns))


def answer_with_given_context(
    questions: DataFrame, pages: DataFrame, model_factory=reference_model, max_context: int = 4096, system: str = "", **calls
) -> DataFrame:
    """Reference answers ``(..., answer, score, reasoning)`` from each question's own source text."""
    texts = fetch_text(questions, pages)
    context = F.coalesce("source_text", F.lit(""))
    prompt = F.concat(F.lit("query: "), F.col("question"), F.lit(", context: "), context)
    ready = with_messages(texts, prompt, max_context, system)
    cap = output_cap(F.lit(max_context))
    answered = batch_generate(ready.drop("source_text"), model_factory, out="response", max_tokens=cap, **calls)
    return answered.select(*questions.columns, F.inline(F.array(parse_reference_response(F.col("response")))))


def _asked_of_chunks(chunks: DataFrame, model_factory, max_context: int, system: str, calls: dict) -> DataFrame:
    """Responses to each chunk, written once: they are read more than once and calls cost."""
    ready = with_messages(chunks, F.concat(F.lit("context: "), F.col("text")), max_context, system)
    cap = output_cap(F.lit(max_context))
    answered = batch_generate(ready.drop("text"), model_factory, out="response", max_tokens=cap, **calls)
    return materialize(filter_nonempty_response(answered.drop("attempts", "error")), "responses")


def generate_qa_per_chunk(
    chunks: DataFrame, model_factory=None, max_context: int = 4096, system: str = "", **calls
) -> tuple[DataFrame, DataFrame]:
    """Question/answer pairs per chunk, and the entries that could not be read."""
    return parse_qa_pairs(_asked_of_chunks(chunks, model_factory or question_writer(1), max_context, system, calls))


def generate_question_per_section(sections: DataFrame, model_factory, max_context: int = 4096, system: str = "", **calls) -> DataFrame:
    """``source, question``: the one question a model writes for each section."""
    return parse_questions(_asked_of_chunks(sections, model_factory, max_context, system, calls))
