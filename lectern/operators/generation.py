"""Batch calls of a model, one answer per row, with retries.

A model is called as ``model(messages, llm, max_tokens, temperature)``.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from lectern.operators.batches import pieces
from lectern.operators.ledger import Ledger, request_hash

Model = Callable[[list[dict], str | None, int | None, float], str]


def call_with_retries(model: Model, asked: tuple, max_retries: int, retry_interval: float):
    """``(answer, attempts, error)``; the answer is empty when every attempt failed."""
    error = None
    for attempt in range(1, max_retries + 2):
        try:
            return model(*asked), attempt, None
        except Exception as problem:  # whatever the caller's model raises
            error = f"{type(problem).__name__}: {problem}"
            if attempt <= max_retries:
                time.sleep(retry_interval)
    return "", max_retries + 1, error


def batch_generate(
    df: DataFrame,
    model_factory: Callable[[], Model],
    messages: str = "messages",
    out: str = "answer",
    llm: Column | None = None,
    max_tokens: Column | None = None,
    temperature: float = 0.0,
    max_retries: int = 1,
    retry_interval: float = 60.0,
    threads: int = 8,
    partitions: int | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """All columns but ``messages`` plus ``out``, ``attempts`` and ``error``.

    ``model_factory()`` runs once per task; a task has up to ``threads`` calls
    under way, so a model has to bear that. ``partitions`` sets the number of
    tasks. A row without messages is not asked for and has no answer.

    With a ``ledger`` (a folder that executors share) every answer is stored as
    soon as it is there, by what was asked. A task that runs again, or another
    job, takes it from there with 0 attempts; equal requests share an answer, and
    failed ones are asked again.
    """
    if partitions:
        df = df.repartition(partitions)
    kept = [f for f in df.schema.fields if f.name != messages]
    asked = df.select(
        *[F.col(f"`{f.name}`") for f in kept],
        F.col(messages).alias("_asked"),
        (F.lit(None) if llm is None else llm).cast("string").alias("_llm_name"),
        (F.lit(None) if max_tokens is None else max_tokens).cast("int").alias("_most"),
    )
    schema = StructType([*kept]).add(out, StringType()).add("attempts", IntegerType()).add("error", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_factory()
        answers_of = Ledger(ledger) if ledger else None

        def ask(call):
            if call[0] is None:
                return None, 0, None
            asked_for = (*call, temperature)
            request = request_hash(*asked_for) if answers_of else None
            known = answers_of.get(request) if answers_of else None
            if known is not None:
                return known, 0, None
            answer, attempts, error = call_with_retries(model, asked_for, max_retries, retry_interval)
            if answers_of and error is None:
                answers_of.put(request, answer, attempts)
            return answer, attempts, error

        with ThreadPoolExecutor(threads) as pool:
            for batch in (piece for whole in batches for piece in pieces(whole)):
                wanted = zip(*(batch.column(len(kept) + i).to_pylist() for i in range(3)))
                answers, attempts, errors = zip(*pool.map(ask, wanted))
                columns = [batch.column(i) for i in range(len(kept))]
                columns += [pa.array(answers, pa.string()), pa.array(attempts, pa.int32()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return asked.mapInArrow(run, schema)


# -- models that need no network; for tests, dry runs and as examples ----------


def _words(text: str) -> set[str]:
    return set(re.findall(r"\w+", text.lower()))


def extractive_model() -> Model:
    """Answers with the context sentence that shares most words with the query."""

    def answer(messages: list[dict], llm=None, max_tokens=None, temperature=0.0) -> str:
        prompt = messages[-1]["content"]
        query, _, context = prompt.partition(", context: ")
        try:
            context = " ".join(json.loads(context))
        except ValueError:  # cut by the budget
            pass
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+", context) if s.strip()]
        asked = _words(query)
        return max(sentences, key=lambda s: len(asked & _words(s)), default="")

    return answer


def reference_model() -> Model:
    """The extractive answer as a JSON record with a score and a reasoning."""
    extract = extractive_model()

    def answer(messages: list[dict], llm=None, max_tokens=None, temperature=0.0) -> str:
        text = extract(messages).replace('"', "'")
        return json.dumps({"answer": text, "score": 4 if text else 1, "reasoning": "taken from the context"}, ensure_ascii=False)

    return answer


def overlap_judge() -> Model:
    """Scores 1 to 5 by the words a generated answer shares with the reference."""

    def judge(messages: list[dict], llm=None, max_tokens=None, temperature=0.0) -> str:
        try:
            record = json.loads(messages[-1]["content"])
        except ValueError:
            return "1\nunreadable record"
        given, wanted = _words(record.get("generated_answer", "")), _words(record.get("reference_answer", ""))
        share = len(given & wanted) / max(1, len(wanted))
        return f"{1 + round(4 * share)}\n\n{len(given & wanted)} of {len(wanted)} reference words"

    return judge


def question_writer(n: int = 1) -> Callable[[], Model]:
    """Writes ``n`` question/answer pairs from the sentences of ``context: ...``."""

    def factory() -> Model:
        def write(messages: list[dict], llm=None, max_tokens=None, temperature=0.0) -> str:
            text = messages[-1]["content"].removeprefix("context: ")
            sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+", text) if s.strip()]
            return "\n\n".join(f"What is said about {s.split()[0]}?\n{' '.join(s.split())}" for s in sentences[:n])

        return write

    return factory
