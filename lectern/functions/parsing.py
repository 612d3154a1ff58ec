"""Parsing of model responses into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields a reference response must carry.
ANSWER_PATTERN = r'"answer"\s*:\s*"([^"]*)"'
SCORE_PATTERN = r'"score"\s*:\s*([0-9]+)'
REASONING_PATTERN = r'"reasoning"\s*:\s*"([^"]*)"'


def parse_reference_response(response: Column) -> Column:
    """Struct ``(answer, score, reasoning)``; empty strings and NULL unless all three occur."""
    complete = (
        response.rlike(ANSWER_PATTERN) & response.rlike(SCORE_PATTERN) & response.rlike(REASONING_PATTERN)
    )
    return F.struct(
        F.when(complete, F.regexp_extract(response, ANSWER_PATTERN, 1)).otherwise("").alias("answer"),
        F.when(complete, F.regexp_extract(response, SCORE_PATTERN, 1).try_cast("double")).alias("score"),
        F.when(complete, F.regexp_extract(response, REASONING_PATTERN, 1)).otherwise("").alias("reasoning"),
    )


def parse_judge_response(response: Column) -> Column:
    """Struct ``(score, reasoning, parse_error)`` from "score line, then reasoning".

    One line only means score 0. A first line that is no number gives a NULL
    score and sets ``parse_error``.
    """
    has_newline = F.instr(response, "\n") > 0
    number = F.trim(F.substring_index(response, "\n", 1)).try_cast("double")
    rest = F.substring(response, F.instr(response, "\n") + 1, F.length(response))
    return F.struct(
        F.when(has_newline, number).otherwise(F.lit(0.0)).alias("score"),
        F.when(has_newline, F.regexp_replace(rest, "^\n+", "")).otherwise("").alias("reasoning"),
        (has_newline & number.isNull()).alias("parse_error"),
    )


def split_qa_entries(df: DataFrame, response: str = "response") -> DataFrame:
    """One row per blank-line entry: ``entry_pos, question, answer, ok``."""
    kept = [c for c in df.columns if c != response]
    entries = df.select(*kept, F.posexplode(F.split(response, "\n\n")).alias("entry_pos", "entry"))
    lines = F.split("entry", "\n")
    well_formed = F.size(lines) == 2
    return entries.select(
        *kept,
        "entry_pos",
        "entry",
        well_formed.alias("ok"),
        F.when(well_formed, F.get(lines, F.lit(0))).alias("question"),
        F.when(well_formed, F.get(lines, F.lit(1))).alias("answer"),
    )


def parse_qa_pairs(df: DataFrame, response: str = "response") -> tuple[DataFrame, DataFrame]:
    """Question/answer rows, and the entries that are not exactly two lines."""
    entries = split_qa_entries(df, response)
    good = entries.where("ok").drop("ok", "entry")
    rejected = entries.where("not ok").drop("ok", "question", "answer")
    return good, rejected


def parse_questions(responses: DataFrame) -> DataFrame:
    """``source, question`` of responses that are one question each: the first line that is not blank."""
    lines = F.filter(F.split("response", "\n"), lambda line: F.trim(line) != "")
    first = F.trim(F.get(lines, F.lit(0)))
    return responses.select("source", first.alias("question")).where("question <> ''")
