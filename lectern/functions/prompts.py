"""Prompt, message and reply expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import token_count, trim_to_budget

# Fixed value: length of the bot mention that opens a chat event's text.
MENTION_LENGTH = 15


def context_budget(max_context: Column, fixed_prompt: Column, reserve_output: bool = True, tokens=token_count) -> Column:
    """Tokens left for the user prompt: half the context (or all) less the fixed prompt, as ``tokens`` counts it."""
    share = F.floor(max_context * F.lit(0.5)) if reserve_output else max_context
    return (share - tokens(fixed_prompt)).cast("bigint")


def output_cap(max_context: Column) -> Column:
    """Tokens the model may sample: the other half of the context."""
    return F.floor(max_context * F.lit(0.5)).cast("bigint")


def user_prompt(question: Column, texts: Column, budget: Column | int | None = None) -> Column:
    """``query: ..., context: [...]`` with the context as a JSON list, cut to the budget."""
    prompt = F.concat(F.lit("query: "), question, F.lit(", context: "), F.to_json(texts))
    return prompt if budget is None else trim_to_budget(prompt, budget)


def messages(system: Column, assistant: Column, user: Column) -> Column:
    """Ordered role/content list; empty contents are left out."""
    parts = F.array(
        *[
            F.struct(F.lit(role).alias("role"), content.alias("content"))
            for role, content in (("system", system), ("assistant", assistant), ("user", user))
        ]
    )
    return F.filter(parts, lambda m: m["content"] != "")


def judge_prompt(
    question: Column, generated: Column, reference: Column, budget: Column | int | None = None
) -> Column:
    """The three judged texts as one JSON record, cut to the budget."""
    record = F.to_json(
        F.struct(
            question.alias("question"),
            generated.alias("generated_answer"),
            reference.alias("reference_answer"),
        )
    )
    return record if budget is None else trim_to_budget(record, budget)


def mention_query(text: Column) -> Column:
    """The question in a mention event: the text after the bot's user id."""
    return F.substring(text, F.lit(MENTION_LENGTH + 1), F.length(text))


def mention_thread(thread_ts: Column, ts: Column) -> Column:
    """The thread to answer in: its own, else the message itself."""
    return F.coalesce(F.nullif(thread_ts, F.lit("")), ts)


def chat_reply(answer: Column, sources: Column) -> Column:
    """Answer, then one source per line."""
    return F.concat(answer, F.lit("\n"), F.array_join(sources, "\n"))


def streamed_reply(answer: Column, sources: Column) -> Column:
    """Answer, then a bullet list of sources when there are any."""
    bullets = F.array_join(F.transform(sources, lambda s: F.concat(F.lit("* "), s, F.lit("\n"))), "")
    return F.when(
        F.size(sources) > 0, F.concat(answer, F.lit("\n\n**Sources:**\n"), bullets)
    ).otherwise(answer)
