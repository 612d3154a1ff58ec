"""Judging answers and comparing experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.parsing import parse_judge_response
from lectern.functions.prompts import judge_prompt, messages, output_cap
from lectern.functions.text import token_count
from lectern.operators.chunking import chunk_sections
from lectern.operators.classifier import predict_tag
from lectern.operators.embedding import HashedWords, embed_chunks, embed_queries
from lectern.operators.evaluation import join_refs_generated, quality_score, retrieval_score
from lectern.operators.generation import batch_generate, overlap_judge
from lectern.operators.lexical import build_lexical_index
from lectern.operators.ranking import assign_chunk_id
from lectern.plans.answering import answer_batch
from lectern.plans.retrieval import RetrievalConfig, gather_contexts, retrieve_contexts
from lectern.session import materialize


def judge_answers(
    references: DataFrame,
    generated: DataFrame,
    judge_factory=overlap_judge,
    max_context: int = 8192,
    system: str = "",
    **calls,
) -> DataFrame:
    """References and generated answers of the same ``pos`` with the judge's ``score`` and ``reasoning``.

    ``references``: pos, question, source, answer. ``generated``: pos, question,
    answer, sources (and any others). Rows without a partner and pairs of two
    questions stay with ``same_question`` false: they are not judged, have no
    score and count as left out.
    """
    left = references.select("pos", "question", "source", F.col("answer").alias("reference_answer"))
    right = generated.withColumnRenamed("answer", "generated_answer").drop("attempts", "error")
    pairs = join_refs_generated(left, right)
    budget = F.lit(max_context) - token_count(F.lit(system))
    prompt = judge_prompt(F.col("question"), F.col("generated_answer"), F.col("reference_answer"), budget)
    asked = F.when(F.col("same_question"), messages(F.lit(system), F.lit(""), prompt))
    cap = output_cap(F.lit(max_context))
    judged = batch_generate(pairs.withColumn("messages", asked), judge_factory, out="_response", max_tokens=cap, **calls)
    parsed = parse_judge_response(F.col("_response"))
    return (
        judged.withColumn("_parsed", parsed)
        .select(*[c for c in pairs.columns], "_parsed.*", (F.col("_response") == "").alias("call_failed"))
        .withColumns({c: F.when(F.col("same_question"), F.col(c)) for c in ("score", "reasoning")})
        .withColumns({c: F.coalesce(F.col("same_question") & F.col(c), F.lit(False)) for c in ("parse_error", "call_failed")})
    )


def evaluation_scores(judged: DataFrame, by: str = "experiment_name") -> DataFrame:
    """Retrieval and quality score per experiment, with the rows that did not count.

    ``judged`` should be a written table: it is read twice. Rows that could not
    be paired count as left out alone.
    """
    return quality_score(judged, [by]).join(retrieval_score(judged.where("same_question"), [by]), by, "left")


def run_experiments(
    contexts: DataFrame,
    questions: DataFrame,
    references: DataFrame,
    configs: list[dict],
    model_factory,
    judge_factory=overlap_judge,
    **calls,
) -> tuple[DataFrame, DataFrame]:
    """Answer and judge under every config; returns ``(scores, judged rows)``.

    ``contexts`` is ranked once, down to the longest ``num_chunks``; each config
    (``experiment_name, num_chunks, llm``) takes its first rows. ``references``
    has ``qid`` beside its columns.
    """
    settings = F.array(
        *[
            F.struct(
                F.lit(c["experiment_name"]).alias("experiment_name"),
                F.lit(c["num_chunks"]).alias("num_chunks"),
                F.lit(c["llm"]).alias("llm"),
            )
            for c in configs
        ]
    )

    def for_each_config(df: DataFrame) -> DataFrame:
        return df.select("*", F.inline(settings))

    keys = ("experiment_name", "qid", "llm")
    cut = for_each_config(contexts).where(F.col("pos") < F.col("num_chunks"))
    retrieved = gather_contexts(for_each_config(questions), cut, keys)
    answered = materialize(answer_batch(retrieved, model_factory, F.col("llm"), **calls), "answered")
    generated = answered.withColumn("pos", F.struct("experiment_name", "qid"))
    wanted = for_each_config(references).withColumn("pos", F.struct("experiment_name", "qid"))
    judged = judge_answers(wanted, generated, judge_factory, **calls)
    judged = judged.withColumns({c: F.col(f"pos.{c}") for c in ("experiment_name", "qid")}).drop("pos")
    judged = materialize(judged, "judged")
    return evaluation_scores(judged), judged


# Settings of an experiment and what holds where a config does not name one.
DEFAULTS = {
    "llm": None,
    "num_chunks": 5,
    "chunk_size": 700,
    "chunk_overlap": 50,
    "encoder": None,
    "use_lexical_search": False,
    "lexical_search_k": 1,
    "use_reranking": False,
    "rerank_threshold": 0.2,
    "rerank_k": 7,
}
INDEX_SETTINGS = ("chunk_size", "chunk_overlap", "encoder")
RANKING_SETTINGS = ("use_lexical_search", "lexical_search_k", "use_reranking", "rerank_threshold", "rerank_k")


def _distinct_settings(configs: list[dict], names: tuple[str, ...]) -> dict[tuple, list[dict]]:
    groups: dict[tuple, list[dict]] = {}
    for config in configs:
        groups.setdefault(tuple(config[n] for n in names), []).append(config)
    return groups


def run_experiment_grid(
    sections: DataFrame,
    questions: DataFrame,
    references: DataFrame,
    configs: list[dict],
    model_factory,
    judge_factory=overlap_judge,
    encoders: dict | None = None,
    tag_model=None,
    tag_prefix: str = "",
    **calls,
) -> tuple[DataFrame, DataFrame]:
    """Answer and judge under every config, over all of its settings; returns ``(scores, judged rows)``.

    ``sections``: source, text. Each config names its experiment and any of
    DEFAULTS; ``encoder`` is a key of ``encoders``. An index is built once for each
    chunk size and encoder, a ranking made once for each way of ranking: configs
    that only differ in the model share it, and without lexical search and
    reranking those of other ``num_chunks`` do too.
    """
    encoders = {None: HashedWords(), **(encoders or {})}
    full = [DEFAULTS | c for c in configs]
    parts = []
    for (size, overlap, encoder), own in _distinct_settings(full, INDEX_SETTINGS).items():
        chunks = materialize(chunk_sections(sections.select("source", "text"), size, overlap), "chunks")
        numbered = assign_chunk_id(chunks, ["source", "chunk_pos", "text"]).withColumnRenamed("chunk_id", "doc_id")
        index = materialize(embed_chunks(numbered.select("doc_id", "text", "source"), encoders[encoder]), "index")
        asked = embed_queries(questions.select("qid", "question"), encoders[encoder])
        lexical = build_lexical_index(index) if any(c["use_lexical_search"] for c in own) else None
        for config in own:
            plain = not (config["use_lexical_search"] or config["use_reranking"])
            config["_chunks"] = None if plain else config["num_chunks"]
        for _, alike in _distinct_settings(own, (*RANKING_SETTINGS, "_chunks")).items():
            first, most = alike[0], max(c["num_chunks"] for c in alike)
            ranking = RetrievalConfig(num_chunks=most, tag_prefix=tag_prefix, **{n: first[n] for n in RANKING_SETTINGS})
            tags = None
            if first["use_reranking"] and tag_model is not None:
                tags = predict_tag(tag_model, asked.select("qid", "question"), first["rerank_threshold"], text="question").drop("question")
            ranked = materialize(retrieve_contexts(asked, index, index, lexical, tags, ranking), "contexts")
            # What lexical search adds and reranking leaves belongs to the context, so nothing more is cut.
            cuts = [c | {"num_chunks": c["num_chunks"] if first["_chunks"] is None else 1 << 30} for c in alike]
            parts.append(run_experiments(ranked, questions, references, cuts, model_factory, judge_factory, **calls))
    scores, judged = parts[0]
    for more_scores, more_judged in parts[1:]:
        scores, judged = scores.unionByName(more_scores), judged.unionByName(more_judged)
    return scores, judged
