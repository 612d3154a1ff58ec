"""Explicit schemas of the record files."""

QUESTION = "question string, source string"
QA_PAIR = "question string, source string, answer string"
ROUTING = "question string, target int, score double"
REFERENCE = "pos bigint, question string, source string, answer string, score double, reasoning string"

CONFIG = (
    "experiment_name string, chunk_size int, chunk_overlap int, num_chunks int, embedding_model_name string, "
    "use_lexical_search boolean, lexical_search_k int, use_reranking boolean, rerank_threshold double, rerank_k int, "
    "llm string, evaluator string, temperature double, max_context_length int, "
    "system_content string, assistant_content string, num_samples int"
)
RESULT = (
    "pos bigint, question string, sources array<string>, document_ids array<bigint>, answer string, llm string"
)
EVALUATED = (
    "pos bigint, question string, generated_answer string, reference_answer string, score double, "
    "reasoning string, sources array<string>"
)
RESPONSES = f"experiment_name string, piece bigint, config struct<{CONFIG}>, results array<struct<{RESULT}>>"
EVALUATION = (
    f"experiment_name string, piece bigint, config struct<{CONFIG}>, retrieval_score double, quality_score double, results array<struct<{EVALUATED}>>"
)
ANSWER_LOG = "time timestamp, query string, document_ids array<bigint>, llm string, answer string"
