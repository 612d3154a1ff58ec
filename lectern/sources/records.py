"""Question, response, reference and evaluation files.

Result rows live in Parquet, partitioned by experiment, beside a table with one
row of config and scores per experiment. The nested ``{config, ..., results}``
form is read as it is and written in numbered pieces of bounded length, so that
no experiment has to fit into one row; piece 0 has config and scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schemas

# Result rows per nested record.
ROWS_PER_RECORD = 1000


def _question_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of question files with what is wrong with them: ``_line`` as it stands if it is no record."""
    read = spark.read.schema(f"{schema}, _line string").option("allowSingleQuotes", "true").option("columnNameOfCorruptRecord", "_line")
    lines = read.json(path)
    wrong = F.when(F.col("_line").isNotNull(), "no record").when(F.col("question").isNull(), "no question")
    return lines.withColumn("_wrong", wrong)


def scan_questions_jsonl(spark: SparkSession, path: str, schema: str = schemas.QUESTION) -> DataFrame:
    """One record per line; single-quoted records are read too.

    Lines that are no record, and records without a question, are left out;
    ``scan_rejected_lines`` has them.
    """
    return _question_lines(spark, path, schema).where(F.col("_wrong").isNull()).drop("_line", "_wrong")


def scan_rejected_lines(spark: SparkSession, path: str, schema: str = schemas.QUESTION) -> DataFrame:
    """``file, reason, line`` and the columns as far as they could be read: the lines that ``scan_questions_jsonl`` leaves out.

    ``line`` is null for a record without a question, which was read as such.
    """
    lines = _question_lines(spark, path, schema).where(F.col("_wrong").isNotNull())
    rest = [c for c in lines.columns if c not in ("_line", "_wrong")]
    return lines.select(F.input_file_name().alias("file"), F.col("_wrong").alias("reason"), F.col("_line").alias("line"), *rest)


def _experiment():
    """Pieces after the first have no config."""
    return F.coalesce(F.col("config.experiment_name"), F.col("experiment_name")).alias("experiment_name")


def _scan_nested(spark, path, schema, lines):
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).json(path)


def _explode_results(records: DataFrame, *kept) -> DataFrame:
    rows = records.select(*kept, F.posexplode("results").alias("_at", "_r"))
    names = [c for c in rows.select("_r.*").columns if c != "pos"]
    pos = F.coalesce("_r.pos", F.col("_at").cast("bigint")).alias("pos")
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], pos, *[F.col(f"_r.{n}").alias(n) for n in names])


def scan_responses_json(spark: SparkSession, path: str, num_samples: int | None = None, lines: bool = False) -> DataFrame:
    """Result rows of nested response files, in order ``pos``; ``lines`` for one record per line."""
    records = _scan_nested(spark, path, schemas.RESPONSES, lines)
    rows = _explode_results(records, _experiment())
    return rows if num_samples is None else rows.where(F.col("pos") < num_samples)


def scan_evaluations_dir(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``(experiment_name, evaluator, retrieval_score, quality_score)`` of every evaluation, one row each."""
    records = _scan_nested(spark, path, schemas.EVALUATION, lines).where(F.coalesce("piece", F.lit(0)) == 0)
    evaluator = F.col("config.evaluator").alias("evaluator")
    return records.select(_experiment(), evaluator, "retrieval_score", "quality_score")


def scan_evaluation_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Evaluated rows of every evaluation file."""
    records = _scan_nested(spark, path, schemas.EVALUATION, lines)
    return _explode_results(records, _experiment())


def _config_struct(configs: DataFrame):
    known = {part.split()[0]: part.split()[1] for part in schemas.CONFIG.split(", ")}
    return F.struct(
        *[(F.col(c).cast(t) if c in configs.columns else F.lit(None).cast(t)).alias(c) for c, t in known.items()]
    )


def write_results(rows: DataFrame, configs: DataFrame, path: str) -> None:
    """Rows partitioned by ``experiment_name`` in ``results/``, one row per experiment in ``config/``."""
    rows.write.mode("overwrite").partitionBy("experiment_name").parquet(f"{path}/results")
    configs.write.mode("overwrite").parquet(f"{path}/config")


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, configs)`` stored by ``write_results``."""
    return spark.read.parquet(f"{path}/results"), spark.read.parquet(f"{path}/config")


def write_nested(rows: DataFrame, configs: DataFrame, path: str, rows_per_record: int = ROWS_PER_RECORD) -> None:
    """Nested JSON records, one per line, of at most ``rows_per_record`` results each.

    ``configs`` has one row per experiment with its config columns and, for
    evaluations, its scores; they are in the record with ``piece`` 0. An
    experiment without rows has one record without results, rows of an unknown
    experiment have records without config.
    """
    scores = [c for c in ("retrieval_score", "quality_score") if c in configs.columns]
    heads = configs.select("experiment_name", F.lit(0).cast("bigint").alias("piece"), _config_struct(configs).alias("config"), *scores)
    fields = [c for c in rows.columns if c != "experiment_name"]
    records = (
        rows.groupBy("experiment_name", F.floor(F.col("pos") / rows_per_record).alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", *[f for f in fields if f != "pos"]))).alias("results"))
        .join(heads, ["experiment_name", "piece"], "full")
        .select("experiment_name", "piece", "config", *scores, "results")
    )
    records.write.mode("overwrite").json(path)


def write_responses(rows: DataFrame, configs: DataFrame, path: str, nested: bool = False) -> None:
    """Generated answers."""
    (write_nested if nested else write_results)(rows, configs, path)


def write_evaluation(rows: DataFrame, configs: DataFrame, path: str, nested: bool = False) -> None:
    """Evaluated answers; ``configs`` carries the scores."""
    (write_nested if nested else write_results)(rows, configs, path)


def write_references(rows: DataFrame, path: str) -> None:
    """Reference answers."""
    rows.write.mode("overwrite").json(path)


def read_references(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REFERENCE).json(path)


def write_qa_pairs(pairs: DataFrame, path: str) -> None:
    """Question/source pairs, one per line."""
    pairs.write.mode("overwrite").json(path)


def read_qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.QA_PAIR).json(path)


def answer_log_rows(answers: DataFrame) -> DataFrame:
    """Log columns of answered queries, with the time of logging."""
    return answers.select(
        F.current_timestamp().alias("time"), F.col("question").alias("query"), "document_ids", "llm", "answer"
    )


def append_answer_log(answers: DataFrame, path: str) -> None:
    """Append one row per answered query."""
    answer_log_rows(answers).write.mode("append").parquet(path)
