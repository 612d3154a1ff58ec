"""Tag classifier and model router as Spark ML pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import preprocess_text
from lectern.operators.rerank import OTHER, threshold_label
from lectern.session import materialize

# Coefficients of a class. Every word counts, in the place that its hash tells; the driver and each task hold
# as many numbers, however many words and labelled rows there are.
WORD_PLACES = 1 << 17
# Fixed value: a word has two or more word characters.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _tokenizer() -> RegexTokenizer:
    return RegexTokenizer(inputCol="clean", outputCol="words", pattern=WORD_PATTERN, gaps=False, toLowercase=True)


def _logistic(n_rows: int, max_iter: int) -> LogisticRegression:
    """Multinomial with an L2 penalty of one over the number of rows on unscaled features."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        family="multinomial",
        regParam=1.0 / max(1, n_rows),
        standardization=False,
        maxIter=max_iter,
        # One step more than usual, so that few sums reach the driver from many tasks.
        aggregationDepth=3,
    )


def _counter(out: str, places: int) -> HashingTF:
    return HashingTF(inputCol="words", outputCol=out, numFeatures=places)


def train_tag_classifier(
    examples: DataFrame, text: str = "text", tag: str = "tag", max_iter: int = 100, places: int = WORD_PLACES
) -> PipelineModel:
    """Clean-up, smoothed TF-IDF of unit length over all words, logistic regression on all rows."""
    clean = examples.select(preprocess_text(F.col(text)).alias("clean"), F.col(tag).alias("tag"))
    words = Pipeline(
        stages=[
            StringIndexer(inputCol="tag", outputCol="label", stringOrderType="alphabetAsc"),
            _tokenizer(),
            _counter("counts", places),
        ]
    ).fit(clean)
    counted = materialize(words.transform(clean).select("counts", "label"), "counts")
    idf = IDF(inputCol="counts", outputCol="_idf").fit(counted).idf
    # The weight wanted is the library's idf plus one.
    weigh = ElementwiseProduct(inputCol="counts", outputCol="weighted", scalingVec=Vectors.dense(idf.toArray() + 1.0))
    scale = Normalizer(inputCol="weighted", outputCol="features", p=2.0)
    featured = scale.transform(weigh.transform(counted)).select("features", "label")
    fitted = _logistic(counted.count(), max_iter).fit(featured)
    return PipelineModel([words.stages[0], words.stages[1], words.stages[2], weigh, scale, fitted])


def train_router(examples: DataFrame, text: str = "question", target: str = "target", max_iter: int = 100, places: int = WORD_PLACES) -> PipelineModel:
    """Counts of all words and logistic regression on a 0/1 target, on all rows."""
    clean = examples.select(F.col(text).alias("clean"), F.col(target).cast("double").alias("label"))
    words = PipelineModel([_tokenizer(), _counter("features", places)])
    counted = materialize(words.transform(clean).select("features", "label"), "counts")
    return PipelineModel([*words.stages, _logistic(counted.count(), max_iter).fit(counted)])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def labels_of(model: PipelineModel) -> list[str]:
    """Class names by class number."""
    return list(model.stages[0].labels)


def predict_probabilities(model: PipelineModel, texts: DataFrame, text: str = "text") -> DataFrame:
    """All columns plus ``labels`` and ``probabilities`` in the same order."""
    names = labels_of(model)
    ready = texts.withColumn("clean", preprocess_text(F.col(text)))
    scored = PipelineModel(model.stages[1:]).transform(ready)
    probabilities = F.slice(vector_to_array("probability"), 1, len(names))
    # Made by a generator, as filters on them (or on a label told by them) move below any other column and
    # would run clean-up and model again for each of their mentions.
    return scored.select(
        *[F.col(c) for c in texts.columns],
        F.array(*[F.lit(n) for n in names]).alias("labels"),
        F.explode_outer(F.array(probabilities)).alias("probabilities"),
    )


def predict_tag(model: PipelineModel, texts: DataFrame, threshold: float = 0.2, other: str = OTHER, text: str = "text") -> DataFrame:
    """All columns plus ``predicted_tag``."""
    scored = predict_probabilities(model, texts, text)
    label = threshold_label(F.col("labels"), F.col("probabilities"), threshold, other)
    return scored.withColumn("predicted_tag", label).drop("labels", "probabilities")


def predict_proba_ranked(model: PipelineModel, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, rank, label, probability)``, most probable first."""
    scored = predict_probabilities(model, texts.select(key, text), text)
    pairs = scored.select(key, F.inline(F.arrays_zip("labels", "probabilities")))
    order = Window.partitionBy(key).orderBy(F.col("probabilities").desc(), "labels")
    return pairs.select(
        key, F.row_number().over(order).alias("rank"), F.col("labels").alias("label"), F.col("probabilities").alias("probability")
    )


def minimum_functionality_checks(model: PipelineModel, expectations: DataFrame) -> DataFrame:
    """Expectations ``(question, tag)`` whose most probable label is another one, with that label."""
    predicted = predict_tag(model, expectations, threshold=0.0, text="question")
    return predicted.where(F.col("predicted_tag") != F.col("tag"))


def route(prediction: Column, open_model: str, closed_model: str) -> Column:
    """1 goes to the open model, 0 to the closed one."""
    return F.when(prediction == 1, open_model).otherwise(closed_model)


def route_queries(model: PipelineModel, questions: DataFrame, open_model: str, closed_model: str, text: str = "question") -> DataFrame:
    """All columns plus ``routed`` (0/1) and ``llm``."""
    scored = model.transform(questions.withColumn("clean", F.col(text)))
    routed = scored.select(*questions.columns, F.col("prediction").cast("int").alias("routed"))
    return routed.withColumn("llm", route(F.col("routed"), open_model, closed_model))
