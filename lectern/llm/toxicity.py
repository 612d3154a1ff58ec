"""A convolutional text classifier over hashed word embeddings, in NumPy."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.arrow import batches
from lectern.llm.word_features import LANGUAGES, function_word_table, guessed_languages, letter_words, prefix_hashes, text_blocks
from lectern.operators.joins import broadcast_if_small
from lectern.session import materialize, scratch_path

# A word is looked up whole and by its first bytes.
PREFIXES = (4, 5)
WIDTHS = (1, 2, 3)
# Held-back rows are counted in so many steps of a logit, which is cut at so much on either side.
LOGIT_STEPS, LOGIT_MOST = 256, 64
# Bits of a map of labelled ids for each of them, bits of one map (as Spark makes them), and most maps that are sent (4 KB each).
MARK_BITS, MAP_BITS, MOST_MAPS = 16, 32768, 8192


@dataclass(frozen=True)
class Shape:
    """Size and training of the model, which learns from all labelled rows: a task from some ``rows`` of them, with some ``mb`` million bytes.

    One task goes through its rows ``epochs`` times. Several go through theirs
    once in each of ``rounds``, after which their models are averaged. Few rows are
    gone through in smaller batches and more often, for at least ``steps`` steps.
    """

    bits: int = 17
    dims: int = 8
    filters: int = 12
    epochs: int = 8
    rate: float = 0.1
    steps: int = 500
    batch: int = 64
    rounds: int = 4
    rows: int = 16384
    mb: int = 32
    seed: int = 7


@dataclass
class Model:
    embedding: np.ndarray
    kernels: list[np.ndarray]
    shifts: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    # AdaGrad's sums: of embedding, kernels, shifts and weights; of the bias.
    grown: list[np.ndarray] = field(default_factory=list)
    bias_grown: float = 1e-6


def lookups(words, bits: int) -> np.ndarray:
    """The rows of the embedding table that each word adds up."""
    kinds = [words.hashes, *(prefix_hashes(words, k) for k in PREFIXES)]
    return np.stack([(h >> np.uint64(64 - bits)).astype(np.int32) for h in kinds], 1)


def embedded(model: Model, rows: np.ndarray) -> np.ndarray:
    out = model.embedding[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        out += model.embedding[rows[:, k]]
    return out


def responses(model: Model, vectors: np.ndarray, k: int) -> np.ndarray:
    """What the filters of the k-th width answer at each place where all their words are there."""
    kernel, n = model.kernels[k], len(vectors) - WIDTHS[k] + 1
    if n <= 0:
        return np.zeros((0, kernel.shape[2]), np.float32)
    out = vectors[:n] @ kernel[0]
    for j in range(1, WIDTHS[k]):
        out += vectors[j : n + j] @ kernel[j]
    return out


def pooled(model: Model, vectors: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """The highest answer of each filter within each text, at least 0."""
    parts = []
    for k, width in enumerate(WIDTHS):
        answer = responses(model, vectors, k)
        best = np.full((n, answer.shape[1]), -np.inf, np.float32)
        if len(answer):
            inside = row[: len(answer)] == row[width - 1 :]
            answer, own = answer[inside], row[: len(answer)][inside]
            if len(own):
                begins = np.flatnonzero(np.diff(own, prepend=-1))
                best[own[begins]] = np.maximum.reduceat(answer, begins, axis=0)
        parts.append(np.maximum(best + model.shifts[k], 0))
    return np.concatenate(parts, 1)


def logits(model: Model, rows: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return pooled(model, embedded(model, rows), row, n) @ model.weights + model.bias


def untrained(shape: Shape, rng: np.random.Generator) -> Model:
    f32 = np.float32
    model = Model(
        rng.normal(0, 0.1, (1 << shape.bits, shape.dims)).astype(f32),
        [rng.normal(0, (w * shape.dims) ** -0.5, (w, shape.dims, shape.filters)).astype(f32) for w in WIDTHS],
        [np.zeros(shape.filters, f32) for _ in WIDTHS],
        np.abs(rng.normal(0, 0.5, len(WIDTHS) * shape.filters)).astype(f32),
        0.0,
    )
    # Half of the filters speak against the label.
    model.weights[::2] *= -1
    model.grown = [np.full(p.shape, 1e-6, f32) for p in (model.embedding, *model.kernels, *model.shifts, model.weights)]
    return model


def train(texts: list[np.ndarray], labels: np.ndarray, shape: Shape, weights: tuple[float, float] | None = None, start: Model | None = None, turn: int = 0, turns: int = 1) -> Model:
    """Fit by stochastic gradients with AdaGrad steps; ``texts`` are arrays of lookups, ``weights`` those of labels 0 and 1 (by default both weigh as much).

    All tasks of the first round start from the same untrained model, those of a later one from ``start``, which is changed.
    """
    rng = np.random.default_rng([shape.seed, turn] if turn else shape.seed)
    f32 = np.float32
    model = start or untrained(shape, rng)
    grown, bias_grown = model.grown, model.bias_grown
    if weights is None:
        positive = max(1, int(labels.sum()))
        weights = len(labels) / (2 * max(1, len(labels) - positive)), len(labels) / (2 * positive)
    weight = np.where(labels > 0, weights[1], weights[0])
    batch = max(8, min(shape.batch, len(texts) // 64))
    for _ in range(1 if turns > 1 else max(shape.epochs, -(-shape.steps * batch // len(texts)))):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            tops, hidden = [], np.zeros((len(chosen), len(model.weights)), f32)
            for b, i in enumerate(chosen):
                vectors = embedded(model, texts[i]) if len(texts[i]) else np.zeros((0, shape.dims), f32)
                own = []
                for k in range(len(WIDTHS)):
                    answer = responses(model, vectors, k)
                    at = answer.argmax(axis=0) if len(answer) else None
                    own.append(at)
                    if at is not None:
                        hidden[b, k * shape.filters : (k + 1) * shape.filters] = np.maximum(answer[at, np.arange(shape.filters)] + model.shifts[k], 0)
                tops.append(own)
            error = (1 / (1 + np.exp(-(hidden @ model.weights + model.bias))) - labels[chosen]) * weight[chosen] / len(chosen)
            back = error[:, None] * model.weights[None, :] * (hidden > 0)
            steps = [None, *(np.zeros_like(p) for p in (*model.kernels, *model.shifts)), (hidden * error[:, None]).sum(axis=0)]
            places, pushes = [], []
            for b, i in enumerate(chosen):
                for k, width in enumerate(WIDTHS):
                    if tops[b][k] is None:
                        continue
                    own = back[b, k * shape.filters : (k + 1) * shape.filters]
                    some = np.flatnonzero(own)
                    if not len(some):
                        continue
                    push = own[some]
                    rows = texts[i][tops[b][k][some][:, None] + np.arange(width)]
                    seen = model.embedding[rows].sum(axis=2)
                    steps[1 + k][:, :, some] += (push[:, None, None] * seen).transpose(1, 2, 0)
                    steps[1 + len(WIDTHS) + k][some] += push
                    places.append(rows.ravel())
                    share = push[:, None, None] * model.kernels[k][:, :, some].transpose(2, 0, 1)
                    pushes.append(np.repeat(share.reshape(-1, shape.dims), rows.shape[2], axis=0))
            if places:
                where, turn = np.unique(np.concatenate(places), return_inverse=True)
                total = np.zeros((len(where), shape.dims), f32)
                np.add.at(total, turn, np.concatenate(pushes))
                grown[0][where] += total**2
                model.embedding[where] -= shape.rate * total / np.sqrt(grown[0][where])
            for p, g, step in zip((*model.kernels, *model.shifts, model.weights), grown[1:], steps[1:]):
                g += step**2
                p -= 0.3 * shape.rate * step / np.sqrt(g)
            bias_grown += float(error.sum()) ** 2
            model.bias -= 0.3 * shape.rate * float(error.sum()) / bias_grown**0.5
    model.bias_grown = bias_grown
    return model


def flat(arrays: list[np.ndarray], last: float, dims: int) -> np.ndarray:
    """All but the embedding and one number more, in rows of ``dims``."""
    values = np.concatenate([*(a.ravel() for a in arrays), [last]]).astype(np.float64)
    return np.pad(values, (0, -len(values) % dims)).reshape(-1, dims)


def parameter_rows(model: Model, before: np.ndarray, dims: int) -> pa.Table:
    """``place, value, grown`` of the rows of the embedding whose sums are not as ``before``, and of all else behind them."""
    where = np.flatnonzero((model.grown[0] != before).any(axis=1))
    rest = flat([*model.kernels, *model.shifts, model.weights], model.bias, dims), flat(model.grown[1:], model.bias_grown, dims)
    value = np.concatenate([model.embedding[where], rest[0]]).astype(np.float64)
    grown = np.concatenate([model.grown[0][where], rest[1]]).astype(np.float64)
    place = np.concatenate([where, len(before) + np.arange(len(rest[0]))]).astype(np.int32)
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), dims).cast(pa.list_(pa.float64())) for a in (value, grown)]
    return pa.table({"place": pa.array(place), "value": lists[0], "grown": lists[1]})


def with_parameters(model: Model, place: np.ndarray, value: np.ndarray, grown: np.ndarray) -> Model:
    """The model with the rows that ``parameter_rows`` gave."""
    some, n = place < len(model.embedding), len(model.embedding)
    order = np.argsort(place[~some])
    assert place[~some][order].tolist() == list(range(n, n + len(order)))
    for into, out in ((model.embedding, value), (model.grown[0], grown)):
        into[place[some]] = out[some]
    at, rest = 0, [a[~some][order].ravel() for a in (value, grown)]
    for into, old in zip((*model.kernels, *model.shifts, model.weights), model.grown[1:]):
        into[...], old[...] = (r[at : at + into.size].reshape(into.shape) for r in rest)
        at += into.size
    model.bias, model.bias_grown = (float(r[at]) for r in rest)
    return model


def best_threshold(n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The cut with the highest F1 between steps (from the highest on), in the middle of the gap where it lies."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    k = int(np.argmax(f1))
    return float(low[k] + (high[k + 1] if k + 1 < len(n) else low[k])) / 2


def calibrated(model: Model, language: np.ndarray, step: np.ndarray, n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray, least: int = 20) -> Model:
    """Set the threshold of each language from the counts of held-back rows; a language with fewer of a class than ``least`` has that of all."""

    def best(own: np.ndarray) -> float:
        order = np.flatnonzero(own)[np.argsort(-step[own], kind="stable")]
        first = np.flatnonzero(np.diff(step[order], prepend=np.inf))
        return best_threshold(np.add.reduceat(n[order], first), np.add.reduceat(hits[order], first), np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first))

    if 0 < hits.sum() < n.sum():
        model.thresholds[:] = best(np.ones(len(n), bool))
        for k in range(len(LANGUAGES)):
            own = language == k
            if least <= hits[own].sum() <= n[own].sum() - least:
                model.thresholds[k] = best(own)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, mb: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` ids and ``mb`` million bytes of each class, in the order of a hash of the id.

    For trials on a small part; ``fit`` learns from all labelled rows.
    An id with several texts teaches with its smallest (then first) one. Texts
    of over a 64th of the bytes come after all others, by size, so that none of
    them keeps others out.
    """
    docs = docs.select("doc_id", "text")
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    rank, spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), 1 << 30
    order = [rank, F.col("doc_id")]
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect() if r["label"] in (0, 1)}
    few = known.limit(0)
    for label, n in sorted(sizes.items()):
        # A share of the hashes that holds some more than enough, so that tasks do not each send as many as are wanted.
        share = min(spread, int(spread * (1.5 * rows + 200) / n))
        few = few.unionByName(known.where((F.col("label") == label) & (rank < share)).orderBy(*order).limit(rows))
    # Few and narrow: at most twice ``rows`` ids travel, then as many lengths are summed up.
    sized = docs.join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    large = F.when(F.col("size") > mb * 1_000_000 // 64, F.col("size")).otherwise(0)
    sums = sized.withColumn("sum", F.sum("size").over(Window.partitionBy("label").orderBy(large, *order).rowsBetween(Window.unboundedPreceding, 0)))
    chosen = sums.where(F.col("sum") <= mb * 1_000_000).select("doc_id", "label", "size")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").where(F.octet_length("text") == F.col("size"))
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def marked(docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose id is among the ``n`` of ``known``, and a few of others: some one in ``MARK_BITS``, until the marks are as many as may be sent.

    Each known id sets one bit of a map that is sent to the documents, so that the texts of others need not travel.
    """
    maps = max(1, min(MOST_MAPS, math.ceil(n * MARK_BITS / MAP_BITS)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(maps * MAP_BITS))
    each, bit = F.expr(f"_place div {MAP_BITS}").alias("_map"), (F.col("_place") % MAP_BITS).alias("_bit")
    marks = known.select(place.alias("_place")).select(each, bit).groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    placed = docs.withColumn("_place", place).select(*docs.columns, each, bit).join(F.broadcast(marks), "_map")
    byte = F.conv(F.hex(F.substring("_marks", F.expr("cast(_bit div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    return placed.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*docs.columns)


def share_names(spark: SparkSession, shares: int) -> list[int]:
    """A number for each share, such that no two of them fall into one of as many buckets."""
    tried = spark.range(64 + 32 * shares).select(F.col("id").cast("int").alias("share"))
    found = tried.groupBy(F.pmod(F.hash("share"), F.lit(shares)).alias("bucket")).agg(F.min("share").alias("share")).orderBy("bucket")
    names = [r["share"] for r in found.collect()]
    assert len(names) == shares
    return names


def shares_of(docs: DataFrame, labels: DataFrame, shape: Shape) -> DataFrame:
    """``share, doc_id, label, text`` of all labelled ids, stored by share; a share is what one task learns from.

    An id with several texts teaches with its smallest (then first) one. Texts
    travel once, to their share, where they meet their labels.
    """
    spark = docs.sparkSession
    kind = docs.select("doc_id").unionByName(labels.select("doc_id")).schema["doc_id"].dataType
    known = labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(F.max("label").alias("label"))
    known = materialize(known.where(F.col("label").isin(0, 1)), "known")
    texts = docs.select(F.col("doc_id").cast(kind).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = texts.select("doc_id", F.octet_length("text").alias("size"))
    n, size = sizes.join(broadcast_if_small(known.select("doc_id")), "doc_id").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shares = max(1, math.ceil(n / shape.rows), math.ceil(size / (shape.mb * 1_000_000)))
    rows = marked(texts, known, known.count()).withColumn("label", F.lit(None).cast(known.schema["label"].dataType))
    rows = rows.unionByName(known.select("doc_id", F.lit(None).cast("string").alias("text"), "label"))
    share = F.get(F.lit(share_names(spark, shares)), F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int"))
    dealt = rows.withColumn("share", share).repartition(shares, "share")
    least = F.min(F.when(F.col("text").isNotNull(), F.struct(F.octet_length("text").alias("size"), "text"))).alias("least")
    each = dealt.groupBy("share", "doc_id").agg(F.max("label").alias("label"), least).where("label is not null and least is not null")
    name = f"lectern_shares_{uuid.uuid4().hex}"
    each.select("share", "doc_id", "label", "least.text").write.bucketBy(shares, "share").option("path", scratch_path(spark, "shares")).saveAsTable(name)
    return spark.table(name)


def lessons(share: pa.Table, bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Lookups, label and language of a share's texts, and which fifth of them is held back for the thresholds."""
    found = share.combine_chunks().sort_by("doc_id")
    label = found["label"].to_numpy().astype(np.float32)
    table, texts, language = function_word_table(20), [], []
    for chunk in found["text"].chunks:
        for lo, hi, data, starts in text_blocks(chunk):
            words = letter_words(data, starts)
            rows = lookups(words, bits)
            texts.extend(np.split(rows, np.cumsum(words.counts)[:-1]))
            language.extend(guessed_languages(words, table))
    # A text without words has nothing toxic in it; some such are added to both parts.
    blank = 5 * max(1, len(texts) // 250)
    texts += [np.zeros((0, 1 + len(PREFIXES)), np.int32)] * blank
    language, label = np.array(language + [0] * blank), np.concatenate([label, np.zeros(blank, np.float32)])
    return texts, label, language, np.arange(len(texts)) % 5 == 0


def learned(shares: DataFrame, shape: Shape, weights: tuple[float, float] | None, start: Model | None, turn: int, turns: int) -> Model:
    """The mean of the models that the tasks of a round come to; a row of the embedding is that of the tasks that changed it."""

    def learn(share: pa.Table) -> pa.Table:
        texts, label, _, back = lessons(share, shape.bits)
        before = start.grown[0].copy() if start else np.float32(1e-6) + np.zeros((1 << shape.bits, shape.dims), np.float32)
        # A worker may learn from several shares.
        own = None if start is None else Model(start.embedding.copy(), [k.copy() for k in start.kernels], [s.copy() for s in start.shifts],
                                               start.weights.copy(), start.bias, start.thresholds, [g.copy() for g in start.grown], start.bias_grown)
        model = train([t for t, b in zip(texts, back) if not b], label[~back], shape, weights, own, turn, turns)
        return parameter_rows(model, before, shape.dims)

    sent = shares.groupBy("share").applyInArrow(learn, "place int, value array<double>, grown array<double>")
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c in ("value", "grown") for i in range(shape.dims)]
    met = sent.groupBy("place").agg(F.count("*").alias("n"), *sums).toArrow()
    n = met["n"].to_numpy()[:, None]
    value, grown = (np.stack([met[f"{c}{i}"].to_numpy() for i in range(shape.dims)], 1) / n for c in ("value", "grown"))
    return with_parameters(start or untrained(shape, np.random.default_rng(shape.seed)), met["place"].to_numpy(), value, grown)


def held_back(shares: DataFrame, model: Model) -> pa.Table:
    """``language, step, n, hits, low, high``: held-back rows and labels among them in each step of the logit, with its range there."""
    bits = int(len(model.embedding)).bit_length() - 1

    def count(share: pa.Table) -> pa.Table:
        texts, label, language, back = lessons(share, bits)
        held = [t for t, b in zip(texts, back) if b]
        row = np.repeat(np.arange(len(held)), [len(t) for t in held])
        logit = logits(model, np.concatenate(held), row, len(held)).astype(np.float32)
        step = np.floor(np.clip(logit, -LOGIT_MOST, LOGIT_MOST) * LOGIT_STEPS).astype(np.int32)
        told = pa.table({"language": pa.array(language[back], pa.int32()), "step": step, "label": pa.array(label[back], pa.int64()), "logit": logit})
        found = told.group_by(["language", "step"]).aggregate([([], "count_all"), ("label", "sum"), ("logit", "min"), ("logit", "max")])
        return found.select(["language", "step", "count_all", "label_sum", "logit_min", "logit_max"]).rename_columns(["language", "step", "n", "hits", "low", "high"])

    each = shares.groupBy("share").applyInArrow(count, "language int, step int, n long, hits long, low float, high float")
    return each.groupBy("language", "step").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow()


def fit(docs: DataFrame, labels: DataFrame, shape: Shape = Shape()) -> Model:
    """A model of ``labels`` (``doc_id, label``) from the texts of ``docs`` (``doc_id, text``): of all labelled rows.

    A fifth of them is held back for the thresholds. Without labelled
    rows of both classes the model scores every text below 0.5.
    """
    shares = shares_of(docs, labels, shape)
    sizes = {r["label"]: r["count"] for r in shares.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model(np.zeros((1 << shape.bits, shape.dims), np.float32), [np.zeros((w, shape.dims, 1), np.float32) for w in WIDTHS],
                     [np.zeros(1, np.float32) for _ in WIDTHS], np.zeros(len(WIDTHS), np.float32), -5.0)
    n = sum(sizes.values())
    several = shares.select("share").distinct().count() > 1
    weights = (n / (2 * sizes[0]), n / (2 * sizes[1])) if several else None
    turns, model = shape.rounds if several else 1, None
    for turn in range(turns):
        model = learned(shares, shape, weights, model, turn, turns)
    model.grown = []
    held = held_back(shares, model)
    return calibrated(model, *(held[c].to_numpy() for c in ("language", "step", "n", "hits", "low", "high")))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row from its whole text alone: 0.5 and more is on the label's side of the threshold.

    The language that picks the threshold is guessed from the text. Null and
    empty texts are scored as texts without words; rows without doc_id keep a
    null; repeated rows give repeated results; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    bits = int(len(model.embedding)).bit_length() - 1

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = function_word_table(20)
        for batch in it:
            found = []
            for lo, hi, data, starts in text_blocks(batch.column(1)):
                words = letter_words(data, starts)
                logit = logits(model, lookups(words, bits), words.row, hi - lo).astype(np.float64)
                logit -= model.thresholds[guessed_languages(words, table)]
                found.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
            yield batches({"doc_id": batch.column(0), "score": np.concatenate(found) if found else np.zeros(0)}, schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, "doc_id long, score double")


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from: those whose id, as text, has a CRC-32 that 5 divides."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    ``labels`` has ``doc_id, label``; the model is fitted to all
    rows that are not held out (see Shape) and scores whole texts.
    Rows without a document id have a null ``held_out``. Tables without rows or
    labels give no rows, or scores below 0.5. See ``score`` for odd texts.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    model = fit(plain, labels.where(~held_out("doc_id")), shape)
    return score(plain, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
