"""Quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.arrow import batches, mix, word_spans
from lectern.llm.word_features import function_word_table, letter_words, text_blocks

# Bytes that prose seldom has.
SYMBOLS = b"#$%&*[\\]^`{|}~"
# What a labeller says of a text.
BAD, GOOD, NOTHING = 0, 1, 2


@dataclass(frozen=True)
class Labeller:
    """Votes by one statistic: good on one side of ``good``, bad on the other side of ``bad``, nothing between or under ``words`` words."""

    statistic: str
    bad: float
    good: float
    words: int = 1

    def vote(self, value: np.ndarray, words: np.ndarray) -> np.ndarray:
        sign = 1 if self.good > self.bad else -1
        votes = np.full(len(value), NOTHING)
        votes[sign * value >= sign * self.good] = GOOD
        votes[sign * value <= sign * self.bad] = BAD
        votes[words < self.words] = NOTHING
        return votes


LABELLERS = (
    Labeller("symbols", bad=0.06, good=0.03),
    Labeller("trailing", bad=0.20, good=0.05, words=5),
    Labeller("bars", bad=0.10, good=0.02, words=5),
    Labeller("capitals", bad=0.50, good=0.25, words=5),
    Labeller("exclamations", bad=0.20, good=0.05, words=5),
    Labeller("echoes", bad=0.25, good=0.05, words=10),
    Labeller("fresh", bad=0.60, good=0.85, words=20),
    Labeller("function", bad=0.02, good=0.08, words=10),
    Labeller("words", bad=0, good=20, words=0),
)


@dataclass
class Statistics:
    """Statistics of some texts, and hashes of the shapes of their tokens."""

    values: dict[str, np.ndarray]
    shapes: np.ndarray
    shape_row: np.ndarray

    def votes(self) -> np.ndarray:
        """One column per labeller."""
        words = self.values["words"]
        return np.stack([x.vote(self.values[x.statistic], words) for x in LABELLERS], 1) if len(words) else np.zeros((0, len(LABELLERS)), int)


def _share(mask: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return (sums[starts[1:]] - sums[starts[:-1]]) / np.maximum(of, 1)


def _repeats(row: np.ndarray, hashes: np.ndarray, n: int, ahead: int) -> np.ndarray:
    """How many of each text's ``ahead``-word windows are new in it, of how many."""
    if len(row) < ahead:
        return np.ones(n)
    window = hashes[: len(hashes) - ahead + 1].copy()
    for j in range(1, ahead):
        window = mix(window) + hashes[j : len(hashes) - ahead + 1 + j]
    own = row[: len(window)] == row[ahead - 1 :]
    row, window = row[: len(window)][own], mix(window[own] + mix(row[: len(own)][own].astype(np.uint64)))
    _, at = np.unique(window, return_index=True)
    return np.bincount(row[at], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1) + (np.bincount(row, minlength=n) == 0)


def text_statistics(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> Statistics:
    n = len(starts) - 1
    first, last, row = word_spans(data, starts)
    tokens = np.bincount(row, minlength=n)
    shown = np.bincount(row, last - first, n)
    words = letter_words(data, starts)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    letters = _share(upper | lower, starts, np.ones(n))
    per_token = lambda mask: np.bincount(row[mask], minlength=n) / np.maximum(tokens, 1)
    bare = (last - first == 1) & symbol[data[first]]
    echo = np.zeros(len(words.row), bool)
    echo[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.row[1:] == words.row[:-1])
    counts = np.maximum(words.counts, 1)
    bits = int(len(table)).bit_length() - 1
    known = table[(words.hashes >> np.uint64(64 - bits)).astype(np.int64)] > 0
    values = {
        "symbols": _share(symbol[data], starts, shown),
        "trailing": per_token((last - first > 1) & symbol[data[last - 1]]),
        "bars": per_token(bare),
        "capitals": _share(upper, starts, letters),
        "exclamations": per_token((data[last - 1] == 33) & (last - first > 1)),
        "echoes": np.bincount(words.row[echo], minlength=n) / counts,
        "fresh": _repeats(words.row, words.hashes, n, 3),
        "function": np.bincount(words.row[known], minlength=n) / counts,
        "words": words.counts.astype(float),
    }
    # Shape of a token: kind of its first and last byte, length up to 8, all capitals or not.
    kind = np.zeros(256, np.uint64)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    kind[list(SYMBOLS)], kind[33:34], kind[list(b".,;:?")] = 4, 5, 6
    ups = np.concatenate([[0], np.cumsum(upper)])
    caps = ((ups[last] - ups[first]) * 2 > last - first).astype(np.uint64)
    shapes = kind[data[first]] | kind[data[last - 1]] << np.uint64(3) | np.minimum(last - first, 8).astype(np.uint64) << np.uint64(6) | caps << np.uint64(10)
    return Statistics(values, mix(shapes + np.uint64(1)), row)


def features(s: Statistics, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of texts: row, bucket, value. Token shapes count by their share; statistics as the tenth they fall into."""
    n = len(s.values["words"])
    bucket = (s.shapes >> np.uint64(64 - bits)).astype(np.int64)
    code, count = np.unique(s.shape_row * (1 << bits) + bucket, return_counts=True)
    row, bucket = code >> bits, code & ((1 << bits) - 1)
    total = np.bincount(s.shape_row, minlength=n)
    rows, buckets, values = [row], [bucket], [count / total[row]]
    for k, (name, value) in enumerate(sorted(s.values.items())):
        tenth = np.minimum(np.log1p(value) * 2 if name == "words" else value * 20, 20).astype(np.uint64)
        rows.append(np.arange(n))
        buckets.append((mix(tenth + np.uint64(1000 * (k + 1))) >> np.uint64(64 - bits)).astype(np.int64))
        values.append(np.full(n, 0.5))
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


@dataclass
class LabelModel:
    """The share of good texts and how often each labeller that votes says what, by true class."""

    good: float
    says: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that a text with these votes is good."""
        log = np.log(np.clip(self.says, 1e-9, 1))
        odds = np.full(len(votes), np.log(self.good) - np.log1p(-self.good))
        for k in range(votes.shape[1]):
            told = votes[:, k] != NOTHING
            odds[told] += log[k, GOOD, votes[told, k]] - log[k, BAD, votes[told, k]]
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def expectation_maximisation(
    votes: np.ndarray, count: np.ndarray, false_alarm: float = 0.005, found: float = 0.25, strength: float = 0.1,
    rounds: int = 200, tolerance: float = 1e-9,
) -> LabelModel:
    """Fit to patterns of votes and how many texts have each.

    A labeller looks for one defect, so it misses most bad texts and seldom
    accuses a good one: rates of ``found`` and ``false_alarm`` are the prior, with
    the weight of ``strength`` times the texts. It starts from: one bad vote
    makes a text bad.
    """
    belief = np.where((votes == BAD).any(axis=1), 0.02, np.where((votes == GOOD).any(axis=1), 0.98, 0.5))
    prior_says = np.array([[found, 1 - found], [false_alarm, 1 - false_alarm]]) * strength * count.sum()
    model = None
    for _ in range(rounds):
        w = np.stack([(1 - belief) * count, belief * count], 1)
        says = np.repeat(prior_says[None], votes.shape[1], axis=0)
        for k in range(votes.shape[1]):
            for said in (BAD, GOOD):
                says[k, :, said] += w[votes[:, k] == said].sum(axis=0)
        says /= says.sum(axis=2, keepdims=True)
        prior = float(np.clip((w[:, 1].sum() + 1) / (w.sum() + 2), 1e-6, 1 - 1e-6))
        model = LabelModel(prior, says)
        after = model.posterior(votes)
        if np.abs(after - belief).max(initial=0) < tolerance:
            break
        belief = after
    return model


def all_votes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, pattern``: what the labellers say of each text, as one number in base 3."""
    schema = pa.schema([("doc_id", pa.int64()), ("pattern", pa.int32())])
    base = 3 ** np.arange(len(LABELLERS))

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = function_word_table(20)
        for batch in it:
            found = [text_statistics(d, s, table).votes() @ base for _, _, d, s in text_blocks(batch.column(1))]
            yield batches({"doc_id": batch.column(0), "pattern": np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)}, schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, "doc_id long, pattern int")


def unpacked(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def score(self, s: Statistics) -> np.ndarray:
        row, bucket, value = features(s, int(len(self.weights)).bit_length() - 1)
        logit = np.bincount(row, self.weights[bucket] * value, len(s.values["words"])) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def linear_scorer(texts: list[str], target: np.ndarray, bits: int, epochs: int = 200, rate: float = 2.0, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by AdaGrad over all given texts at once."""
    table, parts, at = function_word_table(20), [], 0
    for _, _, data, starts in text_blocks(pa.array(texts, pa.string())):
        row, bucket, value = features(text_statistics(data, starts, table), bits)
        parts.append((row + at, bucket, value))
        at += len(starts) - 1
    row, bucket, value = (np.concatenate(x) for x in zip(*parts))
    weights, bias, grown, bias_grown = np.zeros(1 << bits), 0.0, np.full(1 << bits, 1e-9), 1e-9
    for _ in range(epochs):
        error = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[bucket] * value, len(texts)) + bias, -50, 50))) - target
        step = np.bincount(bucket, error[row] * value, 1 << bits) / len(texts) + ridge * weights
        grown += step**2
        weights -= rate * step / np.sqrt(grown) / 4
        bias_grown += error.mean() ** 2
        bias -= rate * error.mean() / bias_grown**0.5 / 4
    return weights, float(bias)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = 4096, mb: int = 32, bits: int = 16) -> QualityModel:
    """Accuracies from the votes on all texts, then a scorer from a sample of ``rows`` texts with ``mb`` million bytes at most.

    The sample is in the order of a hash of id and size, with one text (the
    first) for each id and size; texts of over a 64th of the bytes come after all
    others, by size, so that none of them keeps others out. The driver receives a
    count for each pattern of votes (a fixed number of patterns) and the sample.
    """
    votes = all_votes(docs, doc_id, text).groupBy("pattern").count().toArrow()
    if not votes.num_rows:
        return QualityModel(LabelModel(0.5, np.full((len(LABELLERS), 2, 2), 0.5)), np.zeros(1 << bits), 0.0)
    votes = votes.sort_by("pattern")
    labels = expectation_maximisation(unpacked(votes["pattern"].to_numpy()), votes["count"].to_numpy())
    plain = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("size", F.octet_length("text"))
    order = [F.xxhash64("id", "size"), F.col("id"), F.col("size")]
    few = plain.select("id", "size").distinct().orderBy(*order).limit(rows)
    large = F.when(F.col("size") > mb * 1_000_000 // 64, F.col("size")).otherwise(0)
    sums = few.withColumn("sum", F.sum("size").over(Window.orderBy(large, *order).rowsBetween(Window.unboundedPreceding, 0)))
    chosen = sums.where(F.col("sum") <= mb * 1_000_000).select(F.col("id").alias("chosen"), F.col("size").alias("bytes"))
    same = F.col("id").eqNullSafe(F.col("chosen")) & (F.col("size") == F.col("bytes"))
    sample = plain.join(F.broadcast(chosen), same).groupBy("id", "size").agg(F.min("text").alias("text")).select("id", "text").toArrow()
    texts = [t or "" for t in sample.sort_by([("id", "ascending"), ("text", "ascending")])["text"].to_pylist()]
    if not texts:
        return QualityModel(labels, np.zeros(1 << bits), float(np.log(labels.good / (1 - labels.good))))
    table = function_word_table(20)
    told = np.concatenate([text_statistics(d, s, table).votes() for _, _, d, s in text_blocks(pa.array(texts, pa.string()))])
    return QualityModel(labels, *linear_scorer(texts, labels.posterior(told), bits))


def scored(docs: DataFrame, model: QualityModel, text: str = "text", least: float = 0.5, prefix: str = "quality_") -> DataFrame:
    """All rows and columns of ``docs`` with ``<prefix>posterior``, ``<prefix>score`` and ``<prefix>keep`` (score of ``least`` and more).

    Whole texts are scored; a null counts as empty. A column that already has
    one of the three names is replaced.
    """
    names = [f"{prefix}posterior", f"{prefix}score", f"{prefix}keep"]
    plain = docs.drop(*names)
    at = plain.columns.index(text)
    ddl = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in plain.schema), f"`{names[0]}` double", f"`{names[1]}` double"])

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = function_word_table(20)
        for batch in it:
            told, values = [np.zeros(0)], [np.zeros(0)]
            for _, _, d, s in text_blocks(batch.column(at)):
                found = text_statistics(d, s, table)
                told.append(model.labels.posterior(found.votes()))
                values.append(model.score(found))
            columns = [*batch.columns, pa.array(np.concatenate(told)), pa.array(np.concatenate(values))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names[:2]])

    return plain.mapInArrow(work, ddl).withColumn(names[2], F.col(names[1]) >= least)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id, posterior, score, keep`` of every row.

    The posterior is what the labellers' votes tell, the score is the linear
    scorer's. Null and empty texts are judged as texts without words; rows
    without doc_id are judged too; repeated rows count each and give repeated
    results; an empty table gives an empty result; other columns are not read.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = scored(plain, fit(plain), least=least, prefix="")
    return found.select("doc_id", "posterior", "score", "keep")
