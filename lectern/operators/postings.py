"""A stored inverted index in blocks, and scores of its hits.

Documents are dealt to shards by a hash of their id. A block holds the postings
of one word in one shard and the peaks among them: the (tf, length) pairs that no
other pair of the block beats in both, of which one has the largest saturated tf
whatever the average length and the constants are. Blocks are stored by word, in
buckets, so that a search reads the buckets of its words alone.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.batches import pieces
from lectern.operators.joins import MAX_BROADCAST_ROWS, has_at_most
from lectern.session import scratch_path

# Documents in a shard, at least, and most shards; beyond that shards grow.
SHARD_DOCS, MOST_SHARDS = 2048, 1 << 20
# Documents for which one more bucket is made, and most buckets.
BUCKET_DOCS, MOST_BUCKETS = 20_000, 4096
# Shards of a word whose postings are put together by one task.
SHARDS_TOGETHER = 512
# Most words that are named in a scan, which then reads their buckets only. More would ask for most buckets
# anyway: they are sent to the blocks, or joined bucket by bucket where they are too many for that.
NAMED_WORDS = 256
# Bytes of documents that are inverted at once; smaller pieces make more segments.
INVERTED_BYTES = 2 << 20
# Postings that are put in order at once when segments are merged, if a shard has no more.
MERGED = 100_000
# Hits that a task scores at once, if one question has no more in a shard.
HITS = 500_000

SEGMENTS = "w string, span int, doc_ids array<long>, shards array<int>, tfs array<int>, dls array<int>"
BLOCKS = "w string, shard int, n int, n_tokens long, peaks array<struct<tf:int,dl:int>>, doc_ids array<long>, tfs array<int>, dls array<int>"


def _lists(places: np.ndarray, values, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def batch_tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The tokens of a batch of texts, as ``bm25_corpus_tokens`` tells them, and the row of each."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None and starts[-1] > starts[0] else np.zeros(0, np.uint8)
    starts = starts - starts[0]
    low = raw.copy()
    low[(raw >= 65) & (raw <= 90)] += 32
    inside = (low >= 97) & (low <= 122) | (low >= 48) & (low <= 57)
    edge = np.zeros(len(low) + 1, bool)
    edge[starts] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int64)
    joined = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])])
    return joined.dictionary_encode(), np.searchsorted(starts, first, "right") - 1


def invert(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (``doc_id, shard, text``) to segments: the postings of each word in a piece of a batch, cut where its span of shards ends."""
    for batch in (piece for whole in it for piece in pieces(whole, INVERTED_BYTES)):
        words, row = batch_tokens(batch["text"])
        if not len(words):
            continue
        dl = np.bincount(row, minlength=batch.num_rows)
        cell, tf = np.unique(words.indices.to_numpy().astype(np.int64) * batch.num_rows + row, return_counts=True)
        word, row = np.divmod(cell, batch.num_rows)
        shard = batch["shard"].to_numpy()[row]
        span = shard // SHARDS_TOGETHER
        order = np.lexsort((shard, word))
        word, row, shard, span, tf = word[order], row[order], shard[order], span[order], tf[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(word) != 0) | (np.diff(span) != 0)]))
        places = np.append(new, len(word))
        yield pa.record_batch(
            {
                "w": words.dictionary.take(pa.array(word[new])).cast(pa.string()),
                "span": pa.array(span[new], pa.int32()),
                "doc_ids": _lists(places, batch["doc_id"].to_numpy()[row], pa.int64()),
                "shards": _lists(places, shard, pa.int32()),
                "tfs": _lists(places, tf, pa.int32()),
                "dls": _lists(places, dl[row], pa.int32()),
            }
        )


def peaks_of(block: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
    """Which postings are peaks of their block (numbered from 0, in order): none has as many tokens in a shorter or equally long document."""
    order = np.lexsort((dl, -tf, block))
    # Every block's lengths lie below those of the block before, so that one running minimum does for all.
    level = dl[order].astype(np.int64) - block[order].astype(np.int64) * (1 << 32)
    lowest = np.minimum.accumulate(level)
    found = np.zeros(len(order), bool)
    found[order] = np.concatenate([[True], level[1:] < lowest[:-1]]) if len(order) else False
    return found


def cut_by_shard(table: pa.Table) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
    """The postings of some segments, with the word (by its number) of each, in parts of whole shards: ``MERGED`` postings at most, or one shard."""
    word = table["w"].combine_chunks().dictionary_encode().indices.to_numpy()
    chunks, first = [], 0
    for batch in table.to_batches():
        sizes = pc.list_value_length(batch["shards"]).to_numpy()
        chunks.append((np.repeat(word[first : first + batch.num_rows], sizes), {c: batch[c].flatten().to_numpy() for c in ("doc_ids", "shards", "tfs", "dls")}))
        first += batch.num_rows
    names = np.unique(np.concatenate([np.unique(flat["shards"]) for _, flat in chunks]))
    n = sum(np.bincount(np.searchsorted(names, flat["shards"]), minlength=len(names)) for _, flat in chunks)
    lo = 0
    while lo < len(names):
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(n[lo:]), MERGED, "right")) + lo)
        some = [np.flatnonzero((flat["shards"] >= names[lo]) & (flat["shards"] <= names[hi - 1])) for _, flat in chunks]
        yield np.concatenate([w[i] for (w, _), i in zip(chunks, some)]), {c: np.concatenate([flat[c][i] for (_, flat), i in zip(chunks, some)]) for c in chunks[0][1]}
        lo = hi


def blocks_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The blocks of sorted segments that are complete, of some shards at a time."""
    words = table["w"].combine_chunks().dictionary_encode().dictionary
    for word, flat in cut_by_shard(table):
        order = np.lexsort((flat["doc_ids"], flat["shards"], word))
        word, flat = word[order], {c: v[order] for c, v in flat.items()}
        shard, tf, dl = flat["shards"], flat["tfs"], flat["dls"]
        new = np.concatenate([[True], (np.diff(word) != 0) | (np.diff(shard) != 0)])
        first = np.flatnonzero(new)
        places = np.append(first, len(word))
        block = np.cumsum(new) - 1
        peak = np.flatnonzero(peaks_of(block, tf, dl))
        peak_places = np.searchsorted(block[peak], np.arange(len(first) + 1))
        pairs = pa.StructArray.from_arrays([pa.array(tf[peak], pa.int32()), pa.array(dl[peak], pa.int32())], ["tf", "dl"])
        yield pa.record_batch(
            {
                "w": words.take(pa.array(word[first])),
                "shard": pa.array(shard[first], pa.int32()),
                "n": pa.array(np.diff(places), pa.int32()),
                "n_tokens": pa.array(np.add.reduceat(tf.astype(np.int64), first), pa.int64()),
                "peaks": _lists(peak_places, pairs, pairs.type),
                "doc_ids": _lists(places, flat["doc_ids"], pa.int64()),
                "tfs": _lists(places, tf, pa.int32()),
                "dls": _lists(places, dl, pa.int32()),
            }
        )


def whole_runs(it: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Sorted batches cut so that rows with equal keys stay together."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        if not batch.num_rows:
            continue
        same = None
        for key in keys:
            equal = pc.equal(batch[key], batch[key][batch.num_rows - 1])
            same = equal if same is None else pc.and_(same, equal)
        last = batch.num_rows - int(pc.sum(pc.cast(same, pa.int64())).as_py())
        # Rows of the last key may go on in the next batch; equal rows are the end of a sorted batch.
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif held and any(held[-1][k][held[-1].num_rows - 1].as_py() != batch[k][0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def merge_segments(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_runs((piece for batch in it for piece in pieces(batch)), "w", "span"):
        yield from blocks_of(table)


def open_postings(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A stored table of blocks, known to Spark with its buckets."""
    name = f"lectern_postings_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({BLOCKS}) USING parquet CLUSTERED BY (w) SORTED BY (w, shard) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def write_postings(blocks: DataFrame, path: str, buckets: int) -> None:
    """Store blocks in buckets by word."""
    name = f"lectern_written_{uuid.uuid4().hex}"
    blocks.write.bucketBy(buckets, "w").sortBy("w", "shard").option("path", path).saveAsTable(name)
    # The catalogue's entry goes, an external table's files stay.
    blocks.sparkSession.sql(f"DROP TABLE {name}")


def layout(n_docs: int) -> tuple[int, int, int]:
    """Shards, buckets and spans of shards for so many documents."""
    shards = max(1, math.ceil(n_docs / max(SHARD_DOCS, math.ceil(n_docs / MOST_SHARDS))))
    return shards, min(MOST_BUCKETS, max(8, math.ceil(n_docs / BUCKET_DOCS))), math.ceil(shards / SHARDS_TOGETHER)


def by_bucket(rows: DataFrame, span, buckets: int, spans: int) -> DataFrame:
    """Rows brought together by the bucket their word is stored in, as Spark reckons it, so that a task writes few files."""
    bucket = F.pmod(F.hash("w"), F.lit(buckets))
    return rows.repartition(buckets * spans, bucket, span)


def copy_postings(postings: DataFrame, n_docs: int, path: str) -> None:
    """Store the blocks once more, at ``path``."""
    _, buckets, spans = layout(n_docs)
    write_postings(by_bucket(postings, F.expr(f"shard div {SHARDS_TOGETHER}"), buckets, spans), path, buckets)


def build_postings(docs: DataFrame, n_docs: int, path: str | None = None) -> DataFrame:
    """Invert ``docs`` (``doc_id, text``), store the blocks and open them.

    Segments of a batch's words travel instead of single postings. A word's
    postings come together for ``SHARDS_TOGETHER`` shards at a time, so that the
    most frequent words are no single task's work.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "postings")
    shards, buckets, spans = layout(n_docs)
    placed = docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), "text")
    segments = placed.where("doc_id is not null").mapInArrow(invert, SEGMENTS)
    together = by_bucket(segments, "span", buckets, spans).sortWithinPartitions("w", "span")
    write_postings(together.mapInArrow(merge_segments, BLOCKS), path, buckets)
    return open_postings(spark, path, buckets)


def of_words(postings: DataFrame, asked: DataFrame, names: int = NAMED_WORDS, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The blocks of the words in ``asked`` (``w``, written): a scan of their buckets, or a join; neither shuffles postings."""
    words = asked.select("w").distinct()
    if has_at_most(words, names):
        return postings.where(F.col("w").isin([r["w"] for r in words.collect()]))
    return postings.join(beside_buckets(words, words, most), "w", "left_semi")


def beside_buckets(side: DataFrame, counted: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A side of a join with the blocks: sent to them if ``counted`` is small, else merged bucket by bucket."""
    return F.broadcast(side) if has_at_most(counted, most) else side.hint("merge")


def peak_saturation(k1: float, b: float, avgdl: float):
    """The largest saturated tf of a block."""
    return F.array_max(F.transform("peaks", lambda p: saturation(p["tf"], p["dl"], k1, b, avgdl)))


def saturation(tf, dl, k1: float, b: float, avgdl: float):
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def hits_of(table: pa.Table, k1: float, b: float, avgdl: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``qid, doc_id, score`` of all documents that the blocks (``shard, w, doc_ids, tfs, dls, asks``) of some whole shards hold, by question.

    A shard with many hits is scored for some of its questions at a time. A score
    is summed up in the order of words, whatever else is scored with it.
    """
    shard = table["shard"].to_numpy()
    doc, tf, dl = (table[c].combine_chunks().flatten().to_numpy() for c in ("doc_ids", "tfs", "dls"))
    asks = table["asks"].combine_chunks()
    qid, weight = asks.flatten().field("qid").to_numpy(), asks.flatten().field("weight").to_numpy()
    sat = saturation(tf.astype(np.float64), dl, k1, b, avgdl)
    sizes, asked = np.diff(table["doc_ids"].combine_chunks().offsets.to_numpy()), np.diff(asks.offsets.to_numpy())
    first, first_ask = np.cumsum(sizes) - sizes, np.cumsum(asked) - asked
    hits = np.cumsum(sizes.astype(np.int64) * asked)
    cuts = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
    lo = 0
    while lo < len(shard):
        # As many whole shards as fit, one at least.
        upto = int(np.searchsorted(hits, (hits[lo - 1] if lo else 0) + HITS, "right"))
        at = int(np.searchsorted(cuts, upto, "right")) - 1
        hi = int(cuts[at]) if at >= 0 and cuts[at] > lo else int(cuts[np.searchsorted(cuts, lo, "right")])
        docs, doc_at = np.unique(doc[first[lo] : first[hi - 1] + sizes[hi - 1]], return_inverse=True)
        qids, qid_at = np.unique(qid[first_ask[lo] : first_ask[hi - 1] + asked[hi - 1]], return_inverse=True)
        # The block of each ask and the place of its first hit.
        of = np.repeat(np.arange(lo, hi), asked[lo:hi])
        begin = first[of] - first[lo]
        share = (np.cumsum(np.bincount(qid_at, sizes[of], minlength=len(qids))).astype(np.int64) - 1) // HITS
        for part in np.unique(share):
            # Asks stay in the order of the words, as the blocks come, and so do the sums.
            ask = np.flatnonzero(share[qid_at] == part)
            n = sizes[of[ask]]
            hit = np.arange(n.sum()) + np.repeat(begin[ask] - (np.cumsum(n) - n), n)
            low, high = np.searchsorted(share, [part, part + 1])
            cell = np.repeat(qid_at[ask] - low, n) * len(docs) + doc_at[hit]
            if not len(cell):
                continue
            s = np.repeat(weight[first_ask[lo] + ask], n) * sat[first[lo] + hit]
            each, at = np.unique(cell, return_inverse=True) if (high - low) * len(docs) > 4 * len(cell) else (None, cell)
            total = np.bincount(at, s, minlength=0 if each is not None else (high - low) * len(docs))
            if each is None:
                each = np.flatnonzero(np.bincount(cell, minlength=len(total)))
                total = total[each]
            yield qids[low + each // len(docs)], docs[each % len(docs)], total
        lo = hi


def score_blocks(blocks: DataFrame, reduce: Callable, schema: str, k1: float, b: float, avgdl: float) -> DataFrame:
    """``reduce(hits)`` of each task's shards, where hits are those of ``hits_of``; blocks come together by shard."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (piece for batch in it for piece in pieces(batch))
        yield from reduce(hit for table in whole_runs(some, "shard") for hit in hits_of(table, k1, b, avgdl))

    chosen = blocks.select("shard", "w", "doc_ids", "tfs", "dls", "asks")
    return chosen.repartition("shard").sortWithinPartitions("shard", "w").mapInArrow(run, schema)
