"""Near copies by SimHash: fingerprints, deletion-variant index, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches
from lectern.llm.components import connected_components
from lectern.session import materialize

BITS = 64
# A key shared by more distinct fingerprints than this is cut further, by a byte of the other half.
HOT_KEY = 20_000
# Shingles that are hashed before their bits are counted.
BLOCK = 1 << 16


def shingle_hashes(text: str | None, size: int, seed: int = 42) -> list[int]:
    """XXH64 of each ``size``-word shingle of the text in A-Z lower case; the whole sequence if it is shorter."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(line, seed)]
    begins = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[i : j - 1], seed) for i, j in zip(begins, begins[size:])]


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of hashes[starts[i]:starts[i + 1]] have each bit; no row may be empty."""
    total = np.zeros((len(starts) - 1, BITS), np.int64)
    for lo in range(0, len(hashes), BLOCK):
        part = hashes[lo : lo + BLOCK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(starts, lo, "right")) - 1
        last = int(np.searchsorted(starts, lo + len(part), "left"))
        cuts = np.maximum(starts[first:last], lo) - lo
        total[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    return total


def fingerprint_rows(texts: list, size: int) -> np.ndarray:
    """The fingerprint of each text as a signed long."""
    found = np.zeros(len(texts), np.uint64)
    at, counts, hashes = [], [0], []

    def close():
        if at:
            starts = np.cumsum(counts)
            ones = bit_counts(np.array(hashes, np.uint64), starts)
            wins = ones * 2 > np.diff(starts)[:, None]
            found[at] = np.packbits(wins, axis=1, bitorder="little").view("<u8").ravel()
        at.clear(), hashes.clear(), counts.__setitem__(slice(None), [0])

    for k, text in enumerate(texts):
        own = shingle_hashes(text, size)
        if own:
            at.append(k), counts.append(len(own)), hashes.extend(own)
        if len(hashes) >= BLOCK:
            close()
    close()
    return found.view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row as a long. Texts without words have 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batches({"doc_id": batch.column(0), "fp": fingerprint_rows(batch.column(1).to_pylist(), size)}, schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, "doc_id long, fp long")


def variant_index(fps: DataFrame) -> DataFrame:
    """``key, fp``: each fingerprint under its 64 one-wildcard half variants.

    Of two halves of 32 bits, one differs by at most one bit if the whole
    differs by three at most; halves that differ in bit j alone are equal once
    j is blanked. The key holds the half, j and what is left.
    """
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("p")).select(
        F.expr(
            "(cast(p as bigint) << 32) | (shiftrightunsigned(fp, cast(p div 32 as int) * 32) & 4294967295L & ~(1L << (p % 32)))"
        ).alias("key"),
        "fp",
    )


def run_links(fp: np.ndarray, within: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as (seed, reached)."""
    left, links = fp.view(np.uint64).copy(), []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        wave = [seed]
        while wave and len(left):
            near = np.bitwise_count(left ^ wave.pop()) <= within
            if near.any():
                reached = left[near]
                left = left[~near]
                wave.extend(reached)
                links.extend((seed, r) for r in reached)
    return links


def verified_links(it: Iterator[pa.RecordBatch], within: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Links of each run of equal keys in sorted batches (columns ``key, fp``), without its full list of pairs."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def linked(key, fp):
        a, b = [], []
        cuts = np.flatnonzero(np.diff(key)) + 1
        sizes = np.diff(np.concatenate([[0], cuts, [len(key)]]))
        small = np.repeat(sizes <= 8, sizes)
        for d in range(1, 8):
            i = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
            i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= within]
            a.append(fp[i]), b.append(fp[i + d])
        begins = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(sizes > 8):
            pairs = np.array(run_links(fp[begins[k] : begins[k] + sizes[k]], within), np.uint64).reshape(-1, 2).view(np.int64)
            a.append(pairs[:, 0]), b.append(pairs[:, 1])
        found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        return batches({"a": found[:, 0], "b": found[:, 1]}, schema)

    for batch in it:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if len(keys) and keys[0] != keys[-1]:
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            yield linked(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield linked(keys, fps)


def near_links(fps: DataFrame, within: int = 3, hot_key: int = HOT_KEY) -> DataFrame:
    """``a, b``: links that connect every two distinct fingerprints differing in up to ``within`` (0 to 3) bits.

    Rows with equal keys are brought together and verified. A run of up to
    eight gives all its links, a longer one a spanning forest, so a dense
    group never turns into all its pairs and no connection is lost. Keys with
    more than ``hot_key`` fingerprints are cut by the bytes of the other half:
    of its four bytes one is equal if at most three bits differ.
    """
    if not 0 <= within <= 3:
        raise ValueError("the index holds for up to three differing bits")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(it):
        return verified_links(it, within, schema)

    def join(index):
        return index.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(work, "a long, b long")

    index = variant_index(fps)
    hot = materialize(index.groupBy("key").count().where(F.col("count") > hot_key).select("key"), "hot-keys")
    if hot.isEmpty():
        return join(index)
    cut = index.join(hot, "key", "left_semi").select("key", "fp", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("i"))
    other = F.expr("shiftrightunsigned(fp, cast(1 - (key >> 37) as int) * 32 + i * 8) & 255")
    cut = cut.select(F.xxhash64("key", "i", other).alias("key"), "fp")
    return join(index.join(hot, "key", "left_anti")).union(join(cut))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, within: int = 3, hot_key: int = HOT_KEY) -> DataFrame:
    """``doc_id, fp, component_id`` for every row.

    ``component_id`` is the smallest doc_id that can be reached over links of
    fingerprints that differ in up to ``within`` bits. Copies meet as one
    fingerprint, so a group of any size costs one index entry. Texts that are
    null, empty or blank have fingerprint 0 and are linked like any other; rows
    without doc_id keep a null there and count for no smallest id; repeated
    rows give repeated results; an empty table gives an empty result. Other
    columns are not read.
    """
    each = materialize(fingerprints(docs, doc_id, text, size), "fingerprints")
    distinct = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(near_links(distinct.select("fp"), within, hot_key), "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return each.join(named, "fp").select("doc_id", "fp", "component_id")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, within: int = 3) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group: the one with the smallest id.

    Rows that repeat an id are one document and leave one row. Rows without an
    id stay as they are. Columns are kept.
    """
    kept = near_copies(docs, doc_id, text, size, within).where("doc_id = component_id").select("doc_id").distinct()
    with_id = docs.where(F.col(doc_id).isNotNull())
    stay = with_id.join(kept, with_id[doc_id].cast("long") == kept["doc_id"], "left_semi").dropDuplicates([doc_id])
    return stay.unionByName(docs.where(F.col(doc_id).isNull()))
