"""Exact substring deduplication with suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches, byte_codes, long_powers, mix, ragged, row_groups, span_hashes, text_bytes
from lectern.session import materialize

# Bytes of documents in one shard (or one longer document), and of pieces in one suffix array.
SHARD_BYTES, ARRAY_BYTES = 1 << 20, 1 << 21
# Bytes of documents for each bucket of pieces.
BUCKET_BYTES = 6_000_000
# Powers of two: bytes of shards whose keys, pieces and marks travel together. Each such load sends a row to each bucket.
LEAST_LOAD, MOST_LOAD = 20, 25
# Bytes that are compared, and string starts that are hashed at once.
CHECKED_BYTES, HASHED = 1 << 19, 1 << 15
# Bytes of the part of a string that decides its bucket.
PART = 16


def packed_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros beyond the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        wide = (wide[:-step] << np.uint64(8 * step)) | wide[step:]
    return wide[: len(data)]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order.

    Larsson-Sadakane refinement: groups of suffixes that agree so far are sorted
    by the ranks of what follows, while the length compared doubles; a suffix
    that is alone is never touched again.
    """
    n = len(data)
    words = packed_words(data)
    order = np.argsort(words)
    sorted_words = words[order]
    head = np.ones(n, bool)
    head[1:] = sorted_words[1:] != sorted_words[:-1]
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(head)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    compared = 8
    while True:
        size = np.diff(np.append(first, n))
        open_ = ragged(first[size > 1], size[size > 1])
        if not len(open_):
            break
        members = order[open_]
        ahead = members + compared
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[members] << 32 | follow
        turn = np.argsort(key)
        order[open_] = members[turn]
        key = key[turn]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        head[open_] = new
        first = np.flatnonzero(head)
        starts = np.flatnonzero(new)
        rank[order[open_]] = np.repeat(open_[starts], np.diff(np.append(starts, len(key))))
        compared *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lane: int = 128) -> np.ndarray:
    """How many bytes (up to ``most``) each suffix has in common with the one before it in order.

    Kasai's pass in text order, where each answer is at least the one before
    less one; the text is cut into lanes that advance together.
    """
    n = len(data)
    words = packed_words(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    out = np.zeros(n, np.int64)
    lanes = np.arange(0, n, lane)
    have = np.zeros(len(lanes), np.int64)
    for step in range(lane):
        at = lanes + step
        if at[-1] >= n:
            at, have, lanes = at[:-1], have[:-1], lanes[:-1]
            if not len(at):
                break
        other = np.where(place[at] > 0, order[place[at] - 1], n)
        have = np.maximum(have - 1, 0)
        have[other == n] = 0
        active = np.flatnonzero((other < n) & (have < most))
        while len(active):
            a, b = at[active] + have[active], other[active] + have[active]
            inside = np.minimum(n - a, n - b)
            differ = words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)]
            equal = sum((differ < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(8))
            gain = np.minimum(np.minimum(equal, inside), most - have[active])
            have[active] += gain
            active = active[(gain == 8) & (have[active] < most)]
        out[place[at]] = have
    return out


def squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers with all first bytes, then all second bytes and so on, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def different(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each stretch of bytes (by place) among the different ones, and where each of these is first found."""
    hashes, codes, last = np.empty(len(first), np.uint64), byte_codes(), first + sizes
    for lo, hi in row_groups(np.append(first, last[-1:]), CHECKED_BYTES):
        begin = first[lo]
        hashes[lo:hi] = span_hashes(data[begin : last[lo:hi].max()], first[lo:hi] - begin, last[lo:hi] - begin, codes)
    order = np.argsort(hashes)
    cut = np.ones(len(order), bool)
    cut[1:] = hashes[order[1:]] != hashes[order[:-1]]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(cut) - 1
    head = np.minimum.reduceat(order, np.flatnonzero(cut)) if len(order) else order
    again = np.flatnonzero(head[number] != np.arange(len(number)))
    same = sizes == sizes[head[number]]
    for lo, hi in row_groups(np.concatenate([[0], np.cumsum(sizes[again])]), CHECKED_BYTES):
        k = again[lo:hi][same[again[lo:hi]]]
        if len(k):
            equal = data[ragged(first[k], sizes[k])] == data[ragged(first[head[number[k]]], sizes[k])]
            same[k] = np.logical_and.reduceat(equal, np.cumsum(sizes[k]) - sizes[k])
    # Stretches that share a hash with a different one stay apart, each for itself.
    odd = np.flatnonzero(~same)
    number[odd] = len(head) + np.arange(len(odd))
    return number, np.concatenate([head, odd])


@dataclass
class Runs:
    """Maximal runs of string starts of one document whose strings share their least part: the bytes of a run are a piece."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray


def string_runs(data: np.ndarray, starts: np.ndarray, size: int) -> Runs:
    """The runs of all strings of ``size`` bytes, by the least hash of the parts they hold.

    Equal strings hold equal parts, so they have equal keys wherever they are.
    """
    span, n = size - PART + 1, max(0, len(data) - size + 1)
    if not n:
        return Runs(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64))
    up, down = long_powers(HASHED + size)
    codes, key = byte_codes(), np.empty(n, np.uint64)
    for begin in range(0, n, HASHED):
        text = data[begin : begin + HASHED + size - 1]
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(codes[text] * up[: len(text)], out=total[1:])
        least = mix((total[PART:] - total[:-PART]) * down[: len(text) - PART + 1])
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        key[begin : begin + HASHED] = least
    # Runs begin at documents too, also without a gap between their strings (of exactly size bytes), and where their last strings end.
    cut = np.ones(n, bool)
    cut[1:] = key[1:] != key[:-1]
    edges = np.concatenate([starts[:-1], np.maximum(starts[1:] - size + 1, starts[:-1])])
    cut[edges[edges < n]] = True
    first = np.flatnonzero(cut)
    row = np.searchsorted(starts, first, "right") - 1
    last = np.append(first[1:], n) - 1
    keep = first + size <= starts[row + 1]
    return Runs(row[keep], first[keep], last[keep], mix(key[first[keep]] + np.uint64(1)))


class Shard:
    """Some whole documents, as one row carries them."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"]), np.uint8)

    def runs(self, size: int) -> Runs:
        runs = string_runs(self.data, self.starts, size)
        keep = self.known[runs.row]
        return Runs(runs.row[keep], runs.first[keep], runs.last[keep], runs.key[keep])

    def pieces(self, size: int, shared: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
        """The runs whose keys are shared, the number of the piece of each, and each piece's first run and least document."""
        runs = self.runs(size)
        keep = shared[np.minimum(np.searchsorted(shared, runs.key), len(shared) - 1)] == runs.key if len(shared) else np.zeros(len(runs.key), bool)
        runs = Runs(runs.row[keep], runs.first[keep], runs.last[keep], runs.key[keep])
        number, head = different(self.data, runs.first, runs.last - runs.first + size)
        least = np.full(len(head), np.iinfo(np.int64).max)
        np.minimum.at(least, number, self.doc_ids[runs.row])
        return runs, number, head, least


def shards_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents in shards; the number of a shard tells its task and, in bytes, its place there."""
    schema = pa.schema([("shard", pa.int64()), ("bytes", pa.int64()), ("doc_ids", pa.binary()), ("known", pa.binary()), ("sizes", pa.binary()), ("body", pa.binary())])

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, pack = TaskContext.get().partitionId() << 40, zstandard.ZstdCompressor(level=1)
        for batch in it:
            data, starts = text_bytes(batch.column(1))
            ids = batch.column(0)
            known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for lo, hi in row_groups(starts, SHARD_BYTES):
                body = data[starts[lo] : starts[hi]].tobytes()
                row = {"shard": [number], "bytes": [len(body)], "doc_ids": [ids[lo:hi].astype(np.int64).tobytes()], "known": [known[lo:hi].tobytes()]}
                yield batches(row | {"sizes": [np.diff(starts[lo : hi + 1]).tobytes()], "body": [pack.compress(body)]}, schema)
                number += max(1, len(body))

    ddl = "shard long, bytes long, doc_ids binary, known binary, sizes binary, body binary"
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, ddl)


def load_bits(total: int) -> int:
    """The power of two of a load's bytes: some 256 loads, if they are neither small nor too large for a task.

    Rows between loads and buckets grow with the product of the two, so that a
    load of each shard would make them grow with the square of the input.
    """
    return min(MOST_LOAD, max(LEAST_LOAD, (total >> 8).bit_length()))


def load_keys(shards: DataFrame, size: int, buckets: int) -> DataFrame:
    """``bucket, load, keys, many``: the different keys of each load, and whether several of its documents have them."""
    schema = pa.schema([("bucket", pa.int32()), ("load", pa.int64()), ("keys", pa.binary()), ("many", pa.binary())])

    def told(load: int, every: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        keys, ids = np.concatenate(every), np.concatenate(ids)
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        cut = np.ones(len(keys), bool)
        cut[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(cut)
        many = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first) if len(first) else cut
        keys = keys[first]
        own = (keys % np.uint64(buckets)).astype(np.int32)
        turn = np.argsort(own, kind="stable")
        which, cuts = np.unique(own[turn], return_index=True)
        parts = np.split(turn, cuts[1:]) if len(which) else []
        return batches({"bucket": which, "load": np.full(len(which), load), "keys": [keys[p].tobytes() for p in parts], "many": [many[p].tobytes() for p in parts]}, schema)

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load, keys, ids = None, [], []
        for batch in it:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if keys and row["load"] != load:
                    yield told(load, keys, ids)
                    keys, ids = [], []
                load, shard = row["load"], Shard(row)
                runs = shard.runs(size)
                keys.append(runs.key)
                ids.append(shard.doc_ids[runs.row])
        if keys:
            yield told(load, keys, ids)

    return shards.mapInArrow(work, "bucket int, load long, keys binary, many binary")


def shared_keys(keys: DataFrame) -> DataFrame:
    """``load, keys``: of each load's keys those that some other document has too."""
    schema = pa.schema([("load", pa.int64()), ("keys", pa.binary())])

    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        every = np.concatenate(parts)
        many = np.concatenate([np.frombuffer(r["many"], bool) for r in rows])
        order = np.argsort(every)
        found = every[order]
        twice = np.zeros(len(found), bool)
        twice[1:] = found[1:] == found[:-1]
        twice[:-1] |= twice[1:]
        shared = many.copy()
        shared[order] |= twice
        # A key that several documents of one load have is shared wherever it is; twice tells those of several loads.
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        kept = [p[s] for p, s in zip(parts, np.split(shared, cuts))]
        full = [i for i, p in enumerate(kept) if len(p)]
        return pa.table({"load": pa.array([rows[i]["load"] for i in full], pa.int64()), "keys": pa.array([np.sort(kept[i]).tobytes() for i in full], pa.binary())}, schema=schema)

    return keys.groupBy("bucket").applyInArrow(work, "load long, keys binary")


def _shards(table: pa.Table) -> Iterator[Shard]:
    """The shards of a load in order, one at a time."""
    for k in np.argsort(table["shard"].to_numpy()).tolist():
        yield Shard(table.slice(k, 1).to_pylist()[0])


def _keys(keys: list[bytes]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(k, np.uint64) for k in keys)]))


def shared_pieces(shards: DataFrame, shared: DataFrame, size: int, buckets: int) -> DataFrame:
    """``bucket, load, numbers, keys, least, sizes, body``: each different piece with a shared key, once for a shard.

    Pieces of a load are numbered throughout, shard after shard.
    """
    schema = pa.schema([("bucket", pa.int32()), ("load", pa.int64()), *((c, pa.binary()) for c in ("numbers", "keys", "least", "sizes", "body"))])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out, found = {c: [] for c in schema.names}, []
        if left.num_rows and right.num_rows:
            known = _keys(right["keys"].to_pylist())
            for shard in _shards(left):
                runs, _, head, least = shard.pieces(size, known)
                sizes = runs.last[head] - runs.first[head] + size
                found.append((runs.key[head], least, sizes, shard.data[ragged(runs.first[head], sizes)]))
        if found:
            pack = zstandard.ZstdCompressor(level=1)
            keys, least, sizes, data = map(np.concatenate, zip(*found))
            first = np.cumsum(sizes) - sizes
            own = (keys % np.uint64(buckets)).astype(np.int32)
            turn = np.argsort(own, kind="stable")
            which, cuts = np.unique(own[turn], return_index=True)
            for bucket, part in zip(which.tolist(), np.split(turn, cuts[1:]) if len(which) else []):
                body = data[ragged(first[part], sizes[part])].tobytes()
                numbers, high = np.diff(part, prepend=0), (keys[part] >> np.uint64(32)).astype(np.int64)
                values = (bucket, left["load"][0].as_py(), squeezed(numbers), squeezed(high), squeezed(least[part]), squeezed(sizes[part]), pack.compress(body))
                for column, value in zip(out.values(), values):
                    column.append(value)
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in schema}, schema=schema)

    ddl = "bucket int, load long, numbers binary, keys binary, least binary, sizes binary, body binary"
    return shards.groupBy("load").cogroup(shared.groupBy("load")).applyInArrow(work, ddl)


def least_documents(data: np.ndarray, starts: np.ndarray, least: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some pieces: the places of all strings, the number of each one's text, and for each text (in order) its place and least document."""
    order = suffix_array(data)
    common = common_prefixes(data, order, size)
    valid = np.zeros(len(data), bool)
    valid[ragged(starts[:-1], np.diff(starts) - size + 1)] = True
    # Texts end where neighbours have less in common, whether or not the suffixes between are strings.
    group = np.cumsum(common < size) - 1
    keep = valid[order]
    at, group = order[keep], group[keep]
    _, group = np.unique(group, return_inverse=True)
    piece = np.searchsorted(starts, at, "right") - 1
    low = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, group, least[piece])
    place = np.empty(len(low), np.int64)
    place[group[::-1]] = at[::-1]
    return at, group, place, low


def string_owners(pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: int) -> list[np.ndarray]:
    """For each block (bytes, starts, least documents of its pieces) and byte where a string begins the least document of any block that has it.

    Each block has a suffix array of its own; their sorted texts are merged by
    binary search.
    """
    found = [(*least_documents(data, starts, least, size), data) for data, starts, least in pieces]
    if len(found) > 1:
        texts = [np.ascontiguousarray(data[place[:, None] + np.arange(size)]).view(f"S{size}").ravel() for _, _, place, _, data in found]
        every, low = texts[0], found[0][3].copy()
        for text, (_, _, _, own, _) in zip(texts[1:], found[1:]):
            at = np.searchsorted(every, text)
            hit = every[np.minimum(at, len(every) - 1)] == text
            np.minimum.at(low, at[hit], own[hit])
            every, low = np.insert(every, at[~hit], text[~hit]), np.insert(low, at[~hit], own[~hit])
        found = [(at, group, place, low[np.searchsorted(every, text)], data) for text, (at, group, place, _, data) in zip(texts, found)]
    owners = []
    for at, group, _, low, data in found:
        owner = np.full(len(data), np.iinfo(np.int64).max)
        owner[at] = low[group]
        owners.append(owner)
    return owners


def repeated_strings(data: np.ndarray, first: np.ndarray, strings: np.ndarray, size: int) -> np.ndarray:
    """For each string of some pieces (by place), one after the other, whether another has its hash. The rest have no equal."""
    codes, hashes = byte_codes(), []
    for lo, hi in row_groups(np.append(first, first[-1:] + strings[-1:] + size - 1), CHECKED_BYTES):
        begin = first[lo]
        at = ragged(first[lo:hi] - begin, strings[lo:hi])
        hashes.append(span_hashes(data[begin : begin + at[-1] + size], at, at + size, codes))
    every = np.concatenate(hashes)
    order = np.argsort(every)
    equal = every[order[1:]] == every[order[:-1]]
    twice = np.zeros(len(every), bool)
    twice[order[1:]] = equal
    twice[order[:-1]] |= equal
    return twice


def first_owners(data: np.ndarray, first: np.ndarray, strings: np.ndarray, low: np.ndarray, size: int, most: int) -> np.ndarray:
    """For each string of some different pieces, one after the other, the least document of any piece that has it.

    A string whose hash no other has is its piece's own; the others go, in runs,
    into suffix arrays of up to ``most`` bytes each.
    """
    owner = np.repeat(low, strings)
    at = np.flatnonzero(repeated_strings(data, first, strings, size))
    if not len(at):
        return owner
    ends = np.cumsum(strings)
    piece = np.searchsorted(ends, at, "right")
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (piece[1:] != piece[:-1])
    begin = np.flatnonzero(cut)
    piece, lengths = piece[begin], np.diff(np.append(begin, len(at)))
    begin = first[piece] + at[begin] - (ends - strings)[piece]
    cuts, blocks = np.concatenate([[0], np.cumsum(lengths + size - 1)]), []
    for a, b in row_groups(cuts, most):
        blocks.append((data[ragged(begin[a:b], lengths[a:b] + size - 1)], cuts[a : b + 1] - cuts[a], low[piece[a:b]]))
    owner[at] = np.concatenate(string_owners(blocks, size))[ragged(cuts[:-1], lengths)]
    return owner


def marked_pieces(pieces: DataFrame, size: int, most: int = ARRAY_BYTES) -> DataFrame:
    """``load, numbers, sizes, marks``: for pieces with strings that a smaller document has, where these begin (packed bits).

    Equal pieces of several shards are one from here on. A piece that is the
    only one with its key has all occurrences of its strings; of the others,
    strings whose hash comes twice go into the suffix arrays.
    """
    schema = pa.schema([("load", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("marks", pa.binary())])

    def work(table: pa.Table) -> pa.Table:
        rows = table.select(["load", "numbers", "keys", "least", "sizes", "body"]).to_pylist()
        open_ = zstandard.ZstdDecompressor()
        data = np.concatenate([np.frombuffer(open_.decompress(r["body"]), np.uint8) for r in rows])
        own_sizes = [unsqueezed(r["sizes"]) for r in rows]
        sizes, least = np.concatenate(own_sizes), np.concatenate([unsqueezed(r["least"]) for r in rows])
        first = np.cumsum(sizes) - sizes
        number, head = different(data, first, sizes)
        low = np.full(len(head), np.iinfo(np.int64).max)
        np.minimum.at(low, number, least)
        _, of, among = np.unique(np.concatenate([unsqueezed(r["keys"]) for r in rows])[head], return_inverse=True, return_counts=True)
        alone = among[of] == 1
        # Places of the strings of pieces that are not alone, one after the other; the others have none.
        met = np.flatnonzero(~alone)
        met = met[np.argsort(head[met])]
        strings = sizes[head[met]] - size + 1
        starts = np.zeros(len(head), np.int64)
        starts[met] = np.cumsum(strings) - strings
        owner = first_owners(data, first[head[met]], strings, low[met], size, most) if len(met) else np.zeros(0, np.int64)
        mark = np.zeros(len(data), bool)
        for a, b in row_groups(np.concatenate([[0], np.cumsum(sizes)]), CHECKED_BYTES):
            k, strings = np.arange(a, b), sizes[a:b] - size + 1
            at, lone = ragged(first[a:b], strings), np.repeat(alone[number[k]], strings)
            owned = np.repeat(low[number[k]], strings)
            place = ragged(starts[number[k]], strings)[~lone]
            owned[~lone] = owner[place] if len(place) else 0
            mark[at] = owned < np.repeat(least[k], strings)
        some = np.logical_or.reduceat(mark, first)
        out, at = {c: [] for c in schema.names}, 0
        for row, own in zip(rows, own_sizes):  # own: sizes of the row's pieces
            keep = some[at : at + len(own)]
            if keep.any():
                bits = mark[ragged(first[at : at + len(own)][keep], own[keep])]
                numbers = np.cumsum(unsqueezed(row["numbers"]))[keep]
                packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())
                values = (row["load"], squeezed(np.diff(numbers, prepend=0)), squeezed(own[keep]), packed)
                for column, value in zip(out.values(), values):
                    column.append(value)
            at += len(own)
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in schema}, schema=schema)

    return pieces.groupBy("bucket").applyInArrow(work, "load long, numbers binary, sizes binary, marks binary")


class Marks:
    """Where marked strings begin in the pieces of a load, from one row for each bucket."""

    def __init__(self, rows: list[dict]):
        numbers, begin, packed, total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)], 0
        for r in rows:
            sizes = unsqueezed(r["sizes"])
            numbers.append(np.cumsum(unsqueezed(r["numbers"])))
            begin.append(8 * total + np.cumsum(sizes) - sizes)
            packed.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(r["marks"]), np.uint8))
            total += len(packed[-1])
        self.packed, number = np.concatenate(packed), np.concatenate(numbers)
        order = np.argsort(number)
        self.number, self.begin = number[order], np.concatenate(begin)[order]

    def begins(self, base: int, n: int) -> np.ndarray:
        """The bit where the marks of each of ``n`` pieces from number ``base`` on begin, or -1."""
        lo, hi = np.searchsorted(self.number, [base, base + n])
        out = np.full(n, -1, np.int64)
        out[self.number[lo:hi] - base] = self.begin[lo:hi]
        return out

    def bits(self, at: np.ndarray) -> np.ndarray:
        return (self.packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def removed_bytes(shard: Shard, size: int, shared: np.ndarray, marks: Marks, base: int) -> tuple[np.ndarray, int]:
    """Which bytes of a shard are covered by a string of a smaller document, and how many pieces it has (numbered from ``base`` on)."""
    gone = np.zeros(len(shard.data) + 1, np.int64)
    runs, number, head, least = shard.pieces(size, shared)
    lengths = runs.last - runs.first + 1
    # Copies within the shard: whole runs of documents after the piece's first.
    later = shard.doc_ids[runs.row] > least[number]
    np.add.at(gone, runs.first[later], 1)
    np.add.at(gone, runs.last[later] + size, -1)
    begin = marks.begins(base, len(head))
    told = (begin[number] >= 0) & ~later
    at = ragged(runs.first[told], lengths[told])
    mark = marks.bits(ragged(begin[number[told]], lengths[told]))
    np.add.at(gone, at[mark], 1)
    np.add.at(gone, at[mark] + size, -1)
    return np.cumsum(gone[:-1]) > 0, len(head)


def drop_repeated_strings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 50, with_text: bool = True, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends`` (and ``kept``, the bytes left, with ``with_text``).

    A byte goes if a string of ``size`` bytes that covers it also begins in a
    document with a smaller doc_id; strings never cross documents and are judged
    on the input. Documents travel in shards. A string belongs to the least
    hash among its 16-byte parts; strings in a row with one such key are a
    piece. Keys of one document alone are dropped early (a key for each 18 bytes or
    so is shuffled); the pieces of the rest, each once for a shard, meet in buckets by
    key, where suffix arrays of blocks, merged by binary search, find the least
    document of each string. Marks of pieces go back to the shards. A passage
    that a third of the documents have is one piece a shard. Shards send and get
    all this in loads: a row between each load and each bucket.

    Texts that are null are empty. Rows without doc_id take no part and keep
    all; rows that repeat a doc_id do not remove each other; an empty table gives
    an empty result; other columns are not read.
    """
    if size < 2 * PART:
        raise ValueError("strings are too short")
    shards = materialize(shards_of(docs, doc_id, text), "text-shards")
    total = shards.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes), 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shards = shards.withColumn("load", F.shiftright("shard", load_bits(total)))
    shared = materialize(shared_keys(load_keys(shards, size, buckets)), "shared-keys")
    marks = marked_pieces(shared_pieces(shards, shared, size, buckets), size)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))] + [("kept", pa.binary())] * with_text
    schema = pa.schema(fields)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out, base, rows = {c: [] for c in schema.names}, 0, right.to_pylist()
        known, told = _keys([r["keys"] for r in rows if r["keys"] is not None]), Marks([r for r in rows if r["marks"] is not None])
        for shard in _shards(left) if left.num_rows else ():
            gone, n = removed_bytes(shard, size, known, told, base)
            base += n
            for k, (i, known_id) in enumerate(zip(shard.doc_ids.tolist(), shard.known.tolist())):
                own = gone[shard.starts[k] : shard.starts[k + 1]]
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False))
                kept = shard.data[shard.starts[k] : shard.starts[k + 1]][~own].tobytes()
                values = (i if known_id else None, len(own), int(own.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges[::2], edges[1::2], kept)
                for column, value in zip(out.values(), values):
                    column.append(value)
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in schema}, schema=schema)

    none = F.lit(None).cast("binary")
    told = shared.select("load", "keys", none.alias("numbers"), none.alias("sizes"), none.alias("marks"))
    told = told.unionByName(marks.select("load", none.alias("keys"), "numbers", "sizes", "marks"))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>" + ", kept binary" * with_text
    return shards.groupBy("load").cogroup(told.groupBy("load")).applyInArrow(work, ddl)
