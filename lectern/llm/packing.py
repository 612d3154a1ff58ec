"""Packing of token ids into sequences: balanced by cost, or best fit with full outputs."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches, row_groups, text_bytes
from lectern.llm.token_ids import BLOCK_BYTES, Vocabulary, worker_pieces

# Tokens that are packed together; a task holds no more than this and one document.
GROUP_TOKENS = 1 << 22


@dataclass
class Group:
    """Documents whose ids lie in ``ids[places[i]:places[i + 1]]``."""

    doc_ids: list
    ids: np.ndarray
    places: np.ndarray


# document number in its group, start in it, length
Piece = tuple[int, int, int]


def attention_cost(length: int, linear: float, quadratic: float) -> float:
    """What a piece costs: some work for each token and some for each pair of them."""
    return linear * length + quadratic * length * length


class Capacities:
    """Open sequences by the room they have left, over a segment tree of minima."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.tree: list = [None] * (2 * self.base)
        self.at: list[list] = [[] for _ in range(most + 1)]

    def _renew(self, room: int) -> None:
        tree, k = self.tree, self.base + room
        tree[k] = (*self.at[room][0], room) if self.at[room] else None
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = b if a is None or b is not None and b < a else a

    def put(self, room: int, key: float, sequence: int) -> None:
        heapq.heappush(self.at[room], (key, sequence))
        self._renew(room)

    def take(self, room: int) -> tuple[float, int]:
        found = heapq.heappop(self.at[room])
        self._renew(room)
        return found

    def least_key(self, size: int) -> int | None:
        """The room of the sequence with the lowest key among those that have ``size`` left."""
        lo, hi, best = self.base + size, 2 * self.base, None
        while lo < hi:
            if lo & 1:
                if self.tree[lo] is not None and (best is None or self.tree[lo] < best):
                    best = self.tree[lo]
                lo += 1
            lo, hi = lo >> 1, hi >> 1
        return best[2] if best else None

    def least_room(self, size: int) -> int | None:
        """The smallest room of at least ``size`` that some sequence has left."""
        k = self.base + size
        while self.tree[k] is None:
            while k & 1:
                k >>= 1
            if k <= 1:
                return None
            k += 1
        while k < self.base:
            k = 2 * k if self.tree[2 * k] is not None else 2 * k + 1
        return k - self.base


def overlong_cut(lengths: np.ndarray, capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences cut from long documents, and what is left, longest first."""
    full, rest = [], []
    for i, n in enumerate(lengths.tolist()):
        full.extend([(i, k, capacity)] for k in range(0, n - capacity + 1, capacity))
        if n % capacity:
            rest.append((i, n - n % capacity, n % capacity))
    rest.sort(key=lambda p: (-p[2], p[0]))
    return full, rest


def cost_balanced(lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1 / 512) -> list[list[Piece]]:
    """Sequences of pieces, of like cost and without padding.

    As many sequences as the tokens fill are open from the start. Documents in
    descending order each go to the sequence of lowest cost that has room; what
    fits nowhere whole is cut into the rooms that are left, lowest cost first,
    and the tokens beyond the last full sequence make sequences whose lengths
    are powers of two.
    """
    sequences, rest = overlong_cut(lengths, capacity)
    total = sum(p[2] for p in rest)
    made: list[list[Piece]] = [[] for _ in range(total // capacity)]
    costs, rooms = [0.0] * len(made), [capacity] * len(made)
    free, unplaced = Capacities(capacity), []
    for k in range(len(made)):
        free.put(capacity, 0.0, k)
    for piece in rest:
        room = free.least_key(piece[2])
        if room is None:
            unplaced.append(piece)
            continue
        _, k = free.take(room)
        made[k].append(piece)
        costs[k] += attention_cost(piece[2], linear, quadratic)
        rooms[k] -= piece[2]
        if rooms[k]:
            free.put(rooms[k], costs[k], k)
    unplaced.reverse()
    gaps = [(made[k], rooms[k]) for k in sorted(range(len(made)), key=lambda k: (costs[k], k)) if rooms[k]]
    for bit in reversed(range(capacity.bit_length())):
        if total % capacity >> bit & 1:
            made.append([])
            gaps.append((made[-1], 1 << bit))
    for into, room in gaps:
        while room:
            i, start, n = unplaced.pop()
            into.append((i, start, min(n, room)))
            if n > room:
                unplaced.append((i, start + room, n - room))
            room -= min(n, room)
    return sequences + made


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[Piece]]:
    """Sequences of pieces: longest first, each into the sequence with the least room that holds it, else a new one."""
    sequences, rest = overlong_cut(lengths, capacity)
    free = Capacities(capacity)
    for piece in rest:
        room = free.least_room(piece[2])
        if room is None:
            room, k = capacity, len(sequences)
            sequences.append([])
        else:
            _, k = free.take(room)
        sequences[k].append(piece)
        if room > piece[2]:
            free.put(room - piece[2], 0.0, k)
    return sequences


def token_groups(it: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end: int | None, most: int) -> Iterator[Group]:
    """The documents of a partition as groups of about ``most`` tokens."""
    encoder, doc_ids, parts, sizes, held = worker_pieces(vocabulary), [], [], [], 0

    def group():
        return Group(list(doc_ids), np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))

    for batch in it:
        data, starts = text_bytes(batch.column(1))
        ids = batch.column(0).to_pylist()
        for lo, hi in row_groups(starts, BLOCK_BYTES):
            out, places = encoder.encode(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], end)
            doc_ids.extend(ids[lo:hi]), parts.append(out), sizes.extend(np.diff(places).tolist())
            held += len(out)
            if held >= most:
                yield group()
                doc_ids.clear(), parts.clear(), sizes.clear()
                held = 0
    if doc_ids:
        yield group()


def _packed(docs: DataFrame, doc_id: str, text: str, vocabulary, end, group_tokens, pack: Callable, rows: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for group in token_groups(it, vocabulary, end, group_tokens):
            sequences = pack(np.diff(group.places))
            for lo in range(0, len(sequences), 2048):
                yield batches(rows(group, sequences[lo : lo + 2048], number + lo), schema)
            number += len(sequences)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, ddl)


def pack_by_cost(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end: int | None = 0,
    linear: float = 1.0, quadratic: float = 1 / 512, vocabulary: Vocabulary = Vocabulary(), group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Tasks pack what they read, in groups of about ``group_tokens``; nothing is
    shuffled. All sequences are full but for those of a group's last tokens,
    whose lengths are powers of two. ``sequence_id`` is unique, not dense. A null
    or empty text is the id ``end`` alone (without one it has no row). Rows
    without doc_id keep a null there; repeated rows are packed each for itself;
    an empty table gives an empty result; other columns are not read.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def rows(group: Group, sequences: list[list[Piece]], first: int) -> dict:
        out = {c: [] for c in schema.names}
        raw = memoryview(group.ids.astype("<u4").view(np.uint8))
        for k, pieces in enumerate(sequences):
            offset = 0
            for i, start, n in pieces:
                at = int(group.places[i]) + start
                values = (group.doc_ids[i], start, n, zlib.crc32(raw[4 * at : 4 * (at + n)]), int(group.places[i + 1] - group.places[i]), first + k, offset)
                for column, value in zip(out.values(), values):
                    column.append(value)
                offset += n
        return out

    ddl = ", ".join(f"{c} long" for c in schema.names)
    return _packed(docs, doc_id, text, vocabulary, end, group_tokens, lambda n: cost_balanced(n, capacity, linear, quadratic), rows, schema, ddl)


def pack_best_fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024, end: int | None = None, pad: int = 0,
    vocabulary: Vocabulary = Vocabulary(), group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per sequence: its line of the id matrix and how it is cut.

    ``sequence_id, n_tokens, ids, positions, cu_seqlens, doc_ids, starts``:
    ``ids`` are ``capacity`` little-endian unsigned 16-bit numbers (32-bit if the
    vocabulary is larger), ``pad`` beyond ``n_tokens``; ``positions`` count from 0
    within each piece, as 16 bits (32 if the capacity is larger), and are 0 in the
    padding; ``cu_seqlens`` are the pieces' ends, from 0; ``doc_ids`` and ``starts``
    tell which part of which document each piece is, so documents can be put
    together again. Texts with no ids (null, empty) have no piece. Rows without
    doc_id keep a null; repeated rows are packed each for itself; an empty table
    gives an empty result; other columns are not read.
    """
    fields = [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary())]
    fields += [("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))]
    schema = pa.schema(fields)
    place = "<u2" if capacity <= 1 << 16 else "<u4"

    def rows(group: Group, sequences: list[list[Piece]], first: int) -> dict:
        out = {c: [] for c in schema.names}
        kind = "<u2" if max(worker_pieces(vocabulary).whole.get_vocab_size(), (end or 0) + 1, pad + 1) <= 1 << 16 else "<u4"
        for k, pieces in enumerate(sequences):
            line, at, ends = np.full(capacity, pad, kind), np.zeros(capacity, place), [0]
            for i, start, n in pieces:
                begin = int(group.places[i]) + start
                line[ends[-1] : ends[-1] + n] = group.ids[begin : begin + n]
                at[ends[-1] : ends[-1] + n] = np.arange(n)
                ends.append(ends[-1] + n)
            values = (first + k, ends[-1], line.tobytes(), at.tobytes(), ends, [group.doc_ids[p[0]] for p in pieces], [p[1] for p in pieces])
            for column, value in zip(out.values(), values):
                column.append(value)
        return out

    ddl = "sequence_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, starts array<long>"
    return _packed(docs, doc_id, text, vocabulary, end, group_tokens, lambda n: best_fit(n, capacity), rows, schema, ddl)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet, one row per line of the matrix."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def id_matrix(lines: list[bytes], capacity: int) -> np.ndarray:
    """The ``ids`` or ``positions`` of some sequences as a matrix."""
    width = len(lines[0]) // capacity if lines else 2
    return np.frombuffer(b"".join(lines), f"<u{width}").reshape(-1, capacity)
