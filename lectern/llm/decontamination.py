"""Benchmark decontamination by template windows with checked slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches, byte_codes, long_powers, mix, span_hashes
from lectern.llm.word_features import lowered, text_blocks, word_hash
from lectern.session import materialize

# Tokens of a window; items with fewer are one window, items under LEAST tokens are not looked for.
WINDOW, LEAST = 12, 5
# Words of a window of a longer text that are no slots, for the template alone to count; a whole item needs one.
LITERALS = 6
# Window hashes that travel with the function at once.
HASH_BLOCK = 1 << 20
# Units that may follow a number.
UNITS = (
    "mm cm m km inch inches ft feet yd yards mi mile miles mg g kg t lb lbs oz ml l gal gallon gallons ms s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years k c f w kw mw v a hz khz mhz ghz b kb mb gb tb usd eur gbp dollar dollars cent cents euro euros percent"
)
WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
STAND_IN = np.array([0, 0x6E756D62, 0x6E616D65, 0x756E6974], np.uint64)


class Tokens:
    """Words and numbers of some texts with their kinds and hashes, and the texts in lower case."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.low = low = lowered(data)
        digit = (data >= 48) & (data <= 57)
        inner = np.zeros(len(data), bool)
        inner[1:-1] = ((data[1:-1] == 44) | (data[1:-1] == 46)) & digit[:-2] & digit[2:]
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        kind = np.zeros(len(data), np.int8)
        kind[(low >= 97) & (low <= 122) | (low >= 0x80)] = 1
        kind[digit | inner] = 2
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | edge[1:-1]
        cuts = np.flatnonzero(change)
        first, last = cuts[:-1], cuts[1:]
        shown = kind[first] > 0 if len(first) else np.zeros(0, bool)
        self.first, self.last = first[shown], last[shown]
        self.row = np.searchsorted(starts, self.first, "right") - 1
        n = len(self.first)
        self.literal = span_hashes(low, self.first, self.last, byte_codes())
        self.kind = np.zeros(n, np.int64)
        if n:
            number = kind[self.first] == 2
            before = np.concatenate([[False], number[:-1] & (self.row[1:] == self.row[:-1]) & (self.first[1:] - self.last[:-1] <= 1)])
            units = np.array(sorted(word_hash(u) for u in UNITS.split()), np.uint64)
            unit = before & (units[np.minimum(np.searchsorted(units, self.literal), len(units) - 1)] == self.literal)
            stops = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(b".!?:\n", np.uint8)))])
            opens = np.ones(n, bool)
            opens[1:] = (self.row[1:] != self.row[:-1]) | (stops[self.first[1:]] > stops[self.last[:-1]])
            name = (low[self.first] != data[self.first]) & ~opens & (self.last - self.first > 1)
            second = np.minimum(self.first + 1, len(data) - 1)
            name |= (low[second] != data[second]) & (data[self.first] == 0xC3) & ~opens & (self.last - self.first > 2)
            self.kind[name], self.kind[unit], self.kind[number] = NAME, UNIT, NUMBER
        self.template = np.where(self.kind == WORD, self.literal, mix(STAND_IN[self.kind]))

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a window of ``size`` tokens of one text begins, and its hash."""
        at = np.flatnonzero(self.row[: len(self.row) - size + 1] == self.row[size - 1 :]) if len(self.row) >= size else np.zeros(0, np.int64)
        up, down = long_powers(len(hashes) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)])])
        return at, mix((total[at + size] - total[at]) * down[at] + np.uint64(size))

    def literals(self, size: int) -> np.ndarray:
        """How many plain words each place's window has (for places where one begins)."""
        plain = np.concatenate([[0], np.cumsum(self.kind == WORD)])
        return plain[np.minimum(np.arange(len(self.kind)) + size, len(self.kind))] - plain[:-1]

    def hash_at(self, hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the windows of ``size`` tokens that begin at given places."""
        begins, h = self.windows(hashes, size)
        return h[np.searchsorted(begins, at)]

    def slots(self, at: int, size: int) -> list[str]:
        """What fills the slots of a window, with their kinds."""
        places = at + np.flatnonzero(self.kind[at : at + size] != WORD)
        return [f"{self.kind[i]}:{self.low[self.first[i] : self.last[i]].tobytes().decode(errors='replace')}" for i in places]


def found_windows(tokens: Tokens, size: int, first_of_row: np.ndarray, only=None) -> dict[str, list]:
    """Rows for the windows of one size, literal and template ones; ``only`` tells which (kind, hashes) are wanted."""
    out = {c: [] for c in ("row", "pos", "literal", "hash", "slots")}
    for literal, hashes in ((True, tokens.literal), (False, tokens.template)):
        at, h = tokens.windows(hashes, size)
        if only:
            keep = only(literal, h)
        else:
            keep = np.ones(len(at), bool) if literal else tokens.literals(size)[at] >= (LITERALS if size == WINDOW else 1)
        at, h = at[keep], h[keep]
        row = tokens.row[at]
        out["row"].extend(row.tolist())
        out["pos"].extend((at - first_of_row[row]).tolist())
        out["literal"].extend([literal] * len(at))
        out["hash"].extend(h.view(np.int64).tolist())
        out["slots"].extend([[]] * len(at) if literal else [tokens.slots(i, size) for i in at.tolist()])
    return out


SCHEMA = [("pos", pa.int32()), ("size", pa.int32()), ("literal", pa.bool_()), ("hash", pa.int64()), ("slots", pa.list_(pa.string()))]
DDL = "pos int, size int, literal boolean, hash long, slots array<string>"


def whole_hashes(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of all tokens of each text, which are hashes[begin[i]:begin[i + 1]]."""
    each = (mix(np.bitwise_xor.reduce(mix(hashes[a:b] + np.arange(b - a, dtype=np.uint64)), keepdims=True)) for a, b in zip(begin, begin[1:]))
    return np.array([int(h[0]) for h in each], np.uint64).view(np.int64)


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id, wording, n_windows, entire`` and the windows of each benchmark item.

    ``n_windows`` are those whose template counts. Where that is under half of
    them, the whole item is one more window of its own size (``entire``), if it
    has a plain word.

    Items of one template are one group under their smallest id; each different
    wording of it has its own windows, under its own smallest id.
    """
    schema = pa.schema([("item_id", pa.int64()), ("n_windows", pa.int32()), ("entire", pa.bool_()), ("whole", pa.int64()), ("words", pa.int64()), *SCHEMA])

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = batch.column(0)
            for lo, hi, data, starts in text_blocks(batch.column(1)):
                tokens = Tokens(data, starts)
                begin = np.searchsorted(tokens.row, np.arange(hi - lo + 1))
                wholes, words = whole_hashes(tokens.template, begin), whole_hashes(tokens.literal, begin)
                sizes = np.diff(begin)
                plain = np.diff(np.concatenate([[0], np.cumsum(tokens.kind == WORD)])[begin])
                for size in range(LEAST, WINDOW + 1):
                    found = found_windows(tokens, size, begin[:-1])
                    row = np.array(found["row"], np.int64)
                    own = np.flatnonzero(sizes[row] >= size if size == WINDOW else sizes[row] == size)
                    row = row[own]
                    columns = {c: [found[c][i] for i in own] for c in ("pos", "literal", "hash", "slots")}
                    usable = np.bincount(row[~np.array(columns["literal"], bool)], minlength=hi - lo)
                    columns |= {"item_id": ids.take(pa.array(row + lo)), "n_windows": np.maximum(usable, 1)[row].astype(np.int32), "entire": np.zeros(len(own), bool), "whole": wholes[row], "words": words[row], "size": np.full(len(own), size, np.int32)}
                    yield batches(columns, schema)
                few = (sizes >= WINDOW) & (usable * 2 < sizes - WINDOW + 1) & (plain > 0)
                for size in np.unique(sizes[few]).tolist():
                    row = np.flatnonzero(few & (sizes == size))
                    columns = {"item_id": ids.take(pa.array(row + lo)), "n_windows": np.maximum(usable, 1)[row].astype(np.int32), "entire": np.ones(len(row), bool)}
                    columns |= {"whole": wholes[row], "words": words[row], "size": np.full(len(row), size, np.int32), "pos": np.zeros(len(row), np.int32), "literal": np.zeros(len(row), bool)}
                    columns |= {"hash": tokens.hash_at(tokens.template, begin[row], size).view(np.int64), "slots": [tokens.slots(i, size) for i in begin[row].tolist()]}
                    yield batches(columns, schema)

    found = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), F.col(text).cast("string"))
    found = materialize(found.mapInArrow(work, f"item_id long, n_windows int, entire boolean, whole long, words long, {DDL}"), "benchmark-windows")
    groups = found.groupBy("whole").agg(F.min("item_id").alias("group_id"))
    wordings = found.groupBy("whole", "words").agg(F.min("item_id").alias("wording"))
    named = found.join(groups, "whole").join(wordings, ["whole", "words"])
    return materialize(named.select(F.col("group_id").alias("item_id"), "wording", "n_windows", "entire", F.col("pos").alias("item_pos"), "size", "literal", "hash", F.col("slots").alias("item_slots")).distinct(), "benchmark-groups")


def document_windows(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, block: int = HASH_BLOCK) -> DataFrame:
    """``doc_id, k1, k2`` (a hash of the text) and the windows that some item has too.

    The different hashes of the items travel in blocks of about ``block``; each
    block is one pass over the documents.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), *SCHEMA])
    keys = wanted.select("size", "literal", "hash").distinct()
    total = keys.count()
    blocks = max(1, -(-total // block))
    source = docs.select(F.col(doc_id).cast("long"), F.xxhash64(text), F.xxhash64(F.lit(1), text), F.col(text).cast("string"))
    passes = []
    for b in range(blocks):
        own = keys.where(F.pmod("hash", F.lit(blocks)) == b).toArrow()
        size, literal, hashes = own["size"].to_numpy(), own["literal"].to_numpy(zero_copy_only=False), own["hash"].to_numpy().view(np.uint64)
        sets = {(int(s), kind): np.sort(hashes[(size == s) & (literal == kind)]) for s in np.unique(size) for kind in (True, False)}
        sets = {k: own for k, own in sets.items() if len(own)}

        def work(it: Iterator[pa.RecordBatch], sets=sets) -> Iterator[pa.RecordBatch]:
            tables = {}
            for key, own in sets.items():
                bits = 20 if len(own) > 1 << 10 else 14
                tables[key] = np.zeros(1 << bits, bool), np.uint64(64 - bits)
                tables[key][0][(own >> tables[key][1]).astype(np.int64)] = True

            def wanted_by(size):
                def only(kind, h):
                    if (size, kind) not in sets:
                        return np.zeros(len(h), bool)
                    own, (table, shift) = sets[size, kind], tables[size, kind]
                    found = table[(h >> shift).astype(np.int64)]
                    some = np.flatnonzero(found)
                    if len(some):
                        found[some] = own[np.minimum(np.searchsorted(own, h[some]), len(own) - 1)] == h[some]
                    return found

                return only

            for batch in it:
                for lo, hi, data, starts in text_blocks(batch.column(3)):
                    tokens = Tokens(data, starts)
                    begin = np.searchsorted(tokens.row, np.arange(hi - lo))
                    for size in sorted({s for s, _ in sets}):
                        found = found_windows(tokens, size, begin, wanted_by(size))
                        if found["row"]:
                            at = pa.array(np.array(found.pop("row"), np.int64) + lo)
                            ids = {c: batch.column(i).take(at) for i, c in enumerate(("doc_id", "k1", "k2"))}
                            yield batches(ids | found | {"size": np.full(len(at), size, np.int32)}, schema)

        passes.append(source.mapInArrow(work, f"doc_id long, k1 long, k2 long, {DDL}"))
    out = passes[0]
    for more in passes[1:]:
        out = out.union(more)
    return out


def leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    share: float = 0.5, block: int = HASH_BLOCK,
) -> DataFrame:
    """``doc_id, item_id, n_windows, literal_windows, template_windows, changed_slots, first_token, last_token, k1, k2``.

    One row for each document and benchmark item (the smallest id of its
    template) of which it holds a window of twelve words as it is, or at least
    ``share`` of the windows up to numbers, names and units, where equal slots of
    the item are equal in the document over all of them, and different names
    stay different (numbers and units may become equal). Windows are of one wording of the
    template and at one distance in both texts. Of the windows up to slots those with six plain words count and are
    ``n_windows``; where they are under half of an item's windows, the whole item
    up to slots tells it too. Items of under twelve words count as one window,
    those of under five are not looked for, those of slots alone as they are only. Case, white space and punctuation do not count. Null
    and empty texts hold and are nothing; items without id are left out, rows
    without doc_id keep a null; repeated rows give one row; empty tables give an
    empty result; other columns are not read.
    """
    wanted = item_windows(items, item_id, item_text)
    found = document_windows(docs, doc_id, text, wanted, block)
    both = found.join(wanted, ["size", "literal", "hash"])
    pairs = F.arrays_zip("item_slots", "slots")
    runs = both.groupBy("doc_id", "k1", "k2", "item_id", "wording", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.max("n_windows").alias("n_windows"),
        F.size(F.collect_set(F.when(F.col("literal"), F.col("pos")))).alias("literal_windows"),
        F.size(F.collect_set(F.when(~F.col("literal") & ~F.col("entire"), F.col("pos")))).alias("template_windows"),
        F.max("entire").alias("entire"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("literal"), pairs)))).alias("pairs"),
        F.min("pos").alias("first_token"),
        F.max(F.col("pos") + F.col("size") - 1).alias("last_token"),
    )
    names = F.filter("pairs", lambda p: p["slots"].startswith(f"{NAME}:"))
    consistent = (F.size("pairs") == F.size(F.array_distinct("pairs.item_slots"))) & (F.size(names) == F.size(F.array_distinct(names["slots"])))
    changed = F.size(F.filter("pairs", lambda p: p["item_slots"] != p["slots"]))
    told = runs.where((F.col("literal_windows") > 0) | (consistent & (F.col("entire") | (F.col("template_windows") >= F.col("n_windows") * share))))
    told = told.withColumn("template_windows", F.greatest("template_windows", F.col("entire").cast("int")))
    best = told.withColumn("changed_slots", changed).drop("pairs", "entire")
    columns = ["n_windows", "literal_windows", "template_windows", "changed_slots", "first_token", "last_token"]
    order = F.struct("literal_windows", "template_windows", (-F.col("first_token")).alias("early"), "n_windows", "changed_slots", "first_token", "last_token")
    top = best.groupBy("doc_id", "k1", "k2", "item_id").agg(F.max(order).alias("top"))
    return top.select("doc_id", "item_id", *[F.col(f"top.{c}").alias(c) for c in columns], "k1", "k2")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose texts hold no benchmark item, with their columns; texts are told apart by two hashes."""
    marked = leaks(docs, items, doc_id, text).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    same = (F.xxhash64(docs[text]) == F.col("_k1")) & (F.xxhash64(F.lit(1), docs[text]) == F.col("_k2"))
    return docs.join(marked, same, "left_anti")
