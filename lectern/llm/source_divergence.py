"""How the sources of each language differ in their words, from in-mapper stripes.

A task folds whole documents into stripes: for each language and term the
number of documents and the occurrences by source. Stripes spill when they grow
too large, are merged by language and term, and the merged stripes give the
divergences without ever being joined with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.arrow import batches, ragged, row_groups, text_bytes
from lectern.operators.joins import has_at_most
from lectern.session import materialize

# Probabilities are counted in parts of this.
PARTS = 1_000_000_000
# Documents a term needs within its language.
LEAST_DOCS = 3
# Best terms of each source.
TOP_TERMS = 200
# Cells (term, source) that a task holds before it spills, and pairs of sources that it works on at once.
CELLS, PAIRS = 2_000_000, 1 << 20
# Most sources (with their languages) that travel with the function; the totals of more are joined to the stripes.
CARRIED_SOURCES = 100_000

STRIPES = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
STRIPES_DDL = "lang string, term string, df long, sources array<string>, counts array<long>"
EMITTED = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
EMITTED_DDL = "part string, lang string, source string, item string, value long"


def block_terms(data: np.ndarray, starts: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of some texts (runs of letters and of bytes beyond ASCII, A to Z in lower case) and the row of each."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    letter = (low >= 97) & (low <= 122) | (low >= 0x80)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = letter.copy()
    begins[1:] &= ~letter[:-1] | edge[1:-1]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    places = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    joined = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(places), pa.py_buffer(low[letter])])
    return joined.dictionary_encode(), np.searchsorted(starts, first, "right") - 1


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and each column's sums by key."""
    each, at = np.unique(key, return_inverse=True)
    out = []
    for v in values:
        total = np.zeros(len(each), np.int64)
        np.add.at(total, at, v)
        out.append(total)
    return each, *out


class Stripes:
    """The cells (language and source, term) -> (documents, occurrences) of a task."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[pa.Table] = []
        self.cells = 0

    def add(self, lang: pa.Array, source: pa.Array, text: pa.Array) -> None:
        names = list(zip(lang.to_pylist(), source.to_pylist()))
        group = np.array([self.groups.setdefault(n, len(self.groups)) for n in names], np.int64)
        data, starts = text_bytes(text)
        for lo, hi in row_groups(starts):
            terms, row = block_terms(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
            if not len(terms):
                continue
            kinds = len(terms.dictionary)
            pair, count = np.unique(row * kinds + terms.indices.to_numpy(), return_counts=True)
            cell, docs, total = summed(group[lo:hi][pair // kinds] * kinds + pair % kinds, np.ones(len(pair), np.int64), count)
            self.parts.append(pa.table({"g": cell // kinds, "term": terms.dictionary.take(pa.array(cell % kinds)), "n": docs, "c": total}))
            self.cells += len(cell)

    def fold(self) -> None:
        table = pa.concat_tables(self.parts).group_by(["g", "term"]).aggregate([("n", "sum"), ("c", "sum")])
        self.parts = [table.rename_columns(["g", "term", "n", "c"])]
        self.cells = table.num_rows

    def is_full(self) -> bool:
        if self.cells > self.most:
            self.fold()
        return self.cells > self.most // 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All stripes; nothing is held afterwards."""
        if self.parts:
            self.fold()
            held = self.parts[0].combine_chunks()
            names = list(self.groups)
            numbers = {lang: k for k, lang in enumerate(sorted({lang for lang, _ in names}))}
            langs, lang_of = list(numbers), np.array([numbers[lang] for lang, _ in names], np.int64)
            source_of = pa.array([s for _, s in names], pa.string())
            terms = held["term"].combine_chunks().dictionary_encode()
            kinds, g = len(terms.dictionary), held["g"].to_numpy()
            key = lang_of[g] * kinds + terms.indices.to_numpy()
            order = np.argsort(key, kind="stable")
            key, g, n, c = key[order], g[order], held["n"].to_numpy()[order], held["c"].to_numpy()[order]
            begins = np.flatnonzero(np.diff(key, prepend=-1))
            ends = np.append(begins[1:], len(key))
            for lo in range(0, len(begins), 1 << 16):
                b, e = begins[lo : lo + (1 << 16)], ends[lo : lo + (1 << 16)]
                places = pa.array(np.append(b, e[-1]) - b[0], pa.int32())
                cells = slice(int(b[0]), int(e[-1]))
                yield batches(
                    {
                        "lang": pa.array(langs, pa.string()).take(pa.array(key[b] // kinds)),
                        "term": terms.dictionary.take(pa.array(key[b] % kinds)).cast(pa.string()),
                        "df": np.add.reduceat(n[cells], b - b[0]),
                        "sources": pa.ListArray.from_arrays(places, source_of.take(pa.array(g[cells]))),
                        "counts": pa.ListArray.from_arrays(places, pa.array(c[cells])),
                    },
                    STRIPES,
                )
        self.clear()


def merge_runs(it: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """One stripe for each language and term of sorted stripes, where ``least`` documents have it."""
    held = None
    for batch in it:
        table = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks()
        if not table.num_rows:
            continue
        lang, term = table["lang"].combine_chunks(), table["term"].combine_chunks()
        new = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
        run = np.concatenate([[0], np.cumsum(new)]).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], new]))
        sources, counts = table["sources"].combine_chunks(), table["counts"].combine_chunks()
        names = sources.flatten().dictionary_encode()
        kinds = max(1, len(names.dictionary))
        own = np.repeat(run, np.diff(sources.offsets.to_numpy()))
        cell, total = summed(own * kinds + names.indices.to_numpy(), counts.flatten().to_numpy())
        places = pa.array(np.searchsorted(cell // kinds, np.arange(len(first) + 1)), pa.int32())
        merged = batches(
            {
                "lang": lang.take(pa.array(first)),
                "term": term.take(pa.array(first)),
                "df": np.add.reduceat(table["df"].to_numpy(), first),
                "sources": pa.ListArray.from_arrays(places, names.dictionary.take(pa.array(cell % kinds))),
                "counts": pa.ListArray.from_arrays(places, pa.array(total)),
            },
            STRIPES,
        )
        # The last run may go on in the next batch.
        done, held = merged.slice(0, len(first) - 1), merged.slice(len(first) - 1)
        yield done.filter(pc.greater_equal(done["df"], least))
    if held is not None:
        yield held.filter(pc.greater_equal(held["df"], least))


def source_stripes(docs: DataFrame, least: int = LEAST_DOCS, most: int = CELLS) -> DataFrame:
    """``lang, term, df, sources, counts`` of the terms that at least ``least`` documents of a language have.

    ``docs`` has ``lang, source, text`` without nulls. A term that every task
    knows arrives as one row of a task (or spill) and is merged batch by batch,
    so that no key gathers more than its sources in memory.
    """

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes(most)
        for batch in it:
            held.add(*batch.columns)
            if held.is_full():
                yield from held.rows()
        yield from held.rows()

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_runs(it, least)

    folded = docs.select("lang", "source", "text").mapInArrow(fold, STRIPES_DDL)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, STRIPES_DDL)


def share(count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * (count + 1) / (total + kinds)), exact beyond 64 bits too."""
    count = count + 1
    if count.max(initial=0) > (1 << 62) // PARTS:
        return 1 + (count.astype(object) * PARTS // (total + kinds).astype(object)).astype(np.int64)
    return 1 + count * PARTS // (total + kinds)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def totalled(stripes: DataFrame, groups: DataFrame) -> DataFrame:
    """Stripes with ``totals`` beside ``counts``, joined; for more sources than travel with a function."""
    cells = stripes.select("lang", "term", F.inline(F.arrays_zip("sources", "counts")))
    joined = cells.join(groups.select("lang", F.col("source").alias("sources"), "n"), ["lang", "sources"])
    lists = joined.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("sources", "counts", "n"))).alias("l"))
    whole = groups.select("lang", "kinds", "lang_n").distinct()
    return lists.join(whole, "lang").select("lang", "term", "kinds", "lang_n", "l.sources", "l.counts", F.col("l.n").alias("totals"))


class Emitter:
    """What a task's merged stripes give: sums for pairs of sources, and each source's best terms."""

    def __init__(self, top: int, most: int):
        self.top, self.most = top, most
        self.codes: dict[tuple[str, str], int] = {}
        self.names: list[tuple[str, str]] = []
        self.clear()

    def clear(self) -> None:
        self.key, self.value = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.best: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.held = 0

    def code(self, lang: str, source: str) -> int:
        found = self.codes.setdefault((lang, source), len(self.names))
        if found == len(self.names):
            self.names.append((lang, source))
        return found

    def see(self, term: pa.Array, sizes: np.ndarray, code, count, total, kinds, lang_n) -> None:
        """Stripes of ``sizes`` cells each; ``code, count, total`` of each cell, ``kinds, lang_n`` of each stripe."""
        of = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.cumsum(sizes) - sizes
        whole = np.add.reduceat(count, begin)
        p = share(count, total, kinds[of])
        q = share(whole, lang_n, kinds)[of]
        more = np.flatnonzero(p > q)
        self.best.append((code[more], distance(p[more], q[more]), term.take(pa.array(of[more]))))
        self.held += len(more)
        if self.held > self.most:
            self.trim()
        # Each cell with all cells of its stripe: what two sources have in common beyond what their totals tell.
        zero = share(np.zeros(len(of), np.int64), total, kinds[of])
        partners = sizes[of]
        lo, upto = 0, np.cumsum(partners)
        while lo < len(of):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
            a = np.repeat(np.arange(lo, hi), partners[lo:hi])
            b = ragged(begin[of[lo:hi]], partners[lo:hi])
            a, b = a[a != b], b[a != b]
            common = distance(p[a], p[b]) - distance(p[a], zero[b]) - distance(zero[a], p[b]) + distance(zero[a], zero[b])
            key, value = summed(code[a] << 31 | code[b], common)
            self.key, self.value = np.concatenate([self.key, key]), np.concatenate([self.value, value])
            lo = hi
            if len(self.key) > self.most:
                self.key, self.value = summed(self.key, self.value)

    def trim(self) -> None:
        """Keep each source's best terms; stripes come in the order of terms, so equal values stay in that order."""
        if not self.best:
            return
        code, value = (np.concatenate([b[k] for b in self.best]) for k in (0, 1))
        term = pa.concat_arrays([b[2] for b in self.best])
        order = np.lexsort((-value, code))
        rank = np.arange(len(order)) - np.searchsorted(code[order], code[order])
        order = order[rank < self.top]
        order.sort()
        self.best = [(code[order], value[order], term.take(pa.array(order)))]
        self.held = len(order)

    def is_full(self) -> bool:
        return len(self.key) + self.held > self.most

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.trim()
        langs, sources = (pa.array([n[k] for n in self.names], pa.string()) for k in (0, 1))
        key, value = summed(self.key, self.value)
        for lo in range(0, len(key), 1 << 16):
            a, b = pa.array(key[lo : lo + (1 << 16)] >> 31), pa.array(key[lo : lo + (1 << 16)] & ((1 << 31) - 1))
            part = pa.array(["pair"] * len(a))
            yield batches({"part": part, "lang": langs.take(a), "source": sources.take(a), "item": sources.take(b), "value": value[lo : lo + (1 << 16)]}, EMITTED)
        for code, value, term in self.best:
            at = pa.array(code)
            yield batches({"part": pa.array(["term"] * len(code), pa.string()), "lang": langs.take(at), "source": sources.take(at), "item": term, "value": value}, EMITTED)
        self.clear()


def emitted(stripes: DataFrame, groups: DataFrame, top: int, most: int, carried: int) -> DataFrame:
    """``part, lang, source, item, value``: partial sums of pairs, and terms that may be among a source's best."""
    totals = None
    if has_at_most(groups, carried):
        totals = {(r.lang, r.source): (r.n, r.kinds, r.lang_n) for r in groups.collect()}
        wide = stripes.select("lang", "term", "sources", "counts")
    else:
        wide = totalled(stripes, groups).repartition("lang", "term").sortWithinPartitions("lang", "term")

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Emitter(top, most)
        for batch in it:
            if not batch.num_rows:
                continue
            lang, source = batch["lang"].dictionary_encode(), batch["sources"].flatten().dictionary_encode()
            sizes = np.diff(batch["sources"].offsets.to_numpy()).astype(np.int64)
            own = np.repeat(lang.indices.to_numpy(), sizes) * np.int64(len(source.dictionary)) + source.indices.to_numpy()
            each, at = np.unique(own, return_inverse=True)
            langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
            names = [(langs[k // len(sources)], sources[k % len(sources)]) for k in each.tolist()]
            code = np.array([held.code(*n) for n in names], np.int64)[at]
            if totals is None:
                total = batch["totals"].flatten().to_numpy()
                kinds, lang_n = batch["kinds"].to_numpy(), batch["lang_n"].to_numpy()
            else:
                table = np.array([totals[n] for n in names], np.int64)
                first = at[np.cumsum(sizes) - sizes]
                total, kinds, lang_n = table[at, 0], table[first, 1], table[first, 2]
            held.see(batch["term"], sizes, code, batch["counts"].flatten().to_numpy(), total, kinds, lang_n)
            if held.is_full():
                yield from held.rows()
        yield from held.rows()

    return wide.mapInArrow(work, EMITTED_DDL)


def native_share(count: str, total: str) -> F.Column:
    return F.expr(f"1L + (cast({PARTS} as decimal(10, 0)) * ({count} + 1)) div cast({total} + kinds as decimal(20, 0))")


def native_distance(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def source_divergences(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, top: int = TOP_TERMS, most: int = CELLS, carried: int = CARRIED_SOURCES
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others of its language, and by which terms.

    Terms in fewer than ``least`` documents of a language do not count there.
    Of a source (or a whole language) a term has the share
    ``p = 1 + floor(10^9 * (count + 1) / (N + V))``, N its occurrences of the V
    terms that count. Part ``pair`` gives for each other source of the language
    the sum of ``floor((p - q)^2 / q)`` over all V terms, part ``term`` the
    ``top`` terms with a higher share than in the language as a whole. Ranks go
    by value, then by item in the order of UTF-8.

    The pair sums need no term that a source lacks: V times the distance of two
    unseen terms, plus what each source's counts change (by a histogram of its
    counts), plus what the stripes give for terms that both have.

    Null text, lang and source count as empty; repeated rows count each; a
    source without terms has pairs and no terms, a language with one source no
    pairs, an empty table no rows; other columns are not read.
    """
    blank = F.lit("")
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    stripes = materialize(source_stripes(plain, least, most), "stripes")
    cells = stripes.select("lang", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("count"))))
    counted = materialize(cells.groupBy("lang", "source", "count").agg(F.count("*").alias("n_terms")), "histogram")
    kinds = stripes.groupBy("lang").agg(F.count("*").alias("kinds"))
    sums = counted.groupBy("lang", "source").agg(F.sum(F.col("count") * F.col("n_terms")).alias("n"))
    whole = sums.groupBy("lang").agg(F.sum("n").alias("lang_n")).join(kinds, "lang")
    none = F.lit(0).cast("long")
    groups = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(whole, "lang", "left")
    groups = materialize(groups.select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("n", "kinds", "lang_n"))), "sources")
    found = materialize(emitted(stripes, groups, top, most, carried), "emitted")

    unseen = groups.select("lang", "source", "kinds", "n", F.when(F.col("kinds") > 0, native_share("0", "n")).alias("zero"))
    ends = unseen.select("lang", F.col("source").alias("item"), F.col("zero").alias("item_zero"))
    pairs = unseen.join(ends, "lang").where("source <> item")
    flat = F.expr(f"coalesce(kinds * {native_distance('zero', 'item_zero')}, 0L)").cast("decimal(38, 0)")
    shares = counted.join(unseen, ["lang", "source"]).select("lang", "source", "n_terms", "zero", native_share("count", "n").alias("p"))
    seen = shares.join(ends, "lang").where("source <> item")
    forth = F.expr(f"n_terms * ({native_distance('p', 'item_zero')} - {native_distance('zero', 'item_zero')})").cast("decimal(38, 0)")
    back = F.expr(f"n_terms * ({native_distance('item_zero', 'p')} - {native_distance('item_zero', 'zero')})").cast("decimal(38, 0)")
    change = seen.select("lang", "source", "item", forth.alias("forth"), back.alias("back"))
    change = change.groupBy("lang", "source", "item").agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"))
    both = F.explode(F.array(F.struct("source", "item", F.col("forth").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))))
    values = (
        pairs.select("lang", "source", "item", flat.alias("value"))
        .unionByName(change.select("lang", both.alias("s")).select("lang", "s.source", "s.item", "s.value"))
        .unionByName(found.where("part = 'pair'").select("lang", "source", "item", F.col("value").cast("decimal(38, 0)").alias("value")))
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").cast("long").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = values.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
    return ranked.unionByName(terms)


_LOWER = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DIVERGENCE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT i, lang, source, {_LOWER} AS term FROM (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d)),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 3), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d), n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0)::hugeint AS c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 1)) // (coalesce(n, 0) + v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000::hugeint * (sum(c) + 1)) // (any_value(ln) + any_value(v)) AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS ln FROM n GROUP BY lang) USING (lang) GROUP BY ALL),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM r)
SELECT lang, source, part, item, value::bigint AS value, rank::int AS rank FROM o WHERE part = 'pair' OR rank <= 200"""
