"""Personal data in whole texts: patterns, and a character tagger that learns from what they find.

The patterns' spans always stay. The tagger (``char_tagger``) is trained on
windows around such spans, some of them rewritten into forms that the patterns
miss, and reads every text in overlapping windows; the spans of all windows of a
document are then reconciled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.arrow import batches
from lectern.llm.char_tagger import Tagger, best_labels, char_classes, emissions, may_leave, train
from lectern.session import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The patterns, so written that no text takes more than linear time: a number is tried from its first digit on, and a name from its "@".
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_IP_REST = re.compile(r"\.[0-9]++\.[0-9]++\.[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Windows of a text for the tagger, and what two neighbours share.
WINDOW, SHARED = 512, 64
# Windows that are read in one go.
BLOCK = 1024
# Characters of a window to learn from.
LESSON = 128


@dataclass(frozen=True)
class Settings:
    """Size and training of the tagger. ``rows`` bounds the documents with and those without matches that it learns from, ``windows`` the windows of each."""

    hidden: int = 8
    dims: int = 8
    rows: int = 2_000
    windows: int = 3_000
    steps: int = 900
    batch: int = 96
    rate: float = 0.03
    seed: int = 11


@dataclass
class Finder:
    """A trained tagger and the least score of a span of each kind; without a tagger the patterns alone count."""

    tagger: Tagger | None = None
    least: np.ndarray = field(default_factory=lambda: np.zeros(len(KINDS)))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        else:
            # What stands before this mark cannot begin an address of a later one.
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns' matches that pass their checks, in order."""
    found = [(a, EMAIL, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text) if _IP_REST.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


_AT = re.compile(r"@|(?<![A-Za-z])at(?![A-Za-z])", re.I)
_DOT = re.compile(r"\.|(?<![A-Za-z])dot(?![A-Za-z])", re.I)


def plausible(text: str, kind: int) -> bool:
    """Whether a span that the tagger proposes has what its kind needs, whatever stands between the parts."""
    if text != text.strip() or not text:
        return False
    digits = digits_of(text)
    if kind == EMAIL:
        mark = _AT.search(text)
        return bool(mark and mark.start() > 0 and _DOT.search(text, mark.end() + 1) and text[0].isalnum() and text[-1].isalnum())
    if not ("0" <= text[-1] <= "9") or any(c.isalpha() for c in text):
        return False
    if kind == IP:
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and len(digits) < len(text)


# -- lessons -------------------------------------------------------------------------


def _number(rng: np.random.Generator, size: int) -> str:
    return "".join(map(str, rng.integers(0, 10, size)))


def _card_digits(rng: np.random.Generator) -> str:
    body = _number(rng, 15)
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def _pick(rng: np.random.Generator, options: list):
    return options[int(rng.integers(0, len(options)))]


def variant(rng: np.random.Generator, kind: int, words: list[str]) -> str:
    """A made-up item of a kind, in a form that patterns know or in one that they miss."""
    if kind == EMAIL:
        name = _pick(rng, words).lower() if words and rng.random() < 0.6 else _number(rng, 2)
        if rng.random() < 0.5:
            name += _pick(rng, [".", "_", "-", ""]) + _number(rng, int(rng.integers(1, 4)))
        host = _pick(rng, ["mail", "example", "post", "web", "host"]) + (_number(rng, 1) if rng.random() < 0.5 else "")
        host = [host, *(["example"] if rng.random() < 0.5 else []), _pick(rng, ["com", "org", "net", "de", "fr", "es", "info"])]
        at = _pick(rng, ["@", "@", " at ", " [at] ", "(at)", " (at) ", " @ ", "[at]", " AT "])
        dot = "." if at.strip() == "@" and rng.random() < 0.5 else _pick(rng, [".", " dot ", " [dot] ", "(dot)", " . ", "[.]", " DOT "])
        return name + at + dot.join(host)
    if kind == IP:
        mark = _pick(rng, [".", ".", "[.]", " . ", "(.)", ". ", ","])
        return mark.join(str(p) for p in rng.integers(0, 256, 4))
    if kind == CARD:
        digits = _card_digits(rng)
        mark = _pick(rng, ["", " ", "-", ".", "  ", "/", " - ", "_"])
        return mark.join(digits[k : k + 4] for k in range(0, 16, 4))
    area, first, last = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    start = _pick(rng, ["+1 ", "+1-", "001 ", "1-", "+" + _number(rng, 2) + " ", "", "", "00" + _number(rng, 2) + " "])
    return start + _pick(rng, [f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"{area} {first} {last}", f"({area}){first}-{last}", f"{area}/{first}-{last}"])


def distractor(rng: np.random.Generator, words: list[str]) -> str:
    """What looks like personal data and is none; numbers that only the checks of ``plausible`` tell apart are left to those."""
    n = lambda a, b: int(rng.integers(a, b))
    word = _pick(rng, words) if words else "x"
    return _pick(
        rng,
        [
            f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}",
            f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}",
            f"{n(0, 24):02d}:{n(0, 60):02d}:{n(0, 60):02d}",
            f"{n(0, 20)}.{n(0, 20)}.{n(0, 20)}",
            f"{n(0, 999)}.{n(0, 99)}",
            f"{n(0, 999)},{n(0, 999):03d},{n(0, 999):03d}",
            _number(rng, n(1, 9)),
            _number(rng, n(20, 40)),
            f"@{word}",
            f"{word} at {word}",
            f"{word} at {word}. {word.capitalize()} {word}",
            f"{word} dot {word}",
            f"{word}@{word}",
            f"{n(1, 999)}-{n(1, 999)}",
            f"({n(1, 999)})",
            f"{n(1, 99)} + {n(1, 99)} - {n(1, 99)} = {n(1, 99)}",
            f"{n(1, 99)} of {n(1, 9999)}",
            f"{n(1, 99)} {n(1, 99)} {n(1, 99)} {n(1, 99)}",
            f"#{n(1, 99999)}",
            f"{n(1, 99)}/{n(1, 99)}",
            f"{n(1, 999)}%",
        ],
    )


def lesson(rng: np.random.Generator, before: str, item: str, kind: int | None, after: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Character classes, labels and text of a window with ``item`` somewhere in it."""
    item = item[:LESSON]
    lead = int(rng.integers(0, LESSON - len(item) + 1))
    before = before[-lead:] if lead else ""
    text = (before + item + after)[:LESSON]
    labels = np.zeros(LESSON, np.uint8)
    if kind is not None:
        labels[len(before) : len(before) + len(item)] = 2 * kind + 2
        labels[len(before)] = 2 * kind + 1
    ids = np.zeros(LESSON, np.uint8)
    ids[: len(text)] = char_classes(text)
    return ids, labels, text


def lessons(found: list[tuple[str, str, str, int]], most: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows (times, texts), their labels and texts; half of them without personal data.

    ``found`` has text before, item, text after and kind (-1: a text without any).
    The kinds come in equal shares. Items stay as they are or become a variant of
    their kind; texts without any stay or get a distractor.
    """
    rng = np.random.default_rng(seed)
    own = {k: [f for f in found if f[3] == k] for k in (-1, *range(len(KINDS)))}
    kinds = [k for k in range(len(KINDS)) if own[k]]
    out = []
    for i in range(most):
        if own[-1] and (i % 2 or not kinds):
            before, _, after, _ = _pick(rng, own[-1])
            words = re.findall(r"[A-Za-z]{2,}", before)[-20:]
            item = distractor(rng, words) if rng.random() < 0.6 else ""
            out.append(lesson(rng, before + (" " if item else ""), item, None, (" " if item else "") + after))
        elif kinds:
            kind = kinds[(i // 2) % len(kinds)]
            before, item, after, _ = _pick(rng, own[kind])
            if rng.random() < 0.7:
                item = variant(rng, kind, re.findall(r"[A-Za-z]{2,}", before)[-20:])
                # Some patterns run on into what stands before: an item of its own begins after a blank.
                before = before.rstrip("0123456789.-+_%") + " "
            out.append(lesson(rng, before, item, kind, after if after[:1] in ("", " ", "\n", ".", ",") else " " + after))
    ids, labels = (np.array([x[k] for x in out], np.uint8).reshape(-1, LESSON).T for k in (0, 1))
    return np.ascontiguousarray(ids), np.ascontiguousarray(labels), [x[2] for x in out]


def labelled_windows(docs: DataFrame, settings: Settings) -> list[tuple[str, str, str, int]]:
    """Text before, item, text after and kind of a bounded sample of the patterns' matches, and texts without any (kind -1).

    Of the documents that may hold a match, and of the others, those with the least
    hashes of the id teach, ``settings.rows`` of each at most, with one text an id;
    the windows are cut out where the texts are.
    """
    may = F.col("text").rlike(r"@|\+[0-9]|[0-9]\.[0-9]+\.[0-9]+\.|[0-9]([ -]?[0-9]){11}")
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(may).alias("may"))
    ids = materialize(ids.where("may is not null"), "sampled-ids")
    sizes = {r["may"]: r["count"] for r in ids.groupBy("may").count().collect()}
    rank, spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), 1 << 30
    chosen = None
    for kind, n in sizes.items():
        # A share of the hashes that holds some more than enough, so that few ids are sorted.
        share = min(spread, int(spread * (1.5 * settings.rows + 200) / n))
        part = ids.where((F.col("may") == kind) & (rank < share)).orderBy(rank, "doc_id").limit(settings.rows).select("doc_id")
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return []
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("before", pa.string()), ("item", pa.string()), ("after", pa.string()), ("kind", pa.int32())])

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                end = 0
                spans = base_spans(text)
                for a, kind, b in spans:
                    if a >= end and b - a <= LESSON:
                        stop = min([x for x, _, _ in spans if x >= b], default=len(text))
                        rows.append((doc, a, text[max(end, a - LESSON) : a], text[a:b], text[b : min(stop, b + LESSON)], kind))
                    end = max(end, b)
                if not spans:
                    for at in range(0, min(len(text), 4 * LESSON * 8), LESSON * 8):
                        rows.append((doc, at, text[at : at + LESSON], "", text[at + LESSON : at + 2 * LESSON], -1))
            yield batches({n: [r[k] for r in rows] for k, n in enumerate(schema.names)}, schema)

    texts = docs.join(F.broadcast(chosen), "doc_id").where("text is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    cut = texts.select("doc_id", "text").mapInArrow(work, "doc_id long, at long, before string, item string, after string, kind int")
    cut = materialize(cut, "lesson-windows")
    # A document with very many matches does not crowd out the others.
    best = cut.where("kind >= 0").orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at", "kind").limit(settings.windows)
    none = cut.where("kind < 0").orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").limit(settings.windows)
    found = best.unionByName(none).toArrow().to_pylist()
    return sorted((r["before"], r["item"], r["after"], r["kind"]) for r in found)


def tagged(labels: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the labelled runs of one window."""
    begins = np.flatnonzero(labels % 2 == 1)
    out = []
    for a in begins.tolist():
        kind, b = (int(labels[a]) - 1) // 2, a + 1
        while b < len(labels) and labels[b] == 2 * kind + 2:
            b += 1
        out.append((a, kind, b))
    return out


def span_score(scores: np.ndarray, start: int, kind: int, end: int) -> float:
    """How much more a span's characters score with their labels than outside, on average."""
    own = scores[start:end, 2 * kind + 2].sum() - scores[start, 2 * kind + 2] + scores[start, 2 * kind + 1]
    return float(own - scores[start:end, 0].sum()) / (end - start)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Finder:
    """A finder trained on the patterns' matches in ``docs`` (``doc_id, text``); without matches it has no tagger.

    A fifth of the windows is held back: a kind's least score is the lowest at
    which 99 of 100 of its plausible spans in them touch one that is meant.
    """
    found = labelled_windows(docs, settings)
    if not any(f[3] >= 0 for f in found):
        return Finder()
    back = [f for k, f in enumerate(found) if k % 5 == 0]
    ids, labels, _ = lessons([f for k, f in enumerate(found) if k % 5], 2 * settings.windows, settings.seed)
    tagger = train(ids, labels, len(KINDS), settings.hidden, settings.dims, settings.steps, settings.batch, settings.rate, settings.seed)
    finder = Finder(tagger)
    ids, labels, texts = lessons(back, settings.windows // 2, settings.seed + 1)
    if ids.shape[1]:
        lengths = np.full(ids.shape[1], LESSON)
        scores, _ = emissions(tagger, ids, lengths)
        told = best_labels(tagger, scores, lengths)
        judged: list[list[tuple[float, bool]]] = [[] for _ in KINDS]
        for w in range(ids.shape[1]):
            meant = tagged(labels[:, w])
            for a, kind, b in tagged(told[:, w]):
                c, d = trimmed(texts[w], a, min(b, len(texts[w])))
                if plausible(texts[w][c:d], kind):
                    right = any(kind == k and a < y and x < b for x, k, y in meant)
                    judged[kind].append((span_score(scores[:, :, w], a, kind, b), right))
        for kind, own in enumerate(judged):
            own.sort(reverse=True)
            hits = np.cumsum([r for _, r in own])
            good = np.flatnonzero(hits >= 0.99 * np.arange(1, len(own) + 1)) if own else np.zeros(0, int)
            finder.least[kind] = own[good[-1]][0] if len(good) else np.inf
    return finder


# -- reading -------------------------------------------------------------------------


def windows_of(size: int) -> list[int]:
    """Where the windows of a text of ``size`` characters begin; the last one ends with the text."""
    return list(range(0, max(1, size - SHARED), WINDOW - SHARED))


_OF = {c: int(k) for c, k in zip("09@aAtTzZ", char_classes("09@aAtTzZ"))}


def needed_marks(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running counts of what ``plausible`` asks of every span: digits, and "@" or the word "at"."""
    digit = (classes >= _OF["0"]) & (classes <= _OF["9"])
    letter = (classes >= _OF["A"]) & (classes <= _OF["Z"]) | (classes >= _OF["a"]) & (classes <= _OF["z"])
    mark = classes == _OF["@"]
    if len(classes) > 1:
        word = ((classes[:-1] == _OF["a"]) | (classes[:-1] == _OF["A"])) & ((classes[1:] == _OF["t"]) | (classes[1:] == _OF["T"]))
        word[1:] &= ~letter[:-2]
        word[:-1] &= ~letter[2:]
        mark[:-1] |= word
    return tuple(np.concatenate([[0], np.cumsum(x)]) for x in (digit, mark))


def open_windows(classes: np.ndarray) -> list[tuple[int, int]]:
    """Begin and length of the windows of a text that can hold a plausible span at all: four digits, or "@" or "at"; no others need to be read."""
    if not len(classes):
        return []
    digits, marks = needed_marks(classes)
    starts = np.array(windows_of(len(classes)))
    ends = np.minimum(starts + WINDOW, len(classes))
    may = (digits[ends] - digits[starts] >= 4) | (marks[ends] > marks[starts])
    return [(a, b - a) for a, b in zip(starts[may].tolist(), ends[may].tolist())]


def proposals(finder: Finder, texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
    """``(score, start, kind, end)`` of all spans that the tagger sees in the windows of each text."""
    out: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    classes = [char_classes(t) for t in texts]
    places = [(d, a, n) for d, c in enumerate(classes) for a, n in open_windows(c)]
    # Windows of like length are read together, so that little is filled up.
    places.sort(key=lambda p: (-p[2], p[0], p[1]))
    for lo in range(0, len(places), BLOCK):
        block = places[lo : lo + BLOCK]
        lengths = np.array([p[2] for p in block])
        ids = np.zeros((len(block), lengths[0]), np.uint8)
        for w, (d, a, n) in enumerate(block):
            ids[w, :n] = classes[d][a : a + n]
        ids = np.ascontiguousarray(ids.T)
        scores, _ = emissions(finder.tagger, ids, lengths)
        some = may_leave(finder.tagger, scores, lengths)
        if not len(some):
            continue
        told = best_labels(finder.tagger, np.ascontiguousarray(scores[:, :, some]), lengths[some])
        for column in np.flatnonzero(told.any(axis=0)).tolist():
            w = int(some[column])
            d, a, n = block[w]
            for start, kind, end in tagged(told[:n, column]):
                # A span that touches an inner edge is seen whole by the neighbour.
                if (start == 0 and a > 0) or (end == n and a + n < len(classes[d])):
                    continue
                out[d].append((span_score(scores[:, :, w], start, kind, end), a + start, kind, a + end))
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in " \t\r\n,;:":
        start += 1
    while end > start and text[end - 1] in " \t\r\n.,;:":
        end -= 1
    return start, end


def reconciled(finder: Finder, text: str, base: list[tuple[int, int, int]], seen: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that the tagger adds: plausible, of a sufficient score, touching no pattern's span; of overlapping ones the best."""
    taken = [(a, b) for a, _, b in base]
    added = []
    for score, start, kind, end in sorted(set(seen), key=lambda s: (-s[0], s[1], s[2], s[3])):
        if score < finder.least[kind]:
            continue
        start, end = trimmed(text, start, end)
        if plausible(text[start:end], kind) and all(end <= a or start >= b for a, b in taken):
            taken.append((start, end))
            added.append((start, kind, end))
    return sorted(added)


def find(docs: DataFrame, finder: Finder, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added`` of every row: ``start, kind, end`` of the patterns' spans and of those that the tagger adds.

    Positions count code points, the end is exclusive, kinds are numbered as in
    KINDS. Null and empty texts have no spans; rows without doc_id keep a null;
    repeated rows give repeated results; other columns are not read.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", span), ("added", span)])

    def listed(spans):
        return [{"start": a, "kind": k, "end": b} for a, k, b in spans]

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base, added = [base_spans(t) for t in texts], []
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= 1 << 21):
                    size += len(texts[hi])
                    hi += 1
                if finder.tagger is None:
                    added.extend([] for _ in range(lo, hi))
                else:
                    seen = proposals(finder, texts[lo:hi])
                    added.extend(reconciled(finder, texts[k], base[k], seen[k - lo]) for k in range(lo, hi))
                lo = hi
            yield batches({"doc_id": batch.column(0), "base": pa.array([listed(s) for s in base], span), "added": pa.array([listed(s) for s in added], span)}, schema)

    spans = "array<struct<start:long,kind:long,end:long>>"
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(work, f"doc_id long, base {spans}, added {spans}")


def span_text(column: str | F.Column) -> F.Column:
    """``kind:start:end`` of the spans, joined by commas, by start and then by kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(F.array_sort(column), lambda s: F.concat_ws(":", F.get(names, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every document.

    The counts and ``base_sha256`` are those of the patterns' spans, ``spans`` has
    all spans, ``n_added`` counts those that the tagger adds. It learns from the
    patterns' matches in a bounded sample of ``docs`` (see Settings) and reads
    every text whole. See ``find`` for odd rows; an empty table gives no rows.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = find(plain, fit(plain, settings))
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = {k})")).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )

