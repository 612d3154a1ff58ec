"""Text expressions that stay inside the JVM: tokens, clean-up, budgets."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that Unicode-aware splitting recognises.
UNICODE_SPACE = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Non-ASCII letters whose lower case is an ASCII letter.
LOWERS_TO_ASCII = "\u0130\u212a"

# Fixed value: characters per token, for the native estimate.
CHARS_PER_TOKEN = 4


def squeeze_space(col: Column) -> Column:
    """Every run of white space as one blank, ends trimmed.

    No white space is among the visible ASCII characters; testing for those
    first spares most characters the test of all kinds of white space.
    """
    return F.trim(F.regexp_replace(col, f"[[^!-~]&&[{UNICODE_SPACE}]]+", " "))


def words(col: Column) -> Column:
    """Words between white space."""
    return F.array_remove(F.split(col, f"[{UNICODE_SPACE}]+"), "")


def bm25_corpus_tokens(col: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits.

    Lower-casing before the split lets it use a cheap pattern; the two letters
    that would turn into ASCII on the way are blanked first.
    """
    plain = F.lower(F.translate(col, LOWERS_TO_ASCII, " " * len(LOWERS_TO_ASCII)))
    return F.array_remove(F.split(plain, "[^a-z0-9]+"), "")


def bm25_query_tokens(col: Column, normalize_query: bool = False) -> Column:
    """Lower-cased words; punctuation stays attached unless ``normalize_query``."""
    return bm25_corpus_tokens(col) if normalize_query else words(F.lower(col))


def explode_words(df: DataFrame, *kept: Column | str, tokens: Column | str, out: str = "w") -> DataFrame:
    """One row per token.

    The outer form with a filter after it keeps Spark from computing the token
    array a second time for a "not empty" filter before the explode.
    """
    return df.select(*kept, F.explode_outer(tokens).alias(out)).where(F.col(out).isNotNull())


def split_camel_case(col: Column) -> Column:
    """A blank between a lower-case letter or digit and a capital."""
    return squeeze_space(F.regexp_replace(col, "([A-Z])(?<=[a-z0-9].)", " $1"))


def preprocess_text(col: Column, subwords: Callable[[Column], Column] | None = None) -> Column:
    """Classifier clean-up: part punctuation, drop separators, split camel case.

    ``subwords`` maps the cleaned text to blank-joined pieces; the default
    lower-cases, as no subword vocabulary ships with this package.
    """
    text = F.regexp_replace(col, rf"([?.,!])(?<=[\p{{L}}\p{{N}}_].)(?![{UNICODE_SPACE}])", " $1")
    for found, put in (("_", " "), ("-", " "), ("#", " "), (".html", ""), (".", " ")):
        text = F.replace(text, F.lit(found), F.lit(put))
    text = split_camel_case(text)
    return subwords(text) if subwords else F.lower(text)


def token_count(col: Column, method: str = "chars") -> Column:
    """Estimated token length: four characters, or three quarters of a word, each."""
    if method == "chars":
        return F.ceil(F.length(col) / F.lit(CHARS_PER_TOKEN)).cast("bigint")
    if method == "words":
        return F.ceil(F.size(words(col)) * 4 / F.lit(3)).cast("bigint")
    raise ValueError(f"unknown method {method!r}")


def exact_token_count(encode: Callable[[str], list]) -> Callable[[Column], Column]:
    """An Arrow function that counts with a caller's own tokenizer."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else len(encode(t)) for t in texts.to_pylist()], pa.int64())

    return count


def trim_to_budget(col: Column, max_tokens: Column | int, method: str = "chars") -> Column:
    """The first ``max_tokens`` tokens under the same estimate as ``token_count``."""
    budget = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    if method == "chars":
        return F.substring(col, F.lit(1), (F.greatest(budget, F.lit(0)) * CHARS_PER_TOKEN).cast("int"))
    if method == "words":
        keep = F.floor(F.greatest(budget, F.lit(0)) * 3 / F.lit(4)).cast("int")
        return F.array_join(F.slice(words(col), F.lit(1), keep), " ")
    raise ValueError(f"unknown method {method!r}")


def letter_words(col: Column) -> Column:
    """Lower-cased words made only of ASCII letters; ``_`` parts words."""
    pieces = F.split(F.replace(col, F.lit("_"), F.lit(" ")), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(pieces, lambda w: w.rlike("^[a-zA-Z]+$")), F.lower)
