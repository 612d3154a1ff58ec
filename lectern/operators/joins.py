"""Join helpers for sides whose size has to be checked and keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize

# Most rows of a side that is sent to every executor.
MAX_BROADCAST_ROWS = 500_000
# Most frequent keys that are joined apart from the rest.
HOT_KEYS = 10_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has no more than ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, settle: str | None = None) -> DataFrame:
    """Marks ``df`` (narrow rows: keys and numbers) for broadcast once its size is known to be small.

    With ``settle`` the rows are written to the shared folder under that name
    first, so that counting a costly result does not compute it twice.
    """
    if settle:
        df = materialize(df, settle)
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def join_frequent_keys(rows: DataFrame, keyed: DataFrame, key: str, frequency: str, most: int = HOT_KEYS) -> DataFrame:
    """Inner join on ``key`` when a few keys hold most of ``rows``.

    ``keyed`` has one row per key with its ``frequency``. Its most frequent keys
    (``most`` of them) are broadcast, so their rows stay where they are; all other
    keys are rare enough for a plain shuffled join.
    """
    hot = keyed.orderBy(F.col(frequency).desc(), key).limit(most)
    names = hot.select(key)
    in_place = rows.join(F.broadcast(hot), key)
    shuffled = rows.join(F.broadcast(names), key, "left_anti").join(
        keyed.join(F.broadcast(names), key, "left_anti"), key
    )
    return in_place.unionByName(shuffled)


def join_words(rows: DataFrame, keyed: DataFrame, key: str, frequency: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join of word rows with a word table; the word table is broadcast while it is small."""
    if has_at_most(keyed, max_rows):
        return rows.join(F.broadcast(keyed), key)
    return join_frequent_keys(rows, keyed, key, frequency)
