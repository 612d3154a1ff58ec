"""URL filtering by given host and path rules and by mined token rules, in column expressions and Spark's FP-growth only."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize

# verdict, host, path
Rule = tuple[str, str, str]
BAD = "label:bad"


def url_parts(url) -> tuple[F.Column, F.Column, F.Column]:
    """Host, path and what follows the path. Without ``://`` host and path are empty."""
    known = url.contains("://")
    rest = F.when(known, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"^[^?#]*([\s\S]*)", 1)
    return tuple(F.coalesce(x, F.lit("")) for x in (host, path, tail))


def given_rule(host, path, rules: list[Rule]) -> tuple[F.Column, F.Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def url_tokens(host, path, tail) -> F.Column:
    """Typed tokens of a URL: parts of the host, shape of path and query, each segment, word of a segment, query key and value."""
    labels = F.reverse(F.split(host, r"\."))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    last = F.try_element_at(segments, F.lit(-1))
    keys = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(tail, F.lit(r"[?&]([^=&#]*)"), 1))), ",")
    token = lambda kind, x: F.when(x != "", F.concat(F.lit(kind + ":"), x))
    found = [
        token("host1", F.get(labels, F.lit(0))),
        token("host2", F.get(labels, F.lit(1))),
        token("host3", F.get(labels, F.lit(2))),
        token("host4", F.array_join(F.slice(labels, 4, 1 << 20), ".")),
        token("first", F.get(segments, F.lit(0))),
        token("second", F.regexp_replace(F.get(segments, F.lit(1)), "[0-9]+", "0")),
        token("depth", F.size(segments).cast("string")),
        token("end", F.regexp_extract(last, r"(\.[A-Za-z0-9]+)$", 1)),
        token("keys", keys),
        token("mark", F.when(tail.contains("#"), "#")),
    ]
    words = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    each = [
        (segments, "segment"),
        (words, "word"),
        (F.regexp_extract_all(tail, F.lit(r"[?&]([^=&#]+)"), 1), "key"),
        (F.regexp_extract_all(tail, F.lit(r"[?&]([^=&#]+=[^&#]+)"), 1), "value"),
    ]
    typed = lambda kind: lambda v: F.concat(F.lit(kind + ":"), v)
    many = [F.transform(F.array_distinct(x), typed(kind)) for x, kind in each]
    return F.array_sort(F.array_distinct(F.concat(F.array_compact(F.array(*found)), *many)))


def useful_tokens(rows: DataFrame, least: float, min_confidence: float, rate: float) -> DataFrame:
    """``token, item, alone``: tokens that ``least`` bad rows and more of ``row, tokens, bad`` have.

    Tokens of the very same rows are one item. ``alone`` are those that are a
    rule by themselves: no larger rule with them blocks anything more. There are
    at most as many as a row has tokens on average, over the least support.
    """
    each = rows.select("row", F.col("bad").cast("int").alias("bad"), F.explode("tokens").alias("token"))
    same = [F.bit_xor(F.xxhash64("row")).alias("x"), F.sum(F.xxhash64(F.lit(1), "row") % 1_000_003).alias("y")]
    counts = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), *same).where(F.col("bad") >= least)
    counts = materialize(counts, "url-tokens")
    items = counts.groupBy("n", "bad", "x", "y").agg(F.min("token").alias("item"))
    share = F.col("bad") / F.col("n")
    return materialize(counts.join(items, ["n", "bad", "x", "y"]).select("token", "item", ((share >= min_confidence) & (share > rate)).alias("alone")), "url-items")


def items_of(sets: DataFrame, key: str, useful: DataFrame) -> DataFrame:
    """``key`` and the distinct items of its ``tokens``; keys without any are left out."""
    each = sets.select(key, F.explode("tokens").alias("token")).join(F.broadcast(useful), "token")
    return each.groupBy(key).agg(F.array_sort(F.collect_set("item")).alias("tokens"))


def mined_rules(pages: DataFrame, labels: DataFrame, min_support: float = 0.001, min_count: int = 20, min_confidence: float = 0.5) -> DataFrame:
    """``rule_id, tokens, confidence, support``: token combinations whose labelled pages are mostly bad.

    ``pages`` has ``page_id, tokens``; ``labels`` has ``page_id, bad``. FP-growth
    runs over all labelled pages with their label as one more item; a rule
    needs ``min_support`` of them, at least ``min_count`` pages, ``min_confidence``,
    and more of it than all labelled pages have.
    """
    known = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    baskets = pages.join(known, "page_id").select(
        F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")
    )
    baskets = materialize(baskets, "url-baskets")
    n = baskets.count()
    if not n:
        return pages.sparkSession.createDataFrame([], "rule_id long, tokens array<string>, confidence double, support double")
    support = min(1.0, max(min_support, min_count / n))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.element_at("consequent", 1) == BAD) & (F.col("lift") > 1))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    return materialize(rules.select(F.xxhash64("tokens").alias("rule_id"), "*"), "url-rules")


def matched_token_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The ``tokens`` of ``sets`` (distinct) that hold all tokens of some rule.

    Each rule stands in the inverted index under its rarest token alone, so a
    token that all URLs have leads to few rules.
    """
    held = sets.select("tokens", F.explode("tokens").alias("token"))
    counts = held.groupBy("token").count()
    parts = rules.select("rule_id", F.col("tokens").alias("needed"), F.explode("tokens").alias("token"))
    index = parts.join(counts, "token").groupBy("rule_id").agg(
        F.min_by("token", F.struct("count", "token")).alias("token"), F.first("needed").alias("needed")
    )
    fits = F.size(F.array_except("needed", "tokens")) == 0
    return held.join(index.select("token", "needed"), "token").where(fits).select("tokens").distinct()


def blocked_token_sets(split: DataFrame, labels: DataFrame, min_support: float, min_count: int, min_confidence: float) -> DataFrame:
    """The distinct ``tokens`` of ``split`` (``page_id, tokens``) that some mined rule matches.

    FP-growth sees what may be in a rule: tokens with enough bad pages, those of
    the very same pages as one, without those that are rules alone.
    """
    known = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    rows = split.join(known, "page_id").select(F.monotonically_increasing_id().alias("row"), "tokens", "bad")
    rows = materialize(rows, "labelled-urls")
    n, bad = rows.agg(F.count("*"), F.coalesce(F.count_if("bad"), F.lit(0))).first()
    if not bad:
        return split.select("tokens").limit(0)
    useful = useful_tokens(rows, max(min_support * n, min_count) - 0.5, min_confidence, bad / n)
    others = items_of(rows, "row", useful.where("not alone"))
    baskets = rows.select("row").join(others, "row", "left").select(F.col("row").alias("page_id"), F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    mined = mined_rules(baskets, rows.select(F.col("row").alias("page_id"), "bad"), min_support, min_count, min_confidence)
    sets = materialize(split.select("tokens").distinct().withColumn("set", F.monotonically_increasing_id()), "url-sets")
    alone = sets.select("set", F.explode("tokens").alias("token")).join(F.broadcast(useful.where("alone")), "token").select("set")
    items = materialize(items_of(sets, "set", useful.where("not alone")), "url-set-items")
    some = items.join(matched_token_sets(items.select("tokens").distinct(), mined), "tokens").select("set")
    return sets.join(alone.union(some).distinct(), "set", "left_semi").select("tokens")


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url",
    min_support: float = 0.001, min_count: int = 20, min_confidence: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    The longest given rule that fits decides; without one, a URL that some
    mined rule matches is blocked and any other allowed. Null URLs and those
    without ``://`` have empty host and path and no rule; rows without page_id
    are judged but teach nothing; repeated rows give repeated results; an empty
    table gives an empty result, an empty label table no mined rules. Other
    columns are not read.
    """
    host, path, tail = url_parts(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), url_tokens(host, path, tail).alias("tokens"))
    bad = blocked_token_sets(split, labels, min_support, min_count, min_confidence).withColumn("bad", F.lit(True))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad"), "block").otherwise("allow")
    return split.join(bad, "tokens", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
