"""URL filtering by listed rules and by mined association rules.

Listed rules (host and path prefix) decide first; the longest that fits wins. Other URLs are judged
by rules that FP-growth mines from labelled URLs among them: combinations of URL tokens (scheme, host
labels and their endings, path parts, file ending, query names) that imply "block". A URL is labelled by
the label of the document that its path names (bad if toxic or of low quality); what the listed rules
decide is not learnt from, so that mined rules do not echo them.

Mined rules are pruned by support, confidence and lift, and a rule goes if a shorter part of it is
as confident; all others are kept, however many tokens they have, as a written table. URLs find rules through an inverted index: a
rule is filed under its rarest token, and only rules filed under one of the URL's tokens are
compared. Without a rule that fits, a URL is allowed. Up to ``INDEX_RULES`` rules travel to the
workers as an index; more are joined with the distinct sets of tokens. Both ways find the same rule.

A missing URL, or one without ``://``, has an empty host and path and no tokens: it is allowed.
Repeated rows are judged alike and each count as a labelled URL. Ties between rules go to the larger
support, then the first by tokens. Very long URLs have as many tokens as they have parts. Without
labelled URLs nothing is mined. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import look_up, map_batches
from barloom.sinks.writers import written

#: The listed rules, host and path prefix in one.
LISTED = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Share of the labelled URLs that a combination must cover, and least confidence and lift of a rule.
MIN_SUPPORT = 0.002
#: Labelled URLs that a combination must cover whatever their share.
MIN_URLS = 20
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.2
#: Rules that the workers hold as an index; it decides speed alone.
INDEX_RULES = 10_000

BLOCK, ALLOW = "verdict=block", "verdict=allow"
#: What all path parts of digits alone are called.
NUMBER = "<number>"


def host_of(url: Column) -> Column:
    """Host of a URL with A-Z lower-cased; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """Text of the longest listed rule that fits, else NULL."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit("/" + rest)
        )
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rules: Sequence[tuple[str, str]], rule: Column) -> Column:
    verdict = F.lit(None).cast("string")
    for text, result in rules:
        verdict = F.when(rule == text, F.lit(result)).otherwise(verdict)
    return verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; path parts of digits alone count as one token."""
    scheme = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(.*?)://", 1)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    endings = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda n: F.concat(F.lit("end:"), F.array_join(F.slice(labels, -n, n), ".")),
    )
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    named = F.transform(parts, lambda x: F.when(x.rlike(r"^[0-9]+$"), NUMBER).otherwise(x))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    tokens = F.concat(
        F.array(F.concat(F.lit("scheme:"), scheme), F.concat(F.lit("file:"), ending)),
        F.transform(labels, lambda x: F.concat(F.lit("label:"), x)),
        F.when(F.size(labels) > 0, endings).otherwise(F.array().cast("array<string>")),
        F.transform(named, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(query, lambda x: F.concat(F.lit("query:"), x)),
    )
    return F.array_distinct(F.filter(tokens, lambda x: ~x.rlike("^(scheme|file):$")))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str, url: str) -> DataFrame:
    """``page_id, host, path, rule, listed, tokens`` of every row."""
    parsed = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("__url"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    ).withColumn("rule", listed_rule(rules, F.col("host"), F.col("path")))
    return parsed.select(
        "page_id",
        "host",
        "path",
        "rule",
        verdict_of(rules, F.col("rule")).alias("listed"),
        url_tokens(F.col("__url"), F.col("host"), F.col("path")).alias("tokens"),
    )


def labelled_urls(told: DataFrame, labels: DataFrame) -> DataFrame:
    """``tokens, verdict`` of the URLs that no listed rule decides and that name a labelled document."""
    number = F.regexp_extract("path", r"/([0-9]{1,18})[^/]*/?$", 1).try_cast("bigint")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("__doc")).agg(
        F.max(bad).alias("bad")
    )
    # Pages that name no document get a key of their own, so they do not meet in one task.
    rows = told.where("listed IS NULL")
    rows = rows.withColumn("__doc", F.coalesce(number, -1 - F.abs(F.xxhash64("page_id", "host") % (1 << 40))))
    by_document = F.when(F.col("bad"), F.lit("block")).when(~F.col("bad"), F.lit("allow"))
    return rows.join(known, "__doc").select("tokens", by_document.alias("verdict"))


def rule_table(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_urls: int = MIN_URLS,
) -> DataFrame:
    """``tokens, confidence, support`` of every kept rule, written."""
    baskets = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items")
    )
    total = baskets.count()
    if not total:
        return labelled.sparkSession.createDataFrame(
            [], "tokens array<string>, confidence double, support double"
        )
    least = min(1.0, max(min_support, min_urls / total))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    rules = written(
        model.associationRules.where(
            (F.col("consequent")[0] == BLOCK)
            & (F.col("lift") >= min_lift)
            & ~F.array_contains("antecedent", ALLOW)
        ).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"),
        "url-candidates",
    )
    return _without_redundant(rules)


def _without_redundant(rules: DataFrame) -> DataFrame:
    """Rules of which no shorter part is as confident, by number of tokens.

    A part that went itself has a part that stayed and is as confident, so that rules are compared
    with kept ones only; a kept rule is filed under its first token.
    """
    sizes = sorted(r[0] for r in rules.select(F.size("tokens")).distinct().collect())
    kept = rules.where("false")
    for size in sizes:
        part = rules.where(F.size("tokens") == size)
        filed = kept.select(
            F.col("tokens")[0].alias("__key"), F.col("tokens").alias("__part"), F.col("confidence").alias("__least")
        )
        redundant = (
            part.select("tokens", "confidence", F.explode("tokens").alias("__key"))
            .join(filed, "__key")
            .where((F.col("__least") >= F.col("confidence")) & (F.size(F.array_except("__part", "tokens")) == 0))
            .select("tokens")
            .distinct()
        )
        kept = written(kept.unionByName(part.join(redundant, "tokens", "left_anti")), "url-rules")
    return kept


def collected(rules: DataFrame) -> list[tuple[tuple[str, ...], float, float]]:
    """Rules as (tokens, confidence, support), most confident first."""
    found = [(tuple(r.tokens), r.confidence, r.support) for r in rules.collect()]
    return sorted(found, key=lambda r: (-r[1], -r[2], r[0]))


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_urls: int = MIN_URLS,
) -> list[tuple[tuple[str, ...], float, float]]:
    """Kept rules as (tokens, confidence, support), most confident first."""
    return collected(rule_table(labelled, min_support, min_confidence, min_lift, min_urls))


def inverted_index(
    rules: list[tuple[tuple[str, ...], float, float]], frequency: dict[str, int]
) -> dict[str, list[int]]:
    """Rule numbers under the rarest token of each rule."""
    index: dict[str, list[int]] = {}
    for i, (tokens, _, _) in enumerate(rules):
        rarest = min(tokens, key=lambda t: (frequency.get(t, 0), t))
        index.setdefault(rarest, []).append(i)
    return index


def found_by_index(
    told: DataFrame, labelled: DataFrame, mined: list[tuple[tuple[str, ...], float, float]]
) -> DataFrame:
    """``told`` with ``mined_rule, confidence`` of the first rule that fits; workers hold the index."""
    wanted = sorted({t for tokens, _, _ in mined for t in tokens})
    counts = (
        labelled.select(F.explode("tokens").alias("token")).where(F.col("token").isin(wanted))
        .groupBy("token").count().collect()
        if wanted else []
    )
    index = inverted_index(mined, {r.token: r["count"] for r in counts})

    def make():
        sets = [frozenset(tokens) for tokens, _, _ in mined]

        def step(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            best = []
            for tokens in out["tokens"].to_pylist():
                have = set(tokens)
                fits = [i for t in have for i in index.get(t, ()) if sets[i] <= have]
                best.append(min(fits, default=None))
            out["mined_rule"] = [None if i is None else " & ".join(mined[i][0]) for i in best]
            out["confidence"] = [None if i is None else mined[i][1] for i in best]
            return out

        return step

    return map_batches(
        told.select("page_id", "host", "path", "rule", "listed", "tokens"),
        make,
        "page_id bigint, host string, path string, rule string, listed string,"
        " mined_rule string, confidence double",
    )


def found_by_join(told: DataFrame, labelled: DataFrame, mined: DataFrame) -> DataFrame:
    """``told`` with ``mined_rule, confidence`` of the first rule that fits, for any number of rules.

    A rule is joined on its rarest token with the distinct sets of those tokens that rules use.
    """
    used = mined.select(F.explode("tokens").alias("token")).distinct()
    counts = written(
        labelled.select(F.explode("tokens").alias("token")).groupBy("token").count().join(used, "token"),
        "url-token-counts",
    )
    filed = (
        mined.select("*", F.explode("tokens").alias("token"))
        .join(counts, "token")
        .groupBy("tokens", "confidence", "support")
        .agg(F.min(F.struct("count", "token"))["token"].alias("token"))
        .select("token", F.col("tokens").alias("rule_tokens"), "confidence", "support")
    )
    # Equal sets of tokens are judged once; a set is told apart by a digest.
    pages = told.withColumn("__set", F.sha2(F.to_json(F.array_sort("tokens")), 256))
    sets = written(
        pages.groupBy("__set").agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("__rows")),
        "url-sets",
    )
    # The exploded token goes to its rules; which of them lie in the set is checked there.
    best = (
        sets.select("__set", "tokens", F.explode("tokens").alias("token"))
        .join(filed, "token")
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
        .groupBy("__set")
        .agg(F.min(F.struct(-F.col("confidence"), -F.col("support"), "rule_tokens")).alias("best"))
    )
    judged_sets = sets.select("__set", "__rows").join(best, "__set", "left").select(
        "__set",
        "__rows",
        F.array_join(F.col("best.rule_tokens"), " & ").alias("mined_rule"),
        (-F.col("best.col1")).alias("confidence"),
    )
    rows = pages.select("page_id", "host", "path", "rule", "listed", "__set")
    return look_up(rows, written(judged_sets, "url-judged"), "__set", ["mined_rule", "confidence"], "__rows").drop("__set")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = LISTED,
    page_id: str = "page_id",
    url: str = "url",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_urls: int = MIN_URLS,
    index_rules: int = INDEX_RULES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every row."""
    told = judged(pages, rules, page_id, url)
    labelled = written(labelled_urls(told, labels), "url-labels")
    mined = rule_table(labelled, min_support, min_confidence, min_urls=min_urls)
    if mined.count() <= index_rules:
        found = found_by_index(told, labelled, collected(mined))
    else:
        found = found_by_join(told, labelled, mined)
    by_method = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("listed", by_method).alias("verdict"),
        "mined_rule",
        "confidence",
    )
