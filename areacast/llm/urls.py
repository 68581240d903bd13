"""URL filters: given rules first, association rules mined by FP-growth for all other urls.

Urls that a given rule decides are the labels, and they alone are the baskets: their tokens (parts of the host, of
the path, names of parameters), with the verdict as one more item. An undecided url says nothing for or against a
rule, so support and confidence are shares of the labelled urls. A rule must also raise its verdict above the
verdict's share of all labels (lift over 1): a token that is as common on both sides is no reason by itself. Rules
are looked up by an inverted index from token to rule: a rule fires for the token sets that hold as many of its
tokens as it has.

To judge urls all combinations are searched, of all tokens of a url, but not one by one: tokens that the same labelled urls
have are one, and an antecedent from which a token can be taken without another url fitting it says no more than the shorter
one. What is left, the minimal antecedents, is found level by level. A list of all combinations with FP-growth is
possible for short urls only; there, each url gives its most telling tokens to the search.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.sources.tables import release, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VERDICTS = ("block", "allow")
# Tokens of a basket that take part in a list of all combinations.
MOST = 8
# A lift of so little over 1 is a rounding difference.
_LEAST_LIFT = 1 + 1e-9


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with that path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def given(rules: Sequence[Rule], host: Column, path: Column, what: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits; null without one."""
    found = F.lit(None).cast("string")
    # From the shortest to the longest; equal lengths in the order of their names.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, what))).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens, sorted; digits count as one kind of character."""
    def tagged(parts: Column, tag: str) -> Column:
        return F.transform(
            F.filter(parts, lambda p: p != ""),
            lambda p: F.concat(F.lit(f"{tag}:"), F.regexp_replace(p, "[0-9]+", "0")),
        )

    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    tokens = F.concat(
        tagged(F.split(host, r"\."), "host"), tagged(F.split(path, "/"), "path"), tagged(names, "query"),
    )
    return F.coalesce(F.array_sort(F.array_distinct(tokens)), F.array().cast("array<string>"))


def _chosen(distinct: DataFrame, n_baskets: int, min_support: float, most: int) -> DataFrame:
    """(key, token, contrast, place): the frequent tokens of each distinct basket, the most telling ones first.

    Contrast is the difference of the token's shares among the labels of each verdict; ties go by the token.
    """
    of = [F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in _VERDICTS]
    totals = distinct.agg(*of).first()
    shares = [F.col(v) / max(totals[v] or 0, 1) for v in _VERDICTS]
    each = distinct.select("key", "verdict", "n", F.explode("tokens").alias("token"))
    tokens = each.groupBy("token").agg(*of, F.sum("n").alias("all")).where(F.col("all") >= min_support * n_baskets)
    tokens = tokens.select("token", F.abs(shares[0] - shares[1]).alias("contrast"))
    ranked = each.join(tokens, "token").groupBy("key").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("contrast")).alias("c"), "token"))), 1, most).alias("best")
    )
    return ranked.select("key", F.transform("best", lambda b: b["token"]).alias("chosen"))


def _minimal(distinct: DataFrame, n_baskets: int, min_support: float, tied: bool) -> tuple[DataFrame, DataFrame]:
    """The minimal antecedents (antecedent, all, block, allow), with their counts, and (token, alike).

    Minimal: without any one of its tokens, more baskets fit. Of tokens that the same baskets have, only the first by name,
    ``token``, is in an antecedent; ``alike`` are all of them. Antecedents of one verdict only are not made longer, as a
    longer one is as sure, unless it counts which one has more tokens (``tied``).
    """
    of = [F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in _VERDICTS]
    counts = [F.sum("n").alias("all"), *of]
    # A rule needs the support, and a longer antecedent has no more of it; without any token all baskets fit.
    enough = (F.greatest(*_VERDICTS) / n_baskets >= min_support) & (F.col("all") < n_baskets)
    longer = F.lit(True) if tied else F.greatest(*_VERDICTS) < F.col("all")

    each = distinct.select("key", "verdict", "n", F.explode("tokens").alias("token"))
    baskets_of = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"x{i}") for i in range(2)]
    tokens = each.groupBy("token").agg(*counts, *baskets_of).where(enough)
    same = written(tokens.groupBy("x0", "x1", "all", *_VERDICTS).agg(F.sort_array(F.collect_list("token")).alias("alike")), "alike")
    same = same.withColumn("token", F.get("alike", F.lit(0)))

    level = same.select(F.array("token").alias("antecedent"), "all", *_VERDICTS)
    found, open_ = level, level.where(longer)
    more = written(each.join(open_.select(F.get("antecedent", F.lit(0)).alias("token")), "token"), "open_tokens")
    fitting, made = more.select(F.array("token").alias("antecedent"), "key"), None
    while not open_.isEmpty():
        # Each antecedent comes from the one without its last token.
        longest = F.get("antecedent", F.size("antecedent") - 1)
        before, made = made, written(fitting.join(more, "key").where(F.col("token") > longest).select(
            F.concat("antecedent", F.array("token")).alias("antecedent"), "key", "verdict", "n"
        ), "fitting")
        if before is not None:
            release(before)
        level = made.groupBy("antecedent").agg(*counts).where(enough)
        # All shorter by one have to be open and to fit more baskets.
        shorter = F.transform(
            F.sequence(F.lit(0), F.size("antecedent") - 1),
            lambda i: F.filter("antecedent", lambda _, j: j != i),
        )
        known = open_.select(F.col("antecedent").alias("shorter"), F.col("all").alias("fit"))
        parts = level.withColumn("shorter", F.explode(shorter)).join(known, "shorter").where("fit > all")
        level = parts.groupBy("antecedent", "all", *_VERDICTS).agg(F.count("*").alias("of"))
        level = written(level.where(F.col("of") == F.size("antecedent")).drop("of"), "antecedents")
        found, open_ = found.union(level), level.where(longer)
        fitting = made.join(open_.select("antecedent"), "antecedent", "left_semi").select("antecedent", "key")
    release(more, *([made] if made is not None else []))
    return found, same.select("token", "alike")


def _whole(distinct: DataFrame, n_baskets: int, min_support: float, min_confidence: float) -> DataFrame:
    """The rules of the minimal antecedents, with the tokens ``alike`` to each of an antecedent's.

    Where both verdicts have the same share, the number of tokens can decide between them; then ``closure`` has all tokens that
    each basket has which the antecedent fits.
    """
    of = [F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in _VERDICTS]
    totals = distinct.agg(*of).first()
    tied = len({totals[v] for v in _VERDICTS}) == 1
    found, same = _minimal(distinct, n_baskets, min_support, tied)
    verdicts = F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n")) for v in _VERDICTS]))
    counts = found.select("antecedent", "all", verdicts.alias("v")).select("antecedent", "all", "v.*").where("n > 0")
    rules = written(_sure(counts, distinct, n_baskets, min_support, min_confidence, "all"), "rules")
    places = rules.select("rule_id", F.posexplode("antecedent").alias("place", "token")).join(same, "token")
    alike = places.groupBy("rule_id").agg(F.sort_array(F.collect_list(F.struct("place", "alike"))).alias("places"))
    rules = rules.join(alike, "rule_id").withColumn("alike", F.transform("places", lambda p: p["alike"])).drop("places")
    if tied:
        each = distinct.select("key", "n", F.explode("tokens").alias("token"))
        index = rules.select("rule_id", "all", F.size("antecedent").alias("size"), F.explode("antecedent").alias("token"))
        fits = each.join(index, "token").groupBy("key", "rule_id", "size", "all").agg(F.count("*").alias("of")).where("of = size")
        held = fits.select("key", "rule_id", "all").join(each, "key").groupBy("rule_id", "all", "token").agg(F.sum("n").alias("n"))
        closure = held.where("n = all").groupBy("rule_id").agg(F.collect_set("token").alias("closure"))
        rules = rules.join(closure, "rule_id")
    return written(rules.drop("all"), "rules")


def mine(
    baskets: DataFrame, min_support: float, min_confidence: float, most: int | None = MOST
) -> DataFrame:
    """(rule_id, antecedent, verdict, confidence, lift, support) from (tokens, verdict), with a lift over 1.

    A basket whose verdict is null counts against each rule that its tokens fit. Antecedents are all single frequent tokens, and
    the frequent combinations of the ``most`` tokens of a basket that tell the verdicts apart best. So a url of any length is
    searched in at most 2^most combinations. What FP-growth finds among these is counted again over all baskets with all
    their tokens: support, confidence and lift are exact.

    Without ``most`` (None) nothing is bounded: all combinations of all tokens are searched, and the rules are those of the minimal
    antecedents, from which all others follow. ``alike`` has, for each token of an antecedent, those that may stand for it.
    """
    schema = "rule_id bigint, antecedent array<string>, verdict string, confidence double, lift double, support double"
    # A basket without tokens has nothing to be found by, but is a basket.
    distinct = baskets.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    distinct = written(distinct.withColumn("key", F.xxhash64("tokens", F.coalesce("verdict", F.lit("-")))), "baskets")
    n_baskets = distinct.agg(F.sum("n").alias("n")).first()["n"]
    if not n_baskets:
        return baskets.sparkSession.createDataFrame([], schema)
    if most is None:
        return _whole(distinct, n_baskets, min_support, min_confidence)
    chosen = written(_chosen(distinct, n_baskets, min_support, most), "chosen")
    # A distinct basket as often as it occurs.
    copies = F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))
    transactions = distinct.select("key", copies).join(chosen, "key").select(F.col("chosen").alias("items"))
    found = None
    if not chosen.isEmpty():
        # The share of those baskets that have a token chosen, so that the least count is that over all.
        n_chosen = transactions.count()
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, min_support * n_baskets / n_chosen)).fit(transactions)
        found = model.freqItemsets.select(F.array_sort("items").alias("antecedent"))
    tokens = distinct.select(F.explode("tokens").alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n"))
    single = tokens.where(F.col("n") >= min_support * n_baskets).select(F.array("token").alias("antecedent"))
    found = single if found is None else found.unionByName(single)
    candidates = written(found.distinct().withColumn("rule_id", F.xxhash64("antecedent")), "antecedents")
    return written(_counted(distinct, candidates, n_baskets, min_support, min_confidence), "rules")


def _counted(
    distinct: DataFrame, candidates: DataFrame, n_baskets: int, min_support: float, min_confidence: float
) -> DataFrame:
    """The rules of the candidate antecedents, with exact counts over all baskets."""
    index = candidates.select("rule_id", F.size("antecedent").alias("size"), F.explode("antecedent").alias("token"))
    hits = distinct.select("key", "verdict", "n", F.explode("tokens").alias("token")).join(index, "token")
    full = hits.groupBy("key", "rule_id", "size", "verdict", "n").agg(F.count("*").alias("of")).where("of = size")
    counts = full.groupBy("rule_id", "verdict").agg(F.sum("n").alias("n"))
    whole = counts.groupBy("rule_id").agg(F.sum("n").alias("all"))
    counts = counts.join(whole, "rule_id").join(candidates, "rule_id").select("antecedent", "verdict", "n", "all")
    return _sure(counts, distinct, n_baskets, min_support, min_confidence)


def _sure(
    counts: DataFrame, distinct: DataFrame, n_baskets: int, min_support: float, min_confidence: float, *more: str
) -> DataFrame:
    """The rules among (antecedent, verdict, n, all): how many baskets with the antecedent have the verdict, and how many there are."""
    shares = distinct.where("verdict is not null").groupBy("verdict").agg((F.sum("n") / n_baskets).alias("share"))
    confidence = F.col("n") / F.col("all")
    rules = counts.join(shares, "verdict").select(
        F.xxhash64("antecedent", F.concat(F.lit("verdict:"), "verdict")).alias("rule_id"), "antecedent", "verdict",
        confidence.alias("confidence"), (confidence / F.col("share")).alias("lift"),
        (F.col("n") / n_baskets).alias("support"), *more,
    )
    return rules.where(
        (F.col("support") >= min_support) & (F.col("confidence") >= min_confidence) & (F.col("lift") > _LEAST_LIFT)
    )


def fired(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, mined) for the token sets (key, tokens) that a rule fits: the verdict of the surest rule.

    A token of an antecedent may be one of those ``alike``; of the ``closure``, if given, the tokens of the set count.
    """
    alike = F.col("alike") if "alike" in rules.columns else F.transform("antecedent", lambda t: F.array(t))
    index = rules.select(
        "rule_id", F.size("antecedent").alias("size"), F.posexplode(alike).alias("place", "tokens")
    ).select("rule_id", "size", "place", F.explode("tokens").alias("token"))
    hits = sets.select("key", F.explode("tokens").alias("token")).join(index, "token")
    full = hits.groupBy("key", "rule_id", "size").agg(F.size(F.collect_set("place")).alias("n")).where("n = size")
    what = [c for c in ("verdict", "confidence", "lift", "support", "closure") if c in rules.columns]
    full = full.join(rules.select("rule_id", *what), "rule_id")
    if "closure" in what:
        full = full.join(sets, "key").withColumn("size", F.size(F.array_intersect("tokens", "closure")))
    surest = full.groupBy("key").agg(
        F.max(F.struct("confidence", "lift", "size", "support", "verdict", "rule_id")).alias("best")
    )
    return surest.select("key", F.col("best.verdict").alias("mined"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow",
    min_support: float = 0.002, min_confidence: float = 0.8,
) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``rule`` is the given rule that decides, else null. Without one the surest mined rule decides, without that
    ``default``. Rules are mined from the urls that a given rule decides, of all combinations of their tokens; labels of one verdict only
    have no contrast and give no mined rule. Null urls and those without ``://`` have an empty host and
    path, and no rule. Repeated rows are judged alike; of rules of equal confidence the one with more lift
    (the rarer verdict), then more tokens, then more support, then the later verdict by name wins.
    """
    added = ("host", "path", "rule", "verdict")
    columns = [c for c in pages.columns if c.lower() not in added]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parts = pages.select(*columns, host.alias("host"), path.alias("path"))
    parts = parts.withColumns({
        "rule": given(rules, F.col("host"), F.col("path"), "name"),
        "_given": given(rules, F.col("host"), F.col("path"), "verdict"),
        "_tokens": tokens_of(F.col(url), F.col("host"), F.col("path")),
    })
    mined = mine(
        parts.where("_given is not null").select(
            F.col("_tokens").alias("tokens"), F.col("_given").alias("verdict")
        ),
        min_support, min_confidence, most=None,
    )
    key = F.array_join("_tokens", "\u0000")
    sets = parts.where("_given is null").select(key.alias("key"), F.col("_tokens").alias("tokens"))
    verdicts = fired(sets.groupBy("key").agg(F.first("tokens").alias("tokens")), mined)
    judged = parts.withColumn("_key", key).join(
        verdicts.withColumnRenamed("key", "_key"), "_key", "left"
    )
    return judged.select(
        *columns, "host", "path", "rule",
        F.coalesce("_given", "mined", F.lit(default)).alias("verdict"),
    )
