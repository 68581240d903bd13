"""Secret scans by a trigram inverted index.

From each rule's regex follows a Boolean query over trigrams that every match must hold: an AND of clauses, a clause
being an OR of branches, a branch an AND of trigrams. The index has the postings (trigram, text) of the queries'
trigrams; their intersections are the candidates, which the regex then verifies. A rule without mandatory
trigrams is verified on every text. Texts are compared in lower case here, so that the index holds for
rules of either case; positions come from the text as it is.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BRANCHES = 64


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and Python read alike. ``group`` has to have ``least`` characters in a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The public formats of secrets.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of such characters are maximal, so shorter ones can be left out at once.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
)


def _trigrams(text: str) -> frozenset:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[list[frozenset]]:
    """The clauses of a regex: each a list of branches, each a set of trigrams; none if there is none."""
    clauses: list[list[frozenset]] = []

    def close(runs: list[str]) -> list[str]:
        branches = [_trigrams(run) for run in runs]
        if all(branches):
            clauses.append(branches)
        return [""]

    def strings(nodes) -> list[str] | None:
        """All strings that the nodes match, if they are few and fixed."""
        found = [""]
        for op, value in nodes:
            name = str(op)
            if name == "LITERAL":
                more = [chr(value).lower()]
            elif name == "SUBPATTERN":
                more = strings(value[-1])
            elif name == "BRANCH":
                each = [strings(part) for part in value[1]]
                more = None if None in each else list(itertools.chain(*each))
            elif name == "MAX_REPEAT" and value[1] == 1 and value[0] in (0, 1):
                more = strings(value[2])
                more = more and ([""] if value[0] == 0 else []) + more
            else:
                more = None
            if more is None or len(found) * len(more) > _BRANCHES:
                return None
            found = [a + b for a in found for b in more]
        return found

    runs = [""]
    for node in re._parser.parse(pattern):
        own = strings([node])
        if own is None or len(runs) * len(own) > _BRANCHES:
            runs = close(runs)
        else:
            runs = [a + b for a in runs for b in own]
    close(runs)
    return clauses


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("again"), text).alias("d2")]


def candidates(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(d1, d2, kind): texts, by digest, that hold what the query of a rule asks for.

    ``texts`` has (d1, d2, text). Only rules with a query are looked up.
    """
    spark = texts.sparkSession
    queries = [
        (rule.kind, clause, branch, trigram, len(trigrams), len(found))
        for rule in rules
        for found in [trigram_query(rule.pattern)]
        for clause, branches in enumerate(found)
        for branch, trigrams in enumerate(branches)
        for trigram in sorted(trigrams)
    ]
    table = spark.createDataFrame(
        queries, "kind string, clause int, branch int, trigram string, trigrams int, clauses int"
    ).withColumn("hash", F.hash(F.col("trigram").cast("binary"))).drop("trigram")
    hashes = sorted({r["hash"] for r in table.select("hash").distinct().collect()})
    # Postings. Bytes of three positions each, as numbers; two trigrams of one number add candidates only.
    lower = texts.select("d1", "d2", F.lower("text").cast("binary").alias("bytes"))
    places = F.explode(F.sequence(F.lit(1), F.octet_length("bytes") - 2))
    postings = (
        lower.where(F.octet_length("bytes") > 2).select("d1", "d2", "bytes", places.alias("at"))
        .select("d1", "d2", F.hash(F.substr("bytes", F.col("at"), F.lit(3))).alias("hash"))
        .where(F.col("hash").isin(hashes)).distinct()
    )
    branches = postings.join(table, "hash").groupBy(
        "d1", "d2", "kind", "clause", "branch", "trigrams", "clauses"
    ).agg(F.count("*").alias("n")).where("n >= trigrams")
    return branches.groupBy("d1", "d2", "kind", "clauses").agg(
        F.count_distinct("clause").alias("n")
    ).where("n = clauses").select("d1", "d2", "kind")


def find(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, text: str = "text") -> DataFrame:
    """(d1, d2, spans) of each distinct text with a secret, by the two digests of the text.

    spans are the leftmost non-overlapping matches of each rule, without those whose group is too short,
    as (start, rank of the rule, end, kind), in code points, end exclusive, in this order.
    """
    def of_rule(values: Sequence) -> Column:
        """The rule's value as an expression of its kind: no text is dealt by the few kinds."""
        found = F.lit(None)
        for rule, value in zip(rules, values, strict=True):
            found = F.when(F.col("kind") == rule.kind, F.lit(value)).otherwise(found)
        return found

    texts = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    texts = texts.select(*_key(F.col("text")), "text")
    indexed = [r for r in rules if trigram_query(r.pattern)]
    to_verify = texts.join(candidates(texts, indexed), ["d1", "d2"]) if indexed else None
    for rule in rules:
        if rule not in indexed:
            full = texts.where(F.col("text").rlike(rule.pattern)).withColumn("kind", F.lit(rule.kind))
            to_verify = full if to_verify is None else to_verify.unionByName(full)
    # Copies of a text are verified once.
    to_verify = to_verify.dropDuplicates(["d1", "d2", "kind"]).withColumns({
        "rank": of_rule(range(len(rules))).cast("int"),
        "pattern": of_rule([r.pattern for r in rules]),
        "part": of_rule([r.group for r in rules]),
        "least": of_rule([r.least for r in rules]),
    })
    # A text is its gaps and matches in turn; a match starts where all before it ends.
    pieces = to_verify.select(
        "d1", "d2", "kind", "rank", "least",
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all("text", "pattern", F.lit(0)).alias("match"),
            F.transform(F.split("text", F.col("pattern"), -1), F.length).alias("gap"),
            F.when(F.col("part") == 2, F.regexp_extract_all("text", "pattern", F.lit(2)))
            .otherwise(F.regexp_extract_all("text", "pattern", F.lit(0))).alias("part"),
        )).alias("at", "piece"),
    ).select("d1", "d2", "kind", "rank", "least", "at", "piece.*").where("match is not null")
    upto = Window.partitionBy("d1", "d2", "kind").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    pieces = pieces.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    return pieces.where(F.length("part") >= F.col("least")).groupBy("d1", "d2").agg(
        F.sort_array(F.collect_list(F.struct(
            (F.col("end") - F.length("match")).alias("start"), "rank", "end", "kind"
        ))).alias("spans")
    )


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, text: str = "text") -> DataFrame:
    """All rows with ``secret_spans``, empty where there is none; a column of that name is replaced.

    Null and empty texts have no spans; repeated texts have the same.
    """
    columns = [c for c in docs.columns if c.lower() != "secret_spans"]
    d1, d2 = _key(F.coalesce(F.col(text).cast("string"), F.lit("")))
    found = find(docs, rules, text).select(
        F.col("d1").alias("_secret_d1"), F.col("d2").alias("_secret_d2"), "spans"
    )
    keyed = docs.select(*columns, d1.alias("_secret_d1"), d2.alias("_secret_d2"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return keyed.join(found, ["_secret_d1", "_secret_d2"], "left").select(
        *columns, F.coalesce("spans", none).alias("secret_spans")
    )
