"""Mixing sources to target weights by Pareto order sampling.

A source that has to give more words than it holds first gives certain whole copies of each document. What
is left (the rest) is a sample: each row gets a random number u from its source, id and text, and a number of its
own among equal rows. With an inclusion probability p it is ranked by q = (u / (1 - u)) / (p / (1 - p)), the random odds over the
inclusion odds, and the lowest ranks are taken.

The probabilities are size-aware, as the sample is fixed in words. Documents of more than a hundredth of the rest are long. Of them a fixed number is
taken, p times as many as there are, with p the rest's share of the source (the fraction decides by chance whether it is one more), in
the order of q, while they do not exceed the rest. The others have the probability that fills up what the long ones left, so
it is lower where a long one was taken and higher where not, and p in the mean. They are taken in the order of q while the words are not
exceeded; where more than a hundredth is missing, further rounds go on behind the document that did not fit, then to the long ones that
were not taken, and one more document fills what is missing.

As the choice is a few intervals of that order, it is a filter on the documents: the texts are never sorted or
shuffled (but for rows equal to another), only (source, order, size) is, over range partitions that a large
source spreads over. The plan of the sources is a written table, small enough to be sent to the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areacast.operators.running import running_totals
from areacast.sources.tables import written

# Between the counted words: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
# Documents of more than this part of the rest are long; a rest is full with so small a part missing.
LONG = CLOSE = 0.01


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Add ``target``: a share of the total size by weight, at most ``most`` times the source's size.

    ``sizes`` has (source, source_size). The weights repeat over the sources in code point order, null
    last. What a source cannot take is shared again by weight: with sources in the order of most * size
    / weight, the first ones are at their limit, and from the first whose limit is no less than its share
    of what is left, all have that share. Its windows hold one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.lit(None).cast("double")
    for i, w in enumerate(weights):
        weight = F.when(F.pmod(number, F.lit(len(weights))) == i, float(w)).otherwise(weight)
    limit = F.lit(float(most)) * F.col("source_size")
    rows = sizes.select("*", weight.alias("weight"), number.alias("number"), limit.alias("limit"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    rows = rows.withColumn("place", F.row_number().over(by_limit))
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("place"))
    rows = rows.withColumn("first_open", F.min(open_).over(everything))
    shared = F.when(F.col("place") == F.col("first_open"), F.col("level"))
    rows = rows.withColumn("shared", F.max(shared).over(everything))
    target = F.when(F.col("place") < F.col("first_open"), F.col("limit")).otherwise(
        F.least(F.col("shared") * F.col("weight"), F.col("limit"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def _number(key: Column) -> Column:
    """A number in (0, 1) from the key, the same on every run and in other systems."""
    digest = F.md5(key.cast("string").cast("binary"))
    value = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double")
    return (value + 0.5) / float(1 << 48)


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; a probability of 0 or 1 is taken a little inside."""
    inside = F.greatest(F.least(p, F.lit(1 - 1e-12)), F.lit(1e-12))
    return (u / (1 - u)) / (inside / (1 - inside))


def _order(size: Column, u: Column, plan: dict[str, Column]) -> list[Column]:
    """``stage`` and ``q``: long documents that are taken; short ones; the other long ones."""
    long = size > LONG * plan["rest"]
    q = pareto_rank(u, F.when(long, plan["p"]).otherwise(plan["p_short"]))
    taken = (q <= plan["q_long"]) & (size <= plan["rest"])
    stage = F.when(~long, 1).when(taken, 0).otherwise(2)
    return [stage.alias("stage"), q.alias("q")]


def _with_long(narrow: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """The plan with ``q_long``, the rank up to which long documents are taken, ``left`` and ``p_short``."""
    own = plan.select("source", "rest", "p")
    rows = narrow.join(own.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    long = F.col("size") > LONG * F.col("rest")
    stats = rows.groupBy("source").agg(
        F.sum(F.when(long & (F.col("size") <= F.col("rest")), 1).otherwise(0)).alias("n_long"),
        F.sum(F.when(~long, F.col("size")).otherwise(0)).alias("short_size"),
    )
    # As many as the probabilities add up to; a source's own random number rounds the sum.
    name = F.concat_ws(":", F.lit("long"), F.coalesce(F.col("source").cast("string"), F.lit("")),
                       F.col("source").isNull().cast("string"), F.lit(str(seed)))
    fixed = plan.join(stats.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    fixed = written(fixed.withColumn("n_taken", F.floor(F.col("n_long") * F.col("p") + _number(name))), "mix_long")
    ranked = rows.where(long & (F.col("size") <= F.col("rest"))).select(
        "source", "size", pareto_rank(F.col("u"), F.col("p")).alias("q"), F.lit(1).alias("one")
    )
    ranked = running_totals(ranked, [F.col("q")], {"one": "place", "size": "upto"}, ["source"])
    limits = fixed.select(F.col("source").alias("of"), "n_taken", "rest")
    first = ranked.join(limits, F.col("source").eqNullSafe(F.col("of"))).where(
        (F.col("place") <= F.col("n_taken")) & (F.col("upto") <= F.col("rest"))
    ).groupBy(F.col("source").alias("of")).agg(F.max("q").alias("q_long"), F.max("upto").alias("got"))
    found = fixed.join(first, F.col("source").eqNullSafe(F.col("of")), "left")
    left = F.col("rest") - F.coalesce("got", F.lit(0))
    return written(found.select(
        *plan.columns, F.coalesce("q_long", F.lit(0.0)).alias("q_long"), left.alias("left"),
        F.coalesce(left / F.nullif(F.col("short_size"), F.lit(0)), F.lit(0.0)).alias("p_short"),
    ), "mix_plan")


def _in_rounds(rounds: Column, size: Column, order: Column) -> Column:
    """Whether one of the rounds (missing, after, last) takes the document."""
    return F.coalesce(F.exists(rounds, lambda r: (
        (size <= r["missing"]) & (r["after"].isNull() | (order > r["after"])) & (order <= r["last"])
    )), F.lit(False))


def _numbered(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` and (source, u, size) of each row, where rows of equal ``_mix_u`` have got numbers of their own."""
    seen = docs.groupBy(
        F.col("_mix_source").alias("source"), F.col("_mix_u").alias("u"), F.col("_size").alias("size")
    ).agg(F.count("*").alias("n"))
    seen = written(seen, "mix_sizes")
    again = seen.groupBy("u").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("u").alias("_mix_again"))
    narrow = seen.select("source", "u", "size")
    if seen.where("n > 1").isEmpty() and again.isEmpty():
        return docs, narrow
    again = written(again, "mix_again")
    same = F.col("_mix_u") == F.col("_mix_again")
    # Which of equal rows gets which number does not matter, but each gets one of its own.
    rows = docs.join(again, same, "left_semi").withColumns({"_mix_salt": F.rand(seed), "_mix_one": F.lit(1)})
    rows = running_totals(rows, [F.col("_mix_u"), F.col("_mix_salt")], {"_mix_one": "_mix_no"}, ["_mix_u"])
    own = _number(F.concat_ws(":", F.col("_mix_u").cast("string"), F.col("_mix_no").cast("string")))
    rows = rows.withColumn("_mix_u", own).select(*docs.columns)
    one_each = narrow.join(again, F.col("u") == F.col("_mix_again"), "left_anti")
    return (
        docs.join(again, same, "left_anti").unionByName(rows),
        one_each.unionByName(rows.select(
            F.col("_mix_source").alias("source"), F.col("_mix_u").alias("u"), F.col("_size").alias("size")
        )),
    )


def mix(
    docs: DataFrame, id_column: str, source: str = "source", text: str = "text",
    weights: Sequence[float] = (5, 2, 1), most: int = 3, seed: int = 8,
) -> DataFrame:
    """All documents with ``_size``, ``_source_size``, ``_target`` and ``_copies``, the times it is taken.

    Columns of these names are replaced.
    A size is the number of words; null, empty and blank texts have none, so they count for nothing and are
    taken like others. A null source is a source. Each row is drawn by itself, also where ids are null or
    repeated. Besides the whole copies, a source's documents have about the same inclusion probability over the seeds; one
    that has more words than the source has to give besides the whole copies is left out of that part, unless it
    alone comes nearer to the target than nothing. Without any words every target is 0 and nothing is taken.
    """
    added = ("_size", "_source_size", "_target", "_copies")
    columns = [c for c in docs.columns if c.lower() not in added]
    key = F.concat_ws(
        ":", F.coalesce(F.col(source).cast("string"), F.lit("")),
        F.coalesce(F.col(id_column).cast("string"), F.lit("")),
        F.xxhash64(F.col(text)).cast("string"), F.lit(str(seed)),
    )
    own = docs.select(
        *columns, word_count(F.col(text)).alias("_size"),
        F.col(source).alias("_mix_source"), _number(key).alias("_mix_u"),
    )
    # One narrow row per document; from here on no text is read until the documents are marked.
    own, narrow = _numbered(own, seed)
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(times)).withColumn("p", times - F.floor(times))
    # A part of a few words in 10^9 is a rounding difference of the target.
    plan = plan.withColumn("p", F.when(F.col("p") > 1e-9, F.col("p")).otherwise(0.0))
    plan = written(plan.withColumn("rest", F.col("p") * F.col("source_size")), "mix_targets")
    plan = _with_long(narrow, plan, seed)

    parts = ("rest", "p", "p_short", "q_long")
    rests = plan.select(F.col("source").alias("of"), *parts, "left").where("p > 0")
    placed = narrow.join(rests, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "size", *_order(F.col("size"), F.col("u"), {c: F.col(c) for c in parts})
    ).where("stage > 0")
    order = F.struct("stage", "q")
    after = F.lit(None).cast("struct<stage:int,q:double>")
    state = rests.select("of", "rest", F.col("left").alias("missing"), after.alias("after"))
    rounds = None
    while True:
        # In order, while the words are not exceeded; the next round goes on behind what did not fit.
        fits = placed.join(state, F.col("source").eqNullSafe(F.col("of"))).where(
            (F.col("size") <= F.col("missing")) & (F.col("after").isNull() | (order > F.col("after")))
        ).select("source", "size", "stage", "q", "missing")
        totals = running_totals(fits, [F.col("stage"), F.col("q")], {"size": "upto"}, ["source"])
        got = totals.where("upto <= missing").groupBy(F.col("source").alias("got_of")).agg(
            F.max(order).alias("last"), F.max("upto").alias("got")
        )
        step = written(state.join(got, F.col("of").eqNullSafe(F.col("got_of")), "left").select(
            "of", "rest", "missing", "after", "last",
            (F.col("missing") - F.coalesce("got", F.lit(0))).alias("left"),
        ), "mix_round")
        rounds = step if rounds is None else rounds.union(step)
        state = step.where(F.col("last").isNotNull() & (F.col("left") > CLOSE * F.col("rest"))).select(
            "of", "rest", F.col("left").alias("missing"), F.col("last").alias("after")
        )
        if state.isEmpty():
            break
    done = rounds.groupBy(F.col("of").alias("done_of")).agg(
        F.collect_list(F.struct("missing", "after", "last")).alias("rounds"), F.min("left").alias("left")
    )
    # The words still missing are given by the one document left over that comes nearest to them.
    nearest = placed.join(done, F.col("source").eqNullSafe(F.col("done_of"))).where(
        F.abs(F.col("size") - F.col("left")) < F.col("left")
    ).where(~_in_rounds(F.col("rounds"), F.col("size"), order)).groupBy(F.col("source").alias("of")).agg(
        F.min(F.struct(F.abs(F.col("size") - F.col("left")), order.alias("order")))["order"].alias("filler")
    )
    plan = written(plan.join(done, F.col("source").eqNullSafe(F.col("done_of")), "left").join(
        nearest, F.col("source").eqNullSafe(F.col("of")), "left"
    ).select(
        F.col("source").alias("_mix_of"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"), F.col("whole").alias("_mix_whole"),
        *[F.col(c).alias(f"_mix_{c}") for c in parts],
        F.col("rounds").alias("_mix_rounds"), F.col("filler").alias("_mix_filler"),
    ), "mix_choice")

    own_order = F.struct(*_order(F.col("_size"), F.col("_mix_u"), {c: F.col(f"_mix_{c}") for c in parts}))
    chosen = (own_order["stage"] == 0) | _in_rounds(F.col("_mix_rounds"), F.col("_size"), own_order) | (
        own_order == F.col("_mix_filler")
    )
    one_more = (F.col("_mix_p") > 0) & F.coalesce(chosen, F.lit(False))
    marked = own.join(plan, F.col("_mix_source").eqNullSafe(F.col("_mix_of")), "left")
    return marked.select(
        *columns, "_size", "_source_size", "_target",
        (F.col("_mix_whole") + F.when(one_more, 1).otherwise(0)).cast("int").alias("_copies"),
    )


def taken(docs: DataFrame, id_column: str, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns only."""
    mixed = mix(docs, id_column, **options)
    times = F.explode(F.array_repeat(F.lit(0), F.col("_copies")))
    return mixed.withColumn("_mix_time", times).select(*docs.columns)
