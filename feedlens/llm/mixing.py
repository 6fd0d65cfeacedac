"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact size per source. A source's budget is met
with whole copies of every document first; the rest is one more copy of some
documents, as many of each size as a proportional share and then a bounded
knapsack over the remaining budget say. Which documents of a size get it is
decided by a seeded order."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, materialize, null_key, salted_rank, without, word_count

#: Words left to the dynamic programme at most; larger rests are first reduced by whole documents.
KNAPSACK_BUDGET = 65_536
#: A size's documents are ordered in so many parts, each sorted on its own.
RANK_PARTS_BITS = 8


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take so that their sum is nearest ``budget`` (the lower on a tie).

    Bounded knapsack: counts are split into powers of two and ``via[s]`` keeps
    the item that first reached the sum s, so the choice can be walked back.
    Sums up to twice the budget are tried; memory is 5 bytes for each."""
    take = np.zeros(len(sizes), np.int64)
    top = 2 * budget
    if budget <= 0:
        return take
    reach, via = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int32)
    reach[0] = True
    items: list[tuple[int, int]] = []
    for i, (s, n) in enumerate(zip(sizes.tolist(), counts.tolist())):
        left, part = min(n, top // s) if s > 0 else 0, 1
        while left > 0 and not reach[budget]:
            part = min(part, left)
            w = s * part
            new = reach[: top + 1 - w] & ~reach[w:]
            via[w:][new] = len(items)
            reach[w:] |= new
            items.append((i, part))
            left, part = left - part, part * 2
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, part = items[via[at]]
        take[i] += part
        at -= int(sizes[i]) * part
    return take


def long_counts(sizes: np.ndarray, counts: np.ndarray, goal: int, budget: int) -> np.ndarray:
    """How many of each size to take for a ``goal`` above ``budget``: the knapsack in a unit that brings the goal within it.

    Exact if all sizes are multiples of the unit, else nearest in rounded sizes;
    what is then left within the budget goes to the exact knapsack."""
    open_ = (sizes > 0) & (counts > 0)
    if not open_.any():
        return np.zeros(len(sizes), np.int64)
    unit = max(int(np.gcd.reduce(sizes[open_])), -(-goal // budget))
    scaled = np.where(sizes > 0, np.maximum(1, (sizes + unit // 2) // unit), 0)
    take = knapsack(scaled, counts, max(1, (goal + unit // 2) // unit))
    left = goal - int((sizes * take).sum())
    return take + knapsack(sizes, counts - take, left) if 0 < left <= budget else take


def fit_counts(sizes: np.ndarray, counts: np.ndarray, target: float,
               budget: int = KNAPSACK_BUDGET) -> tuple[int, np.ndarray]:
    """(whole copies of every document, documents of each size that get one more) for one source."""
    total = int((sizes * counts).sum())
    if total <= 0:
        return 0, np.zeros(len(sizes), np.int64)
    copies = int(target // total)
    rest = int(round(target - copies * total))
    extra = np.floor(counts * (rest / total)).astype(np.int64)
    extra[sizes <= 0] = 0
    rest, goal, least = rest - int((sizes * extra).sum()), rest, extra.copy()
    share = counts * (max(rest, 0) / total)
    for i in np.lexsort((-sizes, -(share - np.floor(share)))):  # one more document each, until the knapsack can hold the rest
        if rest <= budget:
            break
        if 0 < sizes[i] <= rest and extra[i] < counts[i]:
            extra[i] += 1
            rest -= int(sizes[i])
    for i in np.argsort(-sizes, kind="stable"):  # then the longest that fit
        if rest <= budget:
            break
        if sizes[i] > 0:
            more = min(int(counts[i] - extra[i]), rest // int(sizes[i]))
            extra[i] += more
            rest -= more * int(sizes[i])
    if 0 < rest <= budget:
        extra += knapsack(sizes, counts - extra, rest)
        rest = goal - int((sizes * extra).sum())
    if rest and goal > budget:  # only longer documents are left: overshooting by one, and other choices of long documents, may be nearer
        tried = [extra, least + long_counts(sizes, counts - least, goal - int((sizes * least).sum()), budget),
                 long_counts(sizes, counts, goal, budget)]
        if ((sizes > 0) & (counts > extra)).any():
            one = extra.copy()
            one[np.flatnonzero((sizes > 0) & (counts > extra))[np.argmin(sizes[(sizes > 0) & (counts > extra)])]] += 1
            tried.append(one)
        extra = min(tried, key=lambda x: (abs(goal - int((sizes * x).sum())), int((sizes * x).sum())))
    return copies, extra


def targets(source_sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source_sizes (source, source_size) with ``target``.

    Sources in order of code point, nulls last, take the weights in turn and
    share ``share`` times all words; no target passes ``most`` times its
    source's size and the excess goes to the others by weight until none is
    above. Water filling in closed form: with sources by size over weight,
    those that are full come first, so the level is found from running sums.
    One row per source passes the windows, never documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(float(w)) for w in weights])
    w = (source_sizes.withColumn("at", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.element_at(pick, (F.col("at") % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    full = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "at")
    before, onward = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    budget = F.sum("source_size").over(every) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (w.withColumn("level", level)
            .withColumn("target", F.least("cap", F.max("level").over(every) * F.col("weight")))
            .select("source", "source_size", "target"))


def _fit_source(rows: pd.DataFrame, budget: int) -> pd.DataFrame:
    rows = rows.sort_values("size")
    copies, extra = fit_counts(rows["size"].to_numpy(np.int64), rows["docs"].to_numpy(np.int64),
                               float(rows["target"].iloc[0]), budget)
    return rows.assign(base=copies, extra=extra)[["key", "size", "source_size", "target", "base", "extra"]]


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0,
        seed: int = 42, budget: int = KNAPSACK_BUDGET) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and copies (how often the mix takes it).

    size counts the words of ``text``; null and empty texts have size 0 and
    are never taken. Copies are whole, 0 to ``most`` rounded up. Null sources
    form one source of their own; a null doc_id is a value like any other.
    Rows that repeat each count, and which of them is taken is all the same.
    An empty table gives an empty result. Input columns named like an added
    one are replaced by it; others are kept.

    The order inside a size is a seeded hash of doc_id and text, so reruns
    agree. Texts are shuffled once at most (not at all if the caller
    drops them); a source's histogram has a row per distinct size, and only
    that meets in one task."""
    docs = without(docs, "size", "source_size", "target", "copies")
    key, part, order, n, base, extra, rank = fresh(docs, "key", "part", "order", "n", "base", "extra", "rank")
    sized = (docs.withColumn("size", word_count(F.col("text"))).withColumn(key, null_key(F.col("source")))
             .withColumn(order, F.xxhash64(F.lit(seed), "doc_id", "text"))
             .withColumn(part, F.shiftrightunsigned(order, 64 - RANK_PARTS_BITS)))
    hist = materialize(sized.groupBy(F.col(key).alias("key"), "size", F.col(part).alias("part"))
                       .agg(F.count("*").alias("n"), F.first("source").alias("source")), "mix-sizes")
    by_size = hist.groupBy("key", "size").agg(F.sum("n").alias("docs"), F.first("source").alias("source"))
    by_source = by_size.groupBy("key").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"),
                                           F.first("source").alias("source"))
    goal = targets(by_source, weights, share, most).withColumn("key", null_key(F.col("source"))).drop("source")
    fit = (by_size.drop("source").join(goal, "key").groupBy("key")
           .applyInPandas(lambda rows: _fit_source(rows, budget),
                          "key string, size long, source_size long, target double, base long, extra long"))
    plan = materialize(hist.drop("source").join(fit, ["key", "size"]), "mix-plan")
    plan = plan.select(F.col("key").alias(key), "size", F.col("part").alias(part), F.col("n").alias(n),
                       "source_size", "target", F.col("base").alias(base), F.col("extra").alias(extra))
    ranked = salted_rank(sized, [key, "size"], [order, "doc_id"], part, rank, plan, n)
    took = F.when(F.col("size") > 0, F.col(base) + (F.col(rank) < F.col(extra)).cast("long")).otherwise(F.lit(0))
    return ranked.withColumn("copies", took.cast("int")).select(
        *[F.col(f"`{c}`") for c in docs.columns], "size", "source_size", "target", "copies")


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row ``copies`` times."""
    (at,) = fresh(mixed, "copy")
    return (mixed.where("copies > 0").withColumn(at, F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"`{c}`") for c in columns]))
