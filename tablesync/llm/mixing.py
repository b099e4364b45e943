"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies, between 0 and ``most``.
Among all rates that meet each source's token target, entropy balancing takes those closest
to 1 in relative entropy. They have the form of an exponential tilt of the odds,

    rate = most * e / (e + most - 1),   e = exp(multiplier * size / mean size),

with one multiplier per source, the solution of a convex dual. Rates depend on source and
size only, so the dual is solved on a histogram of sizes, which Spark counts: each source's is
one small group, in which Newton steps are taken. Rates are then rounded to whole copies such
that the error of a source stays below about half of its smallest texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stash
from .totals import running_total

#: Fixed values of the mix: weights of the sources in their order, repeating; the whole
#: mix as a share of all tokens; the most copies of a document.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST = 2

WORD = r"[^\x20\x09-\x0D]+"

NEWTON_STEPS = 60
TOLERANCE = 1e-9


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(cells: DataFrame, most: float = MOST, share: float = TOTAL_SHARE) -> DataFrame:
    """``source, source_size, target`` from a histogram ``source, size, n``.

    Sources are ordered by code point, null last, and weigh ``WEIGHTS`` in turn. They share
    ``share`` of all tokens by weight; a target above ``most`` times its source stops there,
    and the excess is shared among the rest until none is above.
    """
    sums = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    # A row per source: one narrow sort, whatever the number of documents.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.lit(WEIGHTS[-1])
    for place, value in enumerate(WEIGHTS[:-1]):
        weight = F.when(F.col("_at") % len(WEIGHTS) == place, F.lit(value)).otherwise(weight)
    weighed = sums.withColumn("_at", F.row_number().over(order) - 1).withColumn(
        "_weight", weight.cast("double")
    )
    cap = F.col("source_size") * F.lit(float(most))
    weighed = stash(weighed.drop("_at").withColumn("_cap", cap), "weights")
    # The level per unit of weight rises until no further source is above its cap.
    level, closed = 0.0, -1
    while True:
        full = F.col("_weight") * F.lit(level) >= F.col("_cap")
        row = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(full, 1)).alias("closed"),
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
        ).first()
        if row["open"] == 0 or row["closed"] == closed:
            break
        closed = row["closed"]
        level = max(level, (share * row["all"] - row["given"]) / row["open"])
    target = F.least(F.col("_weight") * F.lit(level), F.col("_cap"))
    if row["open"] == 0:
        target = F.col("_cap")
    return weighed.select("source", "source_size", target.alias("target"))


def _rates(multiplier: float, size: np.ndarray, mean: float, most: float) -> np.ndarray:
    with np.errstate(invalid="ignore"):  # an infinite multiplier of no words
        power = -multiplier * size / mean
    return most / (1 + (most - 1) * np.exp(np.fmax(np.fmin(power, 500.0), -500.0)))


def balance(size: np.ndarray, n: np.ndarray, target: float, most: float) -> tuple[float, float]:
    """The mean size of a source and its multiplier, by safeguarded Newton steps.

    The gap of a source, tokens at the current rates less its target, rises with the
    multiplier. A step that leaves the bracket known so far is replaced by its middle.
    Sources at an end (target 0, or ``most`` times the source) have an infinite multiplier.
    """
    whole = float(n @ size)
    mean = max(whole / float(n.sum()), 1e-9)
    part = target / (whole * most) if whole else 0.0
    if part >= 1 - 1e-12:
        return mean, np.inf
    if part <= 1e-12 or most <= 1:
        return mean, -np.inf
    at = float(np.log(part * (most - 1) / (1 - part)))
    low, high = -np.inf, np.inf
    for _ in range(NEWTON_STEPS):
        rate = _rates(at, size, mean, most)
        tokens = n * size * rate
        gap = float(tokens.sum()) - target
        slope = float((tokens * (1 - rate / most) * size).sum()) / mean
        low, high = (at if gap < 0 else low), (at if gap > 0 else high)
        if abs(gap) <= TOLERANCE * target or high - low <= 1e-13 * abs(at):
            break
        newton = at - gap / slope if slope else np.nan
        if low < newton < high:
            at = newton
        elif low == -np.inf:
            at = high - abs(high) - 1
        elif high == np.inf:
            at = low + abs(low) + 1
        else:
            at = (low + high) / 2
    return mean, at


def _round_cells(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for the cells of one source, largest texts first.

    What a cell takes too much or too little is carried to the next, smaller texts.
    """
    cells = cells.sort_values("size", ascending=False, kind="stable")
    sizes, counts = cells["size"].to_numpy(np.int64), cells["n"].to_numpy(np.int64)
    rates = cells["rate"].to_numpy(float)
    most = cells["most"].to_numpy(np.int64)
    copies = np.zeros(len(cells), np.int64)
    owed = 0.0
    for i, (size, count, rate) in enumerate(zip(sizes, counts, rates)):
        wanted = count * rate + (owed / size if size else 0.0)
        copies[i] = min(max(round(wanted), 0), count * most[i])
        owed += (count * rate - copies[i]) * size
    return pd.DataFrame(
        {
            "source": cells["source"],
            "size": sizes,
            "rate": rates,
            "base": copies // np.maximum(counts, 1),
            "extra": copies % np.maximum(counts, 1),
        }
    )


def _plan_cells(cells: pd.DataFrame) -> pd.DataFrame:
    """Rates and whole copies for the cells of one source, with its size and target."""
    cells = cells.sort_values("size", kind="stable")
    size, n = cells["size"].to_numpy(float), cells["n"].to_numpy(float)
    target, most = float(cells["target"].iloc[0]), float(cells["most"].iloc[0])
    mean, multiplier = balance(size, n, target, most)
    plan = _round_cells(cells.assign(rate=_rates(multiplier, size, mean, most)))
    return plan.assign(source_size=cells["source_size"].iloc[0], target=target)


def mix_sources(documents: DataFrame, most: int = MOST, share: float = TOTAL_SHARE) -> DataFrame:
    """``doc_id, size, source_size, target, taken, rate, copies`` of every document.

    ``size`` is the number of words (0 for null or empty text), ``copies`` how often the mix
    takes the document (0 to ``most``) and ``taken`` its words so taken. Within a source and
    size the copies fall by the hash of ``doc_id``, so reruns agree; repeated rows are
    documents of their own. An empty table gives an empty result. A null source is a source.
    """
    sized = stash(
        documents.select("doc_id", "source", size_in_words(F.col("text")).alias("size")), "sizes"
    )
    return _mix_sized(sized, most, share).drop("source")


def _mix_sized(sized: DataFrame, most: int, share: float) -> DataFrame:
    cells = stash(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    targets = source_targets(cells, most, share)
    names = targets.select(F.col("source").alias("_source"), "source_size", "target")
    goals = cells.join(names, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "size", "n", F.lit(most).cast("long").alias("most"), "source_size", "target"
    )
    # A source with S words has at most sqrt(2 S) different sizes, so this group is small.
    kind = cells.schema["source"].dataType.simpleString()
    plan = goals.groupBy("source").applyInPandas(
        _plan_cells,
        f"source {kind}, size long, rate double, base long, extra long, source_size long, target double",
    )
    plan = stash(plan, "plan").withColumnsRenamed({"source": "_source", "size": "_size"})
    # Copies beyond the base go to the first documents of a cell in the order of the hash.
    ranked = running_total(
        sized.withColumn("_one", F.lit(1)), ["source", "size"],
        F.xxhash64("doc_id", F.lit("mix")), ["doc_id"], "_one", "_rank",
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    copies = F.col("base") + (F.col("_rank") < F.col("extra")).cast("long")
    kept = [name for name in sized.columns if name not in ("source", "size")]
    return ranked.join(plan, same).select(
        *kept, "source", "size", "source_size", "target",
        (copies * F.col("size")).alias("taken"), "rate", copies.alias("copies"),
    )


def repeat_mixed(documents: DataFrame, most: int = MOST, share: float = TOTAL_SHARE) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns only."""
    # Rows are told apart by id and content; rows equal in both are folded and their copies
    # added up. Maps cannot be hashed, so they count as their JSON.
    content = F.xxhash64(*[
        F.to_json(name) if "map<" in kind else F.col(name) for name, kind in documents.dtypes
    ])
    keyed = documents.select(
        F.struct("*").alias("_all"), F.col("doc_id").alias("_id"), content.alias("_row")
    )
    sized = documents.select(
        "doc_id", content.alias("_row"), "source", size_in_words(F.col("text")).alias("size")
    )
    times = _mix_sized(stash(sized, "sizes"), most, share).groupBy("doc_id", "_row")
    times = times.agg(F.sum("copies").alias("_times")).where("_times > 0")
    times = times.withColumnRenamed("_row", "_content")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_row") == F.col("_content"))
    kept = keyed.dropDuplicates(["_id", "_row"]).join(times, same)
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(
        "_all.*"
    )
