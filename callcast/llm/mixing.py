"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are counted into cells, one per combination of the margin columns
(such as source, language and topic), with the sum of their tokens.  Raking
scales the cells to each margin's target shares in turn, until all margins hold
together within ``tolerance``.  A sample cannot hold more of a cell than there
is, so each scaling stops at the tokens of the cell, and the other cells of its
margins take up the rest in the next scalings.  A margin value that has fewer
tokens than its share asks for goes in whole, and the other values share what is
missing by their shares.  A document's chance is raked / actual tokens of its
cell; one common factor makes the expected tokens of the sample ``keep_share``
of the corpus exactly.  Where no sample meets all margins, raking ends after
``rounds`` rounds; ``reached`` lists the shares asked for and reached.

Only cells are raked: the documents are read twice, once for the partial sums
of the cells and once for the draw, and are never shuffled when the cells are
few.  The draw is a hash of the id, so it does not depend on partitions, order
or a task that runs again.

Defined results: a null margin value is a value of its own; a text without
tokens counts as one; a value without a target share, or with share 0, is never
sampled; repeated rows and rows that share an id are drawn alike, null ids too;
an empty table gives an empty result.  Result columns that clash with input
columns replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcast.session import materialize

#: Cells up to which the documents are joined with a broadcast, else with a shuffle.
FEW_CELLS = 100_000
#: Rounds of raking between two comparisons with the goals.
CHECK_ROUNDS = 4


def token_count(text: Column) -> Column:
    """White-space separated tokens, one at least."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)), F.lit(1)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by the form of a text, for tables that have no topic column."""
    return (
        F.when(text.contains(" | "), "table").when(text.contains("!!"), "shout").when(text.contains("icense"), "licensed")
        .when(text.contains("@"), "contact").otherwise("prose")
    )


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id: 52 bits of its MD5."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cell_table(docs: DataFrame, margins: list[str], tokens: str) -> DataFrame:
    return docs.groupBy(*margins).agg(F.sum(tokens).cast("double").alias("tokens"))


def together(cells: DataFrame) -> DataFrame:
    """A written table of at most FEW_CELLS cells in one partition, so that no sum over a margin needs a shuffle; a larger one stays dealt out."""
    return cells.coalesce(1) if cells.count() <= FEW_CELLS else cells


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares (value, share): the actual token shares, to a power, scaled to sum 1.

    A power of 1 keeps the shares, 0 makes them equal; between, small ones gain.
    """
    total = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("t"))
    whole = total.agg(F.sum("t").alias("whole")).first().whole
    return total.select("value", (F.col("t") / F.lit(whole)).alias("share"))


def _goals(cells: DataFrame, margin: str, shares: DataFrame, keep_share: float | None) -> DataFrame:
    """(value, goal): the tokens that a margin's values are to have, at most what they have if ``keep_share`` is given."""
    there = cells.groupBy(F.col(margin).alias("_v")).agg(F.sum("tokens").alias("tokens"))
    whole = F.lit(cells.agg(F.sum("tokens").alias("t")).first().t or 0.0)
    both = there.join(shares, F.col("_v").eqNullSafe(F.col("value")), "left").select("_v", "tokens", (F.coalesce("share", F.lit(0.0)) * whole).alias("weight"))
    if keep_share is None:
        return both.select(F.col("_v").alias("value"), F.col("weight").alias("goal"))
    return chances(both, keep_share).select(F.col("_v").alias("value"), (F.col("prob") * F.col("tokens")).alias("goal"))


def gap(raked: DataFrame, margins: list[str]) -> float:
    """The largest difference between a margin value's tokens and its goal, as a share of all goals."""
    worst = None
    for m in margins:
        one = raked.groupBy(m).agg(F.sum("weight").alias("w"), F.first(f"_g_{m}").alias("g")).agg((F.max(F.abs(F.col("w") - F.col("g"))) / F.sum("g")).alias("gap"))
        worst = one if worst is None else worst.unionAll(one)
    return worst.agg(F.max("gap").alias("gap")).first().gap or 0.0


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 24, keep_share: float | None = None, tolerance: float = 0.0) -> DataFrame:
    """``cells`` with ``weight``: tokens scaled so that each margin has its target shares.

    Without ``keep_share`` the weights add up to the whole; with it to that share, and no cell
    weighs more than its tokens.  Every fourth round the cells are written and the margins compared
    with their goals; raking ends when none is off by more than ``tolerance``.
    """
    margins = list(targets)
    out = cells.withColumn("weight", F.col("tokens"))
    for m, t in targets.items():
        goals = _goals(cells, m, t, keep_share).select(F.col("value").alias(f"_v_{m}"), F.col("goal").alias(f"_g_{m}"))
        out = out.join(goals, F.col(m).eqNullSafe(F.col(f"_v_{m}")), "left").drop(f"_v_{m}")
    for r in range(1, rounds + 1):
        for m in margins:
            there = F.sum("weight").over(Window.partitionBy(m))
            scaled = F.when(there > 0, F.col("weight") * F.col(f"_g_{m}") / there).otherwise(F.lit(0.0))
            out = out.withColumn("weight", scaled if keep_share is None else F.least("tokens", scaled))
        if r % CHECK_ROUNDS == 0 or r == rounds:
            out = together(materialize(out, "mixing-raked"))
            if gap(out, margins) <= tolerance:
                break
    return out.select(*cells.columns, "weight")


def reached(drawn: DataFrame, targets: dict[str, DataFrame], tokens: str = "tokens") -> DataFrame:
    """(margin, value, target, share): the shares asked for, and those of the expected tokens of a result of ``sample``."""
    whole = drawn.agg(F.sum(F.col(tokens) * F.col("prob")).alias("t")).first().t
    out = None
    for m, t in targets.items():
        had = drawn.groupBy(F.col(m).alias("_v")).agg((F.sum(F.col(tokens) * F.col("prob")) / F.lit(whole)).alias("share"))
        want = t.select(F.col("value"), F.col("share").alias("target"))
        one = had.join(want, F.col("_v").eqNullSafe(F.col("value")), "left").select(F.lit(m).alias("margin"), F.col("_v").cast("string").alias("value"), F.coalesce("target", F.lit(0.0)).alias("target"), "share")
        out = one if out is None else out.unionAll(one)
    return out


def chances(raked: DataFrame, keep_share: float) -> DataFrame:
    """``raked`` with ``prob`` = min(1, factor * weight / tokens), expected tokens ``keep_share`` of all (or as near as possible)."""
    ratio = F.col("weight") / F.col("tokens")
    whole = raked.agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).first()
    goal, factor = keep_share * (whole.t or 0.0), keep_share * (whole.t or 0.0) / whole.w if whole.w else 0.0
    while whole.w:
        full = ratio * F.lit(factor) >= 1
        now = raked.agg(F.sum(F.when(full, F.col("tokens"))).alias("t"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if not now.w:
            break
        new = max(factor, (goal - (now.t or 0.0)) / now.w)
        if new <= factor * (1 + 1e-12):
            break
        factor = new
    return raked.withColumn("prob", F.round(F.least(F.lit(1.0), ratio * F.lit(factor)), 9))


def sample(docs: DataFrame, margins: list[str], powers: dict[str, float], tokens: str = "tokens", doc_id: str = "doc_id", keep_share: float = 0.5, rounds: int = 24, seed: int = 11, tolerance: float = 5e-4) -> DataFrame:
    """``docs`` with ``prob`` and ``kept``; targets are tempered shares with one power per margin."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("prob", "kept")])
    cells = together(materialize(cell_table(docs, margins, tokens), "mixing-cells"))
    raked = rake(cells, {m: tempered(cells, m, powers[m]) for m in margins}, rounds, keep_share, tolerance)
    table = chances(raked, keep_share).select(*[F.col(m).alias(f"_m_{m}") for m in margins], "prob")
    same = None
    for m in margins:
        one = F.col(m).eqNullSafe(F.col(f"_m_{m}"))
        same = one if same is None else same & one
    if raked.count() <= FEW_CELLS:
        table = F.broadcast(table)
    joined = docs.join(table, same, "left").drop(*[f"_m_{m}" for m in margins])
    return joined.withColumn("kept", uniform(F.col(f"`{doc_id}`"), seed) < F.col("prob"))
