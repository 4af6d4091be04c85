"""Mixing sources to target weights, by iterative proportional fitting.

Documents are summed into cells (one per combination of the dimensions, for
instance source x language x topic).  The cells' token weights are raked:
each sweep scales them to the target share of every dimension in turn, until
all marginals agree with the targets.  A document is then sampled with the
calibrated probability ``p = c * (raked weight / tokens of its cell)``, where
``c`` is the largest factor that keeps every ``p`` at most 1 (or a smaller
one that meets a token budget), so the expected token mix of the sample has
the target marginals.

Everything is DataFrame functions.  Rows only meet in a partially
aggregated sum per cell; raking runs on the cell table, and the cells' rates
are joined back to the documents (broadcast by Spark only when the written
cell table is small; otherwise a hot cell is split by the adaptive join).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._util import WORD, Scratch, fresh


OUTPUTS = {"mix_weight", "mix_p", "mix_kept"}


def word_count(text: str = "text") -> Column:
    """Words of a text (runs without ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def tempered_targets(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(value, share): natural token shares of a dimension raised to
    ``power`` and normalised (1 keeps them, 0 makes them equal)."""
    t = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("t")).filter("t > 0")
    g = F.pow(F.col("t").cast("double"), F.lit(float(power)))
    whole = F.broadcast(t.agg(F.sum(g).alias("_whole")))         # one row
    return t.crossJoin(whole).select("value", (g / F.col("_whole")).alias("share"))


def rake(cells: DataFrame, dims: list[str], targets: dict[str, DataFrame], scratch: Scratch,
         tolerance: float = 1e-11, max_sweeps: int = 48, report: dict | None = None) -> DataFrame:
    """``cells`` with ``w``, the token weight whose marginals meet
    ``targets`` (``{dim: (value, share)}``).

    Targets are matched null-safely; values without a target get weight 0.
    Raking stops when every marginal is within ``tolerance`` (relative) of
    its target, or after ``max_sweeps`` (targets that the occupied cells
    cannot meet never settle).  Weights that miss a target by more than
    ``tolerance`` are returned with a warning; ``report``, when given,
    receives ``deviation`` (the largest relative one left), ``met`` and
    ``sweeps``.
    """
    total = F.broadcast(cells.agg(F.sum("tokens").cast("double").alias("total")))       # one row
    c = cells.crossJoin(total).withColumn("w", F.col("tokens").cast("double"))
    for d in dims:
        t = targets[d].select(F.col("value").alias("_v"), F.col("share").alias(f"goal_{d}"))
        c = c.join(t, F.col(d).eqNullSafe(F.col("_v")), "left").drop("_v").fillna(0.0, [f"goal_{d}"])
    c = scratch.save(c, "cells0")
    sweeps = 0
    while True:
        for d in dims:
            # sums per value are added up in every task first, then joined back
            s = c.groupBy(F.col(d).alias("_v")).agg(F.sum("w").alias("_s"))
            c = c.join(s, F.col(d).eqNullSafe(F.col("_v"))).withColumn(
                "w", F.when(F.col("_s") > 0, F.col("w") * (F.col(f"goal_{d}") * F.col("total") / F.col("_s"))).otherwise(0.0)).drop("_v", "_s")
        sweeps += 1
        c = scratch.save(c, f"cells{sweeps}")
        scratch.drop(f"cells{sweeps - 1}")
        worst = None
        for d in dims:
            goal = F.first(f"goal_{d}")
            off = c.groupBy(d).agg(F.when(goal > 0, F.abs(F.sum("w") / F.first("total") / goal - 1.0)).otherwise(0.0).alias("off"))
            off = off.agg(F.max("off").alias("off"))
            worst = off if worst is None else worst.unionAll(off)
        worst = worst.agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance or sweeps >= max_sweeps:
            met = worst is None or worst <= tolerance
            if not met:
                warnings.warn(f"mixing targets not met after {sweeps} sweeps: a marginal is off by {worst:.3g} (relative)")
            if report is not None:
                report.update(deviation=worst, met=met, sweeps=sweeps)
            return c.drop("total", *[f"goal_{d}" for d in dims])


def draw(id: str = "doc_id", seed: str = "mix") -> Column:
    """Uniform number in [0, 1) from an id; the same id always draws the
    same number (a null id draws as the empty string)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, dims: dict[str, Column], tokens: Column, power: float = 0.9,
        targets: dict[str, DataFrame] | None = None, budget: float | None = None, id: str = "doc_id",
        seed: str = "mix", report: dict | None = None) -> DataFrame:
    """``docs`` with ``mix_weight`` (raked weight per token), ``mix_p`` (its
    probability) and ``mix_kept`` (whether it was drawn).

    ``dims`` maps dimension names to columns; a null value is a value of its
    own.  Targets default to the natural shares raised to ``power``.
    ``budget`` bounds the expected tokens of the sample.  Documents of cells
    without any token have weight and probability 0.  Repeated rows draw
    alike.  Other columns are kept as they are, whatever their names; one
    named like an output is replaced.  An empty table gives an empty result.  Targets that cannot be met together
    give a warning, and ``report`` receives the deviation (see :func:`rake`).
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    names = list(dims)
    rows = docs.select(*[c.alias(n) for n, c in dims.items()], tokens.cast("long").alias("tokens"))
    cells = scratch.save(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = targets or {n: tempered_targets(cells, n, power) for n in names}
    f = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
    rates = rake(cells, names, targets, scratch, report=report).withColumn("f", f)
    ends = F.broadcast(rates.agg(F.max("f").alias("_top"), F.sum(F.col("f") * F.col("tokens")).alias("_mass")))     # one row
    c = F.when(F.col("_top") > 0, 1.0 / F.col("_top")).otherwise(0.0)
    if budget is not None:
        c = F.when(F.col("_mass") > 0, F.least(c, F.lit(float(budget)) / F.col("_mass"))).otherwise(0.0)
    kept = [x for x in docs.columns if x.lower() not in OUTPUTS]
    cell, doc = ([f"{x}" for x in fresh(docs.columns, *[f"_{side}_{i}" for i in range(len(names))])] for side in ("mix", "doc"))
    rates = scratch.save(rates.crossJoin(ends).select(
        *[F.col(n).alias(a) for n, a in zip(names, cell)], F.col("f").alias("mix_weight"),
        F.least(F.lit(1.0), F.col("f") * c).alias("mix_p")), "rates")
    on = None
    for a, b in zip(cell, doc):
        e = F.col(a).eqNullSafe(F.col(b))
        on = e if on is None else on & e
    drawn = fresh([*docs.columns, *doc], "_drawn")[0]
    keyed = docs.select(*[F.col(f"`{x}`") for x in kept], *[col.alias(b) for b, col in zip(doc, dims.values())], draw(id, seed).alias(drawn))
    out = keyed.join(rates, on, "left")
    return out.select(*[F.col(f"`{x}`") for x in kept], "mix_weight", "mix_p", (F.col(drawn) < F.col("mix_p")).alias("mix_kept"))
