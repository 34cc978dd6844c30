"""Sequential proposals: tree-structured Parzen estimates from the tracked trials, in batches.

The best share of a key's trials is told from the rest. Per parameter, both sets are smoothed into a
density over the parameter's range mapped to [0, 1]: triangles around the values, and one uniform
part. Candidates are drawn from the density of the good ones, and the one whose densities differ most
(sum of ``ln good - ln rest`` over the parameters) is proposed. Draws come from digests of (seed, trial,
candidate, name), so proposals repeat on any machine. A key's trials are one row of arrays; all keys
and slots of a batch are one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schema as S
from barloom.functions.scalars import number

#: Share of the trials that counts as good, rounded up.
GOOD = 0.2
#: Candidates per proposal.
CANDIDATES = 24
#: Half width of a triangle: this times the number of values to the power below.
WIDTH, POWER = 0.5, -0.4

Space = dict[str, tuple[str, float, float]]


def to_unit(name: str, kind: str, low: float, high: float) -> str:
    """A parameter's value on [0, 1], as SQL text; whole numbers lie in the middle of their part."""
    if kind == "int":
        return f"(({name} - {number(low)} + 0.5D) / {number(high - low + 1)})"
    if kind == "log":
        return f"((ln({name}) - ln({number(low)})) / (ln({number(high)}) - ln({number(low)})))"
    return f"(({name} - {number(low)}) / {number(high - low)})"


def from_unit(u: str, kind: str, low: float, high: float) -> str:
    if kind == "int":
        return f"CAST(least(floor({number(low)} + {u} * {number(high - low + 1)}), {number(high)}) AS INT)"
    if kind == "log":
        return f"exp(ln({number(low)}) + {u} * (ln({number(high)}) - ln({number(low)})))"
    return f"({number(low)} + {u} * {number(high - low)})"


def _uniform(seed: int, name: str, purpose: str) -> str:
    digest = f"md5(concat_ws(':', '{seed}', trial, __c, '{name}', '{purpose}'))"
    return f"(CAST(conv(substr({digest}, 1, 8), 16, 10) AS DOUBLE) / 4294967296D)"


def _density(u: str, values: str) -> str:
    """Triangles around the values and a uniform part, all of equal weight."""
    wide = f"({number(WIDTH)} * pow(size({values}), {number(POWER)}))"
    heights = f"aggregate({values}, 0D, (s, x) -> s + greatest(0D, 1D - abs({u} - x) / {wide}) / {wide})"
    return f"((CASE WHEN size({values}) > 0 THEN {heights} ELSE 0D END + 1D) / (size({values}) + 1))"


def next_trials(
    history: DataFrame,
    space: Space,
    first: int,
    count: int,
    direction: str = "maximize",
    seed: int = 42,
    keys: Sequence[str] = (S.SYMBOL,),
    candidates: int = CANDIDATES,
    good: float = GOOD,
) -> DataFrame:
    """``keys, trial, <parameters>``: ``count`` proposals per key, numbered from ``first``.

    ``history`` has ``keys, trial, <parameters>, metric``, one row per trial. Trials without a metric
    are left out; ties go to the lower trial number. Where only good trials are known, or none, the
    missing density is uniform.
    """
    sign = "-" if direction == "maximize" else ""
    units = ", ".join(f"{to_unit(n, *limits)} AS {n}" for n, limits in space.items())
    told = history.where("metric IS NOT NULL").selectExpr(
        *keys, f"{sign}metric AS __loss", "trial", f"struct({units}) AS __u"
    )
    ranked = told.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("__loss", "trial", "__u"))).alias("__trials")
    )
    if keys:  # a key without any metric has uniform densities
        ranked = history.select(*keys).distinct().join(ranked, list(keys), "left")
    size = "coalesce(array_size(__trials), 0)"
    some = ranked.withColumn("__n", F.expr(f"CAST(ceil({size} * {number(good)}) AS INT)"))
    sets = {}
    for name in space:
        values = f"coalesce(transform(__trials, t -> t.__u.{name}), array())"
        sets[f"__good_{name}"] = f"slice({values}, 1, __n)"
        sets[f"__rest_{name}"] = f"slice({values}, __n + 1, greatest(size({values}) - __n, 0))"
    rows = some.selectExpr(*keys, *[f"{v} AS {k}" for k, v in sets.items()])
    rows = rows.withColumn("trial", F.explode(F.sequence(F.lit(first), F.lit(first + count - 1))))
    rows = rows.withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))))
    score = []
    for name, limits in space.items():
        held = f"__good_{name}"
        part = f"CAST(floor({_uniform(seed, name, 'part')} * (size({held}) + 1)) AS INT)"
        rows = rows.withColumns(
            {"__part": F.expr(part), "__draw": F.expr(_uniform(seed, name, "draw"))}
        )
        wide = f"({number(WIDTH)} * pow(size({held}), {number(POWER)}))"
        shift = "CASE WHEN __draw < 0.5D THEN sqrt(2D * __draw) - 1D ELSE 1D - sqrt(2D * (1D - __draw)) END"
        moved = f"(get({held}, __part) + {wide} * ({shift}))"
        inside = f"CASE WHEN {moved} < 0D THEN -{moved} WHEN {moved} > 1D THEN 2D - {moved} ELSE {moved} END"
        u = f"CASE WHEN __part < size({held}) THEN {inside} ELSE __draw END"
        rows = rows.withColumn("__at", F.expr(u)).withColumn(name, F.expr(from_unit("__at", *limits)))
        at = to_unit(name, *limits)
        score.append(f"ln({_density(at, held)}) - ln({_density(at, f'__rest_{name}')})")
    rows = rows.withColumn("__score", F.expr(" + ".join(score)))
    best = F.max_by(F.struct(*space), F.struct("__score", -F.col("__c"))).alias("__best")
    return rows.groupBy(*keys, "trial").agg(best).select(*keys, "trial", "__best.*")

