"""Row positions and position blocks: the layout every ordered operator runs on.

A window partitioned by ``symbol`` alone puts a whole series into one task, so one symbol that
holds a third of all bars decides how long the job runs. Here a series is cut into blocks of
``rows`` consecutive bars and every window is partitioned by ``(symbol, block)``:

* bounded frames (moving averages, lags, rolling extremes) are exact because each block also
  receives copies of the neighbouring bars it looks at (the halo);
* unbounded state (running sums, forward fill, positions, exponential means) is computed inside
  the block, reduced to one row per block, combined over the small block table, and joined back.

Both parts use the same ``(symbol, block)`` partitioning, so the bars are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("symbol",)
POSITION = "i"
LENGTH = "n"
BLOCK = "block"
OWN = "own"

BLOCK_ROWS = 2048
TILE_SECONDS = 30 * 86400


def with_position(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: str = "ts",
    tile_seconds: int = TILE_SECONDS,
) -> DataFrame:
    """Add the 0-based row position ``i`` in time order and the series length ``n``.

    No series is sorted in one task: rows are counted per (series, calendar tile), the counts are
    prefix-summed on that small table, and ``row_number`` runs inside a tile only. A tile holds at
    most ``tile_seconds / bar interval`` rows because ``(symbol, ts)`` is unique.
    """
    keys = list(keys)
    tiled = df.withColumn(
        "__tile", F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / tile_seconds)
    )
    by_series = Window.partitionBy(*keys)
    before = by_series.orderBy("__tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = (
        tiled.groupBy(*keys, "__tile")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            *keys,
            "__tile",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
            F.sum("__rows").over(by_series).alias(LENGTH),
        )
    )
    in_tile = Window.partitionBy(*keys, "__tile").orderBy(order)
    return (
        tiled.join(tiles, [*keys, "__tile"])
        .withColumn(POSITION, F.col("__start") + F.row_number().over(in_tile) - 1)
        .drop("__tile", "__start")
    )


@dataclass(frozen=True)
class Blocks:
    """Positioned rows spread over ``(keys, block)``, with halo copies marked ``own = false``.

    Positions must be consecutive within a series (a contiguous slice of one is fine): after rows
    were dropped from the middle, take positions anew with :func:`with_position`.
    """

    df: DataFrame
    keys: tuple[str, ...] = KEYS
    rows: int = BLOCK_ROWS

    @classmethod
    def of(
        cls,
        positioned: DataFrame,
        before: int = 0,
        after: int = 0,
        keys: Sequence[str] = KEYS,
        rows: int = BLOCK_ROWS,
    ) -> "Blocks":
        """Cut a positioned table into blocks that also see ``before`` / ``after`` foreign rows."""
        if max(before, after) > rows:
            raise ValueError(f"a halo of {max(before, after)} rows needs blocks of at least as many")
        home = F.floor(F.col(POSITION) / rows)
        offset = F.col(POSITION) % rows
        targets = [home]
        if before:
            next_exists = (home + 1) * rows < F.col(LENGTH)
            targets.append(F.when((offset >= rows - before) & next_exists, home + 1))
        if after:
            targets.append(F.when((offset < after) & (home > 0), home - 1))
        if len(targets) == 1:
            df = positioned.withColumn(BLOCK, home).withColumn(OWN, F.lit(True))
        else:
            df = positioned.withColumn(
                BLOCK, F.explode(F.array_compact(F.array(*targets)))
            ).withColumn(OWN, F.col(BLOCK) == home)
        return cls(df, tuple(keys), rows)

    # -- frames -------------------------------------------------------------------------------

    @property
    def w(self) -> WindowSpec:
        """Rows of one block in position order (for ``lag`` and ``lead``)."""
        return Window.partitionBy(*self.keys, BLOCK).orderBy(POSITION)

    def last(self, n: int) -> WindowSpec:
        """The newest ``n`` rows, the current one included."""
        return self.w.rowsBetween(-(n - 1), 0)

    @property
    def running(self) -> WindowSpec:
        """Everything in the block up to the current row."""
        return self.w.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def offset(self) -> Column:
        """Position of an own row inside its block."""
        return F.col(POSITION) - F.col(BLOCK) * self.rows

    def over(self, n: int | None = None, running: bool = False) -> str:
        """The same frames as SQL text: plain, newest ``n`` rows, or running."""
        frame = ""
        if running:
            frame = " ROWS UNBOUNDED PRECEDING"
        elif n is not None:
            frame = f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
        return f"OVER (PARTITION BY {', '.join(self.keys)}, {BLOCK} ORDER BY {POSITION}{frame})"

    # -- steps --------------------------------------------------------------------------------

    def with_columns(self, columns: dict[str, Column]) -> "Blocks":
        return replace(self, df=self.df.withColumns(columns)) if columns else self

    def with_exprs(self, expressions: dict[str, str]) -> "Blocks":
        """Add new columns from SQL expressions in one projection."""
        if not expressions:
            return self
        added = [f"{text} AS `{name}`" for name, text in expressions.items()]
        return replace(self, df=self.df.selectExpr("*", *added))

    def drop(self, *names: str) -> "Blocks":
        return replace(self, df=self.df.drop(*names))

    def where(self, condition: Column | str) -> "Blocks":
        return replace(self, df=self.df.where(condition))

    def expand(self, df: DataFrame, *extra_keys: str) -> "Blocks":
        """The same blocks after rows were multiplied by further series keys (trial, fold)."""
        return replace(self, df=df, keys=(*self.keys, *extra_keys))

    def block_state(
        self,
        summary: dict[str, str],
        state: dict[str, str] | list[dict[str, str]],
    ) -> DataFrame:
        """One row per block: its keys and the columns of the last ``state`` step.

        ``summary`` reduces the own rows of a block to one row. ``state`` turns those rows into
        incoming state; its expressions (one dict, or several applied in turn) may use the named
        windows ``blocks`` (the series' blocks in order) and ``earlier`` (all blocks before the
        current one). The block table is ``rows`` times smaller than the data.
        """
        keys = [*self.keys, BLOCK]
        table = (
            self.df.where(OWN)
            .groupBy(*keys)
            .agg(*[F.expr(text).alias(name) for name, text in summary.items()])
        )
        series = f"PARTITION BY {', '.join(self.keys)} ORDER BY {BLOCK}"
        windows = {
            "OVER blocks": f"OVER ({series})",
            "OVER earlier": f"OVER ({series} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        }
        steps = [state] if isinstance(state, dict) else state
        for step in steps:
            added = []
            for name, text in step.items():
                for short, window in windows.items():
                    text = text.replace(short, window)
                added.append(f"{text} AS {name}")
            table = table.selectExpr("*", *added)
        return table.select(*keys, *steps[-1])

    def carry(
        self,
        summary: dict[str, str],
        state: dict[str, str] | list[dict[str, str]],
        start: str | None = None,
    ) -> "Blocks":
        """Join the state that enters each block, see :meth:`block_state`.

        With ``start``, what every state is where no block comes before, series of one block are not
        summarised: they are read and windowed once. The filter on their length reaches the input only
        where the length is one of the keys.
        """
        keys = [*self.keys, BLOCK]
        if start is None:
            return replace(self, df=self.df.join(self.block_state(summary, state), keys))
        several = replace(self, df=self.df.where(F.col(LENGTH) > self.rows))
        entering = several.block_state(summary, state)
        joined = self.df.join(entering.hint("shuffle_hash"), keys, "left")
        names = state if isinstance(state, dict) else state[-1]
        return replace(
            self, df=joined.withColumns({c: F.coalesce(F.col(c), F.expr(start)) for c in names})
        )

    def own_rows(self, *columns: str | Column) -> DataFrame:
        """Drop the halo; keep ``columns`` (all but the layout columns when none are given)."""
        df = self.df.where(OWN)
        return df.select(*columns) if columns else df.drop(BLOCK, OWN)


def full(frame: WindowSpec, n: int, value: str | Column, result: Column) -> Column:
    """``result`` only where the frame holds ``n`` non-null values, as pandas windows require."""
    return F.when(F.count(value).over(frame) == n, result)
