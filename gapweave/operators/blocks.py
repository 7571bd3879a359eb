"""Order-dependent operators on series of any length.

A window over a whole series puts that series into one task.  So the longest
series is measured first: while it fits, plain windows are used.  Beyond that
rows are cut into blocks, ranges of the series' order with about equal row
counts: each block is summarised, the short table of blocks (as many as the rows
fill) is scanned to find what precedes every block, and that is brought back to
the rows.  Only rows of one block ever share a task.

A series that holds one row per hour is short by the calendar (8,784 rows a
year) and needs no measuring; see ``rolling``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.functions import clock
from gapweave.operators.attach import attach
from gapweave.operators.rolling import frame_columns
from gapweave.session import use_checkpoints

#: Longest series or block, in rows, that one task is asked to sort.
BLOCK_ROWS = 4_000_000


def block_of(time: Column, seconds: int) -> Column:
    stamp = clock.epoch_seconds(time)
    return stamp - F.pmod(stamp, F.lit(seconds))


def _blocks_needed(df: DataFrame, keys: Sequence[str]) -> int:
    """How many blocks of ``BLOCK_ROWS`` the rows fill; 0 if no series is longer than that (one pass, two numbers)."""
    sizes = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    longest, rows = sizes[0] or 0, sizes[1] or 0
    return 0 if longest <= BLOCK_ROWS else -(-rows // max(1, BLOCK_ROWS))


def _whole_series(df: DataFrame, keys: Sequence[str], seconds: int | None) -> tuple[bool, int]:
    """May a task take a whole series?  Never when the caller sets a block width.  Also the blocks needed."""
    blocks = _blocks_needed(df, keys) if seconds is None else 0
    return seconds is None and not blocks, blocks


def _blocked(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], seconds: int | None, blocks: int) -> DataFrame:
    """Rows with ``__block``, ascending in the order of the series.

    Blocks are ranges of (series, time, ties) with about equal row counts, so a
    burst, a full instant and rows without a time are cut as well; rows that
    agree in all of these stay together.  The ranges are drawn from a sample, so
    the cut rows are written once: summary and rows must see the same blocks.
    """
    if seconds is not None:
        return df.withColumn("__block", block_of(F.col(time), seconds))
    use_checkpoints(df.sparkSession)
    dealt = df.repartitionByRange(blocks, *[F.col(k).asc_nulls_last() for k in keys], *_order(time, ties))
    return dealt.withColumn("__block", F.spark_partition_id().cast("bigint")).checkpoint(eager=True)


def _order(time: str, ties: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in (time, *ties)]


def _with_history(df: DataFrame, keys: Sequence[str], summary: Mapping[str, Column],
                  history: Mapping[str, Column]) -> DataFrame:
    """Summarise blocks, scan them in order per series, attach the scan to the rows."""
    blocks = df.groupBy(*keys, "__block").agg(
        *[c.alias(n) for n, c in summary.items()], F.count(F.lit(1)).alias("__weight"))
    scanned = blocks.select(*keys, "__block", "__weight", *[c.alias(n) for n, c in history.items()])
    return attach(df, scanned, [*keys, "__block"], weight="__weight")


def _in_order(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(F.col("__block").asc_nulls_last())


def _before(keys: Sequence[str]):
    return _in_order(keys).rowsBetween(Window.unboundedPreceding, -1)


def row_index(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = (), *,
              into: str = "idx", block_seconds: int | None = None) -> DataFrame:
    """1-based position of every row in its series."""
    whole, blocks = _whole_series(df, keys, block_seconds)
    if whole:
        return df.withColumn(into, F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(time, ties))).cast("bigint"))
    df = _blocked(df, keys, time, ties, block_seconds, blocks)
    df = _with_history(df, keys, {"__n": F.count(F.lit(1))},
                       {"__before": F.coalesce(F.sum("__n").over(_before(keys)), F.lit(0))})
    inside = Window.partitionBy(*keys, "__block").orderBy(*_order(time, ties))
    return (df.withColumn(into, F.col("__before") + F.row_number().over(inside))
            .drop("__block", "__before"))


def running_sum(df: DataFrame, keys: Sequence[str], time: str, value: str, ties: Sequence[str] = (), *,
                into: str = "running", block_seconds: int | None = None) -> DataFrame:
    """Sum of ``value`` from the start of the series up to each row."""
    whole, blocks = _whole_series(df, keys, block_seconds)
    if whole:
        upto = Window.partitionBy(*keys).orderBy(*_order(time, ties)).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(into, F.sum(value).over(upto))
    df = _blocked(df, keys, time, ties, block_seconds, blocks)
    df = _with_history(df, keys, {"__s": F.sum(value)}, {"__before": F.sum("__s").over(_before(keys))})
    inside = (Window.partitionBy(*keys, "__block").orderBy(*_order(time, ties))
              .rowsBetween(Window.unboundedPreceding, 0))
    here = F.sum(value).over(inside)
    total = F.when(F.col("__before").isNull(), here).otherwise(F.col("__before") + F.coalesce(here, F.lit(0.0)))
    return df.withColumn(into, total).drop("__block", "__before")


def previous(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], ties: Sequence[str] = (), *,
             marks: str = "_l1", difference: Mapping[str, str] | None = None,
             block_seconds: int | None = None) -> DataFrame:
    """Value of the row before (``<name>_l1``); optionally the step from it.

    ``difference`` maps a value to the name of its step; the first row of a
    series has a NULL predecessor and a step of 0.
    """
    whole, blocks = _whole_series(df, keys, block_seconds)
    if whole:
        inside = Window.partitionBy(*keys).orderBy(*_order(time, ties))
        df = df.withColumns({"__first": F.row_number().over(inside) == 1,
                             **{v + marks: F.lag(v).over(inside) for v in values}})
    else:
        df = _previous_in_blocks(df, keys, time, values, ties, marks, block_seconds, blocks)
    for v, name in (difference or {}).items():
        df = df.withColumn(name, F.when(F.col("__first"), F.lit(0.0)).otherwise(F.col(v) - F.col(v + marks)))
    return df.drop("__first")


def _previous_in_blocks(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], ties: Sequence[str],
                        marks: str, block_seconds: int | None, blocks: int) -> DataFrame:
    df = _blocked(df, keys, time, ties, block_seconds, blocks)
    # a missing time or tie comes last, as in the order of the rows
    place = F.struct(*[c for n in (time, *ties) for c in (F.col(n).isNull(), F.col(n))])
    order = _in_order(keys)
    df = _with_history(
        df, keys, {f"__last_{v}": F.max_by(v, place) for v in values},
        {"__opens": F.row_number().over(order) == 1,
         **{f"__prev_{v}": F.lag(f"__last_{v}").over(order) for v in values}})
    inside = Window.partitionBy(*keys, "__block").orderBy(*_order(time, ties))
    first_here = F.row_number().over(inside) == 1
    return df.withColumns({
        "__first": first_here & F.col("__opens"),
        **{v + marks: F.when(first_here, F.col(f"__prev_{v}")).otherwise(F.lag(v).over(inside)) for v in values},
    }).drop("__block", "__opens", *[f"__prev_{v}" for v in values])


def chunked(df: DataFrame, keys: Sequence[str], time: str, longest: int, ties: Sequence[str] = (), *,
            chunk_rows: int = 1_000_000, block_seconds: int | None = None) -> DataFrame:
    """Cut series into chunks of equal row count, each led by a copy of the ``longest - 1`` rows before it.

    Any trailing row frame up to ``longest`` rows can then be evaluated per
    ``(keys, __chunk)`` ordered by ``__pos``; keep the rows where ``__own``.
    """
    size = max(chunk_rows, longest)
    df = row_index(df, keys, time, ties, into="__pos", block_seconds=block_seconds)
    df = df.withColumn("__home", F.floor((F.col("__pos") - 1) / size))
    lends = (F.col("__pos") - 1) % size >= size - (longest - 1)
    df = df.withColumn("__chunk", F.explode(
        F.when(lends, F.array(F.col("__home"), F.col("__home") + 1)).otherwise(F.array(F.col("__home")))))
    return df.withColumn("__own", F.col("__chunk") == F.col("__home")).drop("__home")


def roll(df: DataFrame, keys: Sequence[str], time: str, frames: Mapping[str, tuple[str, str, int]],
         ties: Sequence[str] = (), *, chunk_rows: int = 1_000_000, block_seconds: int | None = None) -> DataFrame:
    """Guarded trailing frames over raw rows: ``{name: (value, sum|avg|max|min, n)}``."""
    whole, blocks = _whole_series(df, keys, block_seconds)
    if whole:
        return df.withColumns(frame_columns(Window.partitionBy(*keys).orderBy(*_order(time, ties)), frames))
    longest = max(n for _, _, n in frames.values())
    cut = chunked(df, keys, time, longest, ties, chunk_rows=chunk_rows, block_seconds=block_seconds)
    order = Window.partitionBy(*keys, "__chunk").orderBy("__pos")
    return (cut.withColumns(frame_columns(order, frames)).where("__own")
            .drop("__chunk", "__own", "__pos"))
