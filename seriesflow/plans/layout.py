"""Windows over series of any length.

A window partitioned by series puts each series into one task. That is right
for the many short series and wrong for a series that holds a third of the
table. Here short series take the plain window, and long ones are cut into
blocks of equal row count; each block gets copies of the few rows before and
after it that its windows look at, so the results are those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from seriesflow.config import AUTO, IDX, KEY, N, PLAIN, T, TIE, Y, Layout
from seriesflow.sources.storage import store

BLOCK = "_block"
# Row count up to which a side whose rows have been counted is broadcast.
BROADCAST_ROWS = 100_000
WindowColumns = Callable[[WindowSpec], dict[str, Column]]


def order_columns(df: DataFrame) -> list[str]:
    """Order within a series; rows equal in all of these are interchangeable."""
    return [T, TIE, Y] if TIE in df.columns else [T, Y]


def spread_over_blocks(
    params: DataFrame, last_idx: str, block_rows: int, first_idx: str | None = None
) -> DataFrame:
    """One copy of a per-series row for each block of the series, from that of
    ``first_idx`` on.

    Joining on series and block instead of on series alone keeps a long
    series spread over many tasks.
    """
    first = F.expr(f"{first_idx} div {block_rows}") if first_idx else F.lit(0).cast("bigint")
    blocks = F.sequence(first, F.expr(f"{last_idx} div {block_rows}"))
    return params.withColumn(BLOCK, F.explode(blocks)).drop(last_idx, first_idx or last_idx)


def join_series(left: DataFrame, right: DataFrame, *also: str, how: str = "inner") -> DataFrame:
    """Join on the series, and on further columns, keeping a NULL key as a series."""
    keys = [KEY, *also]
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matches = [F.col(KEY).eqNullSafe(F.col(f"_right_{KEY}"))]
    matches += [F.col(k) == F.col(f"_right_{k}") for k in also]
    return left.join(right, matches, how).drop(*[f"_right_{k}" for k in keys])


def block_of(block_rows: int) -> Column:
    return F.expr(f"{IDX} div {block_rows}")


@dataclass(frozen=True)
class Lengths:
    """What is known about the lengths of the series of a table."""

    has_short: bool
    long_series: int = 0
    long_rows: int = 0


@dataclass(frozen=True)
class SeriesFrame:
    """Indexed rows of many series: short ones whole, long ones in blocks."""

    short: DataFrame | None
    long: DataFrame | None
    order: tuple[str, ...]
    block_rows: int
    lengths: Lengths

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> SeriesFrame:
        """Apply a row-wise step (projection or filter) to all rows."""
        return replace(
            self,
            short=None if self.short is None else fn(self.short),
            long=None if self.long is None else fn(self.long),
        )

    def renumber(self, position: str, total: str) -> SeriesFrame:
        """Number the rows that are left, from 0, and count them per series."""
        short, long = self.short, self.long
        if short is not None:
            ordered = Window.partitionBy(KEY).orderBy(*self.order)
            short = short.select(
                "*", (F.row_number().over(ordered) - 1).cast("bigint").alias(position)
            ).withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(KEY)))
        if long is not None:
            sizes = long.groupBy(KEY, BLOCK).agg(
                F.count(F.lit(1)).alias("_rows"), F.min(IDX).alias("_first"), F.max(IDX).alias("_last"))
            # Kept, as it is asked twice and is a row a block.
            starts = store(sizes.select(
                KEY, BLOCK, "_first",
                _rows_before(BLOCK).alias("_start"),
                F.sum("_rows").over(Window.partitionBy(KEY)).alias(total),
                (F.col("_last") - F.col("_first") + 1 > F.col("_rows")).alias("_gaps"),
            ), "blocks")
            if starts.filter("_gaps").isEmpty():  # what is left of a block is one piece
                local = F.col(IDX) - F.col("_first")
            else:
                in_block = Window.partitionBy(KEY, BLOCK).orderBy(IDX)
                long = long.withColumn("_local", F.row_number().over(in_block) - 1)
                local = F.col("_local")
            blocks = self.lengths.long_rows // self.block_rows + self.lengths.long_series
            long = (
                join_series(long, broadcast_up_to(starts.drop("_gaps"), blocks), BLOCK)
                .withColumn(position, F.col("_start") + local)
                .drop("_start", "_first", "_local")
            )
        return replace(self, short=short, long=long)

    @property
    def df(self) -> DataFrame:
        long = None if self.long is None else self.long.drop(BLOCK)
        if long is None:
            return self.short
        return long if self.short is None else self.short.unionByName(long)


def index_series(
    df: DataFrame,
    layout: Layout = AUTO,
    windows: WindowColumns | None = None,
    back: int = 0,
    ahead: int = 0,
    aggs: dict[str, Column] | None = None,
) -> SeriesFrame:
    """Add position ``idx``, length ``n``, per-series aggregates and window columns.

    ``aggs`` may use ``idx`` and ``n``. ``windows`` maps an ordered window to
    columns; they may look at most ``back`` rows back and ``ahead`` rows ahead. Blocks are
    at least as long as that, so no row is copied to more than the blocks beside its own.
    """
    order = [IDX] if layout.indexed else order_columns(df)
    lengths = measure_lengths(df, layout)
    short, long = _by_length(df, lengths, layout)
    block_rows = max(layout.block_rows, ceil(lengths.long_rows / layout.max_blocks), back, ahead)
    if short is not None:
        short = _index_short(short, order, layout.indexed, windows, aggs)
    if long is not None:
        if not layout.indexed:
            long = _index_long(long, order, lengths, block_rows)
        long = long.withColumn(BLOCK, block_of(block_rows))
        if aggs is not None:
            long = _long_aggregates(long, aggs, lengths, block_rows)
        if windows is not None:
            long = _over_blocks(long, windows, back, ahead, block_rows)
    return SeriesFrame(short, long, tuple(order), block_rows, lengths)


def measure_lengths(df: DataFrame, layout: Layout) -> Lengths:
    """Count short and long series and the rows of the long ones.

    One job that reads only the key column and returns a single row.
    """
    if layout.mode == "plain":
        return Lengths(has_short=True)
    is_long = F.lit(True) if layout.mode == "blocks" else F.col("_rows") > layout.block_rows
    found = _row_counts(df, layout).agg(
        F.count_if(~is_long).alias("short"),
        F.count_if(is_long).alias("long"),
        F.sum(F.when(is_long, F.col("_rows"))).alias("long_rows"),
    ).first()
    return Lengths(
        has_short=found["short"] > 0 or not found["long"],
        long_series=found["long"],
        long_rows=found["long_rows"] or 0,
    )


def resolve(df: DataFrame, layout: Layout = AUTO) -> Layout:
    """The plain layout if no series is long, else the layout as given.

    Resolving once saves the operators that follow from counting again.
    """
    if measure_lengths(df, layout).long_series:
        return layout
    return replace(PLAIN, indexed=layout.indexed)


def keep_index(df: DataFrame, layout: Layout = AUTO) -> tuple[DataFrame, Layout]:
    """Rows and layout for running several operators over the same series.

    Numbering the rows of long series costs a sort, so it is done once and
    written to the shared folder. Without long series nothing is written.
    """
    if layout.mode == "plain" or layout.indexed:
        return df, layout
    frame = index_series(df, layout)
    if frame.long is None:
        return df, PLAIN
    return store(frame.df, "indexed"), replace(layout, indexed=True)


def _row_counts(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.indexed:
        return df.filter(F.col(IDX) == 0).select(KEY, F.col(N).alias("_rows"))
    return df.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows"))


def broadcast_up_to(small: DataFrame, rows: int) -> DataFrame:
    """Broadcast a side known to have at most ``rows`` rows, if that is few."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def _by_length(
    df: DataFrame, lengths: Lengths, layout: Layout
) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of the short series and those of the long series."""
    if not lengths.long_series:
        return df, None
    if not lengths.has_short:
        return None, df
    if layout.indexed:
        return df.filter(F.col(N) <= layout.block_rows), df.filter(F.col(N) > layout.block_rows)
    keys = _row_counts(df, layout).filter(F.col("_rows") > layout.block_rows).select(KEY)
    # Used twice, and a small table: kept, so that it is not counted out again.
    keys = broadcast_up_to(store(keys, "long-keys"), lengths.long_series)
    return join_series(df, keys, how="left_anti"), join_series(df, keys, how="left_semi")


def _index_short(
    df: DataFrame,
    order: list[str],
    indexed: bool,
    windows: WindowColumns | None,
    aggs: dict[str, Column] | None,
) -> DataFrame:
    ordered, whole = Window.partitionBy(KEY).orderBy(*order), Window.partitionBy(KEY)
    extra = [c.alias(name) for name, c in windows(ordered).items()] if windows else []
    idx, n = [], []
    if not indexed:
        idx = [(F.row_number().over(ordered) - 1).cast("bigint").alias(IDX)]
        n = [F.count(F.lit(1)).over(whole).alias(N)]
    # All of these share one distribution and order: one shuffle, one sort.
    if aggs is None:
        return df.select("*", *idx, *extra).select("*", *n)
    # A window over a whole series holds its rows back, so the aggregates come
    # before the window columns widen the rows.
    totals = [c.over(whole).alias(name) for name, c in aggs.items()]
    return df.select("*", *idx).select("*", *n).select("*", *totals).select("*", *extra)


def _index_long(df: DataFrame, order: list[str], lengths: Lengths, block_rows: int) -> DataFrame:
    """Number the rows of long series without one task seeing a whole series.

    Range partitions on key and order are balanced if a tiebreak tells rows
    apart; without one a row number comes last, so that they are however many
    rows share a time and a value. Row numbers and the places of the rows are
    written out before use: neither may change when a lost task is run again.
    Only counts per partition are then summed up.
    """
    order = [KEY, *order]
    if TIE not in df.columns:
        df = store(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
        order.append("_row")
    parts = ceil(lengths.long_rows / block_rows)
    placed = store(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .drop("_row"),
        "positions",
    ).withColumn("_piece", F.shiftright("_pos", 33))  # the id's upper bits name the partition
    pieces = placed.groupBy(KEY, "_piece").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # Kept, so that what follows reads the positions once for each of its branches.
    starts = store(pieces.select(
        KEY, "_piece",
        (_rows_before("_piece") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(KEY)).alias(N),
    ), "pieces")
    return (
        join_series(placed, broadcast_up_to(starts, parts + lengths.long_series), "_piece")
        .withColumn(IDX, F.col("_pos") + F.col("_shift"))
        .drop("_pos", "_piece", "_shift")
    )


def _long_aggregates(
    df: DataFrame, aggs: dict[str, Column], lengths: Lengths, block_rows: int
) -> DataFrame:
    params = df.groupBy(KEY).agg(
        *[c.alias(name) for name, c in aggs.items()], F.max(IDX).alias("_last")
    )
    if lengths.long_series <= BROADCAST_ROWS:
        return join_series(df, F.broadcast(params.drop("_last")))
    return join_series(df, spread_over_blocks(params, "_last", block_rows), BLOCK)


def _over_blocks(
    df: DataFrame, windows: WindowColumns, back: int, ahead: int, block_rows: int
) -> DataFrame:
    block, in_block = F.col(BLOCK), F.col(IDX) % block_rows
    last_block = F.expr(f"({N} - 1) div {block_rows}")
    to_next = (in_block >= block_rows - back) & (block < last_block)
    to_previous = (in_block < ahead) & (block > 0)
    homes = (
        F.when(to_next & to_previous, F.array(block, block + 1, block - 1))
        .when(to_next, F.array(block, block + 1))
        .when(to_previous, F.array(block, block - 1))
        .otherwise(F.array(block))
    )
    copied = df.withColumn(BLOCK, F.explode(homes))
    ordered = Window.partitionBy(KEY, BLOCK).orderBy(IDX)
    extra = windows(ordered)
    return copied.select("*", *[c.alias(name) for name, c in extra.items()]).filter(
        F.col(BLOCK) == block_of(block_rows)
    )


def _rows_before(order: str) -> Column:
    before = Window.partitionBy(KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_rows").over(before), F.lit(0))
