"""How the rows of a panel are spread over tasks.

A panel is ordered within its groups (engines, users). Usually a group is short
and one shuffle by group key is the best plan. A group may also hold a large
share of all rows; such long groups are cut into blocks of consecutive rows, so
that no task ever holds one of them whole. Which groups are long is measured
with one pass over the key columns, before the plan is chosen.

Blocks are cut by rows, not by time. A histogram of the order key counts the rows
of each long group; cells with too many rows are counted again in finer cells, on
the next column of the key where all rows of a cell share a value, until every
cell is small enough. Cells that follow each other are then put together into
blocks. The histograms are aggregated before they are shuffled and name their
cells by the rows in them, so that empty time costs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.session import broadcast_if_small, checkpointed

MAX_GROUP_ROWS = 1_000_000
# Cells of a histogram per half block that its rows would fill.
CELLS_PER_HALF = 4

BLOCK = "_block"
LAST = "_last_time"
START = "_start"
_BORDERS, _STARTS = "_borders", "_starts"
# Which part of the order key the first histogram of a group counts, its cells, and the last block that begins at or before each.
_AT, _WIDTH, _FIRST, _UPTO = "_at", "_width", "_first", "_upto"
_LEAST = -(1 << 63)


def sortable(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The columns of ``order`` as BIGINT in the same order, up to the first that has no such form."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    columns = []
    for name in order:
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType):
            columns.append(F.col(name).cast("long"))
        elif isinstance(kind, T.DateType):
            columns.append(F.unix_date(name).cast("long"))
        elif isinstance(kind, T.TimestampType):
            columns.append(F.unix_micros(name))
        elif isinstance(kind, T.TimestampNTZType):
            columns.append(F.timestamp_diff("MICROSECOND", epoch, F.col(name)))
        else:
            break
    if not columns:
        raise ValueError(f"long groups are cut by integers, dates or timestamps; {order[0]!r} is none")
    return columns


def _as_key(columns: Sequence[Column]) -> Column:
    """One value that orders as the columns one after the other."""
    return columns[0] if len(columns) == 1 else F.struct(*[c.alias(f"k{j}") for j, c in enumerate(columns)])


@dataclass(frozen=True)
class Layout:
    """Placement of one panel: its keys, its order and its long groups, if any.

    ``long`` holds one row per long group: keys, last time, cells of equal width of its first histogram with the block each lies
    in, the first order key of each block, and how many rows lie before each block (one entry more, for the whole group).
    Any two blocks that follow each other hold more than ``half`` rows, and a block at most twice
    as many, unless more rows share one order key.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    long: DataFrame | None = None
    half: int = 0

    @property
    def time(self) -> str:
        return self.order[0]

    @property
    def placed_by(self) -> tuple[str, ...]:
        """Columns whose equal values share a task."""
        return self.keys if self.long is None else (BLOCK,)

    def _block(self, number: Column) -> Column:
        """Keys and block as one value: rows hashed by the keys alone do not count as placed by it."""
        return F.struct(*self.keys, number.alias("block"))

    def place(self, df: DataFrame, *, carried: int = 0) -> DataFrame:
        """``df`` with its block; where the group is long also its last time and the rows before the block.

        With ``carried``, each block of a long group is preceded by the last ``carried`` rows before it; in
        those copies the rows before the block are NULL.
        """
        if self.long is None:
            return df
        marked = df.join(self.long, list(self.keys), "left")
        parts = sortable(df, self.order)
        marked = marked.withColumns({f"_k{j}": c for j, c in enumerate(parts)})
        names = [F.col(f"_k{j}") for j in range(len(parts))]
        value = names[0] if len(names) == 1 else F.get(F.array(*names), F.col(_AT))
        marked = marked.withColumn("_value", value)
        cell = (F.expr(f"_value div `{_WIDTH}`") - F.col(_FIRST)).cast("int")
        cell = F.greatest(F.lit(0), F.least(cell, F.size(_UPTO) - 1))
        marked = marked.withColumn("_cell", F.coalesce(cell, F.lit(0)))
        # The block that the cell begins in; only where blocks begin inside the cell, their borders are looked at.
        before = F.when(F.col("_cell") > 0, F.get(_UPTO, F.col("_cell") - 1)).otherwise(F.lit(0))
        marked = marked.withColumn("_before", before)
        begun = F.get(_UPTO, F.col("_cell")) - F.col("_before")
        key = _as_key(names)
        passed = F.size(F.filter(F.slice(_BORDERS, F.col("_before") + 2, begun), lambda b: b <= key))
        number = F.col("_before") + F.when(begun > 0, passed).otherwise(F.lit(0))
        # 0 for groups that are not long.
        marked = marked.withColumn("_number", F.when(F.col(LAST).isNotNull(), number).otherwise(F.lit(0)).cast("long"))
        marked = marked.withColumn(BLOCK, self._block(F.col("_number")))
        rows = marked.withColumn(START, F.get(_STARTS, F.col("_number").cast("int")))
        columns = [*df.columns, LAST, BLOCK, START]
        if not carried:
            return rows.select(*columns)
        copies = self._carried(marked, df.columns, carried).withColumn(START, F.lit(None).cast("long"))
        return rows.select(*columns).unionByName(copies.select(*columns))

    def _carried(self, marked: DataFrame, columns: Sequence[str], carried: int) -> DataFrame:
        """The last rows of each block once more, for each of the blocks that start at most ``carried`` rows later."""
        # Two blocks in a row hold more than ``half`` rows, so the rows reach no further than this.
        reach = 2 * -(-carried // self.half)
        after = F.least(F.size(_BORDERS) - 1 - F.col("_number"), F.lit(reach).cast("long"))
        starts = F.slice(_STARTS, (F.col("_number") + 2).cast("int"), F.lit(reach))
        tails = marked.where(F.col(LAST).isNotNull()).select(
            *columns, LAST, BLOCK, "_number", after.alias("_after"), starts.alias("_following")
        )
        latest = Window.partitionBy(BLOCK).orderBy(*[F.desc(c) for c in self.order])
        tails = tails.withColumn("_rank", F.row_number().over(latest))
        tails = tails.where((F.col("_rank") <= carried) & (F.col("_after") > 0))
        end = F.get("_following", F.lit(0))
        fed = F.filter(
            F.sequence(F.lit(1), F.col("_after").cast("int")),
            lambda i: F.get("_following", i - 1) - end + F.col("_rank") <= carried,
        )
        tails = tails.withColumn("_ahead", F.explode(fed))
        return tails.withColumn(BLOCK, self._block(F.col("_number") + F.col("_ahead")))

    def place_groups(self, groups: DataFrame) -> DataFrame:
        """Rows that describe whole groups, repeated once per block of a long group."""
        if self.long is None:
            return groups
        first = F.lit(0).cast("long")
        blocks = self.long.select(*self.keys, F.sequence(first, F.size(_BORDERS) - F.lit(1)).alias("_numbers"))
        repeated = groups.join(blocks, list(self.keys), "left").withColumn(
            "_number", F.explode(F.coalesce("_numbers", F.array(first)))
        )
        return repeated.withColumn(BLOCK, self._block(F.col("_number"))).drop("_number", "_numbers", *self.keys)


def measure(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    block_rows: int | None = None,
    least_rows: int = 1,
) -> Layout:
    """Find the groups of ``df`` with more than ``max_group_rows`` rows and cut them into blocks.

    A block holds at most ``block_rows`` rows (by default as many as a group that is not cut), or twice
    ``least_rows`` if that is more. Counts rows per group, which reads the key columns only and aggregates
    before its shuffle; the order is read only if there are long groups. ``max_group_rows=None`` skips
    the pass for a panel known to have short groups. Keys and order must not be NULL.
    """
    keys, order = tuple(keys), tuple(order)
    rows = F.count(F.lit(1))
    if max_group_rows is None:
        return Layout(keys, order)
    if df.groupBy(*keys).agg(rows.alias("_n")).where(F.col("_n") > max_group_rows).isEmpty():
        return Layout(keys, order)
    half = max(1, (block_rows or max_group_rows) // 2, least_rows)
    columns = {f"_k{j}": c for j, c in enumerate(sortable(df, order))}
    names = list(columns)
    # Found once; the passes below would otherwise each count the groups again.
    long = checkpointed(
        df.groupBy(*keys)
        .agg(rows.alias("_n"), F.max(order[0]).alias(LAST), *_ends(columns))
        .where(F.col("_n") > max_group_rows)
    )
    first = _cuts(long, names, half)
    panel = df.select(*keys, *[c.alias(n) for n, c in columns.items()])
    cells = _histogram(panel, keys, first.select(*keys, _AT, _WIDTH), names, half)
    blocks = first.join(_joined(cells, keys, names, half), list(keys))
    cell = F.transform("_blocks", lambda b: F.call_function("div", _part(b["border"], len(names)), F.col(_WIDTH)) - F.col(_FIRST))
    blocks = blocks.withColumn("_begins", cell)
    # How many cells each block is the last to have begun in; the last block goes on to the end.
    upto = F.transform(
        "_begins", lambda c, i: F.array_repeat(i, (F.coalesce(F.get("_begins", i + 1), F.col("_beyond")) - c).cast("int"))
    )
    groups = checkpointed(
        blocks.select(
            *keys,
            LAST,
            _AT,
            _WIDTH,
            _FIRST,
            F.flatten(upto).alias(_UPTO),
            F.transform("_blocks", lambda b: b["border"]).alias(_BORDERS),
            F.concat(F.transform("_blocks", lambda b: b["start"]), F.array("_n")).alias(_STARTS),
        )
    )
    return Layout(keys, order, broadcast_if_small(groups), half)


def _ends(columns: Sequence[str] | dict[str, Column]) -> list[Column]:
    """Smallest and largest value of each part of the order key."""
    of = columns if isinstance(columns, dict) else {n: F.col(n) for n in columns}
    return [f(c).alias(f"{p}{n}") for n, c in of.items() for p, f in (("_low", F.min), ("_high", F.max))]


def _part(border: Column, parts: int) -> Column:
    """The part of an order key that the first histogram of its group counts."""
    return border if parts == 1 else F.get(F.array(*[border[f"k{j}"] for j in range(parts)]), F.col(_AT))


def _varying(names: Sequence[str]) -> Column:
    """The first part of the order key in which the rows of a cell differ; NULL if there is none."""
    return F.coalesce(*[F.when(F.col(f"_low{n}") < F.col(f"_high{n}"), F.lit(j)) for j, n in enumerate(names)])


def _cuts(cells: DataFrame, names: Sequence[str], half: int) -> DataFrame:
    """``cells`` with the part of the key to cut them by, the width of finer cells, the first one and that beyond the last."""
    bins = F.greatest(F.lit(4), F.ceil(F.col("_n") / half) * CELLS_PER_HALF)
    # From both ends by halves, as their difference may not fit.
    widths = [F.expr(f"`_high{n}` div `_bins`") - F.expr(f"`_low{n}` div `_bins`") for n in names]
    cuts = cells.withColumn("_bins", bins).withColumn(_AT, F.coalesce(_varying(names), F.lit(0)))
    cuts = cuts.withColumn(_WIDTH, F.greatest(F.lit(1), F.get(F.array(*widths), F.col(_AT))))
    for end, name in (("_low", _FIRST), ("_high", "_top")):
        value = F.get(F.array(*[F.col(f"{end}{n}") for n in names]), F.col(_AT))
        cuts = cuts.withColumn(name, F.call_function("div", value, F.col(_WIDTH)))
    return cuts.withColumn("_beyond", F.col("_top") - F.col(_FIRST) + 1)


def _histogram(rows: DataFrame, keys: Sequence[str], cuts: DataFrame, names: Sequence[str], half: int) -> DataFrame:
    """Cells of at most ``half`` rows, or of one order key: keys, rows and ends of the key's parts.

    ``cuts`` says how the rows of each group are cut first; cells that are too large are cut again.
    """
    cell, done = F.array().cast("array<bigint>"), None
    rows, cuts = rows.withColumn("_cell", cell), cuts.withColumn("_cell", cell)
    while True:
        rows = rows.join(broadcast_if_small(cuts), [*keys, "_cell"])
        value = F.get(F.array(*names), F.col(_AT))
        rows = rows.withColumn("_cell", F.concat("_cell", F.array(F.call_function("div", value, F.col(_WIDTH)))))
        rows = rows.select(*keys, *names, "_cell")
        heavy = (F.col("_n") > half) & _varying(names).isNotNull()
        counted = checkpointed(rows.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"), *_ends(names)))
        light = counted.where(~heavy).drop("_cell")
        done = light if done is None else done.unionByName(light)
        cells = counted.where(heavy)
        if cells.isEmpty():
            return done
        cuts = _cuts(cells, names, half).select(*keys, "_cell", _AT, _WIDTH)


def _joined(cells: DataFrame, keys: Sequence[str], names: Sequence[str], half: int) -> DataFrame:
    """Blocks of cells that follow each other: keys and, per group, its blocks by the rows before them."""
    parts, same = [], F.lit(True)
    for n in names:
        parts.append(F.when(same, F.col(f"_low{n}")).otherwise(F.lit(_LEAST)))
        same = same & (F.col(f"_low{n}") == F.col(f"_high{n}"))
    cells = cells.select(*keys, "_n", _as_key(parts).alias("border"))
    before = Window.partitionBy(*keys).orderBy("border").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = cells.groupBy(*keys, F.floor(F.col("start") / half).alias("_number")).agg(
        F.min(F.struct("start", "border")).alias("block")
    )
    return blocks.groupBy(*keys).agg(F.array_sort(F.collect_list("block")).alias("_blocks"))


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    *,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """``df`` with the 1-based row number of each row within ``keys``, in ``order``; neither may be NULL.

    Rows of a long group are numbered inside their block, onto the rows before it.
    """
    layout = measure(df, keys, order, max_group_rows=max_group_rows, block_rows=block_rows)
    inside = F.row_number().over(Window.partitionBy(*layout.placed_by).orderBy(*order))
    placed = layout.place(df)
    if layout.long is not None:
        inside = (inside + F.coalesce(START, F.lit(0))).cast("int")
    return placed.withColumn(name, inside).select(*df.columns, name)
