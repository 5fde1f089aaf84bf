"""Scans of series of any length: a series is cut into pieces of its order, so that no task holds a whole one.

A row's piece is known from its order alone. What a scan needs of the rows before or after a piece (how many there are,
the last of them) is taken from one small row per piece, which is scanned in the same way with the next, larger width, and
with none left in one window per key. ``widths`` are the pieces' widths in units of the order column, ascending. One is enough
where the calendar bounds the pieces of a key (days: 36,525 in a century), or where a piece has tens of thousands of rows;
a smaller one can be put before it for readings that are denser than some thousands a day. Orders may have gaps of any
length. Rows with a null order or key come out nowhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000
#: Widths for orders in microseconds, and for places (0, 1, 2, ...).
TIMES, PLACES = (DAY,), (1 << 15,)
#: Widths for values of measurements: there are as many pieces as whole numbers among them.
VALUES = (1.0,)
_FAR = 1 << 52


def piece(order: Column, width: float) -> Column:
    """The number of the piece of an order; what is out of all reach is in the first or last piece."""
    return F.floor(F.greatest(F.least(order / F.lit(width), F.lit(float(_FAR))), F.lit(float(-_FAR)))).cast("long") if isinstance(width, float) else F.floor(order / F.lit(width)).cast("long")


def carried(pieces: DataFrame, keys: Sequence[str], order: str, value: str, widths: Sequence[float], combine: Callable[[str], Column] = F.sum, descending: bool = False, out: str = "carried") -> DataFrame:
    """``pieces`` (rows with one ``order`` each per key) with ``out``: ``combine`` of ``value`` over all rows before, null for none.

    ``descending``: over all rows behind.
    """
    by = F.desc(order) if descending else F.asc(order)
    within = lambda *more: Window.partitionBy(*keys, *more).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    if not widths:
        return pieces.withColumn(out, combine(value).over(within()))
    block, up = f"_block_{len(widths)}", f"_up_{len(widths)}"
    rows = pieces.withColumn(block, piece(F.col(order), widths[0])).filter(F.col(order).isNotNull())
    blocks = rows.groupBy(*keys, block).agg(combine(value).alias("_value"))
    before = carried(blocks, keys, block, "_value", [w / widths[0] if isinstance(w, float) else w // widths[0] for w in widths[1:]], combine, descending, up).drop("_value")
    inside = rows.withColumn("_inside", combine(value).over(within(block))).join(before, [*keys, block])
    both = combine_two(combine)(F.col("_inside"), F.col(up))
    return inside.withColumn(out, both).drop("_inside", up, block)


def combine_two(combine: Callable[[str], Column]) -> Callable[[Column, Column], Column]:
    """The combination of two values of which either may be null."""
    if combine is F.sum:
        return lambda a, b: F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    return {F.max: F.greatest, F.min: F.least}[combine]


def numbered(rows: DataFrame, keys: Sequence[str], order: str, name: str = "pos", widths: Sequence[float] = TIMES, by: Column | None = None) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... in the order of ``by`` (an order whose pieces can be told, in microseconds: default the column ``order``)."""
    rows = rows.withColumn("_at", F.col(order) if by is None else by).withColumn("_piece", piece(F.col("_at"), widths[0]))
    counts = rows.groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    before = carried(counts, keys, "_piece", "_n", [w // widths[0] for w in widths[1:]], out="_before").drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(order))
    return rows.withColumn("_inside", inside).join(before, [*keys, "_piece"]).withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_inside") - 1).cast("long")).drop("_at", "_piece", "_inside", "_before")


def gaps(rows: DataFrame, keys: Sequence[str], order: str, at: Column, widths: Sequence[float]) -> DataFrame:
    """keys, gap: ``at`` less that of the row before in the order, for each row but a series' first."""
    return _gaps(rows.select(*keys, F.col(order).alias("_order"), at.alias("_first"), at.alias("_last")), list(keys), list(widths))


def _gaps(rows: DataFrame, keys: list[str], widths: list[float]) -> DataFrame:
    step = lambda *more: (F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys, *more).orderBy("_order"))).alias("gap")
    if not widths:
        return rows.select(*keys, step()).filter("gap is not null")
    cut = rows.withColumn("_piece", piece(F.col("_order"), widths[0]))
    inside = cut.select(*keys, step("_piece")).filter("gap is not null")
    edges = cut.groupBy(*keys, "_piece").agg(F.min_by("_first", "_order").alias("_first"), F.max_by("_last", "_order").alias("_last")).withColumnRenamed("_piece", "_order")
    return inside.unionAll(_gaps(edges, keys, [w // widths[0] for w in widths[1:]]))


def with_neighbours(rows: DataFrame, keys: Sequence[str], order: str, wanted: dict[str, tuple[str, int]], widths: Sequence[float]) -> DataFrame:
    """``rows`` with a column per item of ``wanted``: name to (column, how many rows before; negative: behind).

    Inside a piece that is a lag or a lead; the first and last rows of a piece look into the nearest pieces that have rows.
    """
    keys, widths = list(keys), list(widths)
    if not widths:
        whole = Window.partitionBy(*keys).orderBy(order)
        return rows.withColumns({n: F.lag(c, k).over(whole) if k > 0 else F.lead(c, -k).over(whole) for n, (c, k) in wanted.items()})
    back, ahead = max([0, *(k for _, k in wanted.values())]), max([0, *(-k for _, k in wanted.values())])
    part = f"_piece_{len(widths)}"
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    cut = rows.withColumn(part, piece(F.col(order), widths[0])).filter(F.col(order).isNotNull())
    here = Window.partitionBy(*keys, part).orderBy(order)
    held = F.struct(*columns)
    extra = {f"_{n}": F.lag(c, k).over(here) if k > 0 else F.lead(c, -k).over(here) for n, (c, k) in wanted.items()}
    placed = cut.withColumns(extra | {"_nth": F.row_number().over(here), "_of": F.count("*").over(Window.partitionBy(*keys, part))})
    # per piece: its first rows and, from the last on, its last rows
    nth, left = F.col("_nth"), F.col("_of") - F.col("_nth")
    pick = lambda place, n: F.array_compact(F.array(*[F.max(F.when(place == i, held)) for i in range(n)])) if n else F.array()
    aggs = [x.alias(n) for x, n in ((pick(nth - 1, ahead), "_head"), (pick(left, back), "_tail")) if (ahead if n == "_head" else back)]
    edges = placed.filter((nth <= ahead) | (left < back)).groupBy(*keys, part).agg(*aggs)
    looks = {f"_t{i}": ("_tail", i) for i in range(1, back + 1)} | {f"_h{i}": ("_head", -i) for i in range(1, ahead + 1)}
    halo = with_neighbours(edges, keys, part, looks, [w // widths[0] for w in widths[1:]])
    none = lambda c: F.coalesce(F.col(c), F.array().cast(edges.schema["_tail" if c[1] == "t" else "_head"].dataType))
    sides = [F.concat(*[none(f"_{s}{i}") for i in range(1, n + 1)]).alias(f"_{name}") for s, n, name in (("t", back, "past"), ("h", ahead, "next")) if n]
    halo = halo.select(*keys, part, *sides)
    out = placed.join(halo, [*keys, part])
    values = {}
    for n, (c, k) in wanted.items():
        outside = F.get("_past", F.lit(k) - nth)[c] if k > 0 else F.get("_next", F.lit(-k) - left - 1)[c]
        values[n] = F.when(nth <= k if k > 0 else left < -k, outside).otherwise(F.col(f"_{n}"))
    return out.withColumns(values).drop(*extra, "_nth", "_of", "_past", "_next", part)


def quantile(counts: DataFrame, keys: Sequence[str], value: str, n: str, p: float = 0.5, widths: Sequence[float] = VALUES, out: str = "quantile") -> DataFrame:
    """keys, ``out``, least, most: the exact interpolated quantile of values that occur ``n`` times each, one row per key and distinct value; and their ends.

    Counts are summed along pieces of the values, so memory is that of a running sum, however many values there are.
    """
    keys = list(keys)
    rows = counts.select(*keys, F.col(value).alias("_value"), F.col(n).alias("_n")).withColumn("_part", piece(F.col("_value"), widths[0])).filter("_part is not null")
    pieces = rows.groupBy(*keys, "_part").agg(F.sum("_n").alias("_here"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    pieces = carried(pieces, keys, "_part", "_here", [w / widths[0] for w in widths[1:]], out="_earlier")
    whole = Window.partitionBy(*keys)
    pieces = pieces.withColumns({"_total": F.sum("_here").over(whole), "least": F.min("_least").over(whole), "most": F.max("_most").over(whole)}).drop("_here", "_least", "_most")
    along = Window.partitionBy(*keys, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.sum("_n").over(along)).join(pieces, [*keys, "_part"])
    before, rank = F.coalesce("_earlier", F.lit(0)) + F.coalesce("_inside", F.lit(0)), (F.col("_total") - 1) * F.lit(float(p))
    rows = rows.withColumns({"_before": before, "_low": F.floor(rank), "_high": F.ceil(rank), "_share": rank - F.floor(rank)})
    has = lambda c: (F.col("_before") <= F.col(c)) & (F.col(c) < F.col("_before") + F.col("_n"))
    found = rows.filter(has("_low") | has("_high")).groupBy(*keys).agg(
        F.max(F.when(has("_low"), F.col("_value"))).alias("_a"), F.max(F.when(has("_high"), F.col("_value"))).alias("_b"), *[F.max(c).alias(c) for c in ("_share", "least", "most")])
    return found.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias(out), "least", "most")
