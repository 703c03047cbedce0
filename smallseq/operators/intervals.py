"""Interval operators: overlap join, shifts, unions of sub-intervals. Coordinates are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import durable

#: Bin widths of the overlap join: WIDTH * STEP ** level. An interval lies on the first level on which it is no longer than
#: SPAN bins, so it covers few bins, and none that is much longer than itself.
WIDTH, STEP, SPAN, LEVELS = 64, 4, 8, 16
#: The interval side is broadcast up to so many rows (after binning); beyond, both sides are shuffled by bin.
BROADCAST_ROWS = 500_000
#: So many tiles (of up to 256 places) are broadcast in a lookup of counts; beyond, both sides are shuffled by tile.
TILE_ROWS = 2_000


def _level(start: str, end: str) -> Column:
    length = F.col(end) - F.col(start)
    tests = [F.when(length <= WIDTH * SPAN * STEP**k, k) for k in range(LEVELS)]
    return F.coalesce(*tests, F.lit(LEVELS))


def _bins(start: str, end: str, width: Column) -> Column:
    return F.sequence(F.floor(F.col(start) / width), F.floor((F.greatest(F.col(end), F.col(start) + 1) - 1) / width))


def _places(start: str, end: str, levels: list[int]) -> Column:
    """The bins that [start, end) covers on these levels, as array<struct<level, bin>>."""

    def on(level: int) -> Column:
        return F.transform(_bins(start, end, F.lit(WIDTH * STEP**level)), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))

    return F.concat(F.array().cast("array<struct<level:int,bin:bigint>>"), *[on(k) for k in levels])


def interval_join(left: DataFrame, right: DataFrame, small: bool | None = None) -> DataFrame:
    """Pairs with equal chrom whose [s, e) and [fs, fe) overlap by at least one base.

    Both sides go to one row for each bin they cover, meet on (chrom, level, bin), and a pair is kept in its first common
    bin only, so that nothing has to be made distinct. An interval of the right side lies on the level that suits its
    length; the left side is looked up on the levels that the right side has (one aggregate counts them and their bins).
    ``small``: whether the interval side may be broadcast; None lets the count of its binned rows decide.
    """
    right = right.where(F.col("fe") > F.col("fs")).withColumn("__level", _level("fs", "fe"))
    right = right.withColumn("__width", F.element_at(F.lit([WIDTH * STEP**k for k in range(LEVELS + 1)]), F.col("__level") + 1))
    right = right.withColumn("__bins", _bins("fs", "fe", F.col("__width")))
    found = dict(right.groupBy("__level").agg(F.sum(F.size("__bins"))).collect())  # LEVELS + 1 rows at most
    if small is None:
        small = sum(found.values()) <= BROADCAST_ROWS
    f = right.select("*", F.explode("__bins").alias("__bin")).drop("__bins").withColumnRenamed("chrom", "__fchrom")
    a = left.withColumn("__at", F.explode(_places("s", "e", sorted(found))))
    first = F.greatest(F.floor(F.col("s") / F.col("__width")), F.floor(F.col("fs") / F.col("__width")))
    same = (F.col("chrom") == F.col("__fchrom")) & (F.col("__at.level") == F.col("__level")) & (F.col("__at.bin") == F.col("__bin"))
    on = same & (F.col("s") < F.col("fe")) & (F.col("fs") < F.col("e")) & (F.col("__bin") == first)
    return a.join(F.broadcast(f) if small else f, on).drop("__at", "__bin", "__level", "__width", "__fchrom")


def _tiles(points: DataFrame, tile: int) -> DataFrame:
    """(chrom, pos) -> (chrom, tile, before, marks, last): points before each tile, and those in it as sums up to each place.

    Every tile from a chromosome's first to its last has a row (``last``: its number); distinct places bound a tile's marks.
    """
    places = points.groupBy("chrom", "pos").agg(F.count("*").alias("n")).withColumn("tile", F.floor(F.col("pos") / tile))
    upto = F.sum("n").over(Window.partitionBy("chrom", "tile").orderBy("pos"))
    marks = F.collect_list(F.struct("pos", F.col("upto"))).alias("marks")
    found = places.withColumn("upto", upto).groupBy("chrom", "tile").agg(F.sum("n").alias("n"), marks)
    w = Window.partitionBy("chrom").orderBy("tile")
    found = found.withColumns({"before": F.sum("n").over(w) - F.col("n"), "next": F.lead("tile").over(w), "last": F.max("tile").over(Window.partitionBy("chrom"))})
    each = found.select("chrom", "last", "n", "before", "marks", "tile", F.explode(F.sequence("tile", F.coalesce(F.col("next") - 1, "tile"))).alias("t"))
    own = F.col("t") == F.col("tile")
    return each.select("chrom", "last", F.col("t").alias("tile"), F.when(own, F.col("before")).otherwise(F.col("before") + F.col("n")).alias("before"), F.when(own, F.col("marks")).alias("marks"))


def _points_upto(left: DataFrame, points: DataFrame, at: Column, out: str, tile: int) -> DataFrame:
    """Adds ``out``: the points (chrom, pos) of the row's chromosome at ``at`` or before."""
    tiles = durable(_tiles(points, tile))
    last = tiles.select(F.col("chrom").alias("__c"), F.col("last").alias("__last")).distinct()
    rows = left.withColumn("__at", at).join(F.broadcast(last), F.col("chrom") == F.col("__c"), "left").withColumn("__tile", F.least(F.floor(F.col("__at") / tile), F.col("__last"))).drop("__c", "__last")
    tiles = tiles.select(F.col("chrom").alias("__c"), F.col("tile").alias("__t"), F.col("before").alias("__before"), F.col("marks").alias("__marks"))
    if tiles.count() <= TILE_ROWS:
        tiles = F.broadcast(tiles)
    rows = rows.join(tiles, (F.col("chrom") == F.col("__c")) & (F.col("__tile") == F.col("__t")), "left")
    within = F.array_max(F.transform(F.filter("__marks", lambda m: m["pos"] <= F.col("__at")), lambda m: m["upto"]))
    count = F.coalesce("__before", F.lit(0)) + F.coalesce(within, F.lit(0))
    return rows.withColumn(out, count).drop("__at", "__tile", "__c", "__t", "__before", "__marks")


def overlap_counts(left: DataFrame, right: DataFrame, out: str, tile: int = 256) -> DataFrame:
    """Adds ``out``: how many intervals [fs, fe) of ``right`` overlap a row's [s, e) by at least one base.

    Those that begin before its end, less those that end at its begin or before: no pair is made, whatever the depth.
    """
    right = right.where(F.col("fe") > F.col("fs"))
    rows = _points_upto(left, right.select("chrom", F.col("fs").alias("pos")), F.col("e") - 1, "__begun", tile)
    rows = _points_upto(rows, right.select("chrom", F.col("fe").alias("pos")), F.col("s"), "__ended", tile)
    return rows.withColumn(out, F.col("__begun") - F.col("__ended")).drop("__begun", "__ended")


def running_sums(rows: DataFrame, by: list[str], sums: list[str], tile: int = 4096) -> DataFrame:
    """Each row with ``sums`` replaced by their totals over its group's rows at its ``pos`` or before.

    A group is summed in tiles of places, which tasks share, and by one row for each tile that has any.
    """
    rows = rows.withColumn("__tile", F.floor(F.col("pos") / tile))
    keys = [*by, "__tile"]
    w, upto = Window.partitionBy(*by).orderBy("__tile"), Window.partitionBy(*keys).orderBy("pos")
    totals = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    before = totals.select(*keys, *[(F.sum(c).over(w) - F.col(c)).alias(f"__before_{c}") for c in sums])
    return rows.withColumns({c: F.sum(c).over(upto) for c in sums}).join(before, keys).withColumns({c: F.col(c) + F.col(f"__before_{c}") for c in sums}).drop("__tile", *[f"__before_{c}" for c in sums])


def shifted(fs: Column, fe: Column, strand: Column, five: Column, three: Column) -> tuple[Column, Column]:
    """An interval's ends moved by a (5', 3') shift: along the strand, outwards by the larger one if unstranded."""
    both = F.greatest(five, three)
    start = F.when(strand, fs + five).when(~strand, fs - three).otherwise(fs - both)
    end = F.when(strand, fe + three).when(~strand, fe - five).otherwise(fe + both)
    return start, end


def with_shift(df: DataFrame) -> DataFrame:
    """(fs, fe, strand, shift5, shift3, ..) -> shifted rows; empty, inverted and negative intervals are dropped."""
    start, end = shifted(F.col("fs"), F.col("fe"), F.col("strand"), F.col("shift5"), F.col("shift3"))
    moved = df.withColumns({"__s": start, "__e": end}).drop("fs", "fe").withColumnsRenamed({"__s": "fs", "__e": "fe"})
    return moved.where((F.col("fs") < F.col("fe")) & (F.col("fs") >= 0))


def illegal_shifts(df: DataFrame) -> DataFrame:
    """The rows that ``with_shift`` drops, with the reason."""
    start, end = shifted(F.col("fs"), F.col("fe"), F.col("strand"), F.col("shift5"), F.col("shift3"))
    reason = F.when(start == end, "null").when(start > end, "inverted").when(start < 0, "negative start")
    return df.withColumn("reason", reason).where("reason is not null")


def merge_intervals(df: DataFrame, keys: list[str], start: str = "fs", end: str = "fe") -> DataFrame:
    """Unions of overlapping intervals for each key; intervals that only touch stay apart."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(F.col(start) < before, 0).otherwise(1)).withColumn("__island", F.sum("__new").over(w))
    return marked.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")
