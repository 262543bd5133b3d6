"""Running aggregates along an order, without one task per key.

A plain window puts all rows of a key in one task. Here a row gets a part number from its place
among quantiles of (key, order), and windows run per (key, part), so a hot key is many groups.
What earlier parts of the same key came to is added afterwards; only keys with a quantile inside
them have any, so that table has at most two rows per part, whatever the data: it may be broadcast.

The quantiles come from rows drawn by a hash of their key and order, as one row that the plan
broadcasts. They depend on the rows alone: a repeated task, or a second pass, numbers the parts alike.
Nothing is stored, and nothing runs before the action.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MERGE = {"sum": lambda a, b: a + b, "min": F.least, "max": F.greatest, "xor": lambda a, b: a.bitwiseXOR(b)}
_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "xor": F.bit_xor}
#: Rows drawn for each part; parts differ in size by about 1 / sqrt(DRAWN).
DRAWN = 64


def order_values(order: list[str]) -> list[Column]:
    """Values that rise along ``order``; '-name' is a numeric column from high to low."""
    return [-F.col(name[1:]) if name.startswith("-") else F.col(name) for name in order]


def cut_points(df: DataFrame, place: Column, parts: int) -> DataFrame:
    """One row ``_cuts``: at most parts - 1 rising values of ``place`` (an orderable struct) that cut ``df`` into even parts."""
    chance = F.pmod(F.xxhash64(F.lit(20), place), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = df.select(place.alias("p"), chance.alias("c"))
    n = rows.agg(F.count("*").alias("n")).scalar()
    drawn = F.array_sort(F.collect_list("p"))
    some = rows.filter(F.col("c") * n < parts * DRAWN).agg(drawn.alias("a"))
    picked = F.transform(
        F.sequence(F.lit(1), F.lit(max(1, parts - 1))),
        lambda i: F.get(F.col("a"), F.floor(i * F.size("a") / parts).cast("int")),
    )
    return some.select(F.array_distinct(F.filter(picked, lambda p: p.isNotNull())).alias("_cuts"))


def _step(parts: int) -> int:
    return max(1, int(parts ** 0.5))


def part_number(cuts: Column, coarse: Column, place: Column, parts: int) -> Column:
    """How many cuts are at or below ``place``: first among ``coarse``, every w-th cut, then between two of these."""
    w = _step(parts)
    up_to = lambda a: F.size(F.filter(a, lambda b: b <= place))
    whole = up_to(coarse) * w
    return (whole + up_to(F.slice(cuts, whole + 1, F.lit(w - 1))) if w > 1 else whole).cast("int")


def _key(keys: list[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


def points(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> tuple[DataFrame, Column, int]:
    """The one row of cuts, the place that is cut, and the number of parts."""
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.struct(_key(keys).alias("k"), *[c.alias(f"o{i}") for i, c in enumerate(order_values(order))])
    return cut_points(df, place, parts), place, parts


def ranged(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None, cut_by: DataFrame | None = None) -> DataFrame:
    """``df`` with its part number ``_part`` along (keys, order), and whether the key goes on in the next or came from an earlier part.

    Keys count by their hash here: which of two keys comes first does not matter. A key with no cut inside is one group
    whatever its number, which is 0: only rows of the few keys that a cut falls into look for their place. ``cut_by`` is a table with the
    same keys and order columns, cheaper to make than ``df``, whose quantiles are good enough; any give the same values.
    """
    cuts, place, parts = points(df if cut_by is None else cut_by, keys, order, parts)
    return placed(df, keys, cuts, place, parts)


def placed(df: DataFrame, keys: list[str], points: DataFrame, place: Column, parts: int) -> DataFrame:
    """``ranged`` by cuts that ``points`` made."""
    cuts, key, w = F.col("_cuts"), _key(keys), _step(parts)
    one_row = points.select("_cuts", F.filter("_cuts", lambda b, i: (i + 1) % w == 0).alias("_coarse"), _cut_keys().alias("_keys"))
    number = F.when(F.array_contains("_keys", key), part_number(cuts, F.col("_coarse"), place, parts)).otherwise(0)
    # get() of an index below 0 is NULL: the first part came from none
    inside = lambda i: F.array_contains("_keys", key) & F.coalesce(F.get(cuts, i)["k"] == key, F.lit(False))
    numbered = df.join(F.broadcast(one_row), how="cross").withColumn("_part", number)
    return numbered.withColumns({"_goes_on": inside(F.col("_part")), "_came": inside(F.col("_part") - 1)}).drop(*one_row.columns)


def _cut_keys() -> Column:
    return F.array_distinct(F.transform("_cuts", lambda c: c["k"]))


def of_cut_keys(df: DataFrame, keys: list[str], points: DataFrame) -> DataFrame:
    """The rows of keys that a cut falls into. The keys are one value of the plan, so the filter moves down to where ``df`` is read."""
    return df.filter(F.array_contains(points.select(_cut_keys().alias("_keys")).scalar(), _key(keys)))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    exclusive: bool = False,
    backward: dict[str, tuple[str, Column]] | None = None,
    parts: int | None = None,
    cut_by: DataFrame | None = None,
) -> DataFrame:
    """Adds one running value per entry of ``values``: name -> (sum | min | max | xor, expression).

    ``backward`` are values that run from the end. ``exclusive`` leaves the current row out.
    ``order`` must be unique within a key. A sum over no rows is NULL.
    """
    backward = backward or {}
    cuts, place, parts = points(df if cut_by is None else cut_by, keys, order, parts)
    cut = placed(df, keys, cuts, place, parts)
    several = placed(of_cut_keys(df, keys, cuts), keys, cuts, place, parts) if keys else cut
    own = [*keys, "_part"]
    everything = values | backward
    totals = (
        several.filter(F.col("_goes_on") | F.col("_came")).groupBy(*own)
        .agg(*[_AGG[kind](value).alias(f"_{name}") for name, (kind, value) in everything.items()])
    )
    # A frame that ends at the last row costs a pass for every row: what runs from the end is ordered from the end.
    before = (Window.unboundedPreceding, -1)
    by_part = {True: Window.partitionBy(*keys).orderBy(F.desc("_part")), False: Window.partitionBy(*keys).orderBy("_part")}
    rising, falling = order_values(order), [F.desc_nulls_last(c) for c in order_values(order)]
    along = {True: Window.partitionBy(*own).orderBy(*falling), False: Window.partitionBy(*own).orderBy(*rising)}
    ways = [(values, False), (backward, True)]
    carried = totals.select(*own, *[
        _AGG[kind](f"_{name}").over(by_part[back].rowsBetween(*before)).alias(f"_{name}")
        for these, back in ways for name, (kind, _) in these.items()
    ])
    frame = before if exclusive else (Window.unboundedPreceding, Window.currentRow)
    local = cut.select("*", *[
        _AGG[kind](value).over(along[back].rowsBetween(*frame)).alias(name)
        for these, back in ways for name, (kind, value) in these.items()
    ])
    renamed = carried.withColumnsRenamed({c: f"_at_{c}" for c in own})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in own])
    joined = local.join(F.broadcast(renamed), same, "left")
    return joined.select(*df.columns, *[_combined(kind, name).alias(name) for name, (kind, _) in everything.items()])


def _combined(kind: str, name: str) -> Column:
    here, carried = F.col(name), F.col(f"_{name}")
    if kind in ("sum", "xor"):
        return F.coalesce(_MERGE[kind](here, carried), here, carried)
    return _MERGE[kind](here, carried)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "idx", cut_by: DataFrame | None = None) -> DataFrame:
    """Adds the 0-based position of each row within its key."""
    return running(df, keys, order, {name: ("sum", F.lit(1))}, cut_by=cut_by).withColumn(name, F.col(name) - 1)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
