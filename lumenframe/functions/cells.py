"""Cell-hash joins: equality on a grid cell, then the exact test.

The smaller side is copied to the neighbouring cells, the larger one keeps a single row per
item, so the larger side is never replicated. A crowded cell is a skewed join key, which
adaptive execution splits; ``salt`` splits it explicitly where the operator aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plane_pairs(
    big: DataFrame,
    small: DataFrame,
    *,
    big_xy: Sequence[str],
    small_xy: Sequence[str],
    radius: float,
    keys: Sequence[str] = (),
    salt: int = 1,
    how: str = "inner",
    exact: Column | None = None,
) -> DataFrame:
    """Pairs closer than or at ``radius`` in any number of plane coordinates, within ``keys``.

    Column names of both sides must differ, except for ``keys``. ``exact`` replaces the
    Euclidean test; it must never hold for items more than one cell apart.
    """
    # A hair wider than the radius, so that rounding never puts a pair two cells apart.
    cell = max(radius, 1e-9) * (1 + 1e-9)
    left, right, names = big, small, []
    for i, (b, s) in enumerate(zip(big_xy, small_xy)):
        name = f"_cell{i}"
        names.append(name)
        left = left.withColumn(name, F.floor(F.col(b) / cell))
        home = F.floor(F.col(s) / cell)
        right = right.withColumn(name, F.explode(F.array(home - 1, home, home + 1)))
    if salt > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*big_xy, *big.columns[:1]), F.lit(salt)))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        names.append("_salt")
    if exact is None:
        d2 = sum(((F.col(b) - F.col(s)) * (F.col(b) - F.col(s)) for b, s in zip(big_xy, small_xy)), F.lit(0.0))
        exact = d2 <= radius * radius
    on = [*keys, *names]
    condition = exact
    for c in on:
        condition = condition & (F.col(f"_l_{c}") == F.col(f"_r_{c}"))
    left = left.select(*[F.col(c).alias(f"_l_{c}") if c in on else F.col(c) for c in left.columns])
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    out = left.join(right, condition, how)
    out = out.drop(*[f"_r_{c}" for c in on], *[f"_l_{c}" for c in names])
    for c in keys:
        out = out.withColumnRenamed(f"_l_{c}", c)
    return out


def sky_cells(big: DataFrame, small: DataFrame, *, big_radec: Sequence[str], small_radec: Sequence[str], radius_deg: float):
    """Add ``_zone`` and ``_racell`` so that equality finds every pair within the radius.

    The number of RA cells shrinks with cos(dec) and cells wrap at 360 degrees.
    """

    radius_deg *= 1 + 1e-9

    def cells_in(zone: Column) -> Column:
        edge = F.least(F.greatest(F.abs(zone * radius_deg), F.abs((zone + 1) * radius_deg)), F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * (360.0 / radius_deg)), F.lit(1))

    ra, dec = (F.col(c) for c in big_radec)
    zone = F.floor(dec / radius_deg)
    left = big.withColumn("_zone", zone).withColumn(
        "_racell", F.pmod(F.floor(ra / 360.0 * cells_in(F.col("_zone"))), cells_in(F.col("_zone")))
    )
    ra, dec = (F.col(c) for c in small_radec)
    home = F.floor(dec / radius_deg)
    right = small.withColumn("_zone", F.explode(F.array(home - 1, home, home + 1)))
    n = cells_in(F.col("_zone"))
    widest = F.cos(F.radians(F.least(F.abs(dec) + radius_deg, F.lit(89.9999))))
    reach = F.least(F.lit(radius_deg) / widest * 1.001, F.lit(180.0))
    first, last = F.floor((ra - reach) / 360.0 * n), F.floor((ra + reach) / 360.0 * n)
    last = F.least(last, first + n - 1)
    right = right.withColumn("_racell", F.explode(F.sequence(first, last))).withColumn("_racell", F.pmod(F.col("_racell"), n))
    return left, right
