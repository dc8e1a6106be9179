"""Which sites lie within given distances of a point, without pairing dense neighbourhoods.

Points and sites are put on the unit sphere and into cubes as wide as the largest distance. A chord
is never longer than its arc, so a partner is in the same or a neighbouring cube: an equi join on
the cube, exact at the poles and the date line too.

A crowded cube is halved along each axis, and its parts again, as long as they are crowded. A point
that has a whole cube inside or outside all of its circles takes the cube as one place and compares
none of its sites; only cubes cut by a circle are opened. So a town that holds a third of all sites
costs a point the cubes along its circles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_MILES, haversine_miles
from ..sources.staging import stage

# Sites a point may be compared with one by one in a cube; and how often cubes are halved at most.
CROWD = 256
DEPTH = 12
SITE = -1  # level of a place that is a single site
# what a point makes of a cube: opens it, compares its sites one by one, takes it as one place
OPEN, COMPARED, WHOLE = 0, 1, 2

CUBE = ("__i", "__j", "__k")
SLACK = 1e-9


@dataclass(frozen=True)
class NearPlaces:
    """``near``: point columns, level, place and ``reach``, the smallest distance that covers the place.
    ``members``: site, level and place, for every place a site belongs to.
    """

    near: DataFrame
    members: DataFrame


def _on_sphere(df: DataFrame, at: tuple[str, str], side: str) -> DataFrame:
    known = df.where(F.col(at[0]).isNotNull() & F.col(at[1]).isNotNull())
    phi, lam = F.radians(F.col(at[0])), F.radians(F.col(at[1]))
    axes: tuple[Column, ...] = (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))
    return known.withColumns({f"__{side}{n}": axis for n, axis in enumerate(axes)})


def _squared(steps: Sequence[Column]) -> Column:
    return steps[0] * steps[0] + steps[1] * steps[1] + steps[2] * steps[2]


def _smallest(radii: Sequence[float], covers) -> Column:
    """The smallest radius for which ``covers`` holds, NULL if none does."""
    chosen = None
    for r in sorted(radii):
        chosen = F.when(covers(r), float(r)) if chosen is None else chosen.when(covers(r), float(r))
    return chosen


def near_places(
    points: DataFrame,
    sites: DataFrame,
    point_at: tuple[str, str],
    site_at: tuple[str, str],
    site: str,
    radii: Sequence[float],
    *,
    by: Sequence[str] = (),
    radius: float = EARTH_RADIUS_MILES,
    crowd: int = CROWD,
    depth: int = DEPTH,
) -> NearPlaces:
    """Places within each of ``radii`` miles of the points, single sites or whole cubes of sites.

    ``sites`` has one row per site, numbered by ``site``; ``by`` are columns both sides must agree
    on. Every site within a distance belongs to exactly one place near the point.
    """
    widest = max(radii)
    edge = widest / radius * (1 + 1e-6)
    by = list(by)
    own = list(points.columns)
    probes = _on_sphere(points, point_at, "p")
    vectors = _on_sphere(sites.select(*by, F.col(site).alias("__site"), *site_at), site_at, "s")

    def chord(r: float) -> float:
        return 2 * math.sin(min(r / radius, math.pi) / 2)

    def compared(joined: DataFrame) -> DataFrame:
        """Points next to sites, one by one: the chord sorts out most before the distance is computed."""
        gap = _squared([F.col(f"__p{n}") - F.col(f"__s{n}") for n in range(3)])
        miles = haversine_miles(
            F.col(f"__pt.{point_at[0]}"), F.col(f"__pt.{point_at[1]}"), F.col(site_at[0]), F.col(site_at[1]), radius
        )
        reach = _smallest(radii, lambda r: F.col("__miles") <= r)
        return (
            joined.where(gap <= (chord(widest) * (1 + 1e-6)) ** 2)
            .select("__pt", F.lit(SITE).alias("level"), F.col("__site").alias("place"), miles.alias("__miles"))
            # filtered by the distance and not by the reach, which would repeat it for every radius
            .where(F.col("__miles") <= widest)
            .select("__pt", "level", "place", reach.alias("reach"))
        )

    axes = [f"__p{n}" for n in range(3)]
    at = ["__level", *CUBE]
    # cubes of the finest level, numbered along each axis; an ancestor's number is theirs shifted right
    fine = vectors.withColumns({c: F.floor(F.col(f"__s{n}") * 2**depth / edge) for n, c in enumerate(CUBE)})

    def ancestor(levels_up: Column) -> list[Column]:
        return [F.call_function("shiftright", F.col(c), levels_up).alias(c) for c in CUBE]

    summed = [F.sum("__n").alias("__n"), F.min("__place").alias("__place")]
    cells = fine.groupBy(*by, *CUBE).agg(F.count(F.lit(1)).alias("__n"), F.min("__site").alias("__place"))
    roots = cells.select(*by, *ancestor(F.lit(depth)), "__n", "__place").groupBy(*by, *CUBE).agg(*summed)
    deepest = None
    if depth and roots.where(F.col("__n") > crowd).limit(1).count():
        # all levels in one aggregation; each crowded cube with the cubes of its halves
        every = cells.withColumn("__level", F.explode(F.sequence(F.lit(1), F.lit(depth))))
        nodes = every.select(*by, "__level", *ancestor(F.lit(depth) - F.col("__level")), "__n", "__place").groupBy(*by, *at).agg(*summed)
        parts = nodes.select(
            *by, (F.col("__level") - 1).alias("__level"), *ancestor(F.lit(1)), F.col("__n").alias("__part_n"),
            F.struct(*at, "__n", "__place").alias("__part"),
        )
        opened = parts.groupBy(*by, *at).agg(F.sum("__part_n").alias("__whole"), F.collect_list("__part").alias("__parts"))
        tree = stage(opened.where(F.col("__whole") > crowd).select(*by, *at, "__parts"))
        deepest = tree.agg(F.max("__level")).first()[0]

    cube = {c: F.floor(F.col(f"__p{n}") / edge) for n, c in enumerate(CUBE)}
    started = probes.select(*by, F.struct(*own).alias("__pt"), *axes, *[c.alias(n) for n, c in cube.items()])
    alone = vectors.select(F.col("__site").alias("site"), F.lit(SITE).alias("level"), F.col("__site").alias("place"))
    around = vectors.withColumns({c: F.floor(F.col(f"__s{n}") / edge) for n, c in enumerate(CUBE)}) if deepest is None else roots
    for axis in CUBE:  # the sites are repeated for the 27 cubes around theirs
        around = around.withColumn(f"_{axis}", F.col(axis)).withColumn(
            axis, F.explode(F.sequence(F.col(axis) - 1, F.col(axis) + 1))
        )
    met = started.join(around, [*by, *CUBE])
    if deepest is None:
        return NearPlaces(compared(met).select("__pt.*", "level", "place", "reach"), alone)

    width = F.lit(edge) / F.pow(F.lit(2.0), F.col("__level"))
    middle = F.sqrt(_squared([F.col(f"__p{n}") - (F.col(c) + 0.5) * width for n, c in enumerate(CUBE)]))
    half = width * math.sqrt(3) / 2

    def judged(df: DataFrame) -> DataFrame:
        """Cubes of open rows: inside of a circle and cut by none (a place), cut and small (to be compared) or
        cut and crowded (open); those outside of all circles go."""
        gaps = df.withColumns({"__middle": middle, "__half": half})
        cut = F.lit(False)
        for r in radii:
            cut = cut | (
                (F.col("__middle") - F.col("__half") <= chord(r) + SLACK) & (F.col("__middle") + F.col("__half") >= chord(r) - SLACK)
            )
        known = gaps.withColumns(
            {"__cut": cut, "__new": _smallest(radii, lambda r: F.col("__middle") + F.col("__half") < chord(r))}
        )
        small = (F.col("__n") <= crowd) | (F.col("__level") == depth)
        state = F.when(~F.col("__cut"), WHOLE).when(small, COMPARED).otherwise(OPEN)
        fresh = F.col("__state") == OPEN
        return (
            known.where(~fresh | F.col("__cut") | F.col("__new").isNotNull())
            .withColumn("__reach", F.when(fresh, F.col("__new")).otherwise(F.col("__reach")))
            .withColumn("__state", F.when(fresh, state).otherwise(F.col("__state")))
            .drop("__middle", "__half", "__cut", "__new")
        )

    first = met.withColumns({c: F.col(f"_{c}") for c in CUBE}).drop(*[f"_{c}" for c in CUBE])
    frontier = judged(
        first.withColumns({"__level": F.lit(0), "__state": F.lit(OPEN), "__reach": F.lit(None).cast("double")})
    )
    kept = [*by, "__pt", *axes, "__state", "__reach"]
    halves = tree.select(*[F.col(c).alias(f"__own_{c}") for c in [*by, *at]], "__parts")
    for _ in range(deepest + 1):
        is_open = F.col("__state") == OPEN
        # rows that are settled match nothing and are spread
        level = F.when(is_open, F.col("__level")).otherwise(-1 - F.pmod(F.xxhash64("__pt", "__place"), F.lit(4096)))
        same = level == F.col("__own___level")
        for c in [*by, *CUBE]:
            same = same & (F.col(c) == F.col(f"__own_{c}"))
        itself = F.array(F.struct(*at, "__n", "__place"))
        next_ones = frontier.join(halves, same, "left").select(
            *kept, F.explode(F.coalesce(F.col("__parts"), itself)).alias("__part")
        )
        frontier = judged(next_ones.select(*kept, "__part.*"))
    frontier = stage(frontier.select(*kept, *at, "__place"))

    # the places: sites by the cubes that may be one, the first cubes and the parts of crowded ones
    places = roots.select(*by, F.lit(0).alias("__level"), *CUBE, "__place").unionByName(
        tree.select(*by, F.explode("__parts").alias("__part")).select(*by, *[f"__part.{c}" for c in at], "__part.__place")
    )
    levelled = fine.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(deepest + 1)))).withColumns(
        dict(zip(CUBE, ancestor(F.lit(depth) - F.col("__level"))))
    )
    members = levelled.join(places, [*by, *at]).select(
        F.col("__site").alias("site"), F.col("__level").alias("level"), F.col("__place").alias("place")
    )
    whole = frontier.where(F.col("__state") == WHOLE).select(
        "__pt", F.col("__level").alias("level"), F.col("__place").alias("place"), F.col("__reach").alias("reach")
    )
    leaves = frontier.where(F.col("__state") == COMPARED).select("__pt", *by, *axes, *at)
    near = whole.unionByName(compared(leaves.join(levelled, [*by, *at])))
    return NearPlaces(near.select("__pt.*", "level", "place", "reach"), alone.unionByName(members))
