"""Exact medoid per group without emitting all pairs of a group.

The medoid of a group minimises S(p) = sum_j w_j d(p, x_j) over its members.
The brute-force way is a self-join on the group: n^2 rows per group, and
with few groups the whole n^2 lands in a handful of tasks. Instead identical
coordinates collapse to weighted *locations* (exact for S; a group of copies
holding a third of all rows becomes one row), bounds leave few candidates, and
only these get an exact total.

Built-in metrics: branch and bound over a tree of cells, refined in rounds.

1. Every location is embedded so that the Euclidean norm of the embedding
   never exceeds the metric: the plane itself for utm/euclidean, the 3-D
   point R(cos(lat)cos(lon), cos(lat)sin(lon), sin(lat)) for haversine
   (chord <= arc).
2. Cells keep their weight W_c, weighted mean m_c and a radius bound r_c. By
   Jensen, L(p) = sum_c W_c |p - m_c| <= S(p), and L(p) >= L(m_c) - n r_c for
   p in c. The first cells are a quantile grid of about 2 n^(1/4) per axis.
3. U is the least exact S of a few members. Cells with L(m_c) - n r_c > U are
   dropped, and of the rest the locations with L(p) > U; every true medoid
   survives (all comparisons carry a relative slack).
4. While more than ``TARGET`` candidates a group are left and the cells are
   fewer than a quarter of the locations, the cells that make up the bounds' error are split into 4 x 4,
   U is renewed from the best candidates, and only the candidates are bounded
   again. Far cells stay coarse, and nothing else limits the depth.

Any other distance that is a metric: the same search, embedded by its own distances
to ``2 * len(DIRECTIONS)`` members q at the edges of the group. By the triangle inequality the
greatest of |d(p, q) - d(x, q)| never exceeds d(p, x), and it is a norm, so the bounds
of cells hold as above. In step 4 the cells are split whose sum from some candidates
differs from that of their mean. Rounds end where one leaves more than 7 of 8: the
embedding may be looser than the metric, however fine the cells. Of what is left then,
batches of members get their exact S, and S(p) >= S(q) - n d(p, q) for every member q
of a batch. A batch of about sqrt(n) members drawn from those left is taken in each round.

Sums over pairs of points and masses broadcast whichever side is below a counted
bound, otherwise they join on (group, block of points, block of masses), so no task
ever holds a whole group. Each location's row is written once, and again where distances
embed it; intermediate tables go
under ``spark.checkpoint.dir`` so lineage stays short and a lost executor
re-reads files instead of recomputing stages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ..functions.metrics import EARTH_RADIUS_M, METRICS, Metric, get_metric
from ..functions.udfs import distance_column
from ..session import discard, materialize
from .attach import SMALL_ROWS, Small
from .centroid import top_by
from .guards import IMPLEMENTATIONS, TIES, assert_unique, check_choice, reject_clashes, require_columns, usable_point

SLACK_REL = 1e-9
SLACK_ABS = 1e-6
QUANTILE_STEPS = 64  # finest first grid per axis; coarser ones take every k-th cut
FIRST_GRID = 32  # cells per axis of the first grid at most; rounds split on without a limit
GRID_SCALE = 2.0  # cells per axis ~ GRID_SCALE * n^(1/4)
TARGET = 32  # candidates a group that are summed exactly without another round
SEEDS = 3  # members a group that give the upper bound of a round
FEW_IDS = 1_000  # picked ids that rows are filtered by before the pick-back join
MOST_TASKS = 20_000  # of one stage; beyond it tasks hold more pairs each

#: Digits that totals are rounded to before ranking, by metric.
TIE_DECIMALS = {"utm": 3, "haversine": 3, "euclidean": 9}

NEAR = 4  # candidates a group that cells are split for under a metric that isn't built in

#: Factors of x and y, as shares of the group's range; the members that are first and
#: last along each are those whose distances embed a metric that isn't built in.
DIRECTIONS = ((1.0, 1.0), (1.0, -1.0), (1.0, 0.0), (0.0, 1.0))


class Space:
    """The coordinates of an embedding (``e`` of a point, ``m`` of a cell's mean, ``q`` of a
    candidate) and its norm: Euclidean, or the greatest coordinate."""

    def __init__(self, size: int, greatest: bool):
        self.e, self.m, self.q = ([f"{c}{i}" for i in range(1, size + 1)] for c in "emq")
        self.greatest = greatest

    def norm(self, parts: list[Column]) -> Column:
        if self.greatest:
            return F.greatest(*[F.abs(r) for r in parts])
        return F.sqrt(sum((r * r for r in parts), F.lit(0.0)))

    def apart(self, a: list[str], b: list[str]) -> Column:
        return self.norm([F.col(i) - F.col(j) for i, j in zip(a, b)])


BUILT_IN = Space(3, greatest=False)
BY_DISTANCES = Space(2 * len(DIRECTIONS), greatest=True)


def _embed(metric: Metric, x: Column, y: Column) -> list[Column]:
    if metric.spherical:
        lam, phi = F.radians(x), F.radians(y)
        r = F.lit(EARTH_RADIUS_M)
        return [r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)]
    return [x, y, F.lit(0.0)]


def _held(value: Column) -> Column:
    """``value`` as Catalyst can't move it: a filter or join on it isn't pushed below
    the projection that computes it, which would repeat its expression many times."""
    return value.cast("long") + F.least(F.monotonically_increasing_id(), F.lit(0))


def _grid_size(n_loc: Column, first_grid: int) -> Column:
    """Cells per axis of the first grid: about n^(1/4) (balances bound work against
    candidates), a power of two between 1 and ``first_grid``."""
    k = F.greatest(F.lit(1.0), F.least(F.lit(float(first_grid)), F.lit(GRID_SCALE) * F.pow(n_loc.cast("double"), 0.25)))
    return F.pow(F.lit(2.0), F.round(F.log2(k))).cast("int")


def _count_at_or_below(df: DataFrame, cuts: str, value: str, out: str) -> DataFrame:
    """Number of entries of the sorted array ``cuts`` (63 long) that are <= ``value``.

    A binary search unrolled into six projections of ``element_at``, so it
    stays in generated code (an array lambda would be interpreted per row).
    """
    df = df.withColumn(out, F.lit(0))
    step = QUANTILE_STEPS // 2
    while step >= 1:
        nxt = F.col(out) + F.lit(step)
        df = df.withColumn(out, F.when((nxt <= F.size(cuts)) & (F.element_at(cuts, nxt) <= F.col(value)), nxt)
                           .otherwise(F.col(out)))
        step //= 2
    return df


class Pairs:
    """Joins within groups, whose way depends on the counted sizes of both sides."""

    def __init__(self, group: str, broadcast_rows: int, pairs_per_task: int):
        self.group, self.broadcast_rows, self.pairs_per_task = group, broadcast_rows, pairs_per_task
        self.groups = 0  # set once they are counted

    def attach(self, rows: DataFrame, per_group: DataFrame) -> DataFrame:
        """``rows`` with a table of one row per group, computed from written ones."""
        few = self.groups <= min(SMALL_ROWS, self.broadcast_rows)
        return rows.join(F.broadcast(per_group), self.group) if few else Small(per_group).join(rows, self.group)

    def _spread(self, df: DataFrame, pairs: float) -> DataFrame:
        """Repartition ``df`` where its pairs are more than a task's share."""
        if pairs <= self.pairs_per_task / 8:
            return df
        cores = df.sparkSession.sparkContext.defaultParallelism
        return df.repartition(min(max(2 * cores, math.ceil(pairs / self.pairs_per_task)), MOST_TASKS))

    def fold(self, points: DataFrame, n: int, masses: DataFrame, m: int, keys: list[str], value: Column, how=F.sum) -> DataFrame:
        """``keys`` of ``points`` and ``value``, summed (or ``how``) over the masses of the point's group.

        ``n`` and ``m`` are at least the numbers of rows of the two sides.
        """
        g = self.group
        pairs = float(n) * m / max(1, self.groups)
        if n <= min(m, self.broadcast_rows):
            joined = self._spread(masses, pairs).join(F.broadcast(points), g)
        elif m <= self.broadcast_rows:
            joined = self._spread(points, pairs).join(F.broadcast(masses), g)
        else:
            joined = self._in_blocks(points, masses, keys)
            return joined.groupBy(*keys, "_mb").agg(how(value).alias("value")).groupBy(*keys).agg(how("value").alias("value"))
        return joined.groupBy(*keys).agg(how(value).alias("value"))

    def _in_blocks(self, points: DataFrame, masses: DataFrame, keys: list[str]) -> DataFrame:
        """Every block of a group's points meets every block of its masses; a block pair has about ``pairs_per_task`` pairs."""
        g, side = self.group, float(max(1, math.isqrt(self.pairs_per_task)))
        count = lambda df: df.groupBy(g).agg(F.count(F.lit(1)).alias("n"))
        blocks = Small(count(points).join(count(masses).withColumnRenamed("n", "m"), g)
                       .select(g, F.ceil(F.col("n") / side).cast("int").alias("_np"), F.ceil(F.col("m") / side).cast("int").alias("_nm")))
        p = blocks.join(points, g).withColumn("_pb", F.pmod(F.xxhash64(*keys), F.col("_np")).cast("int"))
        p = p.withColumn("_mb", F.explode(F.sequence(F.lit(0), F.col("_nm") - 1))).drop("_np", "_nm")
        m = blocks.join(masses, g).withColumn("_mb", F.pmod(F.xxhash64(*masses.columns), F.col("_nm")).cast("int"))
        m = m.withColumn("_pb", F.explode(F.sequence(F.lit(0), F.col("_np") - 1))).drop("_np", "_nm")
        return p.join(m, [g, "_pb", "_mb"])


def _locations(df: DataFrame, g: str, x_col: str, y_col: str, metric: Metric) -> DataFrame:
    """Weighted locations ``(lid, g, x, y, w)`` and under a built-in metric ``e1..e3``, written once.

    Validity is folded into the weight so no row filter is pushed into the
    projection that computed the coordinates.
    """
    loc = (
        df.groupBy(g, x_col, y_col).agg(F.sum(F.when(usable_point(x_col, y_col), F.lit(1.0))).alias("w"))
        .filter(F.col("w") > 0)
        .select(g, F.col(x_col).alias("x"), F.col(y_col).alias("y"), "w")
        .filter(F.col(g).isNotNull())
    )
    embedded = zip(_embed(metric, F.col("x"), F.col("y")), BUILT_IN.e) if metric is METRICS.get(metric.name) else ()
    return materialize(loc.select(F.monotonically_increasing_id().alias("lid"), "*", *[c.alias(n) for c, n in embedded]), "locations")


def _embed_by_distances(loc: DataFrame, pairs: Pairs, metric: Metric, implementation: str) -> DataFrame:
    """``loc`` with the distances to its group's outermost members as ``e1..``, written once."""
    g = pairs.group
    ends = materialize(loc.groupBy(g).agg(*[how(c).alias(f"{end}_{c}") for c in ("x", "y") for end, how in (("lo", F.min), ("hi", F.max))]), "ranges")
    sx, sy = (F.coalesce(F.try_divide(F.col(c) - F.col(f"lo_{c}"), F.col(f"hi_{c}") - F.col(f"lo_{c}")), F.lit(0.0)) for c in ("x", "y"))
    along = [F.lit(a) * sx + F.lit(b) * sy for a, b in DIRECTIONS]
    outer = pairs.attach(loc, ends).groupBy(g).agg(
        *[pick("lid", value).alias(e) for e, (pick, value) in zip(BY_DISTANCES.e, ((p, v) for v in along for p in (F.min_by, F.max_by)))])
    outer = materialize(outer.select(g, F.explode(F.array(*[F.struct(F.lit(e).alias("e"), F.col(e).alias("lid")) for e in BY_DISTANCES.e])).alias("o")).select(g, "o.*"), "outer")
    found = Small(outer.select("lid").distinct()).join(loc.select("lid", "x", "y"), "lid").join(outer, "lid")
    place = materialize(found.groupBy(g).agg(*[F.max(F.when(F.col("e") == e, F.col(c))).alias(f"_{c}_{e}") for e in BY_DISTANCES.e for c in ("x", "y")]), "outermost")
    far = [distance_column(metric, implementation, "x", "y", f"_x_{e}", f"_y_{e}").alias(e) for e in BY_DISTANCES.e]
    return materialize(pairs.attach(loc, place).select(*loc.columns, *far), "embedded")


def _top(df: DataFrame, g: str, order: list, k: int) -> DataFrame:
    w = Window.partitionBy(g).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


class Cells:
    """The tree of cells over the locations: its leaves, and the cell of each location as a lazy column."""

    def __init__(self, loc: DataFrame, pairs: Pairs, first_grid: int, space: Space):
        self.pairs, self.g, self.space = pairs, pairs.group, space
        probs = [i / QUANTILE_STEPS for i in range(1, QUANTILE_STEPS)]
        grid = Small(loc.groupBy(self.g).agg(
            F.count(F.lit(1)).alias("n_loc"),
            F.percentile_approx("x", probs, 1000).alias("qx"),
            F.percentile_approx("y", probs, 1000).alias("qy"),
        ).select(self.g, "qx", "qy", (F.lit(QUANTILE_STEPS) / _grid_size(F.col("n_loc"), first_grid)).cast("int").alias("s")))
        at = grid.join(loc, self.g)
        at = _count_at_or_below(_count_at_or_below(at, "qx", "x", "_fx"), "qy", "y", "_fy")
        row = F.floor(F.col("_fx") / F.col("s")) * (F.lit(QUANTILE_STEPS) / F.col("s"))
        self.located = at.select(*loc.columns, _held(row + F.floor(F.col("_fy") / F.col("s"))).alias("cell"))
        self._summarise()

    def _summarise(self) -> None:
        E, M = self.space.e, self.space.m
        made = self.located.groupBy(self.g, "cell").agg(
            F.sum("w").alias("w"), F.count(F.lit(1)).alias("nl"), F.first("x").alias("sx"), F.first("y").alias("sy"),
            *[(F.sum(F.col("w") * F.col(e)) / F.sum("w")).alias(m) for e, m in zip(E, M)],
            *[F.min(c).alias(f"lo_{c}") for c in (*E, "x", "y")], *[F.max(c).alias(f"hi_{c}") for c in (*E, "x", "y")],
        )
        reach = [F.greatest(F.col(f"hi_{e}") - F.col(m), F.col(m) - F.col(f"lo_{e}")) for e, m in zip(E, M)]
        box = [f"{end}_{c}" for c in ("x", "y") for end in ("lo", "hi")]
        radius = self.space.norm(reach).alias("radius")
        self.leaves = materialize(made.select(self.g, "cell", "w", "nl", "sx", "sy", *M, radius, *box), "cells")
        self.number = self.leaves.count()

    def bound(self, points: DataFrame, n: int, keys: list[str]) -> DataFrame:
        """``keys`` and ``value``, the lower bound L at the embedding of each of (at most n) points."""
        masses = self.leaves.select(self.g, F.col("w").alias("cw"), *self.space.m)
        return self.pairs.fold(points, n, masses, self.number, keys, F.col("cw") * self.space.apart(self.space.e, self.space.m))

    def narrow(self, cells: DataFrame) -> DataFrame:
        """``cells``, some of the leaves, as the side of a join on (group, cell)."""
        return F.broadcast(cells) if self.number <= self.pairs.broadcast_rows else cells.hint("merge")

    def _rated(self, near: DataFrame) -> DataFrame:
        """The leaves with the error ``_err`` that each makes in bounds at the embedded points ``near(g, q1..)``.

        Under the Euclidean norm it is estimated: of first order (the radius) close by and
        of second order far away. Under the greatest coordinate it is what the cell's sum
        exceeds that of its mean by, nothing where one coordinate is the greatest for all of a cell.
        """
        e, m, q = self.space.e, self.space.m, self.space.q
        if not self.space.greatest:
            d = self.space.apart(m, q)
            error = F.col("w") * F.col("radius") * F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("radius"), 2.0 * d), F.lit(1.0)))
            return self.pairs.attach(self.leaves, near).withColumn("_err", error)

        def sums(rows: DataFrame, at: list[str], out: str) -> DataFrame:
            return self.pairs.attach(rows, near).groupBy(self.g, "cell").agg(F.sum(F.col("w") * self.space.apart(at, q)).alias(out))

        error = sums(self.located, e, "_own").join(sums(self.leaves, m, "_mean"), [self.g, "cell"])
        return materialize(self.leaves.join(error.select(self.g, "cell", (F.col("_own") - F.col("_mean")).alias("_err")), [self.g, "cell"]), "rated")

    def split(self, near: DataFrame) -> None:
        """Split into 4 x 4 the cells with the group's mean error or more in bounds at the embedded points ``near(g, q1..)``."""
        rated = self._rated(near)
        mean = rated.groupBy(self.g).agg(F.avg("_err").alias("_mean"))
        parted = self.pairs.attach(rated, mean).where((F.col("nl") > 1) & (F.col("radius") > 0) & (F.col("_err") >= F.col("_mean")))
        parted = materialize(parted.select(self.g, "cell", "lo_x", "hi_x", "lo_y", "hi_y"), "split")
        at = self.located.join(self.narrow(parted), [self.g, "cell"], "left")

        def part(c: str) -> Column:
            place = F.floor(F.try_divide(F.col(c) - F.col(f"lo_{c}"), F.col(f"hi_{c}") - F.col(f"lo_{c}")) * 4)
            return F.least(F.lit(3), F.coalesce(place, F.lit(0)))

        below = F.when(F.col("lo_x").isNotNull(), 1 + part("x") * 4 + part("y")).otherwise(F.lit(0))
        columns = [c for c in self.located.columns if c != "cell"]
        self.located = at.select(*columns, _held(F.col("cell") * 17 + below).alias("cell"))
        old = self.leaves
        self._summarise()
        discard(old)


def _upper(pairs: Pairs, seeds: DataFrame, loc: DataFrame, locations: int, dist: Column) -> DataFrame:
    """``(g, u)``: the least exact total of each group's few seeds ``(g, cx, cy)``."""
    g = pairs.group
    sums = pairs.fold(seeds.select(g, "cx", "cy").distinct(), SEEDS * pairs.groups, loc.select(g, "x", "y", "w"), locations, [g, "cx", "cy"], F.col("w") * dist)
    return materialize(sums.groupBy(g).agg(F.min("value").alias("u")), "upper")


def _by_cells(loc: DataFrame, locations: int, pairs: Pairs, dist: Column, limit, first_grid: int, stats: dict, space: Space = BUILT_IN) -> tuple[DataFrame, int]:
    """Candidates ``(cid, g, cx, cy)`` by the bounds of the cells, and their number."""
    g, E, M = pairs.group, space.e, space.m
    cells = Cells(loc, pairs, first_grid, space)
    own = cells.leaves.select(g, "cell", "sx", "sy", "w", "radius", *[F.col(m).alias(e) for m, e in zip(M, E)])
    bounds = materialize(cells.bound(own.select(g, "cell", *E), cells.number, [g, "cell"]).join(own, [g, "cell"]), "cell-bounds")
    seeds = _top(bounds, g, [F.col("value"), F.col("cell")], SEEDS).select(g, F.col("sx").alias("cx"), F.col("sy").alias("cy"))
    upper = _upper(pairs, seeds, loc, locations, dist)
    weight = bounds.groupBy(g).agg(F.sum("w").alias("n"))
    known = pairs.attach(bounds, upper.join(weight, g))
    live = known.where(F.col("value") - F.col("n") * F.col("radius") <= limit(F.col("u"))).select(g, "cell")
    points = cells.located.join(cells.narrow(live), [g, "cell"]).select(F.col("lid").alias("cid"), g, F.col("x").alias("cx"), F.col("y").alias("cy"), *E)

    def bounded(points: DataFrame, n: int, upper: DataFrame) -> DataFrame:
        found = pairs.attach(cells.bound(points, n, ["cid", g, "cx", "cy", *E]), upper)
        return materialize(found.where(F.col("value") <= limit(F.col("u"))).drop("u").withColumnRenamed("value", "lb"), "candidates")

    candidates = bounded(points, locations, upper)
    left, rounds = candidates.count(), 0
    while left > TARGET * pairs.groups and cells.number * 4 < locations:
        best = _top(candidates, g, [F.col("lb"), F.col("cid")], SEEDS)
        near = _top(candidates, g, [F.col("lb"), F.col("cid")], 1)
        if space.greatest:  # the best one, and others drawn by a hash
            near = materialize(near.unionByName(_top(candidates, g, [F.xxhash64("cid"), F.col("cid")], NEAR - 1)), "near")
        near = near.select(g, *[F.col(e).alias(q) for e, q in zip(E, space.q)])
        upper = upper.unionByName(_upper(pairs, best, loc, locations, dist)).groupBy(g).agg(F.min("u").alias("u"))
        cells.split(near)
        under = pairs.attach(candidates, upper).where(F.col("lb") <= limit(F.col("u")))
        fewer = bounded(under.drop("lb", "u"), left, upper)
        discard(candidates)
        before, candidates, left, rounds = left, fewer, fewer.count(), rounds + 1
        if space.greatest and 8 * left > 7 * before:
            break
    stats.update(cells=cells.number, candidates=left, rounds=rounds)
    return candidates.select("cid", g, "cx", "cy"), left


def _by_triangle(points: DataFrame, left: int, loc: DataFrame, locations: int, pairs: Pairs, dist: Column, limit, stats: dict) -> tuple[DataFrame, int]:
    """Those of the ``left`` candidates ``points(cid, g, cx, cy)`` that exact totals of some of them leave, and their number."""
    g = pairs.group
    weight = materialize(loc.groupBy(g).agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("k")), "weights")
    masses = loc.select(g, "x", "y", "w")
    upper, rounds = None, 0
    while left > TARGET * pairs.groups:
        # a batch of about sqrt(n) members of those left, drawn by a hash that differs between rounds
        share = points.groupBy(g).agg(F.count(F.lit(1)).alias("_left")).join(weight, g).select(
            g, F.least(F.lit(1.0), F.sqrt(F.col("k").cast("double")) / F.col("_left")).alias("_share"))
        draw = F.pmod(F.xxhash64("cid", F.lit(rounds)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        batch = pairs.attach(points, materialize(share, "shares")).where(draw < F.col("_share")).drop("_share")
        batch = materialize(batch, "batch")
        sums = pairs.fold(batch, batch.count(), masses, locations, ["cid", g, "cx", "cy"], F.col("w") * dist)
        sums = materialize(sums, "batch-totals")
        least = sums.groupBy(g).agg(F.min("value").alias("u"))
        upper = materialize(least if upper is None else upper.unionByName(least).groupBy(g).agg(F.min("u").alias("u")), "upper")
        pivots = pairs.attach(sums, weight).select(g, F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("value").alias("total"), "n")
        pivots = materialize(pivots, "pivots")
        lower = pairs.fold(points, left, pivots, pivots.count(), ["cid", g, "cx", "cy"], F.col("total") - F.col("n") * dist, F.max)
        # a group without a draw keeps all its members for this round
        bounded = points.join(lower.select("cid", "value"), "cid", "left").join(upper, g, "left")
        out = F.coalesce(F.col("value") > limit(F.col("u")), F.lit(False))
        fewer = materialize(bounded.where(~out).drop("value", "u"), "candidates")
        now, rounds = fewer.count(), rounds + 1
        points, halved, left = fewer, 2 * now <= left, now
        if not halved:
            break
    stats.update(candidates=left, rounds=stats.get("rounds", 0) + rounds)
    return points, left


def medoid_totals(
    df: DataFrame,
    group_col: str,
    x_col: str,
    y_col: str,
    metric: str | Metric = "utm",
    first_grid: int = FIRST_GRID,
    broadcast_rows: int = 200_000,
    pairs_per_task: int = 4_000_000,
    stats: dict | None = None,
    tie_decimals: int | None = None,
    implementation: str = "native",
    bound: str = "triangle",
) -> DataFrame:
    """Exact total distance S for every location that can be a medoid.

    With ``tie_decimals`` that includes every location whose total rounds to
    the least one's. A distance that is not built in has to be a metric
    (symmetric, with the triangle inequality), unless ``bound="none"``: then every
    location is summed. ``implementation="pandas_udf"`` evaluates a distance that
    exists only over arrays.

    Returns (group, x, y, total_distance) for the candidate locations of
    each group; the minimum per group is the exact medoid total. Rows with a
    null group or a null/NaN coordinate take no part.
    """
    m = get_metric(metric)
    check_choice("implementation", implementation, IMPLEMENTATIONS)
    check_choice("bound", bound, ("triangle", "none"))
    if first_grid < 1 or first_grid > QUANTILE_STEPS or first_grid & (first_grid - 1):
        raise ValueError(f"first_grid must be a power of two in [1, {QUANTILE_STEPS}]")
    g = group_col
    stats = {} if stats is None else stats
    pairs = Pairs(g, broadcast_rows, pairs_per_task)
    loc = _locations(df, g, x_col, y_col, m)
    dist = distance_column(m, implementation, "x", "y", "cx", "cy")
    # the slack covers float sums over all locations and, where totals are rounded before
    # ranking, the width of a rounding step
    sizes = loc.agg(F.count(F.lit(1)), F.count_distinct(g)).first()
    locations, pairs.groups = sizes
    rel = max(SLACK_REL, 4.0 * locations * 2.0**-52)
    step = 0.0 if tie_decimals is None else 10.0**-tie_decimals

    def limit(u: Column) -> Column:
        return u * F.lit(1.0 + rel) + F.lit(SLACK_ABS + step)

    cand, n = loc.select(F.col("lid").alias("cid"), g, F.col("x").alias("cx"), F.col("y").alias("cy")), locations
    if m is METRICS.get(m.name):
        cand, n = _by_cells(loc, locations, pairs, dist, limit, first_grid, stats)
    elif bound == "triangle":
        if locations > TARGET * pairs.groups:
            embedded = _embed_by_distances(loc, pairs, m, implementation)
            cand, n = _by_cells(embedded, locations, pairs, dist, limit, first_grid, stats, BY_DISTANCES)
            cand, n = _by_triangle(cand, n, loc, locations, pairs, dist, limit, stats)
    stats.update(broadcast_rows=broadcast_rows, locations=locations)
    totals = pairs.fold(cand, n, loc.select(g, "x", "y", "w"), locations, ["cid", g, "cx", "cy"], F.col("w") * dist)
    return totals.select(g, F.col("cx").alias(x_col), F.col("cy").alias(y_col), F.col("value").alias("total_distance"))


def _with_ids(df: DataFrame, id_col: str, picks: Small) -> DataFrame:
    """``df``, without most rows that a join with ``picks`` on the id drops, if the ids are few.

    Unlike the join, a filter by values is pushed below the projection of ``df``,
    which then is evaluated for rows with these ids only.
    """
    if not picks.local or not isinstance(df.schema[id_col].dataType, (StringType, IntegralType)):
        return df
    ids = [r[0] for r in picks.df.select(id_col).distinct().limit(FEW_IDS + 1).collect()]
    return df.where(F.col(id_col).isin(ids)) if len(ids) <= FEW_IDS else df


def medoid(
    df: DataFrame,
    group_col: str,
    id_col: str,
    x_col: str,
    y_col: str,
    metric: str | Metric = "utm",
    ties: str = "all",
    tie_decimals: int | str | None = "auto",
    check_unique: bool = False,
    **tuning,
) -> DataFrame:
    """Per group, the member(s) minimising the total distance to all members.

    Output: group column, id column, the other input columns, ``total_distance``.
    ``metric`` is a built-in one, or any function of four columns that is a metric
    (see ``medoid_totals`` for the options). ``ties="all"`` keeps every member at a
    minimal total (members sharing the
    medoid's coordinates always tie); ``"first"`` keeps the lowest id. Totals
    are rounded to ``tie_decimals`` before ranking, so sums that differ only by
    float noise tie: ``"auto"`` is 3 for metres and 9 for degrees (bare sums for
    other distances) and returns the bare totals, a number returns rounded ones, and
    None ranks the bare sums.

    Eager: the stages before the last run when it is called. Coordinates are
    evaluated once, into a written table of (group, id, x, y); picks come back
    by (group, id), with coordinates only as a check against repeated ids.
    """
    check_choice("ties", ties, TIES)
    require_columns(df, group_col, id_col, x_col, y_col)
    reject_clashes(df, ("total_distance", "_pick", "_rank", "_bx", "_by", "_first"))
    if check_unique:
        assert_unique(df.filter(F.col(group_col).isNotNull()), [group_col, id_col])
    auto = tie_decimals == "auto"
    if auto:
        tie_decimals = TIE_DECIMALS.get(get_metric(metric).name)
    members = materialize(df.select(*dict.fromkeys([group_col, id_col, x_col, y_col])), "members")
    totals = medoid_totals(members, group_col, x_col, y_col, metric, tie_decimals=tie_decimals, **tuning)
    rounded = F.col("total_distance") if tie_decimals is None else F.round("total_distance", tie_decimals)
    totals = totals.withColumn("_rank", rounded)
    if not auto:
        totals = totals.withColumn("total_distance", F.col("_rank"))
    best = Small(top_by(totals, group_col, "_rank", None, "all"))
    # members at the winning locations (all tie: they share coordinates)
    won = best.join(members, [group_col, x_col, y_col]).select(
        group_col, id_col, F.col(x_col).alias("_bx"), F.col(y_col).alias("_by"), "total_distance").distinct()
    if ties == "first":  # the least id by an aggregate; of locations that share it, the least
        first = won.groupBy(group_col).agg(F.min(id_col).alias("_first"))
        own = won.join(first, group_col).where(F.col(id_col).eqNullSafe(F.col("_first"))).drop("_first")
        won = _top(own, group_col, ["_bx", "_by"], 1)
    close = lambda c, b: F.abs(F.col(c) - F.col(b)) <= 1e-9 * (1.0 + F.abs(F.col(b)))
    picks = Small(won)
    picked = picks.join(_with_ids(df, id_col, picks), [group_col, id_col]).where(close(x_col, "_bx") & close(y_col, "_by")).drop("_bx", "_by")
    rest = [c for c in df.columns if c not in (group_col, id_col)]
    return picked.select(group_col, id_col, *rest, "total_distance")
