"""Exact nearest-neighbour joins without a product of the two sides.

Points have a whole-number place on each axis of a grid that is as fine as coordinates can be
told apart; the cell of any coarser grid follows by shifting the places. A search walks both
sides' *occupied cells*, not their rows, from one root cell down: a pair of cells survives while
the closest their points can be is no more than the farthest the best partner can be. A left
cell is done as soon as each right cell it still has holds at most ``LEAF`` points, so the grid
gets fine where points are dense and only there, and levels on which nothing splits are passed
over. What survives is a short list of candidate points per left cell, and each left row looks
its list up once and takes its minimum: left rows are never multiplied or grouped.

With few left rows nothing of the right side moves but counts of cells: the bound of each left
row is broadcast as cells, and one filtered scan of the right side finds the rest.

Great-circle search runs on unit vectors, where straight-line distance orders points the
same way; planar search runs on the two coordinates. Equal right points are merged before
indexing, so a heap of copies costs one point.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.functions import geo
from kerbside.operators.skew import join_unique
from kerbside.session import broadcast_if, broadcast_or_merge, materialise, spread, store

LEAF = 8             # right points that a cell of a finished search may hold
CANDIDATES = 500_000  # candidates of all cells together, some 40 MB, that may be broadcast
ROOT_POINTS = 32     # right sides up to this size need no grid at all
FEW_ROWS = 1_000     # left sides up to this size are taken to the right side
SCANNED = 500_000    # candidates that few left rows may have before their cells are refined
FEW_PAIRS = 1_000_000  # pairs of a few left rows and cells, about, that are formed at first
STEP = 2             # grid levels per descent step: each cell splits into 4 per axis
FIRST_PAIRS = 2_000_000  # cell pairs the first step, which starts from one root, may form
FIRST_LEVEL = 10     # deepest grid the first step may reach
NEIGHBOURS = 128     # points around a point that are compared outright
# Width of the finest cells, about a tenth of a micrometre: coordinates are doubles, and
# what they are off by is far below a cell of it.
_FINEST = {"haversine": 2.0 ** -46, "planar": 2.0 ** -40}
_OFF = 1 / 32        # how far a place may be off, in cells of the finest grid
_SLACK = 1e-9        # relative, on squared distances


Bounds = tuple[int, list[float], list[float]]   # rows, lowest and highest value per axis


@dataclass(frozen=True)
class Grid:
    """Whole-number places: ``depth`` levels over a cube at ``low``."""

    metric: str
    low: list[float]
    side: float
    depth: int

    @property
    def axes(self) -> int:
        return len(self.low)

    def places(self, lat: Column, lng: Column) -> list[Column]:
        """The place on each axis, as columns __p0, __p1, ..."""
        top, scale = 2 ** self.depth - 1, 2.0 ** self.depth / self.side
        vector = _embedding(self.metric, lat, lng)
        return [F.greatest(F.lit(0), F.least(F.lit(top), F.floor((v - lo) * scale))).cast("long").alias(f"__p{i}")
                for i, (v, lo) in enumerate(zip(vector, self.low))]

    def up(self, tag: str, level: int) -> list[Column]:
        """The cell of a level that a place is in, as columns tag0, tag1, ..."""
        return [F.expr(f"shiftright(__p{i}, {self.depth - level})").alias(f"{tag}{i}") for i in range(self.axes)]

    def names(self, tag: str) -> list[str]:
        return [f"{tag}{i}" for i in range(self.axes)]

    def packed(self, level: int) -> Column:
        """The cell of a coarse level in one number."""
        return F.expr(" | ".join(
            f"shiftleft(shiftright(__p{i}, {self.depth - level}), {FIRST_LEVEL * i})" for i in range(self.axes)))


@dataclass(frozen=True)
class PointIndex:
    """A right side prepared for searching; reusable across searches."""

    points: DataFrame       # latitude, longitude, ids, rlat, rlng, clat, and places
    ids: list[str]
    rows: int
    grid: Grid
    filled: list[int] = field(default_factory=list)  # occupied cells per level, about

    def covers(self, bounds: Bounds) -> bool:
        """Whether all places of a left side with these bounds lie on the grid."""
        grid = self.grid
        return not bounds[0] or not grid.depth or all(
            lo <= a and b <= lo + grid.side for lo, a, b in zip(grid.low, bounds[1], bounds[2]))


def _embedding(metric: str, lat: Column, lng: Column) -> list[Column]:
    return geo.unit_vector(lat, lng) if metric == "haversine" else [lat, lng]


def _bounds(df: DataFrame, metric: str) -> Bounds:
    """Row count and the lowest and highest value per axis."""
    vector = _embedding(metric, F.col("latitude"), F.col("longitude"))
    row = df.agg(F.count("*"), *[F.min(v) for v in vector], *[F.max(v) for v in vector]).first()
    n = len(vector)
    return row[0], list(row[1:n + 1]), list(row[n + 1:])


def _grid(metric: str, bounds: list[Bounds]) -> Grid:
    known = [b for b in bounds if b[0]]
    low = [min(v) for v in zip(*[b[1] for b in known])]
    high = [max(v) for v in zip(*[b[2] for b in known])]
    side = max(b - a for a, b in zip(low, high)) or 1.0
    return Grid(metric, low, side, max(1, min(50, math.ceil(math.log2(side / _FINEST[metric])))))


def _occupied(grid: Grid, df: DataFrame) -> list[int]:
    """About how many cells of each coarse grid the places fill."""
    return list(df.agg(*[F.approx_count_distinct(grid.packed(at)) for at in range(1, min(grid.depth, FIRST_LEVEL) + 1)]).first())


def _positioned(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def _with_radians(df: DataFrame) -> DataFrame:
    rlat = F.radians("latitude")
    return df.select("*", rlat.alias("rlat"), F.radians("longitude").alias("rlng"), F.cos(rlat).alias("clat"))


def build_index(right: DataFrame, ids: list[str], *, searched_by: list[DataFrame] | None,
                metric: str = "haversine", merge_copies: bool = True, stored: bool = False,
                within: PointIndex | None = None) -> PointIndex:
    """Index ``right`` (latitude, longitude, ``ids``) for searches from ``searched_by``.

    With None as ``searched_by`` it can be searched from anywhere on the sphere.
    ``merge_copies`` keeps the lowest ``ids`` of equal positions; switch it off when the
    copies differ in something a search has to look at. ``stored`` says that ``right`` is
    cheap to read again, so that it need not be written for the passes over it. The grid also
    covers that of ``within``.
    """
    right = _positioned(right).select("latitude", "longitude", *ids)
    if merge_copies:
        lowest = F.min(ids[0]) if len(ids) == 1 else F.min(F.struct(*ids))
        right = right.groupBy("latitude", "longitude").agg(lowest.alias("lowest"))
        right = right.select("latitude", "longitude", *(
            [F.col("lowest").alias(ids[0])] if len(ids) == 1 else [F.col(f"lowest.{i}") for i in ids]))
    right = right if stored and not merge_copies else store(right)
    bounds = [_bounds(right, metric)]
    total = bounds[0][0]
    prepared = _with_radians(right)
    if total <= ROOT_POINTS:
        return PointIndex(prepared, ids, total, Grid(metric, [], 1.0, 0))
    if searched_by is None:
        if metric != "haversine":
            raise ValueError("only the sphere has bounds of its own")
        grid = _grid(metric, [(1, [-1.0] * 3, [1.0] * 3)])
    else:
        if within is not None and within.grid.depth:
            bounds.append((1, within.grid.low, [lo + within.grid.side for lo in within.grid.low]))
        grid = _grid(metric, bounds + [_bounds(_positioned(other), metric) for other in searched_by])
    points = prepared.select("*", *grid.places(F.col("latitude"), F.col("longitude")))
    return PointIndex(points, ids, total, grid, _occupied(grid, points))


def _first_step(left_filled: list[int], right_filled: list[int], pairs: int) -> int:
    """The deepest grid on which all pairs of occupied cells are few."""
    step = 1
    while step < len(left_filled) and left_filled[step] * right_filled[step] <= pairs:
        step += 1
    return step


def _unsplit(grid: Grid, rights: DataFrame, level: int, cells: DataFrame) -> int:
    """The deepest level on which none of the cells has split."""
    inside = rights.select(*grid.up("__c", level), *grid.names("__p")).join(cells, grid.names("__c"), "left_semi")
    spans = inside.groupBy(*grid.names("__c")).agg(*[
        F.expr(f"length(bin(min({p}) ^ max({p})))").alias(p) for p in grid.names("__p")])
    widest = spans.agg(F.max(F.greatest(*grid.names("__p")))).first()[0]
    return max(level, grid.depth - (widest or 0))


@dataclass
class Descent:
    """Walks from the root cell to pairs of cells that are close enough.

    ``lefts`` and ``rights`` have places; ``rights`` may have ``reach2`` (squared limit of its
    own), ``lefts`` may have ``__k``, how many neighbours are wanted.
    """

    grid: Grid
    lefts: DataFrame
    rights: DataFrame
    left_rows: int
    right_rows: int
    other_than_self: bool = False

    def _cells(self, base: DataFrame, tag: str, level: int, parent: int, within: DataFrame | None,
               rows: int, aggregates: list[str]) -> DataFrame:
        grid = self.grid
        if within is not None:
            base = base.select("*", *grid.up(f"__u{tag}", parent)).join(
                broadcast_if(within, rows), grid.names(f"__u{tag}"), "left_semi")
        cells = base.groupBy(*grid.up(f"__{tag}", level)).agg(*[F.expr(a) for a in aggregates])
        return cells.select("*", *[F.expr(f"shiftright(__{tag}{i}, {level - parent})").alias(f"__u{tag}{i}")
                                   for i in range(grid.axes)])

    def step(self, front: DataFrame | None, front_rows: int, parent: int, level: int) -> DataFrame:
        """Pairs of cells (__a*, __c*) of a level with the points of the right one and ``limit2``."""
        grid, axes = self.grid, range(self.grid.axes)
        reach, wanted = "reach2" in self.rights.columns, "__k" in self.lefts.columns
        names = {t: grid.names(f"__{t}") for t in ("a", "c", "ua", "uc")}

        def seen(tag: str) -> DataFrame | None:
            # worth a pass of its own where few cells are left; the join below does it anyway
            if front is None or 4 * front_rows > max(self.left_rows, self.right_rows):
                return None
            return front.select(*[F.col(f"__{tag}{i}").alias(f"__u{tag}{i}") for i in axes]).distinct()

        lefts = self._cells(self.lefts, "a", level, parent, seen("a"), front_rows,
                            ["max(__k) AS __k" if wanted else "1 AS __k"])
        unit = 4.0 ** level / (grid.side * grid.side)
        rights = self._cells(self.rights, "c", level, parent, seen("c"), front_rows,
                             ["count(*) AS points", *([f"max(reach2) * {unit!r}D AS reach2"] if reach else [])])
        if front is None:
            # one root cell on either side, so this join is on the constant cell zero
            roots = [F.col(f"__ua{i}") == F.col(f"__uc{i}") for i in axes]
            pairs = spread(lefts, self.left_rows).withColumn("parent2", F.expr("double('Infinity')")).join(
                broadcast_if(rights, self.right_rows), roots)
        else:
            up = front.select(*[F.col(f"__{t}{i}").alias(f"__u{t}{i}") for t in "ac" for i in axes],
                              (F.col("limit2") * 4.0 ** (level - parent)).alias("parent2"))
            pairs = spread(up, front_rows).join(broadcast_if(rights, self.right_rows), names["uc"]).join(
                broadcast_if(lefts, self.left_rows), names["ua"])
        # squared distances in cell widths: closest and farthest points of two cells can be apart
        off = _OFF * 2.0 ** (level - grid.depth)
        apart = [f"abs(cast(__a{i} - __c{i} AS double))" for i in axes]
        near2 = " + ".join(f"greatest(0D, {d} - {1 + off!r}D) * greatest(0D, {d} - {1 + off!r}D)" for d in apart)
        far2 = " + ".join(f"({d} + {1 + off!r}D) * ({d} + {1 + off!r}D)" for d in apart)
        same = " AND ".join(f"__a{i} = __c{i}" for i in axes)
        sure = "true"
        possible = f"near2 <= parent2 * {1 + _SLACK}"
        if self.other_than_self:
            sure += f" AND (points > 1 OR NOT ({same}))"
        if reach:
            sure += f" AND far2 <= reach2 * {1 - _SLACK}"
            possible += f" AND near2 <= reach2 * {1 + _SLACK}"
        pairs = pairs.selectExpr(*names["a"], *names["c"], "parent2", "points", "__k", *(["reach2"] if reach else []),
                                 f"{near2} AS near2", f"{far2} AS far2").where(possible)
        if wanted:
            # as many points as are wanted lie surely within the limit
            nearer = Window.partitionBy(*names["a"]).orderBy("far2").rangeBetween(Window.unboundedPreceding, 0)
            within = pairs.where(sure).withColumn("held", F.sum("points").over(nearer)).where("held >= __k")
            limits = pairs.groupBy(*names["a"]).agg(F.min("parent2").alias("parent2")).join(
                within.groupBy(*names["a"]).agg(F.min("far2").alias("far2")), names["a"], "left")
            limits = limits.select(*names["a"], F.expr("least(far2, parent2) AS limit2"))
        else:
            # forming the few pairs again is cheaper than keeping lists of them while the
            # limit is being found
            limits = pairs.groupBy(*names["a"]).agg(
                F.expr(f"least(min(if({sure}, far2, NULL)), min(parent2)) AS limit2"))
        close = pairs.join(broadcast_if(limits, self.left_rows), names["a"]).where(f"near2 <= limit2 * {1 + _SLACK}")
        return materialise(close.select(*names["a"], *names["c"], "points", "limit2"))

    def run(self, first: int) -> list[tuple[int, DataFrame, int]]:
        """(level, pairs, candidates) of the left cells that each level finishes."""
        grid, done = self.grid, []
        front, front_rows, parent, level, before = None, 0, 0, min(first, grid.depth), -1
        while True:
            front = self.step(front, front_rows, parent, level)
            front_rows, fullest, held = front.agg(F.count("*"), F.max("points"), F.sum("points")).first()
            if not front_rows or fullest <= LEAF or level == grid.depth:
                return done + [(level, front, held or 0)]
            cell = grid.names("__a")
            open_cells = front.groupBy(*cell).agg(F.max("points").alias("most")).where(F.col("most") > LEAF).drop("most")
            open_cells = broadcast_if(materialise(open_cells), front_rows)
            done.append((level, front.join(open_cells, cell, "left_anti"), held))
            front = front.join(open_cells, cell, "left_semi")
            parent = level
            if fullest == before:
                level = _unsplit(grid, self.rights, level, broadcast_if(
                    front.where(F.col("points") > LEAF).select(*grid.names("__c")).distinct(), front_rows))
            # halving cells once more is enough where they are all but done
            before, level = fullest, min(level + (STEP if fullest > 4 * LEAF else 1), grid.depth)


def _candidate_lists(left: DataFrame, total: int, index: PointIndex, points: DataFrame, fields: list[str],
                     other_than_self: bool) -> DataFrame:
    """Left rows with the list of points that may be their nearest."""
    grid = index.grid
    if grid.depth == 0:
        # at most ROOT_POINTS candidates in all: one row, attached to every left row
        lists = points.groupBy(F.lit(0).alias("__cell")).agg(F.collect_list(F.struct(*fields)).alias("__candidates"))
        return left.withColumn("__cell", F.lit(0)).join(lists.hint("broadcast"), "__cell")
    descent = Descent(grid, left, points, total, index.rows, other_than_self)
    found = None
    for level, pairs, held in descent.run(_first_step(_occupied(grid, left), index.filled, FIRST_PAIRS)):
        cells = grid.names("__a")
        lists = pairs.join(points.select(*fields, *grid.up("__c", level)), grid.names("__c")).groupBy(*cells).agg(
            F.collect_list(F.struct(*fields)).alias("__candidates"))
        rows = spread(left, total).select("*", *grid.up("__a", level))
        if held <= CANDIDATES:
            rows = rows.join(lists.hint("broadcast"), cells)
        else:
            sizes = left.groupBy(*grid.up("__a", level)).agg(F.count("*").alias("rows"))
            rows = join_unique(rows, lists, cells, sizes, total)
        rows = rows.select(*left.columns, "__candidates")
        found = rows if found is None else found.unionByName(rows)
    return found


def search(left: DataFrame, index: PointIndex, *, prefix: str = "", distance: str = "distance",
           other_than_self: bool = False, reach: DataFrame | None = None,
           accepts: Callable[[Column, Column], Column] | None = None, stored: bool = False,
           wanted: str | None = None, names: list[str] | None = None) -> DataFrame:
    """Each row of ``left`` with its nearest indexed point; ties go to the lowest ids.

    Left rows without coordinates, or without any eligible point, are left out.
    ``other_than_self`` ignores points at the row's own position. ``reach`` limits points:
    a DataFrame of ids, ``reach2`` (squared straight-line limit, infinite for none) and
    further columns, which ``accepts(candidate, distance)`` can test exactly. ``stored`` says
    that ``left`` is cheap to read again and always the same. ``wanted`` names a column of
    ``left``: as many points are returned, nearest first, in the column ``found``.
    """
    ids, grid = index.ids, index.grid
    spherical = grid.metric == "haversine"
    points = index.points
    extra: list[str] = []
    if reach is not None:
        extra = [c for c in reach.columns if c not in ids]
        points = points.join(reach, ids)
    fields = ["latitude", "longitude", *ids, *extra, *(["rlat", "rlng", "clat"] if spherical else [])]
    columns = left.columns
    rows = _positioned(left)
    lat, lng = F.col("latitude"), F.col("longitude")
    if grid.depth:
        rows = rows.select("*", *grid.places(lat, lng), *([F.col(wanted).alias("__k")] if wanted else []))
        rows = rows if stored else store(rows)
        total = rows.count()
    else:
        total = 0
    rows = _candidate_lists(rows, total, index, points, fields, other_than_self)
    if wanted:
        found = F.array_sort(_found(spherical, ids, extra, other_than_self, accepts))
        return _with_own_radians(rows, spherical).select(
            *columns, F.slice(found, F.lit(1), F.col(wanted).cast("int")).alias("found")).where(F.size("found") > 0)
    names = names or [distance, *[prefix + i for i in [*ids, *extra]], prefix + "right_latitude", prefix + "right_longitude"]
    best = _minimum(rows, columns, spherical, names, ids, extra, other_than_self, accepts)
    return best.drop(*[prefix + e for e in extra])


def _with_own_radians(rows: DataFrame, spherical: bool) -> DataFrame:
    if not spherical:
        return rows
    rlat = F.radians("latitude")
    return rows.withColumns({"__rlat": rlat, "__rlng": F.radians("longitude"), "__clat": F.cos(rlat)})


def _found(spherical: bool, ids: list[str], extra: list[str], other_than_self: bool,
           accepts: Callable[[Column, Column], Column] | None = None) -> Column:
    """The row's candidates with their distances."""
    def measured(c: Column) -> Column:
        keep = [c[name].alias(name) for name in [*ids, *extra, "latitude", "longitude"]]
        return F.struct(_measure(spherical, c).alias("distance"), *keep)

    candidates = F.col("__candidates")
    if other_than_self:
        candidates = F.filter(candidates, lambda c: (c["latitude"] != F.col("latitude")) | (
            c["longitude"] != F.col("longitude")))
    found = F.transform(candidates, measured)
    return found if accepts is None else F.filter(found, lambda c: accepts(c, c["distance"]))


def _minimum(rows: DataFrame, columns: list[str], spherical: bool, names: list[str], ids: list[str], extra: list[str],
             other_than_self: bool, accepts: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    found = _found(spherical, ids, extra, other_than_self, accepts)
    # a generator is evaluated once; a filter on the minimum would be pushed down and
    # make the whole list be measured again
    best = F.inline(F.array_compact(F.array(F.array_min(found))))
    return _with_own_radians(rows, spherical).select(*columns, best.alias(*names))


def _measure(spherical: bool, c) -> Column:
    """Distance of a row (__rlat, __rlng, __clat or latitude, longitude) to a candidate."""
    if spherical:
        return geo.haversine_radians(F.col("__rlat"), F.col("__rlng"), c["rlat"], c["rlng"], F.col("__clat"), c["clat"])
    return geo.planar(F.col("latitude"), F.col("longitude"), c["latitude"], c["longitude"])


def _few(left: DataFrame, rows: int, left_bounds: Bounds, right: DataFrame, ids: list[str], metric: str, names: list[str],
         other_than_self: bool, index: PointIndex | None = None) -> DataFrame:
    """The nearest point of each of a few stored left rows: scans of the right side, of which
    only counts of cells, and what lies within the bounds, are moved."""
    spherical = metric == "haversine"
    if index is None:
        right = _positioned(right).select("latitude", "longitude", *ids)
        right_bounds = _bounds(right, metric)
        right_rows = right_bounds[0]
        if right_rows <= ROOT_POINTS:
            few_points = PointIndex(_with_radians(right), ids, right_rows, Grid(metric, [], 1.0, 0))
            return search(left, few_points, names=names, other_than_self=other_than_self).drop("__row")
        grid = _grid(metric, [left_bounds, right_bounds]) if right_rows and left_bounds[0] else Grid(
            metric, [0.0] * (3 if spherical else 2), 1.0, 1)
        rights = right.select("*", *grid.places(F.col("latitude"), F.col("longitude")))
        if spherical:
            rights = _with_radians(rights)
    else:
        right_rows, grid, rights = index.rows, index.grid, right
    columns = [c for c in left.columns if c != "__row"]
    placed = _positioned(left).select("*", *grid.places(F.col("latitude"), F.col("longitude")))
    descent = Descent(grid, placed, rights, rows, right_rows, other_than_self)
    # the grid on which all cells of the right side, on its surface, meet all left rows
    level = max(1, min(grid.depth, int(math.log(max(4, FEW_PAIRS // max(1, rows)), 4))))
    front, front_rows, parent = None, 0, 0
    while True:
        front = descent.step(front, front_rows, parent, level)
        front_rows, fullest, held = front.agg(F.count("*"), F.max("points"), F.sum("points")).first()
        if not front_rows or held <= SCANNED or fullest <= LEAF or level == grid.depth:
            break
        parent, level = level, min(level + STEP, grid.depth)
    placed = _with_own_radians(placed, spherical)
    own = [F.col(c) for c in ["__row", "latitude", "longitude", *(["__rlat", "__rlng", "__clat"] if spherical else [])]]
    asked = placed.select(*own, *grid.up("__a", level)).join(front, grid.names("__a")).drop(*grid.names("__a"))
    asked = broadcast_if(asked, max(front_rows, rows))
    keep = ["latitude", "longitude", *ids, *(["rlat", "rlng", "clat"] if spherical else [])]
    candidate = F.struct(*keep).alias("__c")
    met = rights.select(candidate, *grid.up("__c", level)).join(asked, grid.names("__c"))
    if other_than_self:
        met = met.where((F.col("__c.latitude") != F.col("latitude")) | (F.col("__c.longitude") != F.col("longitude")))
    hit = F.struct(_measure(spherical, F.col("__c")).alias("d"), *[F.col(f"__c.{i}") for i in ids],
                   F.col("__c.latitude"), F.col("__c.longitude"))
    best = met.groupBy("__row").agg(F.min(hit).alias("__best"))
    found = broadcast_if(best, rows).join(left, "__row")
    return found.select(*columns, *[F.col(f"__best.{f}").alias(n) for f, n in zip(
        ["d", *ids, "latitude", "longitude"], names)])


def _around(left: DataFrame, total: int, index: PointIndex, names: list[str], other_than_self: bool) -> DataFrame:
    """The nearest point of the left rows that have it in the cells around their own: one join
    of cells as narrow as right points are dense on average. Rows whose neighbours are farther,
    or very many, are left out."""
    grid, ids, points = index.grid, index.ids, index.points
    spherical = grid.metric == "haversine"
    # some four points a cell; cells grow by four a level beyond the levels that are counted
    level = next((at + 1 for at, cells in enumerate(index.filled) if cells >= index.rows / 4), None)
    level = level or min(grid.depth, len(index.filled) + math.ceil(
        math.log(index.rows / max(1, index.filled[-1]) / 4, 4)))
    own, cell = grid.names("__a"), grid.names("__c")
    # dimensions are few: nine cells on a plane, 27 in space, most of these empty
    around = F.explode(F.expr("array(" + ", ".join(
        "struct(" + ", ".join(f"__a{i} + {offset // 3 ** i % 3 - 1} AS __c{i}" for i in range(grid.axes)) + ")"
        for offset in range(3 ** grid.axes)) + ")"))
    asked = left.select(*grid.up("__a", level)).distinct().select("*", around.alias("o")).select(*own, "o.*")
    counts = points.groupBy(*grid.up("__c", level)).agg(F.count("*").alias("n"))
    # asked is 27 times what its shuffle held, by whose size it would be broadcast
    met = store(asked.join(counts.hint("merge"), cell))
    light = met.groupBy(*own).agg(F.sum("n").alias("n")).where(F.col("n") <= NEIGHBOURS)
    fields = ["latitude", "longitude", *ids, *(["rlat", "rlng", "clat"] if spherical else [])]
    held, cells = light.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    pairs = met.drop("n").join(broadcast_if(light.drop("n"), cells), own, "left_semi")
    # a pair of cells has a point at least
    lists = broadcast_or_merge(pairs, held).join(points.select(*fields, *grid.up("__c", level)), cell).groupBy(*own).agg(
        F.collect_list(F.struct(*fields)).alias("__candidates"))
    rows = spread(left, total).select("*", *grid.up("__a", level))
    if held <= CANDIDATES:
        rows = rows.join(lists.hint("broadcast"), own)
    else:
        sizes = left.groupBy(*grid.up("__a", level)).agg(F.count("*").alias("rows"))
        rows = join_unique(rows, lists, own, sizes, total)
    # what is nearer than a cell is wide lies in the cells around
    width = grid.side / 2.0 ** level * (1 - 1e-6)
    straight = 2 * geo.EARTH_RADIUS_M * math.asin(min(1.0, width / 2)) if spherical else width
    found = _minimum(rows, left.columns, spherical, names, ids, [], other_than_self)
    return found.where(F.col(names[0]) < straight)


def nearest(left: DataFrame, right: DataFrame, ids: list[str], *, metric: str = "haversine",
            distance: str = "distance", prefix: str = "", other_than_self: bool = False,
            stored: bool = False) -> DataFrame:
    """Join every left row to its nearest right point (``ids`` break ties, lowest first).

    Few left rows go to the right side, which is then read and not written; it has to give the
    same rows each time. ``stored`` says that ``right`` is, and holds no copies.
    """
    names = [distance, *[prefix + i for i in ids], prefix + "right_latitude", prefix + "right_longitude"]
    kept = store(left.withColumn("__row", F.monotonically_increasing_id()))
    bounds = _bounds(_positioned(kept), metric)
    if bounds[0] <= FEW_ROWS:
        return _few(kept, bounds[0], bounds, right, ids, metric, names, other_than_self)
    index = build_index(right, ids, searched_by=[kept], metric=metric, merge_copies=not stored, stored=stored)
    return _by_index(kept, bounds, index, names, other_than_self)


def _by_index(kept: DataFrame, bounds: Bounds, index: PointIndex, names: list[str], other_than_self: bool) -> DataFrame:
    """The nearest indexed point of stored rows with a __row: around them first, then by bounds."""
    columns = [c for c in kept.columns if c != "__row"]
    if not index.grid.depth:
        return search(kept, index, names=names, other_than_self=other_than_self).drop("__row")
    if bounds[0] <= FEW_ROWS:
        return _few(kept, bounds[0], bounds, index.points, index.ids, index.grid.metric, names, other_than_self, index)
    placed = _positioned(kept).select("*", *index.grid.places(F.col("latitude"), F.col("longitude")))
    near = store(_around(placed, bounds[0], index, names, other_than_self).select("__row", *columns, *names))
    rest = store(kept.join(broadcast_or_merge(near.select("__row"), bounds[0]), "__row", "left_anti"))
    rest_rows = rest.count()
    if not rest_rows:
        return near.drop("__row")
    if rest_rows <= FEW_ROWS:
        others = _few(rest, rest_rows, bounds, index.points, index.ids, index.grid.metric, names, other_than_self, index)
    else:
        others = search(rest.drop("__row"), index, names=names, other_than_self=other_than_self)
    return near.drop("__row").unionByName(others)


class Finder:
    """The nearest points of one right side for one left side after another.

    The right side is stored and indexed once; the index is made anew only when a left side
    lies outside of what it covers.
    """

    def __init__(self, right: DataFrame, ids: list[str], metric: str = "haversine") -> None:
        self.ids, self.metric, self.right = ids, metric, right
        self.index: PointIndex | None = None
        self.stored = False

    def nearest(self, left: DataFrame, distance: str = "distance") -> DataFrame:
        names = [distance, *self.ids, "right_latitude", "right_longitude"]
        kept = store(left.withColumn("__row", F.monotonically_increasing_id()))
        bounds = _bounds(_positioned(kept), self.metric)
        if self.index is None or not self.index.covers(bounds):
            self.index = build_index(self.right, self.ids, searched_by=[kept], metric=self.metric,
                                     merge_copies=not self.stored, stored=self.stored, within=self.index)
            self.right, self.stored = self.index.points.select("latitude", "longitude", *self.ids), True
        return _by_index(kept, bounds, self.index, names, False)


def nearest_other(points: DataFrame, metric: str = "planar") -> DataFrame:
    """Distance from each point to the nearest other point; zero when it has a copy."""
    columns = points.columns
    places = store(_positioned(points.groupBy("latitude", "longitude").agg(F.count("*").alias("copies"))))
    alone = places.where("copies = 1").select("latitude", "longitude")
    # every place is its own id: only the distance is asked for
    right = places.select("latitude", "longitude", F.xxhash64("latitude", "longitude").alias("place"))
    found = nearest(alone, right, ["place"], metric=metric, other_than_self=True, stored=True)
    known = found.select("latitude", "longitude", "distance").unionByName(
        places.where("copies > 1").select("latitude", "longitude", F.lit(0.0).alias("distance")))
    return points.join(known, ["latitude", "longitude"]).select(*columns, "distance")
