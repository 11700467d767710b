"""Spatial and spatio-temporal joins on planar coordinates (metres)."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkit.functions.geo import grid_index, usable_point
from tripkit.functions.temporal import hours_between, micros
from tripkit.session import saved


@dataclass(frozen=True)
class TimeWindow:
    """Only places whose time is within ``seconds`` of the point's time count."""

    point_time: str
    place_time: str
    seconds: float

    @property
    def span(self) -> int:
        return int(round(self.seconds * 1_000_000))


_CELL_REACHES = 2  # side of a cell in reaches: a place is listed in (1 + 2 / this) cells per dimension, on average


def _touched(low: Column, high: Column, index) -> Column:
    """A row per cell from that of ``low`` to that of ``high``."""
    return F.explode(F.sequence(index(low), index(high)))


def within_distance(
    points: DataFrame,
    places: DataFrame,
    radius: float,
    *,
    point: tuple[str, str],
    place: tuple[str, str],
    how: str = "left",
    time: TimeWindow | None = None,
    salts: int = 1,
) -> DataFrame:
    """All places within ``radius`` of each point, and inside the time window if given.

    Space is cut into squares of twice the ``radius`` (and time into slices of twice the
    window): a place is listed in the cells that its reach touches, so each point meets it at
    most once, through an equi-join on its own cell. The exact test is part of the join
    condition, so ``how="left"`` keeps every unmatched point. ``salts`` splits each cell's
    points into that many keys when one cell is known to be very hot; Spark's own skew
    handling covers the usual cases. Spark takes the listed places for as few as the places, so they are
    merged, never broadcast: the driver would have to hold all of them.
    """
    (px, py), (qx, qy) = point, place
    cell = lambda value: grid_index(value, _CELL_REACHES * radius)
    left_keys = [
        F.when(usable_point(F.col(px), F.col(py)), cell(F.col(c))).alias(k) for c, k in ((px, "_cx"), (py, "_cy"))
    ]
    right = places.where(usable_point(F.col(qx), F.col(qy)))
    for c, k in ((qx, "_gx"), (qy, "_gy")):
        # A little more than the radius, for what rounding may take away.
        reach = F.lit(radius * (1 + 1e-9)) + F.least(F.abs(F.col(c)) * F.lit(1e-14), F.lit(float(radius)))
        right = right.withColumn(k, _touched(F.col(c) - reach, F.col(c) + reach, cell))
    pairs = [("_cx", "_gx"), ("_cy", "_gy")]
    dx, dy = F.col(px) - F.col(qx), F.col(py) - F.col(qy)
    tests = [dx * dx + dy * dy <= F.lit(float(radius) ** 2)]
    if time is not None:
        slice_us, at = F.lit(_CELL_REACHES * max(time.span, 1)), micros(F.col(time.place_time))
        piece = lambda value: F.floor(value / slice_us)
        left_keys.append(piece(micros(F.col(time.point_time))).alias("_ct"))
        right = right.withColumn("_gt", _touched(at - F.lit(time.span), at + F.lit(time.span), piece))
        pairs.append(("_ct", "_gt"))
        gap = F.timestamp_diff("MICROSECOND", F.col(time.place_time), F.col(time.point_time))
        tests.append(F.abs(gap) <= F.lit(time.span))
    if salts > 1:
        # A hash of the row, so that a task that is run again salts its rows in the same way.
        left_keys.append(F.pmod(F.xxhash64("*"), F.lit(salts)).alias("_cs"))
        right = right.withColumn("_gs", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        pairs.append(("_cs", "_gs"))
    left = points.select("*", *left_keys)
    condition = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in pairs] + tests)
    return left.join(right.hint("merge"), condition, how).drop(*[name for pair in pairs for name in pair])


def _without_place(points: DataFrame, places: DataFrame, radius: float, *, point: tuple[str, str], place: tuple[str, str]) -> DataFrame:
    """Points that have no place within ``radius``: their nearest one, by the same arithmetic, is farther or there is none.

    A point meets a few places only, however many are near it.
    """
    (px, py), (qx, qy) = point, place
    found = nearest_place(points, places, point=point, place=place, place_id=qx, carry={qx: "_nx", qy: "_ny"}, distance="_nd")
    dx, dy = F.col(px) - F.col("_nx"), F.col(py) - F.col("_ny")
    near = dx * dx + dy * dy <= F.lit(float(radius) ** 2)
    return found.where(~F.coalesce(near, F.lit(False))).drop("_nx", "_ny", "_nd")


def spacetime_join(
    points: DataFrame,
    places: DataFrame,
    radius: float,
    time: TimeWindow,
    *,
    point: tuple[str, str],
    place: tuple[str, str],
    semantics: str = "left",
) -> DataFrame:
    """Places near in space and in time.

    ``left`` keeps points without a match, ``inner`` drops them. ``filter_after`` gives what a join on
    distance alone, keeping points without a near place, gives after pairs too far apart in
    time are removed: a point whose near places all fail the time test disappears, near places
    without a time stay. Pairs that are near in space only are never built for it.
    """
    if semantics in ("left", "inner"):
        return within_distance(points, places, radius, point=point, place=place, how=semantics, time=time)
    if semantics != "filter_after":
        raise ValueError(f"unknown semantics {semantics!r}")
    near = {"point": point, "place": place}
    timed = within_distance(points, places, radius, how="inner", time=time, **near)
    untimed = within_distance(points, places.where(F.col(time.place_time).isNull()), radius, how="inner", **near)
    alone = _without_place(points, places, radius, **near)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in places.schema]
    return timed.union(untimed).union(alone.select("*", *nulls))


# The pyramid search below halves the square around all places ``_DEEPEST`` times: level k has 4**k cells.
_DEEPEST = 24
_ROOT_NODES = 16  # largest number of nodes per time slice the first round may start from
_FEW_PLACES = 64  # places that each point may simply be compared with
_LEAF_PLACES = 16  # places that share the last-level cell of a place, on average
_SLICES = 2  # time slices per half window: a unit sees three of them whole and two in part


@dataclass(frozen=True)
class _Pyramid:
    """Square around all places (corner and side), their number, and the levels to search, coarse to fine."""

    x: float
    y: float
    side: float
    count: int
    levels: tuple[int, ...]

    def cell(self, x: Column, y: Column, level: int | None = None) -> list[Column]:
        """Cell of a position; positions beyond the square share the cells around it."""
        out = []
        for value, corner in ((x, self.x), (y, self.y)):
            scaled = (value - F.lit(corner)) / F.lit(self.side) * F.lit(float(2**_DEEPEST))
            bounded = F.greatest(F.least(scaled, F.lit(float(2 ** (_DEEPEST + 1)))), F.lit(-float(2 ** (_DEEPEST + 1))))
            whole = F.floor(bounded).cast("bigint")
            out.append(whole if level is None else F.shiftright(whole, _DEEPEST - level))
        return out


def _pyramid(located: DataFrame) -> _Pyramid | None:
    """None without places. Levels follow from the extent and the density of the places, whatever their unit of length.

    The first level is the finest with few nodes per slice, the last one the coarsest at which a place shares its node with few
    others on average, so that clusters deepen it as far as they need. One row of extremes and one row per level come back.
    """
    x1, x2, y1, y2, count = located.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y"), F.count(F.lit(1))).first()
    if not count:
        return None
    side = max(x2 - x1, y2 - y1) or 1.0
    flat = _Pyramid(x1, y1, side * (1 + 1e-9), count, ())
    if count <= _FEW_PLACES:
        return flat
    candidates = list(range(0, _DEEPEST + 1, 2))
    level = F.explode(F.array(*[F.lit(k) for k in candidates])).alias("_k")
    cells = located.select("_s", *(c.alias(n) for c, n in zip(flat.cell(F.col("_x"), F.col("_y")), ("_ix", "_iy"))))
    shifted = cells.select("_s", "_ix", "_iy", level).select(
        "_k", "_s", *(F.expr(f"shiftright({c}, {_DEEPEST} - _k)").alias(c) for c in ("_ix", "_iy"))
    )
    nodes = shifted.groupBy("_k", "_s", "_ix", "_iy").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    slices = nodes.groupBy("_k", "_s").agg(F.count(F.lit(1)).alias("_nodes"), F.sum(F.col("_n") * F.col("_n")).alias("_pairs"))
    rows = sorted(slices.groupBy("_k").agg(F.max("_nodes"), F.sum("_pairs") / F.lit(float(count))).collect())  # a row per level
    root = max(k for k, most, _ in rows if most <= _ROOT_NODES or k == 0)
    leaf = next((k for k, _, shared in rows if shared <= _LEAF_PLACES), _DEEPEST)
    shared = {k: mean for k, _, mean in rows}
    if leaf > root and leaf >= 2 and math.sqrt(shared[leaf] * shared[leaf - 2]) <= _LEAF_PLACES:
        leaf -= 1  # between two counted levels
    leaf = max(leaf, root)
    step = 1 if leaf - root <= 3 else 2
    return replace(flat, levels=(*range(root, leaf, step), leaf))


def _gap(low1: Column, high1: Column, low2: Column, high2: Column) -> Column:
    """Distance between two intervals; zero where they meet."""
    return F.greatest(low1 - high2, low2 - high1, F.lit(0.0))


def _reach(low: Column, high: Column, value: Column) -> Column:
    """Distance from a value to the farther end of an interval."""
    return F.greatest(F.abs(value - low), F.abs(high - value))


def _nodes(located: DataFrame, pyramid: _Pyramid, level: int) -> DataFrame:
    """Bounding box and two sample places (earliest, latest) of each node of a level."""
    place = F.struct("_t", "_x", "_y")
    nx, ny = pyramid.cell(F.col("_x"), F.col("_y"), level)
    return located.groupBy(F.col("_s").alias("_ps"), nx.alias("_nx"), ny.alias("_ny")).agg(
        F.min("_x").alias("_x1"), F.max("_x").alias("_x2"), F.min("_y").alias("_y1"), F.max("_y").alias("_y2"),
        F.min(place).alias("_first"), F.max(place).alias("_last"),
    )


def _search(located: DataFrame, unit: DataFrame, names: list[str], pyramid: _Pyramid, time: TimeWindow | None, slice_us: Column) -> DataFrame:
    """Last-level nodes that may hold the nearest place of some point of a unit, with the unit's box, times and bound.

    The window of a unit splits into slices wholly inside, whose places all count, and slices at its edges. A sample place that is
    inside the window of every point of the unit bounds the distance; nodes of any slice beyond the bound go.
    """
    span = F.lit(time.span if time else 0)
    box = [F.min("_qx").alias("_bx1"), F.max("_qx").alias("_bx2"), F.min("_qy").alias("_by1"), F.max("_qy").alias("_by2")]
    times = [F.min("_qt").alias("_t1"), F.max("_qt").alias("_t2")]
    carried = [*names, "_t1", "_t2", "_bx1", "_bx2", "_by1", "_by2"]
    frontier = unit.groupBy(*names).agg(*times, *box)
    low, high = F.floor((F.col("_t1") - span) / slice_us), F.floor((F.col("_t2") + span) / slice_us)
    frontier = frontier.select(*carried, F.explode(F.sequence(low, high)).alias("_s"))

    def sample(name: str) -> Column:
        place = F.col(name)
        far_x = _reach(F.col("_bx1"), F.col("_bx2"), place["_x"])
        far_y = _reach(F.col("_by1"), F.col("_by2"), place["_y"])
        return F.when(place["_t"].between(F.col("_t2") - span, F.col("_t1") + span), far_x * far_x + far_y * far_y)

    some = (F.col("_last")["_t"] >= F.col("_t1") - span) & (F.col("_first")["_t"] <= F.col("_t2") + span)
    gap_x = _gap(F.col("_bx1"), F.col("_bx2"), F.col("_x1"), F.col("_x2"))
    gap_y = _gap(F.col("_by1"), F.col("_by2"), F.col("_y1"), F.col("_y2"))
    above = None
    for level in pyramid.levels:
        match = (F.col("_s") == F.col("_ps")) & some
        if above is not None:
            match &= F.col("_fx") == F.shiftright("_nx", level - above)
            match &= F.col("_fy") == F.shiftright("_ny", level - above)
        scored = frontier.join(_nodes(located, pyramid, level), match).select(
            *carried, "_s", F.col("_nx").alias("_fx"), F.col("_ny").alias("_fy"),
            (gap_x * gap_x + gap_y * gap_y).alias("_near"), F.least(sample("_first"), sample("_last")).alias("_sample"),
        )
        best = F.coalesce(F.min("_sample").over(Window.partitionBy(*names)), F.lit(float("inf"))).alias("_best")
        frontier = scored.select(*carried, "_s", "_fx", "_fy", "_near", best).where(F.col("_near") <= F.col("_best"))
        above = level
    return frontier


def _candidates(located: DataFrame, positions: DataFrame, pyramid: _Pyramid, time: TimeWindow | None, slice_us: Column) -> DataFrame:
    """Pairs of a position and a place that may be its nearest.

    A unit is all positions of one last-level cell and one time slice.
    """
    span, leaf = F.lit(time.span if time else 0), pyramid.levels[-1]
    names = ["_u1", "_u2", "_u3"]
    keys = [*pyramid.cell(F.col("_qx"), F.col("_qy"), leaf), F.floor(F.col("_qt") / slice_us)]
    # The unit is part of the distinct rows, so both uses below share one shuffle.
    unit = positions.select("*", *[key.alias(name) for key, name in zip(keys, names)]).distinct()
    frontier = _search(located, unit, names, pyramid, time, slice_us)
    nx, ny = pyramid.cell(F.col("_x"), F.col("_y"), leaf)
    leaves = located.withColumnRenamed("_s", "_ps").withColumns({"_nx": nx, "_ny": ny})
    place_x = _gap(F.col("_bx1"), F.col("_bx2"), F.col("_x"), F.col("_x"))
    place_y = _gap(F.col("_by1"), F.col("_by2"), F.col("_y"), F.col("_y"))
    match = (F.col("_s") == F.col("_ps")) & (F.col("_fx") == F.col("_nx")) & (F.col("_fy") == F.col("_ny"))
    match &= F.col("_t").between(F.col("_t1") - span, F.col("_t2") + span)
    match &= place_x * place_x + place_y * place_y <= F.col("_best")
    near = frontier.join(leaves, match).select(*[F.col(n).alias(f"_n{n}") for n in names], "_x", "_y", "_t", "_p")
    same = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"_n{n}") for n in names])
    return unit.join(near, same & (F.abs(F.col("_qt") - F.col("_t")) <= span))


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    *,
    point: tuple[str, str],
    place: tuple[str, str],
    place_id: str,
    carry: dict[str, str],
    distance: str,
    time: TimeWindow | None = None,
) -> DataFrame:
    """The exactly nearest place of every point; equal distances go to the smallest id.

    ``carry`` maps place columns to their name in the result. Points without usable
    coordinates, or without any place inside the time window, get nulls.

    A search over a pyramid of grids, written as a few joins. Each node of the pyramid knows
    the bounding box of its places and a sample of them. Points are searched in units: all
    points of one last-level cell together. From the coarsest level down, each unit keeps only
    nodes whose box can be nearer than the farthest its best sample can be, so a handful of
    nodes per unit survive; their places are then compared with each point of the unit. Work
    per point does not grow with the number of places. The grid spans the places, so the unit of
    length does not matter, and clusters get a deeper pyramid. Points at the same position, and
    places at the same position, are searched once.

    With a time window, places and points are also split into time slices of half of a half
    window, and a unit is a cell and a slice: it sees three slices whole and two in part.

    Places are written once to the shared folder and measured there while the plan is built.
    """
    (px, py), (qx, qy) = point, place
    rest = [name for name in carry if name != place_id]
    payload = F.struct(F.col(place_id).alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(rest)])
    outputs = {carry[c]: (places.schema[c].dataType, f"_c{i}") for i, c in enumerate(rest)}
    if place_id in carry:
        outputs[carry[place_id]] = (places.schema[place_id].dataType, "_id")
    span = time.span if time else 0
    slice_us = F.lit(max(span // _SLICES, 1))
    place_time = micros(F.col(time.place_time)) if time else F.lit(0).cast("bigint")
    located = (
        places.where(usable_point(F.col(qx), F.col(qy)) & place_time.isNotNull())
        .groupBy(F.col(qx).cast("double").alias("_x"), F.col(qy).cast("double").alias("_y"), place_time.alias("_t"))
        .agg(F.min(payload).alias("_p"))
        .select(
            "_x", "_y", "_t", "_p", F.floor(F.col("_t") / slice_us).alias("_s")
        )
    )
    located = saved(points.sparkSession, located, "places")
    pyramid = _pyramid(located)
    if pyramid is None:
        nulls = {name: F.lit(None).cast(kind) for name, (kind, _) in outputs.items()}
        return points.withColumns({distance: F.lit(None).cast("double"), **nulls})

    query = ["_qx", "_qy", "_qt"]
    present = usable_point(F.col(px), F.col(py))
    point_time = micros(F.col(time.point_time)) if time else F.lit(0).cast("bigint")
    keyed = points.select(
        "*",
        F.when(present, F.col(px).cast("double")).alias("_qx"), F.when(present, F.col(py).cast("double")).alias("_qy"),
        point_time.alias("_qt"),
    )
    positions = keyed.select(*query).where(F.col("_qx").isNotNull() & F.col("_qt").isNotNull())
    if not pyramid.levels:
        # At most _FEW_PLACES places, as counted: each position meets all of them.
        pairs = positions.distinct().join(F.broadcast(located), F.abs(F.col("_qt") - F.col("_t")) <= F.lit(span))
    else:
        pairs = _candidates(located, positions, pyramid, time, slice_us)
    dx, dy = F.col("_qx") - F.col("_x"), F.col("_qy") - F.col("_y")
    hit = F.min(F.struct((dx * dx + dy * dy).alias("_d2"), "_p")).alias("_hit")
    found = pairs.groupBy(*query).agg(hit).withColumnsRenamed({n: f"_k{n}" for n in query})
    same = reduce(lambda a, b: a & b, [F.col(name) == F.col(f"_k{name}") for name in query])
    return keyed.join(found, same, "left").select(
        *[F.col(f"`{name}`") for name in points.columns],
        F.sqrt(F.col("_hit")["_d2"]).alias(distance),
        *[F.col("_hit")["_p"][source].alias(name) for name, (_, source) in outputs.items()],
    )


def closest_event(
    points: DataFrame,
    events: DataFrame,
    time: TimeWindow,
    *,
    point: tuple[str, str],
    place: tuple[str, str],
    event_id: str,
) -> DataFrame:
    """The spatially closest event inside a time window: its id, distance and signed hours."""
    found = nearest_place(
        points, events,
        point=point, place=place, place_id=event_id,
        carry={event_id: "closest_event_id", time.place_time: "_event_time"},
        distance="closest_event_distance", time=time,
    )
    hours = hours_between(F.col(time.point_time), F.col("_event_time"))
    return found.withColumn("closest_event_time_diff", hours).drop("_event_time")
