"""Points near other points, near lines, and inside areas.

Everything is hashed to square grid cells sized by the radius. A pair of points
meets in a neighbouring cell; a line enters every cell its buffer touches; an area
enters the cells its boundary touches, and the cells of its interior by the parity
of a reference point. The exact test on integers follows in the cell. Distances are
planar in coordinate units; :func:`near_points` can use the great circle instead.

Distinct positions are joined, not rows, so repeated rows and many objects at one
place cost nothing extra before the result is expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Side of a cell for lines and areas, in radii.
COARSE = 16
#: Up to this length of a side, products of two coordinate differences are exact in a double and a bigint.
_EXACT = 1 << 25


def _cell(c: Column, side: int) -> Column:
    return F.floor(c / F.lit(side)).cast("bigint")


def positions(points: DataFrame, id_: str, geom: str) -> DataFrame:
    """Distinct ``id, x, y`` with a whole position and an id; other columns are not read."""
    return points.select(F.col(id_).alias("id"), F.col(f"{geom}.x").alias("x"), F.col(f"{geom}.y").alias("y")).dropna().distinct()


def near_points(pos: DataFrame, radius: int, geodesic: bool = False) -> DataFrame:
    """Pairs ``id, other_id`` (smaller first) of different ids at most ``radius`` apart.

    pos: distinct ``id, x, y``. With ``geodesic`` coordinates are 1e-7 degrees, the
    radius is metres and the distance the great circle's (haversine); the cells then
    follow latitude bands. An id at several places counts at each.
    """
    sites = pos.select("x", "y").distinct()
    if geodesic:
        lat_side = int(radius / 111_000.0 * 1e7) + 1  # a little more than the radius
        band = _cell(F.col("y"), lat_side)
        # Width of a cell in the widest row among a band and its neighbours.
        worst = F.least(F.lit(89.9), (F.abs(band) + 2) * F.lit(lat_side / 1e7))
        n_cols = F.greatest(F.lit(1), F.floor(F.lit(360e7 / lat_side) * F.cos(F.radians(worst)))).cast("bigint")
        cells = sites.withColumn("cy", band)
        n_of = lambda b: F.greatest(F.lit(1), F.floor(F.lit(360e7 / lat_side) * F.cos(F.radians(F.least(F.lit(89.9), (F.abs(b) + 2) * F.lit(lat_side / 1e7)))))).cast("bigint")
        col_of = lambda b: F.floor((F.col("x") + F.lit(1800000000)) / F.lit(3600000000.0) * n_of(b)).cast("bigint")
        a = cells.withColumn("cx", F.pmod(F.floor((F.col("x") + F.lit(1800000000)) / F.lit(3600000000.0) * n_cols).cast("bigint"), n_cols))
        b = (
            cells.withColumn("cy", F.explode(F.array(*[band + d for d in (-1, 0, 1)])))
            .withColumn("cx", F.explode(F.array_distinct(F.array(*[F.pmod(col_of(F.col("cy")) + d, n_of(F.col("cy"))) for d in (-1, 0, 1)]))))
        )
        b = b.select("cx", "cy", F.col("x").alias("x2"), F.col("y").alias("y2"))
        p1, p2 = F.radians(F.col("y") / 1e7), F.radians(F.col("y2") / 1e7)
        h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians((F.col("x2") - F.col("x")) / 1e7) / 2), 2)
        close = F.lit(2 * 6371008.8) * F.asin(F.least(F.lit(1.0), F.sqrt(h))) <= radius
        later = (F.col("x2") > F.col("x")) | ((F.col("x2") == F.col("x")) & (F.col("y2") > F.col("y")))
        pairs = a.join(b, ["cx", "cy"]).where(later & close)
    else:
        a = sites.select(_cell(F.col("x"), radius).alias("cx"), _cell(F.col("y"), radius).alias("cy"), "x", "y")
        # Half of the neighbourhood: each pair of cells meets once.
        around = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j")) for i, j in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
        b = a.withColumn("d", F.explode(around)).select(
            (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy"),
            F.col("x").alias("x2"), F.col("y").alias("y2"), ((F.col("d.i") == 0) & (F.col("d.j") == 0)).alias("same"))
        dx, dy = F.col("x2") - F.col("x"), F.col("y2") - F.col("y")
        later = (F.col("x2") > F.col("x")) | ((F.col("x2") == F.col("x")) & (F.col("y2") > F.col("y")))
        pairs = a.join(b, ["cx", "cy"]).where((dx * dx + dy * dy <= radius * radius) & (~F.col("same") | later))
    near = pairs.select("x", "y", "x2", "y2")
    ids = pos.select("id", "x", "y")
    others = pos.select(F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    apart = near.join(ids, ["x", "y"]).join(others, ["x2", "y2"]).select("id", "id2")
    at_one = ids.join(pos.select(F.col("id").alias("id2"), "x", "y"), ["x", "y"]).where("id < id2").select("id", "id2")
    return apart.unionByName(at_one).where("id <> id2").select(F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("other_id")).distinct()


def segments(lines: DataFrame, id_: str, geom: str) -> DataFrame:
    """Distinct segments ``id, x1, y1, x2, y2``; a line of one point is a segment of length 0.

    Null lines and null vertices are left out.
    """
    g = F.filter(F.col(geom), lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull())
    rows = lines.select(F.col(id_).alias("id"), g.alias("g")).where("id is not null and size(g) > 0").distinct()
    pairs = F.zip_with(F.slice("g", F.lit(1), F.greatest(F.lit(1), F.size("g") - 1)), F.when(F.size("g") > 1, F.slice("g", F.lit(2), F.size("g") - 1)).otherwise(F.col("g")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    s = rows.select("id", F.explode(pairs).alias("s"))
    return s.select("id", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2")).distinct()


def segment_cells(seg: DataFrame, side: int, reach: int) -> DataFrame:
    """Adds ``cx, cy`` for every cell that comes within ``reach`` of the segment (a few more at its sides)."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    s = seg.withColumn("cx", F.explode(F.sequence(_cell(lo - reach, side), _cell(hi + reach, side))))
    xa = F.greatest(lo, F.col("cx") * side - reach).cast("double")
    xb = F.least(hi, (F.col("cx") + 1) * side + reach).cast("double")
    at = lambda x: F.when(F.col("x1") == F.col("x2"), F.col("y1").cast("double")).otherwise(
        F.col("y1") + (x - F.col("x1")) * ((F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0))))
    flat = F.col("x1") == F.col("x2")
    ya = F.when(flat, F.least("y1", "y2")).otherwise(F.least(at(xa), at(xb)))
    yb = F.when(flat, F.greatest("y1", "y2")).otherwise(F.greatest(at(xa), at(xb)))
    return s.withColumn("cy", F.explode(F.sequence(_cell(ya - (reach + 1), side), _cell(yb + (reach + 1), side))))


def _cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Sign-exact ``ax*by - ay*bx``: doubles where every step is exact, else 38-digit decimals."""
    big = F.greatest(F.abs(ax), F.abs(ay), F.abs(bx), F.abs(by)) > _EXACT
    d = lambda c: c.cast("decimal(19,0)")
    return F.when(big, (d(ax) * d(by) - d(ay) * d(bx)).cast("double")).otherwise((ax * by - ay * bx).cast("double"))


def near_lines(pos: DataFrame, seg: DataFrame, radius: int, side: int | None = None) -> DataFrame:
    """Distinct ``id, other_id`` of a point and a line at most ``radius`` apart (planar, exact)."""
    side = side or COARSE * radius
    sites = pos.select("x", "y").distinct().select(_cell(F.col("x"), side).alias("cx"), _cell(F.col("y"), side).alias("cy"), "x", "y")
    s = segment_cells(seg.withColumnRenamed("id", "other_id"), side, radius)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    px, py = F.col("x") - F.col("x1"), F.col("y") - F.col("y1")
    qx, qy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    in_box = (
        (F.col("x") >= F.least("x1", "x2") - radius) & (F.col("x") <= F.greatest("x1", "x2") + radius)
        & (F.col("y") >= F.least("y1", "y2") - radius) & (F.col("y") <= F.greatest("y1", "y2") + radius)
    )
    hit = sites.join(s, ["cx", "cy"]).where(in_box)
    # After the box test both differences are at most a segment's length and a radius.
    r2 = radius * radius
    dec = lambda c: c.cast("decimal(19,0)")
    dot = px.cast("double") * dx + py.cast("double") * dy
    len2 = dx.cast("double") * dx + dy.cast("double") * dy
    cross = dec(px) * dec(dy) - dec(py) * dec(dx)
    cd = px.cast("double") * dy - py.cast("double") * dx
    lhs, rhs = cd * cd, F.lit(float(r2)) * len2
    on_side = (
        F.when(lhs < rhs * (1 - 1e-9) - 1e-3, F.lit(True)).when(lhs > rhs * (1 + 1e-9) + 1e-3, F.lit(False))
        .otherwise(cross.cast("decimal(19,0)") * cross.cast("decimal(19,0)") <= (dec(dx) * dec(dx) + dec(dy) * dec(dy)) * F.lit(r2).cast("decimal(19,0)"))
    )
    close = (
        F.when(px * px + py * py <= r2, F.lit(True)).when(qx * qx + qy * qy <= r2, F.lit(True))
        .when((dot <= 0) | (dot >= len2), F.lit(False)).otherwise(on_side)
    )
    near = hit.where(close).select("x", "y", "other_id").distinct()
    return near.join(pos, ["x", "y"]).select("id", "other_id").distinct()


def enclosing_areas(pos: DataFrame, lines: DataFrame, id_: str, geom: str, side: int) -> DataFrame:
    """Distinct ``id, other_id`` of a point and an area whose boundary encloses it strictly.

    An area's boundary is all lines of its rows in any order and direction, equal or
    reversed lines once; holes and islands follow from even-odd parity. A point on a
    boundary line is outside. Parity is found per cell: one reference point of each
    cell is classified by the boundary's crossings with the row of cells, and a point
    by the crossings of a path from the reference point inside its own cell. So no
    task ever needs an area's whole boundary. All tests are exact on integers.
    """
    g = F.filter(F.col(geom), lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull())
    once = (
        lines.select(F.col(id_).alias("other_id"), g.alias("g")).where("other_id is not null and size(g) > 1")
        .withColumn("r", F.reverse("g")).withColumn("g", F.when(F.col("r") < F.col("g"), F.col("r")).otherwise(F.col("g"))).select("other_id", "g").distinct()
    )
    pairs = F.zip_with(F.slice("g", F.lit(1), F.size("g") - 1), F.slice("g", F.lit(2), F.size("g") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    s = once.select("other_id", F.explode(pairs).alias("s"))
    # Each segment from left to right.
    flip = (F.col("s.b.x") < F.col("s.a.x")) | ((F.col("s.b.x") == F.col("s.a.x")) & (F.col("s.b.y") < F.col("s.a.y")))
    s = s.select("other_id", F.when(flip, F.col("s.b")).otherwise(F.col("s.a")).alias("a"), F.when(flip, F.col("s.a")).otherwise(F.col("s.b")).alias("b"))
    s = s.select("other_id", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2")).where("x1 <> x2 or y1 <> y2")

    # Reference point of cell (i, j): (i*side + 1/2, j*side + 1/2). Twice the coordinates are integers.
    rows = s.withColumn("cy", F.explode(F.sequence(_cell(F.least("y1", "y2"), side) , _cell(F.greatest("y1", "y2"), side))))
    yc2 = F.col("cy") * (2 * side) + 1
    rows = rows.where((F.col("y1") * 2 < yc2) != (F.col("y2") * 2 < yc2))
    dec = lambda c: c.cast("decimal(19,0)")
    up = F.when(F.col("y2") > F.col("y1"), F.lit(1)).otherwise(F.lit(-1))
    # Crossing at x1 + num/den, den > 0, in half units of x: 2*x1 + 2*num/den with num over doubled y.
    num = (dec(yc2 - F.col("y1") * 2) * dec((F.col("x2") - F.col("x1")) * up)).cast("decimal(38,0)")
    den = (F.col("y2") - F.col("y1")) * up
    # Largest i with 2*i*side + 1 < 2*x1 + num/den, that is i*2*side < (2*x1 - 1) + num/den.
    whole = F.floor(num / dec(den)).cast("bigint")
    exact = F.when(num.cast("decimal(38,0)") == (dec(whole) * dec(den)).cast("decimal(38,0)"), F.lit(1)).otherwise(F.lit(0))
    below = F.col("x1") * 2 - 1 + whole - exact  # largest integer strictly below the bound
    rows = rows.select("other_id", "cy", F.floor(below / F.lit(2 * side)).cast("bigint").alias("ci"))
    w = W.partitionBy("other_id", "cy").orderBy(F.desc("ci"))
    odd = rows.withColumn("rn", F.row_number().over(w)).withColumn("nx", F.lead("ci").over(w)).where("rn % 2 = 1 and nx < ci")
    inner = odd.select("other_id", "cy", F.explode(F.sequence(F.col("nx") + 1, F.col("ci"))).alias("cx"))

    sites = pos.select("x", "y").distinct().select(_cell(F.col("x"), side).alias("cx"), _cell(F.col("y"), side).alias("cy"), "x", "y")
    base = sites.join(inner, ["cx", "cy"]).select("x", "y", "other_id", F.lit(1).alias("n"), F.lit(False).alias("edge"))

    local = sites.join(segment_cells(s, side, 0), ["cx", "cy"])
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    px, py, dx, dy = x - x1, y - y1, x2 - x1, y2 - y1
    c_p = _cross(dx, dy, px, py)  # > 0: p above the line (dx >= 0)
    edge = (c_p == 0) & (x >= x1) & (x <= x2) & (y >= F.least("y1", "y2")) & (y <= F.greatest("y1", "y2"))
    # Path: from p up or down at x + epsilon to the reference row, then along it to the reference point.
    yc2 = F.col("cy") * (2 * side) + 1
    xr2 = F.col("cx") * (2 * side) + 1
    c_q = _cross(dx * 2, dy * 2, px * 2, yc2 - y1 * 2)
    q_above = F.when(c_q != 0, c_q > 0).otherwise(dy < 0)  # at x + epsilon the line has moved by the sign of dy
    vertical = (x1 <= x) & (x < x2) & ((c_p > 0) != q_above)
    # Crossing of the row at xc: xr < xc <= x (p is never left of the reference by more than the half unit).
    crosses = (y1 * 2 < yc2) != (y2 * 2 < yc2)
    side_of = lambda qx2: F.when(dy > 0, _cross(dx * 2, dy * 2, qx2 - x1 * 2, yc2 - y1 * 2)).otherwise(-_cross(dx * 2, dy * 2, qx2 - x1 * 2, yc2 - y1 * 2))
    # side_of(q) > 0: q left of the crossing; 0: at it.
    left_p, left_r = side_of(x * 2) > 0, side_of(xr2) > 0
    # p at the cell's first column lies half a unit left of the reference: then xc with x < xc <= xr counts.
    along = crosses & (left_p != left_r)
    n = vertical.cast("int") + along.cast("int")
    near = local.select("x", "y", "other_id", n.alias("n"), edge.alias("edge")).where("n > 0 or edge")
    found = base.unionByName(near).groupBy("x", "y", "other_id").agg((F.sum("n") % 2).alias("odd"), F.max("edge").alias("edge")).where("odd = 1 and not edge")
    return found.join(pos, ["x", "y"]).select("id", "other_id").distinct()
