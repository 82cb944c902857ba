"""Geodesic and iterative measures as Arrow UDFs on NumPy."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# The WGS84 ellipsoid.
A, FLAT = 6378137.0, 1 / 298.257223563
B = A * (1 - FLAT)


def arrow_udf(kind: str):
    """A function of lists as an Arrow UDF of a batch; made at its first use, when there is a session."""
    def wrap(f):
        @functools.wraps(f)
        def call(*cols):
            type_ = to_arrow_type(T.DataType.fromDDL(kind))

            def batch(*arrays: pa.Array) -> pa.Array:
                return pa.array(f(*[a.to_pylist() for a in arrays]), type_)

            # The number of arguments has to be known to the worker.
            one, two = (lambda a: batch(a)), (lambda a, b: batch(a, b))
            udf = one if len(cols) == 1 else two
            udf.__annotations__ = {k: pa.Array for k in ("a", "b")[: len(cols)]} | {"return": pa.Array}
            return F.arrow_udf(udf, kind)(*cols)

        return call

    return wrap


def vincenty(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Metres between points given in degrees on the WGS84 ellipsoid; where the iteration doesn't settle, the great circle's."""
    l1, l2 = np.radians(lat1), np.radians(lat2)
    L = np.radians(np.asarray(lon2) - np.asarray(lon1))
    u1, u2 = np.arctan((1 - FLAT) * np.tan(l1)), np.arctan((1 - FLAT) * np.tan(l2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = L.copy()
    with np.errstate(all="ignore"):
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sig = np.arctan2(ss, cs)
            sa = np.where(ss > 0, c1 * c2 * sl / ss, 0.0)
            ca2 = 1 - sa * sa
            cm = np.where(ca2 > 0, cs - 2 * s1 * s2 / ca2, 0.0)
            c = FLAT / 16 * ca2 * (4 + FLAT * (4 - 3 * ca2))
            new = L + (1 - c) * FLAT * sa * (sig + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
            done = np.abs(new - lam) < 1e-13
            lam = new
            if done.all():
                break
        k = ca2 * (A * A - B * B) / (B * B)
        a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        ds = b * ss * (cm + b / 4 * (cs * (2 * cm * cm - 1) - b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        out = B * a * (sig - ds)
        h = np.sin((l2 - l1) / 2) ** 2 + np.cos(l1) * np.cos(l2) * np.sin(L / 2) ** 2
        return np.where(done & np.isfinite(out), out, 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(1, h))))


def _xy(line) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in line if p is not None and p["x"] is not None and p["y"] is not None], float).reshape(-1, 2)


@arrow_udf("double")
def geodesic_length(lines: list) -> list:
    """Length in metres; null for null, 0 for a line of one point."""
    pts = [None if l is None else _xy(l) for l in lines]
    flat = [p for p in pts if p is not None and len(p) > 1]
    out = [None if p is None else 0.0 for p in pts]
    if flat:
        a, b = np.concatenate([p[:-1] for p in flat]) / 1e7, np.concatenate([p[1:] for p in flat]) / 1e7
        d = vincenty(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
        ends = np.cumsum([len(p) - 1 for p in flat])
        sums = np.diff(np.concatenate([[0.0], np.cumsum(d)[ends - 1]]))
        for i, x in zip([i for i, p in enumerate(pts) if p is not None and len(p) > 1], sums.tolist()):
            out[i] = x
    return out


def _authalic(lat: np.ndarray) -> np.ndarray:
    """sin of the authalic latitude times the authalic radius squared over it, by the ellipsoid's q."""
    e2 = FLAT * (2 - FLAT)
    e, s = np.sqrt(e2), np.sin(lat)
    q = (1 - e2) * (s / (1 - e2 * s * s) + np.arctanh(e * s) / e)
    return q * A * A / 2


def ring_area(p: np.ndarray) -> float:
    """Signed area in square metres of a ring of 1e-7 degrees on the equal-area sphere of the ellipsoid.

    Edges run straight between longitude and the authalic sine; for the edge lengths of
    mapped water the error is far below a square metre.
    """
    lon, lat = np.radians(p[:, 0] / 1e7), np.radians(p[:, 1] / 1e7)
    q = _authalic(lat)
    return float(np.sum((np.roll(lon, -1) - lon) * (np.roll(q, -1) + q)) / 2)


def rings(lines: list) -> list[np.ndarray]:
    """Closed rings put together from boundary lines in any order and direction."""
    parts = [[(p["x"], p["y"]) for p in l] for l in lines if l is not None and len(l) > 1]
    by_end: dict[tuple, list[int]] = {}
    for i, p in enumerate(parts):
        for e in (p[0], p[-1]):
            by_end.setdefault(e, []).append(i)
    used, out = set(), []
    for i, p in enumerate(parts):
        if i in used:
            continue
        used.add(i)
        ring = list(p)
        while ring[0] != ring[-1]:
            nxt = next((j for j in by_end.get(ring[-1], ()) if j not in used), None)
            if nxt is None:
                break
            used.add(nxt)
            q = parts[nxt]
            ring += q[1:] if q[0] == ring[-1] else q[-2::-1]
        out.append(np.array(ring, float))
    return out


def polygons(lines: list) -> list[list[np.ndarray]]:
    """Polygons of a boundary by even-odd nesting: each an outer ring and the holes right inside it; open rings are left out."""
    rs = sorted((r for r in rings(lines) if len(r) > 3 and (r[0] == r[-1]).all()), key=lambda r: -abs(ring_area(r[:-1])))
    # A ring lies in another one when its first point that isn't on it does; larger rings come first.
    holders = [[j for j in range(i) if _holds(rs[j], r)] for i, r in enumerate(rs)]
    out: dict[int, list[np.ndarray]] = {}
    for i, r in enumerate(rs):
        if len(holders[i]) % 2 == 0:
            out[i] = [r]
        else:
            out[[j for j in holders[i] if j in out][-1]].append(r)
    return list(out.values())


def _holds(ring: np.ndarray, other: np.ndarray) -> bool:
    on = {tuple(p) for p in ring.tolist()}
    free = [p for p in other.tolist() if tuple(p) not in on] or ((other[:-1] + other[1:]) / 2).tolist()
    return bool(_inside(np.array(free[:1], float), ring)[0])


def polygon_area(lines: list) -> float:
    """Area inside a boundary by even-odd nesting of its rings, square metres."""
    rs = [r for r in rings(lines) if len(r) > 3]
    total = 0.0
    for i, r in enumerate(rs):
        depth = sum(_inside(r[:1], s)[0] for j, s in enumerate(rs) if j != i)
        total += abs(ring_area(r[:-1] if (r[0] == r[-1]).all() else r)) * (1 if depth % 2 == 0 else -1)
    return total


def _inside(p: np.ndarray, ring: np.ndarray) -> np.ndarray:
    a, b = ring, np.roll(ring, -1, axis=0)
    return _odd(p, a, b)


def _odd(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = (a[:, 1] > p[:, None, 1]) != (b[:, 1] > p[:, None, 1])
        x = a[:, 0] + (p[:, None, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return (cross & (x > p[:, None, 0])).sum(1) % 2 == 1


@arrow_udf("double")
def geodesic_area(boundaries: list) -> list:
    """Square metres inside a boundary given as an array of lines; null for null."""
    return [None if b is None else polygon_area(b) for b in boundaries]


def _distance(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = b - a
    n = (d * d).sum(1)
    t = ((p[:, None, :] - a) * d).sum(2) / np.where(n > 0, n, 1)
    q = a + np.clip(t, 0, 1)[:, :, None] * d
    return np.sqrt(((p[:, None, :] - q) ** 2).sum(2).min(1))


def inscribed_centre(lines: list) -> tuple[int, int] | None:
    """Centre of the largest inscribed circle, to a hundredth of the boundary's extent; null when there is no inside.

    Quad-tree search: cells whose best possible distance can't beat the best centre found are left out.
    """
    segs = [(p[:-1], p[1:]) for p in (_xy(l) for l in lines if l is not None) if len(p) > 1]
    if not segs:
        return None
    a, b = np.concatenate([s[0] for s in segs]), np.concatenate([s[1] for s in segs])
    lo, hi = np.minimum(a, b).min(0), np.maximum(a, b).max(0)
    size = float(max(hi - lo))
    if size == 0:
        return None
    precision = size / 100
    cell = float(min(hi - lo)) or size
    half = cell / 2
    cells = np.array([(x, y) for x in np.arange(lo[0] + half, hi[0] + half, cell) for y in np.arange(lo[1] + half, hi[1] + half, cell)])
    best, at = 0.0, None
    while len(cells):
        d = np.concatenate([_distance(c, a, b) * np.where(_odd(c, a, b), 1, -1) for c in np.array_split(cells, -(-len(cells) * len(a) // 2_000_000))])
        k = int(d.argmax())
        if d[k] > best:
            best, at = float(d[k]), cells[k]
        cells = cells[d + half * np.sqrt(2) > best + precision]
        half /= 2
        cells = np.concatenate([cells + (sx * half, sy * half) for sx in (-1, 1) for sy in (-1, 1)]) if len(cells) else cells
    return None if at is None else (int(round(at[0])), int(round(at[1])))


@arrow_udf("struct<x:bigint,y:bigint>")
def inscribed_circle_centre(boundaries: list) -> list:
    """Centre of the largest circle inside a boundary given as an array of lines; null without an inside."""
    got = [None if b is None else inscribed_centre(b) for b in boundaries]
    return [None if g is None else {"x": g[0], "y": g[1]} for g in got]


def simplify(line: list, tolerance: float) -> list:
    """Douglas-Peucker without recursion."""
    if len(line) < 3:
        return line
    p = _xy(line)
    keep = np.zeros(len(p), bool)
    keep[[0, -1]] = True
    stack = [(0, len(p) - 1)]
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        d = _distance(p[i + 1 : j], p[i : i + 1], p[j : j + 1])
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[i + 1 + k] = True
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return [q for q, k in zip(line, keep) if k]


def shared_parts(l1: list, l2: list) -> list[list[dict]] | None:
    """Linear parts that two lines share, or null unless each also has a part outside the other.

    Coordinates are integers; collinearity is exact.
    """
    def parts(l, m):
        out = []
        full = True
        for p, q in zip(l, l[1:]):
            (ax, ay), (bx, by) = (int(p["x"]), int(p["y"])), (int(q["x"]), int(q["y"]))
            dx, dy = bx - ax, by - ay
            n = dx * dx + dy * dy
            if not n:
                continue
            cover = []
            for r, s in zip(m, m[1:]):
                (cx, cy), (ex, ey) = (int(r["x"]), int(r["y"])), (int(s["x"]), int(s["y"]))
                if dx * (cy - ay) != dy * (cx - ax) or dx * (ey - ay) != dy * (ex - ax):
                    continue
                t = sorted(((cx - ax) * dx + (cy - ay) * dy, (ex - ax) * dx + (ey - ay) * dy))
                lo, hi = max(0, t[0]), min(n, t[1])
                if lo < hi:
                    cover.append((lo, hi))
            cover.sort()
            at = 0
            for lo, hi in cover:
                full = full and lo <= at
                at = max(at, hi)
            full = full and at >= n
            merged: list[list[int]] = []
            for lo, hi in cover:
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                out.append([{"x": round(ax + dx * t / n), "y": round(ay + dy * t / n)} for t in (lo, hi)])
        return out, full

    out, inside1 = parts(l1, l2)
    if not out or inside1 or parts(l2, l1)[1]:
        return None
    joined: list[list[dict]] = []
    for s in out:
        if joined and joined[-1][-1] == s[0]:
            joined[-1].append(s[1])
        else:
            joined.append(list(s))
    return joined


@arrow_udf("array<array<struct<x:bigint,y:bigint>>>")
def overlap_parts(a: list, b: list) -> list:
    """Shared linear parts of two lines; null unless they overlap partly."""
    return [None if x is None or y is None else shared_parts(x, y) for x, y in zip(a, b)]
