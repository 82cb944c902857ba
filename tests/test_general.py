"""The general operators against brute force and on hostile small inputs."""

from collections import defaultdict
from fractions import Fraction

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row

from rillwork.operators import hierarchy, proximity, references, shred
from rillwork.plans import core_queries as q


def rows(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def near_segment(p, a, b, r):
    dx, dy = b[0] - a[0], b[1] - a[1]
    px, py = p[0] - a[0], p[1] - a[1]
    n = dx * dx + dy * dy
    t = px * dx + py * dy
    if n == 0 or t <= 0:
        return px * px + py * py <= r * r
    if t >= n:
        return (p[0] - b[0]) ** 2 + (p[1] - b[1]) ** 2 <= r * r
    return (px * dy - py * dx) ** 2 <= r * r * n


def inside(p, segs):
    odd = False
    for a, b in segs:
        c = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        if c == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1]):
            return False
        if (a[1] > p[1]) != (b[1] > p[1]):
            x = Fraction((b[0] - a[0]) * (p[1] - a[1]), b[1] - a[1]) + a[0]
            odd ^= x > p[0]
    return odd


def brute_p1(nodes, ways, contours, r):
    pos = {(n, x, y) for n, x, y in nodes}
    out = set()
    grid = defaultdict(set)
    for n, x, y in pos:
        grid[x // r, y // r].add((n, x, y))
    for n, x, y in pos:
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                for m, x2, y2 in grid.get((x // r + i, y // r + j), ()):
                    if n < m and (x - x2) ** 2 + (y - y2) ** 2 <= r * r:
                        out.add(("node", n, m))
    own = {(n, w) for w, ns, _ in ways for n in ns or ()}
    for w, _, g in ways:
        for a, b in zip(g, g[1:] or g):
            for n, x, y in pos:
                if min(a[0], b[0]) - r <= x <= max(a[0], b[0]) + r and near_segment((x, y), a, b, r) and (n, w) not in own:
                    out.add(("way", n, w))
    lines = defaultdict(set)
    for w, g in contours:
        g = tuple(g)
        lines[w].add(min(g, g[::-1]))
    for w, gs in lines.items():
        segs = [(a, b) for g in gs for a, b in zip(g, g[1:])]
        x0, x1 = min(min(a[0], b[0]) for a, b in segs), max(max(a[0], b[0]) for a, b in segs)
        for n, x, y in pos:
            if x0 <= x <= x1 and inside((x, y), segs):
                out.add(("area", n, w))
    return out


def found(df, *cols):
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_p1_brute_force(spark, sf):
    xy = lambda p: (p["x"], p["y"])
    nodes = [(r["pnt_osm_id"], *xy(r["geom"])) for r in rows(sf, "graph_nodes") if r["geom"]]
    ways = [(r["way_osm_id"], r["nodes"], [xy(p) for p in r["geom"]]) for r in rows(sf, "osm_ways") if r["geom"]]
    contours = [(r["way_osm_id"], [xy(p) for p in r["geom"]]) for r in rows(sf, "contours") if r["geom"]]
    expect = brute_p1(nodes, ways, contours, q.RADIUS)
    assert {k for k, _, _ in expect} == {"node", "way", "area"}
    assert found(q.p1_found(spark, sf), "kind", "pnt_osm_id", "other_id") == expect


def test_areas_adversarial(spark):
    """Tiny cells, vertices on cell borders and reference rows, shared corners, islands, negative coordinates."""
    import random

    rnd = random.Random(5)
    squares = []
    for k in range(12):
        x, y, s = rnd.randrange(-30, 30), rnd.randrange(-30, 30), rnd.randrange(2, 25)
        ring = [(x, y), (x + s, y - rnd.randrange(3)), (x + s + rnd.randrange(4), y + s), (x, y + s), (x, y)]
        hole = [(x + 1, y + 1), (x + s - 1, y + s - 1), (x + 1, y + s - 1), (x + 1, y + 1)] if s > 5 else None
        squares += [(k, ring[:3]), (k, ring[:1:-1])] + ([(k, hole)] if hole else [])
    pts = [(i * 100 + j, i, j) for i in range(-35, 60, 2) for j in range(-35, 60)]
    df = spark.createDataFrame([(w, [Row(x=a, y=b) for a, b in g]) for w, g in squares * 2], "way_osm_id long, geom array<struct<x:long,y:long>>")
    pos = spark.createDataFrame(pts, "id long, x long, y long")
    segs = defaultdict(set)
    for w, g in squares:
        segs[w] |= set(zip(g, g[1:]))
    expect = {(n, w) for w, s in segs.items() for n, x, y in pts if inside((x, y), s)}
    for side in (4, 7, 1000):
        assert found(proximity.enclosing_areas(pos, df, "way_osm_id", "geom", side), "id", "other_id") == expect


def test_near_points_geodesic(spark):
    import math

    pts = [(1, 0, 0), (2, 900_0, 0), (3, -1799999990, 600000000), (4, 1799999990, 600000000), (5, 300000000, 890000000), (6, 300100000, 890000000)]
    pos = spark.createDataFrame(pts, "id long, x long, y long")

    def dist(a, b):
        p, q_ = math.radians(a[2] / 1e7), math.radians(b[2] / 1e7)
        h = math.sin((q_ - p) / 2) ** 2 + math.cos(p) * math.cos(q_) * math.sin(math.radians((b[1] - a[1]) / 1e7) / 2) ** 2
        return 2 * 6371008.8 * math.asin(math.sqrt(h))

    expect = {(a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and dist(a, b) <= 120}
    assert expect and found(proximity.near_points(pos, 120, geodesic=True), "id", "other_id") == expect


def test_proximity_nulls_and_empty(spark):
    pts = spark.createDataFrame([(1, None, 5), (None, Row(x=1, y=1), 5), (2, Row(x=None, y=1), 5)], "pnt_osm_id long, geom struct<x:long,y:long>, id int")
    pos = proximity.positions(pts, "pnt_osm_id", "geom")
    assert pos.count() == 0
    lines = spark.createDataFrame([(1, None), (2, []), (3, [None, Row(x=5, y=5)])], "w long, geom array<struct<x:long,y:long>>")
    seg = proximity.segments(lines, "w", "geom")
    assert [tuple(r) for r in seg.collect()] == [(3, 5, 5, 5, 5)]
    one = spark.createDataFrame([(9, 5, 8), (10, 5, 9)], "id long, x long, y long")
    assert found(proximity.near_lines(one, seg, 3), "id", "other_id") == {(9, 3)}
    assert proximity.near_points(pos, 3).count() == 0
    assert proximity.enclosing_areas(pos, lines, "w", "geom", 10).count() == 0


def brute_forest(links):
    parent = {}
    ids = {i for i, _ in links if i}
    for i, p in sorted(((i, p) for i, p in links if i and p in ids), reverse=True):
        parent[i] = p
    out, below = {}, defaultdict(int)
    for i in ids:
        path, seen, x = [i], {i}, i
        while x in parent:
            x = parent[x]
            if x in seen:
                path = None
                break
            seen.add(x)
            path.append(x)
        out[i] = path and path[::-1]
        for a in (path or [])[1:]:
            below[a] += 1
    return {(i, "cycle", -1, "", -1) if p is None else (i, p[0], len(p) - 1, ">".join(p), below[i]) for i, p in out.items()}


def test_p2_brute_force(spark, sf):
    import re

    bare = lambda s: (m := re.search(r"(?i)q([0-9]+)\s*$", s or "")) and "Q" + m[1]
    links = [(r["id"], bare(r["mouthq_id"])) for r in rows(sf, "fin_wikidata_waterways_ru")]
    assert found(q.p2_found(spark, sf), "id", "root_id", "depth", "path", "n_descendants") == brute_forest(links)


def test_hierarchy_shapes(spark):
    """A long chain, a hot root, self-loops, cycles with and without splitters, things below cycles, repeats, nulls."""
    links = [(f"c{i}", f"c{i + 1}") for i in range(300)] + [("c300", None)]
    links += [(f"h{i}", "hot") for i in range(500)] + [("hot", "nowhere")]
    links += [("self", "self"), ("s2", "self")]
    for n in (2, 3, 40, 90):
        links += [(f"z{n}_{i}", f"z{n}_{(i + 1) % n}") for i in range(n)] + [(f"below{n}", f"z{n}_0")]
    links += links[:7] + [(None, "c1"), ("c5", None)]
    df = spark.createDataFrame(links, "id string, parent string")
    assert found(hierarchy.hierarchy(df), "id", "root_id", "depth", "path", "n_descendants") == brute_forest(links)
    assert hierarchy.hierarchy(df.limit(0)).count() == 0


def test_orphan_states(spark):
    import datetime as dt

    t = lambda m, d=1: dt.datetime(2024, m, d)
    refs = [("f", "a", "w", "gone", t(3)), ("f", "a", "w", "gone", t(3, 20)), ("f", "a", "w", "none", t(3)), ("f", "b", "w", "late", t(3)), ("f", "b", "w", "same", t(3)),
            ("f", "c", "w", None, t(3)), ("f", "c", "r", "same", t(3)), ("f", "d", "w", "body", t(1)), ("f", "d", "w", "none", None)]
    parents = [("w", "gone", t(1)), ("w", "late", t(4)), ("w", "same", t(3, 30)), ("w", "body", None)]
    dels = [("w", "gone", t(3, 10)), ("w", "none", t(9)), ("w", None, t(1))]
    got = references.orphan_references(
        spark.createDataFrame(refs * 2, "field string, id string, target string, ref string, seen_at timestamp"),
        spark.createDataFrame(parents, "target string, ref string, arrived_at timestamp"),
        spark.createDataFrame(dels * 2, "target string, ref string, deleted_at timestamp"))
    assert found(got, "id", "ref", "period", "status") == {
        ("a", "gone", "2024-03", "deleted"), ("a", "none", "2024-03", "missing"), ("b", "late", "2024-03", "late"),
        ("c", "same", "2024-03", "missing"), ("d", "none", None, "missing")}


JSON_CASES = [
    ('{"tags": {"a": null, "b": {"c": 1}}, "members": [{"type": "way", "ref": 5}, null, {"ref": "r7", "members": {"member": [{"type": "node", "ref": "8", "tags": [{"k": "x", "v": 1}]}]}}]}',
     {("0", "tag", "a"), ("0", "tag", "b"), ("1", "member", "way/5"), ("3", "member", "relation/7"), ("3.1", "member", "node/8"), ("3.1", "tag", "x")}),
    ('﻿ {"members": {"type": "way", "ref": null, "tags": "{\\"k\\": \\"v\\"}"}} \n', {("1", "member", "way/?"), ("1", "tag", "k")}),
    ('{"members": "[{\\"ref\\": 3}, {}]", "history": [{"members": [{"ref": 1}], "tags": {"no": 1}}]}', {("1", "member", "?/3"), ("2", "member", "?/?")}),
    ('{"members": [{"type": "way", "ref": 1}', set()), ("", set()), ("  ", set()), (None, set()), ("[1, 2", set()), ('{"a": 01}', set()), ('{"tags": NaN}', set()), ("5", set()), ('{"tags": {"a": 1}} x', set()),
]


def test_shred_shapes(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(JSON_CASES)], "record_id long, payload string, path string")
    t = shred.shred(df, "record_id", "payload", {"members": "member"}, {"tags"})
    m = shred.pivot_group(t, "members", ["type", "ref"])
    got = {(r.record_id, r.path, "member", r.item) for r in m.select("record_id", "path", shred.member_item(m["type"], m["ref"]).alias("item")).collect()}
    got |= {(r.record_id, r.path, "tag", r.field) for r in t.where("grp = 'tags'").collect()}
    assert got == {(i, *x) for i, (_, e) in enumerate(JSON_CASES) for x in e}


@pytest.mark.parametrize("depth", [3000])
def test_shred_depth(depth):
    text = '{"members": [' * depth + "null" + "]}" * depth
    assert len({p for _, p, _, _ in shred.triples(text, {"members": "member"}, frozenset({"tags"}))}) == depth - 1
