"""Micro fixtures of the network checks, tag rules, ingest and the knowledge graph; SQL equivalence."""

import glob
import os
from collections import Counter
from decimal import Decimal

import pytest

import __spark_entry__
from rillwork.functions import measures
from rillwork.functions.geom import point_from_text
from rillwork.operators import checks, consolidate, ingest, knowledge, network, publish, tagging
from rillwork.sources import readers

P = "struct<x:long,y:long>"
WAY = f"way_osm_id long, tags map<string,string>, nodes array<long>, geom array<{P}>"


def xy(*pts):
    return [{"x": x, "y": y} for x, y in pts]


def way(i, kind, nodes, pts, **tags):
    return (i, ({"waterway": kind} if kind else {}) | tags, nodes, xy(*pts))


@pytest.fixture(scope="module")
def ctx(spark):
    from pyspark.sql import functions as F

    def build(ways, areas=()):
        w = spark.createDataFrame(list(ways), WAY)
        a = spark.createDataFrame([(i, t, [xy(*r) for r in rings]) for i, t, rings in areas], f"way_osm_id long, tags map<string,string>, boundary array<array<{P}>>")
        polys = a.select("way_osm_id", "tags", F.transform("boundary", lambda r: F.array(r)).alias("geom"))
        nodes = network.graph_nodes(w)
        stats = network.node_stats(nodes, w, network.contours(polys))
        return w, a, stats.cache(), network.node_stats_agg(stats).cache()

    return build


def ids(df, c="way_osm_id"):
    return sorted(r[c] for r in df.select(c).collect())


def test_network_and_direction(ctx):
    w, a, stats, agg = ctx([
        way(100, "river", [1, 2], [(0, 0), (10, 0)]), way(101, "river", [2, 3], [(10, 0), (20, 0)]),
        way(200, "river", [10, 11, 12], [(0, 50), (5, 50), (10, 50)]), way(201, "stream", [11, 13], [(5, 50), (5, 60)]),
        way(300, "river", [20, 22, 21], [(0, 100), (5, 105), (10, 100)]), way(301, "river", [20, 23, 21], [(0, 100), (5, 95), (10, 100)]),
        way(302, None, [20, 24, 21], [(0, 100), (5, 90), (10, 100)], natural="cliff"),
        way(510, "stream", [40, 41], [(5, 200), (5, 205)]), way(511, "river", [42, 43], [(0, 205), (10, 205)]),
    ])
    got = {r.pnt_osm_id: (r.str, r.mid, r.end) for r in agg.collect()}
    assert got[1] == (1, 0, 0) and got[2] == (1, 0, 1) and got[3] == (0, 0, 1)
    assert got[41] == (0, 1, 1)  # a touch without a shared node
    assert ids(checks.wrong_direction(w, agg)) == [201, 300, 301, 302]


def test_coast_stops_direction(ctx):
    w, a, stats, agg = ctx([way(200, "river", [10, 11, 12], [(0, 50), (5, 50), (10, 50)]), way(201, "stream", [11, 13], [(5, 50), (5, 60)]), way(900, None, [90, 91], [(0, 60), (10, 60)], natural="coastline")])
    assert ids(checks.wrong_direction(w, agg)) == []


def test_rank_and_its_exception(ctx):
    base = [way(400, "river", [30, 31], [(0, 0), (10, 0)]), way(401, "stream", [31, 32], [(10, 0), (20, 0)])]
    w, a, stats, agg = ctx(base)
    assert [(r.way_osm_id, r.in_pnt.x) for r in checks.rank_errors(w, stats, agg).collect()] == [(401, 10)]
    w, a, stats, agg = ctx([*base, way(402, "river", [31, 33], [(10, 0), (20, 9)])])
    assert checks.rank_errors(w, stats, agg).count() == 0


LAKE = [(0, 0), (100, 0), (100, 100), (0, 100), (0, 0)]


def test_unconnected_and_gap_through_lake(ctx):
    ways = [way(500, "stream", [40, 41], [(-50, 50), (0, 50)]), way(501, "river", [42, 43], [(100, 50), (200, 50)]), way(502, "river", [44, 45], [(100, 90), (200, 95)])]
    lake = (900, {"natural": "water"}, [LAKE])
    w, a, stats, agg = ctx(ways, [lake])
    assert ids(checks.unconnected(w, agg)) == [500]
    got = checks.missing_segments(w, a, stats, agg).collect()
    assert [(r.in_osm_id, r.wa_osm_id, r.out_osm_id) for r in got] == [(500, 900, 501)]
    assert [(p.x, p.y) for p in got[0].geom][::2] == [(0, 50), (100, 50)]
    w, a, stats, agg = ctx(ways)
    assert ids(checks.unconnected(w, agg)) == []


def test_gap_at_riverbank_and_multiplicity(ctx):
    bank = (901, {"natural": "water", "water": "river"}, [LAKE])
    ways = [way(500, "stream", [40, 41], [(-50, 50), (0, 50)]), way(503, "stream", [46, 41], [(-50, 80), (0, 50)]), way(520, "river", [60, 61], [(50, -500), (50, 500)]), way(521, "river", [62, 63], [(5, -500), (5, 500)], tunnel="yes"),
            way(522, "river", [64, 65], [(-20, 0), (-20, 300)])]
    w, a, stats, agg = ctx(ways, [bank])
    none = checks.missing_segments(w, a, stats, agg)
    assert none.count() == 0
    got = checks.missing_segments_at_banks(w, a, stats, agg, none, side=10).collect()
    # 521 is a tunnel, 522 crosses both: the next is 520. Two ways and two bank rows make four.
    assert Counter((r.in_osm_id, r.out_osm_id) for r in got) == {(500, 520): 2, (503, 520): 2}
    assert (got[0].geom[1].x, got[0].geom[1].y) == (50, 50)


def test_duplicates_and_overlaps(spark):
    w = spark.createDataFrame([
        way(600, "river", [], [(0, 0), (9, 9)]), way(601, "river", [], [(0, 0), (9, 9)]), way(602, None, [], [(0, 0), (9, 9)], natural="coastline"), way(603, "river", [], [(9, 9), (0, 0)]),
        way(700, "river", [], [(0, 100), (10, 100), (20, 100)]), way(701, "river", [], [(10, 100), (20, 100), (30, 100)]), way(702, "river", [], [(10, 100), (20, 100)]),
        way(703, "canal", [], [(0, 200), (30, 200)]), way(704, "canal", [], [(20, 200), (5, 200), (5, 210)]), (705, {"waterway": "river"}, [], None)], WAY)
    from rillwork.functions.tags import has

    assert ids(checks.duplicates(w, has("waterway"))) == [600, 601, 602]
    got = {tuple(r.osm_ids): [[(p.x, p.y) for p in part] for part in r.geom] for r in checks.overlapping_ways(w, side=7).collect()}
    assert got == {(701, 700): [[(10, 100), (20, 100)]], (704, 703): [[(20, 200), (5, 200)]]}


TAG_CASES = [
    ("way", {"waterway": "river", "bridge": "yes"}, ["6-2"]), ("way", {"waterway": "ditch", "bridge": "yes"}, None), ("area", {"landuse": "reservoir", "water:type": "x"}, ["6-3", "6-4"]),
    ("area", {"water": "tidal", "natural": "water"}, ["6-5-1"]), ("area", {"water": "tidal", "natural": "bay"}, ["6-5-2"]), ("area", {"water": "tidal"}, [None]), ("area", {"water": "Tidal", "natural": "water"}, [None]),
    ("area", {"water": "natural", "waterway": "riverbank"}, ["6-10", "6-18"]), ("area", {"waterway": "wadi"}, ["6-35", "6-51"]), ("area", {"waterway": "dam"}, None),
    ("area", {"waterway": "ditch", "area": "no"}, ["6-29-1"]), ("area", {"waterway": "ditch"}, ["6-29-2"]), ("area", {"waterway": "ditch", "area": "yes"}, ["6-35"]),
    ("way", {"water": "lake"}, ["6-40"]), ("way", {"water": "rapids", "waterway": "rapids"}, ["6-41"]), ("way", {"water": "spring", "note": "x"}, ["6-42"]), ("way", {"water": "lake", "note": "x"}, ["6-44"]),
    ("way", {"name": "СТАРИЦА"}, ["6-45"]), ("way", {"name": "Старица Оки"}, ["6-46"]), ("way", {"name": "р. Ока"}, ["6-47"]), ("way", {"name": "тигр. 1"}, None), ("way", {"name": "р."}, ["6-47"]),
    ("way", {"name": "кан.Москвы"}, ["6-47"]), ("way", {"name": "кан. Москвы"}, None), ("area", {"name": "оз. Белое"}, [None]), ("way", {"natural": "wetland"}, ["6-55"]), ("way", {}, None), ("way", None, None),
]


def test_tag_rules(spark):
    rows = [(k, t, i) for i, (k, t, _) in enumerate(TAG_CASES)]
    df = lambda kind: spark.createDataFrame([(i, t) for k, t, i in rows if k == kind], "way_osm_id long, tags map<string,string>")
    got = {r.way_osm_id: list(r.err_list) for r in tagging.tagging_mistakes(df("way"), df("area"), None).collect()}
    assert got == {i: e for i, (_, _, e) in enumerate(TAG_CASES) if e}


def test_islands_by_size(spark):
    def square(side_m):
        s = int(side_m / 111_320 * 1e7)
        return [xy((0, 0), (s, 0), (s, s), (0, s), (0, 0))]

    a = spark.createDataFrame([(1, {"waterway": "island"}, square(40)), (2, {"waterway": "island"}, square(25))], f"way_osm_id long, tags map<string,string>, boundary array<array<{P}>>")
    assert {r.way_osm_id: r.err_id for r in tagging.area_findings(a).collect()} == {1: "6-28-1", 2: "6-28-2"}


def test_consolidation(spark):
    f = spark.createDataFrame([(1, "6-10"), (1, "6-18"), (1, "6-18"), (2, None), (3, "9-9")], "osm_id long, err_id string")
    got = {r.osm_id: (list(r.err_ids), len(r.err_list)) for r in consolidate.consolidate([f, f]).collect()}
    assert got == {1: (["6-10", "6-18"], 1), 3: (["9-9"], 1)}


def test_ingest(spark):
    nodes = spark.createDataFrame([(1, {"natural": "spring"}, 0, 0), (2, {"tiger:x": "1"}, 10, 0), (3, {"waterway": "dam", "source_ref": "q"}, 10, 10), (4, {"a": "b"}, 0, 10)], "id long, tags map<string,string>, x long, y long")
    assert [(r.pnt_osm_id, dict(r.tags)) for r in ingest.route_points(nodes).orderBy("pnt_osm_id").collect()] == [(1, {"natural": "spring"}), (3, {"waterway": "dam"})]
    ways = spark.createDataFrame([(10, {"waterway": "fairway"}, [1, 2]), (11, {"waterway": "fairway", "natural": "water"}, [1, 2]), (12, {"natural": "tree_row"}, [1, 2, 3, 1]), (13, {"waterway": "river"}, [1, 99]), (14, {"waterway": "river"}, None), (15, {"x": "y"}, [1, 2, 3]), (16, {"x": "y"}, [3, 4, 1])], "id long, tags map<string,string>, nodes array<long>")
    shaped = ingest.way_lines(ways, nodes)
    lines, areas = ingest.route_ways(shaped)
    assert ids(lines) == [11] and ids(areas) == [12]
    m = [{"type": "way", "ref": r, "role": "outer"} for r in (15, 16)]
    rels = spark.createDataFrame([(5, {"type": "multipolygon", "natural": "water"}, m), (6, {"type": "multipolygon", "water": "lake"}, m), (7, {"type": "waterway"}, m)], "id long, tags map<string,string>, members array<struct<type:string,ref:long,role:string>>")
    got = ingest.relation_areas(rels, shaped).collect()
    assert [(r.way_osm_id, r.nodes, len(r.geom[0][0])) for r in got] == [(-5, None, 5)]
    assert ids(ingest.route_relations(rels), "rel_osm_id") == [7]


def test_multipolygons_with_holes(spark):
    ring = lambda a, b: xy((a, a), (b, a), (b, b), (a, b), (a, a))
    lines = spark.createDataFrame([(1, ring(0, 100)), (2, ring(10, 40)), (3, ring(20, 30)), (4, ring(50, 90)), (5, ring(200, 300)), (6, xy((0, 0), (9, 9)))], f"id long, geom array<{P}>")
    m = [{"type": "way", "ref": r, "role": ""} for r in (6, 5, 4, 3, 2, 1)]
    rels = spark.createDataFrame([(9, {"type": "multipolygon", "natural": "water"}, m), (10, {"type": "multipolygon", "natural": "water"}, m[:1])], "id long, tags map<string,string>, members array<struct<type:string,ref:long,role:string>>")
    got = ingest.relation_areas(rels, lines).collect()
    assert [r.way_osm_id for r in got] == [-9]
    assert sorted([sorted(min(p.x for p in ring) for ring in poly) for poly in got[0].geom]) == [[0, 10, 50], [20], [200]]


def test_knowledge(spark, tmp_path):
    f = tmp_path / "w.csv"
    e = knowledge.ENTITY
    f.write_text(f'waterway,labelru,labelen,sourcecoords,mouthcoords,mouthqid,length,gvr,osm_id,tributaries\n{e}Q1,"А\nБ",,Point(0 0),Point(10 0),,5.5,,7,Q3; Q2\n{e}Q2,Два,,,Point(2 1),Q1,,,,\n{e}Q3,,,,Point(8 -1),"",,,,\n', encoding="utf-8")
    n = knowledge.normalize(readers.read_extract(spark, str(f))).cache()
    r = {x.id: x for x in n.collect()}
    assert r["Q1"].name_ru == "А\nБ" and r["Q1"].length_km == Decimal("5.5") and r["Q2"].source_pnt is None and r["Q2"].geom is None and r["Q3"].mouthq_id is None
    g = {x.id: x for x in knowledge.pseudo_geometry(n).collect()}
    assert [p.x // 10**7 for p in g["Q1"].geom] == [0, 2, 8, 10, 10] and list(g["Q1"].tributary_names_list) == ["Два", None]
    assert list(g["Q2"].tributary_names_list) == [None] and len(g["Q2"].geom) == 2
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("a", "c")], "id string, parent string")
    assert ids(knowledge.closure(edges, spark.createDataFrame([("a",)], "id string")), "id") == ["a", "b", "c"]
    bad = spark.createDataFrame([("Point(a b)",), (None,), ("",), (" POINT ( -1.5 2 ) ",)], "t string")
    assert [x[0] and (x[0].x, x[0].y) for x in bad.select(point_from_text(bad.t)).collect()] == [None, None, None, (-15_000_000, 20_000_000)]


def test_xml_and_config(spark, tmp_path):
    f = tmp_path / "m.xml"
    f.write_text('<osm><node id="1" lat="2.5" lon="-1"><tag k="natural" v="spring"/></node><way id="3"><nd ref="1"/><nd ref="2"/><tag k="waterway" v="river"/></way><relation id="4"><member type="way" ref="3" role=""/><tag k="type" v="waterway"/></relation></osm>')
    n, w, r = (readers.read_xml(spark, str(f), k).collect()[0] for k in ("node", "way", "relation"))
    assert (n.x, n.y, n.tags) == (-10_000_000, 25_000_000, {"natural": "spring"}) and list(w.nodes) == [1, 2] and r.members[0].ref == 3
    env = tmp_path / ".env"
    env.write_text("# no\nexport WATER_SCHEMA='rivers'\n")
    assert readers.Config.read(str(env)).schema == "rivers"


def test_measures():
    deg = 10_000_000
    assert abs(measures.vincenty([0.0], [0.0], [1.0], [0.0])[0] - 111319.4908) < 1e-3
    assert abs(measures.vincenty([0.0], [0.0], [0.0], [90.0])[0] - 10001965.729) < 1e-2
    # A cell of one degree at the equator; its upper edge is no geodesic here.
    assert abs(measures.polygon_area([xy((0, 0), (deg, 0)), xy((deg, deg), (deg, 0)), xy((deg, deg), (0, deg), (0, 0))]) / 12308778361.469 - 1) < 1e-4
    ring = [xy((0, 0), (100, 0), (100, 100), (0, 100), (0, 0)), xy((60, 60), (90, 60), (90, 90), (60, 90), (60, 60))]
    x, y = measures.inscribed_centre(ring)
    import math

    r = min(x, y, 60 - x if y > 60 else math.hypot(60 - x, 60 - y) if x < 60 else 60 - y)
    assert r >= 34
    assert measures.inscribed_centre([]) is None
    assert measures.simplify(xy((0, 0), (5, 1), (10, 0), (10, 50)), 2) == xy((0, 0), (10, 0), (10, 50))


def test_publish(spark):
    w = spark.createDataFrame([way(1, "river", [], [(0, 0), (1, 1)], tunnel="yes", name="N"), way(2, "dam", [], [(0, 0), (1, 1)])], WAY)
    none = spark.createDataFrame([(1, ["3", "5"])], "osm_id long, err_ids array<string>")
    got = publish.line_layer(w, none).collect()
    assert {(r.id, r.type, r.errs) for r in got} == {(1, "rt", "3,5")} and {r.z for r in got} == {6, 7, 8, 9}
    far = spark.createDataFrame([way(5, "river", [], [(0, 10**7), (300_000_000, 10**7)]), way(6, "river", [], [(5, 5)])], WAY)
    tiles = publish.line_layer(far, none).where("z = 6").collect()
    assert sorted(r.x for r in tiles if r.id == 5) == [32, 33, 34, 35, 36, 37] and [(r.x, r.y) for r in tiles if r.id == 6] == [(32, 31)]
    v = publish.error_table_view(w).orderBy("way_osm_id").collect()[0]
    assert list(v.bbox) == [0.0, 1e-7, 1e-7, 0.0] and list(v.osm_ids) == [1] and v.link == "way/1"


SLOW_SQL = {"p2_found", "p3_report"}


def test_sql_equivalence(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    clean = lambda v: float(v) if isinstance(v, Decimal) else v
    q, wrong = __spark_entry__.queries(), []
    for name, sql in __spark_entry__.oracle_sql().items():
        if name in SLOW_SQL:
            continue
        df = q[name](spark, sf)
        cols = sorted(df.columns)
        got = Counter(repr([clean(r[c]) for c in cols]) for r in df.collect())
        rel = con.sql(sql)
        assert sorted(rel.columns) == cols, name
        at = [rel.columns.index(c) for c in cols]
        if got != Counter(repr([clean(r[i]) for i in at]) for r in rel.fetchall()):
            wrong.append(name)
    assert not wrong
