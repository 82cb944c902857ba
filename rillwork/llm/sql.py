"""SQL of the llm queries that SQL can express at the test scale."""

SQL = {
    "p6_found": """with recursive e as (select distinct pnt_osm_id as n, way_osm_id as w from graph_nodes_stat where pnt_osm_id is not null and way_osm_id is not null),
h as (select distinct x.w as a, y.w as b from e x join e y using (n)),
c(w, g) as (select distinct w, w from e union select h.b, c.g from c join h on h.a = c.w where c.g < h.b),
m as (select w, min(g) as g from c group by 1)
select n as pnt_osm_id, min(g) as group_id from e join m using (w) group by 1""",
}
