"""SQL of the general problems' queries for DuckDB."""

from __future__ import annotations

from rillwork.plans.water_sql import bare

_NUMBER = "nullif(regexp_extract({0}::varchar, '(-?[0-9]+)\\D*$', 1), '')"


def number(c: str) -> str:
    return _NUMBER.format(c)


_P3 = f"""with r as (
  select 'mouthq_id' as field, {bare('id')} as id, 'wikidata' as target, {bare('mouthq_id')} as ref, loaded_at from fin_wikidata_waterways_ru
  union all select 'osm_id', {bare('id')}, 'relation', osm_id::varchar, loaded_at from fin_wikidata_waterways_ru
  union all select 'tributary_id_list', {bare('id')}, 'wikidata', {bare('t')}, loaded_at from (select id, unnest(tributary_id_list) as t, loaded_at from fin_wikidata_waterways_ru)),
p as (select 'wikidata' as target, {bare('id')} as ref, min(loaded_at) as came from fin_wikidata_waterways_ru group by all
  union all select 'wikidata', id, timestamp '0001-01-01' from wikidata_waterbodies
  union all select 'relation', rel_osm_id::varchar, min(loaded_at) from osm_relations group by all),
q as (select target, ref, min(came) as came from p group by all),
g as (select object_kind as target, case when object_kind = 'wikidata' then {bare('object_key')} else {number('object_key')} end as ref, min(deleted_at) as gone from object_deletions group by all),
s as (select field, id, r.ref, strftime(loaded_at, '%Y-%m') as period, case when gone <= loaded_at then 'deleted' when came is null then 'missing' when strftime(came, '%Y-%m') > strftime(loaded_at, '%Y-%m') then 'late' end as status
  from r left join q using (target, ref) left join g using (target, ref) where r.ref is not null)
select distinct field, id, ref, period, status from s where status is not null"""

_P2 = f"""with recursive w as (select distinct {bare('id')} as id, {bare('mouthq_id')} as parent from fin_wikidata_waterways_ru), ids as (select distinct id from w where id is not null),
l as (select id, min(parent) as parent from w where parent in (select id from ids) group by 1),
t as (select id, id as root, 0::bigint as depth, id as path from ids where id not in (select id from l)
  union all select l.id, t.root, t.depth + 1, t.path || '>' || l.id from t join l on l.parent = t.id),
n as (select a as id, count(*) as c from (select unnest(string_split(path, '>')[:-2]) as a from t) group by 1)
select ids.id, coalesce(t.root, 'cycle') as root_id, coalesce(t.depth, -1)::bigint as depth, coalesce(t.path, '') as path, case when t.id is null then -1 else coalesce(n.c, 0) end::bigint as n_descendants
from ids left join t using (id) left join n using (id)"""

_P1 = """with pos as (select distinct pnt_osm_id as id, geom.x as x, geom.y as y from graph_nodes where pnt_osm_id is not null and geom.x is not null and geom.y is not null),
near as (select distinct 'node' as kind, a.id as pnt_osm_id, b.id as other_id from pos a join pos b on a.id < b.id and b.x between a.x - 1500 and a.x + 1500 and b.y between a.y - 1500 and a.y + 1500
  where (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2250000),
seg as (select distinct way_osm_id as w, geom[i].x as x1, geom[i].y as y1, geom[i + 1].x as x2, geom[i + 1].y as y2 from (select *, unnest(range(1, len(geom))) as i from osm_ways where geom is not null and way_osm_id is not null)),
c as (select id, w, (x - x1)::hugeint as px, (y - y1)::hugeint as py, (x - x2)::hugeint as qx, (y - y2)::hugeint as qy, (x2 - x1)::hugeint as dx, (y2 - y1)::hugeint as dy from pos join seg
  on x between least(x1, x2) - 1500 and greatest(x1, x2) + 1500 and y between least(y1, y2) - 1500 and greatest(y1, y2) + 1500),
hit as (select distinct id, w from c where px * px + py * py <= 2250000 or qx * qx + qy * qy <= 2250000
  or (px * dx + py * dy > 0 and px * dx + py * dy < dx * dx + dy * dy and (px * dy - py * dx) * (px * dy - py * dx) <= 2250000 * (dx * dx + dy * dy))),
own as (select distinct way_osm_id as w, unnest(nodes) as id from osm_ways),
line as (select distinct way_osm_id as w, least(geom, list_reverse(geom)) as g from contours where geom is not null and way_osm_id is not null),
edge as (select w, g[i].x as x1, g[i].y as y1, g[i + 1].x as x2, g[i + 1].y as y2 from (select *, unnest(range(1, len(g))) as i from line)),
box as (select w, min(least(x1, x2)) as xa, max(greatest(x1, x2)) as xb, min(least(y1, y2)) as ya, max(greatest(y1, y2)) as yb from edge group by 1),
cand as (select id, x, y, w from pos join box on x between xa and xb and y between ya and yb),
t as (select id, x, y, cand.w, ((x2 - x1)::hugeint * (y - y1) - (x - x1)::hugeint * (y2 - y1)) as s, (y1 > y) <> (y2 > y) as cuts, y2 > y1 as up,
  x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2) as inbox from cand join edge on edge.w = cand.w),
area as (select id, w from t group by id, x, y, w having sum((cuts and ((s > 0) = up) and s <> 0)::int) % 2 = 1 and not bool_or(s = 0 and inbox))
select * from near union all select 'way', id, w from hit where not exists (select 1 from own where own.w = hit.w and own.id = hit.id) union all select distinct 'area', id, w from area"""

SQL = {
    "p1_found": _P1,
    "p2_found": _P2,
    "p3_found": _P3,
    "p3_report": f"select field, period, status, count(*)::bigint as n_refs, count(distinct ref)::bigint as n_keys from ({_P3}) group by 1, 2, 3",
}
