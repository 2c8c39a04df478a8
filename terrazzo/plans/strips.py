"""Registered queries on a raster that grows with its table, each with its SQL for DuckDB.

`strip` has one cell for each row of events, 64 columns wide and as high as that takes;
no row is folded away. Its classes lie in patches of 5 x 7 cells with cells of no data
between; its colours follow from the row's numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evidence, fits, lines, masks, regions, reports, textures
from .catalog import query, table

WIDTH = 64
STRIP = f"""strip as (select (event_id // {WIDTH})::int as y, (event_id % {WIDTH})::int as x, event_id as e, user_id as u, ((event_id * 37 + user_id * 101) % 256)::int as r, ((event_id * 7 + user_id * 13) % 256)::int as g, ((event_id * 3 + user_id * 29) % 256)::int as b,
 (case when user_id % 9 = 0 then 0 else (event_id // {WIDTH * 5} * 3 + event_id % {WIDTH} // 7 * 5) % 7 end)::int as class_id from events), size as (select max(y) + 1 as h from strip)"""


def strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    number = lambda c: c.cast("int")
    patch = (F.floor(e / (WIDTH * 5)) * 3 + F.floor(e % WIDTH / 7) * 5) % 7
    colours = [number((e * k + u * m) % 256).alias(n) for n, k, m in (("r", 37, 101), ("g", 7, 13), ("b", 3, 29))]
    return table(spark, sf_dir, "events").select(number(F.floor(e / WIDTH)).alias("y"), number(e % WIDTH).alias("x"), e.alias("e"), u.alias("u"), *colours, number(F.when(u % 9 == 0, 0).otherwise(patch)).alias("class_id"))


def high(cells: DataFrame) -> int:
    return cells.agg(F.max("y")).first()[0] + 1


def labelled(mask: str, connectivity: int = 8, source: str = "strip") -> str:
    """CTEs: m (y, x, id), lab (id, label), c (y, x, label), stats by label."""
    steps = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (connectivity == 8 or not (dy and dx))]
    offsets = ", ".join(f"({dy}, {dx})" for dy, dx in steps)
    return f"""m as (select y, x, y::bigint * 2147483648 + x as id from {source} where {mask}), o(dy, dx) as (values {offsets}), near as (select m.id as p, n.id as q from m, o, m n where n.y = m.y + dy and n.x = m.x + dx),
 reach(id, other) as (select id, id from m union select r.id, near.q from reach r join near on r.other = near.p), lab as (select id, min(other) as label from reach group by id), c as (select y, x, label from m join lab using (id)),
 stats as (select label, count(*) as area, min(y) as top, max(y) as bottom, min(x) as lft, max(x) as rgt, avg(y) as cy, avg(x) as cx, max(x) - min(x) + 1 as w, max(y) - min(y) + 1 as hh from c group by label)"""


def grown(mask: str, name: str) -> str:
    """CTEs of a 3 x 3 closing within the frame, as `name` (y, x)."""
    return f"""k(dy, dx) as (values {', '.join(f'({a}, {b})' for a in (-1, 0, 1) for b in (-1, 0, 1))}), fat as (select distinct y + dy as y, x + dx as x from strip, k, size where {mask} and y + dy between 0 and h - 1 and x + dx between 0 and {WIDTH - 1}),
 around as (select f.y, f.x, count(*) as n from fat f, k join fat g on g.y = f.y + dy and g.x = f.x + dx group by f.y, f.x), {name} as (select a.y, a.x from around a, size where n = (case when a.y in (0, h - 1) then 2 else 3 end) * (case when a.x in (0, {WIDTH - 1}) then 2 else 3 end))"""


TOUCHES = f"(top = 0 or lft = 0 or bottom = (select h from size) - 1 or rgt = {WIDTH - 1})"


@query("border_connected", f"with recursive {STRIP}, {labelled('class_id in (1, 2)')} select y, x, label from c join stats using (label) where {TOUCHES} and area >= 24")
def border_connected(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.border_connected(s.filter("class_id in (1, 2)"), high(s), WIDTH, least=24, share=0.0)


_STROKES = "((y % 20 = 7 and x % 32 < 20 and u % 9 <> 0) or u % 50 = 1)"


@query("long_lines", f"with recursive {STRIP}, {grown(_STROKES, 'shut')}, {labelled('true', 8, 'shut')} select y, x, label from c join stats using (label), size where area >= 12 and (w >= {WIDTH} * 0.2 or hh >= h * 0.2)")
def long_lines(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.long_lines(s.filter(_STROKES), high(s), WIDTH, share=0.2)


@query("blue_strokes", f"with {STRIP}, p as (select y, x, r, g, b, greatest(r, g, b) as v, greatest(r, g, b) - least(r, g, b) as d from strip) select y, x, (b >= 95 and b - r >= 35 and b - g >= 18 and g - r >= 8) as water from p where r < 128 or b >= 95")
def blue_strokes(spark, sf_dir):
    return strip(spark, sf_dir).filter("r < 128 or b >= 95").select("y", "x", masks.blue_water(F.col("r"), F.col("g"), F.col("b")).alias("water"))


@query("compact_ink", f"with recursive {STRIP}, {labelled('class_id = 3')}, ins as (select label, count(*) as ins from c where x between 10 and 30 group by label) select y, x, label from c join stats using (label) join ins using (label) where area between 3 and 240 and greatest(w, hh) <= 32 and greatest(w, hh) <= 6.0 * least(w, hh) and area >= 0.08 * w * hh and ins >= 0.7 * area")
def compact_ink(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.compact_ink(s.filter("class_id = 3"), s.filter("x between 10 and 30")).select("y", "x", "label")


_PINS = [("west", "x", "lft", "y", "cy"), ("east", "x", "rgt", "y", "cy"), ("north", "y", "top", "x", "cx"), ("south", "y", "bottom", "x", "cx")]


@query(
    "pin_points",
    f"with recursive {STRIP}, {labelled('class_id = 2')}, pins as (select label, 0 as k, 'center' as pin, cy as y, cx as x from stats"
    + "".join(f" union all select label, {k}, '{n}', y::double, x::double from (select label, y, x, row_number() over (partition by label order by abs({other} - {centre}), {other}) as rn from c join stats using (label) where {axis} = {edge}) where rn = 1" for k, (n, axis, edge, other, centre) in enumerate(_PINS, 1))
    + ") select label, pin, round(y, 6) as y, round(x, 6) as x from (select *, row_number() over (partition by label, round_even(y, 0), round_even(x, 0) order by k) as rn from pins) where rn = 1",
)
def pin_points(spark, sf_dir):
    cells = regions.components(strip(spark, sf_dir).filter("class_id = 2"))
    return masks.pin_points(cells).select("label", "pin", F.round("y", 6).alias("y"), F.round("x", 6).alias("x"))


_SPARSE = "(e // 2 * 7919) % 97 = 0"


@query("dotted_chains", f"with recursive {STRIP}, {labelled(_SPARSE)}, s as (select * from stats where area between 2 and 90 and w <= 20 and hh <= 20), p as (select a.label, b.cy - a.cy as dy, b.cx - a.cx as dx from s a, s b where sqrt(pow(b.cy - a.cy, 2) + pow(b.cx - a.cx, 2)) between 3 and 42), t as (select label, count(*) as n, avg(dy * dy) as yy, avg(dx * dx) as xx, avg(dy * dx) as xy from p group by label), r as (select label, n, (xx + yy) / 2 as mid, sqrt(pow((xx - yy) / 2, 2) + xy * xy) as root from t) select label, round((mid + root) / greatest(mid - root, 0.25), 6) as anisotropy from r where n >= 2 and (mid + root) / greatest(mid - root, 0.25) >= 3")
def dotted_chains(spark, sf_dir):
    return masks.dotted_chains(strip(spark, sf_dir).filter("floor(e / 2) * 7919 % 97 = 0")).withColumn("anisotropy", F.round("anisotropy", 6))


@query("isolated_dots", f"with recursive {STRIP}, {labelled('e * 7919 % 97 = 0')}, d as (select * from stats where w <= 2 and hh <= 2 and area <= 4 and greatest(w, hh) <= 1.5 * least(w, hh)), p as (select a.label, count(*) as n from d a, d b where a.label <> b.label and pow(b.cy - a.cy, 2) + pow(b.cx - a.cx, 2) <= 144 group by a.label) select d.label, area, cy, cx, n as neighbours from d join p using (label) where n >= 2")
def isolated_dots(spark, sf_dir):
    return masks.isolated_dots(strip(spark, sf_dir).filter("e * 7919 % 97 = 0"), width=2, height=2, area=4, reach=12.0)


_FLOOD = """free as (select y, x from strip where not ({line})), ext(y, x) as (select y, x from free, size where y in (0, h - 1) or x in (0, {right}) union select f.y, f.x from ext e join free f on (f.y = e.y and abs(f.x - e.x) = 1) or (f.x = e.x and abs(f.y - e.y) = 1))"""


@query("filled_holes", f"with recursive {STRIP}, free as (select yy::int as y, xx::int as x from size, range(1000000) a(yy), range({WIDTH}) b(xx) where yy < h and (yy, xx) not in (select (y, x) from strip where class_id in (1, 2, 3, 4, 5, 6))), k8(dy, dx) as (values (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)), ext(y, x) as (select y, x from free, size where y in (0, h - 1) or x in (0, {WIDTH - 1}) union select f.y, f.x from ext e, k8 join free f on f.y = e.y + dy and f.x = e.x + dx), ins as (select y, x from free where (y, x) not in (select (y, x) from ext)), {labelled('true', 8, 'ins')} select y, x from strip where class_id in (1, 2, 3, 4, 5, 6) union all select y, x from c join stats using (label), size where area <= greatest(8, round(h * {WIDTH} * 0.0012))")
def filled_holes(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.filled_holes(s.filter("class_id in (1, 2, 3, 4, 5, 6)"), high(s), WIDTH, least=8)


@query("supported_components", f"with recursive {STRIP}, {labelled('class_id = 5')}, n as (select label, count(*) as area, count(*) filter (u % 20 = 1) as observed from c join strip using (y, x) group by label) select label, area, observed from n where observed >= 1 and label <> (select label from n order by area desc, label limit 1)")
def supported_components(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.supported_components(s.filter("class_id = 5"), s.filter("u % 20 = 1"))


@query("enclosed_islands", f"with recursive {STRIP}, {labelled('class_id = 6 and x < 40', 4)}, s as (select * from stats where not {TOUCHES}), d as (select c.label, min(pow(c.y - t.y, 2) + pow(c.x - t.x, 2)) as d2 from c join s using (label) join strip t on t.x = 40 and t.y between c.y - 12 and c.y + 12 group by c.label), e as (select s.label, s.cx, quantile_cont(t.x, 0.02) as edge from s join d using (label) join strip t on t.x >= 40 and t.y between greatest(0, top - greatest(2, round_even(0.01 * (select h from size), 0))) and bottom + greatest(2, round_even(0.01 * (select h from size), 0)) where d2 <= 144 group by s.label, s.cx) select label from e where cx <= edge + greatest(2.0, 0.006 * {WIDTH})")
def enclosed_islands(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.enclosed_islands(s.filter("class_id = 6 and x < 40"), s.filter("x >= 40"), high(s), WIDTH, reach=12.0)


_LINE = "x = 30 or y % 40 = 20"
_SEED = "x = 45 and y % 50 < 10"


@query("snapped_water", f"with recursive {STRIP}, {_FLOOD.format(line='x = 30 or (y % 40 = 20 and x between 5 and 60)', right=WIDTH - 1)} select distinct e.y, e.x from ext e join strip s on s.y = e.y and s.x = e.x and s.class_id in (1, 2, 3) join strip t on {_SEED.replace('x', 't.x').replace('y', 't.y')} and pow(t.y - e.y, 2) + pow(t.x - e.x, 2) <= 64")
def snapped_water(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.snapped_water(s.filter(_SEED), s.filter("class_id in (1, 2, 3)"), s.filter("x = 30 or (y % 40 = 20 and x between 5 and 60)"), high(s), WIDTH, reach=8.0, grid=s)


@query("constrained_water", f"with {STRIP} select distinct s.y, s.x from strip s join strip t on {_SEED.replace('x', 't.x').replace('y', 't.y')} and pow(t.y - s.y, 2) + pow(t.x - s.x, 2) <= 36 where s.class_id > 0 and (s.r / 255.0) >= 0.25")
def constrained_water(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.constrained_water(s.filter(_SEED), s.filter("class_id > 0"), s.withColumn("share", F.col("r") / 255.0), reach=6.0, least=0.25)


@query("evidence_split", f"with {STRIP} select y, x, ((x < 40 or u % 5 = 0) and class_id > 0) as observed, (x < 40 and class_id > 0) as retained, (u % 5 = 0 and class_id > 0 and not x < 40) as removed from strip")
def evidence_split(spark, sf_dir):
    s = strip(spark, sf_dir).withColumns({"inside": F.expr("x < 40"), "wet": F.expr("u % 5 = 0")})
    return masks.evidence_split(s, before="class_id", interior="inside", water="wet").select("y", "x", "observed", "retained", "removed")


@query("restored_evidence", f"with {STRIP} select y, x, (u % 5 = 0 and class_id > 0) as restored, (x < 40 or (u % 5 = 0 and class_id > 0)) as inside, (u % 5 = 0 and class_id = 0) as wet from strip")
def restored_evidence(spark, sf_dir):
    s = strip(spark, sf_dir).withColumns({"inside": F.expr("x < 40"), "wet": F.expr("u % 5 = 0")})
    return masks.restored_evidence(s, interior="inside", water="wet", value="class_id").select("y", "x", "restored", "inside", "wet")


@query("chroma_compatible", f"with {STRIP}, p as (select y, x, r - 128 as a, g - 128 as b, class_id from strip where class_id in (1, 2)) select y, x, case class_id when 2 then true else sqrt(a * a + b * b) >= 50 * 0.3 and (a * 30 + b * 40) / greatest(sqrt(a * a + b * b) * 50, 1e-6) >= 0.7 end as fits from p")
def chroma_compatible(spark, sf_dir):
    s = strip(spark, sf_dir).filter("class_id in (1, 2)")
    a, b = F.col("r") - 128, F.col("g") - 128
    one, two = (masks.chroma_compatible(a, b, c, neutral=8.0, share=0.3, cosine=0.7) for c in ((30.0, 40.0), (3.0, 4.0)))
    return s.select("y", "x", F.when(F.col("class_id") == 1, one).otherwise(two).alias("fits"))


@query("source_coverage", f"with {STRIP} select y, x, (x * 1.5 - 8 between 0 and 79 and y * 0.5 - 3 between 0 and 59) as inside from strip")
def source_coverage(spark, sf_dir):
    return strip(spark, sf_dir).select("y", "x", masks.source_coverage(F.col("x") * 1.5 - 8, F.col("y") * 0.5 - 3, 80, 60).alias("inside"))


@query("hybrid_interior", f"with {STRIP}, land as (select * from strip where x between 6 + y % 5 and 58), cut as (select y, round_even(min(x) + 0.62 * (max(x) - min(x)), 0)::int as d from land where y between 3 and 79 group by y) select s.y, s.x from strip s join cut using (y) where class_id > 2 and x <= d union all select l.y, l.x from land l left join cut using (y) where d is null or x > d")
def hybrid_interior(spark, sf_dir):
    s = strip(spark, sf_dir)
    return masks.hybrid_interior(s.filter("x between 6 + y % 5 and 58"), s.filter("class_id > 2"), 3, 80)


@query("overlay_composite", f"with {STRIP}, o as (select y, x, r, g, b from strip where class_id = 1 union all select y, x, 255 - r, g, b from strip where u % 2 = 0 union all select y, x, r, 255 - g, 255 - b from strip where x < 20) select y, x, round_even(avg(r), 0)::int as r, round_even(avg(g), 0)::int as g, round_even(avg(b), 0)::int as b from o group by y, x")
def overlay_composite(spark, sf_dir):
    s = strip(spark, sf_dir)
    flip = lambda c: (255 - F.col(c)).alias(c)
    return masks.composite(s.filter("class_id = 1").select("y", "x", "r", "g", "b").unionByName(s.filter("u % 2 = 0").select("y", "x", flip("r"), "g", "b")).unionByName(s.filter("x < 20").select("y", "x", "r", flip("g"), flip("b"))))


_RENDERED, _SOURCE = "x = 20 and y % 2 = 0", "x = 18 + y % 7 and y % 3 <> 0"


@query("line_report", f"with {STRIP}, a as (select y, x from strip where {_RENDERED}), b as (select y, x from strip where {_SOURCE}), f as (select a.y, a.x, sqrt(min(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))) * 0.5 as d from a, b group by a.y, a.x), g as (select b.y, b.x, sqrt(min(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))) * 0.5 as d from b, a where b.y % 4 <> 1 group by b.y, b.x), p as (select count(*) as n, quantile_cont(d, 0.5) as median, quantile_cont(d, 0.9) as p90, avg((d <= 5)::int) as within_5, avg((d <= 8)::int) as within_8, avg((d <= 1)::int) as precision from f), q as (select count(*) as n_source, avg((d <= 1)::int) as recall from g) select n, n_source, round(median, 6) as median, round(p90, 6) as p90, round(within_5, 6) as within_5, round(within_8, 6) as within_8, round(precision, 6) as precision, round(recall, 6) as recall, round(2 * precision * recall / greatest(precision + recall, 1e-12), 6) as f1 from p, q")
def line_report(spark, sf_dir):
    s = strip(spark, sf_dir)
    out = lines.line_report(s.filter(_RENDERED), s.filter(_SOURCE), s.filter("y % 4 <> 1"), tolerance=1.0, scale=0.5)
    return out.select("n", "n_source", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@query("balanced_tail", f"with {STRIP} select floor(y * 5 / h)::int as row, (x * 4 // {WIDTH})::int as col, count(*) as n, round(quantile_cont(r / 16.0, 0.5), 6) as median, round(quantile_cont(r / 16.0, 0.9), 6) as p90, round(avg((r / 16.0 <= 8)::int), 6) as within_8, quantile_cont(r / 16.0, 0.9) <= 14.2 as passed from strip, size group by 1, 2 having count(*) >= 20")
def balanced_tail(spark, sf_dir):
    s = strip(spark, sf_dir).withColumn("d", F.col("r") / 16.0)
    out = lines.balanced_tail(s, "d", height=high(s), width=WIDTH, rows=5, columns=4, limit=14.2)
    return out.select("row", "col", "n", *[F.round(c, 6).alias(c) for c in ("median", "p90", "within_8")], "passed")


@query("corridor_agreement", f"with {STRIP}, a as (select y, x from strip where u % 31 = 0), b as (select y, x from strip where e % 29 = 0), p as (select count(*) as one, count(*) filter (exists (select 1 from b where abs(b.y - a.y) <= 2 and abs(b.x - a.x) <= 2)) as one_supported from a), q as (select count(*) as other, count(*) filter (exists (select 1 from a where abs(b.y - a.y) <= 2 and abs(b.x - a.x) <= 2)) as other_supported from b) select one, one_supported, other, other_supported, round(one_supported / one, 9) as one_share, round(other_supported / other, 9) as other_share from p, q")
def corridor_agreement(spark, sf_dir):
    s = strip(spark, sf_dir)
    out = lines.corridor_agreement(s.filter("u % 31 = 0"), s.filter("e % 29 = 0"))
    return out.withColumns({c: F.round(c, 9) for c in ("one_share", "other_share")})


@query("separation", f"with {STRIP}, a as (select y, x from strip where x < 8 and u % 7 = 0), b as (select y, x from strip where x > 40 and u % 7 = 0) select (select count(*) from a) as n, round(sqrt(min(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))), 6) as separation, (select count(*) from a join strip s using (y, x) where s.x > 6) as overlap, (select count(*) from a join strip s using (y, x) where s.x > 6) = 0 and sqrt(min(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))) >= 24 as passed from a, b where abs(a.y - b.y) < 40")
def separation(spark, sf_dir):
    s = strip(spark, sf_dir)
    out = lines.separation(s.filter("x < 8 and u % 7 = 0"), s.filter("x > 40 and u % 7 = 0"), s.filter("x > 6"))
    return out.select("n", F.round("separation", 6).alias("separation"), "overlap", "passed")


@query("match_consistency", f"with {STRIP}, m as (select (y // 16)::int as row, (x // 16)::int as col, (r % 11) / 2.0 as dx, (g % 13) / 3.0 as dy from strip where u % 4 <> 0), k as (select row, col, count(*) as support, quantile_cont(dx, 0.5) as mx, quantile_cont(dy, 0.5) as my from m group by row, col), o as (select m.*, support, sqrt(pow(dx - mx, 2) + pow(dy - my, 2)) as off from m join k using (row, col)), s as (select row, col, quantile_cont(off, 0.5) as mad from o group by row, col), g2 as (select o.row, o.col, dx, dy, support from o join s using (row, col) where off <= 1.2 * greatest(mad, 1.0)), k2 as (select row, col, max(support) as support, count(*) as robust, quantile_cont(dx, 0.5) as mx, quantile_cont(dy, 0.5) as my from g2 group by row, col), e2 as (select row, col, quantile_cont(sqrt(pow(dx - mx, 2) + pow(dy - my, 2)), 0.5) as mad from g2 join k2 using (row, col) group by row, col) select row, col, k2.support, robust, round(mx, 6) as mx, round(my, 6) as my, round(mad, 6) as mad, robust >= 40 and mad <= 1.6 as accepted from k2 join e2 using (row, col)")
def match_consistency(spark, sf_dir):
    s = strip(spark, sf_dir).select("y", "x", (F.col("r") % 11 / 2.0).alias("dx"), (F.col("g") % 13 / 3.0).alias("dy"), (F.col("u") % 4 != 0).alias("eligible"))
    out = lines.match_consistency(s, side=16, least=40, most=1.6, outlier=1.2)
    return out.select("row", "col", "support", "robust", *[F.round(c, 6).alias(c) for c in ("mx", "my", "mad")], "accepted")


_SUMMARY = "count(v) as n, round(quantile_cont(v, 0.5), 6) as median, round(quantile_cont(v, 0.9), 6) as p90, round(max(v), 6) as largest, round(sqrt(avg(v * v)), 6) as rms, round(avg((v <= 3)::int), 6) as within_3, round(avg((v <= 5)::int), 6) as within_5, round(avg((v <= 8)::int), 6) as within_8"


@query("profile_summary", f"with {STRIP}, p as (select class_id, (r - 128) / 12.0 as s, u % 3 <> 0 as ok from strip), w as (select class_id, 'all' as \"set\", abs(s) as v, s from p union all select class_id, 'accepted', abs(s), s from p where ok) select class_id, \"set\", {_SUMMARY}, round(quantile_cont(s, 0.5), 6) as signed_median from w group by class_id, \"set\"")
def profile_summary(spark, sf_dir):
    p = strip(spark, sf_dir).select("class_id", ((F.col("r") - 128) / 12.0).alias("s"), (F.col("u") % 3 != 0).alias("ok"))
    out = lines.profile_summary(p, "s", "ok", by=["class_id"])
    return out.select("class_id", "set", "n", *[F.round(c, 6).alias(c) for c in ("median", "p90", "largest", "rms", "within_3", "within_5", "within_8", "signed_median")])


_PATCH = "p as (select (e // 50) as id, 50 as points, r / 20.0 as d, u % 3 <> 0 as ok, ((e // 50) % 9) / 2.0 as shift, g / 255.0 as agree from strip), s as (select id, max(points) as points, max(shift) as shift, count(*) filter (ok) as used, avg(least(d, 12.0)) filter (ok) as mean, quantile_cont(d, 0.5) filter (ok) as median, quantile_cont(d, 0.9) filter (ok) as p90, avg((d <= 2.5)::int) filter (ok) as support, quantile_cont(agree, 0.5) filter (ok) as agreement from p group by id), t as (select id, used >= greatest(12, points // 2) as enough, used / points as valid_share, mean + 0.2 * least(p90, 12.0) - 1.75 * support + 0.012 * shift + 1.25 * (1 - agreement) as score, support, median, p90 from s)"


def _patches(spark, sf_dir) -> DataFrame:
    s = strip(spark, sf_dir)
    p = s.select(F.floor(F.col("e") / 50).alias("id"), F.lit(50).alias("points"), (F.col("r") / 20.0).alias("d"), (F.col("u") % 3 != 0).alias("ok"), (F.floor(F.col("e") / 50) % 9 / 2.0).alias("shift"), (F.col("g") / 255.0).alias("agree"))
    return lines.patch_score(p, ["id"], points="points", distance="d", valid="ok", shift=F.col("shift"), least=12, weight=0.012, direction="agree")


@query("patch_score", f"with {STRIP}, {_PATCH} select id, round(case when enough then score else 1e6 end, 6) as score, round(valid_share, 6) as valid_share, round(case when enough then support else 0 end, 6) as support, round(case when enough then median else 1e6 end, 6) as median, round(case when enough then p90 else 1e6 end, 6) as p90 from t")
def patch_score(spark, sf_dir):
    return _patches(spark, sf_dir).select("id", *[F.round(c, 6).alias(c) for c in ("score", "valid_share", "support", "median", "p90")])


@query("zero_shift", f"with {STRIP}, {_PATCH}, z as (select median as v from t where enough and valid_share >= 0.64 and id % 3 <> 1) select {_SUMMARY} from z")
def zero_shift(spark, sf_dir):
    s = _patches(spark, sf_dir)
    out = lines.zero_shift(s, least=0.64, accepted=s.filter("id % 3 <> 1"))
    return out.select("n", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("robust_loss", f"with {STRIP} select class_id, round(avg(least(r / 4.0, 20.0)), 6) as mean, round(quantile_cont(r / 4.0, 0.9), 6) as p90, round(avg((u % 8 <> 0)::int), 6) as visible, round(avg(least(r / 4.0, 20.0)) + 0.35 * least(quantile_cont(r / 4.0, 0.9), 100.0) + 30.0 * (1.0 - avg((u % 8 <> 0)::int)), 6) as loss from strip group by class_id")
def robust_loss(spark, sf_dir):
    out = lines.robust_loss(strip(spark, sf_dir).select("class_id", (F.col("r") / 4.0).alias("d"), (F.col("u") % 8 != 0).alias("i")), "d", "i", ["class_id"])
    return out.select("class_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("jacobian", f"with {STRIP}, d as (select (1.1 + 0.002 * (2 * x + 1)) * (0.9 - 0.004 * (2 * y + 1)) - (0.05 * 0.03) as d from strip where class_id > 0) select count(*) as n, round(min(d), 6) as least, round(quantile_cont(d, 0.5), 6) as median, round(max(d), 6) as largest, round(avg((d > 0)::int), 6) as positive, count(*) filter (d <= 0) as folds, round(min(d) / greatest(quantile_cont(d, 0.5), 1e-12), 6) as ratio from d")
def jacobian(spark, sf_dir):
    p = strip(spark, sf_dir).filter("class_id > 0").select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    out = lines.jacobian(p, lambda x, y: (1.1 * x + 0.002 * x * x + 0.03 * y, 0.9 * y - 0.004 * y * y + 0.05 * x))
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("least", "median", "largest", "positive")], "folds", F.round("ratio", 6).alias("ratio"))


@query("coast_controls", f"with {STRIP}, r as (select y, min(x) as x, (avg(r) - 140) / 4 as gap from strip where class_id > 0 group by y), w as (select k, (select min(y) from r) + ((select max(y) from r) - (select min(y) from r)) * k / 6.0 as goal from range(7) t(k)), n as (select k, y, x, row_number() over (partition by k order by abs(y - goal), y, x) as rn from r, w), c as (select y, min(x) as x from n where rn = 1 group by y) select c.y, c.x, round(quantile_cont(r.gap, 0.5), 6) as measured, round(greatest(-6.0, least(-1.0, quantile_cont(r.gap, 0.5))), 6) as shift from c join r on abs(r.y - c.y) <= 3 group by c.y, c.x")
def coast_controls(spark, sf_dir):
    rows = strip(spark, sf_dir).filter("class_id > 0").groupBy("y").agg(F.min("x").alias("x"), ((F.avg("r") - 140) / 4).alias("gap"))
    return evidence.coast_controls(rows, count=7, reach=3, low=1.0, high=6.0).select("y", "x", F.round("measured", 6).alias("measured"), F.round("shift", 6).alias("shift"))


@query("amplitude", f"with {STRIP}, w as (select (r - 160) / 8.0 as shift, least(greatest((x - 4.0) / 30.0, 0.0), 1.0) as a, least(greatest((y - 2.0) / 20.0, 0.0), 1.0) as b from strip where u % 3 = 0), v as (select -shift / (a * a * (3 - 2 * a) * b * b * (3 - 2 * b)) as v from w where a * a * (3 - 2 * a) * b * b * (3 - 2 * b) >= 0.4), m as (select count(*) as n, quantile_cont(v, 0.5) as median from v) select max(n) as n, round(max(median), 6) as median, round(quantile_cont(abs(v - median), 0.5), 6) as mad, floor(max(median) + 0.5)::int as amplitude from v, m")
def amplitude(spark, sf_dir):
    s = strip(spark, sf_dir).select(((F.col("r") - 160) / 8.0).alias("shift"), (F.col("u") % 3 == 0).alias("accepted"), "x", "y")
    out = evidence.amplitude(s, evidence.operation_weight(F.col("x"), F.col("y"), start=(4.0, 2.0), ramp=(30.0, 20.0)))
    return out.select("n", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"), "amplitude")


@query("paired_segments", f"with {STRIP}, p as (select e // 2 as seg, (r % 9)::double as shift, u % 4 <> 0 as ok, e % 2 as half from strip) select a.seg, a.shift as fit, a.ok as fit_passed, b.shift as holdout, b.ok as holdout_passed, abs(a.shift - b.shift) as difference, a.ok and b.ok and abs(a.shift - b.shift) <= 2 as accepted from p a join p b on a.seg = b.seg and a.half = 0 and b.half = 1")
def paired_segments(spark, sf_dir):
    s = strip(spark, sf_dir).select(F.floor(F.col("e") / 2).alias("seg"), (F.col("r") % 9).cast("double").alias("shift"), (F.col("u") % 4 != 0).alias("accepted"), F.when(F.col("e") % 2 == 0, "fit").otherwise("holdout").alias("half"))
    return evidence.paired(s, "seg")


@query("scale_modes", f"with {STRIP}, c as (select e, g as score, (1 + r)::double as scale from strip), f as (select * from c order by score, e limit 1), s as (select c.* from c, f where abs(ln(c.scale / f.scale)) >= 0.35 order by c.score, c.e limit 1) select e, score, scale from f union all select e, score, scale from s")
def scale_modes(spark, sf_dir):
    s = strip(spark, sf_dir).select("e", F.col("g").alias("score"), (1 + F.col("r")).cast("double").alias("scale"))
    return spark.createDataFrame([(m["e"], m["score"], m["scale"]) for m in evidence.scale_modes(s, order=["score", "e"], scale="scale")], "e long, score int, scale double")


_LABELS = "l as (select n_regionkey as row, case when n_nationkey % 7 = 3 then 'source: ' || n_name when n_nationkey % 11 = 5 then '--' else n_name end as label, case when n_nationkey % 4 = 0 then 'full-page-row-association' else 'crop' end as method, 60.0 + (n_nationkey * 17) % 40 as confidence, n_nationkey as k from nation)"


@query("label_candidates", f"with {_LABELS}, s as (select *, length(regexp_replace(label, '[^A-Za-z0-9]', '', 'g')) as n from l where not starts_with(lower(label), 'source') and length(regexp_replace(label, '[^A-Za-z0-9]', '', 'g')) > 0), t as (select * from (select *, max(n) over (partition by row) as most from s) where method <> 'full-page-row-association' or n >= ceil(most * 0.8)), q as (select * from (select *, max(confidence) over (partition by row) as sure from t) where confidence >= sure - 10) select row, label, method, confidence from (select *, row_number() over (partition by row order by n desc, confidence desc, k desc) as rn from q) where rn = 1")
def label_candidates(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    rows = n.select(F.col("n_regionkey").alias("row"), F.when(k % 7 == 3, F.concat(F.lit("source: "), "n_name")).when(k % 11 == 5, "--").otherwise(F.col("n_name")).alias("label"), F.when(k % 4 == 0, "full-page-row-association").otherwise("crop").alias("method"), (60.0 + k * 17 % 40).alias("confidence"), k.alias("k"))
    return evidence.label_candidates(rows, ["row"], order=[F.col("_n"), F.col("confidence"), F.col("k")])


@query("anchor_matches", f"with {STRIP}, s as (select e // 25 as id, (e % 25 % 5 - 2)::int as dx, (e % 25 // 5 - 2)::int as dy, r / 10.0 as score, g / 255.0 as support, b / 50.0 as median from strip), f as (select *, row_number() over (partition by id order by score, dy, dx, support, median) as rn from s), o as (select f.id, min(s.score) as runner_up from f join s on s.id = f.id and f.rn = 1 and pow(s.dx - f.dx, 2) + pow(s.dy - f.dy, 2) >= 4 group by f.id) select id, dx, dy, score, support, median, runner_up, support >= 0.3 and median <= 4 and coalesce(runner_up - score >= 0.4, true) as accepted from f left join o using (id) where rn = 1")
def anchor_matches(spark, sf_dir):
    k = F.col("e") % 25
    s = strip(spark, sf_dir).select(F.floor(F.col("e") / 25).alias("id"), (k % 5 - 2).cast("int").alias("dx"), (F.floor(k / 5) - 2).cast("int").alias("dy"), (F.col("r") / 10.0).alias("score"), (F.col("g") / 255.0).alias("support"), (F.col("b") / 50.0).alias("median"))
    return evidence.anchor_matches(s, "id", apart=2.0, least_support=0.3, most_median=4.0, margin=0.4)


@query("text_rows", "with w as (select custkey as page, line, l as lft, l + 3 as rgt from (select o_custkey % 40 as custkey, o_custkey % 3 as line, o_orderkey * 6 as l from orders)), b as (select *, case when lft - lag(rgt) over (partition by page, line order by lft) > 5000 then 1 else 0 end as broken from w), p as (select *, sum(broken) over (partition by page, line order by lft rows unbounded preceding) as part from b) select page, line, count(*) as words, max(rgt) as reach from p where part = 0 group by page, line")
def text_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("page"), (F.col("o_custkey") % 3).alias("line"), (F.col("o_orderkey") * 6).alias("left"), (F.col("o_orderkey") * 6 + 3).alias("right"))
    return evidence.text_rows(o, "page", gap=5000).groupBy("page", "line").agg(F.count("*").alias("words"), F.max("right").alias("reach"))


_GRID = f"(floor(y * 6 / h))::int as row, (x * 4 // {WIDTH})::int as col"


def _regional(spark, sf_dir) -> tuple[DataFrame, list]:
    s = strip(spark, sf_dir).withColumns({"again": F.when(F.col("u") % 13 == 0, 0).otherwise(F.col("class_id")), "differs": F.expr("u % 17 = 0"), "out": F.expr("e % 23 = 0"), "channel": F.expr("e % 3")})
    return s, [F.floor(F.col("y") * 6 / F.lit(high(s))).cast("int").alias("row"), F.floor(F.col("x") * 4 / WIDTH).cast("int").alias("col")]


_AGAIN = f"{STRIP}, a as (select *, case when u % 13 = 0 then 0 else class_id end as again, u % 17 = 0 as differs, e % 23 = 0 as out, e % 3 as channel, {_GRID} from strip, size)"


@query("regional_classes", f"with {_AGAIN}, s as (select row, col, count(*) filter (class_id > 0 and not out) as supported, count(*) filter (class_id > 0 and not out and again <> class_id) as roundtrip, count(*) filter (class_id > 0 and not out and differs) as semantic from a group by row, col) select *, round(roundtrip / greatest(supported, 1), 9) as roundtrip_share, round(semantic / greatest(supported, 1), 9) as semantic_share from s")
def regional_classes(spark, sf_dir):
    s, grid = _regional(spark, sf_dir)
    return reports.regional_classes(s, grid, source="class_id", again="again", differs="differs", excluded="out").withColumns({c: F.round(c, 9) for c in ("roundtrip_share", "semantic_share")})


@query("regional_channels", f"with {_AGAIN}, s as (select row, col, channel, count(*) filter (class_id > 0 and not out) as supported, count(*) filter (class_id > 0 and not out and again <> class_id) as mismatch from a group by row, col, channel) select *, round(mismatch / supported, 9) as share from s where supported > 0")
def regional_channels(spark, sf_dir):
    s, grid = _regional(spark, sf_dir)
    return reports.regional_channels(s, grid, channel="channel", source="class_id", again="again", excluded="out").withColumn("share", F.round("share", 9))


@query("channel_report", f"with {_AGAIN}, s as (select row, col, channel, count(*) filter (class_id > 0 and not out) as supported, count(*) filter (class_id > 0 and not out and again <> class_id) as mismatch from a group by row, col, channel) select channel, sum(supported)::bigint as supported, sum(mismatch)::bigint as mismatch, round(max(mismatch / supported), 9) as worst, round(sum(mismatch) / sum(supported), 9) as share from s where supported > 0 group by channel")
def channel_report(spark, sf_dir):
    s, grid = _regional(spark, sf_dir)
    out = reports.channel_report(reports.regional_channels(s, grid, channel="channel", source="class_id", again="again", excluded="out"), "channel")
    return out.withColumns({c: F.round(c, 9) for c in ("worst", "share")})


@query("binary_channels", f"with {_AGAIN}, s as (select row, col, channel, count(*) filter (class_id = 1 or again = 1) as either, count(*) filter (class_id = 1 and again = 1) as both_sides, count(*) filter ((class_id = 1) <> (again = 1)) as differing from a group by row, col, channel) select row, col, channel, either, both_sides as \"both\", differing, round(both_sides / either, 9) as iou from s where either > 0")
def binary_channels(spark, sf_dir):
    s, grid = _regional(spark, sf_dir)
    s = s.withColumns({"p": F.col("class_id") == 1, "q": F.col("again") == 1})
    return reports.binary_channels(s, grid, channel="channel", source="p", again="q").withColumn("iou", F.round("iou", 9))


@query("native_regions", f"with {STRIP}, b as (select s.*, (select count(*) from range(1, 6) k(i) where s.y >= round_even(i * h / 6.0, 0))::int as row, (select count(*) from range(1, 6) k(i) where s.x >= round_even(i * {WIDTH} / 6.0, 0))::int as col from strip s, size), t as (select row, col, count(*) as domain, count(*) filter (class_id > 0 and (u % 2 = 0 or e % 5 <> 0)) as classified, count(*) filter (u % 97 = 0) as mismatch from b where u % 9 <> 0 and class_id <> 0 or u % 45 = 0 group by row, col) select *, round(mismatch / domain, 9) as share, classified = domain and mismatch / domain <= 0.01 as passed from t")
def native_regions(spark, sf_dir):
    s = strip(spark, sf_dir).withColumns({"domain": F.expr("u % 9 <> 0 and class_id <> 0 or u % 45 = 0"), "observed": F.expr("u % 2 = 0"), "inferred": F.expr("e % 5 <> 0"), "mismatch": F.expr("u % 97 = 0")})
    return reports.native_regions(s, high(s), WIDTH, 6, 6, value="class_id", domain="domain", observed="observed", inferred="inferred", mismatch="mismatch").withColumn("share", F.round("share", 9))


@query("same_values", f"with {STRIP}, a as (select y, x, class_id, r from strip where e % 7 <> 0), b as (select y, x, case when u % 19 = 0 then null else class_id end as class_id, r from strip where e % 11 <> 0) select count(*) as cells, count(*) filter (b.y is null) as missing, count(*) filter (a.y is null) as extra, count(*) filter (a.y is not null and b.y is not null and a.class_id is distinct from b.class_id) as differs_class_id, count(*) filter (a.y is not null and b.y is not null and a.r is distinct from b.r) as differs_r, false as passed from a full join b on a.y = b.y and a.x = b.x")
def same_values(spark, sf_dir):
    s = strip(spark, sf_dir)
    return reports.same_values(s.filter("e % 7 <> 0"), s.filter("e % 11 <> 0").withColumn("class_id", F.when(F.col("u") % 19 != 0, F.col("class_id"))), ["class_id", "r"])


@query("mask_difference", f"with {STRIP}, a as (select y, x from strip where u % 6 = 0), b as (select y, x from strip where e % 6 = 0) select y, x, 'missing' as kind from (select * from a except select * from b) union all select y, x, 'extra' from (select * from b except select * from a)")
def mask_difference(spark, sf_dir):
    s = strip(spark, sf_dir)
    return reports.mask_difference(s.filter("u % 6 = 0"), s.filter("e % 6 = 0"))


@query("unclassified_ink", f"with {STRIP} select y, x from strip where x < 50 and class_id = 0 and (pow(r - 60, 2) + pow(g - 60, 2) + pow(b - 60, 2) <= 3600 or pow(r - 200, 2) + pow(g - 90, 2) + pow(b - 150, 2) <= 3600)")
def unclassified_ink(spark, sf_dir):
    return reports.unclassified_ink(strip(spark, sf_dir).withColumn("i", F.expr("x < 50")), [(60, 60, 60), (200, 90, 150)], value="class_id", inside="i", most=60.0).select("y", "x")


@query("attested_layers", f"with {STRIP} select e % 4 as layer, count(*) filter (class_id > 0) as classified, count(*) filter (class_id = 0 and u % 27 <> 0) as empty, 0 as outside from strip group by e % 4")
def attested_layers(spark, sf_dir):
    s = strip(spark, sf_dir).withColumns({"layer": F.expr("e % 4"), "i": F.expr("class_id > 0 or u % 27 <> 0")})
    return reports.attested(s, "layer", value="class_id", inside="i")


@query("same_layers", "with p as (select n_name as name from nation where n_nationkey % 3 <> 0), d as (select n_name as name from nation where n_nationkey % 4 <> 0) select name, 'plan' as side from (select * from p except select * from d) union all select name, 'published' from (select * from d except select * from p)")
def same_layers(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("name", F.col("n_name"))
    return reports.same_layers(n.filter("n_nationkey % 3 <> 0"), n.filter("n_nationkey % 4 <> 0"), "name")


@query("replaced_cells", f"with {STRIP}, w as (select y, x, case when e % 41 = 0 then 9 else class_id end as wanted, case when u % 37 = 0 then 8 when e % 41 = 0 then 9 else class_id end as found from strip) select y, x, wanted, found from w where wanted <> found")
def replaced_cells(spark, sf_dir):
    s = strip(spark, sf_dir)
    after = s.withColumn("class_id", F.expr("case when u % 37 = 0 then 8 when e % 41 = 0 then 9 else class_id end"))
    return reports.replaced(s, after, s.filter("e % 41 = 0").withColumn("class_id", F.lit(9)))


@query("ready_sets", "select n_nationkey as k, n_nationkey not in (select c_nationkey from customer where c_custkey % 9 = 0) as no_customer, n_nationkey not in (select s_nationkey from supplier where s_suppkey % 3 = 0) as no_supplier, n_nationkey in (select c_nationkey from customer where c_custkey % 9 = 0) and n_nationkey in (select s_nationkey from supplier where s_suppkey % 3 = 0) as ready from nation")
def ready_sets(spark, sf_dir):
    n, c, s = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    out = reports.ready(n.select(F.col("n_nationkey").alias("k")), {"customer": c.filter("c_custkey % 9 = 0").select(F.col("c_nationkey").alias("k")), "supplier": s.filter("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("k"))}, "k")
    return out.select("k", F.array_contains("missing", "customer").alias("no_customer"), F.array_contains("missing", "supplier").alias("no_supplier"), "ready")


@query("nonregression", f"with {STRIP}, l as (select e % 50 as s, r as p90, g as med from strip where e < 50), c as (select e % 50 as s, r as p90, g as med from strip where u % 3 = 0) select l.s, count(*) filter (c.p90 < l.p90 or c.p90 = l.p90 and c.med < l.med) as better, count(*) filter (c.p90 < l.p90 or c.p90 = l.p90 and c.med < l.med) = 0 as passed from l left join c using (s) group by l.s")
def nonregression(spark, sf_dir):
    s = strip(spark, sf_dir).select(F.expr("e % 50").alias("s"), F.col("r").alias("p90"), F.col("g").alias("med"), F.expr("u % 3 = 0").alias("accepted"), "e")
    return reports.nonregression(s.filter("e < 50"), s, "s", ["p90", "med"])


@query("failure_report", f"with {STRIP} select u % 30 as map, count(*) as attempts, min(r) as best, count(*) filter (g <= 60) as tail, count(*) filter (b <= 90) as line from strip group by u % 30")
def failure_report(spark, sf_dir):
    s = strip(spark, sf_dir).select(F.expr("u % 30").alias("map"), "r", F.create_map(F.lit("tail"), F.col("g") > 60, F.lit("line"), F.col("b") > 90).alias("gates"))
    out = reports.failure_report(s, "map", score="r", gates="gates")
    return out.select("map", "attempts", "best", *[F.coalesce(F.col("failed")[n], F.lit(0)).alias(n) for n in ("tail", "line")])


@query("progress_index", f"with {STRIP}, c as (select e % 5 as status, count(distinct u) as maps from strip group by 1) select status, maps, round(maps / (select sum(maps) from c), 9) as share from c")
def progress_index(spark, sf_dir):
    return reports.progress(strip(spark, sf_dir).withColumn("status", F.expr("e % 5")), "u", "status").withColumn("share", F.round("share", 9))


@query("source_boxes", f"with {STRIP}, m as (select (floor(y * 3 / h))::int as row, (x * 4 // {WIDTH})::int as col, x * 1.3 - 5 as u, y * 0.4 + x * 0.1 - 2 as v from strip, size) select row, col, count(*) as n, greatest(0, floor(min(u)) - 1)::int as lft, greatest(0, floor(min(v)) - 1)::int as top, least(70, ceil(max(u)) + 2)::int as rgt, least(60, ceil(max(v)) + 2)::int as bottom from m where u between 0 and 69 and v between 0 and 59 group by row, col")
def source_boxes(spark, sf_dir):
    s = strip(spark, sf_dir)
    # Decimals, as in the SQL: a place on a whole pixel mustn't fall beside it by a binary fraction.
    m = s.select("y", "x", F.expr("x * 1.3 - 5").alias("u"), F.expr("y * 0.4 + x * 0.1 - 2").alias("v"))
    grid = [F.floor(F.col("y") * 3 / F.lit(high(s))).cast("int").alias("row"), F.floor(F.col("x") * 4 / WIDTH).cast("int").alias("col")]
    return reports.source_boxes(m, grid, u="u", v="v", width=70, height=60).withColumnsRenamed({"left": "lft", "right": "rgt"})


_CONTROLS = "k as (select e, e % 5 as fold, x::double as x, y::double as y, 1.2 * x - 0.3 * y + 5 + r % 3 as u, 0.3 * x + 1.2 * y - 2 + g % 3 as v from strip)"


def _controls(spark, sf_dir) -> DataFrame:
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return strip(spark, sf_dir).select("e", (F.col("e") % 5).alias("fold"), x.alias("x"), y.alias("y"), (1.2 * x - 0.3 * y + 5 + F.col("r") % 3).alias("u"), (0.3 * x + 1.2 * y - 2 + F.col("g") % 3).alias("v"))


@query("similarity_fit", f"with {STRIP}, {_CONTROLS}, m as (select avg(x) as mx, avg(y) as my, avg(u) as mu, avg(v) as mv from k), s as (select sum((x - mx) * (u - mu) + (y - my) * (v - mv)) / sum(pow(x - mx, 2) + pow(y - my, 2)) as a, sum((x - mx) * (v - mv) - (y - my) * (u - mu)) / sum(pow(x - mx, 2) + pow(y - my, 2)) as b from k, m) select round(a, 6) as a, round(b, 6) as b, round(mu - a * mx + b * my, 5) as tx, round(mv - b * mx - a * my, 5) as ty from s, m")
def similarity_fit(spark, sf_dir):
    m = fits.similarity(_controls(spark, sf_dir))
    return spark.createDataFrame([(round(m[0][0], 6), round(m[1][0], 6), round(m[0][2], 5), round(m[1][2], 5))], "a double, b double, tx double, ty double")


_SOLVED = "(sxu * syy - syu * sxy) / (sxx * syy - sxy * sxy) as a, (syu * sxx - sxu * sxy) / (sxx * syy - sxy * sxy) as b, (sxv * syy - syv * sxy) / (sxx * syy - sxy * sxy) as c, (syv * sxx - sxv * sxy) / (sxx * syy - sxy * sxy) as d"
_COVERED = "var_pop(x) as sxx, var_pop(y) as syy, covar_pop(x, y) as sxy, covar_pop(x, u) as sxu, covar_pop(y, u) as syu, covar_pop(x, v) as sxv, covar_pop(y, v) as syv, avg(x) as mx, avg(y) as my, avg(u) as mu, avg(v) as mv"


@query("affine_coefficients", f"with {STRIP}, {_CONTROLS}, s as (select {_COVERED} from k), f as (select *, {_SOLVED} from s), t as (select mu, mv, mx, my, a, b, c, d, mu - a * mx - b * my as tx, mv - c * mx - d * my as ty from f) select round(a, 6) as a, round(b, 6) as b, round(tx, 5) as tx, round(c, 6) as c, round(d, 6) as d, round(ty, 5) as ty, round((select sqrt(avg(pow(a * x + b * y + tx - u, 2) + pow(c * x + d * y + ty - v, 2))) from k), 6) as rms from t")
def affine_coefficients(spark, sf_dir):
    k = _controls(spark, sf_dir)
    m = fits.affine(k)
    rms = fits.affine_residuals(k, m).agg(F.sqrt(F.avg(F.col("residual") * F.col("residual")))).first()[0]
    row = [round(m[0][0], 6), round(m[0][1], 6), round(m[0][2], 5), round(m[1][0], 6), round(m[1][1], 6), round(m[1][2], 5), round(rms, 6)]
    return spark.createDataFrame([tuple(row)], "a double, b double, tx double, c double, d double, ty double, rms double")


@query("model_residuals", f"with {STRIP}, {_CONTROLS}, d as (select fold, sqrt(pow((1.21 * x - 0.31 * y + 6) / (0.0001 * x + 1) - u, 2) + pow((0.3 * x + 1.19 * y - 1) / (0.0001 * x + 1) - v, 2)) as v from k) select fold, {_SUMMARY} from d group by fold")
def model_residuals(spark, sf_dir):
    out = fits.evaluate(_controls(spark, sf_dir), [[1.21, -0.31, 6.0], [0.3, 1.19, -1.0], [0.0001, 0.0, 1.0]], ["fold"])
    return out.select("fold", "n", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@query("held_out_folds", f"with {STRIP}, {_CONTROLS}, s as (select f.fold, {_COVERED} from (select distinct fold from k) f join k on k.fold <> f.fold group by f.fold), m as (select *, {_SOLVED} from s), d as (select k.fold, sqrt(pow(mu + a * (x - mx) + b * (y - my) - u, 2) + pow(mv + c * (x - mx) + d * (y - my) - v, 2)) as v from k join m using (fold)) select fold, {_SUMMARY.replace('6)', '5)')} from d group by fold")
def held_out_folds(spark, sf_dir):
    out = fits.held_out(_controls(spark, sf_dir), "fold")
    return out.select("fold", "n", *[F.round(c, 5).alias(c) for c in out.columns[2:]])


@query("texture_model", f"with {STRIP}, f as (select class_id, r / 4.0 as p, g / 8.0 as q from strip where class_id > 0), m as (select class_id, quantile_cont(p, 0.5) as mp, quantile_cont(q, 0.5) as mq from f group by class_id), d as (select class_id, mp, mq, sqrt(pow(p - mp, 2) + pow(q - mq, 2)) as d from f join m using (class_id)), n as (select class_id, quantile_cont(d, 0.5) as md from d group by class_id) select class_id, round(max(mp), 6) as p, round(max(mq), 6) as q, round(max(md) + 3 * quantile_cont(abs(d - md), 0.5), 6) as radius from d join n using (class_id) group by class_id")
def texture_model(spark, sf_dir):
    s = strip(spark, sf_dir).filter("class_id > 0").select("class_id", (F.col("r") / 4.0).alias("p"), (F.col("g") / 8.0).alias("q"))
    centres, radii, _ = textures.texture_model(s, "class_id", ["p", "q"])
    return spark.createDataFrame([(k, round(p, 6), round(q, 6), round(radii[k], 6)) for k, (p, q) in centres], "class_id int, p double, q double, radius double")


@query("learned_prototypes", f"with {STRIP}, b as (select class_id, round_even(r / 32.0, 0)::int as r, round_even(g / 32.0, 0)::int as g, count(*) as n from strip where class_id > 0 group by all), k as (select *, row_number() over (partition by class_id order by n desc, r, g) as rank from b) select class_id, rank, n, least(greatest(r * 32.0, 0.0), 255.0) as r, least(greatest(g * 32.0, 0.0), 255.0) as g from k where rank <= 12")
def learned_prototypes(spark, sf_dir):
    return textures.learned_prototypes(strip(spark, sf_dir).filter("class_id > 0"), "class_id", ["r", "g"], step=32.0, most=12)


_MARKS = "(e * 7919 % 23 = 0 or (y % 30 = 4 and x between 10 and 40))"


@query("dot_pattern", f"with recursive {STRIP}, {labelled(_MARKS)}, kept as (select c.y, c.x, label, round_even(cy, 0)::int as my, round_even(cx, 0)::int as mx from c join stats using (label) where area <= 6 and w <= 4 and hh <= 4), q as (select a.label, case when b.y < a.my and b.x < a.mx then 0 when b.y < a.my then 1 when b.x < a.mx then 2 else 3 end as q, count(*) as n from (select distinct label, my, mx from kept) a join kept b on ((b.y >= a.my - 9 and b.y < a.my - 2) or (b.y >= a.my + 2 and b.y < a.my + 9)) and ((b.x >= a.mx - 9 and b.x < a.mx - 2) or (b.x >= a.mx + 2 and b.x < a.mx + 9)) group by 1, 2), good as (select label from q where n >= 2 group by label having count(*) >= 3) select y, x, label from kept where label in (select label from good) and (select count(*) from kept d where abs(d.y - kept.y) <= 5 and abs(d.x - kept.x) <= 5) >= 4")
def dot_pattern(spark, sf_dir):
    return textures.dot_pattern(strip(spark, sf_dir).filter(_MARKS), area=6, side=4, radius=9, quadrants=3, least=2, window=11, crowd=4)


def _offsets(radius: int) -> str:
    return ", ".join(f"({dy}, {dx})" for dy, dx in textures.ellipse(radius))


_GAPS = f"""el(ey, ex) as (values {_offsets(2)}), rg(gy, gx) as (values {_offsets(1)}), fat as (select distinct y + ey as y, x + ex as x, class_id as k from strip, el, size where class_id > 0 and y + ey between 0 and h - 1 and x + ex between 0 and {WIDTH - 1}),
 hit as (select f.y + ey as y, f.x + ex as x, k, count(*) as n from fat f, el group by 1, 2, 3), need as (select s.y, s.x, count(*) as n from strip s, el, size where class_id = 0 and s.y + ey between 0 and h - 1 and s.x + ex between 0 and {WIDTH - 1} group by s.y, s.x),
 gaps as (select y + k * ((select h from size) + 2) as y, x, k from hit join need using (y, x, n))"""


@query("small_gaps", f"with recursive {STRIP}, {_GAPS}, {labelled('true', 8, 'gaps')}, cells as (select c.y - k * (h + 2) as y, c.x, k, label from c join gaps using (y, x), size), fit as (select label from cells group by label having count(*) <= 6 and greatest(max(y) - min(y), max(x) - min(x)) < 4), around as (select distinct label, k, y + gy as y, x + gx as x from cells join fit using (label), rg), votes as (select label, count(*) as n, avg((s.class_id = a.k)::int) as same from around a join strip s using (y, x) where s.class_id > 0 and (a.label, a.y, a.x) not in (select (label, y, x) from cells) group by label), good as (select * from cells where label in (select label from votes where n >= 3 and same >= 0.9)) select y, x, min(k) as class_id from good group by y, x having min(k) = max(k)")
def small_gaps(spark, sf_dir):
    s = strip(spark, sf_dir)
    return textures.small_gaps(s, high(s), WIDTH, radius=2, area=6, side=4, ring=1, least=3, share=0.9)
