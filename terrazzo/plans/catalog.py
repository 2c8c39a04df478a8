"""Registered queries of the raster operators, each with its SQL for DuckDB.

Rasters are derived from the driver's tables by arithmetic that both engines do
alike: `px` is one colour a cell of a 96 x 96 grid from lineitem, `cls` its nearest
legend class with some cells made no data.
"""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import colour, coordinates, values
from ..operators import audits, classify, completion, fits, lineage, ordered, overlay, polygons, ramps, regions, stencils, tiles, words
from ..sources import rasters
from ..streaming import logs
from . import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SIZE = 96
LEGEND = [(1, (60, 40, 40)), (2, (200, 60, 60)), (3, (60, 200, 60)), (4, (210, 210, 120)), (5, (130, 120, 220))]
MAX_DISTANCE, MIN_MARGIN = 0.98, 0.005
RAMP = [(0.0, (0.0, 0.0, 0.0)), (50.0, (120.0, 60.0, 30.0)), (100.0, (250.0, 250.0, 248.0))]
STOPS = [1.0, 5.0, 20.0, 50.0, 100.0]


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters.lineitem_pixels(spark, sf_dir, SIZE)


def cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(y, x, r, g, b, class_id): nearest legend colour, 0 on a regular pattern of cells."""
    named = classify.classify(px(spark, sf_dir), ["r", "g", "b"], LEGEND)
    gap = (F.col("x") * 7 + F.col("y") * 13) % 11 == 0
    return named.select("y", "x", "r", "g", "b", F.when(gap, F.lit(0)).otherwise(F.col("class_id")).alias("class_id"))


PX = f"""px as (select y, x, r, g, b from (select (l_orderkey % {SIZE})::int as y, (l_partkey % {SIZE})::int as x, (round(l_quantity)::bigint * 5)::int as r, (round(l_discount * 100)::bigint * 25)::int as g,
 (round(l_tax * 100)::bigint * 31)::int as b, row_number() over (partition by l_orderkey % {SIZE}, l_partkey % {SIZE} order by l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity), round(l_discount * 100), round(l_tax * 100)) as rn from lineitem) where rn = 1)"""
LEGEND_SQL = "legend(k, lr, lg, lb) as (values " + ", ".join(f"({k}, {r}, {g}, {b})" for k, (r, g, b) in LEGEND) + ")"
NEAR = f"{PX}, {LEGEND_SQL}, dist as (select y, x, r, g, b, k, (r - lr) * (r - lr) + (g - lg) * (g - lg) + (b - lb) * (b - lb) as d from px, legend), near as (select *, row_number() over (partition by y, x order by d, k) as rn, lead(d) over (partition by y, x order by d, k) as d2 from dist)"
CLS = f"{NEAR}, cls as (select y, x, r, g, b, case when (x * 7 + y * 13) % 11 = 0 then 0 else k end as class_id from near where rn = 1)"
CENTRES = """parts as (select label, i, avg(v::double) as m from (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as i from embeddings) group by label, i),
 vec as (select vec_id, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as i from embeddings),
 dist as (select vec_id, label, sqrt(sum((v - m) * (v - m))) as d from vec join parts using (i) group by vec_id, label),
 near as (select vec_id, label, d, row_number() over (partition by vec_id order by d, label) as rn, lead(d) over (partition by vec_id order by d, label) as d2 from dist)"""


def centred(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    centres = classify.class_centres(e, vector="embedding", label="label")
    vectors = e.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("embedding"))
    near = classify.vector_distances(vectors, centres, key="vec_id", vector="embedding", label="label", centre="centre")
    return classify.gate(near, key="vec_id", label="label", max_distance=F.lit(MAX_DISTANCE), min_margin=F.lit(MIN_MARGIN))


@query("classify_margin", f"with {CENTRES} select vec_id, label as nearest, round(d, 6) as d1, round(d2 - d, 6) as margin, case when d <= {MAX_DISTANCE} and d2 - d >= {MIN_MARGIN} then label else -1 end as class_id from near where rn = 1")
def classify_margin(spark, sf_dir):
    g = centred(spark, sf_dir)
    return g.select("vec_id", "nearest", F.round("d1", 6).alias("d1"), F.round(F.col("d2") - F.col("d1"), 6).alias("margin"), F.when(F.col("accepted"), F.col("nearest")).otherwise(F.lit(-1)).alias("class_id"))


_SETTINGS = [(d, m) for d in (0.96, 0.98, 1.0) for m in (0.002, 0.005, 0.01)]


@query("threshold_ensemble", f"with {CENTRES}, e as (select label, ({' + '.join(f'(case when d <= {d} and d2 - d >= {m} then 1 else 0 end)' for d, m in _SETTINGS)}) as s, (d <= 0.98 and d2 - d >= 0.005) as mid from near where rn = 1) select label as nearest, count(*) as n, sum((s = 9)::int)::bigint as always, sum((s = 0)::int)::bigint as never, sum(mid::int)::bigint as middle, sum((s > 0 and not mid)::int)::bigint as added, sum((s < 9 and mid)::int)::bigint as dropped from e group by label")
def threshold_ensemble(spark, sf_dir):
    e = classify.threshold_ensemble(centred(spark, sf_dir), distances=[0.96, 0.98, 1.0], margins=[0.002, 0.005, 0.01])
    return e.groupBy("nearest").agg(F.count("*").alias("n"), audits.count_if(F.col("always")).alias("always"), audits.count_if(F.col("never")).alias("never"), audits.count_if(F.col("middle")).alias("middle"), audits.count_if((F.col("settings") > 0) & ~F.col("middle")).alias("added"), audits.count_if((F.col("settings") < 9) & F.col("middle")).alias("dropped"))


@query("palette_nearest", f"with {NEAR} select y, x, k as nearest_id, round(sqrt(d), 6) as distance, case when sqrt(d) <= 90 and sqrt(d2) - sqrt(d) >= 8 then k else 0 end as class_id from near where rn = 1")
def palette_nearest(spark, sf_dir):
    step = lambda c: classify.classify(c, ["r", "g", "b"], LEGEND, max_distance=90.0, min_margin=8.0)
    return classify.by_distinct(px(spark, sf_dir), ["r", "g", "b"], step).select("y", "x", "nearest_id", F.round("distance", 6).alias("distance"), "class_id")


@query("exact_palette_mask", f"with {PX} select y, x, (r * 65536 + g * 256 + b) as code from px where (r, g, b) in (select (r, g, b) from px group by r, g, b having count(*) >= 4)")
def exact_palette_mask(spark, sf_dir):
    p = px(spark, sf_dir)
    often = p.groupBy("r", "g", "b").agg(F.count("*").alias("n")).filter("n >= 4")
    return p.join(often, ["r", "g", "b"], "left_semi").select("y", "x", colour.pack_rgb(F.col("r"), F.col("g"), F.col("b")).alias("code"))


@query("encode_decode", "with c as (select event_id, value, case when value is null then 0 else least(greatest(round_even((value - (-10.0)) / 0.05, 0) + 1, 1), 65535)::int end as code from events) select event_id, code, case when code > 0 then round(-10.0 + (code - 1) * 0.05, 6) end as decoded from c")
def encode_decode(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("code", values.encode(F.col("value"), -10.0, 0.05))
    return e.select("event_id", "code", F.round(values.decode(F.col("code"), -10.0, 0.05), 6).alias("decoded"))


@query("band_partition", f"select band_id, count(*) as n, round(min(value), 6) as low, round(max(value), 6) as high from (select value, ({' + '.join(f'(value >= {s})::int' for s in STOPS)}) as band_id from events where value is not null) group by band_id")
def band_partition(spark, sf_dir):
    b = ramps.band_id(table(spark, sf_dir, "events").filter(F.col("value").isNotNull()), "value", STOPS)
    return b.groupBy("band_id").agg(F.count("*").alias("n"), F.round(F.min("value"), 6).alias("low"), F.round(F.max("value"), 6).alias("high"))


def _segment(k: int) -> str:
    (v0, a), (v1, b) = RAMP[k], RAMP[k + 1]
    d = [q - p for p, q in zip(a, b, strict=True)]
    size = sum(x * x for x in d)
    dot = " + ".join(f"(c.{n} - {p}) * {q}" for n, p, q in zip("rgb", a, d, strict=True))
    t = f"least(greatest(({dot}) / {size}, 0.0), 1.0)"
    apart = " + ".join(f"pow(c.{n} - {p} - t * {q}, 2)" for n, p, q in zip("rgb", a, d, strict=True))
    return f"select y, x, {k} as k, {v0} + t * {v1 - v0} as v, {apart} as d from (select *, {t} as t from px c) c"


@query("ramp_projection", f"with {PX}, seg as (" + " union all ".join(_segment(k) for k in range(len(RAMP) - 1)) + "), best as (select *, row_number() over (partition by y, x order by round(d, 9), k) as rn from seg) select y, x, round(v, 4) as value, round(sqrt(d), 4) as residual from best where rn = 1")
def ramp_projection(spark, sf_dir):
    return ramps.project(px(spark, sf_dir), ["r", "g", "b"], RAMP).select("y", "x", F.round("value", 4).alias("value"), F.round("residual", 4).alias("residual"))


@query("ramp_inverse", "with s(v, r, g, b) as (values " + ", ".join(f"({v}, {int(c[0])}, {int(c[1])}, {int(c[2])})" for v, c in RAMP) + "), d as (select event_id, r, g, b, row_number() over (partition by event_id order by abs(value - v), -v) as rn from events, s where value is not null) select event_id, r, g, b from d where rn = 1")
def ramp_inverse(spark, sf_dir):
    return ramps.nearest_stop(table(spark, sf_dir, "events").filter(F.col("value").isNotNull()), "value", RAMP).select("event_id", "r", "g", "b")


@query("hue_bands", f"with {PX}, h as (select y, x, greatest(r, g, b) as v, least(r, g, b) as m, r, g, b from px), d as (select y, x, case when v = m then 0.0 when v = r then 60.0 * (g - b) / (v - m) when v = g then 120.0 + 60.0 * (b - r) / (v - m) else 240.0 + 60.0 * (r - g) / (v - m) end as deg from h), u as (select y, x, round_even(case when deg < 0 then deg + 360 else deg end / 2, 0) as h0 from d), w as (select y, x, (case when h0 >= 180 then h0 - 180 else h0 end)::int as hue from u), s as (select *, case when hue >= 150 then hue - 180 else hue end as warm from w), i as (select y, x, hue, unnest([1, 2, 3]) as k, unnest([greatest(-30 - warm, warm - 20, 0), greatest(35 - warm, warm - 85, 0), greatest(100 - warm, warm - 140, 0)]) as apart from s) select y, x, hue, k as class_id, apart as hue_distance from (select *, row_number() over (partition by y, x order by apart, k) as rn from i) where rn = 1")
def hue_bands(spark, sf_dir):
    p = px(spark, sf_dir)
    hue = colour.hsv(F.col("r"), F.col("g"), F.col("b"))[0]
    p = p.withColumn("hue", hue).withColumn("warm", colour.signed_warm_hue(F.col("hue")))
    return classify.hue_intervals(p, "warm", [(-30.0, 20.0), (35.0, 85.0), (100.0, 140.0)]).select("y", "x", "hue", "class_id", F.col("hue_distance").cast("int").alias("hue_distance"))


_LIN = lambda c: f"(case when {c} / 255.0 <= 0.04045 then {c} / 255.0 / 12.92 else pow(({c} / 255.0 + 0.055) / 1.055, 2.4) end)"
_ROW = lambda k: "(" + " + ".join(f"{_LIN(c)} * {w}" for c, w in zip("rgb", colour._XYZ[k], strict=True)) + f") / {colour._WHITE[k]}"
_CURVE = lambda t: f"(case when {t} > 0.008856 then pow({t}, 1.0 / 3) else 7.787 * {t} + 16.0 / 116 end)"


@query("lab_colours", f"with {PX}, c as (select distinct r, g, b from px), t as (select r, g, b, {_ROW(0)} as tx, {_ROW(1)} as ty, {_ROW(2)} as tz from c) select r, g, b, round(case when ty > 0.008856 then 116 * {_CURVE('ty')} - 16 else 903.3 * ty end, 3) as l, round(500 * ({_CURVE('tx')} - {_CURVE('ty')}), 3) as a, round(200 * ({_CURVE('ty')} - {_CURVE('tz')}), 3) as lab_b from t")
def lab_colours(spark, sf_dir):
    c = px(spark, sf_dir).select("r", "g", "b").distinct()
    light, a, b = colour.lab(F.col("r"), F.col("g"), F.col("b"))
    return c.select("r", "g", "b", F.round(light, 3).alias("l"), F.round(a, 3).alias("a"), F.round(b, 3).alias("lab_b"))


@query("blue_water_mask", f"with {PX} select y, x from px where b >= 60 and b - r >= 18 and b - g >= 7")
def blue_water_mask(spark, sf_dir):
    b, r, g = F.col("b"), F.col("r"), F.col("g")
    return px(spark, sf_dir).filter((b >= 60) & (b - r >= 18) & (b - g >= 7)).select("y", "x")


_INKS = [(40.0, 10.0), (-20.0, 45.0), (5.0, -50.0)]


@query("chroma_unmixing", None)
def chroma_unmixing(spark, sf_dir):
    p = px(spark, sf_dir).select("y", "x", (F.col("r") - F.col("g")).cast("double").alias("a"), (F.col("g") - F.col("b")).cast("double").alias("c"))
    return classify.unmix(p, "a", "c", _INKS, penalty=3.0, least=0.25, worst=60.0, chroma=5.0).select("y", "x", "inks", F.round("residual", 6).alias("residual"))


@query("top_colours", "with c as (select lang, source, count(*) as n from documents group by lang, source), r as (select *, sum(n) over (partition by lang) as t, row_number() over (partition by lang order by n desc, source) - 1 as rank from c) select lang, source, rank::int as rank, round(n / t, 9) as share from r where rank < 4")
def top_colours(spark, sf_dir):
    d = classify.colour_distribution(table(spark, sf_dir, "documents").select("lang", "source"), ["lang"], "source", 4)
    return d.select("lang", "source", "rank", F.round("share", 9).alias("share"))


_BOUNDS = lambda c, n: " + ".join(f"({c} >= {round(k * SIZE / n)})::int" for k in range(1, n))


@query("cell_metrics", f"with {CLS} select {_BOUNDS('y', 7)} as row, {_BOUNDS('x', 5)} as col, count(*) as domain, sum((class_id > 0)::int)::bigint as observed, sum((class_id in (1, 3))::int)::bigint as matched, round(sum((class_id > 0)::int) / count(*), 9) as observed_share, round(sum((class_id in (1, 3))::int) / count(*), 9) as matched_share from cls group by 1, 2 having count(*) >= 20")
def cell_metrics(spark, sf_dir):
    m = audits.grid_metrics(cls(spark, sf_dir), height=SIZE, width=SIZE, rows=7, columns=5, domain=F.lit(True), observed=F.col("class_id") > 0, matched=F.col("class_id").isin(1, 3), least=20)
    return m.withColumns({c: F.round(c, 9) for c in ("observed_share", "matched_share")})


_STATE, _EVID = "(y between 4 and 90 and x between 3 and 92)", "(r >= 60 or class_id > 0)"


@query("coverage_audit", f"with {CLS}, f as (select *, {_STATE} as s, {_EVID} as e from cls), c as (select m, sum(s::int)::bigint as domain, sum((s and class_id = 0)::int)::bigint as unclassified, sum((e and class_id = 0)::int)::bigint as dropped, sum((class_id > 0 and not e)::int)::bigint as unsupported, sum((class_id > 0 and not s)::int)::bigint as outside from f, (values ('full'), ('sparse')) t(m) group by m) select m as mode, domain, unclassified, dropped, unsupported, outside, dropped = 0 and outside = 0 and (case when m = 'sparse' then unsupported = 0 else unclassified = 0 end) as passed from c")
def coverage_audit(spark, sf_dir):
    c = cls(spark, sf_dir).withColumns({"state": F.expr(_STATE), "evidence": F.expr(_EVID)})
    one = lambda sparse: audits.coverage(c, value="class_id", state="state", evidence="evidence", sparse=sparse).withColumn("mode", F.lit("sparse" if sparse else "full"))
    return one(False).unionByName(one(True)).select("mode", "domain", "unclassified", "dropped", "unsupported", "outside", "passed")


@query("transition_matrix", f"with {CLS}, two as (select class_id as old, case when r > 120 then class_id else 0 end as new from cls) select old, new, count(*) as n from two where old <> new group by old, new")
def transition_matrix(spark, sf_dir):
    c = cls(spark, sf_dir)
    return audits.transitions(c, c.withColumn("class_id", F.when(F.col("r") > 120, F.col("class_id")).otherwise(F.lit(0))))


@query("precedence_compose", f"with {CLS}, l as (select y, x, class_id, 0 as k, 'observed' as origin from cls where r > 100 and class_id > 0 union all select y, x, class_id, 1, 'inferred' from cls where g > 100 and class_id > 0 union all select y, x, 5, 2, 'manual' from cls where (y + x) % 17 = 0) select y, x, class_id, origin from (select *, row_number() over (partition by y, x order by k) as rn from l) where rn = 1")
def precedence_compose(spark, sf_dir):
    c = cls(spark, sf_dir)
    manual = c.filter((F.col("y") + F.col("x")) % 17 == 0).withColumn("class_id", F.lit(5))
    return overlay.compose([("observed", c.filter("r > 100")), ("inferred", c.filter("g > 100")), ("manual", manual)])


@query("overlay_signature", f"with {PX}, f as (select y, x, r > 125 as a, g > 100 as b, b > 120 as c from px) select (a::int + 2 * b::int + 4 * c::int) as signature, count(*) as n, round(min(y * 96 + x), 0)::bigint as first_cell from f group by 1")
def overlay_signature(spark, sf_dir):
    f = px(spark, sf_dir).select("y", "x", (F.col("r") > 125).alias("fa"), (F.col("g") > 100).alias("fb"), (F.col("b") > 120).alias("fc"))
    return f.groupBy(overlay.signature(["fa", "fb", "fc"]).alias("signature")).agg(F.count("*").alias("n"), F.min(F.col("y") * 96 + F.col("x")).cast("long").alias("first_cell"))


@query("channel_iou", f"with {PX}, f as (select {_BOUNDS('y', 3)} as row, {_BOUNDS('x', 3)} as col, r > 125 as a, g > 100 as b from px) select row, col, round(sum((a and b)::int) / sum((a or b)::int), 9) as iou from f group by row, col")
def channel_iou(spark, sf_dir):
    p = px(spark, sf_dir)
    return p.groupBy(values.cell(F.col("y"), SIZE, 3).alias("row"), values.cell(F.col("x"), SIZE, 3).alias("col")).agg(F.round(overlay.iou(F.col("r") > 125, F.col("g") > 100), 9).alias("iou"))


@query("tolerant_scores", f"with {PX}, t as (select y, x from px where r > 200), f as (select y, x from px where g > 200), s as (select (select count(*) from t) as nt, (select count(*) from f) as nf, (select count(*) from t join f using (y, x)) as nb, (select count(*) from t where exists (select 1 from f where abs(f.y - t.y) <= 1 and abs(f.x - t.x) <= 1)) as th, (select count(*) from f where exists (select 1 from t where abs(f.y - t.y) <= 1 and abs(f.x - t.x) <= 1)) as fh), r as (select nb / (nt + nf - nb) as iou, fh / nf as p, th / nt as q from s) select round(iou, 9) as iou, round(p, 9) as \"precision\", round(q, 9) as recall, round(2 * p * q / (p + q), 9) as f1 from r")
def tolerant_scores(spark, sf_dir):
    p = px(spark, sf_dir)
    s = audits.tolerant_scores(p.filter("r > 200"), p.filter("g > 200"))
    return s.select(*[F.round(c, 9).alias(c) for c in s.columns])


@query("palette_variation", "with c as (select lang, source, count(*) as n from documents group by 1, 2), p as (select lang, source, n / sum(n) over (partition by lang) as p from c), l as (select distinct lang from c), u as (select a.lang as a, b.lang as b, s.source from l a, l b, (select distinct source from c) s where a.lang < b.lang) select u.a, u.b, round(0.5 * sum(abs(coalesce(x.p, 0) - coalesce(y.p, 0))), 9) as tv from u left join p x on x.lang = u.a and x.source = u.source left join p y on y.lang = u.b and y.source = u.source group by u.a, u.b")
def palette_variation(spark, sf_dir):
    c = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return audits.total_variation(c, "lang", "source").withColumn("tv", F.round("tv", 9))


@query("shared_palette", "with c as (select lang, source, count(*) as n from documents group by 1, 2), p as (select lang, source, n / sum(n) over (partition by lang) as p from c) select source, round(min(p), 9) as least_share from p group by source having count(*) = (select count(distinct lang) from c) and min(p) >= 0.005")
def shared_palette(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = d.groupBy("lang", "source").agg(F.count("*").alias("n"))
    return audits.shared_palette(c, "lang", "source", d.agg(F.count_distinct("lang")).first()[0]).withColumn("least_share", F.round("least_share", 9))


@query("confusable_groups", "with recursive e as (select n_nationkey as a, (n_nationkey * 7 + 3) % 25 as b from nation where n_nationkey % 3 = 0), both_ways as (select a, b from e union all select b, a from e), reach(node, other) as (select a, b from both_ways union select r.node, w.b from reach r join both_ways w on r.other = w.a) select node, least(node, min(other)) as group_id from reach group by node")
def confusable_groups(spark, sf_dir):
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 3 = 0")
    return audits.confusable_groups(n.select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 7 + 3) % 25).alias("b")))


@query("contingency", "with o as (select o_orderpriority as p, o_orderstatus as s, count(*) as o from orders group by 1, 2), t as (select *, sum(o) over (partition by p) as r, sum(o) over (partition by s) as c, sum(o) over () as t from o) select round(sum(o * o * t / (r * c)) - max(t), 4) as chi2, (count(distinct p) - 1) * (count(distinct s) - 1) as dof from t")
def contingency(spark, sf_dir):
    c = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return audits.chi_square(c, "o_orderpriority", "o_orderstatus").withColumn("chi2", F.round("chi2", 4))


@query("tile_index", "with p as (select event_id, (event_id * 37 % 3600) / 10.0 - 180 as lon, (event_id * 53 % 1600) / 10.0 - 80 as lat from events), t as (select event_id, floor((lon + 180) / 360 * 512)::bigint as tx, floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 512)::bigint as ty from p) select tx, ty, count(*) as n from t group by tx, ty")
def tile_index(spark, sf_dir):
    p = table(spark, sf_dir, "events").select((F.col("event_id") * 37 % 3600 / 10.0 - 180).alias("lon"), (F.col("event_id") * 53 % 1600 / 10.0 - 80).alias("lat"))
    tx, ty = coordinates.tile_of(F.col("lon"), F.col("lat"), F.lit(9))
    return p.groupBy(tx.alias("tx"), ty.alias("ty")).agg(F.count("*").alias("n"))


@query("mercator_roundtrip", f"with p as (select event_id, (event_id * 37 % 3600) / 10.0 - 180 as lon, (event_id * 53 % 1600) / 10.0 - 80 as lat from events), m as (select event_id, radians(lon) * {coordinates.RADIUS} as mx, ln(tan(pi() / 4 + radians(lat) / 2)) * {coordinates.RADIUS} as my from p) select event_id, round(mx, 3) as mx, round(my, 3) as my, round(degrees(mx / {coordinates.RADIUS}), 6) as lon, round(degrees(2 * atan(exp(my / {coordinates.RADIUS})) - pi() / 2), 6) as lat from m")
def mercator_roundtrip(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 37 % 3600 / 10.0 - 180).alias("lon"), (F.col("event_id") * 53 % 1600 / 10.0 - 80).alias("lat"))
    mx, my = coordinates.to_mercator(F.col("lon"), F.col("lat"))
    m = p.select("event_id", mx.alias("mx"), my.alias("my"))
    lon, lat = coordinates.to_wgs84(F.col("mx"), F.col("my"))
    return m.select("event_id", F.round("mx", 3).alias("mx"), F.round("my", 3).alias("my"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


_DOMINANT = lambda f: f"select ty, tx, class_id, round_even(255.0 * covered / {f * f}, 0)::int as alpha from (select (y // {f})::int as ty, (x // {f})::int as tx, class_id, row_number() over (partition by y // {f}, x // {f} order by count(*) desc, class_id) as rn, sum(count(*)) over (partition by y // {f}, x // {f}) as covered from cls where class_id > 0 group by y // {f}, x // {f}, class_id) where rn = 1"


@query("tile_dominant", f"with {CLS} {_DOMINANT(4)}")
def tile_dominant(spark, sf_dir):
    return tiles.dominant(cls(spark, sf_dir), 4)


@query("tile_pyramid", f"with {CLS}, l as (" + " union all ".join(f"select {k} as level, * from ({_DOMINANT(1 << k)})" for k in range(4)) + ") select level, ty, tx, class_id, alpha from l")
def tile_pyramid(spark, sf_dir):
    return tiles.pyramid(cls(spark, sf_dir).select("y", "x", "class_id"), 4).select("level", "ty", "tx", "class_id", "alpha")


@query("tile_mean_colour", f"with {CLS} select (y // 8)::int as ty, (x // 8)::int as tx, floor(sum(r) / count(*))::int as r, floor(sum(g) / count(*))::int as g, floor(sum(b) / count(*))::int as b, round_even(255.0 * count(*) / 64, 0)::int as alpha from cls where class_id > 0 group by 1, 2")
def tile_mean_colour(spark, sf_dir):
    return tiles.mean_colour(cls(spark, sf_dir), 8, F.col("class_id") > 0)


@query("tile_sample", f"with {CLS}, t as (select (i // 40)::int as y, (i % 40)::int as x from range(1600) r(i)) select t.y, t.x, class_id from t join cls c on c.y = floor((t.y + 0.5) * 96 / 40) and c.x = floor((t.x + 0.5) * 96 / 40)")
def tile_sample(spark, sf_dir):
    return tiles.sample(cls(spark, sf_dir).select("y", "x", "class_id"), 40, 40, SIZE, SIZE, rasters.grid(spark, 40, 40)).select("y", "x", "class_id")


@query("warp_nearest", f"with {CLS}, t as (select (i // 64)::int as y, (i % 64)::int as x from range(4096) r(i)), m as (select y, x, (1.2 * x + 0.1 * y + 3) / (1 + 0.0005 * x) as sx, (0.05 * x + 1.3 * y + 2) / (1 + 0.0005 * x) as sy from t) select m.y, m.x, class_id from m join cls c on c.x = round_even(sx, 0) and c.y = round_even(sy, 0)")
def warp_nearest(spark, sf_dir):
    sx, sy = coordinates.homography(F.col("x"), F.col("y"), [[1.2, 0.1, 3], [0.05, 1.3, 2], [0.0005, 0, 1]])
    m = rasters.grid(spark, 64, 64).select(F.col("y").alias("ty"), F.col("x").alias("tx"), F.rint(sx).cast("int").alias("x"), F.rint(sy).cast("int").alias("y"))
    return m.join(cls(spark, sf_dir), ["y", "x"]).select(F.col("ty").alias("y"), F.col("tx").alias("x"), "class_id")


@query("local_displacement", "with t as (select (i // 64)::int as y, (i % 64)::int as x from range(4096) r(i)), c(cx, cy, ux, uy) as (values (16.0, 20.0, 3.0, -1.0), (40.0, 44.0, -2.0, 2.5)), d as (select y, x, sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) / 30.0 as r, ux, uy from t, c), w as (select y, x, case when r < 1 then pow(1 - r, 4) * (4 * r + 1) else 0.0 end as w, ux, uy from d) select y, x, round(sum(w * ux), 6) + 0.0 as dx, round(sum(w * uy), 6) + 0.0 as dy from w group by y, x")
def local_displacement(spark, sf_dir):
    g = rasters.grid(spark, 64, 64)
    dx, dy = F.lit(0.0), F.lit(0.0)
    for cx, cy, ux, uy in ((16.0, 20.0, 3.0, -1.0), (40.0, 44.0, -2.0, 2.5)):
        w = coordinates.wendland(F.sqrt((F.col("x") - cx) * (F.col("x") - cx) + (F.col("y") - cy) * (F.col("y") - cy)), 30.0)
        dx, dy = dx + w * ux, dy + w * uy
    return g.select("y", "x", (F.round(dx, 6) + 0.0).alias("dx"), (F.round(dy, 6) + 0.0).alias("dy"))


@query("resolution_factors", "with p as (select a.i * 4.0 as x, b.i * 4.0 as y from range(25) a(i), range(25) b(i)), j as (select x, y, 1.1 + 0.002 * y as a, 0.002 * x + 0.05 as b, 0.03 as c, 1.4 - 0.001 * y as d from p), s as (select sqrt((a * a + b * b + c * c + d * d + sqrt(pow(a * a + b * b - c * c - d * d, 2) + 4 * pow(a * c + b * d, 2))) / 2) as top from j) select round(quantile_cont(top, 0.95), 6) as p95, case when 1.1 * quantile_cont(top, 0.95) <= 1 then 1 else least(greatest(ceil(1.1 * quantile_cont(top, 0.95)), 2), 4)::int end as factor from s")
def resolution_factors(spark, sf_dir):
    p = rasters.grid(spark, 25, 25).select((F.col("x") * 4.0).alias("x"), (F.col("y") * 4.0).alias("y"))
    a, b, c, d = 1.1 + 0.002 * F.col("y"), 0.002 * F.col("x") + 0.05, F.lit(0.03), 1.4 - 0.001 * F.col("y")
    top = F.sqrt((a * a + b * b + c * c + d * d + F.sqrt(F.pow(a * a + b * b - c * c - d * d, F.lit(2)) + 4 * F.pow(a * c + b * d, F.lit(2)))) / 2)
    q = p.agg(F.percentile(top, F.lit(0.95)).alias("q"))
    return q.select(F.round("q", 6).alias("p95"), F.when(1.1 * F.col("q") <= 1, 1).otherwise(F.least(F.greatest(F.ceil(1.1 * F.col("q")), F.lit(2)), F.lit(4))).cast("int").alias("factor"))


_NEAREST = f"{CLS}, u as (select y, x from cls where class_id = 0), k as (select y as ky, x as kx, class_id from cls where class_id > 0), d as (select u.y, u.x, ky, kx, class_id, (u.y - ky) * (u.y - ky) + (u.x - kx) * (u.x - kx) as d2 from u, k where abs(u.y - ky) <= 12 and abs(u.x - kx) <= 12), o as (select *, row_number() over (partition by y, x order by d2, ky, kx) as rn from d)"


@query("nearest_fill", f"with {_NEAREST} select y, x, d2, ky, kx, class_id from o where rn = 1")
def nearest_fill(spark, sf_dir):
    c = cls(spark, sf_dir).select("y", "x", "class_id")
    return completion.nearest_fill(c, c.filter("class_id = 0")).select("y", "x", "d2", "ky", "kx", "class_id")


@query("neighbour_vote", f"with {_NEAREST}, v as (select y, x, class_id, sum(1 / ((sqrt(d2) + 0.5) * (sqrt(d2) + 0.5))) as w from o where rn <= 16 group by y, x, class_id), r as (select *, sum(w) over (partition by y, x) as t, row_number() over (partition by y, x order by round(w, 12) desc, class_id) as rn from v) select y, x, class_id, round_even(255 * round(w, 12) / t, 0)::int as confidence from r where rn = 1")
def neighbour_vote(spark, sf_dir):
    c = cls(spark, sf_dir).select("y", "x", "class_id")
    return completion.neighbour_vote(c, c.filter("class_id = 0"))


_BOXES = [(1, 10, 12, 14, 6), (2, 40, 50, 20, 8), (3, 70, 20, 10, 10)]


@query("box_occlusions", f"with {CLS}, w(seq, l, t, w, h) as (values {', '.join(map(str, _BOXES))}), g as (select seq, l - 2 as x0, l + w + 2 as x1, t - 2 as y0, t + h + 2 as y1 from w), n as (select g.*, y, x, class_id from g join cls on y >= y0 - 5 and y < y1 + 5 and x >= x0 - 5 and x < x1 + 5), v as (select seq, class_id, count(*) as n, sum(count(*)) over (partition by seq) as t, row_number() over (partition by seq order by count(*) desc, class_id) as rn from n where class_id > 0 group by seq, class_id), m as (select seq, class_id as k from v where rn = 1 and n >= 0.2 * t), f as (select y, x, k, row_number() over (partition by y, x order by n.seq, k) as rn from n join m using (seq) where n.class_id = 0 and y >= y0 and y < y1 and x >= x0 and x < x1) select y, x, k as class_id from f where rn = 1")
def box_occlusions(spark, sf_dir):
    boxes = spark.createDataFrame(_BOXES, "seq int, left int, top int, width int, height int")
    return completion.fill_boxes(cls(spark, sf_dir).select("y", "x", "class_id"), boxes, pad=2, context=5, share=0.2)


_HOLES = f"{CLS}, z as (select y, x from cls where class_id = 0 or (y between 30 and 33 and x between 40 and 44)), e as (select a.y, a.x, b.y as by_, b.x as bx from z a join z b on abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1)"


@query("components_stats", f"with recursive {_HOLES}, reach(y, x, oy, ox) as (select y, x, y, x from z union select r.y, r.x, e.by_, e.bx from reach r join e on r.oy = e.y and r.ox = e.x), lab as (select y, x, min(oy * 2147483648 + ox) as label from reach group by y, x) select label, count(*) as area, min(y) as top, max(y) as bottom, min(x) as \"left\", max(x) as \"right\" from lab group by label")
def components_stats(spark, sf_dir):
    z = cls(spark, sf_dir).filter("class_id = 0 or (y between 30 and 33 and x between 40 and 44)")
    return regions.component_stats(regions.components(z.select("y", "x"), 8))


@query("enclosed_fill", None)
def enclosed_fill(spark, sf_dir):
    c = cls(spark, sf_dir).withColumn("class_id", F.expr("case when y between 20 and 50 and x between 20 and 60 and class_id > 0 then 2 else class_id end"))
    return regions.fill_enclosed(c.select("y", "x", "class_id"), limit=50, height=SIZE, width=SIZE)


@query("speck_suppress", None)
def speck_suppress(spark, sf_dir):
    return regions.suppress_specks(cls(spark, sf_dir).select("y", "x", "class_id"), limit=2, purity=0.5)


@query("residual_summary", f"with {NEAR} select k as class_id, count(*) as n, round(quantile_cont(sqrt(d), 0.5), 6) as median, round(quantile_cont(sqrt(d), 0.9), 6) as p90, round(max(sqrt(d)), 6) as largest, round(sqrt(avg(d::double)), 6) as rms, round(avg((sqrt(d) <= 30)::int), 6) as within_30 from near where rn = 1 group by k")
def residual_summary(spark, sf_dir):
    d = classify.classify(px(spark, sf_dir), ["r", "g", "b"], LEGEND)
    r = audits.residuals(d.withColumn("d10", F.col("distance") / 10), "distance", ["nearest_id"]).drop("within_3", "within_5", "within_8")
    w = audits.residuals(d.withColumn("d10", F.col("distance") / 10), "d10", ["nearest_id"]).select("nearest_id", F.col("within_3").alias("within_30"))
    out = r.join(w, "nearest_id").withColumnRenamed("nearest_id", "class_id")
    return out.select("class_id", "n", *[F.round(c, 6).alias(c) for c in ("median", "p90", "largest", "rms", "within_30")])


@query("balanced_split", f"with {CLS}, c as (select *, {_BOUNDS('y', 6)} as row, {_BOUNDS('x', 6)} as col from cls where r > 200), n as (select y, x, row, col, count(*) over (partition by row, col) as n, row_number() over (partition by row, col order by y, x) as rn from c) select y, x, rn % 2 = 0 as held_out from n where n >= 4")
def balanced_split(spark, sf_dir):
    c = cls(spark, sf_dir).filter("r > 200").withColumns({"row": values.cell(F.col("y"), SIZE, 6), "col": values.cell(F.col("x"), SIZE, 6)})
    return ordered.balanced_split(c, ["row", "col"], ["y", "x"]).select("y", "x", "held_out")


@query("balanced_gate", f"with {CLS}, c as (select {_BOUNDS('y', 6)} as row, {_BOUNDS('x', 6)} as col, avg((class_id in (1, 3, 5))::int) >= 0.55 as p from cls group by 1, 2) select count(*) as cells, round(avg(p::int), 9) as share, round((select min(s) from (select avg(p::int) as s from c group by row)), 9) as worst_row, round((select min(s) from (select avg(p::int) as s from c group by col)), 9) as worst_column, count(*) >= 8 and avg(p::int) >= 0.7 and (select min(s) from (select avg(p::int) as s from c group by row)) >= 0.5 and (select min(s) from (select avg(p::int) as s from c group by col)) >= 0.5 as balanced from c")
def balanced_gate(spark, sf_dir):
    m = audits.grid_metrics(cls(spark, sf_dir), height=SIZE, width=SIZE, rows=6, columns=6, domain=F.lit(True), observed=F.col("class_id").isin(1, 3, 5))
    g = audits.balanced_gate(m.withColumn("passed", F.col("observed_share") >= 0.55))
    return g.withColumns({c: F.round(c, 9) for c in ("share", "worst_row", "worst_column")})


@query("worst_cells", f"with {CLS}, c as (select {_BOUNDS('y', 6)} as row, {_BOUNDS('x', 6)} as col, sum((class_id = 0)::int)::bigint as missing from cls group by 1, 2) select row, col, missing, rank::int as rank from (select *, row_number() over (partition by row order by missing desc, col) as rank from c) where rank <= 2")
def worst_cells(spark, sf_dir):
    c = cls(spark, sf_dir).groupBy(values.cell(F.col("y"), SIZE, 6).alias("row"), values.cell(F.col("x"), SIZE, 6).alias("col")).agg(audits.count_if(F.col("class_id") == 0).alias("missing"))
    return ordered.top(c, ["row"], [F.desc("missing"), F.asc("col")], 2)


@query("west_envelope", f"with {PX}, a as (select y, min(x) as sx from px where r > 150 group by y), b as (select y, min(x) as tx from px where g > 150 group by y), g as (select y, tx - sx as gap from a join b using (y) where sx < 69 and tx < 69) select y, gap, round(least(greatest((select quantile_cont(h.gap, 0.5) from g h where h.y between g.y - 6 and g.y + 6), -8.0), 8.0), 6) as smooth from g")
def west_envelope(spark, sf_dir):
    p = px(spark, sf_dir)
    g = ordered.west_gaps(p.filter("r > 150"), p.filter("g > 150"), limit=69)
    return ordered.median_smooth(g, "y", "gap", 6, low=-8, high=8).select("y", "gap", F.round("smooth", 6).alias("smooth"))


@query("seam_interpolation", f"with {PX}, a as (select i::int as y, (select min(x) from px where px.y = i and r > 235) as x from range(96) t(i)), w as (select y, x, (select max(b.y) from a b where b.y <= a.y and b.x is not null) as y0, (select min(b.y) from a b where b.y >= a.y and b.x is not null) as y1 from a) select w.y, round(case when y0 = y1 then p.x::double else p.x + (n.x - p.x) * (w.y - y0) / (y1 - y0) end, 6) as x from w left join a p on p.y = y0 left join a n on n.y = y1")
def seam_interpolation(spark, sf_dir):
    first = ordered.row_envelope(px(spark, sf_dir).filter("r > 235")).select("y", F.col("first_x").alias("x"))
    rows = spark.range(SIZE).select(F.col("id").cast("int").alias("y")).join(first, "y", "left")
    return ordered.interpolate(rows, "y", "x").select("y", F.round("x", 6).alias("x"))


@query("octant_reports", f"with {NEAR}, d as (select y, x, sqrt(d) as v from near where rn = 1), c as (select avg(y) as cy, avg(x) as cx from d), t as (select v, degrees(atan2(y - cy, x - cx)) as a from d, c), o as (select v, (round_even(a / 45.0, 0)::int + 8) % 8 as octant, abs(a - 45.0 * round_even(a / 45.0, 0)) as off from t) select octant, count(*) as n, round(quantile_cont(v, 0.5), 6) as median, round(max(v), 6) as largest from o where off < 22.5 group by octant")
def octant_reports(spark, sf_dir):
    d = classify.classify(px(spark, sf_dir), ["r", "g", "b"], LEGEND)
    return audits.octants(d, "distance").select("octant", "n", F.round("median", 6).alias("median"), F.round("largest", 6).alias("largest"))


@query("unanimous_topology", f"with {NEAR}, v as (select y, x, t, case when sqrt(d) <= t then k else 0 end as class_id from near, (values (60.0), (80.0), (100.0)) s(t) where rn = 1) select y, x, min(class_id) as class_id from v group by y, x having count(*) = 3 and min(class_id) = max(class_id) and min(class_id) > 0")
def unanimous_topology(spark, sf_dir):
    d = classify.classify(px(spark, sf_dir), ["r", "g", "b"], LEGEND)
    v = d.withColumn("t", F.explode(F.array(F.lit(60.0), F.lit(80.0), F.lit(100.0)))).withColumn("class_id", F.when(F.col("distance") <= F.col("t"), F.col("nearest_id")).otherwise(F.lit(0)))
    return audits.unanimous(v, ["y", "x"], "class_id", 3)


@query("patch_overlap", f"with {CLS}, cc as (select y, x, class_id, r // 64 * 16 + g // 64 * 4 + b // 64 as colour from cls where class_id > 0), kinds as (select distinct p.class_id as k, p.colour as c0, q.colour as c1, s.colour as c2, t.colour as c3 from cc p join cc q on q.y = p.y and q.x = p.x + 1 and q.class_id = p.class_id join cc s on s.y = p.y + 1 and s.x = p.x and s.class_id = p.class_id join cc t on t.y = p.y + 1 and t.x = p.x + 1 and t.class_id = p.class_id), n as (select k, count(*) as n from kinds group by k), m as (select p.k as a, q.k as b, count(*) as m from kinds p join kinds q using (c0, c1, c2, c3) where p.k < q.k group by p.k, q.k) select p.k as a, q.k as b, coalesce(m, 0) as \"both\", round(coalesce(m, 0) / (p.n + q.n - coalesce(m, 0)), 9) as jaccard from n p join n q on p.k < q.k left join m on m.a = p.k and m.b = q.k")
def patch_overlap(spark, sf_dir):
    c = cls(spark, sf_dir).select("y", "x", "class_id", (F.floor(F.col("r") / 64) * 16 + F.floor(F.col("g") / 64) * 4 + F.floor(F.col("b") / 64)).alias("colour"))
    return audits.patch_overlap(c, 2).withColumn("jaccard", F.round("jaccard", 9))


_OPS = [(0, 20, 20, 60, 60, 7.0), (1, 30, 70, 62, 58, 5.0), (2, 70, 10, 20, 80, 9.0)]


@query("stamp_copies", f"with {CLS}, o(seq, sy, sx, ty, tx, r) as (values {', '.join(map(str, _OPS))}), m as (select seq, sy + a.i as fy, sx + b.i as fx, ty + a.i as y, tx + b.i as x from o, range(-9, 10) a(i), range(-9, 10) b(i) where a.i * a.i + b.i * b.i <= r * r), l as (select m.y, m.x, c.class_id as n, row_number() over (partition by m.y, m.x order by seq desc) as rn from m join cls c on c.y = fy and c.x = fx) select c.y, c.x, coalesce(n, class_id) as class_id from cls c left join l on l.y = c.y and l.x = c.x and rn = 1")
def stamp_copies(spark, sf_dir):
    ops = spark.createDataFrame(_OPS, "seq int, sy int, sx int, ty int, tx int, radius double")
    return overlay.stamp(cls(spark, sf_dir).select("y", "x", "class_id"), ops)


@query("inference_exclusions", f"with {CLS}, b(cy, cx, r) as (values (30, 30, 12.0), (60, 70, 8.0)) select y, x, class_id, case when r > 128 then 'observed' else 'inferred' end as origin from cls c where r > 128 or not exists (select 1 from b where (c.y - cy) * (c.y - cy) + (c.x - cx) * (c.x - cx) <= b.r * b.r)")
def inference_exclusions(spark, sf_dir):
    c = cls(spark, sf_dir).select("y", "x", "class_id", F.when(F.col("r") > 128, "observed").otherwise("inferred").alias("origin"))
    return overlay.erase(c, spark.createDataFrame([(30, 30, 12.0), (60, 70, 8.0)], "cy int, cx int, radius double"))


@query("automatic_ordinals", "with a as (select conv_id, turn, role <> 'system' as eligible, length(text) > 20 as long, text not like '%!%' as calm from conversations) select conv_id, turn, case when eligible then sum(eligible::int) over (partition by conv_id order by turn rows unbounded preceding) else 0 end::bigint as ordinal, (long and calm) as all_gates, eligible and long and calm as accepted from a")
def automatic_ordinals(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("role") != "system").alias("eligible"), F.create_map(F.lit("long"), F.length("text") > 20, F.lit("calm"), ~F.col("text").contains("!")).alias("gates"))
    return ordered.ordinals(c, "conv_id", "turn", "eligible", "gates").select("conv_id", "turn", F.coalesce("ordinal", F.lit(0)).alias("ordinal"), "all_gates", "accepted")


@query("candidate_rank", "select l_returnflag, l_partkey, l_suppkey, l_orderkey from (select *, row_number() over (partition by l_returnflag order by l_quantity desc, l_extendedprice desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn from lineitem) where rn = 1")
def candidate_rank(spark, sf_dir):
    keys = [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return ordered.best_candidate(table(spark, sf_dir, "lineitem"), ["l_returnflag"], keys, ["l_partkey", "l_suppkey", "l_orderkey"])


@query("restart_priority", "select case when o_orderstatus = 'F' and o_totalprice > 300000 then 1 when o_orderstatus = 'F' then 2 when o_totalprice > 200000 then 3 when o_orderpriority like '1%' then 4 else 5 end as priority, count(*) as n from orders group by 1")
def restart_priority(spark, sf_dir):
    status, price = F.col("o_orderstatus") == "F", F.col("o_totalprice")
    p = ordered.first_condition([status & (price > 300000), status, price > 200000, F.col("o_orderpriority").startswith("1")])
    return table(spark, sf_dir, "orders").groupBy(p.alias("priority")).agg(F.count("*").alias("n"))


@query("regular_swatches", "with w as (select p_brand as legend, p_partkey as top, p_size as size, lead(p_partkey) over (partition by p_brand order by p_partkey) - p_partkey as gap from part), f as (select legend, top, count(*) over six as n, stddev_pop(size) over six / avg(size) over six as cs, stddev_pop(gap) over five / avg(gap) over five as cg from w window six as (partition by legend order by top rows between current row and 5 following), five as (partition by legend order by top rows between current row and 4 following)), g as (select legend, top, round(cs + cg, 9) as score from f where n = 6 and cs <= 2 and cg <= 2) select legend, top, score from (select *, row_number() over (partition by legend order by score, top) as rn from g) where rn = 1")
def regular_swatches(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("legend"), F.col("p_partkey").alias("top"), F.col("p_size").alias("size"))
    return ordered.regular_runs(p, "legend", "top", "size", run=6, worst=2.0)


@query("best_shift", "with s as (select user_id % 20 as k, (event_id % 9)::int - 4 as shift, value from events), m as (select k, shift, quantile_cont(value, 0.5) as m from s where value is not null group by k, shift) select k, shift, round(m, 6) as strength from (select *, row_number() over (partition by k order by m desc, shift) as rn from m) where rn = 1")
def best_shift(spark, sf_dir):
    s = table(spark, sf_dir, "events").filter(F.col("value").isNotNull()).select((F.col("user_id") % 20).alias("k"), ((F.col("event_id") % 9).cast("int") - 4).alias("shift"), F.col("value").alias("strength"))
    return ordered.best_shift(s, "k", "shift", "strength").withColumn("strength", F.round("strength", 6))


@query("text_consensus", "with w as (select doc_id as id, source as page, n_chars % 300 as x, doc_id % 200 as y, doc_id % 6 as angle, doc_id * 13 % 180 as direction from documents) select a.page, a.id, count(distinct b.angle) as angles from w a join w b on a.page = b.page and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 900 and least((a.direction - b.direction + 180) % 180, 180 - (a.direction - b.direction + 180) % 180) <= 25 group by a.page, a.id")
def text_consensus(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("page"), (F.col("n_chars") % 300).alias("x"), (F.col("doc_id") % 200).alias("y"), (F.col("doc_id") % 6).alias("angle"), (F.col("doc_id") * 13 % 180).alias("direction"))
    return ordered.consensus(w, page="page", reach=30.0, turn=25.0)


@query("manifest_verify", "select 'p' || page_id as path, case when page_id % 10 = 3 then 'changed' when page_id % 10 = 7 then 'undeclared' else 'ok' end as state from pages union all select 'gone' || page_id, 'missing' from pages where page_id % 50 = 0")
def manifest_verify(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("path", F.concat(F.lit("p"), F.col("page_id")))
    found = lineage.content_hashes(pages, "path", "html")
    declared = found.join(pages.select("path", "page_id"), "path").filter("page_id % 10 <> 7").select("path", F.when(F.col("page_id") % 10 == 3, F.lit("stale")).otherwise(F.col("sha256")).alias("sha256"))
    gone = pages.filter("page_id % 50 = 0").select(F.concat(F.lit("gone"), F.col("page_id")).alias("path"), F.lit("x").alias("sha256"))
    return lineage.verify(found, declared.unionByName(gone))


@query("aggregate_hash", "with f as (select page_id % 16 as bucket, 'p' || page_id as path, sha256(html) as h from pages) select bucket, count(*) as files, sha256(string_agg(path || chr(0) || h || chr(10), '' order by path || chr(0) || h || chr(10))) as digest from f group by bucket")
def aggregate_hash(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumns({"path": F.concat(F.lit("p"), F.col("page_id")), "bucket": F.col("page_id") % 16})
    return lineage.bucket_hashes(pages.select("bucket", "path", F.sha2("html", 256).alias("sha256")), "bucket")


@query("alignment_chain", "with recursive l as (select page_id as sha, case when page_id > 0 then page_id // 3 end as parent from pages), up(step, sha) as (select 0, 200::bigint union all select step + 1, parent from up join l using (sha) where parent is not null) select step, sha::varchar as sha from up")
def alignment_chain(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("sha"), F.when(F.col("page_id") > 0, F.floor(F.col("page_id") / 3).cast("string")).alias("parent"))
    return ordered.chain(p, "200")


@query("affine_fit", "with c as (select l_partkey::double as x, l_suppkey::double as y, 2.0 * l_partkey - 0.5 * l_suppkey + 7 + l_linenumber as u, 0.25 * l_partkey + 3 * l_suppkey - 4 as v from lineitem) select round(avg(u), 4) as mean_u, round(avg(v), 4) as mean_v, count(*) as n from c")
def affine_fit(spark, sf_dir):
    """The fitted plane's means equal the data's, an identity of least squares with an intercept."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("double").alias("x"), F.col("l_suppkey").cast("double").alias("y"), (2.0 * F.col("l_partkey") - 0.5 * F.col("l_suppkey") + 7 + F.col("l_linenumber")).alias("u"), (0.25 * F.col("l_partkey") + 3 * F.col("l_suppkey") - 4).alias("v"))
    m = fits.affine(c)
    pu, pv = (m[k][0] * F.col("x") + m[k][1] * F.col("y") + m[k][2] for k in (0, 1))
    return c.agg(F.round(F.avg(pu), 4).alias("mean_u"), F.round(F.avg(pv), 4).alias("mean_v"), F.count("*").alias("n"))


@query("median_translation", "select l_shipmode_key as k, round(quantile_cont(u, 0.5), 6) as du, round(quantile_cont(v, 0.5), 6) as dv from (select l_linenumber as l_shipmode_key, l_suppkey - l_partkey as u, l_quantity - l_discount as v from lineitem) group by 1")
def median_translation(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("k"), F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("u"), F.col("l_discount").alias("y"), F.col("l_quantity").alias("v"))
    return fits.translation(c, ["k"]).select("k", F.round("du", 6).alias("du"), F.round("dv", 6).alias("dv"))


@query("degree_labels", "with t as (select event_id, event_id % 460 as n, event_id % 4 as s from events), d as (select event_id, s, case when n < 10 then null when n > 180 and n >= 400 then n - 300 else n end as n from t) select event_id, case when n <= 180 then (case when s in (1, 3) then -n else n end) end::double as degrees from d")
def degree_labels(spark, sf_dir):
    t = table(spark, sf_dir, "events").select("event_id", F.concat((F.col("event_id") % 460).cast("string"), F.lit("° "), F.element_at(F.array(*map(F.lit, "NWES")), (F.col("event_id") % 4 + 1).cast("int"))).alias("text"))
    return t.select("event_id", values.degree_label(F.col("text"), 180).cast("double").alias("degrees"))


_MIRROR = lambda v: f"case when {v} < 0 then -({v}) when {v} > {SIZE - 1} then {2 * SIZE - 2} - ({v}) else {v} end"


DENSE = f"{PX}, dense as (select (i // {SIZE})::int as y, (i % {SIZE})::int as x, coalesce(r, 0) as r from range({SIZE * SIZE}) t(i) left join px on px.y = i // {SIZE} and px.x = i % {SIZE})"


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencils.dense(px(spark, sf_dir), rasters.grid(spark, SIZE, SIZE), {"r": 0}).select("y", "x", "r")


@query("texture_moments", f"with {DENSE}, n as (select p.y, p.x, q.r::double as r from dense p, range(-2, 3) a(i), range(-2, 3) b(i), dense q where q.y = {_MIRROR('p.y + a.i')} and q.x = {_MIRROR('p.x + b.i')}) select y, x, round(avg(r), 6) as mean, round(sqrt(greatest(avg(r * r) - avg(r) * avg(r), 0)), 4) as deviation from n group by y, x")
def texture_moments(spark, sf_dir):
    m = stencils.box_moments(dense(spark, sf_dir), ["r"], 2, SIZE, SIZE)
    return m.select("y", "x", F.round("r_mean", 6).alias("mean"), F.round("r_std", 4).alias("deviation"))


@query("black_hat", f"with {DENSE}, d as (select p.y, p.x, p.r, max(q.r) as d from dense p join dense q on abs(p.y - q.y) <= 2 and abs(p.x - q.x) <= 2 group by p.y, p.x, p.r), c as (select p.y, p.x, p.r, min(q.d) as c from d p join d q on abs(p.y - q.y) <= 2 and abs(p.x - q.x) <= 2 group by p.y, p.x, p.r) select y, x, c - r as black_hat from c where c - r >= 20")
def black_hat(spark, sf_dir):
    return stencils.black_hat(dense(spark, sf_dir), "r", 2).filter("black_hat >= 20").select("y", "x", "black_hat")


@query("roundtrip_domain", f"with {CLS}, k as (select y, x, case when r > 60 then 1 else 2 end as class_id from cls) select a.y, a.x, a.class_id from k a join k b on abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 group by a.y, a.x, a.class_id having count(*) = 9 and min(b.class_id) = max(b.class_id)")
def roundtrip_domain(spark, sf_dir):
    k = cls(spark, sf_dir).withColumn("class_id", F.expr("case when r > 60 then 1 else 2 end"))
    return stencils.pure(k, "class_id", 1)


_RINGS = [("a", 0, [(5.2, 4.1), (60.7, 10.3), (80.9, 70.2), (30.4, 88.8)]), ("a", 1, [(30.3, 30.6), (50.1, 32.2), (40.8, 55.5)]), ("b", 0, [(70.2, 5.5), (90.6, 8.1), (85.3, 40.7)])]
_EDGES = ", ".join(f"('{k}', {x0}, {y0}, {x1}, {y1})" for k, _, pts in _RINGS for (x0, y0), (x1, y1) in zip(pts, pts[1:] + pts[:1], strict=True))


@query("polygon_cells", f"with e(polygon, x0, y0, x1, y1) as (values {_EDGES}), g as (select (i // {SIZE})::int as y, (i % {SIZE})::int as x from range({SIZE * SIZE}) t(i)), c as (select polygon, y, x, count(*) as n from g join e on (least(y0, y1) <= y + 0.5 and y + 0.5 < greatest(y0, y1)) and x0 + (y + 0.5 - y0) * (x1 - x0) / (y1 - y0) <= x + 0.5 group by polygon, y, x) select polygon, y, x from c where n % 2 = 1")
def polygon_cells(spark, sf_dir):
    points = [(k, n, i, px_, py) for k, n, pts in _RINGS for i, (px_, py) in enumerate(pts)]
    return polygons.rasterise(spark.createDataFrame(points, "polygon string, ring int, at int, px double, py double"), SIZE, SIZE)


@query("retained_components", None)
def retained_components(spark, sf_dir):
    return regions.retain(regions.components(px(spark, sf_dir).filter("r > 60").select("y", "x"), 4), minimum_area=3, maximum_components=5)


@query("accepted_words", "select doc_id, conf, angles from (select doc_id, (n_chars % 100)::double as conf, doc_id % 4 as angles from documents) where conf >= 65 or (conf >= 42 and angles >= 2)")
def accepted_words(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 100).cast("double").alias("conf"), (F.col("doc_id") % 4).alias("angles"))
    return words.accepted(w)


@query("falling_columns", "with n as (select event_type as page, floor((event_id % 5 * 20 + 4) / 6) as col, event_id as top, round(value, 2) as v from events where value is not null), s as (select *, case when v < lag(v) over (partition by page, col order by top) then 0 else 1 end as s from n), q as (select *, sum(s) over (partition by page, col order by top rows unbounded preceding) as run from s), z as (select page, col, run, count(*) as n, max(v) as first, min(v) as last from q group by page, col, run having count(*) >= 3) select page, n, first, last from (select *, row_number() over (partition by page order by n desc, col, run) as rn from z) where rn = 1")
def falling_columns(spark, sf_dir):
    w = table(spark, sf_dir, "events").select(F.col("event_type").alias("page"), (F.col("event_id") % 5 * 20).cast("int").alias("left"), F.col("event_id").cast("int").alias("top"), F.lit(8).alias("width"), F.lit(6).alias("height"), F.round("value", 2).cast("string").alias("text"))
    return words.falling_column(w, "page").select("page", "n", "first", "last")


@query("greedy_words", None)
def greedy_words(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select(F.col("source").alias("page"), F.col("lang").alias("text"), (F.col("n_chars") % 90).cast("int").alias("left"), (F.col("doc_id") % 70).cast("int").alias("top"), "doc_id")
    return words.greedy(w, "page", ["-doc_id"], words.same_word(14))


@query("log_state", "with e as (select conv_id as map, turn as attempt, case when turn % 2 = 0 then 'alignment' else 'extraction' end as phase, length(text) > 40 as ok from conversations), a as (select map, count(distinct attempt) as attempts, count(distinct case when ok then phase end) as phases from e group by map) select map, attempts, phases, case when phases = 2 then 'complete' else 'open' end as status from a")
def log_state(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    e = c.select(F.col("conv_id").alias("map"), F.col("turn").alias("attempt"), F.when(F.col("turn") % 2 == 0, "alignment").otherwise("extraction").alias("phase"), F.create_map(F.lit("long"), F.length("text") > 40).alias("gates"), F.lit("accept").alias("decision"))
    return logs.state(e).select("map", "attempts", F.size("phases").cast("long").alias("phases"), "status")


_PLAN = {
    "layers": [
        {"id": "zones", "kind": "categorical", "legend": [{"rgb": list(rgb)} for _, rgb in LEGEND], "max_distance": 60.0, "min_margin": 2.0},
        {"id": "greys", "kind": "grayscale_categorical", "legend": [{"gray": 60}, {"gray": 150}], "max_distance": 40.0, "max_chroma": 40, "exclude_layers": ["zones"]},
        {"id": "ink", "kind": "feature_ink", "low": [85, 60, 55], "high": [140, 255, 255]},
    ]
}


@query("plan_layers", None)
def plan_layers(spark, sf_dir):
    out = documents.compile_plan(_PLAN, px(spark, sf_dir))
    parts = [d.groupBy("class_id").agg(F.count("*").alias("n")).withColumn("layer", F.lit(k)) for k, d in out.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
