"""Operators on tiny rasters with known results."""

import pytest
from pyspark.sql import functions as F

from terrazzo.functions import colour, coordinates, values
from terrazzo.operators import audits, classify, completion, fits, lineage, ordered, overlay, ramps, regions, tiles
from terrazzo.sources import rasters


def as_grid(df, value="class_id"):
    return {(r["y"], r["x"]): r[value] for r in df.collect()}


def box(h, w, fill, *patches):
    grid = [[fill] * w for _ in range(h)]
    for v, y0, y1, x0, x1 in patches:
        for y in range(y0, y1):
            for x in range(x0, x1):
                grid[y][x] = v
    return grid


def test_margin_gate_leaves_the_ambiguous_pixel(spark):
    px = spark.createDataFrame([(0, 0, 220, 30, 30), (0, 1, 30, 50, 220), (0, 2, 120, 120, 120)], "y int, x int, r int, g int, b int")
    light, a, b = colour.lab8(F.col("r"), F.col("g"), F.col("b"))
    lab = px.select("y", "x", light.alias("l"), a.alias("a"), b.alias("b"))
    legend = {(220, 30, 30): 1, (30, 50, 220): 2}
    protos = [(legend[(r.r, r.g, r.b)], (float(q.l), float(q.a), float(q.b))) for r, q in zip(px.collect()[:2], lab.collect()[:2], strict=True)]
    got = classify.classify(lab, ["l", "a", "b"], protos, max_distance=5, min_margin=1)
    assert [got.filter(f"x = {x}").first()["class_id"] for x in range(3)] == [1, 2, 0]


def test_unmixing_finds_two_inks(spark):
    one = spark.createDataFrame([(0, 0, 0.65 * 40 + 0.55 * -20, 0.65 * 10 + 0.55 * 45)], "y int, x int, a double, b double")
    got = classify.unmix(one, "a", "b", [(40.0, 10.0), (-20.0, 45.0), (5.0, -50.0)], least=0.25, worst=3.0, chroma=5.0).first()
    assert got["inks"] == [1, 2] and got["residual"] < 1e-9


def test_enclosed_hole_is_filled_and_others_are_not(spark):
    hole = rasters.from_rows(spark, box(9, 9, 2, (0, 3, 6, 3, 6)))
    got = as_grid(regions.fill_enclosed(hole, limit=50, height=9, width=9))
    assert set(got.values()) == {2}
    mixed = box(9, 9, 2, (0, 3, 6, 3, 6))
    mixed[2][4] = 5
    assert as_grid(regions.fill_enclosed(rasters.from_rows(spark, mixed), limit=50, height=9, width=9))[4, 4] == 0
    edge = rasters.from_rows(spark, box(9, 9, 2, (0, 0, 3, 3, 6)))
    assert as_grid(regions.fill_enclosed(edge, limit=50, height=9, width=9))[0, 4] == 0
    large = rasters.from_rows(spark, box(9, 14, 2, (0, 2, 7, 2, 12)))
    assert as_grid(regions.fill_enclosed(large, limit=50, height=9, width=14))[3, 5] == 0
    kept = rasters.from_rows(spark, [[None, None]] * 0 + [[0]]).limit(0).select("y", "x").union(spark.createDataFrame([(4, 4)], "y int, x int"))
    assert as_grid(regions.fill_enclosed(hole, limit=50, height=9, width=9, protected=kept))[4, 4] == 0


def test_components_follow_long_shapes(spark):
    cells = [(0, x) for x in range(40)] + [(y, 39) for y in range(30)] + [(20, 5), (21, 6)]
    df = spark.createDataFrame(cells, "y int, x int").distinct()
    areas = sorted(r["area"] for r in regions.component_stats(regions.components(df, 8)).collect())
    assert areas == [2, 69]
    assert sorted(r["area"] for r in regions.component_stats(regions.components(df, 4)).collect()) == [1, 1, 69]


def test_specks_take_the_ring_majority(spark):
    grid = box(7, 7, 1, (3, 3, 4, 3, 4))
    assert as_grid(regions.suppress_specks(rasters.from_rows(spark, grid), limit=2, purity=0.9))[3, 3] == 1
    exempt = spark.createDataFrame([(3, 3)], "y int, x int")
    assert as_grid(regions.suppress_specks(rasters.from_rows(spark, grid), limit=2, purity=0.9, exempt=exempt))[3, 3] == 3


def test_closed_lines_have_interiors(spark):
    line = [(y, x) for y in range(2, 8) for x in range(2, 9) if y in (2, 7) or x in (2, 8)]
    got = regions.closed_interiors(spark.createDataFrame(line, "y int, x int"), height=12, width=12, grid=rasters.grid(spark, 12, 12))
    assert got.count() == 4 * 5


def test_nearest_fill_reaches_far_cells_and_breaks_ties(spark):
    grid = box(9, 40, 0, (4, 2, 3, 0, 1), (9, 2, 3, 39, 40))
    df = rasters.from_rows(spark, grid)
    got = as_grid(completion.nearest_fill(df, df.filter("class_id = 0")))
    assert got[2, 10] == 4 and got[2, 30] == 9 and got[8, 19] == 4 and len(got) == 9 * 40 - 2


def test_neighbour_vote_and_manual_weight(spark):
    df = spark.createDataFrame([(2, 2, 4, 1.0), (2, 4, 9, 3.0), (4, 2, 4, 1.0), (4, 4, 9, 1.0), (3, 3, 0, 1.0)], "y int, x int, class_id int, w double")
    unknown = df.filter("class_id = 0")
    assert as_grid(completion.neighbour_vote(df, unknown, neighbours=4, weight="w"))[3, 3] == 9
    assert as_grid(completion.neighbour_vote(df, unknown, neighbours=4))[3, 3] == 4


def test_coverage_gates(spark):
    rows = [(y, x, 1 if (y, x) == (2, 1) else 0, 1 <= y <= 3 and 1 <= x <= 5, (y, x) in ((2, 1), (2, 5))) for y in range(5) for x in range(7)]
    df = spark.createDataFrame(rows, "y int, x int, class_id int, state boolean, evidence boolean")
    sparse = audits.coverage(df, value="class_id", state="state", evidence="evidence", sparse=True).first()
    assert sparse["dropped"] == 1 and not sparse["passed"]
    full = audits.coverage(df, value="class_id", state="state", evidence="evidence", sparse=False).first()
    assert full["unclassified"] == 14 and not full["passed"]


def test_total_variation(spark):
    c = spark.createDataFrame([("a", 1, 9), ("a", 2, 7), ("b", 1, 9), ("b", 2, 7), ("c", 3, 1)], "g string, colour int, n int")
    got = {(r["a"], r["b"]): r["tv"] for r in audits.total_variation(c, "g", "colour").collect()}
    assert got[("a", "b")] == pytest.approx(0.0) and got[("a", "c")] == pytest.approx(1.0)


def test_confusable_families(spark):
    pairs = spark.createDataFrame([("5.0", "5.5"), ("5.5", "6.5"), ("2.5", "3.5")], "a string, b string")
    groups = {}
    for r in audits.confusable_groups(pairs).collect():
        groups.setdefault(r["group_id"], []).append(r["node"])
    assert sorted(sorted(v) for v in groups.values()) == [["2.5", "3.5"], ["5.0", "5.5", "6.5"]]


def test_stamps_copy_and_chain(spark):
    df = rasters.from_rows(spark, box(30, 30, 0, (2, 3, 4, 5, 6)))
    ops = [{"source": (3, 5), "target": (10, 5), "radius": 1}, {"source": (10, 5), "target": (18, 5), "radius": 1}]
    got = as_grid(overlay.replay(df, ops))
    assert got[10, 5] == 2 and got[18, 5] == 2 and got[3, 5] == 2


def test_conservative_compose_refuses_overlap(spark):
    a, b = rasters.from_rows(spark, [[1, 0]]), rasters.from_rows(spark, [[0, 2]])
    assert as_grid(overlay.conservative(a, b)) == {(0, 0): 1, (0, 1): 2}
    with pytest.raises(Exception, match="overlaps approved evidence"):
        overlay.conservative(a, rasters.from_rows(spark, [[3, 0]])).collect()


def test_codec_round_trip_and_no_data(spark):
    df = spark.createDataFrame([(-10.0,), (0.0,), (12.34,), (1e9,), (None,)], "v double").withColumn("c", values.encode(F.col("v"), -10.0, 0.05))
    got = df.withColumn("d", values.decode(F.col("c"), -10.0, 0.05)).collect()
    assert [r["c"] for r in got] == [1, 201, 448, 65535, 0] and got[4]["d"] is None and got[2]["d"] == pytest.approx(12.35)


def test_bands_and_ramps(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (5.0,), (100.0,)], "v double")
    assert [r["band_id"] for r in ramps.band_id(df, "v", [1.0, 5.0, 100.0]).orderBy("v").collect()] == [0, 1, 2, 3]
    assert ramps.band_id(df, "v", [1.0, 5.0, 100.0], closed_last=True).orderBy("v").collect()[-1]["band_id"] == 2
    px = spark.createDataFrame([(30, 135, 0), (29, 107, 0), (200, 0, 200)], "r int, g int, b int")
    got = ramps.project(px, ["r", "g", "b"], [(0.0, (29.0, 107.0, 0.0)), (100.0, (30.0, 135.0, 0.0))], worst=30.0).collect()
    assert got[0]["value"] == pytest.approx(100.0) and got[1]["value"] == pytest.approx(0.0) and got[2]["value"] is None


def test_tiles(spark):
    df = rasters.from_rows(spark, box(8, 8, 0, (1, 0, 8, 0, 3)))
    got = {(r["ty"], r["tx"]): (r["class_id"], r["alpha"]) for r in tiles.dominant(df, 4).collect()}
    assert got == {(0, 0): (1, 191), (1, 0): (1, 191)}
    assert tiles.tile_counts(-180, -85, 180, 85, range(3)) == [1, 4, 16]


def test_coordinates():
    assert coordinates.supersampled_size(3, 2, 4) == (9, 5)
    m = [[1.0, 0.2, 3.0], [0.1, 1.0, 4.0], [0.001, 0.0, 1.0]]
    d = coordinates.supersampled_matrix(m, 2.0)
    assert d[0][2] == 6.0 and d[2][0] == 0.0005


def test_affine_fit_and_refusals(spark):
    pts = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (7.0, 3.0)]
    df = spark.createDataFrame([(x, y, 2 * x - y + 5, 0.5 * x + 3 * y - 1) for x, y in pts], "x double, y double, u double, v double")
    m = fits.affine(df)
    assert m[0] == pytest.approx([2, -1, 5]) and m[1] == pytest.approx([0.5, 3, -1])
    assert fits.affine_residuals(df, m).agg(F.max("residual")).first()[0] < 1e-9
    with pytest.raises(ValueError):
        fits.affine(df.limit(2))
    with pytest.raises(ValueError):
        fits.compact_warp([(0.0, 0.0), (0.0, 1e-9)], [(1.0, 0.0), (0.0, 1.0)], 10.0, ridge=0.0)


def test_ordered_operators(spark):
    gaps = spark.createDataFrame([(0, None), (1, 2), (4, 8), (6, None)], "y int, x int")
    assert [r["x"] for r in ordered.interpolate(gaps, "y", "x").orderBy("y").collect()] == [None, 2.0, 8.0, None]
    log = spark.createDataFrame([("m", 1, True, {"a": True}), ("m", 2, False, {"a": True}), ("m", 3, True, {"a": False})], "map string, attempt int, eligible boolean, gates map<string,boolean>")
    got = ordered.ordinals(log, "map", "attempt", "eligible", "gates").orderBy("attempt").collect()
    assert [(r["ordinal"], r["accepted"]) for r in got] == [(1, True), (None, False), (2, False)]
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "sha string, parent string")
    with pytest.raises(Exception, match="cycle"):
        ordered.chain(loop, "a").collect()


def test_chains_longer_than_twenty(spark):
    line = spark.createDataFrame([(str(i), str(i + 1)) for i in range(30)], "sha string, parent string").coalesce(1)
    assert [r["sha"] for r in ordered.chain(line, "0").orderBy("step").collect()] == [str(i) for i in range(31)]
    assert ordered.chain(line, "0", limit=30).count() == 31
    with pytest.raises(Exception, match="more than 29 parents"):
        ordered.chain(line, "0", limit=29).collect()
    loop = spark.createDataFrame([(str(i), str((i + 1) % 25)) for i in range(25)], "sha string, parent string").coalesce(1)
    with pytest.raises(Exception, match="cycle"):
        ordered.chain(loop, "0").collect()


def test_consensus_case(spark):
    words = [("p", 1, 10.0, 10.0, 0, 10.0), ("p", 2, 12.0, 10.0, 20, 12.0), ("p", 3, 11.0, 11.0, 60, 100.0)]
    df = spark.createDataFrame(words, "page string, id int, x double, y double, angle int, direction double")
    assert {r["id"]: r["angles"] for r in ordered.consensus(df, page="page", reach=14.0, turn=20.0).collect()} == {1: 2, 2: 2, 3: 1}


def test_fixed_point_and_signature(spark):
    df = rasters.from_rows(spark, [[1, 2], [3, 4]])
    step = lambda d: d.withColumn("class_id", F.least(F.col("class_id") + 1, F.lit(4)))
    end, passes = lineage.fixed_point(df, step, ["y", "x", "class_id"], most=6)
    assert passes == 4 and set(as_grid(end).values()) == {4}
    with pytest.raises(RuntimeError):
        lineage.fixed_point(df, lambda d: d.withColumn("class_id", F.col("class_id") + 1), ["y", "x", "class_id"])


def test_words_keep_quotes(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    (tmp_path / "w.tsv").write_text(head + '\n5\t1\t1\t1\t1\t1\t10\t20\t30\t8\t96\t"Salinas\n5\t1\t1\t1\t1\t2\t50\t20\t30\t8\t91\tValley\n4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t\n')
    words = rasters.read_words(spark, str(tmp_path / "w.tsv"))
    assert [r["text"] for r in words.orderBy("left").collect()] == ['"Salinas', "Valley"]
    assert rasters.combine_passes([words, words]).filter("block_num = 10001").count() == 2
