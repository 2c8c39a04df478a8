"""Masks, reports and choices on small hand-made cases; the registered queries are tested against SQL."""

import pytest
from pyspark.sql import functions as F

from terrazzo.operators import audits, evidence, fits, lines, masks, regions, reports, textures


def cells(spark, rows):
    """Cells of a picture given as strings: every character but a dot."""
    found = [(y, x, c) for y, line in enumerate(rows) for x, c in enumerate(line) if c != "."]
    return spark.createDataFrame(found, "y int, x int, c string")


def test_groups_reach_along_any_chain(spark):
    path = [(k, k + 1) for k in range(49)] + [(60, 61), (61, 60), (70, 70)]
    got = {r.node: r.group_id for r in audits.confusable_groups(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(50)}, 60: 60, 61: 60, 70: 70}


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_match_a_flood(spark, connectivity):
    picture = ["aa.a..b", ".aa.abb", "a..a..b", "aaa.aa.", "..a...a"]
    got = {(r.y, r.x): r.label for r in regions.components(cells(spark, picture), connectivity, same="c").collect()}
    at = {(y, x): c for y, line in enumerate(picture) for x, c in enumerate(line) if c != "."}
    steps = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (connectivity == 8 or not (dy and dx))]
    seen = {}
    for start in sorted(at):
        if start in seen:
            continue
        todo = [start]
        while todo:
            p = todo.pop()
            if p in seen:
                continue
            seen[p] = start[0] * (1 << 31) + start[1]
            todo += [q for dy, dx in steps if at.get(q := (p[0] + dy, p[1] + dx)) == at[p]]
    assert got == seen


def test_support_keeps_near_satellites_and_fills_holes(spark):
    picture = [
        "..........................",
        ".xxxxxxxx.................",
        ".xxxxxxxx...xxxxx.........",
        ".xxx..xxx...xxxxx........x",
        ".xxxxxxxx.................",
        "..........................",
    ]
    got = {(r.y, r.x) for r in masks.geographic_support(cells(spark, picture), 6, 26).collect()}
    want = {(y, x) for y in range(1, 5) for x in range(1, 9)} | {(y, x) for y in (2, 3) for x in range(12, 17)}
    assert want <= got and (3, 25) not in got


def test_windows_of_regions():
    assert reports.region_window((10, 20, 30, 40), (0, 0, 100, 100), 50, 50) == (5, 30, 15, 40)
    assert reports.region_window((-5, -5, 1, 1), (0, 0, 100, 100), 50, 50) == (0, 49, 1, 50)
    for box in ((30, 20, 10, 40), (200, 200, 300, 300)):
        with pytest.raises(ValueError):
            reports.region_window(box, (0, 0, 100, 100), 50, 50)


def test_choices(spark):
    points = spark.createDataFrame([(k, float(x), float(y), q) for k, (x, y, q) in enumerate([(0, 0, 1.0), (1, 0, 3.0), (10, 0, 1.0), (10, 9, 0.5), (5, 5, 0.1)])], "id int, x double, y double, q double")
    assert [r["id"] for r in evidence.farthest(points, "id", 3, "q", 0.1)] == [1, 3, 2]
    fits = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", 5.0)], "m string, score double")
    assert sorted((r.m, r.score, r["rank"]) for r in evidence.shortlist(fits, ["m"], "score", 2).collect()) == [("a", 1.0, 1), ("a", 2.0, 2), ("b", 5.0, 1)]
    one = spark.createDataFrame([(1, 1.0), (2, 1.1)], "score int, scale double")
    with pytest.raises(ValueError):
        evidence.scale_modes(one, order=["score"], scale="scale")


def test_gates_raise(spark):
    few = spark.createDataFrame([(1.0, True)] * 8, "shift double, accepted boolean")
    with pytest.raises(Exception, match="too little evidence"):
        evidence.amplitude(few, F.lit(1.0)).collect()
    assert evidence.amplitude(few.union(few), F.lit(1.0)).first().amplitude == -1
    outside = spark.createDataFrame([("l", 1, False), ("l", 0, True)], "layer string, v int, inside boolean")
    with pytest.raises(Exception, match="outside the interior"):
        reports.attested(outside, "layer", value="v", inside="inside").collect()


def test_empty_lines_and_exact_copies(spark):
    none, some = cells(spark, ["..."]), cells(spark, ["x.x"])
    row = lines.line_report(none, some, tolerance=1.0).first()
    assert (row.n, row["median"], row.precision, row.f1) == (0, 1e6, 0.0, 0.0)
    same = reports.same_values(some, some, ["c"]).first()
    assert same.passed and same.cells == 2 and same.differs_c == 0
    assert reports.mask_difference(some, some).count() == 0


def test_matrices_are_found_again(spark):
    places = [(float(x), float(y)) for x in range(0, 100, 20) for y in range(0, 80, 20)]

    def under(m):
        w = [m[2][0] * x + m[2][1] * y + m[2][2] for x, y in places]
        return [(k, x, y, (m[0][0] * x + m[0][1] * y + m[0][2]) / w[k], (m[1][0] * x + m[1][1] * y + m[1][2]) / w[k]) for k, (x, y) in enumerate(places)]

    truth = [[1.1, 0.2, 5.0], [-0.1, 0.9, 3.0], [0.001, -0.0005, 1.0]]
    controls = spark.createDataFrame(under(truth), "id int, x double, y double, u double, v double")
    found = fits.projective(controls)
    assert all(abs(found[i][j] - truth[i][j]) < 1e-6 for i in range(3) for j in range(3))
    assert fits.evaluate(controls, found).first().largest < 1e-6
    back = fits.inverse(found)
    turned = fits.moved(back, "u", "v")
    assert controls.select(F.max(F.abs(turned[0] - F.col("x")) + F.abs(turned[1] - F.col("y")))).first()[0] < 1e-6
    with pytest.raises(ValueError):
        fits.inverse([[1, 2, 0], [2, 4, 0], [0, 0, 1]])


def test_outliers_stay_out_of_the_fit(spark):
    rows = [(k, float(k % 7 * 10), float(k // 7 * 10)) for k in range(49)]
    moved = [(k, x, y, 2 * x + 3 + (40 if k % 6 == 0 else 0.1 * (k % 3)), y - x - (35 if k % 6 == 0 else 0)) for k, x, y in rows]
    controls = spark.createDataFrame(moved, "id int, x double, y double, u double, v double")
    got = {r.id: r.inlier for r in fits.consistent(controls, "id").collect()}
    assert got == {k: k % 6 != 0 for k, _, _ in rows}
    assert not any(r.inlier for r in fits.consistent(controls.limit(2), "id").collect())


def test_textures_that_look_alike_raise(spark):
    f = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.2, 0.0), (2, 0.3, 0.1), (3, 9.0, 9.0)], "k int, p double, q double")
    model = textures.texture_model(f, "k", ["p", "q"])
    assert [(a, b) for a, b, _ in model[2]] == [(1, 2)]
    with pytest.raises(ValueError):
        textures.classify_texture(f, ["p", "q"], model, max_distance=1, min_margin=1)
    good = textures.classify_texture(f, ["p", "q"], textures.texture_model(f, "k", ["p", "q"], least=0.1), max_distance=1.0, min_margin=0.01)
    assert [r.class_id for r in good.orderBy("p").collect()] == [1, 1, 2, 3]


def test_source_boxes_keep_places_on_whole_pixels(spark, tmp_path):
    """1.3 * 10 - 5 and 0.4 * y + 0.1 * x - 2 are whole for many cells; binary fractions put some of them beside the pixel."""
    import duckdb

    from terrazzo.plans import catalog, strips  # noqa: F401

    spark.range(9600).selectExpr("id as event_id", "id % 97 as user_id").write.parquet(str(tmp_path / "events.parquet"))
    got = catalog.QUERIES["source_boxes"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(catalog.ORACLES["source_boxes"])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())


def snapped(spark, folder, ids):
    """Rows of snapped_water and of its SQL on events of these ids."""
    import duckdb

    from terrazzo.plans import catalog, strips  # noqa: F401

    ids.selectExpr("id as event_id", "id * 7919 % 1500 as user_id").write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    want = con.execute(catalog.ORACLES["snapped_water"]).fetchall()
    return sorted((r.y, r.x) for r in catalog.QUERIES["snapped_water"](spark, str(folder)).collect()), sorted(want)


def test_snapped_water_broadcasts_no_cells(spark, tmp_path):
    """Cells pack into small files; what a join broadcasts is bounded here as the driver's memory bounds it on large tables."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1500k")
    try:
        got, want = snapped(spark, tmp_path, spark.range(40000))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert got == want and got


def test_snapped_water_steps_over_no_gaps(spark, tmp_path):
    """Cells without an event can't be crossed: what they shut in isn't outside the shoreline."""
    y, x = "id div 64 % 50", "id % 64"
    shut = f"{y} between 2 and 8 and {x} in (40, 50) or {y} in (2, 8) and {x} between 40 and 50"
    got, want = snapped(spark, tmp_path, spark.range(6400).filter(f"not ({shut})"))
    assert got == want and got
