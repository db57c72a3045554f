import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrille.functions.geo import polygons_of
from quadrille.operators import edges, spatial
from quadrille.plans import indicators as kpi


def km(lat1, lon1, lat2, lon2, k=111.0):
    return np.sqrt(((lon2 - lon1) * k * np.cos(np.radians(lat1))) ** 2 + ((lat2 - lat1) * k) ** 2)


@pytest.fixture(scope="module")
def clouds(spark):
    """References with one crowded spot, exact copies and a far outlier; points around them."""
    rng = np.random.default_rng(5)
    crowd = rng.normal([48.85, 2.35], 1e-4, (150, 2))
    spread = rng.uniform([48.8, 2.2], [48.9, 2.5], (80, 2))
    refs = np.vstack([crowd, spread, crowd[:20], [[10.0, -60.0]]])
    refs = pd.DataFrame(refs, columns=["lat", "lon"])
    refs["code"] = [f"r{i:04d}" for i in range(len(refs))]
    refs["zone"] = rng.choice(["a", "b"], len(refs))
    pts = pd.DataFrame(rng.uniform([48.7, 2.1], [49.0, 2.6], (60, 2)), columns=["lat", "lon"])
    pts.loc[:9, ["lat", "lon"]] = refs.loc[:9, ["lat", "lon"]].to_numpy()
    pts["id"] = range(len(pts))
    pts["zone"] = rng.choice(["a", "b", "none"], len(pts))
    lost = spark.createDataFrame([(None, 2.0, 900, "a")], "lat double, lon double, id long, zone string")
    return pts, refs, spark.createDataFrame(pts).unionByName(lost), spark.createDataFrame(refs)


@pytest.mark.parametrize("tree", [(spatial.LEAF_REFS, spatial.NODE_BOXES), (3, 2), (20, 4)])
@pytest.mark.parametrize("by", [[], ["zone"]])
def test_nearest_matches_brute_force(clouds, tree, by):
    pts, refs, p, r = clouds
    out = spatial.nearest(p, r, by=by, leaf_refs=tree[0], node_boxes=tree[1]).toPandas().set_index("id")
    assert len(out) == len(pts) + 1 and out.loc[900].nearest_code is None
    for row in pts.itertuples():
        pool = refs[refs.zone == row.zone] if by else refs
        if pool.empty:
            assert out.loc[row.id].nearest_code is None
            continue
        d = km(row.lat, row.lon, pool.lat.to_numpy(), pool.lon.to_numpy())
        best = min(zip(d, pool.code))
        assert out.loc[row.id].nearest_distance == pytest.approx(best[0], abs=1e-9)
        assert out.loc[row.id].nearest_code == best[1]


def most_rows(df):
    """The largest number of rows that any operator of the run plan made."""
    df.collect()

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        made, below = plan.metrics().get("numOutputRows"), plan.children()
        return max([made.get().value() if made.isDefined() else 0, *[walk(below.apply(i)) for i in range(below.size())]])

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("tree", [(4, 3), (8, 8)])
def test_rows_of_a_place_share_their_bound(spark, tree):
    """What a place follows does not multiply from level to level."""
    rng = np.random.default_rng(8)
    cloud = rng.normal([48.85, 2.35], 0.01, (3_000, 2)).round(6)
    refs = pd.DataFrame(cloud, columns=["lat", "lon"]).assign(code=range(3_000))
    pts = pd.DataFrame(rng.normal([48.85, 2.35], 0.01, (800, 2)).round(6), columns=["lat", "lon"]).assign(id=range(800))
    out = spatial.nearest(spark.createDataFrame(pts), spark.createDataFrame(refs), leaf_refs=tree[0], node_boxes=tree[1])
    assert most_rows(out) <= 60 * len(pts)
    got = {r.id: r.nearest_code for r in out.collect()}
    for row in pts.itertuples():
        d = km(row.lat, row.lon, refs.lat.to_numpy(), refs.lon.to_numpy())
        assert got[row.id] == min(zip(d, refs.code))[1]


def test_nearest_by_squared_degrees(clouds):
    pts, refs, p, r = clouds
    for leaf in (spatial.LEAF_REFS, 7):
        out = spatial.nearest(p, r, metric=spatial.squared_degrees, leaf_refs=leaf).toPandas().set_index("id")
        for row in pts.itertuples():
            d = (refs.lat - row.lat) ** 2 + (refs.lon - row.lon) ** 2
            assert out.loc[row.id].nearest_code == min(zip(d, refs.code))[1]


def test_count_within_matches_brute_force(clouds):
    pts, refs, p, r = clouds
    for radius in (0.3, 4.0):
        out = spatial.count_within(p, r, "id", radius, km=111.32).toPandas().set_index("id").n_within
        for row in pts.itertuples():
            d = km(row.lat, row.lon, refs.lat.to_numpy(), refs.lon.to_numpy(), 111.32)
            assert out[row.id] == (d <= radius).sum()
        assert out[900] == 0


def test_within_distance(clouds):
    _, refs, _, r = clouds
    out = spatial.within_distance(r, 48.85, 2.35, 2.0).toPandas()
    d = km(48.85, 2.35, refs.lat.to_numpy(), refs.lon.to_numpy())
    assert sorted(out.code) == sorted(refs.code[d <= 2.0])


def test_areas(spark):
    shapes = [
        ("a", '{"type":"Polygon","coordinates":[[[0,0],[2,0],[0,2],[0,0]]]}', 0.5, 0.5),
        ("b", '{"type":"MultiPolygon","coordinates":[[[[5,5],[9,5],[9,9],[5,9],[5,5]]]]}', 7.0, 7.0),
        ("c", "broken", 1.5, 1.5),
    ]
    areas = spark.createDataFrame(shapes, "code string, s string, lat_c double, lon_c double")
    areas = areas.withColumn("polygons", polygons_of(F.col("s")))
    pts = spark.createDataFrame([(1, 0.3, 0.3), (2, 1.8, 1.8), (3, 6.0, 6.0), (4, 3.0, 3.0), (5, None, 1.0)], "id int, lat double, lon double")
    got = {r.id: (r.area_code, r.matched_by) for r in spatial.assign_area(pts, areas).collect()}
    assert got == {1: ("a", "polygon"), 2: ("a", "box"), 3: ("b", "polygon"), 4: ("c", "nearest"), 5: (None, None)}


def test_repeated_ids_get_their_own_answers(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 5.0, 5.0), (1, 5.0, 5.0)], "id int, lat double, lon double")
    refs = spark.createDataFrame([("a", 0.1, 0.0), ("b", 5.0, 5.1)], "code string, lat double, lon double")
    for leaf in (spatial.LEAF_REFS, 1):
        out = spatial.nearest(points, refs, leaf_refs=leaf).collect()
        assert sorted((r.lat, r.nearest_code) for r in out) == [(0.0, "a"), (5.0, "b"), (5.0, "b")]


def test_one_huge_area_among_small_ones(spark):
    def square(x, y, side):
        ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
        return f'{{"type":"Polygon","coordinates":[{ring}]}}'

    small = [(f"s{i:02d}", square(i * 0.002, 10.0, 0.001)) for i in range(40)]
    areas = spark.createDataFrame([("huge", square(-60.0, -60.0, 120.0)), ("dot", square(3.0, 3.0, 0.0)), *small], "code string, s string")
    areas = areas.withColumn("polygons", polygons_of(F.col("s")))
    places = [(i, 10.0005, i * 0.002 + 0.0005) for i in range(40)] + [(100, -59.0, 59.0), (101, 70.0, 0.0)]
    points = spark.createDataFrame(places, "id int, lat double, lon double")
    got = {r.id: r.area_code for r in spatial.containing_areas(points, areas).collect()}
    assert got == {**{i: "huge" for i in range(40)}, 100: "huge", 101: None}
    alone = {r.id: r.area_code for r in spatial.containing_areas(points, areas.where("code <> 'huge'")).collect()}
    assert alone == {**{i: f"s{i:02d}" for i in range(40)}, 100: None, 101: None}


def even_odd(x, y, polygons):
    def odd(rings):
        hits = 0
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                hits += (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
        return hits % 2 == 1

    return any(odd(rings) for rings in polygons)


def test_rings_of_many_edges_meet_points_by_slab(spark):
    def star(n, r0, r1, cx=0.0, cy=0.0):
        turns = np.linspace(0, 2 * np.pi, n, endpoint=False)
        r = np.where(np.arange(n) % 2, r0, r1)
        ring = [[cx + float(a), cy + float(b)] for a, b in zip(r * np.cos(turns), r * np.sin(turns))]
        return [*ring, ring[0]]

    comb = [[float(i), 0.0 if i % 2 else 5.0] for i in range(400)] + [[400.0, 6.0], [0.0, 6.0], [0.0, 5.0]]
    shapes = {
        "star": [[star(20_000, 0.8, 1.0), star(3_000, 0.2, 0.5)]],
        "two": [[star(501, 0.3, 0.3, 3.0, 0.0)], [star(7, 0.3, 0.4, 4.0, 0.5), star(5, 0.1, 0.1, 4.0, 0.5)]],
        "comb": [[comb]],
        "flat": [[[[9.0, 1.0], [9.5, 1.0], [9.0, 1.0]]]],
        "none": None,
    }
    areas = spark.createDataFrame([(k, v) for k, v in shapes.items()], "code string, polygons array<array<array<array<double>>>>")
    rng = np.random.default_rng(3)
    places = [(i, float(y), float(x)) for i, (x, y) in enumerate(np.concatenate([rng.uniform(-1.1, 1.1, (400, 2)), rng.uniform(2.5, 4.5, (200, 2)) - [0, 3.2], rng.uniform(0, 6, (300, 2)) * [66, 1]]))]
    places += [(10_000, 1.0, 9.2), (10_001, None, 0.0)]
    points = spark.createDataFrame(places, "id int, lat double, lon double")
    got = {r.id: r.area_code for r in spatial.containing_areas(points, areas).collect()}
    for i, y, x in places:
        want = [] if y is None else [k for k, p in shapes.items() if p and even_odd(x, y, p)]
        assert got[i] == min(want, default=None), (x, y)
    assert sum(v == "star" for v in got.values()) > 100 and sum(v == "two" for v in got.values()) > 5
    slabs, laid = edges.edge_index(areas.where("polygons is not null"), "code", "polygons")
    held = {(r["_code"], r["_slab"]): r["count"] for r in laid.groupBy("_code", "_slab").count().collect()}
    copies = {k: sum(n for (c, _), n in held.items() if c == k) for k in shapes}
    assert copies["star"] <= (edges.COPIES + 1) * 23_000 and copies["comb"] <= (edges.COPIES + 1) * 402
    assert max(n for (c, _), n in held.items() if c == "star") < 23_000 / 4
    round_ = spark.createDataFrame([("round", [[star(20_000, 1.0, 1.0)]])], areas.schema)
    assert edges.edge_index(round_, "code", "polygons")[1].groupBy("_slab").count().agg(F.max("count")).first()[0] < 1_000


def test_target_table_falls_back_to_coarser_levels(spark):
    square = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]
    moved = [[[[x + 2.0, y] for x, y in square[0][0]]]]
    far = [[[[x + 4.0, y] for x, y in square[0][0]]]]
    iris = spark.createDataFrame(
        [("i1", "q1", "01", square), ("i2", "q1", "01", moved), ("i3", "q3", "03", far), ("i4", "q4", "04", None)],
        "code_iris string, code_insee_quartier string, arrondissement string, polygons array<array<array<array<double>>>>",
    )
    sales = [(i, 0.5, 0.5, "q9", "09", 100.0 + i) for i in range(6)] + [(10, 0.5, 2.5, "q9", "09", 900.0), (11, 9.0, 9.0, "q1", "01", 300.0), (12, None, None, "q1", "01", 200.0)]
    sales = spark.createDataFrame(sales, "id int, lat double, lon double, code_insee_quartier string, arrondissement string, prix_m2 double")
    rents = spark.createDataFrame([("q1", "01", 10.0)] * 2 + [("q2", "01", 40.0)] * 4 + [("q3", "03", None)], "code_insee_quartier string, arrondissement string, loyer_reference double")
    homes = spark.createDataFrame([("01", 7), ("01", 5)], "arrondissement string, nb_logements_finances int")
    out = {r.code_iris: r for r in kpi.kpi_by_iris(sales, rents, homes, iris).collect()}
    assert len(out) == 4
    a, b, c, d = (out[f"i{n}"] for n in range(1, 5))
    assert (a.prix_m2_moyen, a.prix_m2_median, a.nb_transactions, a.niveau_prix) == (102.5, 102.5, 6, "iris")
    assert (b.nb_transactions, b.niveau_prix, b.prix_m2_median) == (1, "quartier", 104.0)
    assert a.niveau_loyer == "arrondissement" and a.loyer_moyen == 30.0 and a.rentabilite == 30.0 * 1200 / 102.5
    assert a.nb_logements_sociaux == 12 and c.nb_logements_sociaux == 0
    assert c.prix_m2_moyen is None and c.nb_transactions == 0 and d.tension_immobiliere is None
