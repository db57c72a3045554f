import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrille.operators import distribution, hygiene, projection, quality, scoring, serving
from quadrille.operators import columns as heads


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """One group with most rows, ties, negatives, a missing value and a missing key; read from files."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "g": rng.choice(["a", "b", "c"], 4000, p=[0.9, 0.08, 0.02]),
            "v": np.round(rng.lognormal(3, 1.2, 4000) - 15, 2),
            "t": rng.choice(["x", "y", "z"], 4000),
        }
    )
    frame.loc[:49, "v"] = 7.0
    extra = [(None, 1.0, "x"), ("a", None, "x"), ("a", float("nan"), None)]
    df = spark.createDataFrame(frame).unionByName(spark.createDataFrame(extra, "g string, v double, t string"))
    path = str(tmp_path_factory.mktemp("skewed"))
    df.write.mode("overwrite").parquet(path)
    return frame, spark.read.parquet(path)


# One cell for each group; many rounds of cells; production values.
ROUNDS = [(10**9, 4), (5, 3), (200, 16), (distribution.CELL_ROWS, distribution.BINS)]


@pytest.mark.parametrize("cell", ROUNDS)
def test_quantiles_match_pandas(skewed, cell):
    frame, df = skewed
    probs = {"lo": 0.01, "mid": 0.5, "hi": 0.99}
    got = distribution.quantiles(df, ["g"], "v", probs, {"count": "n", "mean": "m"}, *cell).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        for name, p in probs.items():
            assert got.loc[g, name] == pytest.approx(part.v.quantile(p), rel=1e-12)
        assert got.loc[g, "n"] == len(part) and got.loc[g, "m"] == pytest.approx(part.v.mean())
    assert len(got) == 3


@pytest.mark.parametrize("cell", ROUNDS[1:])
def test_medians_and_modes(skewed, cell):
    frame, df = skewed
    df = df.withColumn("w", F.col("v") * 2)
    got = distribution.medians(df, ["g"], {"mv": "v", "mw": "w"}, {"mv": {"count": "n"}}, *cell).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        assert got.loc[g, "mv"] == pytest.approx(part.v.median())
        assert got.loc[g, "mw"] == pytest.approx(part.v.median() * 2)
    modes = distribution.modes(df.where("g is not null"), ["g"], {"t": "t"}).toPandas().set_index("g").t
    assert modes.to_dict() == frame.groupby("g").t.agg(lambda s: s.mode().iat[0]).to_dict()


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("k", v) for v in ["b", "a", "b", "a", None]], "k string, v string")
    assert rows(distribution.modes(df, ["k"], {"m": "v"})) == [("k", "a")]


@pytest.mark.parametrize("cell", ROUNDS)
def test_groups_without_a_value_stay(spark, tmp_path, cell):
    gaps = [("a", 1.0, "x"), ("a", 3.0, None), ("b", None, None), ("c", float("nan"), None), (None, 5.0, "y")]
    spark.createDataFrame(gaps, "g string, v double, t string").write.parquet(str(tmp_path / "gaps"))
    df = spark.read.parquet(str(tmp_path / "gaps"))
    got = distribution.medians(df, ["g"], {"m": "v"}, {"m": {"count": "n"}}, *cell)
    assert rows(got, "g") == [("a", 2.0, 2), ("b", None, 0), ("c", None, 0)]
    assert rows(distribution.modes(df.where("g is not null"), ["g"], {"t": "t"}), "g") == [("a", "x"), ("b", None), ("c", None)]
    nothing = distribution.quantiles(df.where("g = 'b'"), [], "v", {"m": 0.5}, None, *cell)
    assert rows(nothing) == [(None,)]


@pytest.mark.parametrize("cell", ROUNDS)
def test_narrow_and_wide_ranges_are_split(spark, tmp_path, cell):
    """Coordinates, tiny shares and values near both ends of a double: cells follow the data."""
    rng = np.random.default_rng(8)
    parts = {
        "lat": 48.8 + rng.random(3000) / 10, "tiny": rng.random(3000) * 1e-9, "same": np.full(500, 2.5),
        "wide": np.concatenate([rng.random(400) * 1e308, -rng.random(400) * 1e308, rng.random(700)]),
    }
    frame = pd.DataFrame([(g, v) for g, vs in parts.items() for v in vs], columns=["g", "v"])
    spark.createDataFrame(frame).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = distribution.quantiles(df, ["g"], "v", {"q": 0.123, "m": 0.5}, None, *cell).toPandas().set_index("g")
    for g, vs in parts.items():
        assert got.loc[g, "q"] == pytest.approx(np.quantile(vs, 0.123), rel=1e-12)
        assert got.loc[g, "m"] == pytest.approx(np.quantile(vs, 0.5), rel=1e-12)


def test_quantile_example(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    got = distribution.quantiles(df, [], "v", {"a": 0.01, "b": 0.5, "c": 0.99}).first()
    assert tuple(got) == pytest.approx((1.03, 2.5, 9.79))


def test_percentile_ranks(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 2, 3])], "i int, v double")
    expected = [0.375, 0.375, 0.75, 1.0]
    assert [r.r for r in distribution.percentile_ranks(df, "v", "r").orderBy("i").collect()] == expected


def test_percentile_ranks_match_pandas(skewed):
    frame, df = skewed
    got = distribution.percentile_ranks(df.where("g is not null and v is not null and not isnan(v)"), "v", "r").toPandas()
    expected = frame.v.rank(method="average", pct=True)
    assert sorted(got.r) == pytest.approx(sorted(expected))
    assert got.r.mean() == pytest.approx((len(frame) + 1) / (2 * len(frame)))


def test_trim_drops_only_the_tails(skewed):
    frame, df = skewed
    kept = hygiene.trim_quantiles(df.where("g is not null"), "v", "g").toPandas()
    for g, part in frame.groupby("g"):
        lo, hi = part.v.quantile([0.01, 0.99])
        assert len(kept[kept.g == g]) == part.v.between(lo, hi).sum()
        assert len(part) - len(kept[kept.g == g]) <= 2 * np.ceil(0.01 * (len(part) - 1))


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, "z")], "k string, o int, v string")
    assert rows(hygiene.first_per_key(df, ["k"], ["o"]), "k") == [("a", 1, "x"), ("b", 3, "z")]


def test_union_and_dedupe(spark):
    one = spark.createDataFrame([(1, "a")], "i int, s string")
    two = spark.createDataFrame([(1,), (2,)], "i int")
    assert sorted(rows(hygiene.union_sources([one, two, one]).dropDuplicates()), key=str) == [(1, "a"), (1, None), (2, None)]


def test_fills(spark):
    df = spark.createDataFrame([(None, None, ""), (1, "a", "b")], "n int, s string, t string")
    assert rows(hygiene.fill_text(df), "s") == [(1, "a", "b"), (None, "non_renseigne", "")]
    assert rows(hygiene.fill_zero(df, "n", "absent"), "n")[0][0] == 0
    assert hygiene.blank_to_null(df).where("t is null").count() == 1


def test_funnel(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "v int")
    got = rows(hygiene.funnel(df, {"over 2": F.col("v") > 2, "odd": F.col("v") % 2 == 1}), "step")
    assert got == [(0, "all", 4, 100.0), (1, "over 2", 2, 50.0), (2, "odd", 2, 50.0)]


def test_shares_sum_to_one_and_project(spark):
    fine = spark.createDataFrame([("01", "a", 1.0), ("01", "b", 3.0), ("02", "c", 5.0)], "z string, c string, w double")
    shares = projection.share_of_group(fine, "z", "w")
    assert all(r.s == pytest.approx(1) for r in shares.groupBy("z").agg(F.sum("part").alias("s")).collect())
    coarse = spark.createDataFrame([("01", 10), ("03", 4)], "z string, n int")
    out = projection.project(coarse, shares.select("z", "c", "part"), "z", "part", {"n": "e"})
    # 2.5 and 7.5 round to the even neighbour; a zone without fine zones keeps its row.
    assert rows(out.select("z", "c", "e"), "z", "c") == [("01", "a", 2), ("01", "b", 8), ("03", None, None)]


def test_equal_split_and_evolution(spark):
    fine = spark.createDataFrame([("01", "a"), ("01", "b"), ("02", "c")], "z string, c string")
    totals = spark.createDataFrame([("01", 3.0)], "z string, t double")
    assert rows(projection.equal_split(totals, fine, "z", "t", "p").select("c", "p"), "c") == [("a", 1.5), ("b", 1.5), ("c", 0.0)]
    yearly = spark.createDataFrame([("a", 2021, 10.0), ("a", 2025, 15.0), ("b", 2021, 1.0)], "k string, y int, m double")
    out = projection.evolution(yearly, ["k"], "y", 2021, 2025, {"m": "pct"})
    assert rows(out) == [("a", 10.0, 15.0, 50.0)]


def test_minmax(spark):
    df = spark.createDataFrame([("a", 4.0, 1.0), ("b", 4.0, 3.0), ("c", 4.0, None)], "k string, c double, v double")
    assert rows(scoring.minmax(df, {"c": "sc", "v": "sv"}).select("sc", "sv"), "k") == [(0.5, 0.0), (0.5, 1.0), (0.5, None)]


def test_indicator_risk_skips_missing_indicators(spark):
    data = [(1, "01", "i", 0.0), (1, "02", "i", 10.0), (1, "01", "j", 5.0), (2, "02", "j", 7.0), (1, "03", "k", 3.0)]
    df = spark.createDataFrame(data, "y int, z string, i string, v double")
    out = scoring.indicator_risk(df, ["y", "z"], "i", "v", "r", "s")
    assert rows(out, "y", "z") == [(1, "01", 0.0, 100.0), (1, "02", 100.0, 0.0), (1, "03", 50.0, 50.0), (2, "02", 100.0, 0.0)]


def test_geometric_index(spark):
    df = spark.createDataFrame([(6.0, 6.0, 6.0, 6.0)], "s1 double, s2 double, s3 double, s4 double")
    assert df.select(scoring.geometric_index(scoring.FOUR_AXES)).first()[0] == 6.0


def test_imputation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "g string, v double")
    assert [r.v for r in scoring.impute_group_median(df, "g", "v").orderBy("g", "v").collect()] == [1.0, 2.0, 3.0, 2.0]
    assert scoring.impute_median(df, ["v"]).agg(F.sum("v")).first()[0] == 8.0


def test_bounded_scores(spark):
    got = spark.range(1).select(*[scoring.bounded(F.lit(v), 7000.0, 16000.0, True) for v in (7000.0, 16000.0, 20000.0)]).first()
    assert tuple(got) == (100.0, 0.0, 0.0)


def test_latest(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2022, 2.0), ("b", 2019, 3.0)], "code_insee_quartier string, annee int, v double")
    assert rows(serving.latest(df), "code_insee_quartier") == [("a", 2022, 2.0), ("b", 2019, 3.0)]
    assert rows(serving.latest(df, at=2020)) == [("a", 2020, 1.0)]


def test_ranking(spark):
    members = spark.createDataFrame([("01", "a"), ("01", "b"), ("01", "c"), ("02", "d")], "arrondissement string, code_insee_quartier string")
    prices = spark.createDataFrame([("a", 2020, 9.0), ("a", 2021, 10.0), ("b", 2021, 30.0), ("d", 2021, 5.0)],
                                   "code_insee_quartier string, annee int, prix_m2_median double")
    comfort = spark.createDataFrame([("a", 40.0), ("b", 80.0)], "code_insee_quartier string, score_confort_urbain_100 double")
    out = serving.ranking(members, {"prix_m2": prices, "confort": comfort}, ["prix_m2", "confort", "unknown"])
    got = {r.code_insee_quartier: (r.composite_score, r.rank) for r in out.collect()}
    # A low price is good; a constant category scores 100; no score at all is 0.
    assert got == {"a": (70.0, 1), "b": (40.0, 2), "c": (0.0, 3), "d": (100.0, 1)}


def test_unknown_category(spark):
    with pytest.raises(ValueError, match="unknown category"):
        serving.choropleth({}, "bruit")


def test_heads(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Année` int, `Loyers de référence` int, `Loyers de référence majorés` int, `Ville` int")
    assert heads.pick_column(df, ["loyers_de_reference"]) == "Loyers de référence"
    assert heads.pick_column(df, ["majores"]) == "Loyers de référence majorés"
    assert heads.pick_column(df, ["absent"]) is None
    assert heads.find_column(df, "loyers", "majores") == "Loyers de référence majorés"
    assert heads.find_prefix(df, "ann") == "Année"
    assert heads.normalize_headers(df).columns == ["annee", "loyers_de_reference", "loyers_de_reference_majores", "ville"]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        heads.require(df, ["Ville", "y", "x"])


def test_quality(spark):
    df = spark.createDataFrame([("1.0", "2020", 1.0), ("", "2020", 2.0), ("75001", "x", None)], "arrondissement string, annee string, nb_ventes double")
    found = {(r.check, r.detail): (r.severity, r.violations) for r in quality.report(df, ["annee", "prix_m2_median"]).collect()}
    assert found == {
        ("zone_format", "arrondissement"): ("blocking", 2),
        ("year_numeric", "annee"): ("blocking", 1),
        ("required_column", "prix_m2_median"): ("blocking", 3),
        ("legacy_name", "nb_ventes"): ("warning", 3),
    }
    assert rows(quality.duplicate_keys(df, ["annee"])) == [("2020", 2)]
    assert rows(quality.null_summary(df, ["nb_ventes"])) == [("nb_ventes", 1, 33.33)]
    assert quality.missing_required(spark.createDataFrame([(1,)], "CODE_IRIS int"), ["code_iris"]).count() == 0


def test_fingerprint_ignores_order(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    one = quality.table_fingerprint(df).first()
    two = quality.table_fingerprint(df.orderBy(F.desc("a")).select("b", "a")).first()
    assert one == two and one != quality.table_fingerprint(df.where("a > 0")).first()


def test_regression_diff(spark):
    before = spark.createDataFrame([(1, 2.0), (2, 4.0)], "k int, m double")
    after = spark.createDataFrame([(1, 2.0), (2, None)], "k int, m double")
    got = {r.metric: r.change for r in quality.regression_diff(before, after, ["k"], ["m"]).collect()}
    assert got == {"rows": 0.0, "keys": 0.0, "m_mean": -1.0, "m_missing": 1.0, "m_median": -1.0}
