import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import attribution as A
from tidewatch.operators import evaluate as E
from tidewatch.operators import models as Mo


@pytest.fixture(scope="module")
def accounts(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.7).astype(float)
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double").withColumn("features", array_to_vector("x"))
    return Mo.pos_weight(df).cache()


@pytest.fixture(scope="module")
def model(accounts):
    return Mo.boosted(depth=3, rounds=4).fit(accounts)


def test_weights(accounts):
    r = accounts.agg(F.sum(F.when(F.col("label") == 1, F.col("weight"))).alias("p"), F.sum(F.when(F.col("label") == 0, F.col("weight"))).alias("n")).first()
    assert r["p"] == pytest.approx(r["n"])


def test_attributions_sum_to_margin(accounts, model):
    rows = A.with_attributions(Mo.scored(model, accounts), model).collect()
    for r in rows:
        assert sum(r["contributions"]) + r["base_value"] == pytest.approx(r["margin"], abs=1e-9)


def test_saved_model_scores_alike(spark, accounts, model, tmp_path):
    Mo.save_boosted(model, str(tmp_path), ["a", "b", "c"], 0.25)
    loaded, columns, threshold = Mo.load_boosted(spark, str(tmp_path))
    assert (columns, threshold) == (["a", "b", "c"], 0.25)
    margins = lambda m: {r["id"]: r["margin"] for r in Mo.scored(m, accounts).select("id", "margin").collect()}
    assert margins(loaded) == margins(model)


def expected_margin(tree, x, known):
    """Margin of one tree when only the ``known`` features are looked at."""
    def walk(node):
        if node["left"] is None:
            return node["value"]
        if node["feature"] in known:
            return walk(node["left"] if x[node["feature"]] <= node["cut"] else node["right"])
        share = node["left"]["cover"] / node["cover"]
        return share * walk(node["left"]) + (1 - share) * walk(node["right"])

    return walk(tree)


def test_attributions_by_definition(spark, accounts, model):
    """Shapley values over all subsets of features, tree by tree."""
    from tidewatch.session import new_table_path

    path = new_table_path(spark, "check")
    model.save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]

    def build(nodes, i):
        n = nodes[i]
        leaf = n["leftChild"] < 0
        return {
            "value": n["prediction"], "cover": n["impurityStats"][0], "feature": n["split"]["featureIndex"],
            "cut": None if leaf else n["split"]["leftCategoriesOrThreshold"][0],
            "left": None if leaf else build(nodes, n["leftChild"]), "right": None if leaf else build(nodes, n["rightChild"]),
        }

    roots = [(w, build(trees[t], 0)) for t, w in enumerate(model.treeWeights)]
    margin = lambda x, known: sum(w * expected_margin(t, x, known) for w, t in roots)
    for r in A.with_attributions(accounts, model).limit(25).collect():
        x = r["x"]
        for j in range(3):
            others = [f for f in range(3) if f != j]
            phi = 0.0
            for size in range(3):
                weight = math.factorial(size) * math.factorial(2 - size) / math.factorial(3)
                for s in itertools.combinations(others, size):
                    phi += weight * (margin(x, {*s, j}) - margin(x, set(s)))
            assert r["contributions"][j] == pytest.approx(phi, abs=1e-9)
        assert r["base_value"] == pytest.approx(margin(x, set()), abs=1e-9)


def test_tabled_shares_are_the_same(monkeypatch):
    rng = np.random.default_rng(8)
    leaves = [
        A.Leaf(0.7, [0, 2], [-math.inf, -0.5], [0.2, 0.9], [0.3, 0.5]), A.Leaf(-0.4, [1], [0.1], [math.inf], [0.25]), A.Leaf(0.2, [], [], [], []),
    ]
    x = rng.normal(size=(300, 3))
    x[5, 0] = np.nan
    tabled = A.attributions_of(leaves, [A.share_table(leaf) for leaf in leaves], x)
    monkeypatch.setattr(A, "TABLE_FEATURES", 0)
    found = A.attributions_of(leaves, [A.share_table(leaf) for leaf in leaves], x)
    assert tabled == pytest.approx(found, abs=0) and tabled[:, 1].any()


def test_rows_are_dealt_out_by_key(spark):
    """After a window over two classes the rows lie in two tasks; passes get them in equal ones."""
    from tidewatch.plans.registry import dealt

    rows = spark.range(60_000).withColumn("n", F.count("*").over(Window.partitionBy(F.col("id") % 2)))
    sizes = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    done = dealt(rows, "id", 60_000)
    assert len(sizes(done)) == 8 and max(sizes(done)) < 9_000 and sum(sizes(done)) == 60_000
    assert dealt(rows, "id", 50_000) is rows


def test_rows_of_no_tree_are_told_by_one_comparison(spark):
    rows = spark.range(20_000).withColumn("x", F.array(F.col("id").cast("double")))
    forest = Mo.fit_isolation_forest(rows, "x", "id", trees=20, tree_rows=16)
    filters = [line for line in forest._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter (" in line]
    assert filters and not any("lambda" in line for line in filters)
    sizes = {r["tree"]: r["rows"] for r in forest.collect()}
    assert len(sizes) == 20 and all(4 <= n <= 16 for n in sizes.values())


def test_driver_ranking(accounts, model):
    rows = {r["feature"]: r["mean_abs"] for r in E.driver_ranking(A.with_attributions(accounts, model), "contributions", ["a", "b", "c"]).collect()}
    assert max(rows, key=rows.get) == "a" and len(rows) == 3


def test_search(accounts):
    train, validation = accounts.filter("id % 4 <> 0"), accounts.filter("id % 4 = 0")
    settings, area = Mo.search_boosted(train, validation, trials=2, rounds=3)
    assert 3 <= settings["depth"] <= 9 and 0.01 <= settings["step"] <= 0.3 and area > 0.6


def test_search_starts_no_job_per_level(spark, accounts):
    """Rounds and levels of the trials run inside their tasks."""
    train, validation = accounts.filter("id % 4 > 0"), accounts.filter("id % 4 = 0")
    sc = spark.sparkContext
    sc.setJobGroup("search", "")
    Mo.search_boosted(train, validation, trials=2, rounds=10)
    jobs = len(sc.statusTracker().getJobIdsForGroup("search"))
    sc.setJobGroup("other", "")
    assert jobs < 30


def test_multiclass(spark):
    rng = np.random.default_rng(2)
    rows = [(float(c), [float(v) for v in rng.normal(size=2) + 4 * np.array([c == 1, c == 2])]) for c in (0, 1, 2) for _ in range(60)]
    df = spark.createDataFrame(rows, "label double, x array<double>").withColumn("features", array_to_vector("x")).cache()
    for done in (Mo.multinomial(len(rows), iterations=100).fit(df).transform(df), Mo.classified(df, Mo.multiclass_boosted(df, 3, rounds=2, depth=2))):
        assert done.filter("prediction = label").count() > 160


@pytest.fixture(scope="module")
def planted(spark):
    """1,000 rows on a plane with noise, 30 planted away from it."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(1000, 2))
    x = np.hstack([base, base @ rng.normal(size=(2, 3)) + 0.1 * rng.normal(size=(1000, 3))])
    y = np.zeros(1000, dtype=int)
    y[:30] = 1
    x[:30] += rng.choice([-6.0, 6.0], size=(30, 5))
    columns = [f"m{i}" for i in range(5)]
    return spark.createDataFrame([(i, int(y[i]), *map(float, r)) for i, r in enumerate(x)], "id long, y int, " + ", ".join(f"{c} double" for c in columns)).cache(), columns


def test_ensemble_ranks_planted_rows_first(planted):
    df, columns = planted
    scores = Mo.ensemble_scores(df, columns, "id", "y", trees=50, steps=15).cache()
    assert scores.count() == 1000
    for c in ("iso_score", "svm_score", "ae_rmse"):
        assert E.areas(scores, "y", c).first()["roc_auc"] > 0.85, c
    top = scores.agg(F.min("iso_score"), F.max("iso_score")).first()
    assert 0 < top[0] < top[1] <= 1


def test_forest_is_bounded_and_repeatable(planted):
    df, columns = planted
    rows = df.withColumn("x", F.array(*columns))
    forest = lambda: Mo.fit_isolation_forest(rows, "x", "id", trees=5, tree_rows=64)
    first = sorted(map(tuple, forest().collect()))
    assert first == sorted(map(tuple, forest().repartition(3).collect()))
    per_tree = {r["tree"]: r["rows"] for r in forest().collect()}
    assert set(per_tree) == set(range(5)) and max(per_tree.values()) <= 64
    assert len(first) <= 5 * 2 * 64


def test_scores_do_not_depend_on_a_fixed_depth(planted):
    df, columns = planted
    rows = df.withColumn("x", F.array(*columns))
    mean = lambda n: Mo.isolation_scores(rows, Mo.fit_isolation_forest(rows, "x", "id", trees=10, tree_rows=n), "x").agg(F.avg("iso_score")).first()[0]
    # leaves are reached however deep the trees are
    assert abs(mean(64) - mean(1000)) < 0.15


def test_reconstruction_matches_svd(planted):
    df, columns = planted
    fitted = Mo.fit_reconstruction(df, columns, F.col("y") == 0, k=2)
    got = [r["e"] for r in Mo.reconstruction_error(df, columns, fitted, "e").orderBy("id").collect()]
    x = np.array([tuple(r)[2:] for r in df.orderBy("id").collect()])
    normal = x[30:]
    mean = normal.mean(axis=0)
    v = np.linalg.svd(normal - mean, full_matrices=False)[2][:2].T
    rest = (x - mean) - (x - mean) @ v @ v.T
    assert got == pytest.approx(list(np.sqrt((rest**2).mean(axis=1))))


def test_net_follows_what_bends(spark):
    """On a curve the plane is far off; the net is never worse than it, and the same again for other partitions of equal rows."""
    rng = np.random.default_rng(4)
    t = rng.uniform(-2, 2, size=3000)
    x = np.stack([t, t**2 - 1.3, np.sin(2 * t)], axis=1) + 0.02 * rng.normal(size=(3000, 3))
    df = spark.createDataFrame([(i, 0, *map(float, r)) for i, r in enumerate(x)], "id long, y int, a double, b double, c double")
    normal, columns = F.col("y") == 0, ["a", "b", "c"]
    net = Mo.fit_autoencoder(df, columns, normal, k=1)
    plane = Mo.reconstruction_error(df, columns, Mo.fit_reconstruction(df, columns, normal, 1), "e").agg(F.avg(F.col("e") ** 2)).first()[0]
    got = Mo.autoencoder_error(df, columns, net, "e").agg(F.avg(F.col("e") ** 2)).first()[0]
    assert got == pytest.approx(net.loss, rel=1e-9) and got < 0.5 * plane
    none = Mo.fit_autoencoder(df, columns, normal, k=1, passes=1)
    assert none.loss == pytest.approx(plane, rel=1e-6)


def test_net_gradients_by_differences():
    rng = np.random.default_rng(5)
    weights = [rng.normal(size=s) for s in ((4, 3), 3, (3, 2), (2, 3), 3, (3, 4), 4)]
    net = Mo.Autoencoder(rng.normal(size=4), rng.normal(size=(2, 4)), weights)
    x = rng.normal(size=(7, 4))
    flat, slope = net.flat(), net.gradients(x)
    for i in range(len(flat)):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        change = net.with_flat(flat + step).errors(x).mean() - net.with_flat(flat - step).errors(x).mean()
        assert slope[i] == pytest.approx(change / 2e-6, abs=1e-6)


def test_boundary_reaches_its_optimum(planted):
    """The stated gap holds against the exact corner, and the objective against many plain steps."""
    df, columns = planted
    rows = df.withColumn("x", F.array(*columns))
    model = Mo.fit_one_class(rows, "x", 0.05, width=32, tolerance=0.01)
    z = model.features(np.array([r["x"] for r in rows.collect()]))
    mass = Mo.outside_share(0.05) * len(z)

    def lowest(normal):
        order = np.argsort(z @ normal)
        take = np.clip(mass - np.arange(len(z)), 0, 1)
        return (z[order] * take[:, None]).sum(axis=0) / mass

    square = float(model.normal @ model.normal)
    gap = (square - float(model.normal @ lowest(model.normal))) / square
    assert -1e-9 <= gap <= model.gap + 1e-9 and model.gap <= 0.01 and model.passes < 60
    plain = z.mean(axis=0)
    for step in range(3000):
        plain = plain + 2.0 / (step + 2) * (lowest(plain) - plain)
    assert square <= float(plain @ plain) * 1.02
    assert (model.score(np.array([r["x"] for r in rows.collect()])) > 1e-9).sum() <= mass
    assert Mo.fit_one_class(rows.limit(0), "x", 0.05).score(np.zeros((2, 1))).tolist() == [0.0, 0.0]
