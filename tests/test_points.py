from pyspark.sql import functions as F

from flowlens.operators import points as P


def test_poisson_points(spark):
    base = spark.range(0, 20000, 1, 6).select(F.col("id").alias("i"))
    df = P.poisson_points(base, "i")
    r = df.agg(F.count("*").alias("n"), F.countDistinct("key").alias("k"), F.mean("x").alias("mx"),
               F.mean("y").alias("my"), F.variance("x").alias("vx")).collect()[0]
    assert r.n == 20000 and r.k == 20000
    assert abs(r.mx - 50) < 0.5 and abs(r.my - 20) < 0.3 and abs(r.vx - 50) < 3
    # same seed -> same rows, whatever the partitioning
    again = P.poisson_points(base.repartition(3), "i")
    assert sorted(df.collect()) == sorted(again.collect())
    assert df.filter(F.col("key") == "000042").count() == 1


def test_poisson_inverse_cdf_matches_scan():
    import bisect
    cdf = P.poisson_cdf(20.0)
    for u in (1e-12, 0.001, 0.3, 0.5, 0.9, 0.999999):
        assert bisect.bisect_right(cdf, u) == sum(1 for c in cdf if c <= u)


def test_cluster_points(spark):
    base = spark.range(0, 8000, 1, 4).select(F.col("id").alias("i"))
    df = P.cluster_points(base, "i").withColumn("c", F.pmod(F.substring("key", 1, 6).cast("int"), F.lit(4)))
    cs = P.cluster_centers()
    got = {r.c: (r.mx, r.my) for r in df.groupBy("c").agg(F.mean("x").alias("mx"), F.mean("y").alias("my")).collect()}
    for c, (mx, my) in got.items():
        assert abs(mx - cs[c][0]) < 0.1 and abs(my - cs[c][1]) < 0.1


def test_merge_points_full_outer(spark):
    a = spark.createDataFrame([("000001", 1.0, 2.0), ("000002", 3.0, 4.0)], "key STRING, x DOUBLE, y DOUBLE")
    b = spark.createDataFrame([("000002", 5.0, 6.0), ("000003", 7.0, 8.0)], "key STRING, x DOUBLE, y DOUBLE")
    got = {r.key: tuple(r)[1:] for r in P.merge_points(a, b).collect()}
    assert got == {"000001": (1.0, 2.0, None, None), "000002": (3.0, 4.0, 5.0, 6.0), "000003": (None, None, 7.0, 8.0)}


def test_kmeans_finds_centres(spark):
    base = spark.range(0, 4000, 1, 4).select(F.col("id").alias("i"))
    res = P.kmeans_fit(P.cluster_points(base, "i"), 4, 20).collect()
    assert len(res) == 4 and sum(r.n for r in res) == 4000


def test_kmeans_computes_points_once(spark):
    """However many fits and passes, a point is computed once."""
    seen = spark.sparkContext.accumulator(0)

    def point(i):
        seen.add(1)
        return (float(i % 2 * 10), float(i % 3))

    points = spark.createDataFrame(spark.sparkContext.parallelize(range(600), 4).map(point), "x double, y double")
    res = P.kmeans_fit(points, 2, 5, restarts=3).collect()
    assert sorted(r.n for r in res) == [300, 300] and seen.value == 600
