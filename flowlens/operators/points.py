"""Point generators (L1, L2), point merge (D2) and KMeans (L3).

The reference generates 100,000 points per set from unseeded RNGs in 30
partitions. Here every point is a pure function of (seed, row id): random
numbers come from MD5 of ``seed:stream:id`` (a counter-based generator), so
a point does not depend on partitioning, a retried task reproduces it
exactly, and the points of a table are generated where its rows are, with
no shuffle. Poisson values use the inverse CDF (a literal table built from
the mean); normal values use Box-Muller.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO52 = float(1 << 52)
# Fixed values (the reference's generator parameters): Poisson rates 50
# and 20; 4 clusters in 2 dimensions with radius 10.
POISSON_MEANS = (50.0, 20.0)
CLUSTER_K, CLUSTER_DIM, CLUSTER_R = 4, 2, 10.0
DEFAULT_SEED = 42
ROUND_DIGITS = 6


def uniform(seed: int, stream: str, id_col: Column) -> Column:
    """U(0,1) from MD5(seed:stream:id): 52 random bits, never 0 or 1."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(stream), id_col.cast("string")))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / TWO52


def uniform_py(seed: int, stream: str, i: int) -> float:
    """The same generator in Python (driver-side constants such as centres)."""
    h = hashlib.md5(f"{seed}:{stream}:{i}".encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / TWO52


def normal(seed: int, stream: str, id_col: Column) -> Column:
    """N(0,1) by Box-Muller from two uniforms."""
    u1, u2 = uniform(seed, stream + "/a", id_col), uniform(seed, stream + "/b", id_col)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)


def normal_py(seed: int, stream: str, i: int) -> float:
    u1, u2 = uniform_py(seed, stream + "/a", i), uniform_py(seed, stream + "/b", i)
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(2.0 * math.pi * u2)


def poisson_cdf(mean: float) -> list[float]:
    """Cumulative probabilities P(X <= k), k = 0, 1, ... until they reach 1.0
    in double precision (so the lookup below never runs off the table)."""
    out, p, c, k = [], math.exp(-mean), 0.0, 0
    while True:
        c += p
        if c >= 1.0 or k > mean + 60 * math.sqrt(mean) + 60:
            out.append(1.0)
            return out
        out.append(c)
        k += 1
        p = p * mean / k


def poisson_sql(mean: float, u: str) -> str:
    """Inverse CDF for the uniform column ``u``: the first k with
    u < P(X <= k) (= the number of CDF entries <= u), as SQL text of a
    balanced binary search of nested CASEs: ~log2(table) comparisons per
    value, all in generated code (a higher-order ``filter`` over the table
    would run interpreted)."""
    cdf = poisson_cdf(mean)

    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return f"{float(lo)}D"
        mid = (lo + hi) // 2
        return f"CASE WHEN {u} < {cdf[mid]!r}D THEN {search(lo, mid)} ELSE {search(mid + 1, hi)} END"
    return search(0, len(cdf) - 1)


def poisson_points(base: DataFrame, id_col: str, means=POISSON_MEANS, seed: int = DEFAULT_SEED) -> DataFrame:
    """L1: one 2-d Poisson point per row of ``base`` -> (key '%06d', x, y)."""
    i = F.col(id_col)
    us = base.select(F.format_string("%06d", i).alias("key"),
                     uniform(seed, "poisson/x", i).alias("_ux"), uniform(seed, "poisson/y", i).alias("_uy"))
    return us.selectExpr("key", f"{poisson_sql(means[0], '_ux')} AS x", f"{poisson_sql(means[1], '_uy')} AS y")


def cluster_centers(k: int = CLUSTER_K, d: int = CLUSTER_DIM, r: float = CLUSTER_R,
                    seed: int = DEFAULT_SEED) -> list[list[float]]:
    """k centres of d normal coordinates scaled by r (a k*d parameter table)."""
    return [[normal_py(seed, f"center/{j}", t) * r for t in range(d)] for j in range(k)]


def cluster_points(base: DataFrame, id_col: str, k: int = CLUSTER_K, d: int = CLUSTER_DIM,
                   r: float = CLUSTER_R, seed: int = DEFAULT_SEED) -> DataFrame:
    """L2: point i = centre (i mod k) + N(0, 1) per coordinate -> (key, x, y...)."""
    i = F.col(id_col)
    cs = cluster_centers(k, d, r, seed)
    names = ["x", "y"] + [f"c{t}" for t in range(2, d)]
    cols = []
    for t in range(d):
        centre = F.element_at(F.array(*[F.lit(c[t]) for c in cs]), (F.pmod(i, F.lit(k)) + 1).cast("int"))
        cols.append(F.round(centre + normal(seed, f"point/{t}", i), ROUND_DIGITS).alias(names[t]))
    return base.select(F.format_string("%06d", i).alias("key"), *cols)


def merge_points(b: DataFrame, k: DataFrame) -> DataFrame:
    """Two point sets that share keys -> one row per key with both
    (bx, by, kx, ky); a key missing from one set keeps NULLs there.

    A union + one grouped aggregate (one exchange, hash aggregate) instead of
    a full outer sort-merge join (two exchanges and two sorts).
    """
    u = b.select("key", F.lit(0).alias("s"), "x", "y").unionByName(
        k.select("key", F.lit(1).alias("s"), "x", "y"))
    return u.groupBy("key").agg(
        F.max(F.when(F.col("s") == 0, F.col("x"))).alias("bx"),
        F.max(F.when(F.col("s") == 0, F.col("y"))).alias("by"),
        F.max(F.when(F.col("s") == 1, F.col("x"))).alias("kx"),
        F.max(F.when(F.col("s") == 1, F.col("y"))).alias("ky"))


def kmeans_fit(points: DataFrame, k: int, iters: int = 20, seed: int = 1,
               features: list[str] = ("x", "y"), restarts: int = 1) -> DataFrame:
    """L3: KMeans (Spark ML, distributed Lloyd iterations) -> centres. Of
    ``restarts`` seeds the fit of least cost is kept: one start may end in a
    local optimum. The points are computed once, over all task slots, and kept
    for every pass of every fit."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    spark = points.sparkSession
    slots = spark.sparkContext.defaultParallelism
    rows = points.select(*features)
    if rows.rdd.getNumPartitions() < slots:
        rows = rows.repartition(slots)
    va = VectorAssembler(inputCols=list(features), outputCol="features")
    given = va.transform(rows).select("features").persist()
    try:
        fits = (KMeans(k=k, maxIter=iters, seed=seed + i, featuresCol="features").fit(given) for i in range(restarts))
        model = min(fits, key=lambda m: m.summary.trainingCost)
        # k rows
        sizes = {r["prediction"]: r["n"] for r in model.transform(given).groupBy("prediction")
                 .agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        given.unpersist()
    return spark.createDataFrame(
        [(i, sizes.get(i), [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster INT, n BIGINT, center ARRAY<DOUBLE>")
