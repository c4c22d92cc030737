"""Project life cycle: durations, standardising, components and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from scholarweave.functions.text import year_column
from scholarweave.workspace import materialise

FEATURES = ("duration", "time_to_publish")


def with_lifecycle(
    df: DataFrame, start: str, end: str, output: str
) -> DataFrame:
    """Add duration and time to publish; rows without three years or with a negative value go."""
    s, e, o = year_column(df, start), year_column(df, end), year_column(df, output)
    return df.withColumns({"duration": e - s, "time_to_publish": o - s}).where(
        (F.col("duration") >= 0) & (F.col("time_to_publish") >= 0)
    )


def feature_groups(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Distinct feature combinations with their frequency.

    Features are whole years, so however many records there are, only some
    thousands of combinations go into fitting.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))


def standard_scores(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """z-scores by population deviation, as expressions; a constant column gives 0.

    Means and deviations are two numbers per column, computed in one aggregation.
    """
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    scores = {}
    for c in columns:
        mean, deviation = stats[f"m_{c}"], stats[f"s_{c}"]
        if mean is None:
            scores[c] = F.lit(None).cast("double")
        elif not deviation:
            scores[c] = F.lit(0.0)
        else:
            scores[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation)
    return scores


def weighted_scores(groups: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """As :func:`standard_scores`, from distinct rows with a frequency."""
    w = F.col("weight")
    sums = groups.agg(
        F.sum(w).alias("n"),
        *[F.sum(w * F.col(c)).alias(f"a_{c}") for c in columns],
        *[F.sum(w * F.col(c) * F.col(c)).alias(f"q_{c}") for c in columns],
    ).first()
    scores = {}
    for c in columns:
        if not sums["n"]:
            scores[c] = F.lit(None).cast("double")
            continue
        n, total, squares = int(sums["n"]), int(sums[f"a_{c}"]), int(sums[f"q_{c}"])
        # Whole-number sums keep the variance free of cancellation.
        variance = (n * squares - total * total) / (n * n)
        if variance == 0:
            scores[c] = F.lit(0.0)
        else:
            scores[c] = (F.col(c).cast("double") - F.lit(total / n)) / F.lit(variance**0.5)
    return scores


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by their z-scores. The rows are stored: they are read twice."""
    df = materialise(df, "scored")
    return df.withColumns(standard_scores(df, columns))


def fit_lifecycle_clusters(groups: DataFrame, k: int = 2, seed: int = 42) -> KMeansModel:
    """k-means on standardised features; frequencies act as weights."""
    scaled = groups.withColumns(
        {f"z_{c}": s for c, s in weighted_scores(groups, FEATURES).items()}
    )
    features = VectorAssembler(inputCols=[f"z_{c}" for c in FEATURES], outputCol="features")
    # Without a tolerance it ends where nothing moves any more.
    fitted = KMeans(k=k, seed=seed, weightCol="weight", featuresCol="features", tol=0.0, maxIter=500)
    return fitted.fit(features.transform(scaled))


def lifecycle_clusters(df: DataFrame, k: int = 2, seed: int = 42) -> DataFrame:
    """Append a cluster number to records with life-cycle columns.

    Clusters are numbered by mean duration, because the numbers k-means hands
    out are arbitrary. Labelling compares each record with ``k`` constant
    centres, without a shuffle.
    """
    df = materialise(df, "lifecycles")
    groups = materialise(feature_groups(df), "features")
    scores = weighted_scores(groups, FEATURES)
    model = fit_lifecycle_clusters(groups, k, seed)
    centres = sorted([float(x) for x in c] for c in model.clusterCenters())
    distances = [
        F.struct(
            (
                (scores["duration"] - F.lit(c[0])) * (scores["duration"] - F.lit(c[0]))
                + (scores["time_to_publish"] - F.lit(c[1]))
                * (scores["time_to_publish"] - F.lit(c[1]))
            ).alias("d"),
            F.lit(i).alias("cluster"),
        )
        for i, c in enumerate(centres)
    ]
    nearest = distances[0] if len(distances) == 1 else F.least(*distances)
    return df.withColumn("lifecycle_cluster", nearest["cluster"])


def fit_topic_pca(matrix: DataFrame, k: int = 18) -> tuple[DataFrame, PCAModel]:
    """Standardised year-by-topic matrix and its component model.

    ``k`` is lowered to the number of topics. The matrix has one row per year;
    only topics x topics numbers reach the driver.
    """
    topics = [c for c in matrix.columns if c != "year"]
    matrix = materialise(matrix, "matrix")
    scaled = standardise(matrix, topics)
    vectors = VectorAssembler(inputCols=topics, outputCol="features").transform(scaled)
    model = PCA(k=min(k, len(topics)), inputCol="features", outputCol="scores").fit(vectors)
    return vectors, model


def topic_pca(matrix: DataFrame, k: int = 18) -> DataFrame:
    """Scores per year, PC1 to PCk; each component's largest loading is made positive."""
    vectors, model = fit_topic_pca(matrix, k)
    loadings = model.pc.toArray()
    signs = [1.0 if max(column, key=abs) >= 0 else -1.0 for column in loadings.T]
    scores = vector_to_array("scores")
    return model.transform(vectors).select(
        "year", *[(scores[i] * F.lit(s)).alias(f"PC{i + 1}") for i, s in enumerate(signs)]
    )


def explained_variance(matrix: DataFrame, k: int = 18) -> DataFrame:
    """Share of variance per component and its running sum."""
    _, model = fit_topic_pca(matrix, k)
    shares = [float(v) for v in model.explainedVariance]
    rows, total = [], 0.0
    for i, share in enumerate(shares, start=1):
        total += share
        rows.append((i, share, total))
    return matrix.sparkSession.createDataFrame(
        rows, "component int, share double, running_share double"
    )
