"""Models of samples: scaling, PCA, K-Means, a hashed hold-out and a random forest.

Everything is fitted by Spark ML on the distributed per-sample table. Only model
metadata whose size the settings bound (means, loadings, centres, trees, metrics) reaches
the driver.

Starting points and bags are drawn partition by partition, so every fit runs on rows that
:func:`fixed_layout` has dealt: which rows share a partition, and in which order, follows
from the samples alone, not from ``spark.sql.shuffle.partitions`` or adaptive execution. With
one partition, which is up to ``rows_per_partition`` samples, results are the same to the
last bit; with several, sums may differ in their last bits from run to run.

The regression target is no independent quantity: each sample has a row for every
gene, so ``library_size`` is ``avg_count`` times a constant. A high R² restates that
identity and says nothing about predictive power. For the same reason three of the four
features are collinear and two components explain all variance.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (
    PCA,
    ElementwiseProduct,
    PCAModel,
    StandardScaler,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matrixmill.functions.expressions import is_detected, is_zero, share
from matrixmill.functions.names import COUNT, LIBRARY_SIZE, SAMPLE
from matrixmill.sources.tables import checkpointed

# Features in model order, target, and model settings.
FEATURE_COLUMNS = ("avg_count", "num_zero_genes", "num_detected_genes", "pct_zero_genes")
TARGET_COLUMN = LIBRARY_SIZE
N_COMPONENTS = 2
N_CLUSTERS = 3
N_ESTIMATORS = 200
TEST_SIZE = 0.2
RANDOM_STATE = 42

# Settings of the Spark estimators. A tree has fewer than 2**(MAX_DEPTH + 1) nodes however
# many samples there are; with fewer samples than bins every split point between two samples
# is tried.
MAX_DEPTH = 10
MAX_BINS = 128
MIN_LEAF = 1
N_STARTS = 10
PARALLEL_FITS = 4
KMEANS_ITERATIONS = 300
KMEANS_TOLERANCE = 1e-9
ROWS_PER_PARTITION = 100_000


@dataclass(frozen=True)
class ModelSettings:
    """All parameters of :func:`run_modeling`."""

    n_components: int = N_COMPONENTS
    n_clusters: int = N_CLUSTERS
    n_starts: int = N_STARTS
    test_size: float = TEST_SIZE
    n_estimators: int = N_ESTIMATORS
    max_depth: int = MAX_DEPTH
    max_bins: int = MAX_BINS
    min_leaf: int = MIN_LEAF
    bootstrap: bool = True
    random_state: int = RANDOM_STATE
    rows_per_partition: int = ROWS_PER_PARTITION

    @property
    def most_nodes(self) -> int:
        """What the forest on the driver never exceeds, whatever the number of samples."""
        return self.n_estimators * (2 ** (self.max_depth + 1) - 1)


FEATURES = "features"
SCALED = "scaled"

#: Leading hex digits of the split key that form a bucket: at most 16**4 buckets.
_BUCKET_DIGITS = 4


class UnsupervisedFit(NamedTuple):
    """Rows with ``PC1…`` and ``cluster``, the variance ratios, and the fitted stages."""

    scored: DataFrame
    explained_variance_ratio: list[float]
    model: PipelineModel


class SupervisedFit(NamedTuple):
    """Rows with ``pred_library_size``, metrics of the test rows, and the forest."""

    scored: DataFrame
    metrics: dict[str, float | None]
    model: RandomForestRegressionModel


def fixed_layout(
    df: DataFrame, key: str = SAMPLE, rows_per_partition: int = ROWS_PER_PARTITION
) -> DataFrame:
    """``df`` checkpointed in a layout that only its rows decide.

    Rows are dealt by the hash of ``key`` to one partition per ``rows_per_partition`` rows,
    and sorted by it. The number is given to ``repartition``, so neither the session's number
    of shuffle partitions nor adaptive execution changes it. ``df`` is evaluated twice; pass a
    stored or checkpointed table when that is costly.
    """
    partitions = max(1, math.ceil(df.count() / rows_per_partition))
    return checkpointed(df.repartition(partitions, key).sortWithinPartitions(key))


def build_modeling_features(
    df_norm: DataFrame, sample_column: str = SAMPLE, count_column: str = COUNT
) -> DataFrame:
    """One row per sample from raw counts, all values double."""
    return (
        df_norm.groupBy(sample_column)
        .agg(
            F.sum(count_column).alias(TARGET_COLUMN),
            F.avg(count_column).alias("avg_count"),
            F.count_if(is_zero(count_column)).cast("double").alias("num_zero_genes"),
            F.count_if(is_detected(count_column)).cast("double").alias("num_detected_genes"),
        )
        .withColumn("pct_zero_genes", share("num_zero_genes", "num_detected_genes"))
    )


def to_feature_matrix(df: DataFrame, output_column: str = FEATURES) -> DataFrame:
    """Adds the four features as one vector, in fixed order."""
    _require_columns(df)
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol=output_column).transform(df)


def _require_columns(df: DataFrame) -> None:
    missing = [name for name in (*FEATURE_COLUMNS, TARGET_COLUMN) if name not in df.columns]
    if missing:
        raise KeyError(f"The sample table lacks {missing}")


def fit_scaler(df: DataFrame) -> PipelineModel:
    """Stages that add the vector ``scaled`` of z-scores with the population deviation.

    Spark's scaler divides by the sample standard deviation, which differs by one
    factor for all features.
    """
    _require_columns(df)
    num_rows = df.count()
    factor = math.sqrt(num_rows / (num_rows - 1)) if num_rows > 1 else 1.0
    stages = [
        VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol=FEATURES),
        StandardScaler(inputCol=FEATURES, outputCol="centred", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="centred",
            outputCol=SCALED,
            scalingVec=Vectors.dense([factor] * len(FEATURE_COLUMNS)),
        ),
    ]
    return Pipeline(stages=stages).fit(df)


def scale_features(df: DataFrame) -> DataFrame:
    """Adds the vector ``scaled``; a constant feature becomes 0."""
    return fit_scaler(df).transform(df).drop(FEATURES, "centred")


def fit_projection(
    scaled: DataFrame, n_components: int = N_COMPONENTS
) -> tuple[DataFrame, PCAModel]:
    """Adds ``PC1…``, each pointing towards larger ``avg_count``."""
    model = PCA(k=n_components, inputCol=SCALED, outputCol="projected").fit(scaled)
    projected = vector_to_array("projected")
    components = {
        f"PC{i + 1}": projected[i] * (-1.0 if loading < 0 else 1.0)
        for i, loading in enumerate(model.pc.toArray()[0])
    }
    return model.transform(scaled).withColumns(components).drop("projected"), model


def fit_clusters(
    scaled: DataFrame,
    n_clusters: int = N_CLUSTERS,
    random_state: int = RANDOM_STATE,
    n_starts: int = N_STARTS,
) -> tuple[DataFrame, KMeansModel]:
    """Adds ``cluster``, numbered by ascending ``avg_count`` of the cluster's centre.

    Of ``n_starts`` fits, with the seeds from ``random_state`` on, the one with the least
    training cost is taken, the first of equal ones. ``scaled`` should come from a table in
    :func:`fixed_layout`, and is read by every start.
    """

    def fit(seed: int) -> KMeansModel:
        return KMeans(
            k=n_clusters,
            seed=seed,
            maxIter=KMEANS_ITERATIONS,
            tol=KMEANS_TOLERANCE,
            featuresCol=SCALED,
            predictionCol="raw_cluster",
        ).fit(scaled)

    # The fits are independent and each is many small jobs, so some run side by side.
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        models = list(pool.map(fit, range(random_state, random_state + n_starts)))
    costs = [fitted.summary.trainingCost for fitted in models]
    # Equal clusters may differ in the last bits of their cost.
    model = next(x for x, cost in zip(models, costs) if cost <= min(costs) * (1 + 1e-9))
    centres = [tuple(centre) for centre in model.clusterCenters()]
    ranks = F.array(*[F.lit(sorted(centres).index(centre)) for centre in centres])
    numbered = model.transform(scaled).withColumn("cluster", F.get(ranks, F.col("raw_cluster")))
    return numbered.drop("raw_cluster"), model


def fit_pca_kmeans(
    df: DataFrame,
    n_components: int = N_COMPONENTS,
    n_clusters: int = N_CLUSTERS,
    random_state: int = RANDOM_STATE,
    n_starts: int = N_STARTS,
) -> UnsupervisedFit:
    """Projects the z-scores and clusters them (the z-scores, not the projection).

    ``df`` is read several times, so pass a table of :func:`fixed_layout`.
    """
    scaler = fit_scaler(df)
    scaled = scaler.transform(df).drop(FEATURES, "centred")
    projected, pca = fit_projection(scaled, n_components)
    clustered, kmeans = fit_clusters(projected, n_clusters, random_state, n_starts)
    return UnsupervisedFit(
        clustered.drop(SCALED),
        [float(ratio) for ratio in pca.explainedVariance],
        PipelineModel(stages=[*scaler.stages, pca, kmeans]),
    )


def assign_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    random_state: int = RANDOM_STATE,
    sample_column: str = SAMPLE,
) -> DataFrame:
    """Adds ``is_test``, true for exactly ``ceil(test_size * n)`` rows.

    Rows are ranked by the MD5 of sample and seed, so the choice depends neither on
    partitioning nor on row order. No task ever sorts all rows: the rank is the number
    of rows in lower buckets (a table of at most 65,536 counts) plus the rank within
    the bucket. Samples are expected to be unique.
    """
    keyed = df.withColumn(
        "_key", F.md5(F.concat_ws(":", F.col(sample_column), F.lit(str(random_state))))
    ).withColumn("_bucket", F.substring("_key", 1, _BUCKET_DIGITS))
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        keyed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_size").over(lower), F.lit(0)).alias("_below"),
            F.sum("_size").over(everything).alias("_total"),
        )
    )
    within = Window.partitionBy("_bucket").orderBy("_key", sample_column)
    rank = F.col("_below") + F.row_number().over(within)
    return keyed.join(F.broadcast(buckets), "_bucket").select(
        *df.columns, (rank <= F.ceil(F.lit(float(test_size)) * F.col("_total"))).alias("is_test")
    )


def train_test_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    random_state: int = RANDOM_STATE,
    sample_column: str = SAMPLE,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of :func:`assign_split`."""
    split = assign_split(df, test_size, random_state, sample_column)
    return (
        split.filter(~F.col("is_test")).drop("is_test"),
        split.filter(F.col("is_test")).drop("is_test"),
    )


def _metric_columns(y_true: str, y_pred: str) -> dict[str, Column]:
    y = F.col(y_true).cast("double")
    error = y - F.col(y_pred).cast("double")
    squared = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    mse = F.avg(error * error)
    return {
        "r2": 1 - F.try_divide(squared, spread),
        "mae": F.avg(F.abs(error)),
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mape": F.avg(F.abs(F.try_divide(error, y))) * 100,
    }


def regression_metrics_table(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred"
) -> DataFrame:
    """One row of r2, mae, mse, rmse and mape, plus ``zero_targets``, in one aggregation.

    ``r2`` is null for a constant target. ``mape`` only covers all rows when
    ``zero_targets`` is 0.
    """
    columns = _metric_columns(y_true, y_pred)
    return df.agg(
        *[column.alias(name) for name, column in columns.items()],
        F.count_if(F.col(y_true) == 0).alias("zero_targets"),
    )


def regression_metrics(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred"
) -> dict[str, float | None]:
    """The metrics as a dictionary; refuses targets of zero, for which MAPE has no value."""
    row = regression_metrics_table(df, y_true, y_pred).first().asDict()
    if row.pop("zero_targets"):
        raise ValueError("MAPE has no value when a true value is zero.")
    return row


def train_library_size_model(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    n_estimators: int = N_ESTIMATORS,
    random_state: int = RANDOM_STATE,
    sample_column: str = SAMPLE,
    max_depth: int = MAX_DEPTH,
    max_bins: int = MAX_BINS,
    min_leaf: int = MIN_LEAF,
    bootstrap: bool = True,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> SupervisedFit:
    """Forest regression of the target on the unscaled features.

    Metrics cover the test rows only. Predictions cover all rows, so most of them are
    in-sample. Bags are drawn on rows in :func:`fixed_layout`, so they depend on the samples
    and the seed only. ``max_depth`` bounds the nodes of a tree, and with them the driver's
    memory. Without ``bootstrap`` all trees are one and the same.
    """
    vectors = to_feature_matrix(df)
    split = assign_split(vectors, test_size, random_state, sample_column)
    split = fixed_layout(checkpointed(split), sample_column, rows_per_partition)
    train, test = split.filter(~F.col("is_test")), split.filter(F.col("is_test"))
    forest = RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=TARGET_COLUMN,
        predictionCol="pred_library_size",
        numTrees=n_estimators,
        seed=random_state,
        maxDepth=max_depth,
        maxBins=max_bins,
        minInstancesPerNode=min_leaf,
        bootstrap=bootstrap,
        featureSubsetStrategy="all",
    )
    model = forest.fit(train)
    metrics = regression_metrics(model.transform(test), TARGET_COLUMN, "pred_library_size")
    return SupervisedFit(model.transform(vectors).drop(FEATURES), metrics, model)


def build_prediction_table(unsupervised: UnsupervisedFit, supervised: SupervisedFit) -> DataFrame:
    """Sample table with projection, cluster, prediction, target and the two model scores.

    The forest scores the clustered rows, so nothing has to be joined. The scores are
    literals on every row.
    """
    vectors = to_feature_matrix(unsupervised.scored)
    metrics = supervised.metrics
    return (
        supervised.model.transform(vectors)
        .drop(FEATURES)
        .withColumn("target_library_size", F.col(TARGET_COLUMN))
        .withColumn("model_r2", F.lit(metrics["r2"]).cast("double"))
        .withColumn("model_rmse", F.lit(metrics["rmse"]).cast("double"))
    )


def sample_table(
    df_norm: DataFrame,
    sample_column: str = SAMPLE,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """The modelling table, stored in :func:`fixed_layout`, since every fit reads it."""
    features = checkpointed(build_modeling_features(df_norm, sample_column))
    return fixed_layout(features, sample_column, rows_per_partition)


def run_modeling(
    df_norm: DataFrame, settings: ModelSettings = ModelSettings()
) -> tuple[DataFrame, dict[str, float | None]]:
    """The prediction table of a normalised count table, and the test metrics."""
    samples = sample_table(df_norm, rows_per_partition=settings.rows_per_partition)
    unsupervised = fit_pca_kmeans(
        samples,
        n_components=settings.n_components,
        n_clusters=settings.n_clusters,
        random_state=settings.random_state,
        n_starts=settings.n_starts,
    )
    supervised = train_library_size_model(
        samples,
        test_size=settings.test_size,
        n_estimators=settings.n_estimators,
        random_state=settings.random_state,
        max_depth=settings.max_depth,
        max_bins=settings.max_bins,
        min_leaf=settings.min_leaf,
        bootstrap=settings.bootstrap,
        rows_per_partition=settings.rows_per_partition,
    )
    return build_prediction_table(unsupervised, supervised), supervised.metrics
