"""The registered queries: every operator, run over the whole order tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matrixmill.functions.names import COUNT, GENE_ID, SAMPLE, sanitize_column_names
from matrixmill.operators import annotation, bronze, features, modeling, normalize, reports, silver
from matrixmill.plans.jobs import run_pipeline
from matrixmill.plans.layout import Layout
from matrixmill.sources import order_matrix, tables
from matrixmill.sources.gtf import read_gtf
from matrixmill.sources.matrix import matrix_schema, read_raw_counts

#: Decimal places of results whose last bits depend on summation order or on the
#: logarithm of the engine.
PLACES = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), PLACES) for name in columns})


# Inputs shared by the queries.


def _matrix_files(spark: SparkSession, sf_dir: str) -> str:
    return order_matrix.write_raw_matrix(spark, sf_dir, tables.stage_path(spark, "matrix.json"))


def _gtf_files(spark: SparkSession, sf_dir: str) -> str:
    return order_matrix.write_gtf(spark, sf_dir, tables.stage_path(spark, "annotation.gtf"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.build_bronze_counts(order_matrix.raw_matrix(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _bronze(spark, sf_dir)
    return silver.cast_sample_columns(df, silver.sample_columns(df))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _typed(spark, sf_dir)
    return silver.unpivot_counts(df, silver.sample_columns(df))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver_counts(_bronze(spark, sf_dir))


def _annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.extract_gene_annotations(order_matrix.gtf_lines(spark, sf_dir))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.join_gene_annotations(_silver(spark, sf_dir), _annotations(spark, sf_dir))


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotated counts are read by two passes, so they are stored in between."""
    return normalize.normalize_counts(tables.staged(_annotated(spark, sf_dir), "counts_with_genes"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.sample_table(_normalized(spark, sf_dir))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.scale_features(_samples(spark, sf_dir))


def _lines_files(spark: SparkSession, sf_dir: str) -> str:
    return order_matrix.write_raw_lines(spark, sf_dir, tables.stage_path(spark, "matrix.jsonl"))


def _lines_schema(spark: SparkSession, sf_dir: str) -> StructType:
    fields = order_matrix.sample_fields(order_matrix.sample_keys(spark, sf_dir))
    text = [name for name, kind in fields.items() if kind == "string"]
    return matrix_schema(order_matrix.RAW_GENE_COLUMN, fields, text)


def _ratio_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with a prediction SQL can repeat: library size per detected gene in training."""
    train, test = modeling.train_test_split(_samples(spark, sf_dir))
    ratio = train.agg(F.sum(modeling.TARGET_COLUMN) / F.sum("num_detected_genes")).first()[0]
    return test.select(
        SAMPLE,
        F.col(modeling.TARGET_COLUMN).alias("target_library_size"),
        (F.col("num_detected_genes") * F.lit(ratio)).alias("pred_library_size"),
    )


# Sources and sinks.


def src_json_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_counts(spark, _matrix_files(spark, sf_dir))


def src_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix as JSON lines, with its schema given: no pass over the data to infer it."""
    schema = _lines_schema(spark, sf_dir)
    return read_raw_counts(spark, _lines_files(spark, sf_dir), multi_line=False, schema=schema)


def src_gtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_gtf(spark, _gtf_files(spark, sf_dir))


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.stage_path(spark, "counts_long")
    tables.write_table(_silver(spark, sf_dir), path)
    return tables.read_table(spark, path)


def table_overwrite_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are replaced by library sizes at the same path."""
    path = tables.stage_path(spark, "replaced")
    counts = tables.staged(_silver(spark, sf_dir), "counts_long")
    tables.write_table(counts, path)
    tables.write_table(normalize.compute_library_sizes(counts), path, overwrite_schema=True)
    return tables.read_table(spark, path)


# Bronze and Silver.


def bronze_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.rename_gene_column(order_matrix.raw_matrix(spark, sf_dir))


def bronze_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = order_matrix.raw_matrix(spark, sf_dir)
    return df.toDF(*sanitize_column_names(df.columns))


def bronze_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.ingest_bronze(spark, _matrix_files(spark, sf_dir))


def bronze_ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.ingest_bronze(
        spark, _lines_files(spark, sf_dir), multi_line=False, schema=_lines_schema(spark, sf_dir)
    )


def stored_gene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gene filter on a stored Bronze table, where the file scan applies it."""
    path = tables.stage_path(spark, "bronze_counts")
    tables.write_table(_bronze(spark, sf_dir), path)
    return silver.filter_ensembl_genes(tables.read_table(spark, path))


def silver_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir)


def silver_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir)


def silver_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _typed(spark, sf_dir)
    return df.select(GENE_ID, F.expr(silver.build_stack_expression(silver.sample_columns(df))))


def silver_gene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.filter_ensembl_genes(_long(spark, sf_dir))


def silver_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fill_missing_counts(_long(spark, sf_dir))


def silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


# Annotation.


def gene_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.add_gene_base(_bronze(spark, sf_dir).select(GENE_ID))


def gene_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.build_gene_annotations(spark, _gtf_files(spark, sf_dir))


def counts_with_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir)


def counts_with_unique_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.join_gene_annotations(
        _silver(spark, sf_dir), _annotations(spark, sf_dir), unique_annotations=True
    )


# Normalisation and marts.


def library_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.compute_library_sizes(_silver(spark, sf_dir))


def nonzero_libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.filter_nonzero_libraries(library_sizes(spark, sf_dir))


def cpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per million of the counts as they are, before any annotation."""
    counts = tables.staged(_silver(spark, sf_dir), "counts_long")
    return _rounded(normalize.normalize_counts(counts), "log1p_cpm")


def normalized_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_normalized(spark, sf_dir), "log1p_cpm")


def sample_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.build_sample_features(_normalized(spark, sf_dir))
    return _rounded(df, "avg_log1p_cpm", "pct_zero_genes")


def gene_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.build_gene_features(_normalized(spark, sf_dir))
    return _rounded(df, "mean_log1p_cpm", "std_log1p_cpm", "pct_samples_detected")


# Models.


def modeling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = modeling.build_modeling_features(_normalized(spark, sf_dir))
    return _rounded(df, "avg_count", "pct_zero_genes")


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the feature vector, in order."""
    parts = vector_to_array(modeling.FEATURES)
    names = [f"f{i}" for i in range(len(modeling.FEATURE_COLUMNS))]
    vectors = modeling.to_feature_matrix(_samples(spark, sf_dir))
    return _rounded(vectors.select(SAMPLE, *[parts[i].alias(x) for i, x in enumerate(names)]), "f0", "f3")


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _scaled(spark, sf_dir)
    scores = vector_to_array(modeling.SCALED)
    names = [f"z_{name}" for name in modeling.FEATURE_COLUMNS]
    scaled = df.select(SAMPLE, *[scores[i].alias(name) for i, name in enumerate(names)])
    return _rounded(scaled, *names)


def pca_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected, _ = modeling.fit_projection(_scaled(spark, sf_dir))
    return _rounded(projected.select(SAMPLE, "PC1", "PC2"), "PC1", "PC2")


def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = modeling.fit_projection(_scaled(spark, sf_dir))
    rows = [(f"PC{i + 1}", float(ratio)) for i, ratio in enumerate(model.explainedVariance)]
    return _rounded(
        spark.createDataFrame(rows, "component string, explained_variance_ratio double"),
        "explained_variance_ratio",
    )


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.fit_clusters(_scaled(spark, sf_dir))[0].select(SAMPLE, "cluster")


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.assign_split(_samples(spark, sf_dir)).select(SAMPLE, "is_test")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = modeling.regression_metrics_table(
        _ratio_predictions(spark, sf_dir), "target_library_size", "pred_library_size"
    )
    return _rounded(table, "r2", "mae", "mse", "rmse", "mape")


def prediction_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    residuals = reports.prediction_residuals(_ratio_predictions(spark, sf_dir))
    return _rounded(residuals, "pred_library_size", "residual")


def rf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default forest. Its bags have no SQL, but each prediction is an average of training
    targets, so it lies within their range."""
    samples = _samples(spark, sf_dir)
    train, _ = modeling.train_test_split(samples)
    target = modeling.TARGET_COLUMN
    least, most = train.agg(F.min(target), F.max(target)).first()
    scored = modeling.train_library_size_model(samples).scored
    inside = F.col("pred_library_size").between(least * (1 - 1e-12), most * (1 + 1e-12))
    return scored.select(SAMPLE, target, inside.alias("in_training_range"))


def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of equal trees: without bags each tree is the one that fits all training rows."""
    samples = _samples(spark, sf_dir)
    fit = modeling.train_library_size_model(samples, n_estimators=2, bootstrap=False)
    split = modeling.assign_split(samples).select(SAMPLE, "is_test")
    scored = fit.scored.join(split, SAMPLE)
    return _rounded(
        scored.select(SAMPLE, "is_test", modeling.TARGET_COLUMN, "pred_library_size"), "pred_library_size"
    )


#: Settings under which SQL can repeat the whole modelling stage.
_EXACT = modeling.ModelSettings(n_estimators=1, bootstrap=False)
_PREDICTED = ("avg_count", "pct_zero_genes", "PC1", "PC2", "pred_library_size", "model_r2", "model_rmse")


def sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(modeling.run_modeling(_normalized(spark, sf_dir), _EXACT)[0], *_PREDICTED)


# Report aggregates.


def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of groups that SQL can form as well: the nations of one region."""
    nations = order_matrix.read_source(spark, sf_dir, "nation").select(
        F.concat(F.lit("nat_"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(SAMPLE),
        F.col("n_regionkey").alias("cluster"),
    )
    grouped = _samples(spark, sf_dir).join(nations, SAMPLE)
    return _rounded(
        reports.cluster_profile(grouped),
        "mean_library_size", "std_library_size", "mean_pct_zero_genes", "std_pct_zero_genes",
    )


def kmeans_cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = reports.cluster_profile(modeling.fit_clusters(_scaled(spark, sf_dir))[0])
    return _rounded(
        profile,
        "mean_library_size", "std_library_size", "mean_pct_zero_genes", "std_pct_zero_genes",
    )


def counts_by_gene_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by_gene_name(_annotated(spark, sf_dir))


def avg_count_by_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.avg_count_by_gene(_annotated(spark, sf_dir)), "avg_count")


def counts_by_gene(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by_gene(_annotated(spark, sf_dir))


def counts_by_gene_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by_gene_sample(_annotated(spark, sf_dir))


def count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_range(_silver(spark, sf_dir))


# Jobs.


def _input_files(spark: SparkSession, sf_dir: str) -> Layout:
    layout = Layout(
        tables.stage_path(spark, "base"), raw_file="matrix.json", gtf_file="annotation.gtf"
    )
    order_matrix.write_raw_matrix(spark, sf_dir, layout.raw_path)
    order_matrix.write_gtf(spark, sf_dir, layout.gtf_path)
    return layout


def stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data stages from files to stored tables; returns the last table they write."""
    return _stored(spark, sf_dir, "gene_features", "bronze", "silver", "annotation", "gold")


def _stored(spark: SparkSession, sf_dir: str, table: str, *stages: str) -> DataFrame:
    """A table as the stages store it, from the input files on."""
    layout = _input_files(spark, sf_dir)
    for stage in stages:
        run_pipeline(spark, layout, stage, _EXACT)
    stored = tables.read_table(spark, layout.table_path(table))
    return _rounded(stored, *[name for name in _STORED_ROUNDED if name in stored.columns])


_STORED_ROUNDED = (
    *_PREDICTED, "log1p_cpm", "avg_log1p_cpm", "mean_log1p_cpm", "std_log1p_cpm", "pct_samples_detected",
)


def stored_bronze_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "bronze_counts", "bronze")


def stored_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "counts_long", "bronze", "silver")


def stored_gene_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "gene_annotations", "annotation")


def stored_counts_with_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "counts_with_genes", "bronze", "silver", "annotation", "gold")


def stored_normalized_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "normalized_counts", "bronze", "silver", "annotation", "gold")


def stored_sample_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "sample_features", "bronze", "silver", "annotation", "gold")


def stored_gene_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read after all five stages have run: the modelling stage leaves the others' tables alone."""
    return _stored(spark, sf_dir, "gene_features", "all")


def stored_sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five stages, and the table that the last one writes."""
    return _stored(spark, sf_dir, "sample_predictions", "all")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        src_json_matrix,
        src_json_lines,
        src_gtf,
        table_roundtrip,
        table_overwrite_schema,
        bronze_rename,
        bronze_sanitize,
        bronze_counts,
        bronze_ingest,
        bronze_ingest_lines,
        stored_gene_filter,
        silver_cast,
        silver_unpivot,
        silver_stack,
        silver_gene_filter,
        silver_fill,
        silver_counts,
        gene_base,
        gene_annotations,
        counts_with_genes,
        counts_with_unique_genes,
        library_sizes,
        nonzero_libraries,
        cpm,
        normalized_counts,
        sample_features,
        gene_features,
        modeling_features,
        feature_matrix,
        scaled_features,
        pca_components,
        pca_variance,
        kmeans_clusters,
        train_test_split,
        regression_metrics,
        prediction_residuals,
        rf_predictions,
        tree_predictions,
        sample_predictions,
        cluster_profile,
        kmeans_cluster_profile,
        counts_by_gene_name,
        avg_count_by_gene,
        counts_by_gene,
        counts_by_gene_sample,
        count_range,
        stored_tables,
        stored_bronze_counts,
        stored_counts_long,
        stored_gene_annotations,
        stored_counts_with_genes,
        stored_normalized_counts,
        stored_sample_features,
        stored_gene_features,
        stored_sample_predictions,
    )
}
