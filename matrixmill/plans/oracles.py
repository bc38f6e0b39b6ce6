"""SQL of the registered queries, for a second engine over the same order tables.

Each statement restates a query from the order tables on, sharing only the fixed rules of
the derived matrix; the list of samples is its own. Clusters are the best that Lloyd's steps
reach from any choice of samples as first centres. The tree is grown level by level; a forest
with bags has no SQL, only bounds that hold for each of its predictions.
"""

from __future__ import annotations

import re

from matrixmill.operators.modeling import MAX_DEPTH
from matrixmill.sources.order_matrix import (
    DOUBLED_SIZE,
    NAMELESS_TYPE,
    PSEUDOGENE_BRAND,
    RAW_GENE_COLUMN,
    SUMMARY_ROWS,
    holds_text,
    raw_sample_name,
)

# The keys of the given nations, and one more for lines without any.
_NATIONS = tuple(range(25))
_SAMPLES = (*_NATIONS, 25)
_RAW = [raw_sample_name(nation) for nation in _SAMPLES]
_CLEAN = [name.replace("-", "_") for name in _RAW]


def _list(items) -> str:
    return ", ".join(items)


def _pivot_cell(nation: int) -> str:
    total = f"sum(q) FILTER (WHERE k = {nation})"
    if holds_text(nation):
        total = f"CAST(CAST({total} AS DECIMAL(38, 6)) AS VARCHAR)"
    return f'{total} AS "{raw_sample_name(nation)}"'


_PIVOT = _list(_pivot_cell(nation) for nation in _SAMPLES)
_SUMMARY_NAME = " ".join(f"WHEN '{flag}' THEN '{name}'" for flag, name in SUMMARY_ROWS.items())
_SUMMARY_FLAGS = _list(f"'{flag}'" for flag in SUMMARY_ROWS)
_CASTS = _list(f'TRY_CAST("{raw}" AS DOUBLE) AS "{clean}"' for raw, clean in zip(_RAW, _CLEAN))
_RAW_COLUMNS = _list(f'"{name}"' for name in _RAW)
_CLEAN_COLUMNS = _list(f'"{raw}" AS "{clean}"' for raw, clean in zip(_RAW, _CLEAN))

# The features in model order; steps after which the clusters stand still.
_FEATURES = ("avg_count", "num_zero_genes", "num_detected_genes", "pct_zero_genes")
_LLOYD_STEPS = 30
_DISTANCE = " + ".join(f"(s.z{i} - m.z{i}) ** 2" for i in range(len(_FEATURES)))


def _score(name: str) -> str:
    spread = f"nullif(stddev_pop({name}) OVER (), 0)"
    return f"coalesce(({name} - avg({name}) OVER ()) / {spread}, 0)"


def _z(name: str) -> str:
    return f"round({_score(name)}, 6) AS z_{name}"


def _variance(part: str) -> str:
    return f"({part}q - {part}s * {part}s / {part}n) / {part}n"


def _grown(level: int) -> dict[str, str]:
    """Steps that split the nodes of one level of the tree: the children of 1 are 2 and 3."""
    return {
        f"gains_{level}": f"""
            SELECT node, feature, threshold,
                   {_variance('')} - (ln / n) * ({_variance('l')}) - (rn / n) * ({_variance('r')}) AS gain
            FROM (SELECT *, n - ln AS rn, s - ls AS rs, q - lq AS rq FROM (
                SELECT node, feature, threshold, CAST(count(*) AS DOUBLE) AS n, sum(v.y) AS s, sum(v.y * v.y) AS q,
                       CAST(count(*) FILTER (WHERE x <= threshold) AS DOUBLE) AS ln,
                       sum(v.y) FILTER (WHERE x <= threshold) AS ls,
                       sum(v.y * v.y) FILTER (WHERE x <= threshold) AS lq
                FROM level_{level} JOIN vectors v USING (sample_uuid) JOIN thresholds USING (feature)
                WHERE NOT v.is_test GROUP BY node, feature, threshold))
            WHERE ln > 0 AND rn > 0""",
        f"splits_{level}": f"""
            SELECT node, feature, threshold FROM gains_{level} WHERE gain > 0
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, threshold) = 1""",
        f"level_{level + 1}": f"""
            SELECT t.sample_uuid, t.is_test, t.y,
                   CASE WHEN p.node IS NULL THEN t.node WHEN x <= threshold THEN 2 * t.node
                        ELSE 2 * t.node + 1 END AS node
            FROM level_{level} t LEFT JOIN splits_{level} p ON t.node = p.node
                 LEFT JOIN vectors v ON v.sample_uuid = t.sample_uuid AND v.feature = p.feature""",
    }


def _component(sign: str) -> str:
    """Score on the component with eigenvalue 2 ± sqrt(1 + 3r²); holds while three features
    are collinear, which they are when all samples have the same number of genes."""
    direction = f"(1 {sign} sqrt(1 + 3 * r * r))"
    return (
        f"round(sign(r) * (sqrt(3) * r * (avg_count - m1) / s1 + {direction} * sqrt(3) * "
        f"(num_zero_genes - m2) / s2) / sqrt(3 * r * r + {direction} * {direction}), 6)"
    )


_STEPS = {
    "deliveries": """
        SELECT l_partkey AS part, l_returnflag AS flag, l_quantity AS q,
               coalesce(s_nationkey, (SELECT max(n_nationkey) + 1 FROM nation)) AS k
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "raw_matrix": f"""
        SELECT 'ENSG' || lpad(CAST(part AS VARCHAR), 11, '0') || '.' ||
               CAST(part % 9 + 1 AS VARCHAR) AS gene, {_PIVOT}
        FROM deliveries GROUP BY part
        UNION ALL
        SELECT CASE flag {_SUMMARY_NAME} END AS gene, {_PIVOT}
        FROM deliveries WHERE flag IN ({_SUMMARY_FLAGS}) GROUP BY flag""",
    "typed": f"SELECT gene AS gene_id, {_CASTS} FROM raw_matrix",
    "long_counts": f"""
        SELECT gene_id, sample_uuid, "count"
        FROM typed UNPIVOT INCLUDE NULLS
            ("count" FOR sample_uuid IN ({_list(f'"{name}"' for name in _CLEAN)}))""",
    "counts": """
        SELECT gene_id, sample_uuid, coalesce("count", 0.0) AS "count"
        FROM long_counts WHERE starts_with(gene_id, 'ENSG')""",
    "part_features": f"""
        SELECT part.*, CASE WHEN p_brand <> '{PSEUDOGENE_BRAND}' THEN 'gene' ELSE 'pseudogene' END
               AS feature FROM part
        UNION ALL SELECT part.*, 'transcript' FROM part
        UNION ALL SELECT part.*, 'gene' FROM part
        WHERE p_brand <> '{PSEUDOGENE_BRAND}' AND p_size = {DOUBLED_SIZE}""",
    "gtf": f"""
        SELECT CAST(p_size % 22 + 1 AS VARCHAR) AS chrom, 'havana' AS source, feature,
               CAST(p_partkey AS VARCHAR) AS "start",
               CAST(p_partkey + p_size AS VARCHAR) AS "end", '.' AS score,
               CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, '.' AS frame,
               'gene_id "ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') ||
               '"; gene_version "1";' ||
               CASE WHEN p_type <> '{NAMELESS_TYPE}' THEN ' gene_name "' || p_name || '";'
                    ELSE '' END ||
               ' gene_biotype "' || p_type || '";' AS attributes
        FROM part_features""",
    "annotations": """
        SELECT regexp_extract(attributes, 'gene_id "([^"]+)"', 1) AS gene_id,
               regexp_extract(attributes, 'gene_name "([^"]+)"', 1) AS gene_name,
               chrom, "start", "end", strand
        FROM gtf WHERE feature = 'gene'""",
    "symbols": """
        SELECT regexp_extract(gene_id, '^(ENSG[0-9]+)', 1) AS base, gene_name
        FROM annotations""",
    "annotated": """
        SELECT c.gene_id, c.sample_uuid, c."count", s.gene_name
        FROM counts c LEFT JOIN symbols s
          ON regexp_extract(c.gene_id, '^(ENSG[0-9]+)', 1) = s.base""",
    "totals": """
        SELECT sample_uuid, sum("count") AS library_size FROM annotated
        GROUP BY sample_uuid HAVING sum("count") > 0""",
    "normalized": """
        SELECT a.sample_uuid, a.gene_id, a."count", a.gene_name, t.library_size,
               a."count" * 1e6 / t.library_size AS cpm,
               ln(1 + a."count" * 1e6 / t.library_size) AS log1p_cpm
        FROM annotated a JOIN totals t ON a.sample_uuid = t.sample_uuid""",
    "gene_summary": """
        SELECT gene_id, gene_name, round(avg(log1p_cpm), 6) AS mean_log1p_cpm,
               round(stddev_samp(log1p_cpm), 6) AS std_log1p_cpm,
               count(*) FILTER (WHERE "count" > 0) AS num_samples_detected,
               count(*) AS num_samples_total,
               round(count(*) FILTER (WHERE "count" > 0) / count(*), 6) AS pct_samples_detected
        FROM normalized GROUP BY gene_id, gene_name""",
    "sample_summary": """
        SELECT sample_uuid, max(library_size) AS library_size,
               round(avg(log1p_cpm), 6) AS avg_log1p_cpm,
               count(*) FILTER (WHERE "count" = 0) AS num_zero_genes,
               count(*) FILTER (WHERE "count" > 0) AS num_detected_genes,
               round(count(*) FILTER (WHERE "count" = 0) /
                     nullif(count(*) FILTER (WHERE "count" >= 0), 0), 6) AS pct_zero_genes
        FROM normalized GROUP BY sample_uuid""",
    "samples": """
        SELECT sample_uuid, library_size, avg_count, num_zero_genes, num_detected_genes,
               num_zero_genes / nullif(num_zero_genes + num_detected_genes, 0) AS pct_zero_genes
        FROM (SELECT sample_uuid, sum("count") AS library_size, avg("count") AS avg_count,
                     CAST(count(*) FILTER (WHERE "count" = 0) AS DOUBLE) AS num_zero_genes,
                     CAST(count(*) FILTER (WHERE "count" > 0) AS DOUBLE) AS num_detected_genes
              FROM normalized GROUP BY sample_uuid)""",
    "correlation": """
        SELECT corr(avg_count, num_zero_genes) AS r, avg(avg_count) AS m1,
               stddev_pop(avg_count) AS s1, avg(num_zero_genes) AS m2,
               stddev_pop(num_zero_genes) AS s2
        FROM samples""",
    "split": """
        SELECT *, row_number() OVER (ORDER BY md5(sample_uuid || ':42'), sample_uuid)
                  <= ceil(0.2 * count(*) OVER ()) AS is_test
        FROM samples""",
    "ratio_predictions": """
        SELECT sample_uuid, library_size AS target_library_size,
               num_detected_genes *
               (SELECT sum(library_size) / sum(num_detected_genes) FROM split WHERE NOT is_test)
               AS pred_library_size
        FROM split WHERE is_test""",
    "scores": f"""
        SELECT sample_uuid, {_list(f"{_score(name)} AS z{i}" for i, name in enumerate(_FEATURES))}
        FROM samples""",
    # Clusters: Lloyd's steps from every three samples as first centres.
    "first_centres": """
        SELECT row_number() OVER () AS start, [a.sample_uuid, b.sample_uuid, c.sample_uuid] AS names
        FROM scores a JOIN scores b ON a.sample_uuid < b.sample_uuid
                      JOIN scores c ON b.sample_uuid < c.sample_uuid""",
    "centres": f"""
        SELECT start, list_position(names, sample_uuid) AS c, 0 AS step, z0, z1, z2, z3
        FROM first_centres JOIN scores ON list_contains(names, sample_uuid)
        UNION ALL
        SELECT start, c, step + 1, avg(z0), avg(z1), avg(z2), avg(z3)
        FROM (SELECT start, step, sample_uuid, arg_min(c, {_DISTANCE}) AS c,
                     any_value(s.z0) AS z0, any_value(s.z1) AS z1,
                     any_value(s.z2) AS z2, any_value(s.z3) AS z3
              FROM centres m, scores s WHERE step < {_LLOYD_STEPS} GROUP BY start, step, sample_uuid)
        GROUP BY start, step, c""",
    "partitions": f"""
        SELECT start, sample_uuid, arg_min(c, {_DISTANCE}) AS c, min({_DISTANCE}) AS cost
        FROM centres m, scores s WHERE step = {_LLOYD_STEPS} GROUP BY start, sample_uuid""",
    "best_partition": """
        SELECT sample_uuid, c FROM partitions WHERE start =
            (SELECT arg_min(start, cost) FROM
                (SELECT start, sum(cost) AS cost FROM partitions GROUP BY start HAVING count(DISTINCT c) = 3))""",
    "clusters": """
        SELECT sample_uuid, CAST(place AS INTEGER) AS "cluster"
        FROM best_partition JOIN (
            SELECT c, row_number() OVER (ORDER BY avg(z0), avg(z1), avg(z2), avg(z3)) - 1 AS place
            FROM best_partition JOIN scores USING (sample_uuid) GROUP BY c) USING (c)""",
    # The tree: splits halfway between the training values, the largest gain in variance first.
    "vectors": f"""
        SELECT sample_uuid, is_test, library_size AS y,
               unnest([{_list(str(i) for i in range(len(_FEATURES)))}]) AS feature,
               unnest([{_list(_FEATURES)}]) AS x
        FROM split""",
    "thresholds": """
        SELECT feature, threshold FROM (
            SELECT feature, (x + lead(x) OVER (PARTITION BY feature ORDER BY x)) / 2.0 AS threshold
            FROM (SELECT DISTINCT feature, x FROM vectors WHERE NOT is_test))
        WHERE threshold IS NOT NULL""",
    "level_0": "SELECT sample_uuid, is_test, library_size AS y, CAST(1 AS BIGINT) AS node FROM split",
    **{name: body for level in range(MAX_DEPTH) for name, body in _grown(level).items()},
    "tree": f"""
        SELECT sample_uuid, is_test, library_size, pred
        FROM split JOIN level_{MAX_DEPTH} USING (sample_uuid, is_test) JOIN (
            SELECT node, sum(y) / count(*) AS pred FROM level_{MAX_DEPTH} WHERE NOT is_test GROUP BY node)
        USING (node)""",
    "test_metrics": """
        SELECT 1 - sum(e * e) / nullif(var_pop(y) * count(*), 0) AS model_r2,
               sqrt(avg(e * e)) AS model_rmse
        FROM (SELECT library_size AS y, library_size - pred AS e FROM tree WHERE is_test)""",
    "projection": f"""
        SELECT sample_uuid, {_component('+')} AS "PC1", {_component('-')} AS "PC2"
        FROM samples, correlation""",
    "predictions": """
        SELECT sample_uuid, library_size, round(avg_count, 6) AS avg_count, num_zero_genes,
               num_detected_genes, round(pct_zero_genes, 6) AS pct_zero_genes, "PC1", "PC2",
               "cluster", round(pred, 6) AS pred_library_size,
               library_size AS target_library_size, round(model_r2, 6) AS model_r2,
               round(model_rmse, 6) AS model_rmse
        FROM samples JOIN projection USING (sample_uuid) JOIN clusters USING (sample_uuid)
             JOIN tree USING (sample_uuid, library_size), test_metrics""",
}


def _needed(name: str, found: dict[str, None]) -> None:
    """Adds the steps that a step reads, and then the step."""
    for other in re.findall(r"\w+", _STEPS[name]):
        if other in _STEPS and other != name and other not in found:
            _needed(other, found)
    found[name] = None


def _statement(select: str) -> str:
    found: dict[str, None] = {}
    for name in re.findall(r"\w+", select):
        if name in _STEPS and name not in found:
            _needed(name, found)
    steps = ",\n".join(f"{name} AS {'' if name == 'centres' else 'MATERIALIZED '}({_STEPS[name]})" for name in found)
    return f"WITH RECURSIVE {steps}\n{select}" if found else select


_SELECTS = {
    "src_json_matrix": f'SELECT gene AS "{RAW_GENE_COLUMN}", {_RAW_COLUMNS} FROM raw_matrix',
    "src_gtf": "SELECT * FROM gtf",
    "table_roundtrip": "SELECT * FROM counts",
    "table_overwrite_schema": """
        SELECT sample_uuid, sum("count") AS library_size FROM counts GROUP BY sample_uuid""",
    "bronze_rename": f"SELECT gene AS gene_id, {_RAW_COLUMNS} FROM raw_matrix",
    "bronze_sanitize": f"""
        SELECT gene AS "{RAW_GENE_COLUMN.replace(':', '_')}", {_CLEAN_COLUMNS}
        FROM raw_matrix""",
    "bronze_counts": f"SELECT gene AS gene_id, {_CLEAN_COLUMNS} FROM raw_matrix",
    "bronze_ingest": f"SELECT gene AS gene_id, {_CLEAN_COLUMNS} FROM raw_matrix",
    "silver_cast": "SELECT * FROM typed",
    "silver_unpivot": "SELECT * FROM long_counts",
    "silver_stack": "SELECT * FROM long_counts",
    "silver_gene_filter": "SELECT * FROM long_counts WHERE starts_with(gene_id, 'ENSG')",
    "silver_fill": """
        SELECT gene_id, sample_uuid, coalesce("count", 0.0) AS "count" FROM long_counts""",
    "silver_counts": "SELECT * FROM counts",
    "gene_base": """
        SELECT gene AS gene_id, regexp_extract(gene, '^(ENSG[0-9]+)', 1) AS gene_base
        FROM raw_matrix""",
    "gene_annotations": "SELECT * FROM annotations",
    "counts_with_genes": "SELECT * FROM annotated",
    "counts_with_unique_genes": """
        SELECT c.gene_id, c.sample_uuid, c."count", s.gene_name
        FROM counts c LEFT JOIN (
            SELECT base, coalesce(min(nullif(gene_name, '')), '') AS gene_name
            FROM symbols WHERE base <> '' GROUP BY base) s
          ON regexp_extract(c.gene_id, '^(ENSG[0-9]+)', 1) = s.base""",
    "library_sizes": """
        SELECT sample_uuid, sum("count") AS library_size FROM counts GROUP BY sample_uuid""",
    "nonzero_libraries": """
        SELECT sample_uuid, sum("count") AS library_size FROM counts
        GROUP BY sample_uuid HAVING sum("count") > 0""",
    "cpm": """
        SELECT c.sample_uuid, c.gene_id, c."count", t.library_size,
               c."count" * 1e6 / t.library_size AS cpm,
               round(ln(1 + c."count" * 1e6 / t.library_size), 6) AS log1p_cpm
        FROM counts c JOIN (SELECT sample_uuid, sum("count") AS library_size FROM counts
                            GROUP BY sample_uuid HAVING sum("count") > 0) t
          ON c.sample_uuid = t.sample_uuid""",
    "normalized_counts": "SELECT * REPLACE (round(log1p_cpm, 6) AS log1p_cpm) FROM normalized",
    "sample_features": "SELECT * FROM sample_summary",
    "gene_features": "SELECT * FROM gene_summary",
    "modeling_features": """
        SELECT * REPLACE (round(avg_count, 6) AS avg_count,
                          round(pct_zero_genes, 6) AS pct_zero_genes) FROM samples""",
    "scaled_features": f"""
        SELECT sample_uuid, {_z('avg_count')}, {_z('num_zero_genes')},
               {_z('num_detected_genes')}, {_z('pct_zero_genes')} FROM samples""",
    "feature_matrix": """
        SELECT sample_uuid, round(avg_count, 6) AS f0, num_zero_genes AS f1,
               num_detected_genes AS f2, round(pct_zero_genes, 6) AS f3 FROM samples""",
    "pca_components": "SELECT * FROM projection",
    "kmeans_clusters": "SELECT * FROM clusters",
    "kmeans_cluster_profile": """
        SELECT "cluster", count(*) AS num_samples,
               round(avg(library_size), 6) AS mean_library_size,
               round(stddev_samp(library_size), 6) AS std_library_size,
               round(avg(pct_zero_genes), 6) AS mean_pct_zero_genes,
               round(stddev_samp(pct_zero_genes), 6) AS std_pct_zero_genes
        FROM samples JOIN clusters USING (sample_uuid) GROUP BY "cluster" """,
    "tree_predictions": """
        SELECT sample_uuid, is_test, library_size, round(pred, 6) AS pred_library_size FROM tree""",
    "rf_predictions": "SELECT sample_uuid, library_size, true AS in_training_range FROM samples",
    "sample_predictions": "SELECT * FROM predictions",
    "pca_variance": """
        SELECT 'PC1' AS component,
               round((2 + sqrt(1 + 3 * r * r)) / 4, 6) AS explained_variance_ratio
        FROM correlation
        UNION ALL SELECT 'PC2', round((2 - sqrt(1 + 3 * r * r)) / 4, 6) FROM correlation""",
    "train_test_split": "SELECT sample_uuid, is_test FROM split",
    "regression_metrics": """
        SELECT round(1 - sum(e * e) / nullif(var_pop(y) * count(*), 0), 6) AS r2,
               round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse,
               round(sqrt(avg(e * e)), 6) AS rmse,
               round(avg(abs(e / nullif(y, 0))) * 100, 6) AS mape,
               count(*) FILTER (WHERE y = 0) AS zero_targets
        FROM (SELECT target_library_size AS y, target_library_size - pred_library_size AS e
              FROM ratio_predictions)""",
    "prediction_residuals": """
        SELECT sample_uuid, target_library_size,
               round(pred_library_size, 6) AS pred_library_size,
               round(target_library_size - pred_library_size, 6) AS residual
        FROM ratio_predictions""",
    "cluster_profile": """
        SELECT n_regionkey AS "cluster", count(*) AS num_samples,
               round(avg(library_size), 6) AS mean_library_size,
               round(stddev_samp(library_size), 6) AS std_library_size,
               round(avg(pct_zero_genes), 6) AS mean_pct_zero_genes,
               round(stddev_samp(pct_zero_genes), 6) AS std_pct_zero_genes
        FROM samples JOIN nation
          ON sample_uuid = 'nat_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
        GROUP BY n_regionkey""",
    "counts_by_gene_name": """
        SELECT gene_name, sum("count") AS total_count FROM annotated GROUP BY gene_name""",
    "avg_count_by_gene": """
        SELECT gene_id, round(avg("count"), 6) AS avg_count FROM annotated GROUP BY gene_id""",
    "counts_by_gene": """
        SELECT gene_id, sum("count") AS total_count FROM annotated GROUP BY gene_id""",
    "counts_by_gene_sample": """
        SELECT gene_id, sample_uuid, sum("count") AS total_count FROM annotated
        GROUP BY gene_id, sample_uuid""",
    "count_range": """
        SELECT min("count") AS min_count, max("count") AS max_count FROM counts""",
    "src_json_lines": f'SELECT gene AS "{RAW_GENE_COLUMN}", {_RAW_COLUMNS} FROM raw_matrix',
    "bronze_ingest_lines": f"SELECT gene AS gene_id, {_CLEAN_COLUMNS} FROM raw_matrix",
    "stored_gene_filter": f"""
        SELECT gene AS gene_id, {_CLEAN_COLUMNS} FROM raw_matrix WHERE starts_with(gene, 'ENSG')""",
    "stored_tables": "SELECT * FROM gene_summary",
    "stored_bronze_counts": f"SELECT gene AS gene_id, {_CLEAN_COLUMNS} FROM raw_matrix",
    "stored_counts_long": "SELECT * FROM counts",
    "stored_gene_annotations": "SELECT * FROM annotations",
    "stored_counts_with_genes": "SELECT * FROM annotated",
    "stored_normalized_counts": """
        SELECT * REPLACE (round(log1p_cpm, 6) AS log1p_cpm) FROM normalized""",
    "stored_sample_features": "SELECT * FROM sample_summary",
    "stored_gene_features": "SELECT * FROM gene_summary",
    "stored_sample_predictions": "SELECT * FROM predictions",
}

ORACLES: dict[str, str] = {name: _statement(select) for name, select in _SELECTS.items()}
