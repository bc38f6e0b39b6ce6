"""A count matrix and a GTF file derived from order tables, for the registered queries.

A gene is a part, a sample is a supplier nation, a count is the quantity that suppliers
of the nation delivered of the part. Every order line takes part: the samples are all nations
that the nation or the supplier table names, and one more, past the largest, for lines whose
supplier is unknown or has no nation. The rules give the matrix the quirks real exports have:

* cells without deliveries are null; where all suppliers have a nation, the sample of the
  others is empty and is inferred as text;
* every fifth sample column holds text, with six decimal places;
* two summary rows (returned, and accepted quantity per nation) stand beside the genes;
* in the GTF, parts of one brand are pseudogenes (no annotation), parts of one type have
  no symbol, parts of the largest size are annotated twice, every part has a transcript.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixmill.plans.joins import lookup_join, measured_bytes
from matrixmill.sources.gtf import GTF_COLUMNS

# The rules above, used by the queries' SQL as well.
RAW_GENE_COLUMN = "Unnamed: 0"
TEXT_COLUMN_STEP = 5
SUMMARY_ROWS = {"R": "N_multimapping", "A": "N_noFeature"}
PSEUDOGENE_BRAND = "Brand#2"
NAMELESS_TYPE = "SMALL"
DOUBLED_SIZE = 50

#: About how many genes share one JSON document of the stored matrix.
RECORDS_PER_DOCUMENT = 10_000


def raw_sample_name(nation: int) -> str:
    return f"nat-{nation:02d}"


def holds_text(nation: int) -> bool:
    return nation % TEXT_COLUMN_STEP == 0


def read_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _accession(part_key: str) -> str:
    return f"concat('ENSG', lpad(CAST({part_key} AS string), 11, '0'))"


def sample_keys(spark: SparkSession, sf_dir: str) -> list[int]:
    """Keys of all samples: the matrix has a column for each, so they are few."""
    named = read_source(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"))
    used = read_source(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"))
    keys = named.unionByName(used).filter("key IS NOT NULL").distinct().collect()
    known = sorted(row["key"] for row in keys)
    return [*known, known[-1] + 1 if known else 0]


def sample_fields(keys: list[int]) -> dict[str, str]:
    """Type of each sample column."""
    return {raw_sample_name(key): "string" if holds_text(key) else "double" for key in keys}


def _samples_of(rows: DataFrame, group: str, name: str, keys: list[int]) -> DataFrame:
    """One row per group, named by the SQL ``name``, with the quantity of each nation.

    All sums are taken in one aggregation, which starts before its only shuffle.
    """
    sums = [F.expr(f"sum(if(k = {key}, l_quantity, NULL)) AS `{key}`") for key in keys]
    cells = [
        f"CAST(CAST(`{key}` AS decimal(38, 6)) AS string) AS `{raw_sample_name(key)}`"
        if holds_text(key)
        else f"CAST(`{key}` AS double) AS `{raw_sample_name(key)}`"
        for key in keys
    ]
    return rows.groupBy(group).agg(*sums).selectExpr(f"{name} AS `{RAW_GENE_COLUMN}`", *cells)


def raw_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part plus the summary rows, one column per nation."""
    keys = sample_keys(spark, sf_dir)
    lines = read_source(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    suppliers = (
        read_source(spark, sf_dir, "supplier")
        .filter("s_suppkey IS NOT NULL")
        .select("s_suppkey", F.col("s_nationkey").alias("k"))
    )
    supplier_bytes = measured_bytes(suppliers)

    def with_nation(rows: DataFrame) -> DataFrame:
        joined = lookup_join(rows, suppliers, "s_suppkey", "left", lookup_bytes=supplier_bytes)
        return joined.withColumn("k", F.coalesce("k", F.lit(keys[-1])))

    versioned = f"concat({_accession('l_partkey')}, '.', l_partkey % 9 + 1)"
    per_line = with_nation(lines.select("s_suppkey", "l_partkey", "l_quantity"))
    genes = _samples_of(per_line, "l_partkey", versioned, keys)
    # The summary needs no line, so lines are added up per supplier before the join.
    per_supplier = (
        lines.filter(F.col("l_returnflag").isin(list(SUMMARY_ROWS)))
        .groupBy("s_suppkey", "l_returnflag")
        .agg(F.sum("l_quantity").alias("l_quantity"))
    )
    cases = " ".join(f"WHEN '{flag}' THEN '{name}'" for flag, name in SUMMARY_ROWS.items())
    summary = _samples_of(
        with_nation(per_supplier), "l_returnflag", f"CASE l_returnflag {cases} END", keys
    )
    return genes.unionByName(summary)


def gtf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine GTF fields, as text, of all lines of all parts."""
    is_gene = f"p_brand <> '{PSEUDOGENE_BRAND}'"
    fields = {
        "chrom": "CAST(p_size % 22 + 1 AS string)",
        "source": "'havana'",
        "feature": f"""explode(array_compact(array(
            if({is_gene}, 'gene', 'pseudogene'),
            'transcript',
            if({is_gene} AND p_size = {DOUBLED_SIZE}, 'gene', NULL))))""",
        "start": "CAST(p_partkey AS string)",
        "end": "CAST(p_partkey + p_size AS string)",
        "score": "'.'",
        "strand": "if(p_partkey % 2 = 0, '+', '-')",
        "frame": "'.'",
        "attributes": f"""concat_ws(' ',
            concat('gene_id "', {_accession("p_partkey")}, '"; gene_version "1";'),
            if(p_type <> '{NAMELESS_TYPE}', concat('gene_name "', p_name, '";'), NULL),
            concat('gene_biotype "', p_type, '";'))""",
    }
    parts = read_source(spark, sf_dir, "part")
    return parts.selectExpr(*[f"{fields[name]} AS `{name}`" for name in GTF_COLUMNS])


def write_gtf(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Stores the GTF lines as a folder of gzipped text with a header line."""
    header = spark.range(1).select(F.lit("#!genome-build synthetic").alias("value"))
    lines = gtf_lines(spark, sf_dir).select(F.concat_ws("\t", *GTF_COLUMNS).alias("value"))
    header.unionByName(lines).write.option("compression", "gzip").text(path)
    return path


def write_raw_matrix(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Stores the matrix as a folder of JSON array documents, one per file.

    Genes are unique, so hashing them gives documents of about equal length, and the
    same ones whenever a task is repeated.
    """
    num_parts = read_source(spark, sf_dir, "part").count()
    num_documents = num_parts // RECORDS_PER_DOCUMENT + 1
    document = F.pmod(F.xxhash64(f"`{RAW_GENE_COLUMN}`"), F.lit(num_documents))
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    documents = (
        raw_matrix(spark, sf_dir)
        .select(document.alias("document"), record.alias("record"))
        .groupBy("document")
        .agg(F.array_join(F.collect_list("record"), ",\n").alias("records"))
        .select(F.concat(F.lit("["), "records", F.lit("]")).alias("value"))
    )
    documents.write.option("maxRecordsPerFile", 1).text(path)
    return path


def write_raw_lines(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Stores the matrix as JSON lines, which Spark splits by bytes.

    Rows are dealt by gene, so the files are about equal and the same when a task is repeated.
    """
    num_parts = read_source(spark, sf_dir, "part").count()
    files = num_parts // RECORDS_PER_DOCUMENT + 2
    matrix = raw_matrix(spark, sf_dir).repartition(files, f"`{RAW_GENE_COLUMN}`")
    matrix.write.option("ignoreNullFields", "false").json(path)
    return path
