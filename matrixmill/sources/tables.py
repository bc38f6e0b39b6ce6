"""Tables stored by path, and intermediate results in the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"
DELTA_FORMAT = "delta"

_CHECKPOINT_DIR = "spark.checkpoint.dir"


class SchemaMismatchError(ValueError):
    """An overwrite would change a stored table's columns without being asked to."""


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    overwrite_schema: bool = False,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Replaces the whole table at ``path``.

    A table with other columns or types is only replaced with ``overwrite_schema``.
    Delta checks this itself and can overwrite a table it is reading. File formats can
    do neither, so both are checked here before a file is touched. An overwrite of a
    file format is not atomic: if the driver dies during it, run the job again.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == DELTA_FORMAT:
        if overwrite_schema:
            writer = writer.option("overwriteSchema", "true")
        writer.save(path)
        return
    exists, stored = _stored_schema(df.sparkSession, path, fmt)
    if exists:
        _refuse_own_source(df, path)
    if stored is not None and not overwrite_schema:
        _require_same_columns(stored, df.schema, path)
    writer.save(path)


read_delta = partial(read_table, fmt=DELTA_FORMAT)
write_delta = partial(write_table, fmt=DELTA_FORMAT)


def _stored_schema(spark: SparkSession, path: str, fmt: str) -> tuple[bool, StructType | None]:
    """Whether ``path`` exists, and the schema of the table there if it holds one."""
    try:
        return True, read_table(spark, path, fmt).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False, None
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return True, None
        raise


def _require_same_columns(stored: StructType, new: StructType, path: str) -> None:
    before = {field.name: field.dataType for field in stored}
    after = {field.name: field.dataType for field in new}
    changed = sorted(
        name for name in before.keys() | after.keys() if before.get(name) != after.get(name)
    )
    if changed:
        raise SchemaMismatchError(
            f"Columns {changed} differ from the table stored at {path}; "
            "pass overwrite_schema=True to replace its schema."
        )


def _nodes(plan) -> Iterator:
    yield plan
    children = plan.children()
    for at in range(children.size()):
        yield from _nodes(children.apply(at))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _root_paths(df: DataFrame) -> set[str]:
    """Qualified paths that the file relations of a plan were given; their files aren't listed."""
    roots = set()
    for node in _nodes(df._jdf.queryExecution().analyzed()):
        if _kind(node) == "LogicalRelation" and _kind(node.relation()) == "HadoopFsRelation":
            paths = node.relation().location().rootPaths()
            roots |= {paths.apply(at).toString() for at in range(paths.size())}
    return roots


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, host and working folder, as Spark's relations have it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(target).toString()


def _refuse_own_source(df: DataFrame, path: str) -> None:
    target = _qualified(df.sparkSession, path)
    for source in sorted(_root_paths(df)):
        # Either may be a folder of the other: a partition of a table, or its parent.
        if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
            raise ValueError(f"{path} is being read by the rows that would replace it ({source}).")


#: Plan nodes that read stored rows as they are.
_STORED_NODES = {"Project", "LogicalRDD", "LogicalRelation", "LocalRelation"}


def is_stored(df: DataFrame) -> bool:
    """Whether reading ``df`` again costs no more than reading columns of stored rows."""
    return all(
        _kind(node) in _STORED_NODES and (_kind(node) != "Project" or _only_columns(node))
        for node in _nodes(df._jdf.queryExecution().optimizedPlan())
    )


def _only_columns(project) -> bool:
    columns = project.projectList()
    for at in range(columns.size()):
        column = columns.apply(at)
        if _kind(column) == "Alias":
            column = column.child()
        if _kind(column) not in ("AttributeReference", "Literal"):
            return False
    return True


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder below ``spark.sql.warehouse.dir`` is taken: tables
    are kept there, so executors share it. On a cluster that folder must not be a local one,
    which each executor would look for on its own machine; then the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
        local = folder.startswith("file:") or ":" not in folder
        if local and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(
                f"Executors can't share {folder}; set {_CHECKPOINT_DIR} to a folder they all reach."
            )
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/staged/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """Writes ``df`` once, in a folder for each value of ``parts``, and returns the stored table.

    For large results that several later passes read: they then scan only the columns
    they need, and a lost executor costs a file read instead of the whole upstream.
    """
    path = stage_path(df.sparkSession, name)
    df.write.format(DEFAULT_FORMAT).partitionBy(*parts).save(path)
    return read_table(df.sparkSession, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, for small results that steer later work."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
