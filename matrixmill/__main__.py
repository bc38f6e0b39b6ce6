"""``spark-submit`` entry: ``python -m matrixmill --base-path <uri> [--stage silver]``."""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields
from pathlib import Path

from pyspark.sql import SparkSession

from matrixmill.operators.modeling import ModelSettings
from matrixmill.plans.jobs import STAGES, run_pipeline
from matrixmill.plans.layout import GTF_FILE, RAW_FILE, Layout
from matrixmill.sources.tables import DEFAULT_FORMAT


def _add_settings(parser: argparse.ArgumentParser) -> None:
    """An option for each model setting, named like it, with its default."""
    group = parser.add_argument_group("models")
    for field in fields(ModelSettings):
        option = f"--{field.name.replace('_', '-')}"
        if isinstance(field.default, bool):
            group.add_argument(option, action=argparse.BooleanOptionalAction, default=field.default)
        else:
            group.add_argument(option, type=type(field.default), default=field.default)


def parse(argv: list[str] | None = None) -> tuple[argparse.Namespace, Layout, ModelSettings]:
    """The arguments, and the layout and the model settings they name."""
    parser = argparse.ArgumentParser(prog="matrixmill")
    parser.add_argument("--base-path", required=True, help="folder that holds inputs and tables")
    parser.add_argument("--stage", default="all", choices=["all", *STAGES])
    parser.add_argument("--raw-file", default=RAW_FILE, help="matrix, relative to the base path")
    parser.add_argument("--gtf-file", default=GTF_FILE, help="GTF, relative to the base path")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format")
    parser.add_argument("--json-lines", action="store_true", help="the matrix is JSON lines")
    parser.add_argument(
        "--raw-schema", type=Path, help="local file with the matrix columns as DDL; else inferred"
    )
    parser.add_argument("--log-level", default="INFO")
    _add_settings(parser)
    args = parser.parse_args(argv)
    schema = args.raw_schema.read_text(encoding="utf-8").strip() if args.raw_schema else None
    layout = Layout(
        args.base_path, args.raw_file, args.gtf_file, args.format, not args.json_lines, schema
    )
    settings = ModelSettings(**{x.name: getattr(args, x.name) for x in fields(ModelSettings)})
    return args, layout, settings


def main(argv: list[str] | None = None) -> None:
    args, layout, settings = parse(argv)
    logging.basicConfig(level=args.log_level.upper())
    spark = SparkSession.builder.appName("matrixmill").getOrCreate()
    run_pipeline(spark, layout, args.stage, settings)


if __name__ == "__main__":
    main()
