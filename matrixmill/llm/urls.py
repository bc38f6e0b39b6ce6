"""URL filter: explicit rules first, gradient-boosted trees on lexical features for the rest.

Everything is built-in functions and Spark ML. The host is what follows the first ``://`` up
to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; the path follows up to ``?``, ``#``
or the end. A null url, or one without ``://``, has an empty host and path.

A rule fits its host and all subdomains if the path starts with the rule's path; the longest
fitting rule decides. Other urls are judged by trees on length, depth, digit ratio, entropy,
parameters and statistics of the host's suffix, fitted on labelled urls. Where no labels are
given, the urls that a rule decides are the labelled ones. At most ``MAX_ROWS`` of them are
used, chosen by hash. With labels of one kind only, that kind is the verdict of all others;
without any labels it is ``allow``. The statistics of suffixes are always those of the pages that
are judged, for the labelled urls too; a suffix that no page has counts as empty. Repeated rows
are each judged; an empty table gives an empty result; other columns take no part, whatever
their names. A long url is one row like any other; its features take time in proportion to its
length and its different characters.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixmill.llm.common import ascii_lower
from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed

MAX_ROWS = 10_000
TREES = 15
DEPTH = 4

ALLOW, BLOCK = "allow", "block"
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens",
    "entropy", "parameters", "query_length", "fragment", "secure", "suffix_share", "suffix_path_length",
)


class Rule(NamedTuple):
    """``allow`` or ``block`` for a host with its subdomains, and a beginning of the path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def add_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    text = F.coalesce(F.col(url), F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return pages.withColumns(
        {"host": ascii_lower(F.regexp_extract(text, pattern, 1)), "path": F.regexp_extract(text, pattern, 2)}
    )


def rule_column(rules: Sequence[Rule], part: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits ``host`` and ``path``, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit(f".{rule.host}"))
        fits = host & F.startswith(F.col("path"), F.lit(rule.path))
        found = F.when(fits, F.lit(getattr(rule, part))).otherwise(found)
    return found


def _count(text: str, characters: str) -> str:
    return f"CAST(char_length({text}) - char_length(translate({text}, '{characters}', '')) AS double)"


def suffix_statistics(parts: DataFrame) -> tuple[DataFrame, int]:
    """``(suffix, urls, suffix_path_length)`` of the last two labels of hosts, and the number of urls.

    They are grouped and stored before they are joined back, so a suffix with a third of all
    rows is one row per task.
    """
    by_suffix = checkpointed(
        parts.groupBy(F.substring_index("host", ".", -2).alias("suffix")).agg(
            F.count(F.lit(1)).alias("urls"), F.avg(F.char_length("path")).alias("suffix_path_length")
        )
    )
    return by_suffix, by_suffix.agg(F.sum("urls")).first()[0] or 1


def add_features(parts: DataFrame, statistics: tuple[DataFrame, int]) -> DataFrame:
    """Adds :data:`FEATURES` to rows with ``url``, ``host`` and ``path``."""
    by_suffix, total = statistics
    keyed = parts.withColumn("suffix", F.substring_index("host", ".", -2))
    text, digits = "coalesce(url, '')", "0123456789"
    share = "(char_length(t) - char_length(replace(t, c, ''))) / char_length(t)"
    exprs = {
        "url_length": f"CAST(char_length({text}) AS double)",
        "host_length": "CAST(char_length(host) AS double)",
        "path_length": "CAST(char_length(path) AS double)",
        "depth": _count("path", "/"),
        "labels": _count("host", ".") + " + 1.0",
        "digit_ratio": f"{_count('path', digits)} / greatest(char_length(path), 1)",
        "host_digits": _count("host", digits),
        "hyphens": _count("host", "-"),
        "entropy": "aggregate(array_distinct(filter(split(t, ''), c -> c <> '')), CAST(0 AS double), "
        f"(a, c) -> a - {share} * log2({share}))",
        "parameters": f"{_count(text, '&')} + if(contains({text}, '?'), 1, 0)",
        "query_length": f"if(contains({text}, '?'), CAST(char_length(substring_index({text}, '?', -1)) AS double), 0.0)",
        "fragment": f"if(contains({text}, '#'), 1.0, 0.0)",
        "secure": f"if(startswith({text}, 'https:'), 1.0, 0.0)",
        "suffix_share": f"coalesce(CAST(urls AS double), 0.0) / {total}",
        "suffix_path_length": "coalesce(suffix_path_length, 0.0)",
    }
    joined = lookup_join(keyed, by_suffix, "suffix", "left").withColumn("t", F.expr(text))
    return joined.select(*parts.columns, *[F.expr(exprs[name]).cast("double").alias(name) for name in FEATURES])


def fit_model(labelled: DataFrame) -> Model | float:
    """Trees on rows with :data:`FEATURES` and ``label`` (1: block), or the one label there is.

    The rows to learn from are put in a fixed order in one partition of at most
    :data:`MAX_ROWS`, so that the model depends neither on the layout nor on the session.
    """
    order = [F.xxhash64("url"), "url", "label"]
    chosen = checkpointed(labelled.select("url", "label", *FEATURES).orderBy(*order).limit(MAX_ROWS))
    kinds = [row["label"] for row in chosen.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    rows = chosen.coalesce(1).sortWithinPartitions(*order)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, featuresCol="features", labelCol="label", seed=1)
    return trees.fit(vectors)


def judge(
    pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, id_column: str = "page_id"
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``labelled`` may give ``(url, label)`` to learn from, with label 1 for urls to block.
    """
    parts = add_parts(pages.select(id_column, "url"))
    statistics = suffix_statistics(parts)
    features = add_features(parts, statistics).withColumns(
        {"rule": rule_column(rules, "name"), "by_rule": rule_column(rules, "verdict")}
    )
    if labelled is None:
        known = features.filter(F.col("by_rule").isNotNull()).withColumn(
            "label", (F.col("by_rule") == BLOCK).cast("double")
        )
    else:
        given = add_parts(labelled.select("url", F.col("label").cast("double").alias("label")))
        known = add_features(given, statistics)
    model = fit_model(known)
    if isinstance(model, float):
        judged = features.withColumn("prediction", F.lit(model))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
        judged = model.transform(vectors)
    own = F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(id_column, "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"))
