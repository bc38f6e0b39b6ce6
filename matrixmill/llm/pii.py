"""Personal data by bootstrapped contextual extraction, with built-in functions only.

Patterns of fixed form find the seeds: emails, IPv4 addresses, cards that pass the Luhn check,
and phones with a country code. The words before a seed form lexical patterns of its kind: the
last word, and the last two. The same patterns are looked up before candidates, tokens with
five digits or an ``@`` that no seed covers. Patterns and instances form a graph that is scored
by rounds: a pattern by the share of its instances known to be of the kind and by their
number, an instance by the patterns it stands in. Instances that reach ``ACCEPTED`` join the
known ones of the next round. In the end the candidates with an accepted instance in a
confident pattern are added to the spans, if their characters suit the kind.

Secrets are found by their context alone. Tokens of 32, 40 or 64 hexadecimal digits start the
graph, since keys often look so, but so do checksums: a token of this kind, hexadecimal or not,
becomes a span only if it stands in a confident pattern.

All steps take time in proportion to the texts and their matches: a match's place is the sum of
what stands before it, by a window over the matches of its document. Documents move without
their texts. Scores are stored before they are joined back, by :func:`lookup_join`, so a
pattern or a value with a third of all occurrences is spread over many tasks.

A null text counts as empty; texts without matches have empty lists. Offsets are code points,
the end exclusive. Matches of one kind don't overlap; those of different kinds may. Repeated
rows and ids are each searched; an empty table gives an empty result. Other columns take no
part, whatever their names. A long text is searched whole, and its matches are held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed, staged

KINDS = ("email", "ip", "card", "phone")
#: The kind that has no seeds of its own, and the lengths of the tokens its graph starts from.
SECRET = "secret"
_STARTING_LENGTHS = (32, 40, 64)
_ORDER = (*KINDS, SECRET)

ROUNDS = 3
#: A pattern counts from so many different known instances on, and from this confidence.
MIN_KNOWN = 3
CONFIDENT = 0.8
#: Score from which an instance is taken for one of the kind.
ACCEPTED = 0.8
#: Characters before a match in which its pattern words are looked for.
CONTEXT = 48

# The forms of the seeds. They match what the plain patterns match from the left:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
# but never go back within a run of characters, so long runs take linear time: a match can
# only begin where a run begins, or where the match before it ended.
_LOCAL = "A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions without which a form can't match or its match fails.
_HINTS = {
    "email": "contains(text, '@')",
    "ip": r"text RLIKE r'[0-9]\.[0-9]'",
    "card": r"text RLIKE r'[0-9](?:[\x20-]?[0-9]){15}'",
    "phone": r"text RLIKE r'\+[0-9]'",
}
_DIGITS = "regexp_replace({0}, '[^0-9]', '')"
_VALID = {
    "email": "true",
    "ip": r"forall(split({0}, r'\.'), p -> p RLIKE r'\A0*(?:[0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])\z')",
    "card": f"char_length({_DIGITS}) BETWEEN 16 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"char_length({_DIGITS}) BETWEEN 8 AND 15",
}
#: Tokens with five digits or an @.
_CANDIDATE = r"(?<!\S)(?=(?:[^\s0-9]*+[0-9]){5}|[^\s@]*+@)\S++"
#: What a candidate of a kind looks like.
_SUITS = {
    "email": r"{0} RLIKE r'\A[^\s@]+@[^\s@]+\z'",
    "ip": r"{0} RLIKE r'\A[0-9A-Fa-f]*[.:][0-9A-Fa-f]*[.:][0-9A-Fa-f.:]*\z'",
    "card": f"{{0}} RLIKE r'\\A[0-9-]+\\z' AND char_length({_DIGITS}) BETWEEN 12 AND 19",
    "phone": f"{{0}} RLIKE r'\\A[+(0-9][0-9().-]*\\z' AND char_length({_DIGITS}) BETWEEN 7 AND 15",
    "secret": r"{0} RLIKE r'\A(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/.=-]{{16,}}\z'",
}


_CANDIDATES = "candidates"


def _matches(kind: str, form: str, hint: str) -> str:
    """SQL of the matches of a form in order, each with the text since the match before it."""
    return f"""if({hint}, transform(
        filter(zip_with(split(text, r'{form}', -1), regexp_extract_all(text, r'{form}', 0),
                        (piece, value) -> struct(piece, value)), x -> x.value IS NOT NULL),
        (x, place) -> struct('{kind}' AS kind, place, char_length(x.piece) AS skipped,
                             lower(right(x.piece, {CONTEXT})) AS context, x.value AS value)), array())"""


def _all_matches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, row, matches)`` of every row of ``docs``, stored without texts."""
    texts = docs.select(
        F.col(id_column).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    parts = [_matches(kind, FORMS[kind], _HINTS[kind]) for kind in KINDS]
    parts.append(_matches(_CANDIDATES, _CANDIDATE, r"text RLIKE r'[0-9@]'"))
    return staged(texts.select("id", "row", F.expr(f"concat({', '.join(parts)})").alias("matches")), "matches")


def _placed(matches: DataFrame) -> DataFrame:
    """``(row, kind, start, end, value, words)``: valid seeds, and candidates that no seed overlaps.

    Candidates are without punctuation at their ends.
    """
    along = Window.partitionBy("row", "kind").orderBy("place")
    valid = " ".join(f"WHEN '{kind}' THEN {_VALID[kind].format('value')}" for kind in KINDS)
    lead, tail = r"regexp_extract(value, r'\A[^0-9A-Za-z+(]*', 0)", r"regexp_extract(value, r'[^0-9A-Za-z]*+\z', 0)"
    spans = (
        matches.select("row", F.inline("matches"))
        .withColumn("end", F.sum(F.col("skipped") + F.char_length("value")).over(along))
        .withColumn("start", F.col("end") - F.char_length("value"))
        .filter(f"CASE kind {valid} ELSE true END")
        .withColumn("lead", F.expr(f"if(kind = '{_CANDIDATES}', char_length({lead}), 0)"))
        .withColumn("tail", F.expr(f"if(kind = '{_CANDIDATES}', char_length({tail}), 0)"))
        .withColumn("value", F.expr("substring(value, lead + 1, greatest(char_length(value) - lead - tail, 0))"))
        .filter("value <> ''")
        .select(
            "row",
            "kind",
            (F.col("start") + F.col("lead")).cast("int").alias("start"),
            (F.col("end") - F.col("tail")).cast("int").alias("end"),
            "value",
            F.expr(r"filter(split(context, r'[^\p{L}]+'), w -> w <> '')").alias("words"),
        )
        .withColumn("words", F.expr("slice(words, greatest(size(words) - 1, 1), 2)"))
    )
    # A seed overlaps a candidate if one that starts no later ends after its start, or if the
    # next one starts before its end.
    # Both look back, from either end: a frame that grows is updated, one that shrinks is not.
    order, before = [F.col("start"), F.col("kind") == _CANDIDATES], (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("row").orderBy(*order).rowsBetween(*before)
    later = Window.partitionBy("row").orderBy(*[x.desc() for x in order]).rowsBetween(*before)
    seed = F.col("kind") != _CANDIDATES
    reach = F.max(F.when(seed, F.col("end"))).over(earlier)
    upcoming = F.min(F.when(seed, F.col("start"))).over(later)
    covered = (F.coalesce(reach, F.lit(0)) > F.col("start")) | F.coalesce(upcoming < F.col("end"), F.lit(False))
    return staged(spans.withColumn("covered", ~seed & covered).filter("NOT covered").drop("covered"), "spans")


def _patterns(words: str) -> str:
    """SQL of the patterns of a match: its last word, and its last two."""
    return f"array_distinct(filter(array(element_at({words}, -1), array_join({words}, ' ')), p -> p <> ''))"


def _occurrences(spans: DataFrame) -> DataFrame:
    """``(row, kind, value, pattern, start, end, seed)`` of seeds and of suitable candidates."""
    known = spans.filter(F.col("kind") != _CANDIDATES).withColumn("seed", F.lit(True))
    suits = ", ".join(f"if({_SUITS[kind].format('value')}, '{kind}', NULL)" for kind in _ORDER)
    starting = f"char_length(value) IN {_STARTING_LENGTHS} AND value RLIKE r'\\A[0-9A-Fa-f]+\\z'"
    unknown = (
        spans.filter(F.col("kind") == _CANDIDATES)
        .withColumn("kind", F.explode(F.expr(f"array_compact(array({suits}))")))
        .withColumn("seed", F.expr(f"kind = '{SECRET}' AND {starting}"))
    )
    return known.unionByName(unknown).filter("size(words) > 0").select(
        "row", "kind", "value", F.explode(F.expr(_patterns("words"))).alias("pattern"), "start", "end", "seed"
    )


def _key(*columns: str) -> Column:
    """One text for several columns, told apart by a character that no pattern holds."""
    return F.concat_ws("\n", *columns)


def _pattern_scores(pairs: DataFrame) -> DataFrame:
    """``(by_pattern, confidence)`` of patterns with enough known instances."""
    return checkpointed(
        pairs.groupBy("by_pattern")
        .agg(F.sum("known").alias("sure"), F.count(F.lit(1)).alias("all"), F.count_if(F.col("known") >= ACCEPTED).alias("many"))
        .filter(F.col("many") >= MIN_KNOWN)
        # The more known instances, the closer to the plain share.
        .select("by_pattern", (F.col("sure") / (F.col("all") + 1 / F.log2(F.col("many") + 1.0))).alias("confidence"))
    )


def discover(spans: DataFrame) -> DataFrame:
    """``(row, kind, start, end, confidence)`` of candidates that confident patterns find."""
    occurrences = checkpointed(
        _occurrences(spans).withColumn("by_pattern", _key("kind", "pattern")).withColumn("by_value", _key("kind", "value"))
    )
    # The graph: each pair of pattern and instance once, however often it occurs.
    pairs = checkpointed(
        occurrences.groupBy("by_pattern", "by_value").agg(F.max(F.col("seed").cast("double")).alias("known"))
    )
    if pairs.filter("known < 1").isEmpty() and occurrences.filter(F.col("kind") == SECRET).isEmpty():
        return occurrences.limit(0).select("row", "kind", "start", "end", F.lit(0.0).alias("confidence"))
    for _ in range(ROUNDS):
        scored = lookup_join(pairs, _pattern_scores(pairs), "by_pattern", "left").withColumn(
            "doubt", 1 - F.coalesce("confidence", F.lit(0.0))
        )
        # Noisy-or over the patterns of an instance; seeds stay certain.
        instances = checkpointed(
            scored.groupBy("by_value").agg(F.greatest(F.max("known"), 1 - F.product("doubt")).alias("score"))
        )
        pairs = checkpointed(
            lookup_join(pairs.drop("known"), instances, "by_value").select(
                "by_pattern", "by_value", F.when(F.col("score") >= ACCEPTED, F.col("score")).otherwise(0.0).alias("known")
            )
        )
    confident = _pattern_scores(pairs).filter(F.col("confidence") >= CONFIDENT)
    return (
        lookup_join(occurrences.filter((F.col("kind") == SECRET) | ~F.col("seed")), confident, "by_pattern")
        .groupBy("row", "kind", "start", "end")
        .agg(F.max("confidence").alias("confidence"))
    )


def _listed(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


def _in_order(spans: str) -> str:
    """SQL of spans ``(k, kind, start, end)`` in order of kind and start, without ``k``."""
    return f"transform(array_sort({spans}), x -> struct(x.kind, x.start, x.end))"


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``base`` and ``spans``, arrays of ``(kind, start, end)``.

    Both are in order of kind, then start; ``spans`` holds ``base`` and what was discovered.
    """
    matches = _all_matches(docs, id_column, text_column)
    spans = _placed(matches)
    # A candidate of two kinds goes to the one its patterns speak for most.
    added = (
        discover(spans)
        .groupBy("row", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
        .select("row", "kind", "start", "end", F.lit(False).alias("seed"))
    )
    seeds = spans.filter(F.col("kind") != _CANDIDATES).select("row", "kind", "start", "end", F.lit(True).alias("seed"))
    order = f"array_position(array('{"', '".join(_ORDER)}'), kind)"
    own = (
        seeds.unionByName(added)
        .withColumn("x", F.struct(F.expr(order).cast("int").alias("k"), "start", "end", "kind"))
        .groupBy("row")
        .agg(F.collect_list(F.when(F.col("seed"), F.col("x"))).alias("base"), F.collect_list("x").alias("spans"))
        .select("row", F.expr(_in_order("base")).alias("base"), F.expr(_in_order("spans")).alias("spans"))
    )
    nothing = "CAST(array() AS array<struct<kind: string, start: int, end: int>>)"
    return (
        matches.select("id", "row")
        .join(own, "row", "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("base", F.expr(nothing)).alias("base"),
            F.coalesce("spans", F.expr(nothing)).alias("spans"),
        )
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of the seeds of each kind, the hash of their list, and the list of all spans."""
    counts: dict[str, Column] = {
        f"n_{kind}": F.expr(f"CAST(size(filter(base, x -> x.kind = '{kind}')) AS long)") for kind in KINDS
    }
    return found.select(
        id_column,
        *[column.alias(name) for name, column in counts.items()],
        F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"),
        F.expr(_listed("spans")).alias("spans"),
        F.expr("CAST(size(spans) - size(base) AS long)").alias("n_added"),
    )
