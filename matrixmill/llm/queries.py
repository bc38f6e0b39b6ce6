"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixmill.llm import (
    decontaminate,
    exact_dedup,
    lexical,
    licenses,
    packing,
    pii,
    quality,
    repeats,
    simhash,
    spelling,
    toxicity,
    urls,
    warc,
)
from matrixmill.llm.common import read_rows
from matrixmill.sources.tables import stage_path

# The rules of the url query.
URL_RULES = (
    urls.Rule(urls.ALLOW, "org", "/"),
    urls.Rule(urls.BLOCK, "example.org", "/es/"),
    urls.Rule(urls.BLOCK, "example.org", "/en/1"),
    urls.Rule(urls.ALLOW, "com", "/fr/"),
    urls.Rule(urls.BLOCK, "com", "/de/"),
)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_rows(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that overlap; clean documents have none."""
    documents, benchmark = (read_rows(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.find_overlaps(documents, benchmark)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_rows(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_rows(spark, sf_dir, "documents")
    return licenses.scan(documents, licenses.fit_model(licenses.sample_lines(documents)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(read_rows(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_rows(spark, sf_dir, "pages"), URL_RULES)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.chunk_rows(read_rows(spark, sf_dir, "pages"))
    manifest = warc.write_archives(chunks, stage_path(spark, "archives"))
    return warc.payload_table(warc.read_archives(spark, manifest))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_rows(spark, sf_dir, "documents")
    forest = quality.fit_model(documents, read_rows(spark, sf_dir, "labels"), quality.TRAINING)
    scored = quality.score(documents.select("doc_id", "text"), forest)
    return scored.select(
        "doc_id",
        F.expr(f"NOT ({quality.TRAINING})").alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPTED).cast("int").alias("predicted"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_rows(spark, sf_dir, "documents")
    model = toxicity.fit_model(documents, read_rows(spark, sf_dir, "labels"), toxicity.TRAINING)
    tagged = toxicity.tag(documents.select("doc_id", "text"), model, keep_text=False)
    return tagged.select(
        "doc_id",
        F.expr(f"NOT ({toxicity.TRAINING})").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECTED).cast("int").alias("predicted"),
        "spans",
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(read_rows(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read_rows(spark, sf_dir, "documents"), change=spelling.thinned)
    return spelling.group_variants(words)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(read_rows(spark, sf_dir, "documents")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_rows(spark, sf_dir, "documents"), read_rows(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash,
        op2_decontaminate,
        op3_pack,
        op4_licenses,
        op5_exact_dedup,
        op6_url_filter,
        op7_warc,
        op8_quality,
        op9_toxicity,
        op10_pii,
        op11_spelling_variants,
        op12_substring_dedup,
        op13_lexical_search,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES = {
    "op5_exact_dedup": f"""
        WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
        groups AS (
            SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM hashed JOIN groups USING (text_sha256)""",
    # The checksum is worked out byte by byte; near words share what is left when one letter goes.
    "op11_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
        runs AS (
            SELECT doc_id, run, count(*) AS many FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
                FROM documents)
            WHERE length(run) >= 7 GROUP BY doc_id, run),
        hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs),
        checked AS (
            SELECT run, many, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
                    lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM hexed, crc_table),
        changed AS (
            SELECT CASE WHEN crc % 31 = 0
                THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, many
            FROM checked),
        vocabulary AS (
            SELECT word, CAST(sum(many) AS BIGINT) AS n FROM changed WHERE length(word) >= 7
            GROUP BY word HAVING sum(many) >= 2),
        cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
        pairs AS (
            SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
            FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION
            SELECT DISTINCT c.word, c.n, v.word, v.n FROM cut c JOIN vocabulary v ON c.rest = v.word
            UNION
            SELECT DISTINCT v.word, v.n, c.word, c.n FROM cut c JOIN vocabulary v ON c.rest = v.word),
        near AS (
            SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near
            FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
        forms AS (SELECT word, other AS form, other_n AS form_n FROM near WHERE other_n >= 10 * n),
        steps AS (
            SELECT word, form AS root, 1 AS step FROM forms
            UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON s.root = f.word),
        roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM vocabulary LEFT JOIN (SELECT word, n_near FROM near) USING (word) LEFT JOIN forms USING (word)
             LEFT JOIN roots USING (word)""",
    "op12_substring_dedup": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        windows AS (
            SELECT r, doc_id, pos, md5(array_to_string(words[pos + 1 : pos + 50], ' ')) AS w
            FROM (SELECT *, unnest(range(len(words) - 49)) AS pos FROM texts WHERE len(words) >= 50)),
        least AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w),
        gone AS (
            SELECT r, list(DISTINCT pos + k) AS places
            FROM (SELECT r, pos FROM windows JOIN least USING (w) WHERE doc_id > first_id), range(1, 51) AS steps(k)
            GROUP BY r),
        kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY place) AS kept_text
            FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts)
            ANTI JOIN (SELECT r, unnest(places) AS place FROM gone) USING (r, place)
            GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
        FROM texts LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)""",
    "op13_lexical_search": rf"""
        WITH terms AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents),
        sizes AS (SELECT r, doc_id, len(terms) AS n FROM terms WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS num, CAST(sum(n) AS BIGINT) AS total FROM sizes),
        counts AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM terms) GROUP BY r, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2.0 * num + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term, num),
        wanted AS (
            SELECT item_id, i, term, count(*) AS many
            FROM (SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term
                  FROM benchmark)
            GROUP BY item_id, i, term),
        scores AS (
            SELECT item_id, i, doc_id, r,
                   sum(many * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * num) // total)))) AS score
            FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (r), totals
            GROUP BY item_id, i, doc_id, r)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
               doc_id, CAST(score AS BIGINT) AS score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) <= 10""",
}
