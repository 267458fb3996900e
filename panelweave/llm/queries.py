"""The registered queries of this subpackage, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.llm import (
    bag_minhash,
    bpe,
    collocations,
    exact_dedup,
    language_id,
    merkle,
    min_slack,
    packing,
    pitman_yor,
    quality,
    secret_scans,
    substring_dedup,
    url_filters,
)
from panelweave.llm.workers import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(name: str, sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op4_url_filters",
    rf"""
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
    parts AS (
        SELECT page_id,
            CASE WHEN strpos(url, '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    urls AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parts
    )
    SELECT page_id, host, path,
        (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
           AND starts_with(path, rule_path)) AS rule,
        coalesce((SELECT max_by(rule_verdict, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
           AND starts_with(path, rule_path)), 'allow') AS verdict
    FROM urls
    """,
)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), listed)


@query(
    "op9_exact_dedup",
    """
    WITH marked AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size,
        doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
    FROM marked
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.group_copies(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judge(docs, quality.fit(docs, labels))


@query("op6_secret_scans")
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(table(spark, sf_dir, "documents")).drop("file", "place")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, tokenizer("byte_bpe_50k.json"), digests=True)


@query("op8_minhash_dedup")
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("file", "place")


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op11_collocations",
    rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    numbered AS (
        SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ),
    words AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered),
    totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
    fours AS (
        SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
        FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
    ),
    grams AS (
        SELECT lang, 1 AS size, [w1] AS gram FROM fours
        UNION ALL SELECT lang, 2, [w1, w2] FROM fours WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, [w1, w2, w3] FROM fours WHERE w3 IS NOT NULL
        UNION ALL SELECT lang, 4, [w1, w2, w3, w4] FROM fours WHERE w4 IS NOT NULL
    ),
    counts AS (
        SELECT lang, size, gram, array_to_string(gram, ' ') AS phrase, count(*) AS a
        FROM grams GROUP BY lang, size, gram HAVING count(*) >= 30
    ),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, k, f.a AS l, b.a AS r,
            (2000000::HUGEINT * c.a // (f.a + b.a))::BIGINT AS score
        FROM counts c, (VALUES (1), (2), (3)) AS ks(k), counts f, counts b
        WHERE k < c.size AND f.lang = c.lang AND f.phrase = array_to_string(c.gram[1:k], ' ')
            AND b.lang = c.lang AND b.phrase = array_to_string(c.gram[k + 1:], ' ')
    ),
    lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ),
    inner_phrases AS (
        SELECT lang, a, array_to_string(gram[i:i + held - 1], ' ') AS phrase
        FROM counts, (VALUES (2), (3)) AS helds(held), (VALUES (1), (2), (3)) AS firsts(i)
        WHERE held < size AND i + held - 1 <= size
    ),
    longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase),
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary"
        ) AS rank
        FROM lowest LEFT JOIN longest USING (lang, phrase)
        WHERE longer IS NULL OR 100 * longer < 80 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_best_fit")
def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return min_slack.pack_whole(docs, tokenizer("byte_bpe_50k.json"))


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(map(_framed, fields))})"


@query(
    "op13_merkle",
    rf"""
    WITH RECURSIVE bytes AS (
        SELECT list_transform(range(256), lambda b: list_reduce(
            range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, b
        )) AS entries
    ),
    leaves AS (
        SELECT doc_id, source, {_leaf("text")} AS leaf,
            row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n,
            CASE WHEN list_reduce(
                string_split(doc_id::VARCHAR, ''),
                lambda c, x: xor(c // 256, entries[xor(c % 256, ascii(x)) + 1]), 4294967295
            ) % 2 = 1 THEN {_leaf("translate(text, chr(10), '')")} ELSE leaf END AS altered
        FROM documents, bytes
    ),
    trees AS (
        SELECT source, 0 AS level, pos, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
        FROM trees WHERE n > 1 GROUP BY source, level, n, pos // 3
    ),
    subroots AS (
        SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM trees WHERE n = 1
    ),
    top AS (
        SELECT 0 AS level, pos, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
        FROM top WHERE n > 1 GROUP BY level, n, pos // 3
    ),
    folds AS (
        SELECT doc_id, source, 0 AS level, pos, n, altered AS digest, '' AS proof FROM leaves
        UNION ALL
        SELECT f.doc_id, f.source, f.level + 1, f.pos // 3, (f.n + 2) // 3,
            sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.digest ELSE t.digest END, '' ORDER BY t.pos)),
            f.proof || coalesce(string_agg(CASE WHEN t.pos <> f.pos THEN t.digest END, '' ORDER BY t.pos), '')
        FROM folds f JOIN trees t
            ON t.source IS NOT DISTINCT FROM f.source AND t.level = f.level AND t.pos // 3 = f.pos // 3
        WHERE f.n > 1 GROUP BY f.doc_id, f.source, f.level, f.pos, f.n, f.proof
    ),
    climbs AS (
        SELECT f.doc_id, 0 AS level, s.pos, s.n, f.digest, f.proof, s.digest AS subroot
        FROM folds f JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
        UNION ALL
        SELECT c.doc_id, c.level + 1, c.pos // 3, (c.n + 2) // 3,
            sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.digest ELSE t.digest END, '' ORDER BY t.pos)),
            c.proof || coalesce(string_agg(CASE WHEN t.pos <> c.pos THEN t.digest END, '' ORDER BY t.pos), ''),
            c.subroot
        FROM climbs c JOIN top t ON t.level = c.level AND t.pos // 3 = c.pos // 3
        WHERE c.n > 1 GROUP BY c.doc_id, c.level, c.pos, c.n, c.proof, c.subroot
    )
    SELECT l.doc_id, l.leaf, c.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256,
        c.digest AS folded_root, c.digest = r.digest AS verified
    FROM leaves l JOIN climbs c ON c.doc_id = l.doc_id AND c.n = 1, (SELECT digest FROM top WHERE n = 1) r
    """,
)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.manifest(table(spark, sf_dir, "documents"), fields)
