"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eavista.llm import (
    bpe, centroids, conversation_repair, exact_chunks, line_dedup, mixing, quality_qda, quality_rules, secret_scan, simhash_dedup, substring_dedup,
    toxicity, url_filter,
)
from eavista.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_bpe_round_trip")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def _mixing_sql() -> str:
    """Rounds of raking to the full targets as a recursive table that ends by the operator's rule, then copies."""
    m = mixing
    steps = [f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+'))::BIGINT AS n_tokens
    FROM documents
),
marked AS (
    SELECT doc_id, source, lang, n_tokens,
           CASE WHEN length(text) - length(replace(text, '|', '')) >= {m.TABLE_BARS} THEN 'table'
                WHEN n_tokens < {m.NOTE_WORDS} THEN 'note' WHEN n_tokens < {m.ARTICLE_WORDS} THEN 'article' ELSE 'book' END AS topic
    FROM docs
),
sums AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM marked GROUP BY ALL HAVING sum(n_tokens) > 0),
own AS MATERIALIZED (SELECT source, lang, topic, tokens / (SELECT sum(tokens) FROM sums) AS share FROM sums)"""]
    for margin in m.MARGINS:
        steps.append(f"""
own_{margin} AS (SELECT {margin} AS value, pow(sum(share), {m.POWER[margin]}) AS wish FROM own GROUP BY ALL),
target_{margin} AS MATERIALIZED (SELECT value, wish / (SELECT sum(wish) FROM own_{margin}) AS target FROM own_{margin})""")
    targets = ", ".join(f"target_{margin}.target AS t_{margin}" for margin in m.MARGINS)
    joins = " ".join(f"JOIN target_{margin} ON {margin} = target_{margin}.value" for margin in m.MARGINS)
    once = "(SELECT *, weight AS before FROM raked WHERE going)"
    for margin in m.MARGINS:
        once = f"(SELECT * REPLACE (weight * (t_{margin} / sum(weight) OVER (PARTITION BY {margin})) AS weight) FROM {once})"
    error = ", ".join(f"abs(sum(weight) OVER (PARTITION BY {margin}) / t_{margin} - 1)" for margin in m.MARGINS)
    moved = ", ".join(f"sum(abs(weight - before)) OVER (PARTITION BY {margin}) / t_{margin}" for margin in m.MARGINS)
    steps.append(f"""
raked AS (
    SELECT 0 AS k, source, lang, topic, share, share::DOUBLE AS weight, {targets}, true AS going FROM own {joins}
    UNION ALL
    SELECT k + 1, source, lang, topic, share, weight, t_source, t_lang, t_topic,
           k + 1 < {m.ROUNDS} OR max(error) OVER () > {m.TOLERANCE} AND max(moved) OVER () > {m.STILL} * max(error) OVER ()
    FROM (SELECT *, greatest({error}) AS error, greatest({moved}) AS moved FROM {once})
),
cells AS (
    SELECT source, lang, topic, round(weight / share * {m.KEEP}::DOUBLE, {m.PLACES}) AS expected FROM raked WHERE NOT going
),
chosen AS (
    SELECT doc_id, source, lang, topic, n_tokens, coalesce(expected, 1.0) AS expected,
           ('0x' || substr(md5(doc_id || ':{m.SEED}'), 1, 12))::BIGINT / {16**12}.0 AS chance
    FROM marked LEFT JOIN cells USING (source, lang, topic)
)""")
    return ",".join(steps) + """
SELECT doc_id, source, lang, topic, n_tokens, least(expected, 1.0) AS probability, chance < expected AS selected,
       floor(expected)::BIGINT + (chance < expected - floor(expected))::BIGINT AS copies
FROM chosen"""


@query("op4_source_mixing", _mixing_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), repeats=True)


#: Word lists of the check SQL: the ASCII spaces are one separator.
_WORDS = "list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


_LINE_FAILS = f"""(
    100 * {_count('line', '[#*$%&|<>]')} > {quality_rules.MAX_SYMBOLS} * chars
    OR n >= 4 AND 100 * {_count('line', '[A-Z]')} > {quality_rules.MAX_SHOUTED} * {_count('line', '[A-Za-z]')}
    OR 100 * {_count('line', '[!?]{2,}')} > {quality_rules.MAX_STUTTER} * n
    OR n >= {quality_rules.PROSE_WORDS} AND NOT regexp_matches(line, '[.!?:;]')
    OR {_count('line', '[|»]')} >= 3 AND 4 * {_count('line', '[|»]')} >= n
    OR n >= 4 AND 100 * len(list_filter(range(2, n + 1), lambda i: words[i] = words[i - 1])) > {quality_rules.MAX_STUTTER} * n
    OR n <= {quality_rules.FURNITURE_WORDS} AND regexp_matches(lower(line), '{"|".join(quality_rules.FURNITURE)}')
)"""


@query("op5_quality_rules", f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, line, number, {_WORDS.format(text='line')} AS words
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS number FROM docs)
),
full_lines AS (
    SELECT *, len(words) AS n, length(array_to_string(words, '')) AS chars,
           row_number() OVER (PARTITION BY doc_id, line ORDER BY number) > 1 AS again
    FROM lines WHERE len(words) > 0
),
judged AS (SELECT *, {_LINE_FAILS} AS fails FROM full_lines),
by_doc AS (
    SELECT doc_id, sum(n) AS n_words, sum(chars) AS word_chars, count(*) FILTER (again) AS n_dup_lines,
           count(*) AS n_lines, count(*) FILTER (fails) AS n_failed_lines,
           coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
    FROM judged GROUP BY doc_id
),
tokens AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place
    FROM (SELECT doc_id, {_WORDS.format(text='text')} AS words FROM docs)
),
windows AS (
    SELECT doc_id, place, (count(*) OVER w) = {quality_rules.WINDOW} AS whole, array_to_string((list(word) OVER w), ' ') AS content
    FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND {quality_rules.WINDOW - 1} FOLLOWING)
),
found AS (SELECT doc_id, place, whole AND count(*) OVER (PARTITION BY doc_id, whole, content) > 1 AS twice FROM windows),
covered AS (
    SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN {quality_rules.WINDOW - 1} PRECEDING AND CURRENT ROW) AS inside
    FROM found
),
repeats AS (SELECT doc_id, count(*) FILTER (inside) AS n_repeat_words FROM covered GROUP BY doc_id),
facts AS (
    SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
           {_count('text', '[#*$%&|<>]')}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
           coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
    FROM docs d LEFT JOIN by_doc USING (doc_id) LEFT JOIN repeats USING (doc_id)
),
base AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT} * n_words AS base_failed FROM facts)
SELECT *, NOT base_failed AND 100 * lost_chars <= {quality_rules.MAX_LOST} * word_chars AS kept FROM base
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


#: Lines of two words, or of enough letters of scripts without spaces, in DuckDB's regular expressions.
_JUDGED = (
    "(regexp_matches(bare, '[^ \\t-\\r][ \\t-\\r]+[^ \\t-\\r]') "
    f"OR len(regexp_extract_all(bare, '{line_dedup.UNSPACED_PATTERN}')) >= {line_dedup.UNSPACED_LETTERS})"
)


@query("op6_line_dedup", f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, source, text, line, place, regexp_replace(line, '^[ \\t-\\r]+|[ \\t-\\r]+$', '', 'g') AS bare
    FROM (SELECT *, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM docs)
),
spread AS (
    SELECT bare FROM lines WHERE {_JUDGED}
    GROUP BY bare HAVING count(DISTINCT source) >= {line_dedup.SITES}
),
marked AS (SELECT *, bare IN (SELECT bare FROM spread) AS hit FROM lines),
copies AS (SELECT text FROM docs GROUP BY text HAVING count(DISTINCT doc_id) > 1),
by_doc AS (
    SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (hit) AS hits,
           100 * coalesce(sum(length(line)) FILTER (hit), 0) > {line_dedup.MOST} * length(text)
               AND text IN (SELECT text FROM copies) AS whole_copy,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT hit), '') AS clean
    FROM marked GROUP BY doc_id, text
)
SELECT doc_id, n_lines, CASE WHEN whole_copy THEN 0 ELSE hits END AS n_removed,
       sha256(CASE WHEN whole_copy OR hits = 0 THEN text ELSE clean END) AS kept_sha256
FROM by_doc
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


_AFTER = "'^(?s:.*?)://"
_RULE_CASES = sorted(url_filter.RULES, key=lambda r: -len(r.text))


def _rule_case(value: str) -> str:
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'"
        for r in _RULE_CASES
    ) + " END"


@query("op7_url_filter", f"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), {_AFTER}([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), {_AFTER}[^/?#]*(/[^?#]*)', 1) AS path,
           regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), {_AFTER}[^?#]*\\?([^#]*)', 1),
               '(^|&)({url_filter.TRACKING})=[^&]*', '', 'g'), '^&+', '') AS query
    FROM pages
),
named AS (
    SELECT *, CASE WHEN host <> '' THEN concat(host, regexp_replace(path, '/+$', ''), CASE WHEN query <> '' THEN concat('?', query) ELSE '' END) END AS canonical
    FROM parts
),
list AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '{url_filter.listed_pattern()}') AND contains(host, '-'))
SELECT page_id, host, path, {_rule_case('text')} AS rule,
       coalesce({_rule_case('verdict')}, CASE WHEN canonical IN (SELECT canonical FROM list) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(canonical IN (SELECT canonical FROM list), false) AS listed
FROM named
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_hosts(pages))


@query("op8_simhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query("op10_exact_dedup", """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
kept AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM docs JOIN kept USING (text)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_chunks.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lloyd_sql() -> str:
    """Assignments and new centroids, one common table each."""
    m = centroids
    steps = [f"""
WITH kept AS (
    SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda v: floor({m.SCALE} * v::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {m.DIMENSIONS} AND len(list_filter(embedding, lambda v: isfinite(v))) = {m.DIMENSIONS}
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256(concat('{m.SEED}:', coalesce(vec_id::VARCHAR, 'null'))), x) - 1 AS cluster, x AS c
    FROM kept ORDER BY cluster LIMIT {m.CLUSTERS}
)"""]
    for k in range(m.ROUNDS + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
    SELECT row_id, vec_id, x, cluster, distance FROM (
        SELECT row_id, vec_id, x, cluster, list_sum(list_transform(range(1, {m.DIMENSIONS + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS distance
        FROM kept, c{k}
    ) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) = 1
)""")
        if k < m.ROUNDS:
            steps.append(f"""
m{k} AS (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS mean
    FROM (SELECT cluster, i, sum(v)::BIGINT AS total, count(*) AS n
          FROM (SELECT cluster, unnest(x) AS v, unnest(range({m.DIMENSIONS})) AS i FROM a{k}) GROUP BY cluster, i)
    GROUP BY cluster
),
c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(mean, c) AS c FROM c{k} LEFT JOIN m{k} USING (cluster))""")
    return ",".join(steps) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{m.ROUNDS} JOIN c{m.ROUNDS} USING (cluster)"""


@query("op12_centroid_clusters", _lloyd_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
