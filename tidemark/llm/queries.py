"""One query for each text operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    packing,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents")).drop("row")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer)).drop("row")


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op8_mix_sources",
    """
    WITH sizes AS (SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), 0.5) AS weight FROM documents GROUP BY source),
    rates AS (
        SELECT source, weight * CAST((SELECT sum(n) FROM sizes) AS DOUBLE) / (SELECT sum(weight) FROM sizes) / n AS rate
        FROM sizes),
    terms AS (
        SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS term
        FROM rates, (SELECT unnest(range(0, 2000)) AS k) WHERE k <= 40 + 4 * rate),
    steps AS (SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
    drawn AS (
        SELECT *, CAST('0x' || md5('mix:' || doc_id)[1:13] AS BIGINT) / 4503599627370496.0 AS u FROM documents),
    counted AS (
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(s.k) AS copies
        FROM drawn d JOIN steps s ON s.source IS NOT DISTINCT FROM d.source AND s.below <= d.u
        GROUP BY ALL)
    SELECT doc_id, text, lang, source, n_chars, copy, md5('mix:order:' || doc_id || ':' || copy) AS shuffle_key
    FROM (SELECT *, CAST(unnest(range(copies)) AS INTEGER) AS copy FROM counted)""",
)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op4_pii_pseudonyms")
def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise(table(spark, sf_dir, "documents"), key="tidemark")
    return made.select("doc_id", "text", F.size("private_kinds").cast("long").alias("n_private"), "private_kinds")


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.withColumn("has_repeat", F.col("n_removed") > 0)


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"))


@query(
    "op11_collocations",
    r"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
    sizes AS (SELECT unnest(range(1, 6)) AS size),
    f AS (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
        FROM places, sizes WHERE i + size - 1 <= len(w) GROUP BY ALL),
    totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
    found AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1 AND f >= 100),
    cuts AS (SELECT *, unnest(range(1, size)) AS k FROM found),
    scored AS (
        SELECT c.lang, c.phrase, c.size, c.a, p.f AS l, q.f AS r, t.n, k,
               (1000::HUGEINT * c.a * t.n) // (p.f::HUGEINT * q.f) AS score
        FROM cuts c JOIN totals t ON t.lang = c.lang
        JOIN f p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1:k], ' ')
        JOIN f q ON q.lang = c.lang AND q.phrase = array_to_string(c.w[k + 1:], ' ')),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_sizes AS (SELECT lang, w, size, a, unnest(range(2, size)) AS part FROM found),
    inner_places AS (SELECT lang, w, a, part, unnest(range(1, size - part + 2)) AS i FROM inner_sizes),
    covered AS (
        SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS within FROM inner_places GROUP BY ALL),
    ranked AS (
        SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
        FROM weakest s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
        WHERE v.within IS NULL OR v.within < s.a)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked WHERE rank <= 2000""",
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query(
    "op12_conversation_trie",
    """
    WITH tab AS (
        SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
            lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS t),
    said AS (
        SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT c, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || t)) AS turns
        FROM said GROUP BY c),
    drawn AS (
        SELECT c, turns, xor(4294967295, list_reduce(
            list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
            lambda x, b: xor(x // 256, tab.t[xor(x % 256, b) + 1]))) % 9 AS h
        FROM own, tab),
    made AS (
        SELECT d.c, list_concat(coalesce(b.turns, [])[1:d.h], d.turns[d.h + 1:]) AS key
        FROM drawn d LEFT JOIN own b ON b.c = d.c - d.c % 5),
    steps AS (SELECT c, key, unnest(range(len(key) + 1)) AS d FROM made),
    prefixes AS (SELECT c, d, key[1:d] AS p, len(key) = d AS ends FROM steps),
    nodes AS (
        SELECT d, p, min(c) AS c, count(*) AS n, list(c ORDER BY c) FILTER (WHERE ends) AS e
        FROM prefixes GROUP BY d, p),
    above AS (SELECT n.*, CASE WHEN d > 0 THEN p[1:d - 1] END AS q FROM nodes n),
    counted AS (
        SELECT a.*, u.c AS parent, (SELECT count(*) FROM above k WHERE k.q = a.p) AS kids
        FROM above a LEFT JOIN nodes u ON u.p = a.q AND u.d = a.d - 1),
    lifted AS (
        SELECT w.p, w.d, sum(CASE WHEN k.kids = 0 THEN 1 ELSE 0 END) AS leaves,
               sum(CASE WHEN k.d > 0 THEN (k.n - 1) * strlen(k.p[k.d].t) ELSE 0 END) AS saved
        FROM counted k JOIN prefixes w ON w.c = k.c AND w.d <= k.d GROUP BY w.p, w.d)
    SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, kids AS n_children,
           CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
           sha256(coalesce(array_to_string(e, ','), '')) AS ends_sha256
    FROM counted JOIN lifted USING (p, d)""",
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
