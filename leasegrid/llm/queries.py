"""Registered queries of this folder and, where SQL can say it, their statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasegrid.llm import (
    bitplane_store, cross_polytope, license_dice, order_minhash, ordinal_quality, secret_confirm, simhash_tiles, substring_dedup,
    temperature_mix, template_decon, url_reputation, vector_codes, whitening,
)
from leasegrid.queries.registry import table

#: The rules of the URL query: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_TAIL = 0.6
MAX_BAD = 0.5
ENTROPY_RATIO = 0.95
CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS = 16, 64, 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of pages are the ratings that carry the page's number: poor or toxic is bad."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1.0).when(F.col("quality").isNotNull(), 0.0)
    rated = labels.groupBy(F.col("doc_id").alias("page")).agg(F.max(bad).alias("bad"))
    outcomes = pages.select("page_id", "url").join(rated, F.col("page_id") == F.col("page")).select("url", "bad")
    return url_reputation.filter_urls(pages, outcomes, URL_RULES, max_bad=MAX_BAD).select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled", F.round("post_low", 6).alias("post_low"))


def op2_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_dice.scan_licenses(table(spark, sf_dir, "documents"))


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents selected: rejected ones have no row."""
    docs = table(spark, sf_dir, "documents")
    ratings = ordinal_quality.graded(table(spark, sf_dir, "labels"))
    kept = ordinal_quality.select_quality(docs, ratings, MIN_TAIL)
    return kept.select("doc_id", "expected_grade", "tail_probability", F.lit(True).alias("kept"))


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = temperature_mix.mix_sources(docs, entropy_ratio=ENTROPY_RATIO)
    return mixed.select("doc_id", "source", "epoch", temperature_mix.order_key(17, F.col("epoch"), F.col("doc_id")).alias("order_key"))


def op5_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_distance=3)


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100).drop("kept")


def op7_template_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leak: document, item, windows found."""
    return template_decon.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_bitplane_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_store.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_secret_confirm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_confirm.scan_secrets(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 16 parts and 64 entries after two rounds, with the error of the row and of its label."""
    coded, books = vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"), parts=CODE_PARTS, entries=CODE_ENTRIES, rounds=CODE_ROUNDS)
    shown = vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error")
    return shown.withColumn("codebooks_sha256", F.lit(vector_codes.books_digest(books)))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.as_text(order_minhash.fingerprints(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_reputation, op2_license_dice, op3_ordinal_quality, op4_temperature_mix, op5_simhash_tiles, op6_suffix_array,
        op7_template_decon, op8_cross_polytope, op9_bitplane_store, op10_secret_confirm,
        op11_vector_codes, op12_whitening, op13_order_minhash,
    )
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_HOST = rf"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), {_AZ}), '')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"


def _strength_sql(level: str, n: str, k: str, mean: str) -> str:
    return (
        f"(SELECT CASE WHEN rho > 0 THEN least(1000e0, greatest(1e0, 1 / rho - 1)) ELSE 1000e0 END FROM (SELECT coalesce((dev - base) / nullif(excess, 0), 0) AS rho "
        f"FROM (SELECT sum(({k} - {n} * {mean}) * ({k} - {n} * {mean}) / {n}) AS dev, sum({mean} * (1 - {mean})) AS base, "
        f"sum({mean} * (1 - {mean}) * ({n} - 1)) AS excess FROM {level})))"
    )


def _rule_sql() -> str:
    ordered = sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    return "CASE " + " ".join(
        f"WHEN ends_with('.' || host, '.{h}') AND starts_with(path, '{p}') THEN '{h}{p}|{v}'" for h, p, v in ordered
    ) + " END"


_URL_SQL = f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
r AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1e0 WHEN quality IS NOT NULL THEN 0e0 END) AS bad FROM labels GROUP BY doc_id),
h0 AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM p JOIN r ON page_id = doc_id WHERE bad IS NOT NULL AND host <> '' GROUP BY host),
h1 AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^[^@]*@', ''), '\\.?(:[0-9]*)?$', ''), '.') AS parts FROM h0),
h AS (SELECT host, n, bad, parts[-1] AS suffix, array_to_string(CASE WHEN len(parts) > 2 THEN parts[-2:] ELSE parts END, '.') AS domain FROM h1),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
s0 AS (SELECT *, (SELECT (sum(bad) + 0.5e0) / (sum(n) + 1) FROM s) AS m0 FROM s),
s1 AS (SELECT suffix, (bad + k * m0) / (n + k) AS sm FROM (SELECT *, {_strength_sql("s0", "n", "bad", "m0")} AS k FROM s0)),
d0 AS (SELECT d.*, sm FROM d JOIN s1 USING (suffix)),
d1 AS (SELECT domain, (bad + k * sm) / (n + k) AS dm FROM (SELECT *, {_strength_sql("d0", "n", "bad", "sm")} AS k FROM d0)),
e0 AS (SELECT h.*, dm FROM h JOIN d1 USING (domain)),
e1 AS (SELECT host, n, k, (bad + k * dm) / (n + k) AS m FROM (SELECT *, {_strength_sql("e0", "n", "bad", "dm")} AS k FROM e0)),
e AS (SELECT host, n, greatest(0e0, m - 1.645e0 * sqrt(m * (1 - m) / (n + k + 1))) AS low FROM e1),
j AS (SELECT p.*, e.n, e.low, {_rule_sql()} AS hit FROM (SELECT * FROM p) p LEFT JOIN (SELECT host AS eh, n, low FROM e) e ON p.host = eh)
SELECT page_id, host, path, string_split(hit, '|')[1] AS rule,
  coalesce(string_split(hit, '|')[2], CASE WHEN coalesce(low, 0) > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(n, 0) AS n_labelled, round(low, 6) AS post_low FROM j
"""

_NORM = "trim(regexp_replace(translate(coalesce({0}, ''), " + _AZ + "), '[^a-z0-9]+', ' ', 'g'))"
_PAIRS = "list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)"
_LICENSE_SQL = (
    "WITH t0(license_id, body) AS (VALUES "
    + ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(license_dice.TEMPLATES.items()))
    + f"), t1 AS (SELECT license_id, string_split({_NORM.format('body')}, ' ') AS w FROM t0), t AS (SELECT license_id, {_PAIRS} AS b FROM t1), "
    + "g0 AS (SELECT doc_id, unnest(list_distinct(list_concat([coalesce(text, '')], string_split_regex(coalesce(text, ''), '\\n[ \\t\\r]*\\n'), "
    + "string_split(coalesce(text, ''), chr(10))))) AS part FROM documents), "
    + f"g1 AS (SELECT doc_id, part, {_NORM.format('part')} AS norm FROM g0), "
    + f"g2 AS (SELECT doc_id, part, string_split(norm, ' ') AS w FROM g1 WHERE norm <> ''), g AS (SELECT doc_id, part, {_PAIRS} AS a FROM g2), "
    + "x AS (SELECT doc_id, part, license_id, 2e0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice FROM g JOIN t "
    + "ON len(a) >= len(b) * (0.8e0 / 1.2e0) AND len(a) <= len(b) * (1.2e0 / 0.8e0)), "
    + "y AS (SELECT * FROM x WHERE dice >= 0.8e0 QUALIFY row_number() OVER (PARTITION BY doc_id, part ORDER BY dice DESC, license_id DESC) = 1) "
    + "SELECT doc_id, license_id, round(max(dice), 6) AS dice, count(*) AS n_segments FROM y GROUP BY doc_id, license_id"
)

_MIX_SQL = rf"""
WITH RECURSIVE c AS (SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM c GROUP BY source),
tot AS (SELECT sum(tokens)::DOUBLE AS total, count(*) FILTER (WHERE tokens > 0) AS live FROM s),
p AS (SELECT source, tokens, ln(tokens / total) AS lp FROM s, tot WHERE tokens > 0),
ends AS (SELECT (SELECT ln(sum(exp(lp))) - sum(exp(lp) * lp) / sum(exp(lp)) FROM p) >= {ENTROPY_RATIO}e0 * ln(live) AS full_met FROM tot),
it AS (
  SELECT 0 AS i, CASE WHEN full_met THEN 1e0 ELSE 0e0 END AS lo, 1e0 AS hi FROM ends
  UNION ALL
  SELECT i + 1, CASE WHEN good THEN (lo + hi) / 2 ELSE lo END, CASE WHEN good THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, (SELECT ln(sum(exp((lo + hi) / 2 * lp))) - (lo + hi) / 2 * sum(exp((lo + hi) / 2 * lp) * lp) / sum(exp((lo + hi) / 2 * lp)) FROM p)
    >= {ENTROPY_RATIO}e0 * ln((SELECT live FROM tot)) AS good FROM it WHERE i < 30)
),
x AS (SELECT lo AS t FROM it WHERE i = 30),
w AS (SELECT s.source, s.tokens, CASE WHEN s.tokens > 0 THEN exp(t * ln(s.tokens / total)) / (SELECT sum(exp(t * lp)) FROM p) * total END AS budget FROM s, x, tot),
e AS (SELECT *, CASE WHEN tokens > 0 THEN floor(budget / tokens + 1e-9)::BIGINT ELSE 1 END AS epochs FROM w),
r AS (SELECT *, CASE WHEN tokens > 0 THEN greatest(0e0, budget - epochs * tokens) ELSE 0e0 END AS rest FROM e),
k AS (SELECT c.source, c.doc_id, c.tokens, epochs, rest, md5('17:' || epochs || ':' || coalesce(c.doc_id::VARCHAR, '')) AS okey FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source),
u AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY okey RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k),
n AS (SELECT source, doc_id, unnest(range(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM u)
SELECT doc_id, source, epoch, md5('17:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS order_key FROM n
"""



def _codes_sql() -> str:
    """Rounds of assignment and floor of means as common tables; parts of 1-based positions."""
    n = CODE_PARTS

    def assign(book: str) -> str:
        gap = "list_sum(list_transform(list_zip(k.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT"
        return (
            f"SELECT vec_id, label, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM "
            f"(SELECT k.vec_id, k.label, k.p, c.e, {gap} AS d FROM k JOIN {book} c USING (p)) GROUP BY vec_id, label, p"
        )

    steps = [
        "f AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256e0 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"k AS (SELECT vec_id, label, p, v[p * len(v) // {n} + 1:(p + 1) * len(v) // {n}] AS x FROM f, range({n}) r(p))",
        f"c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM k QUALIFY e < {CODE_ENTRIES})",
    ]
    for i in range(CODE_ROUNDS + 1):
        steps.append(f"a{i} AS ({assign(f'c{i}')})")
        if i < CODE_ROUNDS:
            steps.append(
                f"m{i} AS (SELECT p, e, list(mean ORDER BY j) AS x FROM (SELECT p, e, j, floor(sum(y) / count(*))::BIGINT AS mean FROM "
                f"(SELECT a.p, a.e, unnest(k.x) AS y, generate_subscripts(k.x, 1) AS j FROM a{i} a JOIN k ON a.vec_id = k.vec_id AND a.p = k.p) GROUP BY p, e, j) GROUP BY p, e)")
            steps.append(f"c{i + 1} AS (SELECT p, e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (p, e))")
    last = CODE_ROUNDS
    steps.append(f"o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY vec_id, label)")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{last})")
    return "WITH " + ", ".join(steps) + " SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, s"


SQL: dict[str, str] = {"op1_url_reputation": _URL_SQL, "op2_license_dice": _LICENSE_SQL, "op4_temperature_mix": _MIX_SQL, "op11_vector_codes": _codes_sql()}
