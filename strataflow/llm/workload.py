"""Registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (
    codes,
    decontaminate,
    langid,
    lexical,
    licenses,
    mixing,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    topk,
    urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24
SHINGLE = 3
WEIGHTS, SHARE_PERCENT, MOST_COPIES, SEED = (3, 1, 2), 150, 2, 42
WORD = r"[^\x20\x09-\x0D]+"

URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]
# Names that put a host on the blocklist of the workload.
BLOCKED_HOSTS = "(^|[.-])(pills|spam|adult|casino)([.-]|$)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=SHINGLE)


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op4_quality",
    rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT row, doc_id, text, regexp_extract_all(text, '{WORD}') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS l FROM docs),
windows AS (SELECT row, unnest(range(1, len(w) - 3)) AS place, unnest(list_transform(range(1, len(w) - 3),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS gram FROM split WHERE len(w) >= 5),
twice AS (SELECT row, place FROM (SELECT row, place, count(*) OVER (PARTITION BY row, gram) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT row, sum(least(5, place - coalesce(before, -5)))::BIGINT AS n FROM (
    SELECT row, place, lag(place) OVER (PARTITION BY row ORDER BY place) AS before FROM twice) GROUP BY row),
measured AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{quality.SYMBOLS}'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN repeated USING (row)),
judged AS (SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
    + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
    + 16 * (word_chars < 3 * n_words)::INT + 32 * (word_chars > 12 * n_words)::INT)::BIGINT AS failed FROM measured)
SELECT *, failed & 3 <> 0 AS base_failed, failed & 7 = 0 AS kept, 2 AS policy FROM judged""",
)
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), quality.PRODUCTION)


def _ablations_sql() -> str:
    """Policies and rules as rows of masks, met with the bit patterns of the ledger that SQL computes for op4."""
    ledger = ORACLES["op4_quality"].rpartition("\nSELECT *")[0]
    rows = ", ".join(
        f"({v}, '{name}', {quality.mask(names)}::BIGINT, {quality.mask([name])}::BIGINT)"
        for v, names in quality.POLICIES.items()
        for name in names
    )
    return f"""{ledger}, masks(policy, rule, all_rules, own) AS (VALUES {rows}),
patterns AS (SELECT failed, count(*) AS n FROM judged GROUP BY 1)
SELECT policy::INT AS policy, rule, coalesce(sum(n), 0)::BIGINT AS documents,
    coalesce(sum(n) FILTER (WHERE failed & all_rules = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE failed & own <> 0), 0)::BIGINT AS failed_rule,
    coalesce(sum(n) FILTER (WHERE failed & all_rules <> 0 AND failed & (all_rules - own) = 0), 0)::BIGINT AS removed_alone,
    coalesce(sum(n) FILTER (WHERE failed & (all_rules - own) = 0), 0)::BIGINT AS kept_without
FROM masks LEFT JOIN patterns ON true GROUP BY 1, 2"""


@query("quality_ablations", _ablations_sql())
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every rule of every policy removes, from the ledger of all documents."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secret_scan.scan(documents, labelled_findings(documents), lang="lang")


def labelled_findings(documents: DataFrame) -> DataFrame:
    """Findings of three quarters of the documents with the labels a reviewer would give by form.

    Access keys and hexadecimal values of a token or password are secrets, numbers and
    plain words are not; other findings have no label.
    """
    found = secret_scan.candidates(documents.where(~langid.held_out(F.col("doc_id"))))
    return found.withColumn("label", finding_label())


def finding_label() -> Column:
    word = F.col("word")
    access_key = F.col("value").rlike("^AKIA[0-9A-Z]{16}$")
    assigned = word.rlike("^password=[0-9a-f]{16,}") | (
        word.rlike('^"[0-9a-f]{32,}"') & F.col("before").rlike("(?:^| )token =$")
    )
    harmless = F.col("value").rlike("^(?:[0-9]+|[A-Za-z]+)$") & ~access_key
    return F.when(access_key | assigned, 1).when(harmless, 0)


@query("op6_licenses", licenses.scan_sql())
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _rule_sql(rule: urls.Rule) -> str:
    return (
        f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}') "
        f"THEN '{rule.text}' "
    )


_LONGEST_FIRST = sorted(URL_RULES, key=lambda r: -len(r.text))


@query(
    "op7_urls",
    rf"""
WITH parts AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (SELECT *, CASE {"".join(_rule_sql(r) for r in _LONGEST_FIRST)} END AS rule,
    regexp_matches(host, '{BLOCKED_HOSTS}') AS listed FROM parts)
SELECT page_id, host, path, rule, CASE {"".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}' " for r in URL_RULES)}
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM ruled""",
)
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, lambda host: host.rlike(BLOCKED_HOSTS))


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_all(table(spark, sf_dir, "documents"))


@query("op9_tokens")
def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), rule=token_counts.MOST)


@query(
    "op10_mixing",
    rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, 2 * source_size AS most, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
    AS weight FROM sources),
-- Sources reach their limit in the order of limit per weight; the first that doesn't sets the level.
filled AS (SELECT *, row_number() OVER by_limit AS step, coalesce(sum(most) OVER (by_limit ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS taken, sum(weight) OVER (by_limit ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    sum(source_size) OVER () AS total FROM weighed WINDOW by_limit AS (ORDER BY most / weight, source NULLS LAST)),
level AS (SELECT (total * 150 - taken * 100)::BIGINT AS share, (100 * free)::BIGINT AS parts FROM filled
    WHERE most * 100 * free > weight * (total * 150 - taken * 100) ORDER BY step LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN most * parts <= weight * share THEN most::DOUBLE
    ELSE weight::DOUBLE * share::DOUBLE / parts::DOUBLE END AS target FROM weighed LEFT JOIN level ON true),
ranked AS (SELECT doc_id, size, sized.source, source_size, target,
    row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id NULLS FIRST) AS rank,
    CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216.0 + 0.5)::BIGINT ELSE 0 END AS rate,
    ('0x' || substr(md5('42:' || coalesce(sized.source, chr(0))), 1, 6))::BIGINT AS start
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
copied AS (SELECT *, ((rank * rate + start) >> 24) - (((rank - 1) * rate + start) >> 24) AS copies FROM ranked)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source, copies::BIGINT AS copies FROM copied""",
)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, SHARE_PERCENT, MOST_COPIES, SEED)


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    f"'{TERM}')"
)


@query(
    "op11_lexical",
    f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS_SQL} AS t FROM documents),
terms AS (SELECT row, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM docs),
totals AS (SELECT count(*) FILTER (len(t) > 0)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM docs),
postings AS (SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf FROM terms
    GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term, docs),
asked AS (SELECT DISTINCT item_row, item_id, unnest(t) AS term
    FROM (SELECT row_number() OVER () AS item_row, item_id, {_TERMS_SQL} AS t FROM benchmark)),
scored AS (SELECT item_row, item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // totals.terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term), totals GROUP BY item_row, item_id, row, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10""",
)
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_FINITE_SQL = (
    "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
)


def _codes_sql(rounds: int = 4) -> str:
    """Each round as two tables: the nearest entries (distance and index in one number), then the new codebooks."""
    text = f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE {_FINITE_SQL}),
parts AS MATERIALIZED (SELECT row, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, range(4) AS t(p)),
book0 AS MATERIALIZED (SELECT p, row - 1 AS entry, x FROM parts WHERE row <= 256)"""
    for i in range(rounds + 1):
        text += f""",
near{i} AS MATERIALIZED (SELECT row, p, any_value(parts.x) AS x, min((list_dot_product(parts.x, parts.x)
    - 2 * list_dot_product(parts.x, b.x) + list_dot_product(b.x, b.x))::BIGINT * 256 + entry) AS best
    FROM parts JOIN book{i} b USING (p) GROUP BY row, p)"""
        if i < rounds:
            text += f""",
means{i} AS (SELECT p, entry, list(m ORDER BY place) AS x FROM (SELECT p, entry, place, floor(sum(c) / count(*)) AS m
    FROM (SELECT p, best % 256 AS entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM near{i})
    GROUP BY p, entry, place) GROUP BY p, entry),
book{i + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN means{i} m USING (p, entry))"""
    return text + f""",
coded AS (SELECT row, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
    FROM near{rounds} GROUP BY row),
whole AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, entry, place)) AS codebooks_sha256
    FROM (SELECT p, entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM book{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (row), whole"""


@query("op12_codes", _codes_sql())
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)


@query(
    "op13_topk",
    f"""
WITH kept AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE {_FINITE_SQL})
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.row ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id
    NULLS LAST)::INT AS rank, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM kept q JOIN kept c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5""",
)
def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)
