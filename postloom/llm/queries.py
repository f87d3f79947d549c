"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.packing import packed_documents

    placed = packed_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.html_text import extracted

    return extracted(_table(spark, sf_dir, "pages"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.language import identify

    return identify(_table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.token_files import token_file_round_trip

    back = token_file_round_trip(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 0)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.decontaminate import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("uid")


def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.lm_score import backoff_scores

    return backoff_scores(_table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm import licenses

    return licenses.license_scan(_table(spark, sf_dir, "documents"))[0].drop("uid")


def near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.near_dup import document_classes

    return document_classes(_table(spark, sf_dir, "documents")).drop("uid")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.sharding import shuffled_shards

    return shuffled_shards(_table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm import quality

    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("uid")


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.search import ranked

    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("item")


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.personal import KINDS, personal_data, written

    spans = personal_data(_table(spark, sf_dir, "documents"))[0]
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return spans.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "found")).alias("spans"),
    )


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postloom.llm.periodic import periodic_runs, strongest, with_planted_periods

    found = periodic_runs(with_planted_periods(_table(spark, sf_dir, "documents")))
    best = F.col("best")
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


QUERIES: dict[str, Query] = {
    "op1_decontaminate": decontaminate,
    "op2_html_text": html_text,
    "op3_packing": packing,
    "op4_language": language,
    "op5_token_files": token_files,
    "op6_lm_score": lm_score,
    "op7_license_scan": license_scan,
    "op8_near_dup": near_dup,
    "op9_sharding": sharding,
    "op10_quality": quality,
    "op11_search": search,
    "op12_personal": personal,
    "op13_periodic": periodic,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT uid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
iw AS (SELECT item, item_id, least(len(w), 13) AS k, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM i),
win AS (SELECT DISTINCT item_id, k, g FROM (
  SELECT item_id, k, p, string_agg(word, ' ') OVER v AS g, count(*) OVER v AS n FROM iw WINDOW v AS (PARTITION BY item ORDER BY p ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING)) x WHERE n = k),
grams AS (SELECT uid, p, k, g FROM (
  SELECT uid, p, k, string_agg(word, ' ') OVER v AS g, count(*) OVER v AS n FROM dw, (SELECT DISTINCT k FROM win) ks
  WINDOW v AS (PARTITION BY uid, k ORDER BY p ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING)) x WHERE n = k),
hit AS (SELECT uid, p, g.k, item_id FROM grams g JOIN win ON g.k = win.k AND g.g = win.g),
cov AS (SELECT uid, count(DISTINCT q) AS n_hit FROM (SELECT uid, unnest(generate_series(p, p + k - 1)) AS q FROM hit) x GROUP BY uid),
it AS (SELECT uid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov ON d.uid = cov.uid LEFT JOIN it ON d.uid = it.uid"""


def _template_rows() -> str:
    from postloom.llm.licenses import GRAM, template_words

    rows = []
    for number, label, base, words in template_words():
        n = len(words) - GRAM + 1
        rows += [f"({number}, '{label}', {base}, {n}, {i}, '{' '.join(words[i : i + GRAM])}')" for i in range(n)]
    return ", ".join(rows)


_LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT uid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
g AS (SELECT uid, p, word || ' ' || lead(word, 1) OVER v || ' ' || lead(word, 2) OVER v AS g FROM dw WINDOW v AS (PARTITION BY uid ORDER BY p)),
t(template, label, base, n, at_word, g) AS (VALUES {_template_rows()}),
lines AS (SELECT uid, template, label, base, n, p - at_word AS diagonal, list(DISTINCT at_word) AS seen, min(p) AS first FROM g JOIN t USING (g) GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY uid, template ORDER BY diagonal) > 4 THEN 1 ELSE 0 END AS apart FROM lines WHERE NOT base),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY uid, template ORDER BY diagonal) AS run FROM marked),
merged AS (SELECT uid, label, false AS base, min(first) AS first, len(list_distinct(flatten(list(seen)))) / n AS score, n FROM numbered GROUP BY uid, template, label, n, run),
runs AS (SELECT uid, label, base, first, 1.0 AS score FROM lines WHERE base AND len(seen) = n
  UNION ALL SELECT uid, label, base, first, score FROM merged WHERE score >= CASE WHEN n < 12 THEN 1.0 ELSE 0.8 END),
per AS (SELECT uid, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM runs GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN per ON d.uid = per.uid"""



def _shards() -> str:
    from postloom.llm.sharding import ROUNDS, SEED, SHARDS

    noise = lambda half, i: f"CAST('0x' || substr(md5('{SEED}:{i}:' || CAST({half} AS VARCHAR)), 1, 8) AS BIGINT)"
    steps, left, right = ["x % a AS l0", "x // a AS r0"], "l0", "r0"
    for i in range(ROUNDS):
        if i % 2:
            steps.append(f"({right} + {noise(left, i)}) % b AS r{i + 1}")
            right = f"r{i + 1}"
        else:
            steps.append(f"({left} + {noise(right, i)}) % a AS l{i + 1}")
            left = f"l{i + 1}"
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END)) AS t),
raw AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (SELECT doc_id, CAST(n_bytes + 1 AS BIGINT) AS size, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(n_bytes), lambda j: CAST('0x' || substr(h, 2 * j + 1, 2) AS BIGINT))), lambda c, v: xor(c // 256, t[xor(c, v) % 256 + 1]))) AS text_crc32 FROM raw, crc),
rn AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS i FROM summed),
cells AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(greatest(0, count(*) - 1))) AS BIGINT) + 1 AS a FROM rn) c),
walk AS (SELECT i, i AS x, 0 AS step, n, a, b FROM rn, cells
  UNION ALL SELECT i, {left} + {right} * a, step + 1, n, a, b FROM (SELECT *, {", ".join(steps)} FROM walk WHERE step = 0 OR x >= n) w)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {SHARDS} AS INTEGER) AS shard, CAST(x // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM rn JOIN walk ON rn.i = walk.i WHERE step > 0 AND x < n"""


_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, {_WORDS} AS w FROM benchmark),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM i) x GROUP BY ALL),
tf AS (SELECT uid, doc_id, n, term, count(*) AS tf FROM (SELECT uid, doc_id, len(w) AS n, unnest(w) AS term FROM d) x WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) x, s),
scored AS (SELECT item, item_id, uid, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, uid) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20"""


# The others rest on tokenizers, trained weights or signatures.
ORACLES: dict[str, str] = {
    "op1_decontaminate": _CONTAMINATION,
    "op7_license_scan": _LICENSES,
    "op9_sharding": _shards(),
    "op11_search": _SEARCH,
}
