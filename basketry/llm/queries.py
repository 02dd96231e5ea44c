"""Registered queries of the operators and, where SQL can express them, their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.conversation_sql import REPAIR, TRIE
from basketry.llm.forest import near_vectors
from basketry.llm.jaccard import jaccard_components
from basketry.llm.lines import drop_common_lines
from basketry.llm.mixing import mix_sources
from basketry.llm.multi_index import nearest_vectors
from basketry.llm.pitman_yor import score_documents
from basketry.llm.prefix_trie import prefix_trie
from basketry.llm.redirects import filter_pages
from basketry.llm.repair import repair_conversations
from basketry.llm.secrets import kind_count, scan_secrets, span_text
from basketry.llm.surrogates import replace_private
from basketry.llm.templates import find_contamination
from basketry.llm.turns import joined_digests
from basketry.llm.weak_labels import score_quality

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed rules of the URL query: host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_private(docs, "query key").select("doc_id", "text", "n_private")


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents").select("doc_id", "text"))


def op3_vector_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return find_contamination(docs, table(spark, folder, "benchmark"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        kind_count("base", "assign").alias("n_assign"),
        kind_count("base", "access").alias("n_access"),
        kind_count("base", "hex").alias("n_hex"),
        F.sha2(span_text("base"), 256).alias("base_sha256"),
        span_text("all_spans").alias("spans"),
        kind_count("all_spans", "random").alias("n_random"),
    )


def op6_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_common_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return score_quality(docs, labels).select("doc_id", "quality_score", "kept")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, rule_verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return filter_pages(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def damaged(turns: DataFrame) -> DataFrame:
    """The faults that the repair query plants, by ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its
    text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets the role user. Null columns are one space."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    return (
        turns.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0")
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(or_space("role")).alias("role"), text.alias("text"))
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair_conversations(damaged(turns))
    parts = repaired.withColumns({"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), "part": F.concat("role", F.lit(":"), "text")})
    digests = joined_digests(parts, ["conv"], ["cut", "k"], "part", "\n", "repaired_sha256")
    every = turns.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        every.join(report.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).drop("conv_id"), "conv", "left")
        .join(digests, "conv", "left")
        .select(
            "conv_id", *[F.when(F.col("audit").isNotNull(), F.col(c)).otherwise(0).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def op12_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Query] = {
    "op1_surrogates": op1_surrogates,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_vector_forest": op3_vector_forest,
    "op4_decontaminate": op4_decontaminate,
    "op5_secret_scan": op5_secret_scan,
    "op6_pitman_yor": op6_pitman_yor,
    "op7_line_dedup": op7_line_dedup,
    "op8_weak_label_quality": op8_weak_label_quality,
    "op9_url_filter": op9_url_filter,
    "op10_mix_sources": op10_mix_sources,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_multi_index": op12_multi_index,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Made in SQL by other means: dynamic programming row by row, and sums over the ancestors of every node.
_CONVERSATIONS = {"op11_conversation_repair": REPAIR, "op13_prefix_trie": TRIE}

_WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = _CONVERSATIONS | {
    "op2_ngram_jaccard": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM words
), grams AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT node, b FROM reach JOIN both_ways ON seen = a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) ON doc_id = node""",
    "op3_vector_forest": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.95
), reach(node, seen) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT node, b FROM reach JOIN links ON seen = a
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) ON v.vec_id = node
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON v.vec_id = a""",
    "op7_line_dedup": r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op9_url_filter": r"""
WITH cut AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS place
  FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), ruled AS (
  SELECT cut.*, rule, v FROM cut LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (page_id)
), alias AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(
         regexp_extract(url, '(?s)^.*?://(.*)$', 1)), '(?s)#.*$', ''),
         '([?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*(?:&|$)', '\1', 'g'), '([?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*(?:&|$)', '\1', 'g'), '[?&]$', ''), '^www\.', '') AS place
  FROM ruled
), decided AS (
  SELECT place FROM alias WHERE v IS NOT NULL GROUP BY place HAVING NOT bool_or(v = 'allow')
)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN decided.place IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM alias LEFT JOIN decided USING (place)""",
    "op10_mix_sources": rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, 3 * source_size AS room, (3 * source_size) / CAST(weight AS DOUBLE) AS ratio FROM sources
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(room) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS own
  FROM ratios
), placed AS (
  SELECT *, CASE WHEN own <= ratio THEN row_number() OVER (ORDER BY ratio, source NULLS LAST) END AS place FROM levels
), leveled AS (
  SELECT *, arg_min(own, place) OVER () AS level FROM placed
), budgets AS (
  SELECT source, source_size,
         coalesce(CASE WHEN ratio <= level THEN CAST(room AS DOUBLE) ELSE level * weight END, 0.0) AS target
  FROM leveled
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM budgets
), rested AS (
  SELECT *, CAST(round(target) AS BIGINT) - epochs * source_size AS rest FROM parts
), running AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM running JOIN rested ON running.source IS NOT DISTINCT FROM rested.source""",
}
