"""The thin queries over the test tables: digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    decontam, extraction, factorisation, langid, licenses, packing, prefixtrie, quality, secrets, sharding, simhash, substrings, turnrepair,
)
from snapmart.llm.common import prepared, table
from snapmart.sources.staging import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@query("op1_simhash")
def op1_simhash(spark, d):
    groups = simhash.near_groups(table(spark, d, "documents"))
    return groups.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_decontaminate", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
q AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM p, (SELECT DISTINCT n FROM win) WHERE i + n - 1 <= len(w)),
m AS (SELECT r, i, q.n, item_id FROM q JOIN win ON q.n = win.n AND q.t = win.t),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM m) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS v FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)""")
def op4_decontaminate(spark, d):
    found = decontam.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_substrings", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
v AS (SELECT r, doc_id, i, array_to_string(w[i : i + 49], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT t, min(doc_id) AS m FROM v GROUP BY t),
x AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS j FROM v JOIN f USING (t) WHERE doc_id > m),
g AS (SELECT r, count(*) AS n FROM x GROUP BY r),
k AS (SELECT u.r, string_agg(u.w[u.j], ' ' ORDER BY u.j) AS kept
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS j FROM d) AS u LEFT JOIN x ON u.r = x.r AND u.j = x.j WHERE x.r IS NULL GROUP BY u.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r) LEFT JOIN k USING (r)""")
def op3_substrings(spark, d):
    return substrings.repeated_passages(table(spark, d, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op10_quality", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i : i + 4], ' ') AS t FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
x AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM g) WHERE c > 1) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, length(regexp_replace(t, '\\P{L}+', '', 'g')) AS n_letters,
  len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09]*[-*\\x{2022}]'))) AS n_bullets,
  len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|\\x{2026})[\\x20\\x09-\\x0D]*$'))) AS n_ellipses
  FROM w LEFT JOIN x USING (r)),
f AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END)
  + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END)
  + (CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_bullets > 9 * n_lines THEN 128 ELSE 0 END)
  + (CASE WHEN 10 * n_ellipses > 3 * n_lines THEN 256 ELSE 0 END) + (CASE WHEN n_words > 1000000 THEN 512 ELSE 0 END) AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, (failed & 3) <> 0 AS base_failed, (failed & 511) = 0 AS kept FROM f""")
def op10_quality(spark, d):
    rows = quality.ledger(table(spark, d, "documents"), ["doc_id"])
    measures = (f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return rows.select(
        "doc_id", *measures, "failed",
        quality.rejected(quality.POLICIES[1]).alias("base_failed"),
        (~quality.rejected(quality.POLICIES[quality.CURRENT])).alias("kept"),
    )


@query("op5_secrets")
def op5_secrets(spark, d):
    found = secrets.secrets(table(spark, d, "documents"), ["doc_id"])
    counts = (secrets.number(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex"))
    return found.select("doc_id", *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query("op6_licenses")
def op6_licenses(spark, d):
    rows = licenses.licenses(table(spark, d, "documents"), ["doc_id"])
    own = licenses.labels(F.col("base"))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base")["start"].cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h["start"])).cast("long").alias("last_word"),
        F.array_join(own, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, licenses.labels(F.col("found")))), ",").alias("labels"),
        licenses.score(F.col("found"), F.col("base")).alias("score"),
    )


@query("op9_language")
def op9_language(spark, d):
    docs = table(spark, d, "documents")
    found = langid.identified(docs, langid.train(docs), ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op2_sharding")
def op2_sharding(spark, d):
    rows = sharding.placed(table(spark, d, "documents"), 40, new_path(spark, "slot-map"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")


@query("op7_packing")
def op7_packing(spark, d):
    return packing.packed(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_extraction")
def op8_extraction(spark, d):
    pages = table(spark, d, "pages")
    found = extraction.extracted(pages, extraction.train(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op11_quality_classifier")
def op11_quality_classifier(spark, d):
    docs, metadata = table(spark, d, "documents"), ["n_chars"]
    model = factorisation.train(docs, table(spark, d, "labels"), metadata=metadata)
    found = factorisation.scored(docs, model, ["doc_id"], metadata=metadata)
    return found.select("doc_id", factorisation.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, d):
    return turnrepair.repaired(turnrepair.damaged(table(spark, d, "conversations")))


@query("op13_prefix_trie")
def op13_prefix_trie(spark, d):
    return prefixtrie.prefix_trie(table(spark, d, "conversations"))
