"""Queries of the operators over their whole tables, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborspark.llm import bpe_codec, chat, jaccard, langid, licenses, manifest, mixing, pii, quality, token_counts, vectors, warc, whitening
from arborspark.session import land, size_by_files

TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """Vocabulary file on the driver; TOKENIZER_DIR overrides the installed folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, TOKENIZER_FILE)
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    size_by_files(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_path()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


_CONTROL = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, '{_CONTROL}' text FROM VALUES (0, 'user'), (1, 'assistant') v(turn, role)")
    messages = land(chat.linear(rows.union(extra)), "messages")
    out = land(chat.format_paths(chat.branches(messages), messages), "formatted")
    turns, loss = chat.read_turns(F.col("formatted")), chat.masked(F.col("formatted"), F.col("loss_spans"))
    out = out.select("tree", "formatted", turns.alias("turns"), loss.alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    return mixing.mix(docs, weights=(1, 2, 3), cap=3).select("doc_id", "size", "source_size", "target", "taken")


def op4_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records against a replica with a layout of its own, in which some records were turned, lengthened or lost."""
    html, kind = F.coalesce("html", F.lit("")), F.length(F.coalesce("html", F.lit(""))) % 97
    turned = F.concat(F.substring(html, 2, 1 << 30), F.substring(html, 1, 1))
    other = F.when(kind == 3, turned).when(kind == 4, F.concat(html, F.lit("?"))).otherwise(html)
    pages = table(spark, sf_dir, "pages")

    def store(rows: DataFrame, body: Column) -> DataFrame:
        whole = warc.record(F.col("url"), body)
        records = rows.select(F.col("page_id").alias("record_id"), F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("digest"))
        return land(warc.lay_out(records).select("record_id", "offset", "digest"), "archive")

    primary, replica = store(pages, html), store(pages.filter(kind != 5), other)
    return warc.audit(primary, replica).select(F.col("record_id").alias("page_id"), "offset", "leaf", "status", "digest_a", "digest_b")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"), width=3, percent=90)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe_codec.encode(docs, tokenizer_path(), decoded="decoded", keep_text=False)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").cast("long").alias("n_fuzzy"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    held = docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out"))
    return langid.identify(held, model).select("doc_id", "held_out", "lang_pred", "score")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = manifest.digests(table(spark, sf_dir, "documents"), "source", "doc_id", fields, [*fields[:4], F.translate("text", _UPPER, _LOWER)], tampered)
    leaves = manifest.number_leaves(rows)
    nodes, root = manifest.build(leaves)
    return manifest.prove(leaves, nodes, root).withColumnRenamed("key", "doc_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened_rows(table(spark, sf_dir, "embeddings"), components=32)
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.scan(docs, pii.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_format": op2_chat_format,
    "op3_mixing": op3_mixing,
    "op4_warc_audit": op4_warc_audit,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_whitening": op12_whitening,
    "op13_pii": op13_pii,
}

ORACLES = {
    "op2_chat_format": r"""
WITH msg AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + 20 AS n FROM msg)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id""",
    "op5_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS tok FROM s),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM t a JOIN t b ON a.tok = b.tok AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM o WHERE 100 * c >= 90 * (n + m - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.y FROM reach r JOIN link l ON l.x = r.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s""",
    "op9_embedding_dedup": r"""
WITH RECURSIVE ok AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM link l WHERE l.a = e.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id GROUP BY e.vec_id""",
    "op4_warc_audit": r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, length(coalesce(html, '')) % 97 AS k FROM pages),
o AS (SELECT *, CASE k WHEN 3 THEN substr(html, 2) || substr(html, 1, 1) WHEN 4 THEN html || '?' ELSE html END AS other FROM p),
r AS (SELECT page_id, k,
  'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS a,
  'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(other) || chr(13) || chr(10) || chr(13) || chr(10) || other || chr(13) || chr(10) || chr(13) || chr(10) AS b FROM o),
l AS (SELECT page_id, sha256(a) AS digest_a, CASE WHEN k <> 5 THEN sha256(b) END AS digest_b,
  CAST(sum(strlen(a)) OVER (ORDER BY page_id, sha256(a)) - strlen(a) AS BIGINT) AS "offset" FROM r)
SELECT page_id, "offset", "offset" // 65536 AS leaf, CASE WHEN digest_b IS NULL THEN 'missing' ELSE 'changed' END AS status, digest_a, digest_b
FROM l WHERE digest_b IS NULL OR digest_a <> digest_b""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE part AS (SELECT doc_id, source, text, unnest([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]) AS v, unnest(range(5)) AS k, row_number() OVER () AS r FROM documents),
said AS (SELECT r, doc_id, source, k, coalesce(strlen(v) || ':' || v, '-') AS said,
  CASE WHEN k = 4 THEN coalesce(strlen(v) || ':' || translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') ELSE coalesce(strlen(v) || ':' || v, '-') END AS low FROM part),
leaf AS (SELECT doc_id, source, sha256(string_agg(said, '' ORDER BY k)) AS leaf, sha256(string_agg(low, '' ORDER BY k)) AS low FROM said GROUP BY r, doc_id, source),
crc AS (SELECT *, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))) % 5 = 0 AS bad FROM leaf),
numbered AS MATERIALIZED (SELECT *, CASE WHEN bad THEN low ELSE leaf END AS shown, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM crc),
node(src, level, idx, n, digest) AS (SELECT src, 0, pos, n, leaf FROM numbered
  UNION ALL SELECT src, any_value(level) + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY src, idx // 16),
subs AS MATERIALIZED (SELECT src, digest, max(src) OVER () + 1 AS n FROM node WHERE n = 1),
top(level, idx, n, digest) AS (SELECT 0, src, n, digest FROM subs
  UNION ALL SELECT any_value(level) + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY idx // 16),
whole AS MATERIALIZED (SELECT src, level, idx, n, digest FROM node UNION ALL SELECT -1, level, idx, n, digest FROM top),
step(src, level, child, before, behind) AS MATERIALIZED (SELECT src, level, idx,
  coalesce(string_agg(digest, '') OVER (PARTITION BY src, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
  coalesce(string_agg(digest, '') OVER (PARTITION BY src, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') FROM whole WHERE n > 1),
path(r, tree, home, level, idx, proof, digest, ended) AS (SELECT row_number() OVER (ORDER BY src, pos), src, src, 0, pos, '', shown, false FROM numbered
  UNION ALL SELECT p.r, CASE WHEN s.src IS NULL THEN -1 ELSE p.tree END, p.home, CASE WHEN s.src IS NULL THEN 0 ELSE p.level + 1 END, CASE WHEN s.src IS NULL THEN p.home ELSE p.idx // 16 END,
    p.proof || coalesce(s.before || s.behind, ''), CASE WHEN s.src IS NULL THEN p.digest ELSE sha256(s.before || p.digest || s.behind) END, s.src IS NULL AND p.tree = -1
  FROM path p LEFT JOIN step s ON s.src = p.tree AND s.level = p.level AND s.child = p.idx WHERE NOT p.ended),
root AS (SELECT digest FROM top WHERE n = 1)
SELECT n.doc_id, n.leaf, s.digest AS subroot, (SELECT digest FROM root) AS root, sha256(p.proof) AS proof_sha256, p.digest AS folded_root, p.digest = (SELECT digest FROM root) AS verified
FROM (SELECT *, row_number() OVER (ORDER BY src, pos) AS r FROM numbered) n JOIN path p ON p.r = n.r AND p.ended JOIN subs s ON s.src = n.src""",
}
