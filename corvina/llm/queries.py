"""One query per operator over its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, fim, licenses, linededup, minhash, packing, pii, quality, repair, sharding, toxicity, warc
from .common import scratch, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.line_dedup(docs).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.joined_labels(licenses.license_scan(docs))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it leaks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks), ranks))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.personal_data(docs))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_dedup(docs, size=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law of these shards is rows: counts are at most one apart."""
    docs = table(spark, sf_dir, "documents")
    whole = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "source", (F.octet_length(whole) + 8).cast("long").alias("size"), F.crc32(whole).cast("long").alias("text_crc32"))
    placed = sharding.interleave(sized, shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "doc_id", "text", toxicity.SAMPLE, toxicity.SAMPLE_CHARS)
    scored = toxicity.toxicity(docs, toxicity.train(sample))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality(docs).select(*columns)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives to the shared folder, reads them back, and removes them."""
    folder = warc.shared_folder(spark)
    written = warc.write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    read = scratch(warc.read_warc(written, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    warc.remove_folder(spark, folder)
    return read


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dealt damage, then the repair of every conversation; digests of the repaired turns."""
    return repair.digests(repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.digests(fim.fill_in_middle(docs))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS at,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
totals AS (SELECT source, count(DISTINCT coalesce(text, '')) AS total FROM documents GROUP BY source),
bad AS (
  SELECT k.source, k.k FROM keyed k JOIN totals t ON k.source IS NOT DISTINCT FROM t.source
  WHERE k.k <> '' GROUP BY k.source, k.k
  HAVING count(DISTINCT k.text) >= 5 AND count(DISTINCT k.text) > 0.02 * any_value(t.total))
SELECT k.doc_id, k.source,
       coalesce(string_agg(k.line, chr(10) ORDER BY k.at) FILTER (WHERE b.k IS NULL), '') AS text,
       count(*) AS n_lines, count(b.k) AS n_dropped
FROM keyed k LEFT JOIN bad b ON k.source IS NOT DISTINCT FROM b.source AND k.k = b.k
GROUP BY k.doc_id, k.source
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS s FROM (
    SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sets AS (SELECT doc_id, list(s ORDER BY s) AS all_s FROM s GROUP BY doc_id),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY all_s) AS rep FROM sets),
alike AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM (SELECT s.* FROM s JOIN rep USING (doc_id) WHERE doc_id = rep) a
  JOIN (SELECT s.* FROM s JOIN rep USING (doc_id) WHERE doc_id = rep) b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
e AS (SELECT x, y FROM alike UNION SELECT y, x FROM alike
      UNION SELECT doc_id, rep FROM rep UNION SELECT rep, doc_id FROM rep),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

_PASSES = (
    f"length(bare) = 0 OR (regexp_matches(line, '[{quality.STOPS}][\\x20\\x09\\x0B\\x0C\\x0D\"''”’»)\\]]*$') AND noise * 10 <= length(bare) "
    "AND NOT (marks >= 3 AND marks * 40 >= length(bare)) AND NOT ("
    + " OR ".join(f"contains(lower(line), '{p}')" for p in quality.BOILERPLATE)
    + "))"
)

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (
  SELECT doc_id, i, ws[i : i + 2] AS three FROM (
    SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) > 2)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS c FROM tri) WHERE c > 1),
rep AS (
  SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, generate_subscripts(string_split(t, chr(10)), 1) AS pos, unnest(string_split(t, chr(10))) AS line FROM d),
marked AS (
  SELECT doc_id, pos, line, translate(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS bare,
         length(line) - length(translate(line, '{quality.NOISE}', '')) AS noise,
         length(line) - length(translate(line, '{quality.SEPARATORS}', '')) AS marks FROM lines),
l AS (
  SELECT doc_id, count(*) FILTER (WHERE bare <> '') - count(DISTINCT line) FILTER (WHERE bare <> '') AS n_dup,
         coalesce(sum(length(bare)) FILTER (WHERE {_PASSES}), 0) AS left_chars FROM marked GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(w.ws) AS n_words, coalesce(list_sum(list_transform(w.ws, lambda x: length(x))), 0) AS word_chars,
         length(w.t) - length(translate(w.t, '{quality.SYMBOLS}', '')) AS n_symbols, l.n_dup AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, l.left_chars
  FROM w JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND left_chars >= 0.5 * word_chars AS kept
FROM b
"""

OP10_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS b, sha256(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, b::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN b >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN b >= 100 AND page_id <> f THEN f END AS refers_to
FROM m
"""

#: The table of the CRC-32 of octets, made by its polynomial.
_CRC = [reduce(lambda c, _: c >> 1 ^ (0xEDB88320 if c & 1 else 0), range(8), i) for i in range(256)]

OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                         lambda c, b: xor(c >> 8, ({_CRC}::BIGINT[])[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM documents),
k AS (SELECT *, md5(concat_ws('|', '42', coalesce(doc_id::VARCHAR, ''), coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), size::VARCHAR, text_crc32::VARCHAR)) AS h FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h) - 1 AS rank, count(*) OVER (PARTITION BY source) AS total FROM k),
p AS (SELECT *, row_number() OVER (ORDER BY (rank * 2 + 1) / (total * 2), source NULLS FIRST, rank) - 1 AS place, count(*) OVER () AS n FROM r),
s AS (SELECT *, place * 24 // n AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
       (place - (shard * n + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
             list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS hs FROM d),
c AS (SELECT *, least(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS a, greatest(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) AS b,
             CASE WHEN t = '' OR hs[3] % 100 >= 50 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(us[1 : a], ''), '') AS pre, coalesce(array_to_string(us[a + 1 : b], ''), '') AS mid,
             coalesce(array_to_string(us[b + 1 :], ''), '') AS suf FROM c)
SELECT doc_id, len(us)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

OP11_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda x: ('0x' || x)::BIGINT),
                         lambda c, b: xor(c >> 8, ({_CRC}::BIGINT[])[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) % 20 AS how
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE how WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE how <> 0),
seen AS (
  SELECT *, sha256(role || chr(0) || text) AS h,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept FROM damaged),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, h, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, h ORDER BY turn NULLS FIRST, copy) AS again FROM seen),
f AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS first, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN kept = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM r),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before || first NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id),
every AS (
  SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
         coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id),
-- Every state is a struct of cost, edits and repaired turns after i rows, with turns inserted before the next row.
steps AS (
  SELECT conv_id, 0 AS i, 'b' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS told FROM every
  UNION ALL
  SELECT conv_id, i, state, cost, audit, told FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS best FROM (
      SELECT s.conv_id, f.i, m.m['to'] AS state, s.cost + m.m['cost'] AS cost, s.audit || m.m['edit'] AS audit, s.told || m.m['told'] AS told
      FROM (
        SELECT conv_id, i, x.s AS state, cost + x.c AS cost, audit || x.e AS audit, told || x.t AS told FROM (
          SELECT *, unnest([{{'s': state, 'c': 0, 'e': '', 't': []::VARCHAR[]}},
            {{'s': CASE state WHEN 'u' THEN 'a' ELSE 'u' END, 'c': 2, 'e': 'I', 't': CASE state WHEN 'u' THEN ['assistant:'] ELSE ['user:'] END}},
            {{'s': CASE state WHEN 'u' THEN 'u' ELSE 'a' END, 'c': 4, 'e': 'II', 't': CASE state WHEN 'u' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END}}]) AS x FROM steps)) s
      JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1,
      unnest([{{'to': s.state, 'cost': 3, 'edit': 'D', 'told': []::VARCHAR[]}},
        {{'to': CASE WHEN f.fault IN ('blank', 'duplicate') THEN NULL WHEN f.first = 's' AND s.state = 'b' THEN 's' WHEN f.first = 'u' AND s.state <> 'u' THEN 'u'
                     WHEN f.first = 'a' AND s.state = 'u' THEN 'a' END,
          'cost': CASE f.fault WHEN 'truncated' THEN 1 ELSE 0 END, 'edit': 'K', 'told': [f.role || ':' || f.text]}},
        {{'to': CASE WHEN f.fault IN ('blank', 'duplicate') THEN NULL WHEN s.state = 'u' THEN 'a' ELSE 'u' END,
          'cost': CASE f.fault WHEN 'truncated' THEN 3 ELSE 2 END, 'edit': 'R',
          'told': [CASE s.state WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || f.text]}}]) AS m(m)
      WHERE m.m['to'] IS NOT NULL)) WHERE best = 1),
ends AS (
  SELECT e.*, s.cost + CASE s.state WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END AS cost,
         s.audit || CASE s.state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
         s.told || CASE s.state WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE []::VARCHAR[] END AS told
  FROM every e JOIN steps s ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = e.n)
SELECT conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, cost::BIGINT AS cost, audit,
       sha256(coalesce(array_to_string(told, chr(10)), '')) AS repaired_sha256
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM ends) WHERE best = 1
"""

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_pii": op5_pii,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op6_minhash_near_dedup": OP6_SQL,
    "op7_sharding": OP7_SQL,
    "op9_quality_rules": OP9_SQL,
    "op10_warc": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
