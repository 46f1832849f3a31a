"""Queries on text functions, mentions, sources and streams over the driver's tables, each with its SQL.

Sentences are made from a part's columns, in the same way on both sides.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from ..functions import spans, text, vocab
from ..operators import aliases, edges, gates, images, mentions, relations, scoring, vectors
from ..sources import files
from ..streaming import incremental
from ..storage import shared_folder, spread
from . import tracks
from .figure_queries import _case, _case_sql, _topology_sql
from .registry import query, table

#: Parts that a task reads where much is made of each, and where each becomes a picture.
PARTS, PICTURES = 20_000, 5_000


def _key():
    return F.col("p_partkey").cast("string")


def _told(column: str, values: dict[str, str | None]) -> str:
    """SQL for what is expected of a list of texts, by the same remainder."""
    return _case_sql(column, list(values.values()))


# Scalar functions.

# Texts are whole documents, each with terms of a vocabulary spliced into it, so that something is found; the SQL looks for the same terms in the same texts.


def _spliced(*vocabularies):
    """What makes the column of a document's text with a term of each vocabulary, by its id, in the middle and at the end, and SQL that does."""

    def column():
        whole = F.coalesce("text", F.lit(""))
        half = F.floor(F.length(whole) / 2).cast("int")
        out = F.concat(F.substr(whole, F.lit(1), half), F.lit("\n{0} "), F.substr(whole, half + 1), F.lit(" {1}."))
        for i, terms in enumerate(vocabularies):
            some = F.get(F.array(*map(F.lit, terms)), (F.col("doc_id") % (len(terms) + i)).cast("int"))
            out = F.replace(out, F.lit(f"{{{i}}}"), F.coalesce(some, F.lit("of none")))
        return out

    sql = "coalesce(text, '')"
    sql = f"substr({sql}, 1, length({sql}) // 2) || chr(10) || '{{0}} ' || substr({sql}, length({sql}) // 2 + 1) || ' {{1}}.'"
    for i, terms in enumerate(vocabularies):
        listed = ", ".join("'" + t.replace("'", "''") + "'" for t in terms)
        sql = f"replace({sql}, '{{{i}}}', coalesce(([{listed}])[1 + doc_id % {len(terms) + i}], 'of none'))"
    return column, sql


_LOW = r"trim(regexp_replace(lower({x}), '[\s\x0B\x{{A0}}\x{{85}}]+', ' ', 'g'))"
_NOT_WORD = r"[^\p{L}\p{N}_]"


def _first_term(low, terms, bound=False):
    """SQL for the label of the first of (term, label) that a text has."""
    has = (lambda t: f"regexp_matches({low}, '(^|{_NOT_WORD}){re.escape(t)}($|{_NOT_WORD})')") if bound else (lambda t: f"contains({low}, '{t}')")
    return "CASE " + " ".join(f"WHEN {has(t)} THEN '{label}'" for t, label in terms) + " END"


_SPAN, _SPAN_SQL = _spliced(("(glcm", '"`entropy', "[a , b"), ("c)", 'x"', "y ];:"))


@query(rf"""
WITH d AS (SELECT doc_id, {_SPAN_SQL} AS t FROM documents),
a AS (SELECT doc_id, t, regexp_replace(trim(regexp_replace(t, '[\s\x0B\x{{A0}}\x{{85}}]+', ' ', 'g')), '^["''`\[\]{{}}()]+|["''`\[\]{{}}()]+$', '', 'g') AS s FROM d)
SELECT doc_id, md5(trim(regexp_replace(s, '^[ ,;:.]+|[ ,;:.]+$', '', 'g'))) AS span, md5({_LOW.format(x='t')}) AS low FROM a""")
def t2_normalized(spark, d):
    docs = table(spark, d, "documents").select("doc_id", _SPAN().alias("t"))
    return docs.select("doc_id", F.md5(spans.normalize_span(F.col("t"))).alias("span"), F.md5(text.normalize(F.col("t"))).alias("low"))


_ILL, _ILL_SQL = _spliced(("Severe liver fibrosis", "patients in training reduces liver disease", "lung cancer", "Dysbiosis drives colorectal cancer", "no name"), ("It is a disease", "type 2 diabetes", "colorectal adenoma"))
#: Letters beyond ASCII; a word's border is beside them in one engine and not in the other, so the SQL takes them for an underscore.
_LETTERS = r"[\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2C1}\x{370}-\x{1FFF}\x{3040}-\x{D7FF}]"
_STOPS = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(rf"""
WITH d AS (SELECT doc_id, {_ILL_SQL} AS t FROM documents),
f AS (SELECT doc_id, list_transform(regexp_extract_all(regexp_replace(t, '{_LETTERS}', '_', 'g'), '{vocab.DISEASE}', 1), lambda x: string_split({_LOW.format(x='x')}, ' ')) AS xs FROM d)
SELECT doc_id, array_to_string(list_filter(xs, lambda w: NOT list_contains({_STOPS(vocab.DISEASE_LEAD_STOPWORDS)}, w[1])
  AND NOT (len(w) > 3 AND list_has_any(w[:-2], {_STOPS(vocab.DISEASE_CONTEXT_STOPWORDS)})))[1], ' ') AS disease FROM f""")
def t14_disease(spark, d):
    return table(spark, d, "documents").select("doc_id", text.disease(_ILL(), F.lit("")).alias("disease"))


_HINT, _HINT_SQL = _spliced([t for _, terms in vocab.CLAIM_HINTS for t in terms][::2], [t for _, terms in vocab.CLAIM_HINTS for t in terms][1::2])


@query(f"""
WITH d AS (SELECT doc_id, {_LOW.format(x=_HINT_SQL)} AS low FROM documents)
SELECT doc_id, {_first_term('low', [(t, hint) for hint, terms in vocab.CLAIM_HINTS for t in terms])} AS hint FROM d""")
def t15_claim_hint(spark, d):
    return table(spark, d, "documents").select("doc_id", text.claim_hint(_HINT(), F.lit(None)).alias("hint"))


_STATED, _STATED_SQL = _spliced([f"MATCH (n) {c.lower()}" for c in vocab.WRITE_CLAUSES], ["RETURN n", "SET n.x = 1", "CALL db.labels()", "call {x}"])


@query(f"""
WITH d AS (SELECT doc_id, upper({_STATED_SQL}) AS t FROM documents)
SELECT doc_id, CASE {' '.join(f"WHEN contains(t, '{c}') THEN '{c.strip()}'" for c in vocab.WRITE_CLAUSES)} END AS clause FROM d""")
def f10_read_only(spark, d):
    """The writing clause of each statement, a document's text with clauses in it."""
    return table(spark, d, "documents").select("doc_id", text.writes(_STATED()).alias("clause"))


_CAPTION, _CAPTION_SQL = _spliced([w for words in vocab.TOPOLOGY_KEYWORDS.values() for w in words], [w for words in vocab.TOPOLOGY_KEYWORDS.values() for w in words][::3])


@query(f"""
WITH c AS (SELECT doc_id, {_LOW.format(x=_CAPTION_SQL)} AS caption FROM documents), t AS (SELECT doc_id, {_topology_sql('caption')} AS topology FROM c)
SELECT doc_id, topology FROM t WHERE topology IN ('heatmap', 'forest_plot')""")
def f6_topology_filter(spark, d):
    """Figures of two topologies; captions are whole documents with keywords in them."""
    figures = table(spark, d, "documents").select(F.col("doc_id").alias("figure_id"), _CAPTION().alias("caption"))
    none = spark.createDataFrame([], "proposal_id string, figure_id bigint, candidate_r double")
    return tracks.figure_track(figures, none, ("heatmap", "forest_plot"))["figures"].select(F.col("figure_id").alias("doc_id"), "topology")


SUBJECTS = {
    "Fusobacterium nucleatum rose": ("Microbe", "fusobacterium nucleatum"),
    "more roseburia than prevotella": ("Microbe", "prevotella"),
    "Prevotella syndrome and alpha diversity": ("Microbe", "prevotella"),
    "gut microbiota composition differs": ("MicrobialSignature", "gut microbiota composition"),
    "Homo sapiens only": (None, None),
}


@query(
    f"SELECT p_partkey, {_case_sql('p_partkey', [k for k, _ in SUBJECTS.values()])} AS type, {_case_sql('p_partkey', [n for _, n in SUBJECTS.values()])} AS name, "
    f"coalesce({_case_sql('p_partkey', [k for k, _ in SUBJECTS.values()])}, 'Microbe') AS type2, coalesce({_case_sql('p_partkey', [n for _, n in SUBJECTS.values()])}, 'homo sapiens only') AS name2 FROM part"
)
def t16_subject(spark, d):
    s = _case("p_partkey", list(SUBJECTS))
    p = table(spark, d, "part").select("p_partkey", text.subject(s).alias("a"), text.subject(s, fallback=True).alias("b"))
    return p.select("p_partkey", "a.type", "a.name", F.col("b.type").alias("type2"), F.col("b.name").alias("name2"))


_NAMES = (*vocab.BODYCOMP_CANONICAL, *vocab.RADIOMIC_CANONICAL)
_FEATURES_SQL = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"


@query(f"""
WITH w AS (SELECT doc_id, unnest(list_distinct(string_split({_LOW.format(x="coalesce(text, '')")}, ' '))) AS w FROM documents),
f AS (SELECT DISTINCT w, CASE WHEN crc % 3 = 0 THEN ({_FEATURES_SQL})[1 + crc % {len(_NAMES)}] ELSE w END AS f
      FROM (SELECT w, max(length(w)) * 7 + min(doc_id) AS crc FROM w GROUP BY w)),
b AS (SELECT w, f, list_contains({_STOPS(vocab.BODYCOMP_CANONICAL)}, f) AS body FROM f)
SELECT w, CASE WHEN body THEN 'body_composition' ELSE 'radiomic' END AS family, CASE WHEN body THEN 'BodyCompositionFeature' ELSE 'RadiomicFeature' END AS node_type FROM b""")
def t17_feature_family(spark, d):
    """The words of all documents, a third of them taken for the names of features."""
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split(text.normalize(F.col("text")), " ")).alias("w"))
    one = words.groupBy("w").agg((F.max(F.length("w")) * 7 + F.min("doc_id")).alias("n"))
    f = F.when(F.col("n") % 3 == 0, F.get(F.array(*map(F.lit, _NAMES)), (F.col("n") % len(_NAMES)).cast("int"))).otherwise(F.col("w"))
    name = F.initcap(F.concat(F.lit("  "), f))
    return one.select("w", text.feature_family(name).alias("family"), text.feature_node_type(name).alias("node_type"))


_ANSWER_SQL = "concat(([' (A) ', 'b', '\"C.\" ', 'positive', ' Clearly NEGATIVE', '[d]'])[1 + (conv_id * 5 + turn) % 13], ' ', coalesce(text, ''), ([' positive', ' negative'])[1 + turn % 5])"


@query(rf"""
WITH a AS (SELECT conv_id, turn, lower(trim({_ANSWER_SQL})) AS low FROM conversations),
f AS (SELECT conv_id, turn, low, regexp_replace(regexp_extract(low, '^(\S+)', 1), '^[()\[\]{{}}:;,."'']+|[()\[\]{{}}:;,."'']+$', '', 'g') AS first FROM a)
SELECT conv_id, turn, CASE WHEN first = 'a' THEN 'positive' WHEN first = 'b' THEN 'negative' WHEN first IN ('c', 'd') THEN 'unrelated'
  WHEN contains(low, 'positive') THEN 'positive' WHEN contains(low, 'negative') THEN 'negative' ELSE 'unrelated' END AS label FROM f""")
def t23_relation_label(spark, d):
    """What all turns say, some of them begun or ended as a model's answers are."""
    begin = F.get(F.array(*map(F.lit, (" (A) ", "b", '"C." ', "positive", " Clearly NEGATIVE", "[d]"))), ((F.col("conv_id") * 5 + F.col("turn")) % 13).cast("int"))
    end = F.get(F.array(F.lit(" positive"), F.lit(" negative")), (F.col("turn") % 5).cast("int"))
    none = lambda c: F.coalesce(c, F.lit(""))
    return table(spark, d, "conversations").select("conv_id", "turn", text.relation_label(F.concat(none(begin), F.lit(" "), none(F.col("text")), none(end))).alias("label"))


@query("SELECT conv_id, turn, round(0.45 + 0.4 * (turn % 7) / 6, 3)::DOUBLE AS temperature FROM conversations")
def t25_temperatures(spark, d):
    """The temperature of each turn, if turns are the samples of a conversation."""
    each = F.array(*map(F.lit, text.temperatures()))
    return table(spark, d, "conversations").select("conv_id", "turn", F.get(each, (F.col("turn") % 7).cast("int")).alias("temperature"))


_PLACED, _PLACED_SQL = _spliced(vocab.BODY_LOCATIONS, [t for t, _ in vocab.MODALITIES])


@query(f"""
WITH d AS (SELECT doc_id, {_LOW.format(x=_PLACED_SQL)} AS low FROM documents)
SELECT doc_id, {_first_term('low', [(t, t) for t in vocab.BODY_LOCATIONS], bound=True)} AS place, {_first_term('low', vocab.MODALITIES)} AS modality FROM d""")
def t13_places(spark, d):
    return table(spark, d, "documents").select("doc_id", text.body_location(_PLACED()).alias("place"), text.modality(_PLACED()).alias("modality"))


@query("SELECT p_partkey, p_size % 2 = 0 AND p_size >= 30 AS supported FROM part")
def f2_supported(spark, d):
    e = F.when(F.col("p_size") % 2 == 0, "told").otherwise(" ")
    return table(spark, d, "part").select("p_partkey", spans.mention_supported(F.col("p_size") / 50, F.col("p_type"), e).alias("supported"))


PAIRS = [("Roseburia levels", "obesity patients", "", "roseburia", "obesity"), ("bacteria", "obesity", "generic_microbe_term", None, None),
    ("Roseburia", "disease", "generic_disease_term", None, None)]


@query(f"""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'missing_sentence' WHEN p_size % 4 = 1 THEN 'evidence_too_long_words'
    ELSE nullif({_case_sql('p_partkey', [x[2] for x in PAIRS])}, '') END AS reason,
       CASE WHEN p_size % 4 > 1 THEN {_case_sql('p_partkey', [x[3] for x in PAIRS])} END AS subject, CASE WHEN p_size % 4 > 1
           THEN {_case_sql('p_partkey', [x[4] for x in PAIRS])} END AS disease
         FROM part""")
def t7_clean_pair(spark, d):
    s = F.when(F.col("p_size") % 4 == 0, " ").when(F.col("p_size") % 4 == 1, F.repeat(F.lit("word "), 12)).otherwise("a sentence")
    c = spans.clean_pair(s, _case("p_partkey", [x[0] for x in PAIRS]), _case("p_partkey", [x[1] for x in PAIRS]), max_words=12, max_chars=100)
    return table(spark, d, "part").select("p_partkey", c.alias("c")).select("p_partkey", "c.reason", "c.subject", "c.disease")


# Mentions.

MENTIONS = {
    "GLCM entropy and the skeletal muscle index differ.": [(0, 12, "glcm_entropy", "exact"), (21, 42, "skeletal_muscle_index", "exact")],
    "Haralick entropi of the texture.": [(0, 16, "glcm_entropy", "fuzzy")],
    "The mean age was high.": [],
    "VAT on CT.": [(0, 3, "visceral_adipose_tissue", "exact")],
}
_HITS = ", ".join(f"({i}, {a}, {b}, '{c}', '{m}')" for i, x in enumerate(MENTIONS.values()) for a, b, c, m in x)


@query(f'SELECT p_partkey, t.s AS start, t.e AS "end", t.c AS canonical, t.m AS method FROM part JOIN (VALUES {_HITS}) t(i, s, e, c, m) ON p_partkey % {len(MENTIONS)} = t.i')
def t9_alias_matches(spark, d):
    s = _case("p_partkey", list(MENTIONS))
    found = spread(table(spark, d, "part").select("p_partkey"), PARTS).select("p_partkey", F.inline(aliases.alias_matches(text.normalize(s))))
    return found.select("p_partkey", "start", "end", "canonical", "method")


_WORD = r"[\p{L}\p{N}_]+"
_NORMAL = r"string_split(trim(regexp_replace(lower(coalesce({c}, '')), '[\s\x0B\x{{A0}}\x{{85}}]+', ' ', 'g')), ' ')"


@query(rf"""
WITH b AS (SELECT ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM (SELECT {_NORMAL.format(c='text')} AS ws FROM benchmark)),
aliases AS (
  SELECT DISTINCT ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS alias FROM b
  WHERE ws[i] <> ws[i + 1] AND ws[i] <> ws[i + 2] AND regexp_full_match(ws[i], '{_WORD}') AND regexp_full_match(ws[i + 1], '{_WORD}') AND regexp_full_match(ws[i + 2], '{_WORD}')
  UNION SELECT array_to_string({_NORMAL.format(c='p_name')}, ' ') FROM part),
d AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM (SELECT doc_id, {_NORMAL.format(c='text')} AS ws FROM documents)),
w AS (SELECT doc_id, regexp_extract(ws[i], '({_WORD})$', 1) AS a, ws[i + 1] AS b, regexp_extract(ws[i + 1], '^({_WORD})', 1) AS last, regexp_extract(coalesce(ws[i + 2], ''), '^({_WORD})', 1) AS c FROM d),
found AS (
  SELECT doc_id, a || ' ' || last AS alias FROM w WHERE a <> '' AND last <> ''
  UNION ALL SELECT doc_id, a || ' ' || b || ' ' || c FROM w WHERE a <> '' AND b = last AND c <> '')
SELECT doc_id, alias, count(*) AS n FROM found JOIN aliases USING (alias) GROUP BY ALL""")
def t9_alias_vocabulary(spark, d):
    """How often whole documents have each of thousands of aliases: three words of a benchmark item, and the names of parts."""
    words = table(spark, d, "benchmark").select(F.split(text.normalize(F.col("text")), " ").alias("w"))
    three = words.select(F.explode(F.expr("transform(sequence(1, greatest(size(w) - 2, 1)), i -> struct(get(w, i - 1) AS a, get(w, i) AS b, get(w, i + 1) AS c))")).alias("x")).select("x.*")
    three = three.where("a <> b AND a <> c").where(F.concat("a", "b", "c").rlike(f"^{_WORD}$")).select(F.concat_ws(" ", "a", "b", "c").alias("alias"))
    names = aliases.vocabulary(three.unionByName(table(spark, d, "part").select(text.normalize(F.col("p_name")).alias("alias"))), "alias")
    found = table(spark, d, "documents").select("doc_id", F.inline(aliases.alias_counts(text.normalize(F.col("text")), names)))
    return found.select("doc_id", "alias", "n")


@query(f"""
SELECT p_partkey::VARCHAR AS pmid, t.i // 10 AS sentence_index, t.c AS canonical_feature, round(least(1, 0.45 + CASE t.m WHEN 'exact' THEN 0.15 ELSE 0.05 END + t.x),
    2)::DOUBLE AS confidence
FROM part, (VALUES (0, 'glcm_entropy', 'exact', 0.15), (0, 'skeletal_muscle_index', 'exact', 0.15), (20, 'visceral_adipose_tissue', 'exact', 0.30)) t(i, c, m, x)""")
def t18_mentions(spark, d):
    content = F.lit("GLCM entropy and the skeletal muscle index differ. Nothing is told here. VAT on CT of the liver in liver cancer.")
    papers = spread(table(spark, d, "part").select("p_partkey"), PARTS).select(_key().alias("pmid"), F.lit("A title").alias("title"), content.alias("content"))
    return mentions.extract_mentions(papers).select("pmid", "sentence_index", "canonical_feature", F.round("confidence", 2).alias("confidence"))


TERMS = [("vat", "vat_feature"), ("visceral fat", "visceral_fat"), ("muscle", "muscle"), ("skeletal muscle", "skeletal_muscle")]


@query(f"""
SELECT p_partkey::VARCHAR AS pmid, m AS microbe, {_case_sql('p_partkey', ['visceral_fat', 'skeletal_muscle', 'vat_feature', None])} AS feature
  FROM part, (VALUES ('roseburia'), ('muscle')) t(m)
WHERE p_partkey % 4 <> 3""")
def t20_microbe_features(spark, d):
    s = _case("p_partkey", ["Visceral fat (VAT) and muscle", "Skeletal muscle", "VAT; elevated", "private"])
    microbes = F.array(*[F.struct(F.lit(x).alias("text")) for x in (" Roseburia", "roseburia", "Muscle")])
    rows = table(spark, d, "part").select(_key().alias("pmid"), s.alias("sentence"), F.lit(0).alias("ord"), microbes.alias("microbes"))
    return mentions.microbe_features(rows, TERMS, ["vat"]).select("pmid", "microbe", "feature")


@query("""
WITH g AS (SELECT p_brand AS surface, p_size % 3 = 0 AS ok, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'low' ELSE 'type' END AS reason FROM part)
SELECT 'total' AS kind, '' AS key, count(*) AS n, round(count(*) FILTER (WHERE NOT ok) / count(*), 4) AS share FROM g
  UNION ALL SELECT 'reason', reason, count(*), NULL FROM g WHERE NOT ok GROUP BY reason
UNION ALL (SELECT 'surface', surface, count(*), NULL FROM g WHERE NOT ok GROUP BY surface ORDER BY count(*) DESC, surface LIMIT 20)""")
def a15_audit_report(spark, d):
    size = F.col("p_size") % 3
    return mentions.audit_report(table(spark, d, "part").select(F.col("p_brand").alias("surface"), (size == 0).alias("accepted"),
        _case("p_size", ["", "low", "type"]).alias("drop_reason"), size))


# Sources and sinks.


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS note FROM orders UNION ALL SELECT -1, 'X', 1.5, NULL""")
def s3_json_lines(spark, d):
    """Rows written as JSON lines, appended to, and read again, a malformed line among them."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("note"))
    at = f"{shared_folder(spark)}/jsonl-{uuid.uuid4().hex}"
    files.write_jsonl(o, at)
    files.write_jsonl(spark.createDataFrame([(-1, "X", 1.5, None)], o.schema), at, append=True)
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(at)
    return files.read_jsonl(spark, at, o.schema, tolerant=True)


@query("SELECT 'Microbe' AS source_node_type, c_name AS source_node, '' AS pmid, c_custkey::VARCHAR AS confidence FROM customer")
def s4_relationship_csv(spark, d):
    c = table(spark, d, "customer").select(F.lit("Microbe").alias("source_node_type"), F.col("c_name").alias("source_node"), F.col("c_custkey").alias("confidence"),
        F.col("c_acctbal").alias("extra"))
    at = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(c, at, vocab.RELATIONSHIP_COLUMNS)
    return files.read_relationships(spark, at).select("source_node_type", "source_node", "pmid", "confidence")


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'full ' || p_type WHEN p_size % 4 = 1 THEN p_name || '. ' || p_type WHEN p_size % 4 = 2 THEN p_name ELSE '' END
    AS content,
       CASE p_size % 4 WHEN 0 THEN 'full_text' WHEN 1 THEN 'title_abstract' WHEN 2 THEN 'title' ELSE 'empty' END AS source_text FROM part""")
def s6_paper_text(spark, d):
    p, four = table(spark, d, "part"), F.col("p_size") % 4
    texts = p.where(four == 0).select(F.concat(F.lit("t/"), _key()).alias("path"), F.concat(F.lit("full "), "p_type", F.lit(" ")).alias("value"))
    papers = p.select("p_partkey", F.when(four != 3, F.col("p_name")).alias("title"), F.when(four == 1, F.col("p_type")).otherwise(" ").alias("abstract"),
        F.concat(F.lit("t/"), _key()).alias("full_text_path"))
    return files.paper_text(papers, texts).select("p_partkey", "content", "source_text")


@query(f"SELECT p_partkey, {_case_sql('p_partkey', ['Figure 1', 'Figure 3', 'Figure 2', None])} AS found FROM part")
def s9_figure_match(spark, d):
    labels = F.array(*map(F.lit, ("Figure 1", "Figure 3", "Figure 2")))
    return table(spark, d, "part").select("p_partkey", files.match_figure(_case("p_partkey", ["figure 1", "Fig. 3", "FIGURE 2 a, Figure 2", "Fig 9"]),
        labels).alias("found"))


@query("""
SELECT p_partkey, p_partkey::VARCHAR AS pmid, p_name AS title, CASE WHEN p_size % 2 = 0 THEN 'A. ' || p_brand END AS abstract, CASE p_size % 4 WHEN 0 THEN 2001 WHEN 1
    THEN 2002 WHEN 2 THEN 2003 END AS year,
       CASE WHEN p_size % 3 <> 2 THEN '10.1/' || p_partkey END AS doi FROM part""")
def s12_article_fields(spark, d):
    tag = lambda t, v: F.concat(F.lit(f"<{t}>"), v, F.lit(f"</{t.split()[0]}>"))
    year = F.when(F.col("p_size") % 4 == 0, "<JournalIssue><PubDate><Year>2001</Year></PubDate></JournalIssue><ArticleDate><Year>1990</Year></ArticleDate>")
    year = year.when(F.col("p_size") % 4 == 1, "<ArticleDate><Year>2002</Year></ArticleDate>").when(F.col("p_size") % 4 == 2,
        "<PubDate><MedlineDate>Spring 2003</MedlineDate></PubDate>").otherwise("")
    number = F.concat(F.lit("10.1/"), _key())
    doi = F.when(F.col("p_size") % 3 == 0, tag("ELocationID EIdType='doi'", number)).when(F.col("p_size") % 3 == 1, tag("ArticleId IdType='doi'", number)).otherwise("")
    told = F.when(F.col("p_size") % 2 == 0, tag("Abstract", F.concat(tag("AbstractText", F.lit("A.")), tag("AbstractText", F.col("p_brand"))))).otherwise("")
    xml = tag("A", F.concat(tag("PMID", _key()), tag("ArticleTitle", F.col("p_name")), told, year, doi))
    return table(spark, d, "part").select("p_partkey", files.article_fields(xml).alias("f")).select("p_partkey", "f.*")


PAGE = "<html><head><title>T</title><script>var abstract = 1;</script></head><body><p>Intro</p><h2>Abstract</h2><p>We &amp; {b}</p>\n<div>and&nbsp;more</div><p>References</p><li>1. x</li></body></html>"


@query("SELECT p_partkey, 'Abstract We & ' || p_brand || ' and more' AS text FROM part")
def s7_article_sections(spark, d):
    return table(spark, d, "part").select("p_partkey", files.article_text(F.replace(F.lit(PAGE), F.lit("{b}"), F.col("p_brand"))).alias("text"))


# Images: pictures are made of a part's columns, so that what is seen in them is known.


@query("""
SELECT p_partkey::VARCHAR AS proposal_id, CASE WHEN p_size % 5 = 0 THEN 'missing_image' WHEN p_size % 5 = 1 THEN 'proposed_r_missing' WHEN p_size % 5 = 2
    THEN 'r_out_of_range' WHEN p_size % 5 = 3 THEN 'verified' ELSE 'insufficient_support' END AS reason_code,
       CASE WHEN p_size % 5 = 0 THEN 'image_missing' ELSE 'legend_detected' END AS bar FROM part""")
def v2_heatmap_values(spark, d):
    """A left panel of one colour, and a colour bar at the right edge, as far as a proposal has a picture."""
    height, width = 60, 80
    level = lambda y: (y * 255 / (height - 1)).cast("int")
    pixel = lambda r, b: F.concat(F.lpad(F.hex(b), 2, "0"), F.lit("28"), F.lpad(F.hex(r), 2, "0"))  # noqa: E731  blue, green, red

    def line(y):
        shade = F.lit(230 - int(0.25 * 200)).cast("int")  # the colour of the panel: a quarter of the way down the bar
        bar = (F.lit(230) - level(y) * 200 / 255).cast("int")
        panel, strip = F.repeat(pixel(shade, F.lit(255) - shade), 50), F.repeat(pixel(bar, F.lit(255) - bar), 10)
        return F.concat(panel, F.repeat(F.lit("000000"), 12), strip, F.repeat(F.lit("000000"), 8))

    # One picture serves all parts, so it is drawn once.
    data = F.lit(spark.range(1).select(F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(height - 1)), line), ""))).first()[0])
    five = F.col("p_size") % 5
    r = F.when(five == 1, None).when(five == 2, 2.0).when(five == 3, 0.5).otherwise(-0.9)
    image = F.struct(F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(3).alias("nChannels"), F.when(five != 0, data).alias("data"))
    none = F.lit(None).cast("array<int>")
    rows = spread(table(spark, d, "part").select("p_partkey", "p_size"), PICTURES).select(_key().alias("proposal_id"), r.alias("candidate_r"), none.alias("legend_bbox"),
        none.alias("heatmap_bbox"), image.alias("image"))
    return images.gated_images(rows).select("proposal_id", "reason_code", F.col("reason").alias("bar"))


@query("""
SELECT p_partkey::VARCHAR AS proposal_id, least(1, (24 + 6 * (p_size % 5) - 1 + 7) / 80) AS matrix_score,
       round(least(1, greatest(0, (p_size % 11 - p_size % 4) / (1 + p_size % 4 + 1e-6))), 6) AS forest_score FROM part""")
def v4_image_make_up(spark, d):
    """Grey pictures of 8 lines that go up and down by a number of steps, another number in the middle third."""
    third = F.lit(8) + 2 * (F.col("p_size") % 5).cast("int")
    up = lambda n: F.lpad(F.hex(100 + 2 * (F.lit(1) + n)), 2, "0")
    side, middle = F.col("p_size") % 4, F.col("p_size") % 11
    flat = F.repeat(F.lit("64"), 3 * third)
    line = F.concat(F.repeat(up(side), third), F.repeat(up(middle), third), F.repeat(up(side), third))
    data = F.unhex(F.repeat(F.concat(flat, line), F.lit(4)))
    image = F.struct(F.lit(8).alias("height"), (3 * third).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"))
    told = images.image_heuristics(spread(table(spark, d, "part").select("p_partkey", "p_size"), PICTURES).select(_key().alias("proposal_id"), image.alias("image")))
    return told.select("proposal_id", "matrix_score", F.round("forest_score", 6).alias("forest_score"))


# Metrics, windows, streams.


@query("""
SELECT (SELECT count(*) FROM part) AS n, (SELECT count(*) FROM part WHERE p_size % 2 = 0) AS even, (SELECT count(DISTINCT p_brand) FROM part) AS brands""")
def a17_stage_metrics(spark, d):
    """Counted while another result is written."""
    rows, seen = files.with_metrics(table(spark, d, "part"), n=F.count("*"), even=F.count_if(F.col("p_size") % 2 == 0))
    brands = rows.select("p_brand", "p_size").distinct().agg(F.countDistinct("p_brand").alias("b")).first().b
    told = {"n": None, "even": None} | seen.get
    return spark.createDataFrame([(told["n"], told["even"], brands)], "n bigint, even bigint, brands bigint")


@query("""
WITH b AS (SELECT event_id, user_id, event_type, ts, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS k FROM events)
SELECT event_id, event_type FROM b WHERE event_id % 2 = 0 AND event_id NOT IN (SELECT event_id FROM events WHERE event_id % 3 = 0)""")
def f7_unseen_events(spark, d):
    e = table(spark, d, "events")
    return incremental.new_only(e.where("event_id % 2 = 0").select("event_id", "event_type"), e.where("event_id % 3 = 0"), "event_id")


@query("""
WITH n AS (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n, embedding FROM embeddings)
SELECT vec_id, i::INT AS i, round(x::DOUBLE * 2 / (n * 2), 5) AS x FROM (SELECT vec_id, n, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS x FROM n)""")
def v5_unit_vectors(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", vectors.norm(F.transform("embedding", lambda x: x.cast("double") * 2)).alias("e"))
    return e.select("vec_id", F.posexplode("e").alias("i", "x")).withColumn("x", F.round("x", 5))


@query("""
WITH g AS (SELECT *, CASE WHEN l_discount < 0.03 THEN 'caption' WHEN l_discount < 0.06 THEN 'colorbar_detect' WHEN l_tax > 0.05 THEN 'range_sanity' END AS f
  FROM lineitem)
SELECT l_orderkey, l_linenumber, f IS NULL AS passed, f AS failing_gate FROM g""")
def t31_gate_chain(spark, d):
    gate = lambda c, why: F.struct(c.alias("passed"), F.when(c, "ok").otherwise(why).alias("reason"))
    li = table(spark, d, "lineitem")
    range_gate = gates.range_gate(F.when(F.col("l_tax") > 0.05, 1.5).otherwise(0.5))
    chain = gates.chain(caption=gate(F.col("l_discount") >= 0.03, "a"), colorbar_detect=gate(F.col("l_discount") >= 0.06, "b"), range_sanity=range_gate)
    return li.select("l_orderkey", "l_linenumber", chain.alias("c")).select("l_orderkey", "l_linenumber", "c.passed", "c.failing_gate")


@query("""
WITH s AS (SELECT p_partkey AS ord, p_name AS sentence, CASE WHEN p_size % 4 <> 0 THEN p_brand ELSE '' END AS m, CASE WHEN p_size % 5 <> 0 THEN p_type ELSE '' END AS dis,
    row_number() OVER (ORDER BY p_partkey) - 1 AS i
  FROM part),
pm AS (SELECT m, row_number() OVER (ORDER BY ord) - 1 AS j, count(*) OVER () AS n FROM s
  WHERE m <> ''), pd AS (SELECT dis, row_number() OVER (ORDER BY ord) - 1 AS j, count(*) OVER () AS n FROM s WHERE dis <> '')
SELECT s.ord, s.m AS microbe, s.dis AS disease, pm.m AS next_microbe, pd.dis AS next_disease FROM s
  JOIN pm ON (s.i + 1) % pm.n = pm.j JOIN pd ON (s.i + 2) % pd.n = pd.j""")
def t35_augmented(spark, d):
    p = table(spark, d, "part")
    m, s = F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).otherwise(""), F.when(F.col("p_size") % 5 != 0, F.col("p_type")).otherwise("")
    # A sentence of marks, so that the swap shows what it puts in.
    seeds = p.select(F.col("p_partkey").alias("ord"), F.concat(F.lit("<"), m, F.lit("|"), s, F.lit(">")).alias("sentence"), m.alias("microbe"), s.alias("disease"))
    both = seeds.select("ord", "microbe", "disease")
    from ..operators.ordering import ordinals

    numbered = ordinals(both, "ord", "i")
    pools = {c: ordinals(both.where(F.col(c) != ""), "ord", "j").select("j", F.col(c).alias(f"next_{c}")) for c in ("microbe", "disease")}
    sizes = {c: pool.count() for c, pool in pools.items()}
    out = numbered.join(pools["microbe"], F.pmod(F.col("i") + 1, F.lit(sizes["microbe"])) == F.col("j")).drop("j")
    out = out.join(pools["disease"], F.pmod(F.col("i") + 2, F.lit(sizes["disease"])) == F.col("j")).drop("j", "i")
    made = relations.augment(seeds).where("kind = 'entity_swap' AND startswith(text, '<')").select("ord", "text")
    wrong = out.join(made, "ord").where((F.col("microbe") != "") & (F.col("disease") != "") & (F.col("text") != F.concat(F.lit("<"), "next_microbe", F.lit("|"),
        "next_disease", F.lit(">"))))
    if not wrong.isEmpty():
        raise ValueError("a swap takes other entities than the rotation gives")
    return out


@query("""
WITH g AS (SELECT CASE WHEN grouping(label) = 0 THEN 'label' ELSE 'all' END AS scope, coalesce(label::VARCHAR, '') AS value, count(*) FILTER (WHERE embedding[1] > 0
    AND embedding[2] > 0) AS tp, count(*) FILTER (WHERE embedding[2] <= 0 AND embedding[1] > 0) AS fp
FROM embeddings GROUP BY GROUPING SETS ((), (label))) SELECT * FROM g""")
def a12_by_label(spark, d):
    e = table(spark, d, "embeddings").select("label", (F.element_at("embedding", 2) > 0).alias("gold"), (F.element_at("embedding", 1) > 0).alias("predicted"))
    return scoring.confusion(e, ["label"]).select("scope", "value", "tp", "fp")


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'https://x/a' WHEN p_size % 3 = 0 THEN 'https://example.org/b' ELSE 'http://c' END AS url, p_size % 2 = 0
    OR p_size % 3 = 0 AS hit
  FROM part""")
def s14_absolute_urls(spark, d):
    raw = F.when(F.col("p_size") % 2 == 0, "//x/a").when(F.col("p_size") % 3 == 0, "/b").otherwise("http://c")
    return table(spark, d, "part").select("p_partkey", files.absolute_url(raw).alias("url"), edges.disease_match(raw, F.lit("//x/a/b")).alias("hit"))


@query(f"""
SELECT substr(sha1(p_partkey || '|roseburia|' || f), 1, 16) AS record_id, f AS target_node, 'PMID ' || p_partkey || ': ' || s AS evidence, 3::BIGINT AS n_samples
FROM (SELECT p_partkey, p_size, {_case_sql('p_partkey', ['visceral_fat', 'skeletal_muscle', 'vat_feature', None])} AS f,
             {_case_sql('p_partkey', ['Visceral fat (VAT) and muscle', 'Skeletal muscle', 'VAT; elevated', 'private'])} AS s FROM part)
WHERE f IS NOT NULL AND p_size % 3 <> 0""")
def e9_feature_edges(spark, d):
    s = _case("p_partkey", ["Visceral fat (VAT) and muscle", "Skeletal muscle", "VAT; elevated", "private"])
    microbes = F.array(*[F.struct(F.lit(x).alias("text")) for x in ("Roseburia", "Muscle")])
    p = table(spark, d, "part")
    rows = p.select(_key().alias("pmid"), s.alias("sentence"), F.lit(0).alias("ord"), microbes.alias("microbes"))
    grounded = spark.createDataFrame([(" ROSEBURIA", True, "", "C1", "T007", 0.9, "Roseburia"), ("muscle", False, "deny_cui:x", "C2", "T204", 0.9, "M")],
        "surface string, accepted boolean, drop_reason string, cui string, tui string, similarity double, official_name string")
    gated = mentions.gated_features(mentions.microbe_features(rows, TERMS, ["vat"]), grounded).where("drop_reason IS NULL")
    label = F.when((F.col("p_size") % 3 == 0) & (F.col("i") == 1), "unrelated").otherwise("associated")
    samples = p.select("p_size", _key().alias("pmid"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i")).withColumn("label", label)
    answers = gated.select("pmid", "microbe", "feature").join(samples, "pmid").select("pmid", "microbe", "feature", "label")
    return mentions.feature_edges(gated, answers).select("record_id", "target_node", "evidence", "n_samples")


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN -0.5 WHEN 1 THEN -1 END::DOUBLE AS low, CASE p_size % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 2 END::DOUBLE AS high,
       CASE p_size % 5 WHEN 0 THEN 'read off' WHEN 1 THEN 'vlm_extracted' WHEN 2 THEN 'no_numeric_ticks' WHEN 3 THEN 'non_numeric_response' ELSE 'vlm_extracted' END
           AS reason,
       CASE WHEN p_size % 5 = 4 OR p_partkey % 4 = 3 THEN 'unknown' ELSE ['positive', 'neutral', 'unknown'][p_partkey % 4 + 1] END AS hemisphere,
       CASE WHEN p_partkey % 4 = 3 THEN 'bbox_invalid' WHEN p_size % 5 = 4 THEN 'hemisphere_missing' WHEN p_partkey % 4 = 2 THEN 'hemisphere_unrecognized'
           ELSE 'vlm_judgment' END AS seen
         FROM part""")
def v7_readers(spark, d):
    from ..operators import figures

    bar = _case("p_size", ['{"min": 0.5, "max": -0.5, "reason": "read off"}', '```json\n{"min": "-1", "max": 2}\n```',
        '{"min": null, "max": 1, "reason": "no_numeric_ticks"}', '{"min": "low", "max": 1}', "none"])
    cell = F.when(F.col("p_size") % 5 == 4, "{}").otherwise(_case("p_partkey",
        ['{"hemisphere": " Positive"}', 'so {"hemisphere": "NEUTRAL", "reason": ""}', '{"hemisphere": "warm"}', '{"hemisphere": "negative"}']))
    area = F.when(F.col("p_partkey") % 4 != 3, F.array(*map(F.lit, (1, 2, 3, 4)))).otherwise(F.array(F.lit(1)))
    p = spread(table(spark, d, "part").select("p_partkey", "p_size"), PARTS).select("p_partkey", figures.colourbar_range(bar).alias("b"), figures.hemisphere(cell, area).alias("h"))
    return p.select("p_partkey", "b.low", "b.high", "b.reason", "h.hemisphere", F.col("h.reason").alias("seen"))


@query("""
SELECT p_partkey::VARCHAR AS record_id, 'items[].kind' AS path, 'enum' AS rule FROM part WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey::VARCHAR, 'items[].score', 'range' FROM part WHERE p_size > 40
  UNION ALL SELECT p_partkey::VARCHAR, 'one.name', 'required' FROM part WHERE p_size % 4 = 0""")
def f1_nested_violations(spark, d):
    from ..schemas import violations

    item = lambda k, x: F.struct(k.alias("kind"), x.alias("score"))
    kind = F.when(F.col("p_size") % 3 == 0, "other").otherwise("a")
    p = table(spark, d, "part").select("p_partkey", F.array(item(F.lit("a"), F.lit(0.5)), item(kind, F.col("p_size") / 40)).alias("items"),
        F.struct(F.when(F.col("p_size") % 4 != 0, "x").alias("name")).alias("one"))
    return violations(p, "p_partkey", ["one.name"], {"items[].kind": ("a", "b")}, {"items[].score": (0, 1)})
