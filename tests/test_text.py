import math

import pytest
from pyspark.sql import functions as F

from corvina.functions import spans, text, vocab
from corvina.operators import aliases, mentions


def values(spark, rows, made, schema="x string"):
    """The values of an expression of x over rows, in their order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", made.alias("v")).orderBy("i").collect()]


X = None


@pytest.fixture(autouse=True)
def column(spark):
    global X
    X = F.col("x")

SUBJECTS = {
    "Akkermansia muciniphila abundance": ("akkermansia muciniphila", None),
    "Bacteroides genus levels": ("bacteroides", None),
    "ruminococcus 2": ("ruminococcus", None),
    "lactobacillus-containing probiotics": ("lactobacillus", None),
    "bacterial species": (None, "generic_microbe_term"),
    "certain gram-negative bacteria": (None, "generic_microbe_term"),
    "bacteria-derived": (None, "generic_microbe_term"),
    "fuso ##bacterium": (None, "subject_wordpiece_fragment"),
    "  ": (None, "missing_subject_node"),
    None: (None, "missing_subject_node"),
    "Prevotella and": ("prevotella", None),
    "[E. coli]": ("e. coli", None),
}
DISEASES = {
    "Colorectal cancer patients": ("colorectal cancer", None),
    "in patients with liver cirrhosis": ("liver cirrhosis", None),
    "manifestations of sarcopenia": ("sarcopenia", None),
    "with the risk": (None, "missing_disease"),
    "high bmi in obesity and more": ("obesity and more", None),
    "disease": (None, "generic_disease_term"),
    "increased liver fibrosis": (None, "disease_relation_language"),
    "their very long list of liver diseases": (None, "disease_clause_like"),
    "one two three four five six seven eight": (None, "disease_clause_like"),
    "liver ##osis": (None, "disease_wordpiece_fragment"),
    "": (None, "missing_disease"),
    None: (None, "missing_disease"),
}


def test_clean_subject(spark):
    got = values(spark, list(SUBJECTS), spans.clean_subject(X))
    assert {k: (g.canonical, g.reason) for k, g in zip(SUBJECTS, got, strict=True)} == SUBJECTS
    signature = values(spark, ["Gut microbiota composition levels"], spans.clean_subject(X, F.lit("MicrobialSignature")))
    assert signature[0].canonical == "gut microbiota composition levels"


def test_clean_disease(spark):
    got = values(spark, list(DISEASES), spans.clean_disease(X))
    assert {k: (g.canonical, g.reason) for k, g in zip(DISEASES, got, strict=True)} == DISEASES


def test_cleaning_is_idempotent(spark):
    for rows, f in ((SUBJECTS, spans.clean_subject), (DISEASES, spans.clean_disease)):
        once = [g.canonical for g in values(spark, list(rows), f(X)) if g.canonical]
        assert [g.canonical for g in values(spark, once, f(X))] == once


def test_text_disease_and_eligibility(spark):
    cleaned = values(spark, ["the liver cancer", "presence of steatosis", "biopsy-proven nash", "disease"], spans.clean_text_disease(X))
    assert [c.canonical for c in cleaned] == ["liver cancer", "steatosis", "nash", None]
    ok = ["liver cancer", "systemic inflammation", "type 2 diabetes"]
    bad = ["cancer", "inflammation", "gut inflammation", "development of colorectal cancer", "diet and obesity", "sarcopenia", "gut microbiota in obesity", "patients with obesity", "what causes obesity", ""]
    assert values(spark, ok + bad, spans.eligible_disease(X)) == [True] * len(ok) + [False] * len(bad)


def test_clean_pair_precedence(spark):
    df = spark.createDataFrame([("", "x", "y"), ("a b c", "bacteria", "disease"), ("a b", "Roseburia", "disease"), ("a b", "Roseburia", "Obesity")], "s string, m string, d string")
    got = [r.p for r in df.select(spans.clean_pair(F.col("s"), F.col("m"), F.col("d"), max_words=3).alias("p")).collect()]
    assert [g.reason for g in got] == ["missing_sentence", "evidence_too_long_words", "generic_disease_term", None]
    assert (got[3].subject, got[3].disease) == ("roseburia", "obesity")


def test_sentences_chunks_normalize(spark):
    assert values(spark, ["A b. C d?  E", "", None, "no end"], text.sentences(X)) == [["A b.", "C d?", "E"], [], [], ["no end"]]
    chunks = values(spark, [" ".join(map(str, range(n))) for n in (0, 100, 101, 205)], text.chunks(X))
    assert [len(c) for c in chunks] == [0, 1, 2, 3] and all(len(x.split()) <= 100 for c in chunks for x in c)
    assert chunks[3][1].split()[0] == "70" and chunks[3][-1].split()[-1] == "204"
    assert values(spark, ["  A b \n C ", None], text.normalize(X)) == ["a b c", ""]


def test_loose_values(spark):
    raw = ["NA", "", None, "-1", "3.5", "x", "Q2", "3"]
    assert values(spark, raw, text.impact_factor(X)) == [None, None, None, None, 3.5, None, None, 3.0]
    assert values(spark, raw, text.quartile(X)) == [None, None, None, None, None, None, "Q2", "Q3"]
    assert values(spark, ["2024.0", "", "x", "-7.9"], text.safe_int(X)) == [2024, None, None, -7]
    assert values(spark, ["TRUE", " yes", "0", "", None], text.safe_bool(X)) == [True, True, False, None, None]


def test_detection(spark):
    s = ["CT of the liver affected", "An MRI scan", "dual-energy x-ray absorptiometry", "nothing", None]
    assert values(spark, s, text.modality(X)) == ["CT", "MRI", "DXA", None, None]
    assert values(spark, ["was affected"], text.modality(X)) == ["CT"] and values(spark, ["was affected"], text.modality(X, whole_words=True)) == [None]
    assert values(spark, ["Hip and liver", "delivery"], text.body_location(X)) == ["liver", None]
    assert values(spark, ["She had non-alcoholic liver disease.", "Patients had non-alcoholic liver disease.", "with obesity in"], text.disease(X, F.lit(""))) == ["she had non-alcoholic liver disease", None, None]
    assert values(spark, ["survival predicted", "survival", "detected", "linked to", "x"], text.claim_hint(X, F.lit(""))) == ["predictive", "prognostic", "diagnostic", "association", None]
    got = values(spark, ["Fusobacterium nucleatum was", "some roseburia", "gut microbiota composition", "nothing"], text.subject(X))
    assert [(g.type, g.name) for g in got] == [("Microbe", "fusobacterium nucleatum"), ("Microbe", "roseburia"), ("MicrobialSignature", "gut microbiota composition"), (None, None)]
    assert values(spark, ["Odd Bug", ""], text.subject(X, fallback=True)[("name")]) == ["odd bug", None]


def test_labels_topology_json(spark):
    assert values(spark, ["(A) yes", "b", "C.", "It is positive", "negative!", "na", "", None], text.relation_label(X)) == ["positive", "negative", "unrelated", "positive", "negative", "unrelated", "unrelated", "unrelated"]
    assert values(spark, ["X increased the risk", "X was reduced", "increase and decrease", "none"], text.marker_label(X)) == ["positive", "negative", "unrelated", "unrelated"]
    got = values(spark, ["Heatmap of the correlation matrix", "Forest plot of hazard ratio", "Scatter plot", "none"], text.topology(X))
    assert [(g.topology, g.confidence) for g in got] == [("heatmap", pytest.approx(0.6)), ("forest_plot", 0.4), ("scatter_plot", 0.5), ("unknown", 0.0)]
    assert values(spark, ['{"a": 1}', 'so: {"a": {"b": 2}} done', "{broken", None], text.json_object(X)) == ['{"a": 1}', '{"a": {"b": 2}}', None, None]
    assert text.temperatures() == [0.45, 0.517, 0.583, 0.65, 0.717, 0.783, 0.85] and text.temperatures(1) == [0.7]
    assert text.read_only("MATCH (n) RETURN n")
    with pytest.raises(ValueError):
        text.read_only("match (n) delete n")


def test_stable_ids_match_plain_sha1(spark):
    from hashlib import sha1

    want = sha1(b"text|1||x").hexdigest()[:16]
    assert values(spark, ["x"], text.stable_id("text", F.lit(1), F.lit(None), X)) == [want]


def test_alias_matches():
    m = aliases.AliasMatcher(vocab.ALIASES)
    assert [(x[0], x[2], x[3]) for x in m.exact("glcm entropy and skeletal muscle index")] == [(0, "glcm entropy", "glcm_entropy"), (17, "skeletal muscle index", "skeletal_muscle_index")]
    assert m.exact("mean age of 60 in radiomics") == [] and m.exact("the mean intensity")[0][3] == "first_order_mean"
    assert m.exact("kurtosis of prices") == [] and m.exact("kurtosis of the histogram")[0][3] == "first_order_kurtosis"
    assert m.fuzzy("radiomic haralick entropi was")[0][3] == "glcm_entropy" and m.fuzzy("haralik entropi") == []


def test_extract_mentions(spark):
    papers = spark.createDataFrame(
        [("1", "A title", "CT radiomics of the liver. GLCM entropy on CT of the liver was linked to liver cancer and Fusobacterium nucleatum. VAT was seen."), ("2", "t", None)],
        "pmid string, title string, content string",
    )
    rows = {r.canonical_feature: r for r in mentions.extract_mentions(papers).collect()}
    one = rows["glcm_entropy"]
    assert (one.sentence_index, one.span_start, one.span_end, one.modality, one.body_location) == (1, 0, 12, "CT", "liver")
    assert one.subject_node == "fusobacterium nucleatum" and math.isclose(one.confidence, 0.95) and one.ibsi_id == "IBSI:GLCM_ENTROPY"
    assert math.isclose(rows["visceral_adipose_tissue"].confidence, 0.6)
