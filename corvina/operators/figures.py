"""Figures before and after they are read: records, filters, lookups, proposals, failures, and the audit of both verifiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..storage import dealt_join, tasks_for
from . import gates
from .relations import last_by

BOX = "array<int>"


def _filled(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


# Records and filters.


def figures_of_papers(papers: DataFrame) -> DataFrame:
    """One row per element of figure_metadata of papers(pmid, figure_metadata), classified; an id is made where none is given."""
    one = papers.select(F.nullif("pmid", F.lit("")).alias("pmid"), F.explode("figure_metadata").alias("f"))
    caption, path = F.coalesce("f.caption", F.lit("")), F.col("f.image_path")
    made = text.stable_id(F.coalesce("pmid", F.lit("na")), caption, F.coalesce(path, F.lit("na")))
    rows = one.select(F.coalesce(F.nullif("f.figure_id", F.lit("")), made).alias("figure_id"), "pmid", path.alias("image_path"), caption.alias("caption"))
    kind = text.topology(F.col("caption"))
    told = rows.withColumn("t", kind)
    return told.select(*rows.columns, "t.topology", F.col("t.confidence").alias("topology_confidence"), F.col("t.hits").alias("heuristic_hits"),
        F.lit("paper_metadata").alias("source_context"))


def caption_suggests(caption: Column, words: Sequence[str] = vocab.QUALIFYING_CAPTIONS) -> Column:
    """Whether a caption has one of the words; a null caption has none."""
    return text.contains_any(F.lower(F.coalesce(caption, F.lit(""))), words)


def relevance(figures: DataFrame, answers: DataFrame) -> DataFrame:
    """figures with relevant and relevance_reason, from answers(figure_id, answer, error) of a reader, which stand for its calls.

    A figure without an image is not relevant. The gate fails open: an error or a
    missing answer lets the figure pass; only an answer that doesn't begin with yes stops it.
    """
    a = last_by(answers.withColumn("ord", F.col("ord") if "ord" in answers.columns else F.xxhash64("answer", "error")), ["figure_id"])
    joined = figures.join(a.select("figure_id", "answer", "error"), "figure_id", "left")
    none = _filled(F.col("image_path")).isNull()
    failed = F.col("error").isNotNull() | F.col("answer").isNull()
    low = F.lower(F.trim("answer"))
    reason = F.when(none, "no_image").when(failed, F.concat(F.lit("gate_error:"), F.coalesce("error", F.lit("no_answer")))).otherwise(F.substring(low, 1, 20))
    passed = F.when(none, False).when(failed, True).otherwise(low.startswith("yes"))
    return joined.withColumns({"relevant": passed, "relevance_reason": reason}).drop("answer", "error")


def allowed(rows: DataFrame, listed: DataFrame, key: str = "pmcid") -> DataFrame:
    """Rows whose key is in a list."""
    return rows.join(listed.select(key).distinct(), key, "left_semi")


# Lookups.


def with_images(proposals: DataFrame, figures: DataFrame) -> DataFrame:
    """proposals with the image of their figure where they have none; of a figure's rows with an image the last counts."""
    known = figures.where((F.coalesce("figure_id", F.lit("")) != "") & _filled(F.col("image_path")).isNotNull())
    last = known.groupBy("figure_id").agg(F.max_by("image_path", "ord").alias("_image"))
    return proposals.join(last, "figure_id", "left").withColumn("image_path", F.coalesce(F.nullif("image_path", F.lit("")), "_image")).drop("_image")


def with_captions(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """rows with the trimmed caption of their figure, the last of its rows; empty without one."""
    last = figures.where(F.trim("figure_id") != "").groupBy(F.trim("figure_id").alias("figure_id")).agg(F.max_by(F.trim(F.coalesce("caption", F.lit(""))),
        "ord").alias("caption"))
    return rows.join(last, "figure_id", "left").withColumn("caption", F.coalesce("caption", F.lit("")))


def resolved_images(rows: DataFrame, files: DataFrame, folder: str = "", kinds: Sequence[str] = ("png", "jpg")) -> DataFrame:
    """rows with resolved_path, the first of their possible image paths that files(path) lists.

    Tried in order: image_path, panel_image_path, figure_image_path, then
    folder/pmcid_figure_id with each suffix where both ids are given.
    """
    given = [_filled(F.col(c)) for c in ("image_path", "panel_image_path", "figure_image_path") if c in rows.columns]
    made = [F.concat(F.lit(folder), _filled(F.col("pmcid")), F.lit("_"), _filled(F.col("figure_id")), F.lit(f".{k}")) for k in kinds]
    return _first_existing(rows, [*given, *made], files)


def figure_files(rows: DataFrame, files: DataFrame, folder: str = "", kinds: Sequence[str] = ("jpg", "jpeg", "png", "webp")) -> DataFrame:
    """rows with resolved_path, the first of folder/figure_id with each suffix that files(path) lists."""
    return _first_existing(rows, [F.concat(F.lit(folder), "figure_id", F.lit(f".{k}")) for k in kinds], files)


def _first_existing(rows: DataFrame, paths: Sequence[Column], files: DataFrame) -> DataFrame:
    tasks = tasks_for(rows, files)
    keyed = rows.withColumn("_paths", F.filter(F.array(*paths), lambda p: p.isNotNull())).repartition(tasks, "_paths")
    # Equal lists of paths are looked up once.
    tried = keyed.select("_paths").distinct().select("_paths", F.posexplode("_paths").alias("_at", "path"))
    found = dealt_join(tried, files.select(F.col("path").alias("_file")), "path", "_file", tasks, "left_semi")
    first = found.repartition(tasks, "_paths").groupBy("_paths").agg(F.min("_at").alias("_first"))
    return keyed.join(first, "_paths", "left").withColumn("resolved_path", F.get("_paths", F.col("_first"))).drop("_paths", "_first")


def historical(verifications: DataFrame, proposals: DataFrame, current: DataFrame, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Verified rows of earlier runs with their proposals, without figures that current proposals have.

    verifications(figure_id, verified, verification_passed, proposed_r, r_value,
    subject_node, object_node); of a figure's proposals the last counts. What a
    verification says goes before what its proposal says.
    """
    names = F.create_map(*[F.lit(x) for p in (renamed or {"": ""}).items() for x in p])
    good = F.coalesce("verified", F.lit(False)) | F.coalesce("verification_passed", F.lit(False))
    v = verifications.where(good).withColumn("figure_id", F.coalesce(F.try_element_at(names, F.col("figure_id")), "figure_id"))
    v = v.join(current.select("figure_id").distinct(), "figure_id", "left_anti")
    p = last_by(proposals.select("figure_id", "candidate_r", "microbe", "radiomic_feature", "topology", "ord"), ["figure_id"]).drop("ord")
    p = p.select("figure_id", *[F.col(c).alias(f"_{c}") for c in ("candidate_r", "microbe", "radiomic_feature", "topology")])
    joined = v.join(p, "figure_id", "left")
    return joined.select(
        "figure_id",
        F.coalesce("proposed_r", "r_value", "_candidate_r").alias("candidate_r"),
        F.coalesce(_filled(F.col("subject_node")), "_microbe").alias("microbe"),
        F.coalesce(_filled(F.col("object_node")), "_radiomic_feature").alias("radiomic_feature"),
        F.col("_topology").alias("topology"),
    )


# Proposals.


def _first_key(fields: Column, *keys: str) -> Column:
    """The value of the first key that there is, even if it is null."""
    return text.first_of([(F.map_contains_key(fields, k), fields[k]) for k in keys], F.lit(None).cast("string"))


def box(value: Column) -> Column:
    """Four whole numbers of a JSON list, or of the keys x, y, w and h; else null."""
    listed = F.from_json(value, "array<double>")
    keyed = F.from_json(value, "map<string,double>")
    four = F.when(value.startswith("["), listed).otherwise(F.array(*[F.try_element_at(keyed, F.lit(k)) for k in "xywh"]))
    good = (F.size(four) == 4) & ~F.exists(four, lambda x: x.isNull())
    return F.when(good, F.transform(four, lambda x: x.cast("int")))


def proposal_fields(response: Column) -> Column:
    """struct of what a reader's answer proposes; null if there is no JSON object in it.

    A correlation is held within -1 and 1; other effects stay as they are.
    """
    fields = F.from_json(text.json_object(response), "map<string,string>")

    def told(m: Column) -> Column:
        number = lambda *keys: _first_key(m, *keys).try_cast("double")
        some = lambda key, default: F.coalesce(F.nullif(m[key], F.lit("")), F.lit(default))
        kind, r = some("effect_type", "correlation_r"), number("candidate_r", "proposed_r", "r_value", "r")
        held = F.when((kind == "correlation_r") & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).otherwise(r)
        made = {
            "candidate_r": held,
            "effect_type": kind,
            "ci_lower": number("ci_lower"),
            "ci_upper": number("ci_upper"),
            "p_value": number("p_value"),
            "panel_id": some("panel_id", "main"),
            "bbox": box(m["bbox"]),
            "legend_bbox": box(m["legend_bbox"]),
            "heatmap_bbox": box(_first_key(m, "heatmap_bbox", "bbox")),
            "modality": m["modality"],
            "microbe": m["microbe"],
            "subject_node_type": m["subject_node_type"],
            "subject_node": _first_key(m, "subject_node", "microbe"),
            "radiomic_feature": m["radiomic_feature"],
            "disease": m["disease"],
        }
        return F.struct(*[v.alias(k) for k, v in made.items()])

    return F.get(F.transform(F.array(fields), lambda m: F.when(m.isNotNull(), told(m))), F.lit(0))


def verifier_fields(proposals: DataFrame) -> DataFrame:
    """proposals in the terms of the verifiers: subject, feature, value and topology."""
    has = lambda c: F.col(c) if c in proposals.columns else F.lit(None)
    value = F.coalesce(has("candidate_r"), has("proposed_r")).cast("double")
    some = lambda *cs: F.coalesce(*[F.nullif(has(c).cast("string"), F.lit("")) for c in cs], F.lit(""))
    made = {"subject": some("microbe", "subject_node"), "feature": some("radiomic_feature"), "value": value, "r_value": value}
    return proposals.withColumns(made | {"topology": F.coalesce(F.nullif(has("topology").cast("string"), F.lit("")), F.lit("heatmap"))})


def to_verify(proposals: DataFrame) -> DataFrame:
    return proposals.where((F.col("status") == "ok") & F.col("candidate_r").isNotNull())


def failure(r: Column, topology: Column, image_path: Column, exists: Column, low: float = -1.0, high: float = 1.0) -> Column:
    """Why a proposal can't be held against its image, or null; forest plots need no image."""
    forest = F.coalesce(topology, F.lit("heatmap")) == "forest_plot"
    cases = [
        (r.isNull(), "missing_candidate_r"),
        (forest, F.lit(None).cast("string")),
        (F.coalesce(F.trim(image_path), F.lit("")) == "", "missing_image"),
        (~F.coalesce(exists, F.lit(False)), "image_not_found"),
        ((r < low) | (r > high), "r_out_of_range"),
    ]
    return text.first_of(cases, F.lit(None).cast("string"))


# Both verifiers.


def balanced_object(answer: Column) -> Column:
    """The first {...} of an answer whose braces are balanced, also in a fenced block; null if there is none or it is no JSON."""
    from_open = F.substr(answer, F.locate("{", answer))

    def step(a: Column, c: Column) -> Column:
        depth = a["depth"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        at = a["at"] + 1
        return F.struct(depth.alias("depth"), at.alias("at"), F.when(a["end"] > 0, a["end"]).when(depth == 0, at).otherwise(0).alias("end"))

    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))
    end = F.aggregate(F.split(from_open, ""), zero, step, lambda a: a["end"])
    cut = F.when((F.locate("{", answer) > 0) & (end > 0), F.substr(from_open, F.lit(1), end))
    return F.when(F.try_parse_json(cut).isNotNull(), cut)


def vision_verdict(answer: Column) -> Column:
    """pass or fail as a verifier's answer says, else inconclusive."""
    said = F.lower(F.get_json_object(balanced_object(F.coalesce(answer, F.lit(""))), "$.verdict"))
    return F.when(said.isin("pass", "fail"), said).otherwise("inconclusive")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What use makes of a value that is told once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def colourbar_range(answer: Column) -> Column:
    """struct(low, high, reason) of a reader's answer about the ends of a colour bar; both are null where it can't be told."""
    found = balanced_object(F.coalesce(answer, F.lit("")))

    def read(x: Column) -> Column:
        raw = [F.get_json_object(x, f"$.{k}") for k in ("min", "max")]
        return F.struct(raw[0].alias("lo"), raw[1].alias("hi"), raw[0].try_cast("double").alias("a"), raw[1].try_cast("double").alias("b"), F.get_json_object(x, "$.reason").alias("why"))

    def told(x: Column) -> Column:
        raw, a, b = (x.lo, x.hi), x.a, x.b
        reason = F.coalesce(F.nullif(x.why, F.lit("")), F.lit("vlm_extracted"))
        numbers = a.isNotNull() & b.isNotNull()
        why = F.when(raw[0].isNull() | raw[1].isNull() | numbers, reason).otherwise("non_numeric_response")
        return F.struct(F.when(numbers, F.least(a, b)).alias("low"), F.when(numbers, F.greatest(a, b)).alias("high"), why.alias("reason"))

    return _once(_once(found, read), told)


def hemisphere(answer: Column, area: Column) -> Column:
    """struct(hemisphere, reason) of a reader's answer about the colour of an area, four whole numbers; unknown where it can't be told."""
    found = balanced_object(F.coalesce(answer, F.lit("")))
    wrong = F.coalesce(F.size(area), F.lit(0)) != 4

    def read(x: Column) -> Column:
        return F.struct(F.lower(F.trim(F.get_json_object(x, "$.hemisphere"))).alias("low"), F.get_json_object(x, "$.reason").alias("why"))

    def told(x: Column) -> Column:
        good = x.low.isin("positive", "negative", "neutral", "unknown")
        reason = text.first_of(
            [(wrong, "bbox_invalid"), (x.low.isNull(), "hemisphere_missing"), (~good, "hemisphere_unrecognized")],
            F.coalesce(F.nullif(x.why, F.lit("")), F.lit("vlm_judgment")),
        )
        failed = reason.isin("bbox_invalid", "hemisphere_missing", "hemisphere_unrecognized")
        return F.struct(F.when(failed, "unknown").otherwise(x.low).alias("hemisphere"), reason.alias("reason"))

    return _once(_once(found, read), told)


def dual_verification(proposals: DataFrame, pixel: DataFrame, vision: DataFrame) -> DataFrame:
    """proposals with pixel_verdict, vision_verdict and the outcome of both.

    pixel(proposal_id, verified, reason_code) and vision(proposal_id, answer)
    stand for the two readers; a missing answer is inconclusive.
    """
    p = pixel.select("proposal_id", gates.pixel_verdict(F.col("verified"), F.col("reason_code")).alias("pixel_verdict"))
    v = vision.select("proposal_id", vision_verdict(F.col("answer")).alias("vision_verdict"))
    both = proposals.join(p, "proposal_id", "left").join(v, "proposal_id", "left").na.fill("inconclusive", ["pixel_verdict", "vision_verdict"])
    return both.withColumn("outcome", gates.consensus(F.col("pixel_verdict"), F.col("vision_verdict"))).select("*", "outcome.*").drop("outcome")


def audit(proposals: DataFrame, figures: DataFrame, colourbars: DataFrame, pixel: DataFrame, vision: DataFrame) -> DataFrame:
    """proposals(proposal_id, figure_id, candidate_r, provenance, ...) with failing_gate, gate_reason and final_verdict.

    The gates come in the order caption, colour bar, range, and the first that
    fails is told; colourbars(proposal_id, passed, reason, low, high) is the
    result of images.colourbar_gate() with the range that was read, -1 to 1
    without one. What passes them goes by both verifiers.
    """
    rows = with_captions(proposals, figures).join(colourbars.select("proposal_id", F.struct("passed", "reason").alias("_bar"), "low", "high"), "proposal_id", "left")
    bar = F.coalesce("_bar", F.struct(F.lit(False).alias("passed"), F.lit("image_missing").alias("reason")))
    low, high = F.coalesce("low", F.lit(-1.0)), F.coalesce("high", F.lit(1.0))
    chain = gates.chain(caption=gates.caption_gate(F.col("caption")), colorbar_detect=bar, range_sanity=gates.range_gate(F.col("candidate_r"), low, high))
    judged = dual_verification(rows.withColumn("_gate", chain), pixel, vision)
    outcome = F.struct("accepted", "needs_review", "rationale")
    return judged.withColumns(
        {"final_verdict": gates.audit_verdict(F.col("_gate"), outcome), "failing_gate": F.col("_gate.failing_gate"), "gate_reason": F.col("_gate.reason")}
    ).drop("_bar", "_gate", "low", "high")


def audit_counts(audited: DataFrame) -> DataFrame:
    """(kind, key, n): verdicts, failing gates, and verdicts by provenance."""
    kinds = F.array(
        F.struct(F.lit("verdict").alias("kind"), F.col("final_verdict").alias("key")),
        F.struct(F.lit("failing_gate").alias("kind"), F.col("failing_gate").alias("key")),
        F.struct(F.lit("by_provenance").alias("kind"), F.concat_ws("|", "provenance", "final_verdict").alias("key")),
    )
    return audited.select(F.inline(F.filter(kinds, lambda x: x["key"].isNotNull()))).groupBy("kind", "key").agg(F.count("*").alias("n"))
