"""Gates that a figure reading passes, as typed results: struct(passed, reason)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text, vocab

NEAR_ZERO = 0.10


def _gate(passed: Column, reason: Column) -> Column:
    return F.struct(passed.alias("passed"), reason.alias("reason"))


def _typed(good: str, *cases: tuple[Column, str]) -> Column:
    reason = text.first_of(cases, good)
    return _gate(reason == good, reason)


def caption_gate(caption: Column) -> Column:
    """Passes if a caption tells of a correlation and of no other quantity."""
    low = F.lower(F.coalesce(caption, F.lit("")))
    return _typed(
        "correlation_vocabulary_matched",
        (F.trim(low) == "", "caption_missing"),
        (low.rlike(text.any_of(vocab.CAPTION_NEGATIVE)), "non_r_quantity_indicated"),
        (~low.rlike(text.any_of(vocab.CAPTION_POSITIVE)), "no_correlation_vocabulary"),
    )


def range_gate(r: Column, low: Column | float = -1.0, high: Column | float = 1.0, tolerance: float = 0.05) -> Column:
    bound = F.greatest(F.abs(low if isinstance(low, Column) else F.lit(low)), F.abs(high if isinstance(high, Column) else F.lit(high))) + tolerance
    return _typed("within_range", (r.isNull(), "proposed_r_missing"), (F.abs(r) > bound, "out_of_range"))


def sign_gate(r: Column, hemisphere: Column, near_zero: float = NEAR_ZERO) -> Column:
    """Fails where a colour's hemisphere contradicts the sign of r; weak or unknown readings pass."""
    seen = F.lower(F.trim(F.coalesce(hemisphere, F.lit(""))))
    sign = F.when(F.abs(r) < near_zero, "neutral").when(r > 0, "positive").otherwise("negative")
    reason = text.first_of(
        [
            (r.isNull(), "proposed_r_missing"),
            (~seen.isin("positive", "negative", "neutral", "unknown"), "observed_hemisphere_unrecognized_pass"),
            (seen.isin("neutral", "unknown") | (sign == "neutral"), "near_zero_or_inconclusive_pass"),
            (sign == seen, "sign_agrees"),
        ],
        "sign_disagrees",
    )
    return _gate(~reason.isin("proposed_r_missing", "sign_disagrees"), reason)


def chain(**gates: Column) -> Column:
    """struct(passed, failing_gate, reason) of gates in their order: the first that fails."""
    cases = [(~g["passed"], F.struct(F.lit(False).alias("passed"), F.lit(name).alias("failing_gate"), g["reason"].alias("reason"))) for name, g in gates.items()]
    empty = F.lit(None).cast("string")
    return text.first_of(cases, F.struct(F.lit(True).alias("passed"), empty.alias("failing_gate"), empty.alias("reason")))


def pixel_verdict(verified: Column, reason: Column) -> Column:
    unsure = reason.isin("legend_not_found", "insufficient_colored_pixels", "r_out_of_range", "proposed_r_missing")
    return F.when(F.coalesce(verified, F.lit(False)), "pass").when(F.coalesce(unsure, F.lit(False)), "inconclusive").otherwise("fail")


def consensus(pixel: Column, vision: Column) -> Column:
    """struct(accepted, needs_review, rationale): both pass, both fail, or review."""
    p, v = pixel == "pass", vision == "pass"
    told = F.concat(F.lit("pixel="), pixel, F.lit(",vision="), vision)
    rationale = (
        F.when(p & v, "both_verifiers_pass")
        .when((pixel == "fail") & (vision == "fail"), "both_verifiers_reject")
        .when(p | v, F.concat(F.lit("verifier_disagreement:"), told))
        .otherwise(F.concat(F.lit("inconclusive:"), told))
    )
    return F.struct((p & v).alias("accepted"), (~rationale.isin("both_verifiers_pass", "both_verifiers_reject")).alias("needs_review"), rationale.alias("rationale"))


def audit_verdict(gate: Column, outcome: Column, error: Column | None = None) -> Column:
    """ACCEPT, REVIEW, REJECT_GATE, REJECT_DUAL or ERROR."""
    cases = [(~gate["passed"], "REJECT_GATE"), (outcome["accepted"], "ACCEPT"), (outcome["needs_review"], "REVIEW")]
    return text.first_of(([(error.isNotNull(), "ERROR")] if error is not None else []) + cases, "REJECT_DUAL")


def forest_plot(effect: Column, lower: Column, upper: Column, kind: Column) -> Column:
    """struct(verified, reason, min_abs_error): an interval must leave out 1 for ratios and 0 otherwise."""
    null = F.when(kind.isin("odds_ratio", "hazard_ratio"), 1.0).otherwise(0.0)
    missing = lower.isNull() | upper.isNull()
    crosses = (lower <= null) & (null <= upper)
    reason = F.when(missing, "missing_ci").when(crosses, "ci_crosses_null").otherwise("ci_excludes_null")
    return F.struct((reason == "ci_excludes_null").alias("verified"), reason.alias("reason"), F.when(~missing, F.abs(effect - null)).alias("min_abs_error"))
