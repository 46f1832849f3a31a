"""Scoring of predictions against gold labels, agreement, calibration, and stratified samples."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import positions
from .relations import first_by

ASSOCIATED = ("positive", "negative", "associated")


def gold_binary(label: Column, associated: Sequence[str] = ASSOCIATED) -> Column:
    """true for an association, false for none; null for unclear and unlabelled rows. Labels of the gold set are vocab.ASSOCIATED_LABELS."""
    return F.when(label.isin(*associated), True).when(label.isNotNull() & (label != "unclear"), False)


def confusion(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f1 over rows(gold, predicted), for all rows and by each column of by on its own.

    scope names the column, all for all rows, and value its value. One pass
    over the rows; divisions by nothing give 0; figures are rounded to 4.
    """
    known = rows.where(F.col("gold").isNotNull())
    scopes = F.array(F.struct(F.lit("all").alias("scope"), F.lit("").alias("value")),
        *[F.struct(F.lit(b).alias("scope"), F.coalesce(F.col(b).cast("string"), F.lit("none")).alias("value")) for b in by])
    counts = known.select("gold", "predicted", F.explode(scopes).alias("s")).groupBy("s.scope", "s.value").agg(
        F.count_if(F.col("gold") & F.col("predicted")).alias("tp"),
        F.count_if(~F.col("gold") & F.col("predicted")).alias("fp"),
        F.count_if(F.col("gold") & ~F.col("predicted")).alias("fn"),
        F.count_if(~F.col("gold") & ~F.col("predicted")).alias("tn"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumns({"precision": F.round(p, 4), "recall": F.round(r, 4), "f1": F.round(ratio(2 * p * r, p + r), 4)})


def predict(gold: DataFrame, accepted: DataFrame) -> DataFrame:
    """gold with predicted: whether (pmid, microbe in lower case, feature) is an accepted edge; the inferred feature comes first."""
    keys = accepted.select(F.col("pmid").alias("_p"), F.lower(F.trim("microbe")).alias("_m"), F.col("feature").alias("_f")).distinct().withColumn("_hit", F.lit(True))
    feature = F.coalesce(F.when(F.col("inferred_feature_canonical") != "", F.col("inferred_feature_canonical")), F.col("candidate_feature_canonical"))
    on = (F.col("pmid") == F.col("_p")) & (F.lower(F.trim("microbe")) == F.col("_m")) & (feature == F.col("_f"))
    return gold.join(keys, on, "left").withColumn("predicted", F.coalesce("_hit", F.lit(False))).drop("_p", "_m", "_f", "_hit")


def label_distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(F.coalesce(label, F.lit("unlabelled")).alias("label")).agg(F.count("*").alias("n"))


def kappa(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (n, observed, expected, kappa) for two labels per row; nulls are left out, no rows give NaN, chance of 1 gives 1."""
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("a"),
        F.col(b).cast("string").alias("b")).agg(F.count("*").alias("n"))
    marginal = both.select(F.inline(F.array(F.struct(F.col("a").alias("l"), F.col("n").alias("x"), F.lit(0).cast("bigint").alias("y")),
        F.struct(F.col("b").alias("l"), F.lit(0).cast("bigint").alias("x"), F.col("n").alias("y")))))
    chance = marginal.groupBy("l").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).agg(F.sum(F.col("x").cast("double") * F.col("y")).alias("xy"))
    total = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).alias("same"))
    out = total.crossJoin(chance)  # one row each
    n = F.col("n")
    po, pe = F.col("same") / n, F.col("xy") / (n * n)
    k = F.when(n == 0, F.lit(float("nan"))).otherwise(F.when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe)))
    some = lambda x: F.when(n > 0, F.round(x, 6))
    return out.select("n", some(po).alias("observed"), some(pe).alias("expected"), F.when(n > 0, F.round(k, 6)).otherwise(k).alias("kappa"))


def calibrate(rows: DataFrame, precision: float = 0.9, min_recall: float = 0.0, least: float = -1.0, most: float = 1.0) -> DataFrame:
    """Thresholds of a score that reach a precision, best first: (threshold, precision, recall, n_kept).

    rows(score, gold), scores between least and most. Thresholds are the
    distinct scores rounded to 4; rows are kept from the threshold on by their
    unrounded score. Counts are taken by threshold first, combined before the
    shuffle: of a grid of 10,000 steps a unit no more meet in the task that sums
    them from above than the grid has, however many rows there are.
    """
    scores = rows.where(F.col("score").isNotNull())
    # The lowest grid point that a row is kept at reaches up to its score: it may be the one below its own rounding.
    up = F.round("score", 4)
    at = F.when(F.col("score") >= up, up).otherwise(F.round(up - 0.0001, 4))
    counts = scores.groupBy(F.greatest(F.lit(least - 1), F.least(at, F.lit(most))).alias("t")).agg(F.count("*").alias("n"), F.count_if("gold").alias("g"),
        F.lit(0).alias("is_t"))
    grid = scores.select(up.alias("t")).distinct().select("t", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("g"), F.lit(1).alias("is_t"))
    steps = counts.unionByName(grid)
    down = Window.orderBy(F.col("t").desc(), "is_t").rowsBetween(Window.unboundedPreceding, 0)
    summed = steps.withColumns({"n_kept": F.sum("n").over(down), "tp": F.sum("g").over(down)}).where("is_t = 1")
    positives = scores.agg(F.count_if("gold").alias("all_positive"))
    out = summed.crossJoin(F.broadcast(positives)).where("n_kept > 0")  # one row
    p = F.col("tp") / F.col("n_kept")
    r = F.when(F.col("all_positive") > 0, F.col("tp") / F.col("all_positive")).otherwise(0.0)
    good = out.select(F.col("t").alias("threshold"), p.alias("precision"), r.alias("recall"), "n_kept")
    return good.where((F.col("precision") >= precision) & (F.col("recall") >= min_recall)).orderBy(F.col("recall").desc(), "threshold")


def stratified_sample(rows: DataFrame, stratum: str, key: str, targets: dict[str, int] | int, seed: int = 42) -> DataFrame:
    """Rows of each stratum in the order of sha1(seed|key), up to its target: a sample by design, the same in every run."""
    h = F.sha1(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(stratum).orderBy(h, key)))
    if isinstance(targets, int):
        most = F.lit(targets)
    else:
        most = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in targets.items() for x in p]), F.col(stratum)), F.lit(0))
    return ranked.where(F.col("_n") <= most).drop("_n")


def generator_sample(rows: DataFrame, target: int, rng: random.Random, *order: str) -> DataFrame:
    """target rows of a table, those that Python's rng.sample() picks of a list in this order; all of a table of no more, without a draw.

    Which positions are drawn depends on the count alone, so they are drawn on
    the driver and looked up; the draws of one generator go on from table to
    table, as they do from list to list.
    """
    n = rows.count()
    if n <= target:
        return rows
    drawn = rows.sparkSession.createDataFrame([(p,) for p in rng.sample(range(n), target)], "_at bigint")  # target rows
    return positions(rows, "_at", *order).join(F.broadcast(drawn), "_at").drop("_at")


def gold_strata(strata: Sequence[tuple[str, DataFrame]], key: str = "record_id") -> DataFrame:
    """Candidates of several strata with their stratum; a key that an earlier stratum has is left out of later ones."""
    out = None
    for i, (name, df) in enumerate(strata):
        part = df.withColumns({"stratum": F.lit(name), "_i": F.lit(i)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    first = out.groupBy(F.col(key).alias("_k")).agg(F.min("_i").alias("_f"))
    kept = out.join(first, (F.col(key) == F.col("_k")) & (F.col("_i") == F.col("_f"))).drop("_k", "_f", "_i")
    return first_by(kept, [key], *[F.col(c).cast("string") for c in sorted(kept.columns)])


def override_labels(gold: DataFrame, overrides: DataFrame, key: str = "record_id") -> DataFrame:
    o = overrides.select(F.col(key).alias("_k"), F.col("label").alias("_l"))
    return gold.join(o, F.col(key) == F.col("_k"), "left").withColumn("label", F.coalesce("_l", "label")).drop("_k", "_l")
