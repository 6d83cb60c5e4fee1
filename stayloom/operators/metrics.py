"""Performance, uncertainty, fairness and contribution statistics of binary predictions.

Predictions are a long table with `y_true` (0/1) and `y_prob`.  Every statistic starts from the
positives and negatives per score, so equal scores are added up before anything is moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.functions.values import quoted
from stayloom.operators.features import md5_number
from stayloom.operators.ordered import cut_points, positions, running_sum

POS, NEG = "pos", "neg"


def with_sides(predictions: DataFrame) -> DataFrame:
    """Add the 0/1 counters `pos` and `neg`."""
    positive = (F.col("y_true") == 1).cast("bigint")
    return predictions.withColumns({POS: positive, NEG: F.lit(1) - positive})


def _ratio(a: Column, b: Column, empty: Column | None = None) -> Column:
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    return ratio if empty is None else F.coalesce(ratio, empty)


def _statistics(cells: DataFrame, by: Sequence[str], cuts: Sequence[float], threshold: float = 0.5) -> DataFrame:
    """The performance statistics from (by, y_prob, pos, neg), in one pass from the top score down.

    Areas are NULL when only one class occurs; tpr and fpr are 0 without positives or negatives.
    """
    falling = running_sum(cells, by, "y_prob", [POS, NEG], descending=True, cuts=cuts)
    positives, negatives = F.sum(POS), F.sum(NEG)
    chosen = F.col("y_prob") > threshold
    tp, fp = (F.sum(F.when(chosen, F.col(c)).otherwise(F.lit(0))) for c in (POS, NEG))
    # Pairs ranked wrongly: a negative above a positive, or half of one at the same score.
    wrong = F.sum(F.col(POS) * (F.col("cum_neg") - F.col(NEG) / 2.0))
    gained = F.col(POS) * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return falling.groupBy(*by).agg(
        (1 - _ratio(wrong, positives.cast("double") * negatives.cast("double"))).alias("auroc"),
        _ratio(tp + negatives - fp, positives + negatives).alias("accuracy"),
        _ratio(tp, positives, F.lit(0.0)).alias("tpr"),
        _ratio(fp, negatives, F.lit(0.0)).alias("fpr"),
        F.when(negatives > 0, _ratio(F.sum(gained), positives)).alias("auprc"),
    )


def auroc(predictions: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Area under the ROC curve; equal scores count half. NULL when only one class occurs."""
    sides = with_sides(predictions)
    area = _statistics(sides, by, cut_points(predictions, "y_prob"))
    return area.select(*by, F.round("auroc", digits).alias("auroc"))


def auprc(predictions: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Average precision: precision at each score, weighted by the recall gained there."""
    sides = with_sides(predictions)
    area = _statistics(sides, by, cut_points(predictions, "y_prob"))
    return area.select(*by, F.round("auprc", digits).alias("auprc"))


def confusion(
    predictions: DataFrame, by: Sequence[str] = (), threshold: float = 0.5, inclusive: bool = False
) -> DataFrame:
    """Counts and rates at a threshold, which itself counts as positive only if `inclusive`.

    Rates without a denominator are NULL.
    """
    score = F.col("y_prob")
    chosen = (score >= threshold) if inclusive else (score > threshold)
    sides = with_sides(predictions)

    def count(side: str, hit: Column) -> Column:
        return F.sum(F.when(hit, F.col(side)).otherwise(F.lit(0)))

    counts = sides.groupBy(*by).agg(
        count(POS, chosen).alias("tp"), count(NEG, chosen).alias("fp"),
        count(NEG, ~chosen).alias("tn"), count(POS, ~chosen).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        *by, "tp", "fp", "tn", "fn",
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fn).alias("tpr"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(tp + fp, tp + fp + tn + fn).alias("selection_rate"),
    )


METRICS = ["auroc", "accuracy", "tpr", "fpr", "auprc"]


def performance(
    predictions: DataFrame, by: Sequence[str] = (), threshold: float = 0.5, digits: int = 6
) -> DataFrame:
    """The five performance statistics of each group."""
    values = _statistics(with_sides(predictions), by, cut_points(predictions, "y_prob"), threshold)
    return values.select(*by, *[F.round(m, digits).alias(m) for m in METRICS])


def bootstrap_draws(n_rows: int, replicates: int, spark, seed: int = 0) -> DataFrame:
    """(replicate, position): for each replicate `n_rows` row numbers drawn with replacement."""
    draws = spark.range(replicates * n_rows)
    drawn = md5_number(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), digits=15) % n_rows
    return draws.select(F.floor(F.col("id") / n_rows).alias("replicate"), (drawn + 1).alias("position"))


def bootstrap(
    predictions: DataFrame,
    by: Sequence[str] = (),
    key: str = "stay_id",
    replicates: int = 1000,
    alpha: float = 0.95,
    threshold: float = 0.5,
    seed: int = 0,
    digits: int = 6,
) -> DataFrame:
    """(by, metric, value, lower, upper): each statistic with its bootstrap interval.

    Rows are numbered in key order and drawn by number with a seeded hash; all groups of `by`
    must cover the same keys and share the draws.  Draws are added up per (replicate, score)
    before they are ordered.  Replicates with one class only have no areas and are left out there.
    """
    rows = predictions.select(*by, key, "y_true", "y_prob")
    cuts = cut_points(rows, "y_prob")
    keys = rows.select(key).distinct()
    numbered = with_sides(rows.join(positions(keys, key, cuts=cut_points(rows, key)), key))
    draws = bootstrap_draws(keys.count(), replicates, predictions.sparkSession, seed)
    cells = draws.join(numbered, "position").groupBy(*by, "replicate", "y_prob").agg(
        F.sum(POS).alias(POS), F.sum(NEG).alias(NEG)
    )
    per_draw = _statistics(cells, [*by, "replicate"], cuts, threshold)
    values = _statistics(with_sides(rows), by, cuts, threshold)

    low, high = (1.0 - alpha) / 2.0, (1.0 + alpha) / 2.0
    spread = _long(per_draw, [*by, "replicate"]).groupBy(*by, "metric").agg(
        F.percentile("value", F.lit(low)).alias("lower"), F.percentile("value", F.lit(high)).alias("upper")
    )
    return _long(values, by).join(spread, [*by, "metric"]).select(
        *by, "metric", *[F.round(c, digits).alias(c) for c in ("value", "lower", "upper")]
    )


def _long(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    return metrics.unpivot([quoted(c) for c in by], [quoted(m) for m in METRICS], "metric", "value")


def performance_table(intervals: DataFrame, by: Sequence[str] = ("models", "mix")) -> DataFrame:
    """One row per model and modality mix with each statistic as text `m[lower, upper]`."""
    shown = F.format_string("%.4f[%.4f, %.4f]", F.col("value"), F.col("lower"), F.col("upper"))
    names = [("auroc", "AUROC"), ("accuracy", "Accuracy"), ("tpr", "TPR"), ("fpr", "FPR"), ("auprc", "AUPRC")]
    return intervals.groupBy(*by).agg(
        *[F.max(F.when(F.col("metric") == metric, shown)).alias(label) for metric, label in names]
    )


def best_model(predictions: DataFrame, model: str = "model") -> DataFrame:
    """The model with the highest AUROC; the first name among equals."""
    areas = auroc(predictions, [model], digits=12)
    return areas.where("auroc IS NOT NULL").orderBy(F.col("auroc").desc(), F.col(model)).limit(1)


# --- fairness -----------------------------------------------------------------------------------


def by_feature(predictions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Predictions once per sensitive feature, as (feature, group, y_true, y_prob)."""
    df = predictions.select("y_true", "y_prob", *[quoted(f).cast("string").alias(f) for f in features])
    return df.unpivot(["y_true", "y_prob"], [quoted(f) for f in features], "feature", "group").where(
        F.col("group").isNotNull()
    )


def subgroup_metrics(
    predictions: DataFrame, features: Sequence[str], threshold: float = 0.5, digits: int = 6
) -> DataFrame:
    """AUROC, accuracy, TPR, FPR and selection rate of every group of every feature."""
    rows = by_feature(predictions, features)
    by = ["feature", "group"]
    area = _statistics(with_sides(rows), by, cut_points(predictions, "y_prob")).select(*by, "auroc")
    rates = confusion(rows, by, threshold, inclusive=True)
    joined = rates.join(area, by)
    return joined.select(
        *by, *[F.round(c, digits).alias(c) for c in ("auroc", "accuracy", "tpr", "fpr", "selection_rate")]
    )


def fairness_ratios(
    predictions: DataFrame, features: Sequence[str], threshold: float = 0.5, digits: int = 6
) -> DataFrame:
    """Demographic parity and equalised odds ratios of each feature: smallest over largest rate.

    A rate that is 0 in every group has no ratio.
    """
    rates = confusion(by_feature(predictions, features), ["feature", "group"], threshold, inclusive=True)

    def ratio(c: str) -> Column:
        return _ratio(F.min(c), F.max(c))

    return rates.groupBy("feature").agg(
        F.round(ratio("selection_rate"), digits).alias("demographic_parity"),
        F.round(F.least(ratio("tpr"), ratio("fpr")), digits).alias("equalized_odds"),
    )


def fairness_report(predictions: DataFrame, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Subgroup statistics with the ratios of their feature."""
    return subgroup_metrics(predictions, features, threshold).join(
        fairness_ratios(predictions, features, threshold), "feature"
    )


# --- contribution -------------------------------------------------------------------------------


def _modality_sums(modalities: Mapping[str, Sequence[str]], value) -> dict[str, Column]:
    return {m: sum((value(c) for c in columns), F.lit(0.0)) for m, columns in modalities.items()}


def modality_contribution(
    features: DataFrame,
    coefficients: Mapping[str, float],
    modalities: Mapping[str, Sequence[str]],
    digits: int = 6,
) -> DataFrame:
    """(modality, contribution): summed |Σ value · coefficient| of each modality, as shares of 1."""
    sums = _modality_sums(modalities, lambda c: quoted(c).cast("double") * F.lit(coefficients[c]))
    totals = features.agg(*[F.sum(F.abs(s)).alias(m) for m, s in sums.items()])
    whole = sum((quoted(m) for m in modalities), F.lit(0.0))
    shares = totals.select(*[F.round(_ratio(quoted(m), whole), digits).alias(m) for m in modalities])
    return shares.unpivot([], [quoted(m) for m in modalities], "modality", "contribution")


def block_contribution(
    fused: DataFrame, coefficients: Mapping[str, Sequence[float]], digits: int = 6
) -> DataFrame:
    """`modality_contribution` for feature arrays: one array column and its coefficients per modality."""

    def total(block: str) -> Column:
        weights = F.array(*[F.lit(float(c)) for c in coefficients[block]])
        products = F.zip_with(F.col(block), weights, lambda x, c: x * c)
        return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)

    sums = fused.select(*[total(b).alias(b) for b in coefficients])
    return modality_contribution(sums, {b: 1.0 for b in coefficients}, {b: [b] for b in coefficients}, digits)


def grouped_attribution(
    attributions: DataFrame, modalities: Mapping[str, Sequence[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Attribution values summed within each modality, one row per prediction."""
    sums = _modality_sums(modalities, lambda c: quoted(c).cast("double"))
    return attributions.select(*[quoted(c) for c in keep], *[s.alias(m) for m, s in sums.items()])


def attribution_contribution(grouped: DataFrame, modalities: Sequence[str], digits: int = 6) -> DataFrame:
    """(modality, contribution): mean absolute attribution."""
    means = grouped.agg(*[F.round(F.avg(F.abs(quoted(m))), digits).alias(m) for m in modalities])
    return means.unpivot([], [quoted(m) for m in modalities], "modality", "contribution")
