"""Evaluation statistics over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayloom.driver.registry import query
from stayloom.driver.views import Views
from stayloom.operators import metrics

SENSITIVE = ["lang", "source", "size_group"]


def _cells(source: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""
        SELECT {keys}y_prob, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
        FROM {source} GROUP BY {keys}y_prob"""


def _statistics(source: str, by: str = "", digits: int = 6) -> str:
    """All five statistics per group from the rows of `source`."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
        SELECT {keys}round(auroc, {digits}) AS auroc, round(accuracy, {digits}) AS accuracy, round(tpr, {digits}) AS tpr,
               round(fpr, {digits}) AS fpr, round(auprc, {digits}) AS auprc
        FROM (SELECT {keys}
                     sum(pos * (neg_below + neg / 2)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auroc,
                     sum(CASE WHEN y_prob > 0.5 THEN pos ELSE neg END) / CAST(sum(pos + neg) AS DOUBLE) AS accuracy,
                     coalesce(sum(CASE WHEN y_prob > 0.5 THEN pos ELSE 0 END) / nullif(CAST(sum(pos) AS DOUBLE), 0), 0) AS tpr,
                     coalesce(sum(CASE WHEN y_prob > 0.5 THEN neg ELSE 0 END) / nullif(CAST(sum(neg) AS DOUBLE), 0), 0) AS fpr,
                     CASE WHEN sum(neg) > 0 THEN sum(pos * top_pos / (top_pos + top_neg)) / nullif(CAST(sum(pos) AS DOUBLE), 0) END AS auprc
              FROM (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY y_prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
                           CAST(sum(pos) OVER ({part} ORDER BY y_prob DESC) AS DOUBLE) AS top_pos,
                           CAST(sum(neg) OVER ({part} ORDER BY y_prob DESC) AS DOUBLE) AS top_neg
                    FROM ({_cells(source, by)})) {group})"""


@query("auroc", f"SELECT auroc FROM ({_statistics('predictions')})", ["predictions"])
def _(v: Views):
    return metrics.auroc(v["predictions"])


@query("auprc", f"SELECT auprc FROM ({_statistics('predictions')})", ["predictions"])
def _(v: Views):
    return metrics.auprc(v["predictions"])


@query("performance", _statistics("mix_predictions", "mix"), ["mix_predictions"])
def _(v: Views):
    return metrics.performance(v["mix_predictions"], ["mix"])


def _rates(source: str, by: str, sign: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
        SELECT {keys}tp, fp, tn, fn, round((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS accuracy,
               round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS tpr,
               round(fp / nullif(CAST(fp + tn AS DOUBLE), 0), 6) AS fpr,
               round((tp + fp) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS selection_rate
        FROM (SELECT {keys}count(*) FILTER (WHERE y_true = 1 AND y_prob {sign} 0.5) AS tp,
                     count(*) FILTER (WHERE y_true = 0 AND y_prob {sign} 0.5) AS fp,
                     count(*) FILTER (WHERE y_true = 0 AND NOT y_prob {sign} 0.5) AS tn,
                     count(*) FILTER (WHERE y_true = 1 AND NOT y_prob {sign} 0.5) AS fn
              FROM {source} {group})"""


@query("confusion_metrics", _rates("predictions", "", ">"), ["predictions"])
def _(v: Views):
    rates = metrics.confusion(v["predictions"])
    return rates.withColumns({c: F.round(c, 6) for c in ("accuracy", "tpr", "fpr", "selection_rate")})


# --- bootstrap ----------------------------------------------------------------------------------

REPLICATES = 1000
NAMES = metrics.METRICS


def _bootstrap(source: str, by: str) -> str:
    keys = f"{by}, "
    same = " AND ".join(f"v.{k.strip()} = s.{k.strip()}" for k in by.split(","))
    shown = ", ".join(f"v.{k.strip()}" for k in by.split(","))
    values = " UNION ALL ".join(f"SELECT {keys}'{m}' AS metric, {m} AS value FROM whole" for m in NAMES)
    drawn = " UNION ALL ".join(f"SELECT {keys}'{m}' AS metric, {m} AS value FROM per_draw" for m in NAMES)
    return f"""
        WITH keyed AS (SELECT stay_id, row_number() OVER (ORDER BY stay_id) AS position FROM (SELECT DISTINCT stay_id FROM {source})),
             size AS (SELECT count(*) AS n FROM keyed),
             draws AS (SELECT i // n AS replicate, CAST(('0x' || substr(md5('0:' || i), 1, 15)) AS BIGINT) % n + 1 AS position
                       FROM size, unnest(range({REPLICATES} * n)) AS t(i)),
             sampled AS (SELECT p.*, d.replicate FROM draws d JOIN keyed k ON d.position = k.position
                         JOIN {source} p ON k.stay_id = p.stay_id),
             per_draw AS ({_statistics("sampled", keys + "replicate", 15)}),
             whole AS ({_statistics(source, by, 15)}),
             spread AS (SELECT {keys}metric, quantile_cont(value, 0.025) AS lower, quantile_cont(value, 0.975) AS upper
                        FROM ({drawn}) WHERE value IS NOT NULL GROUP BY {keys}metric)
        SELECT {shown}, v.metric, round(v.value, 6) AS value, round(s.lower, 6) AS lower, round(s.upper, 6) AS upper
        FROM ({values}) v JOIN spread s ON {same} AND v.metric = s.metric"""


@query("bootstrap_ci", _bootstrap("mix_predictions", "mix"), ["mix_predictions"])
def _(v: Views):
    return metrics.bootstrap(v["mix_predictions"], ["mix"], replicates=REPLICATES)


@query(
    "perf_table",
    "SELECT models, mix, "
    + ", ".join(
        f"""max(CASE WHEN metric = '{m}' THEN printf('%.4f[%.4f, %.4f]', value, lower, upper) END) AS "{label}" """
        for m, label in (("auroc", "AUROC"), ("accuracy", "Accuracy"), ("tpr", "TPR"), ("fpr", "FPR"), ("auprc", "AUPRC"))
    )
    + f"FROM ({_bootstrap('mix_predictions', 'models, mix')}) GROUP BY models, mix",
    ["mix_predictions"],
)
def _(v: Views):
    by = ["models", "mix"]
    return metrics.performance_table(metrics.bootstrap(v["mix_predictions"], by, replicates=REPLICATES), by)


@query(
    "best_model",
    f"SELECT mix AS model, round(auroc, 6) AS auroc FROM ({_statistics('mix_predictions', 'mix', 12)}) ORDER BY auroc DESC, mix LIMIT 1",
    ["mix_predictions"],
)
def _(v: Views):
    best = metrics.best_model(v["mix_predictions"].withColumnRenamed("mix", "model"))
    return best.select("model", F.round("auroc", 6).alias("auroc"))


# --- fairness -----------------------------------------------------------------------------------

LONG = " UNION ALL ".join(
    f"""SELECT y_true, y_prob, '{f}' AS feature, {f} AS "group" FROM predictions WHERE {f} IS NOT NULL""" for f in SENSITIVE
)
SUBGROUPS = f"""
    SELECT r.feature, r."group", s.auroc, r.accuracy, r.tpr, r.fpr, r.selection_rate
    FROM ({_rates("long", 'feature, "group"', ">=")}) r
    JOIN ({_statistics("long", 'feature, "group"')}) s ON r.feature = s.feature AND r."group" = s."group" """
RATIOS = f"""
    SELECT feature, round(min(sel) / nullif(max(sel), 0), 6) AS demographic_parity,
           round(least(min(tpr) / nullif(max(tpr), 0), min(fpr) / nullif(max(fpr), 0)), 6) AS equalized_odds
    FROM (SELECT feature, (tp + fp) / CAST(tp + fp + tn + fn AS DOUBLE) AS sel,
                 tp / nullif(CAST(tp + fn AS DOUBLE), 0) AS tpr, fp / nullif(CAST(fp + tn AS DOUBLE), 0) AS fpr
          FROM ({_rates("long", 'feature, "group"', ">=")}))
    GROUP BY feature"""


@query("subgroup_metrics", f"WITH long AS ({LONG}) {SUBGROUPS}", ["predictions"])
def _(v: Views):
    return metrics.subgroup_metrics(v["predictions"], SENSITIVE)


@query("demographic_parity", f"WITH long AS ({LONG}) SELECT feature, demographic_parity FROM ({RATIOS})", ["predictions"])
def _(v: Views):
    return metrics.fairness_ratios(v["predictions"], SENSITIVE).select("feature", "demographic_parity")


@query("equalized_odds", f"WITH long AS ({LONG}) SELECT feature, equalized_odds FROM ({RATIOS})", ["predictions"])
def _(v: Views):
    return metrics.fairness_ratios(v["predictions"], SENSITIVE).select("feature", "equalized_odds")


@query(
    "fairness_report",
    f"""WITH long AS ({LONG}) SELECT g.*, r.demographic_parity, r.equalized_odds
        FROM ({SUBGROUPS}) g JOIN ({RATIOS}) r ON g.feature = r.feature""",
    ["predictions"],
)
def _(v: Views):
    return metrics.fairness_report(v["predictions"], SENSITIVE)


# --- contribution -------------------------------------------------------------------------------

COEFFICIENTS = {"l_quantity": 0.02, "l_extendedprice": -0.00001, "l_discount": 4.0, "l_tax": -2.5}
MODALITIES = {"tabular": ["l_quantity", "l_extendedprice"], "image": ["l_discount"], "text": ["l_tax"]}


def _sum(columns, weighted: bool) -> str:
    return " + ".join(f"{c} * CAST({COEFFICIENTS[c]} AS DOUBLE)" if weighted else c for c in columns)


_TOTALS = ", ".join(f"sum(abs({_sum(cs, True)})) AS {m}" for m, cs in MODALITIES.items())


@query(
    "modality_contribution",
    f"WITH t AS (SELECT {_TOTALS} FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS modality, round({m} / ({' + '.join(MODALITIES)}), 6) AS contribution FROM t" for m in MODALITIES
    ),
)
def _(v: Views):
    return metrics.modality_contribution(v["lineitem"], COEFFICIENTS, MODALITIES)


_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "grouped_attribution",
    f"SELECT {', '.join(_KEYS)}, "
    + ", ".join(f"round({_sum(cs, False)}, 6) AS {m}" for m, cs in MODALITIES.items())
    + " FROM lineitem",
)
def _(v: Views):
    grouped = metrics.grouped_attribution(v["lineitem"], MODALITIES, _KEYS)
    return grouped.withColumns({m: F.round(m, 6) for m in MODALITIES})


@query(
    "attribution_contribution",
    " UNION ALL ".join(
        f"SELECT '{m}' AS modality, round(avg(abs({_sum(cs, False)})), 6) AS contribution FROM lineitem"
        for m, cs in MODALITIES.items()
    ),
)
def _(v: Views):
    return metrics.attribution_contribution(metrics.grouped_attribution(v["lineitem"], MODALITIES), list(MODALITIES))
