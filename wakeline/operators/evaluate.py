"""Evaluation metrics as aggregates: one pass over the scored rows, then arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wakeline.operators.layout import detect
from wakeline.operators.scan import _with_key, running_sum, scan
from wakeline.session import stored


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def confusion(df: DataFrame, keys: Sequence[str] = (), label: str = "y", pred: str = "pred") -> DataFrame:
    """tp, tn, fp, fn and the unlabelled rows (label -1)."""
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if(y == -1).alias("unlabeled"),
    )


def binary_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, specificity, accuracy and MCC from a confusion table."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    product = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "specificity": _ratio(tn, tn + fp),
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
            "mcc": _ratio(tp * tn - fp * fn, product),
        }
    )


def class_report(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support for classes 0 and 1, macro and weighted averages, accuracy."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    zero = (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn), tn + fp)
    one = (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn), tp + fn)
    support = zero[3] + one[3]
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_ratio(a * zero[3] + b * one[3], support) for a, b in zip(zero[:3], one[:3])]
    accuracy = _ratio(tp + tn, support)
    table = {
        "0": zero,
        "1": one,
        "accuracy": (accuracy, accuracy, accuracy, support),
        "macro avg": (*macro, support),
        "weighted avg": (*weighted, support),
    }
    rows = [
        F.struct(
            F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.cast("bigint").alias("support")
        )
        for name, (p, r, f, s) in table.items()
    ]
    return counts.select(*keys, F.inline(F.array(*rows)))


def roc_auc(df: DataFrame, keys: Sequence[str] = (), label: str = "y", score: str = "score", **options) -> DataFrame:
    """Area under the ROC curve by rank sums over per-score counts (ties count half); 0 for one class.

    Sorting happens on distinct scores, and a long score list is cut into chunks.
    """
    keyed, group = _with_key(df, keys)
    counts = keyed.groupBy(*group, score).agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    counts = stored(counts, "counts")  # the layout and the scan read them several times
    layout = detect(counts, group, [score], **options)
    ranked = scan(counts, layout, _below=running_sum("_neg", before=True))
    wins = F.col("_pos") * (F.coalesce("_below", F.lit(0)) + F.col("_neg") / 2)
    sums = ranked.groupBy(*group).agg(F.sum(wins).alias("_wins"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    pairs = F.col("_p").cast("double") * F.col("_n")
    return sums.select(*keys, _ratio(F.col("_wins"), pairs).alias("auc"))


def count_below(value: Column, grid: Column, size: int) -> Column:
    """How many entries of a sorted array are below the value, by binary search."""
    steps, step = [], 1
    while step <= size:
        steps.append(step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda low, s: F.when(F.get(grid, low + s - 1) < value, low + s).otherwise(low),
    )


def threshold_scan(
    df: DataFrame, taus: Sequence[float] | str, keys: Sequence[str] = (), label: str = "y", score: str = "score", size: int | None = None
) -> DataFrame:
    """Confusion counts and F1 of ``score > tau`` for every tau of an ascending grid, in one pass.

    ``taus`` is a list, or the name of an array column holding each group's own grid of ``size``
    entries. A row is counted once, by how many taus its score exceeds; the counts for every tau
    are sums over that short list, so rows are not multiplied by the grid.
    """
    own = isinstance(taus, str)
    size = size if own else len(taus)
    grid = F.col(taus) if own else F.array(*[F.lit(float(t)) for t in taus])
    keyed, group = _with_key(df, keys)
    passed = keyed.withColumn("_passed", count_below(F.col(score), grid, size))
    carried = [F.first(grid).alias("_grid")] if own else []
    counts = passed.groupBy(*group, "_passed").agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"), *carried
    )
    # At most size + 1 rows per group from here on.
    per_group = counts.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("_passed", F.struct("_pos", "_neg").alias("c")))).alias("_by"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
        *([F.first("_grid").alias("_grid")] if own else []),
    )
    each = per_group.select(*group, "_p", "_n", "_by", F.posexplode(F.col("_grid") if own else grid).alias("tau_index", "tau"))
    each = each.withColumns(
        {
            "_pos": F.coalesce(F.col("_by")[F.col("tau_index") + 1]["_pos"], F.lit(0)),
            "_neg": F.coalesce(F.col("_by")[F.col("tau_index") + 1]["_neg"], F.lit(0)),
        }
    )
    from_top = Window.partitionBy(*group).orderBy(F.desc("tau_index")).rowsBetween(Window.unboundedPreceding, 0)
    swept = each.withColumn("tp", F.sum("_pos").over(from_top)).withColumn("fp", F.sum("_neg").over(from_top))
    fn = F.col("_p") - F.col("tp")
    f1 = _ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + fn)
    return swept.select(*keys, "tau_index", "tau", "tp", "fp", fn.alias("fn"), (F.col("_n") - F.col("fp")).alias("tn"), f1.alias("f1"))


def best_threshold(scanned: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The tau with the highest F1, the first of equals."""
    best = F.max_by(F.struct("tau", "f1"), F.struct(F.col("f1"), -F.col("tau_index")))
    return scanned.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.tau", "_best.f1")


def first_best(results: DataFrame, metric: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric, the first of equals."""
    best = F.max_by(F.struct(*[F.col(c) for c in results.columns]), F.struct(F.col(metric), -F.col(order)))
    return results.groupBy(*keys).agg(best.alias("_best")).select("_best.*")


def r_squared(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y, p = F.col(label), F.col(prediction)
    sums = df.groupBy(*keys).agg(
        F.sum(w * (y - p) * (y - p)).alias("_res"), F.sum(w * y * y).alias("_yy"), F.sum(w * y).alias("_y"), F.sum(w).alias("_w")
    )
    spread = F.col("_yy") - F.col("_y") * F.col("_y") / F.col("_w")
    return sums.select(*keys, F.when(spread > 0, 1 - F.col("_res") / spread).otherwise(0.0).alias("r2"))


def anomaly_share(df: DataFrame, keys: Sequence[str], flag: str = "is_anomaly") -> DataFrame:
    """Points, anomalous points and their share per group."""
    hit = F.coalesce(F.col(flag).cast("boolean"), F.lit(False))
    return df.groupBy(*keys).agg(
        F.count("*").alias("points"), F.count_if(hit).alias("anomalies"), (F.count_if(hit) / F.count("*")).alias("share")
    )
