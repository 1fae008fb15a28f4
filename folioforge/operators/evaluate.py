"""Metrics of predicted labels against a ground truth, and the rows that predictions lack."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def confusion(pairs: DataFrame, labels: list[str]) -> DataFrame:
    """Per label: counts, precision, recall, f1, accuracy; pairs has pred_<label> and true_<label> booleans.

    One pass: labels are unpivoted before a single aggregation.
    """
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(f"pred_{x}").alias("p"), F.col(f"true_{x}").alias("t")) for x in labels])).alias("r")
    r = pairs.select(each).select("r.*")
    c = r.groupBy("label").agg(*[F.count_if(cond).alias(n) for n, cond in (("tp", F.expr("p and t")), ("fp", F.expr("p and not t")), ("fn", F.expr("not p and t")), ("tn", F.expr("not p and not t")))])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.withColumns({
        "f1": ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        "accuracy": ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
    })


def exact_match(pairs: DataFrame, labels: list[str]) -> DataFrame:
    same = F.lit(True)
    for x in labels:
        same = same & (F.col(f"pred_{x}") == F.col(f"true_{x}"))
    n = F.count("*")
    return pairs.agg(n.alias("total"), F.count_if(same).alias("exact"), F.coalesce(F.try_divide(F.count_if(same), n), F.lit(0.0)).alias("rate"))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by order; a single aggregation, no window."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def missing(truth: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return truth.join(seen.select(key).distinct(), key, "left_anti")


def with_truth(rows: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Predicted rows with their truth (null: none), and the truth's keys that no row has; state tells them apart."""
    found = rows.join(truth, key, "left").withColumn("state", F.lit("found"))
    return found.unionByName(missing(truth, rows, key).withColumn("state", F.lit("missing")), allowMissingColumns=True)


class Counters:
    """Counts of conditions over the rows of a DataFrame, taken while another action runs over them."""

    def __init__(self, **conditions: str) -> None:
        self.conditions, self._seen = conditions, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count("*").alias("rows"), *[F.count_if(F.expr(c)).alias(n) for n, c in self.conditions.items()])

    def values(self) -> dict[str, int]:
        """After the action."""
        return self._seen.get


def report(metrics: DataFrame, overall: DataFrame) -> str:
    """Text of a few rows: one per label and the exact matches."""
    o = overall.first()
    lines = [f"{r['label']}: precision {r['precision']:.3f}, recall {r['recall']:.3f}, f1 {r['f1']:.3f}, accuracy {r['accuracy']:.3f} ({r['tp']} {r['fp']} {r['fn']} {r['tn']})" for r in metrics.orderBy("label").collect()]
    return "\n".join([*lines, f"exact: {o['exact']} of {o['total']} ({o['rate']:.3f})"])
