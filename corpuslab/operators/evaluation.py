"""Scoring of pass/fail predictions per model, and model picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import example_kind
from .running import running

DECIMALS = 6


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def metrics(predictions: DataFrame) -> DataFrame:
    """Confusion counts and scores per model; ERROR rows are left out, a zero
    denominator scores 0."""
    e, p = F.col("expected"), F.col("predicted")
    counts = predictions.where(p != "ERROR").groupBy("model").agg(
        F.count_if((e == "PASS") & (p == "PASS")).alias("tp"),
        F.count_if((e == "FAIL") & (p == "FAIL")).alias("tn"),
        F.count_if((e == "FAIL") & (p == "PASS")).alias("fp"),
        F.count_if((e == "PASS") & (p == "FAIL")).alias("fn"),
        F.count(F.lit(1)).alias("total"),
        F.count_if((e == "PASS") == (p == "PASS")).alias("__right"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "model", "tp", "tn", "fp", "fn", "total",
        F.round(_share(F.col("__right"), F.col("total")), DECIMALS).alias("accuracy"),
        F.round(_share(tp, tp + fp), DECIMALS).alias("precision"),
        F.round(_share(tp, tp + fn), DECIMALS).alias("recall"),
        F.round(_share(2 * tp, 2 * tp + fp + fn), DECIMALS).alias("f1"),
    )


def by_f1(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("f1"), F.asc("model"))


def difficulty(predictions: DataFrame) -> DataFrame:
    """Misclassified count and percent per item over all models."""
    n_models = predictions.agg(F.count_distinct("model").alias("n")).scalar()
    return predictions.groupBy("item", "expected").agg(F.count_if(F.col("match") == "N").alias("misclassified")).withColumns(
        {"kind": example_kind("item"), "misclassified_pct": F.round(F.col("misclassified") * 100.0 / n_models, 4)}
    )


def correctness_matrix(predictions: DataFrame, models: list[str]) -> DataFrame:
    """Item x model matrix of 1 (match) and 0; ``models`` names the columns."""
    return predictions.groupBy("item").pivot("model", models).agg(F.max((F.col("match") == "Y").cast("long")))


def item_set_gaps(predictions: DataFrame, reference_model: str) -> DataFrame:
    """Items a model lacks or has in excess of the reference model's items."""
    pairs = predictions.select("model", "item").distinct()
    wanted = pairs.where(F.col("model") == reference_model).select("item")
    n_models = pairs.agg(F.count_distinct("model").alias("n")).scalar()
    extra = pairs.join(wanted, "item", "left_anti").withColumn("gap", F.lit("extra"))
    # Only items some model lacks are paired with the models.
    held = pairs.join(wanted, "item", "left_semi").groupBy("item").agg(
        F.collect_set("model").alias("__have"), F.count(F.lit(1)).alias("__n")
    ).where(F.col("__n") < n_models)
    models = predictions.agg(F.collect_set("model").alias("m")).scalar()
    missing = held.select(F.explode(F.array_except(models, F.col("__have"))).alias("model"), "item")
    return extra.select("model", "item", "gap").unionByName(missing.withColumn("gap", F.lit("missing")))


def pareto_front(table: DataFrame, time: str = "time_ms", score: str = "f1") -> DataFrame:
    """Rows no other row beats on both axes (less time and a higher score).

    The best score of all strictly smaller times is a running maximum over
    distinct times, so the cost is linear and no pairs are formed.  ``time`` is
    a positive integer.
    """
    timed = table.where(F.col(time) > 0)
    best = timed.groupBy(time).agg(F.max(score).alias("__s"))
    before = running(best, [], time, F.col("__s"), "__before", how="max", inclusive=False)
    return (
        timed.join(before.select(time, "__before"), time)
        .where(F.col("__before").isNull() | (F.col(score) >= F.col("__before")))
        .drop("__before")
    )


def picks(table: DataFrame, min_f1: float = 0.90) -> DataFrame:
    """Best-of picks over a model table with ``time_ms, size_gb, f1``:
    fastest accurate one, most accurate, best per GB, three balanced ones."""
    one = [
        ("speed", table.where(F.col("f1") >= min_f1), [F.asc("time_ms"), F.asc("model")]),
        ("accuracy", table, [F.desc("f1"), F.asc("model")]),
        ("size", table, [F.desc(F.round(F.col("f1") / F.col("size_gb"), 9)), F.asc("model")]),
    ]
    out = None
    for name, rows, order in one:
        pick = rows.orderBy(*order).limit(1).select(F.lit(name).alias("pick"), F.lit(1).cast("long").alias("position"), "model")
        out = pick if out is None else out.unionByName(pick)
    front = pareto_front(table)
    enough = front.agg((F.count(F.lit(1)) >= 3).alias("b")).scalar()
    on_front = front.select("model").distinct().withColumn("__front", F.lit(True))
    spans = table.agg(
        F.struct(
            F.min("f1").alias("f_lo"), F.max("f1").alias("f_hi"), F.min("time_ms").alias("t_lo"), F.max("time_ms").alias("t_hi")
        ).alias("s")
    ).scalar()
    scored = table.join(on_front, "model", "left").withColumns({"__many": enough, "__s": spans})
    f1_part = F.try_divide(F.col("f1") - F.col("__s.f_lo"), F.col("__s.f_hi") - F.col("__s.f_lo"))
    time_part = 1 - F.try_divide((F.col("time_ms") - F.col("__s.t_lo")).cast("double"), F.col("__s.t_hi") - F.col("__s.t_lo"))
    balanced = F.round(f1_part * 0.6 + time_part * 0.4, 9)
    ranked = scored.where(~F.col("__many") | F.col("__front")).withColumn(
        "__rank_by", F.when(F.col("__many"), F.col("f1")).otherwise(balanced)
    )
    top = ranked.orderBy(F.desc_nulls_last("__rank_by"), F.asc("model")).limit(3)
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("__rank_by"), F.asc("model"))
    top = top.select(F.lit("balanced").alias("pick"), F.row_number().over(w).cast("long").alias("position"), "model")
    return out.unionByName(top)
