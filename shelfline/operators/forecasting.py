"""Demand forecasts per SKU: seven models, hold-out evaluation, the best one refitted.

Sales are reduced to one row per SKU and day, so a series is bounded by its calendar. After
that single shuffle on SKU everything stays in place: model states are grouped sums, each SKU
becomes one row, and evaluation, selection and prediction are expressions on that row.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.operators.ledger import daily_demand, demand_on_calendar
from shelfline.star import Star

TAIL = max(labels.MOVING_AVERAGES.values())
FEATURES = ["trend", "dow_sin", "dow_cos", "month_sin", "month_cos", "quarter"]


def filled_series(sales: DataFrame) -> DataFrame:
    """``(sku_id, date, units_sold)`` for every SKU and calendar day, 0 on days without sales."""
    skus = sales.where(F.col("sku_id").isNotNull()).select("sku_id").distinct()
    return demand_on_calendar(skus, sales)


def observed_series(sales: DataFrame, min_rows: int = labels.MIN_SALES_ROWS, fill_gaps: bool = False,
                    skus: DataFrame | None = None) -> DataFrame:
    """Daily units per SKU with the position of each day counted from the newest (1).

    SKUs with fewer than ``min_rows`` sales rows (before they are added up per day) are left out.
    Days without sales stay absent unless ``fill_gaps``. ``skus`` limits the SKUs.
    """
    known = sales.where(F.col("sku_id").isNotNull())
    if skus is not None:
        known = known.join(skus.select("sku_id"), "sku_id", "left_semi")
    daily = daily_demand(known)
    if fill_gaps:
        daily = filled_series(known).join(daily.select("sku_id", "date", "sales_rows"), ["sku_id", "date"], "left")
    whole = Window.partitionBy("sku_id")
    return (
        # The ordered window comes first: its sort also serves the others.
        daily.withColumn("recency", F.row_number().over(whole.orderBy(F.desc("date"))))
        .withColumns(
            {
                "rows": F.sum("sales_rows").over(whole),
                "points": F.count(F.lit(1)).over(whole),
                "first_date": F.min("date").over(whole),
            }
        )
        .where(F.col("rows") >= min_rows)
        .select("sku_id", "date", F.col("units_sold").cast("double").alias("units"), "points", "first_date", "recency")
    )


def calendar_features(day: Column, first_day: Column) -> list[Column]:
    """Trend in days, weekday (Monday 0) and month on the circle, quarter."""
    weekday = F.weekday(day) * (2 * math.pi) / 7
    month = F.month(day) * (2 * math.pi) / 12
    return [
        F.datediff(day, first_day).cast("double"), F.sin(weekday), F.cos(weekday), F.sin(month), F.cos(month),
        F.quarter(day).cast("double"),
    ]


def solve_regression(moments: pd.Series) -> pd.Series:
    """Coefficients (intercept first) of the least-squares fit on standardised features.

    ``moments`` holds, per series: the row count, the sum of y, the sum of each feature, of each
    product of two features (upper triangle, row by row) and of each feature times y. Works on a
    batch of series at once. A constant feature gets no weight, and of
    several equally good fits the one with the smallest standardised weights is taken.
    """
    sums = np.stack(moments.to_numpy())
    size = len(FEATURES)
    n, y_sum, f_sum = sums[:, 0], sums[:, 1], sums[:, 2 : 2 + size]
    upper = np.triu_indices(size)
    gram = np.zeros((len(sums), size, size))
    gram[:, upper[0], upper[1]] = sums[:, 2 + size : -size]
    gram = gram + np.triu(gram, 1).transpose(0, 2, 1)
    mean = f_sum / n[:, None]
    raw = np.diagonal(gram, axis1=1, axis2=2) / n[:, None]
    cov = gram / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    var = np.diagonal(cov, axis1=1, axis2=2)
    varies = var > 1e-12 * raw
    std = np.where(varies, np.sqrt(np.where(varies, var, 1.0)), 1.0)
    mask = varies[:, :, None] & varies[:, None, :]
    corr = np.where(mask, cov / (std[:, :, None] * std[:, None, :]), 0.0)
    target = np.where(varies, (sums[:, -size:] / n[:, None] - mean * (y_sum / n)[:, None]) / std, 0.0)
    values, vectors = np.linalg.eigh(corr)
    keep = values > 1e-10 * np.maximum(values[:, -1:], 1e-300)
    projected = np.einsum("bij,bi->bj", vectors, target)
    weights = np.einsum("bij,bj->bi", vectors, np.where(keep, projected / np.where(keep, values, 1.0), 0.0)) / std
    intercept = y_sum / n - (weights * mean).sum(axis=1)
    return pd.Series(list(np.column_stack([intercept, weights])))


def _smoothing_weight(alpha: float, position: Column, count: Column) -> Column:
    """Weight of a value in the smoothed level; the oldest value starts the recursion unweighted."""
    decay = F.pow(F.lit(1 - alpha), position - 1)
    return F.when(position == count, decay).otherwise(decay * alpha)


def fit_models(series: DataFrame, hold_out: int = labels.HOLD_OUT) -> DataFrame:
    """One row per SKU with two fitted states: ``train`` (without the newest ``hold_out`` rows,
    NULL if none are left) and ``full``."""
    segments = F.when(F.col("recency") > hold_out, F.array(F.lit("train"), F.lit("full"))).otherwise(F.array(F.lit("full")))
    held = F.when(F.col("segment") == "train", hold_out).otherwise(0)
    rows = (
        series.withColumns(dict(zip(FEATURES, calendar_features(F.col("date"), F.col("first_date")))))
        .withColumn("segment", F.explode(segments))
        .withColumns({"position": F.col("recency") - held, "count": F.col("points") - held})
    )
    y, position, count = F.col("units"), F.col("position"), F.col("count")
    products = [F.col(a) * F.col(b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
    terms = [F.lit(1.0), y, *[F.col(f) for f in FEATURES], *products, *[F.col(f) * y for f in FEATURES]]
    keep = max(TAIL, hold_out)
    fitted = rows.groupBy("sku_id", "segment").agg(
        F.max("date").alias("last_date"),
        F.min("first_date").alias("first_date"),
        F.max("points").alias("points"),
        F.array(*[F.sum(y * _smoothing_weight(a, position, count)) for a in labels.SMOOTHINGS.values()]).alias("levels"),
        # The newest values, oldest first; NULL entries are not collected.
        F.array_sort(
            F.collect_list(F.when(position <= keep, F.struct((-position).alias("p"), y.alias("units"))))
        ).alias("tail"),
        F.array(*[F.sum(term) for term in terms]).alias("moments"),
    )
    state = F.struct("last_date", "first_date", "points", "levels", F.col("tail.units").alias("tail"), "moments")
    states = (
        fitted.select("sku_id", "segment", state.alias("state"))
        .groupBy("sku_id")
        .agg(
            F.first(F.when(F.col("segment") == "train", F.col("state")), ignorenulls=True).alias("train"),
            F.first(F.when(F.col("segment") == "full", F.col("state")), ignorenulls=True).alias("full"),
        )
    )
    # Solved last, on rows that hold a whole SKU: a Python stage drops the partitioning.
    solve = F.pandas_udf(solve_regression, "array<double>")
    weights = {
        "train": solve(F.coalesce("train.moments", "full.moments")),
        "full": solve("full.moments"),
    }
    return states.select(
        "sku_id", *[F.col(s).withField("weights", w).dropFields("moments").alias(s) for s, w in weights.items()]
    )


def _moving_average(tail: Column, window: int, horizon: int) -> Column:
    """Each prediction is the mean of the last values, and becomes the newest of them."""
    last = F.slice(tail, F.greatest(F.size(tail) - window + 1, F.lit(1)), window)
    start = F.struct(last.alias("values"), F.array().cast("array<double>").alias("out"))

    def step(state: Column, _: Column) -> Column:
        values = state["values"]
        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)
        return F.struct(
            F.concat(F.slice(values, 2, F.lit(window)), F.array(mean)).alias("values"),
            F.concat(state["out"], F.array(mean)).alias("out"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"])


def _regression(state: Column, horizon: int) -> Column:
    def predict(step: Column) -> Column:
        values = calendar_features(F.date_add(state["last_date"], step), state["first_date"])
        terms = [state["weights"][i + 1] * v for i, v in enumerate(values)]
        return F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, terms, state["weights"][0]))

    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), predict)


def predictions(state: Column, horizon: int) -> Column:
    """``horizon`` predictions of every model, in the order of ``labels.MODELS``."""
    return F.array(
        *[_moving_average(state["tail"], w, horizon) for w in labels.MOVING_AVERAGES.values()],
        *[F.array_repeat(state["levels"][i], horizon) for i in range(len(labels.SMOOTHINGS))],
        _regression(state, horizon),
    )


def _evaluated(fitted: DataFrame, hold_out: int) -> DataFrame:
    """Adds ``scores``: one ``(model, mae, rmse)`` per model against the held-out rows, which are
    compared with that many consecutive predicted days; NULL when nothing was left to train on."""
    actual = F.slice(F.col("full.tail"), -hold_out, hold_out)

    def score(predicted: Column, i: Column) -> Column:
        errors = F.zip_with(actual, predicted, lambda a, p: a - p)
        return F.struct(
            F.array(*[F.lit(m) for m in labels.MODELS])[i].alias("model"),
            (F.aggregate(errors, F.lit(0.0), lambda s, e: s + F.abs(e)) / hold_out).alias("mae"),
            F.sqrt(F.aggregate(errors, F.lit(0.0), lambda s, e: s + e * e) / hold_out).alias("rmse"),
        )

    scores = F.transform(predictions(F.col("train"), hold_out), score)
    return fitted.withColumn("scores", F.when(F.col("train").isNotNull(), scores))


def _best(scores: Column) -> Column:
    """The model with the lowest MAE; of equal ones the first in the list."""
    return F.array_min(
        F.transform(scores, lambda s, i: F.struct(s["mae"].alias("mae"), i.alias("i"), s["model"].alias("model")))
    )


def evaluate_models(star: Star, min_rows: int = labels.MIN_SALES_ROWS, hold_out: int = labels.HOLD_OUT,
                    fill_gaps: bool = False) -> DataFrame:
    """MAE and RMSE of each model per SKU; ``error`` says why a model has none."""
    series = observed_series(star.sales, min_rows, fill_gaps)
    nothing = F.transform(
        F.array(*[F.lit(m) for m in labels.MODELS]),
        lambda m: F.struct(m.alias("model"), F.lit(None).cast("double").alias("mae"), F.lit(None).cast("double").alias("rmse")),
    )
    scored = _evaluated(fit_models(series, hold_out), hold_out)
    return scored.select("sku_id", F.inline(F.coalesce("scores", nothing))).withColumn(
        "error", F.when(F.col("mae").isNull(), "no rows left to train on")
    )


def best_models(star: Star, min_rows: int = labels.MIN_SALES_ROWS, hold_out: int = labels.HOLD_OUT) -> DataFrame:
    scored = _evaluated(fit_models(observed_series(star.sales, min_rows), hold_out), hold_out)
    return (
        scored.where(F.col("full.points") > hold_out)
        .withColumn("best", _best(F.col("scores")))
        .select("sku_id", F.col("best.model").alias("model_used"), F.col("best.mae").alias("model_mae"))
    )


def _forecast(fitted: DataFrame, horizon: int, hold_out: int) -> DataFrame:
    """One row per SKU: the best model and its predictions; SKUs no model could be tested on, for
    want of rows before the hold-out, are left out."""
    return (
        _evaluated(fitted, hold_out)
        .where(F.col("full.points") > hold_out)
        .withColumn("best", _best(F.col("scores")))
        .withColumn("predicted", predictions(F.col("full"), horizon)[F.col("best.i")])
    )


def forecast_skus(star: Star, horizon: int = labels.HORIZON, min_rows: int = labels.MIN_SALES_ROWS,
                  hold_out: int = labels.HOLD_OUT, fill_gaps: bool = False,
                  skus: DataFrame | None = None) -> DataFrame:
    """The best model's forecast for every SKU: consecutive days after its last sale."""
    series = observed_series(star.sales, min_rows, fill_gaps, skus)
    return (
        _forecast(fit_models(series, hold_out), horizon, hold_out)
        .select("sku_id", "full.last_date", "best", F.posexplode("predicted").alias("step", "predicted"))
        .select(
            "sku_id",
            F.date_add("last_date", F.col("step") + 1).alias("forecast_date"),
            (F.col("step") + 1).alias("day_ahead"),
            F.bround("predicted", 2).alias("predicted_demand"),
            F.col("best.model").alias("model_used"),
            F.bround("best.mae", 2).alias("model_mae"),
        )
    )


def model_usage(forecasts: DataFrame) -> DataFrame:
    """Forecast rows per model."""
    return forecasts.groupBy("model_used").agg(F.count(F.lit(1)).alias("forecast_rows"))


def forecast_summaries(star: Star, horizon: int = labels.HORIZON, min_rows: int = labels.MIN_SALES_ROWS,
                       hold_out: int = labels.HOLD_OUT) -> DataFrame:
    """Per SKU: history length, best model, MAE of every model, mean and total predicted demand."""
    planned = _forecast(fit_models(observed_series(star.sales, min_rows), hold_out), horizon, hold_out)
    total = F.aggregate("predicted", F.lit(0.0), lambda s, p: s + p)
    maes = [F.bround(F.col("scores")[i]["mae"], 2).alias(f"mae_{m}".replace(".", "_")) for i, m in enumerate(labels.MODELS)]
    return planned.select(
        "sku_id", F.col("full.points").alias("points"), F.col("best.model").alias("model_used"), *maes,
        F.bround(total / horizon, 1).alias("avg_predicted"), F.bround(total, 0).alias("total_predicted"),
    )


def forecast_one_sku(star: Star, sku_id: str, horizon: int = labels.HORIZON) -> DataFrame:
    """The summary of one SKU, whatever the length of its history; an unknown SKU is an error."""
    one = star.sales.where(F.col("sku_id") == sku_id)
    if one.isEmpty():
        raise ValueError(f"No sales data found for SKU: {sku_id}")
    return forecast_summaries(star.with_derived(sales=one), horizon, min_rows=1)
