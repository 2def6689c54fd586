import datetime as dt
import random

import numpy as np
import pytest

from conftest import sale
from shelfline import labels
from shelfline.operators import forecasting as fc

HORIZON = 30


def moving_average(values, window):
    last, out = list(values[-window:]), []
    for _ in range(HORIZON):
        out.append(sum(last) / len(last))
        last = last[1:] + [out[-1]]
    return out


def smoothing(values, alpha):
    level = values[0]
    for v in values[1:]:
        level = alpha * v + (1 - alpha) * level
    return [level] * HORIZON


def features(days, first):
    rows = []
    for d in days:
        w, m = 2 * np.pi * d.weekday() / 7, 2 * np.pi * d.month / 12
        rows.append([(d - first).days, np.sin(w), np.cos(w), np.sin(m), np.cos(m), (d.month - 1) // 3 + 1])
    return np.array(rows, float)


def regression(values, days):
    x, y = features(days, days[0]), np.array(values, float)
    mean, std = x.mean(0), x.std(0)
    std = np.where(std < 1e-9, 1, std)
    weights = np.linalg.lstsq((x - mean) / std, y - y.mean(), rcond=1e-8)[0]
    ahead = features([days[-1] + dt.timedelta(days=i + 1) for i in range(HORIZON)], days[0])
    return np.maximum(0, y.mean() + ((ahead - mean) / std) @ weights)


def twins(values, days):
    by_name = {m: moving_average(values, w) for m, w in labels.MOVING_AVERAGES.items()}
    by_name |= {m: smoothing(values, a) for m, a in labels.SMOOTHINGS.items()}
    return by_name | {labels.REGRESSION: regression(values, days)}


def series(seed, n, gap=0.0, start=0):
    r = random.Random(seed)
    return [(start + i, r.randint(0, 40) + i // 9) for i in range(n) if i in (0, n - 1) or r.random() >= gap]


CASES = {
    "long": series(1, 400), "gaps": series(2, 200, 0.3), "short": series(3, 60), "one_month": series(4, 61),
    "one_train_row": series(5, 31), "seventy": series(6, 70),
}


@pytest.fixture(scope="module")
def star(spark):
    from conftest import table
    from shelfline import schemas
    from shelfline.star import Star

    rows = [sale(k, n, u) for k, s in CASES.items() for n, u in s]
    rows += [sale("split", n, u) for n in range(40) for u in (n, 2)]  # two rows a day: 80 rows, 40 days
    rows += [sale("few_days", n % 20, n) for n in range(80)]  # enough rows, nothing to train on
    empty = lambda ddl: table(spark, ddl, [])
    return Star(empty(schemas.PRODUCTS), empty(schemas.SUPPLIERS), table(spark, schemas.SALES, rows).cache(),
                empty(schemas.INVENTORY), empty(schemas.ORDERS))


def case(name):
    points = CASES.get(name) or [(n, n + 2) for n in range(40)]
    return [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n, _ in points], [float(u) for _, u in points]


def test_evaluation_matches_plain_loops(star):
    rows = fc.evaluate_models(star, min_rows=1).collect()
    got = {(r.sku_id, r.model): (r.mae, r.rmse) for r in rows}
    for name in [*CASES, "split"]:
        days, values = case(name)
        for model, predicted in twins(values[:-30], days[:-30]).items():
            errors = np.array(values[-30:]) - np.array(predicted)
            assert got[name, model] == pytest.approx((np.abs(errors).mean(), np.sqrt((errors**2).mean())), rel=1e-6), (name, model)
    failed = [r for r in rows if r.sku_id == "few_days"]
    assert len(failed) == 7 and all(r.mae is None and r.error for r in failed)
    assert all(r.error is None for r in rows if r.sku_id != "few_days")


def test_forecast_refits_the_best_model(star):
    rows = fc.forecast_skus(star, min_rows=60).orderBy("sku_id", "day_ahead").collect()
    names = {r.sku_id for r in rows}
    assert names == {"long", "short", "one_month", "seventy", "gaps", "split"} & names | names
    assert "one_train_row" not in names and "few_days" not in names and {"long", "short", "split"} <= names
    for name in sorted(names):
        days, values = case(name)
        scores = {m: np.abs(np.array(values[-30:]) - np.array(p)).mean() for m, p in twins(values[:-30], days[:-30]).items()}
        best = min(scores, key=lambda m: round(scores[m], 9))
        mine = [r for r in rows if r.sku_id == name]
        assert {r.model_used for r in mine} == {best}
        assert [r.forecast_date for r in mine] == [days[-1] + dt.timedelta(days=i + 1) for i in range(30)]
        assert [r.predicted_demand for r in mine] == pytest.approx(list(twins(values, days)[best]), abs=0.0051)
        assert mine[0].model_mae == pytest.approx(scores[best], abs=0.0051)


def test_minimum_counts_rows_before_they_are_added_up(star):
    kept = {r.sku_id for r in fc.observed_series(star.sales).select("sku_id").distinct().collect()}
    assert {"split", "few_days", "short"} <= kept and "one_train_row" not in kept


def test_sku_list_and_gap_filling(spark, star):
    wanted = spark.createDataFrame([("gaps",)], "sku_id string")
    plain = fc.observed_series(star.sales, skus=wanted)
    filled = fc.observed_series(star.sales, skus=wanted, fill_gaps=True)
    assert {r.sku_id for r in plain.select("sku_id").distinct().collect()} == {"gaps"}
    assert plain.count() == len(CASES["gaps"]) and filled.count() == 200
    assert filled.agg({"units": "sum"}).first()[0] == sum(u for _, u in CASES["gaps"])


def test_single_sku_summary(star):
    row = fc.forecast_one_sku(star, "one_train_row").first()
    assert row.points == 31 and row.total_predicted == pytest.approx(30 * row.avg_predicted, abs=2)
    with pytest.raises(ValueError, match="nobody"):
        fc.forecast_one_sku(star, "nobody")


def test_equal_models_resolve_in_list_order(make_star):
    star = make_star(sales=[sale("flat", n, 8) for n in range(90)])
    row = fc.best_models(star).first()
    assert row.model_used == labels.MODELS[0] and row.model_mae == 0


def test_regression_survives_constant_features():
    import pandas as pd

    n = 5.0  # five rows on which every feature is constant
    f = [3.0, 0.1, 0.2, 0.3, 0.4, 1.0]
    sums = [n, 50.0, *[n * v for v in f], *[n * f[i] * f[j] for i in range(6) for j in range(i, 6)], *[50.0 * v for v in f]]
    weights = fc.solve_regression(pd.Series([np.array(sums)]))[0]
    assert weights == pytest.approx([10, 0, 0, 0, 0, 0, 0])
