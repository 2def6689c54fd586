import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.functions.numeric import half_even, percent, quotient, sample_deviation
from shelfline.functions.quantiles import exact_quantiles


def rounded(num, den, digits, how):
    with localcontext() as c:
        c.prec = 60
        return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), how)


def test_quotients_round_like_exact_decimals(spark):
    r = random.Random(1)
    pairs = [(r.randint(-10**6, 10**6), r.choice([1, 2, 3, 7, 8, 40, 1000])) for _ in range(300)]
    pairs += [(1, 8), (-1, 8), (5, 2), (-5, 2), (10**18, 3)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for row in df.select("n", "d", quotient("n", "d", 2).alias("q")).collect():
        assert row.q == rounded(row.n, row.d, 2, ROUND_HALF_UP)
    positive = df.where("n >= 0 and n < 1000000000")
    for row in positive.select("n", "d", half_even(F.col("n"), F.col("d"), 18, 2).alias("q")).collect():
        assert row.q == rounded(row.n, row.d, 2, ROUND_HALF_EVEN)


def test_empty_denominators_give_null(spark):
    row = spark.sql("select 5L n, 0L d, cast(null as bigint) m").select(
        quotient("n", "d", 1), percent("n", "m"), half_even(F.col("n"), F.col("d"), 10, 1)
    ).first()
    assert list(row) == [None, None, None]


def test_sums_beyond_64_bits(spark):
    row = spark.sql("select cast('9000000000000000000000' as decimal(38,0)) n, 3L d").select(
        (quotient("n", F.lit(10).cast("decimal(38,0)") * 10**8, 1)).alias("q")
    ).first()
    assert row.q == Decimal("9000000000000.0")


def test_sample_deviation_from_sums(spark):
    values = [3, 9, 9, 200]
    row = spark.createDataFrame([(sum(values), sum(v * v for v in values), 4), (3, 9, 1)], "s bigint, q bigint, n bigint")
    got = [r[0] for r in row.select(sample_deviation("s", "q", "n")).collect()]
    assert got[0] == pytest.approx(np.std(values, ddof=1)) and got[1] is None


@pytest.mark.parametrize("hot", [0, 4000])
def test_exact_quantiles_match_numpy(spark, hot):
    r = random.Random(hot)
    values = [round(r.lognormvariate(3, 2), 2) for _ in range(5000)] + [7.5] * hot
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {row.share: row.value for row in exact_quantiles(df, "x", shares).collect()}
    for share in shares:
        assert got[share] == pytest.approx(np.quantile(values, share)), share


@pytest.mark.parametrize("digits", [16, 4096])
def test_quantiles_settle_by_digits(spark, digits, monkeypatch):
    """A million different values over twenty orders of magnitude: cells are cut until they hold
    few rows, and no more than those are fetched."""
    from shelfline.functions import quantiles

    df = spark.range(1_000_000).selectExpr("if(id % 2 = 0, id, pow(10, 20 * id / 1000000.0)) x")
    passes = []
    refine = quantiles._refine
    monkeypatch.setattr(quantiles, "_refine", lambda v, ranges, ranks, d: passes.append([r.rows for r in ranges]) or refine(v, ranges, ranks, d))
    shares = [0.1, 0.5, 0.9]
    got = {r.share: r.value for r in exact_quantiles(df, "x", shares, few=200, digits=digits).collect()}
    i = np.arange(1_000_000)
    values = np.where(i % 2 == 0, i.astype(float), 10.0 ** (20 * i / 1_000_000.0))
    for share in shares:
        assert got[share] == pytest.approx(np.quantile(values, share), rel=1e-9), share
    assert 1 < len(passes) <= 25 and passes[0] == [1_000_000]
    assert all(sum(after) < sum(before) for before, after in zip(passes, passes[1:]))


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]).count() == 0


def test_quantiles_of_one_value(spark):
    got = exact_quantiles(spark.createDataFrame([(4.0,)], "x double"), "x", [0.25, 0.75]).collect()
    assert sorted((r.share, r.value) for r in got) == [(0.25, 4.0), (0.75, 4.0)]
