"""Data-quality checks, one tidy row per check: ``(check, table_name, status, observed)``.

Each table is read once: all of its checks are measures of a single aggregate. WARN and INFO do
not fail the verdict, FAIL does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels

PASS, WARN, FAIL, INFO = "PASS", "WARN", "FAIL", "INFO"
Check = tuple[str, Column, Column]


def _zero_or(status: str, measure: Column) -> Column:
    return F.when(measure > 0, status).otherwise(PASS)


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _counted(check: str, measure: str, status: str = FAIL) -> Check:
    return check, _zero_or(status, _count(measure)), _count(measure).cast("string")


def _tidy(measures: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """One row of measures to one row per check."""
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                 status.alias("status"), observed.alias("observed"))
        for check, status, observed in checks
    ]
    return measures.select(F.inline(F.array(*rows)))


def _shape_checks(df: DataFrame, table: str, rules: dict) -> list[Check]:
    minimum, required = rules[table]
    rows = _count("rows")
    missing = [c for c in required if c not in df.columns]
    return [
        ("row_count", F.when(rows < minimum, WARN).otherwise(PASS), rows.cast("string")),
        ("required_columns", F.lit(FAIL if missing else PASS), F.lit(",".join(missing))),
    ]


def _key_counts(df: DataFrame, key: str, *more: Column) -> DataFrame:
    """Rows per key: the first, skew-proof half of every check on keys."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *more)


def _orphans(keyed: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Adds ``known``, NULL where the key has no parent; a NULL key never has one."""
    known = parents.select(key).distinct().withColumn("known", F.lit(True))
    return keyed.join(known, key, "left")


def _product_checks(products: DataFrame, suppliers: DataFrame | None, rules: dict) -> DataFrame:
    checks = _shape_checks(products, "products", rules)
    if "sku_id" not in products.columns:
        return _tidy(products.agg(F.count(F.lit(1)).alias("rows")), "products", checks)
    by_sku = _key_counts(products, "sku_id").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("sku_id").isNull(), F.col("n"))).alias("null_skus"),
        F.sum(F.col("n") - 1).alias("extra_copies"),
    )
    checks += [_counted("null_skus", "null_skus"), _counted("duplicate_skus", "extra_copies")]
    result = _tidy(by_sku, "products", checks)
    if suppliers is not None and "supplier_id" in products.columns and "supplier_id" in suppliers.columns:
        unknown = _orphans(_key_counts(products, "supplier_id"), suppliers, "supplier_id").agg(
            F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("unknown")
        )
        result = result.unionByName(_tidy(unknown, "products", [_counted("unknown_suppliers", "unknown")]))
    return result


def _sales_checks(sales: DataFrame, products: DataFrame | None, rules: dict, years: tuple[int, int]) -> DataFrame:
    checks = _shape_checks(sales, "sales", rules)
    if not {"sku_id", "date"} <= set(sales.columns):
        return _tidy(sales.agg(F.count(F.lit(1)).alias("rows")), "sales", checks)
    keyed = _key_counts(sales, "sku_id", F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    measures = [F.sum("n").alias("rows"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]
    covers = (F.year("first_day") == years[0]) & (F.year("last_day") == years[1])
    span = F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string"))
    checks += [
        ("sales_date_range", F.lit(INFO), span),
        ("sales_years", F.when(covers, PASS).otherwise(WARN), span),
    ]
    if products is not None and "sku_id" in products.columns:
        keyed = _orphans(keyed, products, "sku_id")
        measures.append(F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("unknown"))
        checks.append(_counted("unknown_skus", "unknown"))
    return _tidy(keyed.agg(*measures), "sales", checks)


def _inventory_checks(inventory: DataFrame, rules: dict) -> DataFrame:
    checks = _shape_checks(inventory, "inventory", rules)
    measures = [F.count(F.lit(1)).alias("rows")]
    if {"on_hand_qty", "stockout_flag"} <= set(inventory.columns):
        on_hand = F.col("on_hand_qty")
        measures += [
            F.count_if(on_hand < 0).alias("negative"),
            F.count_if(F.col("stockout_flag") & (on_hand > 0)).alias("mismatch"),
        ]
        checks += [_counted("negative_on_hand", "negative"), _counted("stockout_flag_consistent", "mismatch", WARN)]
    return _tidy(inventory.agg(*measures), "inventory", checks)


def _plain_checks(df: DataFrame, table: str, rules: dict) -> DataFrame:
    return _tidy(df.agg(F.count(F.lit(1)).alias("rows")), table, _shape_checks(df, table, rules))


def _with_verdict(checks: DataFrame) -> DataFrame:
    """Adds the overall row. Every check also contributes to it, so nothing is read twice."""
    failed = (F.col("status") == FAIL).cast("int")
    verdict = {"check": F.lit("overall"), "table_name": F.lit("all"), "status": F.lit(PASS),
               "observed": F.lit(None).cast("string"), "failed": failed}
    both = checks.select(
        F.inline(
            F.array(
                F.struct("check", "table_name", "status", "observed", F.lit(0).alias("failed")),
                F.struct(*[value.alias(name) for name, value in verdict.items()]),
            )
        )
    )
    total = F.sum("failed")
    overall = F.col("check") == "overall"
    return (
        both.groupBy("check", "table_name")
        .agg(F.max("status").alias("status"), F.max("observed").alias("observed"), total.alias("failed"))
        .select(
            "check",
            "table_name",
            F.when(overall & (F.col("failed") > 0), FAIL).otherwise(F.col("status")).alias("status"),
            F.when(overall, F.col("failed").cast("string")).otherwise(F.col("observed")).alias("observed"),
        )
    )


def validate(
    tables: dict[str, DataFrame | None],
    rules: dict[str, tuple[int, list[str]]] = labels.QUALITY_RULES,
    years: tuple[int, int] = (2024, 2025),
) -> DataFrame:
    """All checks on the tables named in ``rules``; a table that is absent or None fails.

    ``years`` are the expected years of the first and the last sale.
    """
    parts, absent = [], [name for name in rules if tables.get(name) is None]
    for name in rules:
        df = tables.get(name)
        if df is None:
            continue
        if name == "products":
            parts.append(_product_checks(df, tables.get("suppliers"), rules))
        elif name == "sales":
            parts.append(_sales_checks(df, tables.get("products"), rules, years))
        elif name == "inventory":
            parts.append(_inventory_checks(df, rules))
        else:
            parts.append(_plain_checks(df, name, rules))
    if not parts:
        raise ValueError("no table to validate")
    if absent:
        spark = parts[0].sparkSession
        parts.append(
            spark.createDataFrame(
                [("table_present", name, FAIL, "absent") for name in absent],
                "check string, table_name string, status string, observed string",
            )
        )
    return _with_verdict(reduce(DataFrame.unionByName, parts))
