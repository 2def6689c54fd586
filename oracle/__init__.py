"""Plain SQL twins of the registered queries, for DuckDB on the same parquet files."""

from oracle import marts, models, reports


def all_queries() -> dict[str, str]:
    return {**reports.build(), **marts.build(), **models.build()}
