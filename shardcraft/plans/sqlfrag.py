"""SQL twins of the exact rounding helpers (``aggregates.ratio_fixed`` and
``aggregates.avg_fixed``) for the DuckDB oracle."""


def ratio_sql(num: str, den: str, digits: int = 4) -> str:
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(nullif(({den}), 0) AS HUGEINT)"
    return f"(CAST(({n} * {2 * 10 ** digits} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** digits}.0)"


def avg_sql(x: str, scale: int = 2, digits: int = 4) -> str:
    units = f"sum(CAST(CAST({x} AS DECIMAL(18,{scale})) * {10 ** scale} AS BIGINT))"
    return ratio_sql(units, f"count({x}) * {10 ** scale}", digits)
