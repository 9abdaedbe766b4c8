"""Validated ingest with quarantine (IO8).

Each rule yields a reason string or NULL per row; the reasons are collected
into one array column.  Rows without reasons are good; the others go to the
quarantine output with their reasons.  Text is data: a value such as
``'; DROP TABLE users; --`` is kept verbatim.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rules:
    required: list[str] = field(default_factory=list)
    max_length: dict = field(default_factory=dict)        # column -> characters
    types: dict = field(default_factory=dict)             # column -> Spark type name
    domains: dict = field(default_factory=dict)           # column -> allowed values


def reasons(rules: Rules) -> Column:
    checks = []
    for c in rules.required:
        v = F.col(c)
        empty = v.isNull() | (F.trim(v.cast("string")) == "")
        checks.append(F.when(empty, F.lit(f"{c}: required")))
    for c, n in rules.max_length.items():
        checks.append(F.when(F.length(F.col(c)) > n, F.lit(f"{c}: longer than {n}")))
    for c, t in rules.types.items():
        checks.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                             F.lit(f"{c}: not a valid {t}")))
    for c, vals in rules.domains.items():
        checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(vals)),
                             F.lit(f"{c}: not one of {','.join(map(str, vals))}")))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame, rules: Rules, cast: bool = True):
    """Returns ``(good, bad)``; ``good`` has the typed columns (``cast``),
    ``bad`` keeps the raw row plus ``reasons`` (array) and ``reason`` (text)."""
    r = df.withColumn("__reasons", reasons(rules))
    good = r.where(F.size("__reasons") == 0).drop("__reasons")
    if cast:
        for c, t in rules.types.items():
            good = good.withColumn(c, F.col(c).try_cast(t))
    bad = (r.where(F.size("__reasons") > 0)
            .withColumnRenamed("__reasons", "reasons")
            .withColumn("reason", F.array_join("reasons", "; ")))
    return good, bad
