"""Named queries: a Spark builder ``f(spark, sf_dir) -> DataFrame`` plus, when the
result is SQL-expressible, the DuckDB oracle statement with the same column names."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from riskframe.plans import q_clean, q_profile, q_explore, q_metrics, q_features, q_models, q_sources  # noqa: F401


ROUND_DIGITS = 6


def _rounded(fn):
    def run(spark, sf_dir):
        from pyspark.sql import functions as F
        df = fn(spark, sf_dir)
        return df.select(*[F.round(F.col(f"`{f.name}`"), ROUND_DIGITS).alias(f.name)
                           if f.dataType.simpleString() in ("double", "float") else F.col(f"`{f.name}`")
                           for f in df.schema.fields])
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def rounded_queries() -> dict[str, Callable]:
    """Queries with every double column rounded to ROUND_DIGITS (the comparison form)."""
    load_all()
    return {k: _rounded(v) for k, v in QUERIES.items()}


def rounded_oracles() -> dict[str, str]:
    """Oracle SQL with the same rounding applied to the same (double) columns."""
    from riskframe.plans.doubles import DOUBLE_COLUMNS
    load_all()
    out = {}
    for k, sql in ORACLES.items():
        cols = DOUBLE_COLUMNS.get(k)
        if cols:
            rep = ", ".join(f'round("{c}", {ROUND_DIGITS}) AS "{c}"' for c in cols)
            sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"
        out[k] = sql
    return out
