"""Column-level helpers: null tokens, deterministic randomness, safe arithmetic.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen and has a direct SQL counterpart (see the
``*_sql`` twins, used by the oracle queries).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
# Tokens that the reference's CSV reader turns into missing values, plus its
# sentinel; and the Poisson(1) cumulative probabilities used for bootstrap weights.
SENTINEL = "?"
NA_TOKENS = ["", "NULL", "null", "None", "NA", "N/A", "NaN", "nan"]
SPECIAL_TOKENS = ["?", "NULL", "null", "None", ""]
POISSON1_CDF = [0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406]
# --------------------------------------------------------------------------------


def qcol(name: str) -> Column:
    """Column by exact name, also for names holding '-', '.' or spaces."""
    return F.col(f"`{name}`")


def qname(name: str) -> str:
    return f"`{name}`"


def normalize_tokens(c: Column, tokens: Iterable[str] = NA_TOKENS, trim: bool = True) -> Column:
    """Map NA-like text to NULL (what a pandas CSV read does implicitly)."""
    v = F.trim(c) if trim else c
    return F.when(v.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def uniform(seed, key: Column) -> Column:
    """Deterministic U[0,1) from (seed, key): first 32 bits of md5(seed ':' key).

    Same integer as DuckDB ``('0x'||substr(md5(seed||':'||key),1,8))::BIGINT``,
    so any split/fold/bootstrap built on it can be re-derived in SQL.
    """
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    h = F.conv(F.substr(F.md5(F.concat(seed, F.lit(":"), key.cast("string"))), F.lit(1), F.lit(8)), 16, 10)
    return h.cast("bigint").cast("double") / F.lit(4294967296.0)


def uniform_sql(seed, key_sql: str) -> str:
    return (f"(('0x' || substr(md5('{seed}' || ':' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"
            f"::DOUBLE / 4294967296.0)")


def hash_order(seed, key: Column) -> Column:
    """Integer shuffle key (first 32 bits of md5), ties broken by the caller."""
    return F.conv(F.substr(F.md5(F.concat(F.lit(str(seed)), F.lit(":"), key.cast("string"))), F.lit(1), F.lit(8)),
                  16, 10).cast("bigint")


def hash_order_sql(seed, key_sql: str) -> str:
    return f"(('0x' || substr(md5('{seed}' || ':' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT)"


def poisson1(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF on a uniform column (bootstrap weight)."""
    expr = F.lit(len(POISSON1_CDF))
    for k in range(len(POISSON1_CDF) - 1, -1, -1):
        expr = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(k)).otherwise(expr)
    return expr


def poisson1_sql(u_sql: str) -> str:
    parts = " ".join(f"WHEN {u_sql} < {p} THEN {k}" for k, p in enumerate(POISSON1_CDF))
    return f"(CASE {parts} ELSE {len(POISSON1_CDF)} END)"


def safe_ratio(num: Column, den: Column, default=0.0) -> Column:
    """num/den as double; ``default`` when den is 0 or null (sklearn zero_division=0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default).cast("double"))


def r6(c: Column, digits: int = 6) -> Column:
    return F.round(c.cast("double"), digits)


def is_numeric_type(dt) -> bool:
    from pyspark.sql import types as T
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                           T.DecimalType))


def is_integral_type(dt) -> bool:
    from pyspark.sql import types as T
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_string_type(dt) -> bool:
    from pyspark.sql import types as T
    return isinstance(dt, T.StringType)
