"""PRJ-1..PRJ-8: interpret a ``TableSpec`` over a bronze DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adlake.functions.names import flat_name
from adlake.operators.spec import TableSpec

UNKNOWN = "Unknown"


class MissingColumnsError(ValueError):
    pass


def check_columns(columns: list[str], spec: TableSpec) -> None:
    """Fail early, naming every missing input column (instead of the first one)."""
    have = set(columns)
    missing = [c for c in spec.required_columns() if c not in have]
    if missing:
        raise MissingColumnsError(f"{spec.bronze} -> {spec.silver}: missing input columns {missing}")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _filled(orig: str, dtype: T.DataType, numeric: bool, text: bool) -> str:
    """Spark's ``fillna`` rule for one column, as a SQL expression.

    A numeric fill touches numeric columns only and also replaces NaN in
    floating columns; a string fill touches string columns only.  Any other
    type is left as it is (so a bigint id keeps its nulls under a string fill).
    """
    c = _q(orig)
    if numeric and isinstance(dtype, T.NumericType):
        v = f"nanvl({c}, NULL)" if isinstance(dtype, (T.DoubleType, T.FloatType)) else c
        return f"coalesce({v}, CAST(0 AS {dtype.simpleString()}))"
    if text and isinstance(dtype, T.StringType):
        return f"coalesce({c}, '{UNKNOWN}')"
    return c


def apply_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """flatten names + numeric fill 0 + string fill 'Unknown' -> derived levels -> select.

    All narrow, and stated as SQL expressions: one projection flattens and
    fills, each derived level but the last is one more projection, and the
    last level is computed inside the final one (so a spec costs two or three
    driver->JVM calls, not one per column operation).  Catalyst collapses them
    into the scan's single Project and prunes the scan's ReadSchema to the
    columns actually used.  Names that would collide after flattening are
    rejected.
    """
    names = [flat_name(c, spec.collapse_underscores) for c in df.columns]
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after flattening: {dup}")
    check_columns(names, spec)
    num, text = set(spec.num_fill), set(spec.str_fill)
    # one projection, stated as SQL expressions: a single driver->JVM call
    out = df.selectExpr(*[
        f"{_filled(orig, field.dataType, name in num, name in text)} AS {_q(name)}"
        for orig, name, field in zip(df.columns, names, df.schema.fields)
    ])
    levels = list(spec.derived)
    last = dict(levels.pop()) if levels else {}
    for level in levels:
        out = out.selectExpr("*", *[f"{sql} AS {_q(name)}" for name, sql in level])
    pairs = spec.output_pairs()
    if pairs is None:
        return out.selectExpr("*", *[f"{sql} AS {_q(n)}" for n, sql in last.items()]) if last else out
    return out.selectExpr(*[f"{last.get(src, _q(src))} AS {_q(alias)}" for src, alias in pairs])
