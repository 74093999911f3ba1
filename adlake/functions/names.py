"""PRJ-1 / PRJ-2: flatten dotted report column names."""

from __future__ import annotations

from pyspark.sql import DataFrame


def flat_name(name: str, collapse: bool = False) -> str:
    out = name.replace(".", "_")
    return out.replace("__", "_") if collapse else out


def flatten_names(df: DataFrame, collapse: bool = False) -> DataFrame:
    """Rename every column ``a.b.c`` -> ``a_b_c`` (optionally ``__`` -> ``_``).

    A positional ``toDF`` rename (one Project, no data movement).  Two input
    names that flatten to the same name would make later references ambiguous,
    so that is rejected up front.
    """
    names = [flat_name(c, collapse) for c in df.columns]
    seen: dict[str, str] = {}
    clashes = []
    for old, new in zip(df.columns, names):
        if new in seen:
            clashes.append(f"{seen[new]!r} and {old!r} -> {new!r}")
        seen.setdefault(new, old)
    if clashes:
        raise ValueError("column names collide after flattening: " + "; ".join(clashes))
    if names == df.columns:
        return df
    return df.toDF(*names)
