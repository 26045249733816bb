"""Order-free, exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def _column(table: pa.Table, name: str) -> list:
    values = table.column(name)
    if pa.types.is_timestamp(values.type):
        values = values.cast(pa.timestamp("us"))
    return [repr(v + 0.0) if isinstance(v, float) else v for v in values.to_pylist()]


def types_of(table: pa.Table) -> dict[str, str]:
    def kind(t: pa.DataType) -> str:
        return "timestamp" if pa.types.is_timestamp(t) else str(t).replace("large_", "")

    return {f.name: kind(f.type) for f in table.schema}


def differences(ours: pa.Table, theirs: pa.Table) -> list[str]:
    """Human-readable differences, none if the results are equal."""
    found = []
    if set(ours.column_names) != set(theirs.column_names):
        return [f"columns {sorted(set(ours.column_names) ^ set(theirs.column_names))}"]
    a, b = types_of(ours), types_of(theirs)
    found += [f"type of {c}: {a[c]} / {b[c]}" for c in a if a[c] != b[c]]
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} / {theirs.num_rows}")
    names = sorted(ours.column_names)
    left = Counter(zip(*[_column(ours, c) for c in names]))
    right = Counter(zip(*[_column(theirs, c) for c in names]))
    only_left, only_right = list((left - right).elements()), list((right - left).elements())
    if only_left or only_right:
        found.append(f"{len(only_left)} rows only ours, {len(only_right)} only theirs, columns {names}")
        order = lambda r: tuple(str(x) for x in r)
        found += [f"  ours   {r}" for r in sorted(only_left, key=order)[:3]]
        found += [f"  theirs {r}" for r in sorted(only_right, key=order)[:3]]
    return found
