"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def shown(value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return "<null>"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(shown(v) for v in row) for row in frame.itertuples(index=False))


def kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def compare(spark, key: str, function, sql: str, sf_dir: str, count: list[int] | None = None) -> str | None:
    """None where both agree, else what differs. ``count`` is given the number of rows."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    mine = function(spark, sf_dir).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if kinds(mine) != kinds(theirs):
        return f"{key}: types differ\n  {sorted(kinds(mine).items())}\n  {sorted(kinds(theirs).items())}"
    if count is not None:
        count.append(mine.num_rows)
    mine, theirs = rows(_objects(mine)), rows(_objects(theirs))
    if mine != theirs:
        left, right = [r for r in mine if r not in set(theirs)], [r for r in theirs if r not in set(mine)]
        return f"{key}: {len(mine)} rows against {len(theirs)}\n  {left[:3]}\n  {right[:3]}"
    return None


def _objects(table) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(table[c].to_pylist(), dtype=object) for c in table.column_names})


if __name__ == "__main__":
    from folioloom.registry import ORACLES, QUERIES
    from folioloom.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for key, function in QUERIES.items():
        if wanted and key not in wanted:
            continue
        began, count = time.time(), []
        try:
            if key in ORACLES:
                fault = compare(spark, key, function, ORACLES[key], sf_dir, count)
            else:
                fault = None if function(spark, sf_dir).count() else f"{key}: no rows"
        except Exception as error:  # noqa: BLE001
            fault = f"{key}: {type(error).__name__} {str(error)[:1500]}"
        bad += fault is not None
        print(f"{'FAIL' if fault else 'ok':5}{key:28}{time.time() - began:7.2f}s", *count, fault or "", flush=True)
    print(f"{len(QUERIES)} registered, {len(ORACLES)} with SQL, {bad} failed")
