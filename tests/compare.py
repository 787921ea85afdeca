"""Run registered queries next to their SQL: python tests/compare.py [folder] [name part ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> list[str]:
    """What is different between a query's result and its SQL's: types, names, rows."""
    table = con.sql(sql)
    kinds = {"long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    ours = {f.name: kinds.get(f.dataType.typeName(), f.dataType.simpleString().upper()) for f in df.schema.fields}
    theirs = {n: str(k) for n, k in zip(table.columns, table.types)}
    found = []
    if {n: k.replace(", ", ",").replace(" ", "") for n, k in theirs.items()} != ours:
        found.append(f"schema {ours} is not {theirs}")
    left = canonical([tuple(r) for r in df.collect()], df.columns)
    right = canonical(table.fetchall(), table.columns)
    if left != right:
        found.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; only here {list((left - right).items())[:3]}; "
            f"only in SQL {list((right - left).items())[:3]}"
        )
    return found


def main(folder: str = "/root/testdata/sf0.001", *parts: str) -> int:
    import __spark_entry__ as entry
    from asterism.session import build_session

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in entry.queries().items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            found = differences(query(spark, folder), con, sql) if sql else [f"no SQL, {query(spark, folder).count()} rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found) and not found[0].startswith("no SQL")
        print(f"{'ok ' if not found else 'BAD'} {time.time() - start:6.2f} {name}", *found, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
