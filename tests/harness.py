"""Compare a registered query with its SQL on the same Parquet files.

Run ``python -m tests.harness [name ...]`` for a report; ``SF_DIR`` picks the data, and ``SPARK_CONF``
(``key=value,key=value``) sets a session other than the usual one.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

from millrace.session import TABLES, local_session

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")

# Spark type name -> the DuckDB type a matching column must have.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def oracle_connection(sf_dir: str = SF_DIR):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, connection, sql: str) -> list[str]:
    """Problems found; empty when columns, types, row counts and values all agree."""
    result = connection.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    names = sorted(described)
    problems = []
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    for field in df.schema:
        kind = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != described[field.name]:
            problems.append(f"type of {field.name}: {kind} != {described[field.name]}")
    order = [list(described).index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    actual = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    bad = [(a, b) for a, b in zip(actual, expected) if not all(map(_same, a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} sql={bad[0][1]} ({names})")
    return problems


def main(names: list[str]) -> int:
    from millrace.plans import ORACLES, QUERIES

    conf = dict(pair.split("=", 1) for pair in os.environ.get("SPARK_CONF", "").split(",") if pair)
    spark = local_session(8, **conf)
    connection = oracle_connection()
    failures = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, SF_DIR)
            if name in ORACLES:
                problems = compare(df, connection, ORACLES[name])
                if not problems and df.limit(1).count() == 0:
                    problems = ["no rows"]
                note = "; ".join(problems)[:900] or "ok"
            else:
                note = f"rows only: {df.count()}"
                problems = []
        except Exception as error:  # report and go on
            problems = [str(error)]
            note = "FAILED " + (str(error)[:600] if not os.environ.get("TRACE") else traceback.format_exc()[-3000:])
        failures += bool(problems)
        mark = "BAD " if problems else "    "
        print(f"{mark}{name}: {note} [{time.time() - started:.1f}s]", flush=True)
    print(f"{failures} problems", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
