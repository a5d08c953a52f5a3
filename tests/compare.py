"""Compare a query with its SQL on the same parquet tables, outside Spark."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(directory):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"integer": "int", "bigint": "bigint", "double": "double", "varchar": "string"}


def difference(df, con, sql):
    """None if both sides hold the same rows, else a short description."""
    relation = con.sql(sql)
    expected_types = {
        c: KINDS.get(str(t).lower(), str(t).lower())
        for c, t in zip(relation.columns, relation.types)
    }
    actual_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if expected_types != actual_types:
        return f"types: {actual_types} against {expected_types}"
    actual = _table(df.collect(), df.columns)
    expected = _table(relation.fetchall(), relation.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"first difference: {a} against {e}"
    return None


def main(directory, names):
    from tidemark.queries import REGISTRY
    from tidemark.session import create_session

    spark = create_session(
        "compare",
        "local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
        log_level="ERROR",
    )
    con = connect(directory)
    bad = 0
    for name, q in REGISTRY.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        begun = time.time()
        try:
            df = q(spark, directory)
            if q.sql:
                found = difference(df, con, q.sql)
            else:
                found = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report every query, then fail
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        label = "ok" if found is None else "BAD"
        kind = "" if q.sql else " (rows only)"
        print(f"{label:4}{name}{kind} {time.time() - begun:.2f}s {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
