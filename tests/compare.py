"""Run registered queries next to their SQL: ``python tests/compare.py sf_dir [name…]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([_cell(r[i]) for i in order] for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a short text about the first difference."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            bad = sum(p != q for p, q in zip(a, b))
            return f"{bad} rows differ, first:\n   spark {x}\n   sql   {y}"
    types = {n: str(t) for n, t in zip(names, (d[1] for d in cursor.description))}
    kind = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    for name, spark_type in df.dtypes:
        if kind.get(spark_type) != types[name]:
            return f"column {name} is {spark_type}, sql {types[name]}"
    return None if a else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as e
    from headway.session import local_session

    sf, only = sys.argv[1], sys.argv[2:]
    session, con, sql = local_session(8), connect(sf), e.oracle_sql()
    failed = 0
    for name, query in e.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            if name in sql:
                problem = compare(session, con, query, sql[name], sf)
            else:
                n = query(session, sf).count()
                problem = None if n else "no rows"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.2f}s"
              f"{'' if name in sql else ' (rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
