from __future__ import annotations

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    return round(v, 9) if isinstance(v, float) else v


def rows_of(columns, rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(spark_df, duck, sql) -> None:
    got = rows_of(spark_df.columns, spark_df.collect())
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(spark_df.columns)
    assert got == rows_of(names, cur.fetchall())
