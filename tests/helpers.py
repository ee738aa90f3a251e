"""Comparison of query results."""

from collections import Counter


def norm(x):
    if isinstance(x, float):
        return "nan" if x != x else f"{x:.6g}"
    if hasattr(x, "isoformat"):
        return x.isoformat()[:19]
    return x


def bag(df):
    """Rows as a multiset, columns in name order."""
    return Counter(tuple(map(norm, r)) for r in df.select(*(f"`{c}`" for c in sorted(df.columns))).collect())


def same_as_sql(query, sql, spark, small, duck):
    df = query(spark, small)
    mine = bag(df)
    r = duck.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    assert mine == Counter(tuple(norm(x[i]) for i in at) for x in r.fetchall())
