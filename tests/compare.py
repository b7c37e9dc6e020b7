"""Exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_KIND = {"bigint": "int", "double": "float", "string": "text"}
DUCK_KIND = {"BIGINT": "int", "DOUBLE": "float", "VARCHAR": "text", "INTEGER": "int"}


def spark_rows(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    return names, {n: SPARK_KIND.get(kinds[n], kinds[n]) for n in names}, rows


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in result.description]
    fetched = result.fetchall()
    names = sorted(c for c, _ in columns)
    position = {c: i for i, (c, _) in enumerate(columns)}
    kinds = {c: DUCK_KIND.get(t.upper(), t) for c, t in columns}
    return names, kinds, [tuple(r[position[n]] for n in names) for r in fetched]


def differences(spark_side, duck_side) -> list[str]:
    (sn, sk, sr), (dn, dk, dr) = spark_side, duck_side
    if sn != dn:
        return [f"columns differ: {sn} / {dn}"]
    problems = [f"type of {n}: {sk[n]} / {dk[n]}" for n in sn if sk[n] != dk[n]]
    if len(sr) != len(dr):
        problems.append(f"rows: {len(sr)} / {len(dr)}")
    a, b = Counter(sr), Counter(dr)
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    if only_a or only_b:
        def key(r):
            return tuple((x is None, str(x)) for x in r)
        only_a.sort(key=key), only_b.sort(key=key)
        problems.append(f"{len(only_a)} rows only in spark, {len(only_b)} only in sql; columns {sn}")
        problems += [f"  spark {r}" for r in only_a[:4]] + [f"  sql   {r}" for r in only_b[:4]]
    return problems
