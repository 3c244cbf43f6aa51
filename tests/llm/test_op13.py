import hashlib
import re
from fractions import Fraction

import duckdb
import pytest

from pelorus.llm import op13_mixing as op
from pelorus.llm.registry import op13_source_mix

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size string"


def brute(rows):
    docs = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    size = {s: sum(n for _, n, x in docs if x == s) for s in sources}
    aim, open_, left = {}, set(sources), Fraction(3, 2) * sum(size.values())
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * each >= 2 * size[s]}
        if not full:
            aim.update({s: weight[s] * each for s in open_})
            break
        aim.update({s: Fraction(2 * size[s]) for s in full})
        left -= sum(2 * size[s] for s in full)
        open_ -= full
    out = []
    for s in sources:
        budget = int(aim[s])
        mine = sorted((hashlib.md5(f"0:{'' if i is None else i}".encode()).hexdigest()[:16], i is not None, i, n) for i, n, x in docs if x == s)
        times, rest = divmod(budget, size[s]) if size[s] else (0, 0)
        for _, _, i, n in mine:
            out.append((i, n, size[s], float(aim[s]), times * n + min(rest, n)))
            rest -= min(rest, n)
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 5}" if i % 3 else "big") for i in range(300)]
    rows += [(1000, None, "s1"), (1001, " \t\n", "blank"), (1002, "a b c\x0bd\x1fe", None), (7, "x y z", "s2"), (7, "x y z", "s2"), (None, "null id", "s3")]
    rows += [(2000, "long " * 5000, "Z"), (2001, "tiny", "z"), (2002, "", "")]
    df = spark.createDataFrame([(i, t, s, "x") for i, t, s in rows], SCHEMA)
    got = sorted((tuple(r) for r in op.mix(df).collect()), key=str)
    want = brute(rows)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    assert sorted((tuple(r) for r in op.mix(df.repartition(7)).collect()), key=str) == got


@pytest.mark.parametrize("rows", [[], [(1, None, None, "")], [(1, "a b", "s", "")]])
def test_small_tables(spark, rows):
    got = [tuple(r) for r in op.mix(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [{0: (1, 0, 0, 0.0, 0), 2: (1, 2, 2, 3.0, 3)}[len((r[1] or "").split())] for r in rows]


def test_budgets_are_met_exactly(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 40), f"s{i % 7}", "") for i in range(700)], SCHEMA)
    rows = op.mix(df).collect()
    for source in range(7):
        mine = [r for r in rows if r.doc_id % 7 == source]
        assert sum(r.taken for r in mine) == int(mine[0].target)
    assert all(r.taken <= 2 * r.size for r in rows)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(tuple(r) for r in op13_source_mix(spark, SF).collect()) == sorted(con.execute(op.SQL).fetchall())
