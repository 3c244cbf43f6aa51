import hashlib
import random
import zlib

import duckdb
import pytest

from pelorus.llm import op12_merkle as op
from pelorus.llm.registry import op12_merkle_manifest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, tree string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(level):
    """The top of a list of digests and the steps (left, right) of each."""
    steps = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            steps[k].append((run[: i % 3], run[i % 3 + 1 :]))
        level = [H(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], steps


def brute(rows):
    by = {}
    for r in rows:
        text = r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r[:5]), leaf([*r[:4], text]), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: climb([x[2] for x in sorted(by[s])]) for s in names}
    root, above = climb([tops[s][0] for s in names]) if names else (None, [])
    out = []
    for k, s in enumerate(names):
        for x, steps in zip(sorted(by[s]), tops[s][1], strict=True):
            proof = steps + above[k]
            h = x[3]
            for left, right in proof:
                h = H(*left, h, *right)
            out.append((x[4], x[2], tops[s][0], root, H(*[d for a, b in proof for d in a + b]), h, h == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_brute_force(spark, levels):
    rng = random.Random(levels)
    rows = [(i, f"s{min(rng.randrange(12), 8)}", rng.choice(["en", None]), i * 3, f"line {i}\nnext é\n" * (i % 3)) for i in range(260)]
    rows += [(1000 + i, None, None, None, None) for i in range(5)] + [(2000, "alone", "de", 1, "\n"), (None, "s1", "en", 4, "a\nb"), (None, None, None, None, "\n")]
    rows += [rows[3], rows[3], (7, "s1", "xx", 0, ""), (2001, "", "de", 1, "x\n" * 4000), (2002, "é", "de", 1, "z"), (2003, "zz", "de", -1, "z")]
    df = spark.createDataFrame([(*r, 0, "t") for r in rows], SCHEMA)
    got = rows_of(op.report(df, levels=levels))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 27, 28])
def test_small_trees(spark, n):
    rows = [(i, "s", "en", 1, "a\nb") for i in range(n)]
    assert rows_of(op.report(spark.createDataFrame([(*r, 0, "t") for r in rows], SCHEMA), levels=1)) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"host{i // 2}", "en", 1, "a") for i in range(300)]
    assert rows_of(op.report(spark.createDataFrame([(*r, 0, "t") for r in rows], SCHEMA), levels=2)) == brute(rows)


def test_a_block_bounds_the_queue():
    block = op.Block("t", 0, 10**6, 6, 3)
    longest = 0
    for i in range(729):
        block.leaf(i, bytes([i % 256]) * 32)
        longest = max(longest, len(block.queue))
    block.forward()
    assert longest == 729 and block.height == 6 and len(block.tape) == (729 - 1) // 2


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert rows_of(op12_merkle_manifest(spark, SF)) == sorted(con.execute(op.SQL).fetchall(), key=str)
