import hashlib

import duckdb

from pelorus.llm import op2_lines as op
from pelorus.llm.registry import op2_line_dedup

SF = "/root/testdata/sf0.01"


def brute(rows, min_sites):
    sites, first = {}, {}
    for i, text, site in rows:
        for p, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                sites.setdefault(line, set()).add(site)
                first[line] = min(first.get(line, (i, p)), (i, p))
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        gone = [bool(x.strip(" ")) and len(sites[x]) >= min_sites and first[x] != (i, p) for p, x in enumerate(lines)]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, len(lines) if text else 0, sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, text string, source string, n_lines int, _removed string")


def test_threshold_is_exact(spark):
    rows = []
    for n in range(1, 60):  # line n is on n sites
        for s in range(n):
            rows.append((len(rows), f"own {len(rows)}\nline {n}\n\nline {n}", f"s{s}"))
    rows += [(5000, None, "s1"), (5001, "", "s2"), (5002, "line 40\n" * 3000, None), (5003, "line 30", "s0")]
    for sites in (2, 10, 33):
        got = op.report(docs_of(spark, rows), sites)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, sites)


def test_columns_kept_and_repeats(spark):
    rows = [(i, "shared\nmine " + str(i), f"s{i}") for i in range(4)] + [(3, "shared\nmine 3", "s3"), (None, "shared", "s9")]
    out = op.without_boilerplate(docs_of(spark, rows), 3)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "_removed"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect()) == [
        (False, 0, "shared\nmine 0"), (False, 1, "mine 1"), (False, 2, "mine 2"), (False, 3, "mine 3"), (False, 3, "mine 3"), (True, 0, "")
    ]
    assert op.report(docs_of(spark, rows).limit(0)).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = sorted(tuple(r) for r in op2_line_dedup(spark, SF).collect())
    assert got == sorted(con.execute(op.SQL).fetchall())
    assert sum(r[2] for r in got) > 0
