import itertools
import random

import pytest

from pelorus.llm import bundles
from pelorus.llm import op6_roles as op
from pelorus.llm.registry import op6_role_repair

NEXT = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def least(roles):
    """Cost of the cheapest repair, by trying everything."""
    best = {"": 0}

    def insert(costs):
        for _ in range(4):
            for s, c in list(costs.items()):
                for t in NEXT[s]:
                    costs[t] = min(costs.get(t, 10**9), c + 3)
        return costs

    for r in roles:
        new = {}
        for s, c in insert(best).items():
            for t in NEXT[s]:
                new[t] = min(new.get(t, 10**9), c + (0 if t == r else 2))
            if s:
                new[s] = min(new.get(s, 10**9), c + (1 if s == r else 3))
        best = new
    return min(c for s, c in insert(best).items() if s in ("user", "assistant"))


def legal(rendered):
    turns = [t.split("|>", 1)[0].removeprefix("<|") for t in rendered.split("<|end|>\n")[:-1]]
    state = ""
    for t in turns:
        assert t in NEXT[state], (turns, rendered)
        state = t
    return state in ("user", "assistant")


def check(turns, df):
    got = {}
    for r in df.collect():
        got.setdefault(r.conv_id, []).append(r)
    assert {c for c, *_ in turns} == set(got)
    for conv, rows in got.items():
        mine = sorted(((t, r or "", x or "") for c, t, r, x in turns if c == conv), key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
        assert len(mine) == len(rows)
        rows.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role_in or ""))
        assert sum(r.cost for r in rows) == least([r.role_in for r in rows])
        if len({(r.turn, r.role_in) for r in rows}) == len(rows):
            text = "".join(r.rendered for r in rows)
            assert legal(text) and all(x in text for _, _, x in mine)


def test_all_short_sequences():
    names = [None, "system", "user", "assistant"]
    for n in range(1, 6):
        for roles in itertools.product(names, repeat=n):
            way = op.trace([op.state_of(r) for r in roles], op.START, None)
            assert sum(w[4] for w in way) + op.closing(way[-1][1])[0] == least(roles), roles


@pytest.mark.parametrize("size, span", [(bundles.BUNDLE_BYTES, op.SPAN), (40, op.SPAN), (40, 7)])
def test_conversations_across_bundles(spark, monkeypatch, size, span):
    monkeypatch.setattr(op.bundle_files, "__defaults__", (size,))
    rng = random.Random(5)
    turns = []
    for c in range(30):
        for t in range(rng.randrange(1, 9)):
            turns.append((c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None]), f"text {c}.{t}"))
    turns += [(99, t, rng.choice(["user", "assistant", "system"]), f"hot {t}") for t in range(400)]
    turns += [(None, t, rng.choice(["user", "assistant"]), f"no id {t}") for t in range(60)]
    turns += [ (40, None, "system", "null turn"), (40, 1, "user", None), (41, 0, "system", ""), (42, 0, "user", "x" * 100000)]
    turns += [(43, 0, "user", "same")] * 3
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn int, role string, text string, action string, cost int")
    check(turns, op.format_chats(df, span=span))


def test_empty_table(spark):
    assert op.format_chats(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    check(turns, op6_role_repair(spark, sf))
