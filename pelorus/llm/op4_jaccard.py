"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct 5-word shingles (64-bit hashes). All documents order their shingles alike: by how often they occur, then by
hash. Two sets of similarity 3/4 or more share at least ``t = ceil(3n/4)`` shingles, so their first
``n - t + l`` ones share at least l. Each document picks its own l: longer prefixes cost more list entries but leave fewer candidates to
verify, and the estimate weighs both from the occurrence counts. A pair is verified if it shares min(l, l') prefix shingles.

Steps: bundles exchange shingle counts (`bundles`); equal sets become one class, within a bundle first and then over all; prefixes with fewer than l repeated
shingles cannot match and are dropped with proof; prefix shingles connect classes into candidate groups; groups
up to ``BLOCK`` classes are joined in one task, larger ones in cells of two blocks; verified links are connected to components.

Edge cases: null, empty and blank texts have an empty set, link with nothing and are their own component. Rows that repeat a
document id are separate rows with the same id. A null id takes part in links but never names a component: a component without an id is null.
Columns beyond the named ones are carried by ``one_per_group`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from ..session import durable
from .bundles import beside, bundle_files, collected, repeated_keys, slots_for, unpack_rows
from .common import arrow_schema, tidy
from .components import components

SIZE = 5
# Classes that one task joins at once; a larger candidate group is cut into blocks and joined block against block.
BLOCK = 128
_BLOCK_SHINGLES = 1_000_000
_MAX_L = 8
# What one verification costs, in list entries.
_VERIFY_COST = 50

# Bytes between words (space and 9 to 13) as a space, A-Z as lower case, all others unchanged.
WORD_BYTES = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingler(size: int = SIZE) -> Callable[[str | None], np.ndarray]:
    """A function from a text to the sorted distinct hashes of its shingles."""
    word_hash = lru_cache(maxsize=200_000)(xxhash.xxh64_intdigest)

    def shingles(text: str | None) -> np.ndarray:
        found = (text or "").encode().translate(WORD_BYTES).split()
        h = np.fromiter(map(word_hash, found), "u8", len(found))
        if not len(h):
            return h
        n = min(size, len(h))
        total = np.zeros(len(h) - n + 1, "u8")
        for k in range(n):
            total = _mix(total + h[k : len(h) - n + 1 + k])
        return np.unique(total)

    return shingles


def least_shared(n: int) -> int:
    """Fewest shingles that a set of n shares with any set it is linked to."""
    return -(-3 * n // 4)


def choose_prefix(n: int, counts: np.ndarray) -> tuple[int, int]:
    """``(l, length)`` for a set of n whose counts are in global order: the cheapest by list entries plus verifications."""
    t = least_shared(n)
    others = np.concatenate([[0], np.cumsum(counts - 1)])
    best = None
    for l in range(1, min(_MAX_L, t) + 1):
        length = n - t + l
        cost = others[length] * (1 + _VERIFY_COST / l)
        if best is None or cost < best[0]:
            best = (cost, l, length)
    return best[1], best[2]


def _uids(bundle: int, n: int) -> np.ndarray:
    """Row numbers that are unique over all bundles: partition, bundle and row, 21 bits each."""
    return ((bundle >> 32) << 42 | (bundle & 0xFFFFFFFF) << 21) + np.arange(n, dtype="int64")


def _found_ddl(kind: str) -> str:
    return f"uid bigint, doc_id {kind}, n bigint, rep bigint, k1 bigint, k2 bigint, l bigint, prefix binary, rest binary"


def _prefixes(key_bits: int, schema: pa.Schema):
    """Every document with its set's size and digest, and ``rep``, the first row of the bundle that has an equal set. The standing row of a
    set that may have a partner also gets its repeated shingles and how many of them are prefix."""

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        tidy()
        if not left.num_rows:
            return schema.empty_table()
        rows = unpack_rows(left.column("blob")[0].as_py())
        keys, counts = collected(right)
        shingles, shift = shingler(), np.uint64(64 - key_bits)
        uid = _uids(left.column("bundle")[0].as_py(), rows.num_rows)
        first: dict[bytes, int] = {}
        digests, sizes, reps = [], [], []
        ls, prefix, rest = ([None] * rows.num_rows for _ in range(3))
        for i, text in enumerate(rows.column(1).to_pylist()):
            mine = shingles(text)
            digests.append(xxhash.xxh3_128_digest(mine.tobytes()))
            sizes.append(len(mine))
            at_first = first.setdefault(digests[-1], i)
            reps.append(int(uid[at_first]))
            if at_first != i or not len(mine):
                continue
            short = mine >> shift
            at = np.minimum(np.searchsorted(keys, short), max(len(keys) - 1, 0))
            n_times = np.where(keys[at] == short, counts[at], 1) if len(keys) else np.ones(len(mine), "int64")
            shared = n_times >= 2
            if shared.sum() < least_shared(len(mine)):
                continue  # no other set can share enough
            order = np.lexsort((mine, n_times))
            ordered, times = mine[order], n_times[order]
            l, length = choose_prefix(len(mine), times)
            shared = times >= 2
            if shared[:length].sum() < l:
                continue
            ls[i], prefix[i], rest[i] = l, ordered[:length][shared[:length]].tobytes(), ordered[length:].tobytes()
        pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [pa.array(uid), rows.column(0), pa.array(sizes), pa.array(reps), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(ls), pa.array(prefix), pa.array(rest)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return apply


def _tokens(batches):
    for b in batches:
        lists = [np.frombuffer(p, "<i8") for p in b.column(1).to_pylist()]
        sizes = [len(x) for x in lists]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column(0).to_numpy(), sizes)), pa.array(np.concatenate([*lists, np.zeros(0, "<i8")]))], ["uid", "token"]
        )


def _common(prefixes: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of shared entries of all sets."""
    m = len(prefixes)
    owner = np.repeat(np.arange(m), [len(p) for p in prefixes])
    _, token, freq = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
    keep = freq[token] >= 2
    owner, token = owner[keep], token[keep]
    _, token = np.unique(token, return_inverse=True)
    out = np.zeros((m, m), "float32")
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    n = int(token[-1]) + 1 if len(token) else 0
    for start in range(0, n, 2048):
        a, b = np.searchsorted(token, [start, start + 2048])
        dense = np.zeros((min(2048, n - start), m), "float32")
        dense[token[a:b] - start, owner[a:b]] = 1
        out += dense.T @ dense
    return out


def join_cell(uids: np.ndarray, n: np.ndarray, l: np.ndarray, prefixes: list[np.ndarray], sets: list[np.ndarray], block: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all linked sets of a cell (a spanning forest of them). Sets of different blocks are compared with
    each other; if there is one block only, all are."""
    m = len(uids)
    shared = np.triu(_common(prefixes), 1)
    need = np.minimum(l[:, None], l[None, :])
    fits = 4 * np.minimum(n[:, None], n[None, :]) >= 3 * np.maximum(n[:, None], n[None, :])
    across = block[:, None] != block[None, :] if len(np.unique(block)) > 1 else True
    a, b = np.nonzero(np.triu(fits & (shared >= need) & across, 1))
    order = np.argsort(-shared[a, b], kind="stable")
    root = list(range(m))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        x, y = find(i), find(j)
        if x != y:
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 75 * (int(n[i]) + int(n[j]) - both):
                root[max(x, y)] = min(x, y)
                links.append((int(uids[i]), int(uids[j])))
    return links


def _join(table: pa.Table) -> pa.Table:
    tidy()
    table = table.combine_chunks()
    prefixes = [np.frombuffer(p, "<u8") for p in table.column("prefix").to_pylist()]
    rests = [np.frombuffer(r, "<u8") for r in table.column("rest").to_pylist()]
    sets = [np.sort(np.concatenate(x)) for x in zip(prefixes, rests, strict=True)]
    links = join_cell(
        table.column("uid").to_numpy(), table.column("n").to_numpy(), table.column("l").to_numpy(), prefixes, sets, table.column("block").to_numpy()
    )
    return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def _cells(candidates: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """Every candidate class in the cells of its group: one cell for a small group, else one for each pair of its blocks."""
    sized = groups.withColumnRenamed("node", "uid").join(candidates.select("uid", "n"), "uid")
    most = F.greatest(F.count("*") / block, F.sum("n") / _BLOCK_SHINGLES)
    sizes = sized.groupBy("component").agg(F.ceil(most).cast("int").alias("blocks"))
    placed = sized.join(sizes, "component").select("uid", "component", "blocks")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = candidates.join(placed, "uid").select("uid", "n", "l", "prefix", "rest", "component", "block", other)
    return spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def linked(rows: DataFrame, bundles: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """For ``rows (doc_id, text, ...)`` and their bundles: ``found (uid, doc_id, n, rep, ...)`` of all documents, and ``groups (rep, group)``
    with the standing rows of all non-empty sets; rows of one group are equal or linked."""
    # A word takes two bytes at least. Bits that tell almost all shingles apart; a clash only makes a shingle look more frequent.
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key_bits = min(64, max(20, (n_bytes // 2 + 1).bit_length() + 6))

    def keys_of():
        shingles, shift = shingler(), np.uint64(64 - key_bits)
        return lambda batch: np.concatenate([shingles(t) >> shift for t in batch.column(1).to_pylist()] or [np.zeros(0, "u8")])

    answers = repeated_keys(bundles, keys_of, min(slots_for(n_bytes // 6), key_bits - 1), key_bits)
    ddl = _found_ddl(dict(rows.dtypes)["doc_id"])
    found = durable(beside(bundles, answers, _prefixes(key_bits, arrow_schema(ddl)), ddl))
    # One row per bundle and distinct set; both sides are written, so that a set in very many bundles is split by the join.
    reps = found.filter("uid = rep and n > 0").select("rep", "k1", "k2")
    first = durable(reps.groupBy("k1", "k2").agg(F.min("rep").alias("class")))
    classes = durable(reps.join(first, ["k1", "k2"]).select("rep", "class"))
    standing = classes.filter("rep = class").select(F.col("rep").alias("uid"))
    with_prefix = found.filter(F.col("prefix").isNotNull()).select("uid", "n", "l", "prefix", "rest")
    candidates = durable(with_prefix.join(standing, "uid", "left_semi"))
    tokens = candidates.select("uid", "prefix").mapInArrow(_tokens, "uid bigint, token bigint")
    least = tokens.groupBy("token").agg(F.min("uid").alias("b"), F.count("*").alias("many")).filter("many > 1").select("token", "b")
    edges = tokens.join(least, "token").filter("uid <> b").select(F.col("uid").alias("a"), "b")
    groups = components(edges)
    cells = _cells(candidates, durable(groups), block)
    links = cells.groupBy("component", "i", "j").applyInArrow(_join, "a bigint, b bigint")
    linked_classes = durable(components(links)).select(F.col("node").alias("class"), "component")
    return found, durable(classes.join(linked_classes, "class", "left").select("rep", F.coalesce("component", "class").alias("group")))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found, groups = linked(rows, bundle_files(rows, 1), block)
    # Names come from standing rows, one per bundle and set, so a large group is added up before it travels.
    least = found.filter("n > 0").groupBy("rep").agg(F.min("doc_id").alias("least"))
    named = durable(groups.join(least, "rep").select("rep", "group", "least"))
    names = durable(named.groupBy("group").agg(F.min("least").alias("name")))
    by_rep = durable(named.join(names, "group").select("rep", "name"))
    joined = found.select("doc_id", "n", "rep").join(by_rep, "rep", "left")
    own = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return joined.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with the same columns, one row of each group: the one with the smallest document id (rows without a set all
    stay). The rows travel in the bundles, so a kept row comes out of the very bundle it was judged in."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest)
    bundles = bundle_files(rows, 1)
    found, groups = linked(rows, bundles, block)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))
    best = found.filter("n > 0").groupBy("rep").agg(F.min(order).alias("best")).join(groups, "rep").groupBy("group").agg(F.min("best").alias("best"))
    best = best.select(F.col("best.uid").alias("uid")).unionByName(found.filter("n = 0").select("uid"))
    home = best.select((F.shiftleft(F.shiftright("uid", 42), 32) + F.shiftright("uid", 21) % (1 << 21)).alias("bundle"), "uid")
    schema = StructType([StructField("rest", rows.schema["rest"].dataType), StructField("text", StringType())])
    arrow = to_arrow_schema(schema)

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        held = unpack_rows(left.column("blob")[0].as_py())
        at = np.sort(right.column("uid").to_numpy() & ((1 << 21) - 1))
        kept = held.take(pa.array(at))
        return pa.Table.from_batches([kept.select([2, 1])]).rename_columns(["rest", "text"]).cast(arrow)

    kept = beside(bundles, home, keep, schema)
    return kept.select(*[(F.col("text") if c == text_col else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
