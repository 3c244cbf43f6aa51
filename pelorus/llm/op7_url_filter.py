"""URL rules in a sorted digest array.

Rules ``(host, path, verdict)`` are keyed by the 64-bit xxhash of ``host + path``. Spark range-partitions them by
key; every partition writes its sorted keys, verdicts and full strings as flat files. Tasks memory-map the files, probe
all candidate strings of a slice of URLs at once by binary search, and compare the stored string of every hit, so a
digest collision never decides. Candidates of a URL are its host's suffixes at label borders times its path's
prefixes of the lengths that rules have.

Edge cases: a null URL or one without ``://`` has empty host and path and fits no rule; a URL that fits no rule is
not listed, so it is allowed. Only A-Z are lower-cased, ports and user names stay in the host. Of rules that fit, the
longest string wins, then the longer host. Repeated rules count once; where they disagree, block wins. Without
rules everything is allowed. Repeated and null page ids are returned as they come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import attempt_name, create, mapped, new_folder
from ..session import durable
from .common import arrow_schema

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    stop = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[stop:]
    end = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:stop].translate(_LOWER), path[:end]


class DigestArray:
    """A written rule set: files in key order, the path lengths that occur, and the length of the longest host."""

    def __init__(self, folder: str, files: list[tuple[int, int, str]], lengths: list[int], longest: int, hasher=digest):
        self.folder, self.files, self.lengths, self.longest, self.hasher = folder, files, lengths, longest, hasher

    def suffixes(self, host: str) -> list[str]:
        """The host and its parent domains that are no longer than the longest stored host."""
        tail = host[-self.longest - 1 :] if self.longest else ""
        whole = [host] if host and len(host) <= self.longest else []
        return whole + [tail[i + 1 :] for i, c in enumerate(tail) if c == "."]

    def open(self) -> Probe:
        return Probe(self)


class Probe:
    """The memory-mapped arrays of one task."""

    def __init__(self, array: DigestArray):
        self.lasts = np.array([last for _, last, _ in array.files], "u8")
        self.parts = []
        for _, _, name in array.files:
            part = [mapped(array.folder, f"{name}.{kind}", t) for kind, t in (("key", "<u8"), ("off", "<i8"), ("cut", "<i4"), ("block", "u1"), ("str", "u1"))]
            self.parts.append(part)

    def find(self, keys: np.ndarray, strings: list[str], hosts: list[int]) -> list[bool | None]:
        """Per candidate: True for a block rule, False for an allow rule, None if not stored. ``hosts`` holds the bytes of the
        host part, since ``host + path`` alone would not tell where the host ends."""
        out: list[bool | None] = [None] * len(keys)
        where = np.searchsorted(self.lasts, keys)
        for p, (key, off, cut, block, blob) in enumerate(self.parts):
            mine = np.flatnonzero(where == p)
            lo = np.searchsorted(key, keys[mine], "left")
            hi = np.searchsorted(key, keys[mine], "right")
            for i, a, b in zip(mine.tolist(), lo.tolist(), hi.tolist(), strict=True):
                for k in range(a, b):
                    if cut[k] == hosts[i] and blob[off[k] : off[k + 1]].tobytes() == strings[i].encode():
                        out[i] = bool(block[k])
                        break
        return out


def build(rules: DataFrame, host_col: str = "host", path_col: str = "path", verdict_col: str = "verdict", hasher=digest) -> DigestArray:
    """Write ``rules`` as digest arrays; null hosts or paths are empty, an empty host fits nothing and is left out."""
    spark = rules.sparkSession
    folder = new_folder(spark, "digests")
    lower = F.translate(F.coalesce(F.col(host_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = rules.select(lower.alias("host"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), (F.col(verdict_col) == "block").alias("block"))
    plain = plain.filter("host <> ''").groupBy("host", "path").agg(F.max("block").alias("block"))

    def keyed(batches):
        for b in batches:
            hosts, paths = b.column(0).to_pylist(), b.column(1).to_pylist()
            # As signed with the top bit flipped, so that Spark's order is the unsigned one.
            keys = [hasher(h + p) - (1 << 63) for h, p in zip(hosts, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *b.columns], ["key", "host", "path", "block"])

    def write(batches):
        keys, cuts, blocks, strings = [], [], [], []
        for b in batches:
            hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
            keys += [k + (1 << 63) for k in b.column(0).to_pylist()]
            cuts += [len(h.encode()) for h in hosts]
            blocks += [bool(x) for x in b.column(3).to_pylist()]
            strings += [(h + p).encode() for h, p in zip(hosts, paths, strict=True)]
        if not keys:
            return
        name = attempt_name(TaskContext.get().partitionId())
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        for kind, data in (
            ("key", np.array(keys, "<u8")), ("off", offsets.astype("<i8")), ("cut", np.array(cuts, "<i4")),
            ("block", np.array(blocks, "u1")), ("str", np.frombuffer(b"".join(strings), "u1")),
        ):
            with create(folder, f"{name}.{kind}") as f:
                f.write(data.tobytes())
        row = [pa.array([keys[0] - (1 << 63)], pa.int64()), pa.array([keys[-1] - (1 << 63)], pa.int64()), pa.array([name])]
        yield pa.RecordBatch.from_arrays(row, ["first", "last", "name"])

    stored = plain.mapInArrow(keyed, "key bigint, host string, path string, block boolean")
    ordered = stored.repartitionByRange("key").sortWithinPartitions("key", "host", "path")
    manifest = durable(ordered.mapInArrow(write, "first bigint, last bigint, name string"))
    # One row per file, and one per distinct path length: both small whatever the number of rules.
    files = sorted((r["first"] + (1 << 63), r["last"] + (1 << 63), r["name"]) for r in manifest.collect())
    lengths = sorted(r[0] for r in plain.select(F.length("path")).distinct().collect())
    longest = plain.agg(F.coalesce(F.max(F.length("host")), F.lit(0))).first()[0]
    return DigestArray(folder, files, lengths, longest, hasher)


def judge(pages: DataFrame, array: DigestArray, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row; narrow, no shuffle."""
    ddl = f"`{id_col}` {dict(pages.dtypes)[id_col]}, host string, path string, rule string, verdict string"
    schema = arrow_schema(ddl)

    def run(batches):
        probe = array.open()
        for b in batches:
            cut = [split_url(u) for u in b.column(1).to_pylist()]
            strings, sizes, owner = [], [], []
            for row, (host, path) in enumerate(cut):
                for suffix in array.suffixes(host):
                    for n in array.lengths:
                        if n <= len(path):
                            strings.append(suffix + path[:n])
                            sizes.append(len(suffix.encode()))
                            owner.append(row)
            best: list[tuple[int, int, str, bool] | None] = [None] * len(cut)
            keys = np.array([array.hasher(s) for s in strings], "u8")
            for row, s, size, hit in zip(owner, strings, sizes, probe.find(keys, strings, sizes), strict=True):
                if hit is not None:
                    mine = (len(s), size, s, hit)
                    if best[row] is None or mine > best[row]:
                        best[row] = mine
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([h for h, _ in cut], pa.string()),
                    pa.array([p for _, p in cut], pa.string()),
                    pa.array([x and x[2] for x in best], pa.string()),
                    pa.array(["block" if x and x[3] else "allow" for x in best], pa.string()),
                ],
                schema=schema,
            )

    return pages.select(F.col(id_col), F.col(url_col).cast("string")).mapInArrow(run, ddl)


SQL = """
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
  SELECT page_id, substr(url, strpos(url, '://') + 3) AS rest, coalesce(strpos(url, '://'), 0) > 0 AS ok FROM pages
), parts AS (
  SELECT page_id, CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*') ELSE '' END AS raw, rest, ok FROM cut
), urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN ok THEN regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') ELSE '' END AS path
  FROM parts
), fits AS (
  SELECT u.page_id, u.host, u.path, r.rhost || r.rpath AS rule, r.rverdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS k
  FROM urls u LEFT JOIN rules r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE k = 1
"""
