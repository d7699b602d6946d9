"""URL filters over a memory-mapped sorted digest array (operator 6).

Rules and listed hosts are strings ``host/path-prefix``.  Their 64-bit xxhash
digests are written in ascending order to one file, with the full strings
behind them.  Workers map the file, look up the digests of all strings that
could fit a url (each suffix of its host, each listed length of its path) by
one vectorised binary search per batch, and compare the stored full string of
every hit, so a digest collision never decides.  The longest fitting rule
gives the verdict; a url without a rule is blocked if one of the listed hosts
fits it, and allowed otherwise.

Cases: a null url or one without ``://`` has an empty host and path and is
allowed; repeated rows and null ids pass through row by row; very long urls
are looked at whole; an empty list or table works as such.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Entries of a digest array file, at most: the file is shipped to every executor.
MAX_ENTRIES = 20_000_000
#: Hosts of one array when the list is a table.
SHARD_ENTRIES = 1_000_000
ALLOW, BLOCK = "allow", "block"

# The rules of the contract, as (verdict, host, path prefix).
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
# Names of advertising, gambling, adult and spam hosts, and the domains they stand under.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_DOMAINS = ("example.com", "example.net", "example.org")
LISTED_HOSTS = tuple(f"{name}.{domain}" for name in LISTED_NAMES for domain in LISTED_DOMAINS)

_HEAD = struct.Struct("<4sQ")
_MAGIC = b"SDA1"
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_PATH_END = re.compile(r"[?#]")
_HOST_END = re.compile(r"[/?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = _HOST_END.search(rest)
    if end is None:
        return rest.translate(_UPPER), ""
    host, rest = rest[: end.start()], rest[end.start() :]
    stop = _PATH_END.search(rest)
    return host.translate(_UPPER), rest[: stop.start()] if stop else rest


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def write_digests(path: str, entries: Iterable[str], hashed=digest) -> None:
    """Write the sorted digest array of ``entries`` (repeats once)."""
    listed = sorted((hashed(e), e) for e in set(entries))
    if len(listed) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} entries")
    texts = [e.encode("utf-8", "surrogatepass") for _, e in listed]
    with open(path, "wb") as out:
        out.write(_HEAD.pack(_MAGIC, len(listed)))
        out.write(np.asarray([d for d, _ in listed], "<u8").tobytes())
        out.write(np.cumsum([0, *map(len, texts)], dtype="<u8").tobytes())
        out.write(b"".join(texts))


class DigestArray:
    """A mapped digest array: exact membership of many strings at once."""

    def __init__(self, path: str, hashed=digest):
        self.hashed = hashed
        with open(path, "rb") as f:
            magic, self.n = _HEAD.unpack(f.read(_HEAD.size))
        if magic != _MAGIC:
            raise ValueError("not a digest array")
        at = _HEAD.size
        self.keys = np.memmap(path, "<u8", "r", at, (self.n,)) if self.n else np.zeros(0, "<u8")
        self.offsets = np.memmap(path, "<u8", "r", at + 8 * self.n, (self.n + 1,))
        size = int(self.offsets[-1])
        self.texts = np.memmap(path, np.uint8, "r", at + 16 * self.n + 8, (size,)) if size else np.zeros(0, np.uint8)

    def contains(self, probes: list[str]) -> np.ndarray:
        """For each probe, whether the very string is listed."""
        found = np.zeros(len(probes), bool)
        if not self.n or not probes:
            return found
        wanted = np.fromiter(map(self.hashed, probes), "<u8", len(probes))
        at = np.searchsorted(self.keys, wanted)
        hits = np.flatnonzero(self.keys[np.minimum(at, self.n - 1)] == wanted)
        for i in hits:
            own, j = probes[i].encode("utf-8", "surrogatepass"), int(at[i])
            while not found[i] and j < self.n and self.keys[j] == wanted[i]:
                found[i] = self.texts[int(self.offsets[j]) : int(self.offsets[j + 1])].tobytes() == own
                j += 1
        return found


def host_suffixes(host: str) -> list[str]:
    """The host and all its parent domains."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))] if host else []


def _sharded(rows: DataFrame, column: str, shards: int) -> DataFrame:
    """(shard, host) of the hosts in ``column``; the digests are cut into equal ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [(digest(h) * shards) >> 64 for h in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), batch.column(0)], ["shard", "host"])

    return rows.select(F.col(column).alias("host")).mapInArrow(run, "shard int, host string")


def listed_hosts_among(hosts: DataFrame, listed: DataFrame, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """The distinct ``host`` of ``hosts`` that are, or lie under, a ``host`` of the table ``listed``, of any size.

    The list is cut by digest into arrays of some ``shard_entries`` hosts, made by as
    many tasks.  Every distinct suffix of the hosts is sent to its array once, in
    parts of as many probes, and a task maps the array beside its part.
    """
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    entries = stored(listed.select(lower.alias("host")).where("host is not null and host <> ''").distinct())
    shards = max(1, -(-entries.count() // shard_entries))
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    own = stored(hosts.select("host").where("host is not null and host <> ''").distinct())
    suffixes = own.select("host", F.explode(tails).alias("suffix"))
    probes = stored(suffixes.select("suffix").distinct())
    parts = max(1, -(-probes.count() // (shards * shard_entries)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[str]] = {}
        for batch in batches:
            for shard, host in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(shard, []).append(host)
        for shard, texts in held.items():
            with tempfile.TemporaryDirectory() as folder:
                path = os.path.join(folder, "digests.bin")
                write_digests(path, texts)
                with open(path, "rb") as made:
                    data = made.read()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([data], pa.large_binary())], ["shard", "data"])

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("host").to_pylist()
        found = np.zeros(len(texts), bool)
        if texts and right.num_rows:
            with tempfile.TemporaryDirectory() as folder:  # the task's own; the array is mapped and gone with it
                path = os.path.join(folder, "digests.bin")
                with open(path, "wb") as out:
                    out.write(right.column("data")[0].as_py())
                found = DigestArray(path).contains(texts)
        return pa.table({"suffix": pa.array([t for t, f in zip(texts, found) if f], pa.string())})

    arrays = _sharded(entries, "host", shards).repartitionById(shards, F.col("shard")).mapInArrow(build, "shard int, data binary")
    arrays = arrays.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = _sharded(probes, "suffix", shards).withColumn("part", F.pmod(F.xxhash64("host"), F.lit(parts)).cast("int"))
    hits = dealt.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part")).applyInArrow(probe, "suffix string")
    return suffixes.join(hits, "suffix", "left_semi").select("host").distinct()


def judge(pages: DataFrame, rules=RULES, listed_hosts: Iterable[str] | DataFrame = LISTED_HOSTS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page's url.

    ``listed_hosts`` is a short list, shipped as one array, or a table with the column
    ``host``, looked up in as many arrays as it needs (:func:`listed_hosts_among`).
    """
    if isinstance(listed_hosts, DataFrame):
        judged = judge(pages, rules, ())
        found = listed_hosts_among(judged.select("host"), listed_hosts).withColumnRenamed("host", "_listed")
        blocked = F.col("_listed").isNotNull() & F.col("rule").isNull()
        joined = judged.join(found, F.col("host") == F.col("_listed"), "left")
        return joined.select("page_id", "host", "path", "rule", F.when(blocked, F.lit(BLOCK)).otherwise(F.col("verdict")).alias("verdict"))
    spark = pages.sparkSession
    verdicts = {host + path: verdict for verdict, host, path in rules}
    lengths = sorted({len(path) for _, _, path in rules})
    # A rule is stored as is; a listed host has no slash, so the two kinds cannot meet.
    folder = tempfile.mkdtemp()
    name = f"url-digests-{uuid.uuid4().hex}.bin"
    write_digests(os.path.join(folder, name), [*verdicts, *listed_hosts])
    spark.sparkContext.addFile(os.path.join(folder, name))  # shipped to executors, later ones too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            split = [split_url(u.as_py()) for u in batch.column(1)]
            probes, owners = [], []
            for i, (host, path) in enumerate(split):
                for suffix in host_suffixes(host):
                    own = [suffix, *(suffix + path[:n] for n in lengths if n <= len(path))]
                    probes += own
                    owners += [i] * len(own)
            best: list[str | None] = [None] * len(split)
            blocked = [False] * len(split)
            for k in np.flatnonzero(array.contains(probes)):
                probe, i = probes[k], owners[k]
                if probe not in verdicts:
                    blocked[i] = True
                elif best[i] is None or len(probe) > len(best[i]):
                    best[i] = probe
            verdict = [verdicts[r] if r is not None else BLOCK if b else ALLOW for r, b in zip(best, blocked)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array(best, pa.string()),
                    pa.array(verdict, pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return wanted.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
