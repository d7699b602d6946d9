"""Embedding near-duplicates by spherical-cap filters (operator 8).

Filters are directions made of code words: a random rotation cuts a unit
vector into two halves, and every pair of code words of the halves' random
codes is one filter.  A vector belongs to all filters whose direction it
exceeds by a threshold; the product structure lists them without trying each
(list decoding).  Vectors of one label that share a filter are compared in
double precision.  The threshold keeps a filter's share of random vectors
small at the given table size, and the number of code words is raised until
random pairs at the linking cosine share ``SHARED`` filters on average.

Equal vectors of a label are joined to one representative first.  A filter
with many members is cut into tiles, so no task has to hold it; a pair that
shares several filters is counted in the smallest of them, and tiles return a
count per vector and a spanning forest of their links, never all pairs.

Cases: rows with a null label or a vector that is null, zero or holds null or
non-finite components link with nothing and stand alone; rows with a null id
take no part and are kept; rows that repeat an id are vectors of their own
for counting; vectors of different lengths, however many lengths there are, are
never compared; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored

COSINE = 0.93
#: Random codes (rotations), and filters that a pair at the linking cosine shares on average over all codes.
CODES = 8
SHARED = 16.0
#: Random pairs on which that is measured.
TRIALS = 200
#: Random vectors of a label in one filter, on average, and the largest share of them.
CROWD = 8.0
LARGEST_SHARE = 1e-3
#: Largest threshold: a direction further than this from every vector is of no use.
LARGEST_LEVEL = 0.5
#: Vectors of a filter in one tile.
TILE = 512
#: Lengths of vectors in one pass: the filters of these are sent to the workers.
LENGTHS_AT_ONCE = 4
#: Keys of a tile's vectors that are compared at once.
KEYS_AT_ONCE = 4096


class CapCode:
    """The filters of one rotation: all pairs of code words of two halves."""

    def __init__(self, dims: int, words: int, level: float, seed: int):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        self.half = dims // 2
        self.level = level * math.sqrt(2)
        self.books = []
        for size in (self.half, dims - self.half):
            book = rng.standard_normal((words, max(1, size)))
            self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True))

    def filters(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the ascending numbers of the filters it exceeds."""
        turned = units @ self.rotation
        halves = turned[:, : self.half], turned[:, self.half :]
        near = [h @ b[:, : h.shape[1]].T if h.shape[1] else np.zeros((len(units), len(b))) for h, b in zip(halves, self.books)]
        out = []
        words = len(self.books[1])
        for first, second in zip(*near):
            order = np.argsort(-second)
            ranked = -second[order]  # ascending
            open_words = np.flatnonzero(first - ranked[0] >= self.level)
            counts = np.searchsorted(ranked, first[open_words] - self.level, side="right")
            found = [w * words + order[:c] for w, c in zip(open_words, counts)]
            out.append(np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64))
        return out


def random_pairs(dims: int, cosine: float, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and partners at exactly the given cosine (in one dimension: the same)."""
    rng = np.random.default_rng(seed)
    a, side = rng.standard_normal((2, n, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    if dims == 1:
        return a, a
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return a, cosine * a + math.sqrt(1 - cosine**2) * side


class CapFilters:
    """All codes for a dimension and a crowd (vectors of the largest label)."""

    def __init__(self, dims: int, crowd: int, cosine: float = COSINE):
        self.dims = dims
        share = min(LARGEST_SHARE, CROWD / max(1, crowd))
        level = min(LARGEST_LEVEL, -NormalDist().inv_cdf(share) / math.sqrt(dims))
        words = max(2, math.ceil(math.sqrt(2 * SHARED / CODES / share)))
        one, two = random_pairs(dims, cosine, TRIALS)
        while True:
            self.space = words * words
            self.codes = [CapCode(dims, words, level, 100 + i) for i in range(CODES)]
            shared = np.mean([len(np.intersect1d(x, y)) for x, y in zip(self.keys(one), self.keys(two))])
            if shared >= SHARED:
                break
            words = math.ceil(words * min(2.0, max(1.05, math.sqrt(SHARED / max(shared, 0.1)))))

    def keys(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the ascending keys of all its filters."""
        own = [code.filters(units) for code in self.codes]
        return [np.concatenate([k + i * self.space for i, k in enumerate(x)]) for x in zip(*own)]


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Vectors at length 1, in double precision; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def packed(vector: np.ndarray) -> bytes:
    """A vector's components as floats where these hold them exactly, else as doubles."""
    with np.errstate(over="ignore"):
        single = vector.astype("<f4")
    return (single if (single == vector).all() else vector.astype("<f8")).tobytes()


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f4" if len(data) == 4 * dims else "<f8").astype(np.float64)


def forest(n: int, links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest (parent, child) of the links between rows."""
    around = np.zeros((n, n), bool)
    around[np.ix_(left, right)] = links
    around |= around.T
    fresh = np.ones(n, bool)
    out = []
    for start in range(n):
        if not fresh[start]:
            continue
        fresh[start] = False
        stack = [start]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(around[at] & fresh)
            fresh[new] = False
            out += [(at, int(x)) for x in new]
            stack += new.tolist()
    return out


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    given = F.col(vector_column).cast("array<double>")
    sound = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        given, lambda x: x != 0
    )
    key = F.when(
        F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & sound,
        # -0.0 and 0.0 are one component
        F.struct(F.col(label_column).cast("string").alias("label"), F.transform(given, lambda x: x + F.lit(0.0)).alias("v")),
    )
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), key.alias("key"))
    same = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(same.select("rep", "copies", F.col("key.label").alias("label"), F.col("key.v").alias("v")))
    crowds = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    lengths = sorted(r[0] for r in reps.select(F.size("v").alias("d")).distinct().collect())  # a number per length
    found = reps.select("rep", F.lit(None).cast("long").alias("other"), F.lit(0).cast("long").alias("n")).where("false")
    for at in range(0, len(lengths), LENGTHS_AT_ONCE):
        some = lengths[at : at + LENGTHS_AT_ONCE]
        found = found.unionByName(stored(_links(reps.where(F.size("v").isin(some)), {d: CapFilters(d, crowds, cosine) for d in some}, cosine)))
    counts = found.where("n > 0").groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    told = (
        reps.join(counts, "rep", "left")
        .join(roots.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            F.struct("label", "v").alias("key"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    told = stored(told)
    out = rows.join(told.withColumnRenamed("key", "own"), F.col("key") == F.col("own"), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def shares_a_key(lists: list[np.ndarray], size: int, rows: np.ndarray) -> np.ndarray:
    """Which pairs of ``size`` vectors share a key, given the keys of the vectors ``rows``."""
    shared = np.zeros((size, size), bool)
    names, places = np.unique(np.concatenate(lists), return_inverse=True)
    owners = np.repeat(rows, [len(k) for k in lists])
    for at in range(0, len(names), KEYS_AT_ONCE):  # a bounded part of the members x keys table at a time
        own = (places >= at) & (places < at + KEYS_AT_ONCE)
        member = np.zeros((size, min(KEYS_AT_ONCE, len(names) - at)), np.float32)
        member[owners[own], places[own] - at] = 1
        shared |= member @ member.T > 0
    return shared


def _links(reps: DataFrame, caps: dict[int, CapFilters], cosine: float) -> DataFrame:
    """Links between representatives: rows (rep, other, n); n sums to the linked vectors, (rep, other) spans them."""

    def decode(batches: Iterator[pa.RecordBatch], with_vector: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lengths = pc.list_value_length(part.column(3)).to_numpy(zero_copy_only=False)
                for dims in np.unique(lengths).tolist():
                    same = part.filter(pa.array(lengths == dims))
                    given = np.asarray(same.column(3).flatten(), np.float64).reshape(same.num_rows, dims)
                    keys = caps[dims].keys(units_of(given))
                    owner = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
                    flat = pa.array(np.concatenate(keys), pa.int64())
                    label, size = same.column(2).take(owner), pa.array(np.full(len(flat), dims, np.int32))
                    if not with_vector:
                        yield pa.RecordBatch.from_arrays([label, size, flat], ["label", "dims", "filter"])
                        continue
                    binary = pa.array([packed(v) for v in given], pa.binary()).take(owner)
                    yield pa.RecordBatch.from_arrays(
                        [same.column(0).take(owner), same.column(1).take(owner), label, size, flat, binary],
                        ["rep", "copies", "label", "dims", "filter", "v"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def linked() -> pa.RecordBatch:
            out: list[tuple] = []
            if len(held) > 1:
                held.sort(key=lambda r: r[0])
                ids, copies, sides = (np.asarray([r[i] for r in held], np.int64) for i in (0, 1, 2))
                _, dims, own_filter, first, second = now
                units = units_of(np.stack([unpacked(r[3], dims) for r in held]))
                two = first != second
                left = np.flatnonzero(sides == first)
                right = np.flatnonzero(sides == second)
                hits = units[left] @ units[right].T >= cosine
                if not two:
                    hits = np.triu(hits, 1)
                rows = np.unique(np.concatenate([left[hits.any(1)], right[hits.any(0)]]))
                if len(rows):
                    lower = [k[k < own_filter] for k in caps[dims].keys(units[rows])]
                    hits &= ~shares_a_key(lower, len(held), rows)[np.ix_(left, right)]  # counted in the smallest shared filter
                    n = np.zeros(len(held), np.int64)
                    n[left] += hits @ copies[right]
                    n[right] += hits.T @ copies[left]
                    out += [(int(ids[i]), None, int(n[i])) for i in np.flatnonzero(n)]
                    out += [(int(ids[a]), int(ids[b]), 0) for a, b in forest(len(held), hits, left, right)]
            columns = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["rep", "other", "n"])

        for batch in batches:
            for *bucket, rep, copies, side, v in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    if now is not None:
                        yield linked()
                    now, held = bucket, []
                held.append((rep, copies, side, v))
        if now is not None:
            yield linked()

    source = reps.select("rep", "copies", "label", "v")
    sizes = source.mapInArrow(lambda b: decode(b, False), "label string, dims int, filter long")
    large = sizes.groupBy("label", "dims", "filter").count().where(F.col("count") > TILE)
    large = stored(large.select("label", "dims", "filter", F.ceil(F.col("count") / TILE).cast("long").alias("tiles")))
    entries = source.mapInArrow(lambda b: decode(b, True), "rep long, copies long, label string, dims int, filter long, v binary")
    entries = entries.join(large, ["label", "dims", "filter"], "left")
    tiles = F.coalesce("tiles", F.lit(1))
    side = F.pmod(F.xxhash64("rep"), tiles)
    entries = entries.withColumn("side", side).withColumn(
        "tile", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), lambda j: F.struct(
            F.least(j, side).alias("a"), F.greatest(j, side).alias("b"))))
    )
    order = ["label", "dims", "filter", "tile.a", "tile.b"]
    dealt = entries.select(*order, "rep", "copies", "side", "v")
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["label", "dims", "filter", "a", "b"]
    dealt = dealt.repartition(parts, *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(compare, "rep long, other long, n long")
