"""MinHash near-duplicates with odd sketches (operator 10).

Texts are lower-cased (A-Z) and cut into words; a document's set holds its
distinct 5-word shingles.  One pass over the texts gives each document the
digest of its set, ``BANDS`` band keys of ``ROWS`` MinHash values, and odd
sketches of a MinHash sample: the shingles of least hash (those under a
threshold, so that the samples of two documents fit together; sets of up to
``SAMPLE`` shingles whole) each flip a bit of a bitmap.  The population count
of the exclusive-or of two bitmaps tells how many sampled shingles differ, and
with the sample sizes the similarity, most precisely where it is high.  The
threshold halves with each doubling of the set; two sketches, at a document's
own threshold and at half of it, make neighbouring sizes comparable.

Documents with equal sets become one class.  Documents sharing a band key are
candidates: first each with the least document of its band (a star, so a
large group gives no more pairs than it has members); then, in bands whose
documents are still in different components, a spanning forest of the most
similar pairs by sketch, as long as that links anything; at last all pairs
that are similar by sketch and not yet connected.  Each candidate that the
sketch does not rule out is confirmed on the full sets, recomputed from the
whole texts; only confirmed links count.

Cases: null texts and texts without words have an empty set and link with
nothing; texts of fewer than five words are one shingle; rows with a null id
link with nothing and are kept, their component is null; rows that repeat an
id are one document of several texts; very long texts are read whole; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, give_back, release_shuffles, stored, text_or_empty

SHINGLE_WORDS = 5
#: A pair at similarity 0.75 shares no band with a chance of 2e-5.
BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
#: Shingles in the sample of a sketch, at most on average.
SAMPLE = 512
#: Candidates are ruled out this far under the threshold by sketch (four to five standard errors): sets
#: sketched whole, where only colliding bits blur the estimate, and sampled ones.
WHOLE_MARGIN, SAMPLED_MARGIN = 0.06, 0.15
#: Documents of a band compared in one tile.
TILE = 1024
#: Pairs of one document confirmed in one group, and ids that are broadcast to pick texts (8 MB).
GROUP_PAIRS = 256
BROADCAST_IDS = 500_000
#: Shingles hashed at a time.
SLICE = 8192

_rng = np.random.default_rng(750)
_TURNS = _rng.integers(0, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
_BAND_TURNS = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SALT = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_BIT_SALT = np.uint64(0x5851F42D4C957F2D)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A full mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """The ascending distinct shingles of a text as 64-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes both know A-Z and \t-\r and blank only
    if len(words) < SHINGLE_WORDS:
        return np.asarray([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE_WORDS + 1
    sums = np.zeros(n, np.uint64)
    for i, turn in enumerate(_TURNS):
        sums += hashes[i : i + n] * turn
    return np.unique(_mixed(sums))


def minhash(own: np.ndarray) -> np.ndarray:
    """SAMPLES MinHash values of a non-empty set."""
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(own), SLICE):
        x = own[at : at + SLICE].astype(np.uint32)
        np.minimum(low, (x * _MULTIPLY + _ADD).min(1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = low.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_TURNS
    return _mixed(parts.sum(1, dtype=np.uint64) ^ _BAND_SALT).view(np.int64)


def halvings(n: np.ndarray | int) -> np.ndarray:
    """How often the sampling threshold is halved for sets of ``n`` shingles."""
    return np.ceil(np.log2(np.maximum(np.asarray(n, np.float64), SAMPLE) / SAMPLE)).astype(np.int64)


def odd_sketch(own: np.ndarray, times: int) -> bytes:
    """Size and parity bitmap of the shingles under the threshold halved ``times`` times."""
    sample = own[own <= np.uint64(0xFFFFFFFFFFFFFFFF >> times)]  # shingles are mixed hashes
    places = (_mixed(sample ^ _BIT_SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bits = np.packbits(np.bincount(places, minlength=SKETCH_BITS) & 1 == 1)
    return np.asarray([len(sample)], "<u8").tobytes() + bits.tobytes()


def sketches(own: np.ndarray) -> bytes:
    """The sketches of a set at its own threshold and at half of it."""
    times = int(halvings(len(own)))
    return odd_sketch(own, times) + odd_sketch(own, times + 1)


#: 64-bit words of one sketch: the sample's size and the bitmap.
_WORDS = 1 + SKETCH_BITS // 64


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Sketches as an array (document, threshold, word)."""
    return np.frombuffer(b"".join(rows), "<u8").reshape(len(rows), 2, _WORDS)


def likely(sizes_a: np.ndarray, a: np.ndarray, sizes_b: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarities of pairs, and whether size and sketch allow ``least``.

    ``a`` and ``b`` are sketches as of :func:`unpacked`, row by row.
    """
    own, other = halvings(sizes_a), halvings(sizes_b)
    times = np.maximum(own, other)
    rows = np.arange(len(own))
    x, y = a[rows, np.minimum(times - own, 1)], b[rows, np.minimum(times - other, 1)]
    odd = np.bitwise_count(x[:, 1:] ^ y[:, 1:]).sum(1)
    differ = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * odd / SKETCH_BITS, 1e-9))
    both = (x[:, 0] + y[:, 0]).astype(np.float64)
    near = (both - differ) / np.maximum(both + differ, 1)
    margin = np.where(times == 0, WHOLE_MARGIN, SAMPLED_MARGIN)
    fits = np.minimum(sizes_a, sizes_b) >= (least - 1e-9) * np.maximum(sizes_a, sizes_b)
    return near, fits & (near >= least - margin)


def _sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, bands, sketch) of every row; empty sets have no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column(1):
                own = shingles(text.as_py())
                low = minhash(own) if len(own) else None
                out[0].append(len(own))
                out[1].append(None if low is None else xxhash.xxh3_128_digest(own.tobytes()))
                out[2].append(None if low is None else band_keys(low))
                out[3].append(None if low is None else sketches(own))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n", "digest", "bands", "sketch"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return wanted.mapInArrow(give_back(run), "doc_id long, n long, digest binary, bands array<long>, sketch binary")


def _similar(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the similarity ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.int64) for i in (2, 3))
            one, two = (unpacked(batch.column(i).to_pylist()) for i in (4, 5))
            close = likely(na, one, nb, two, least)[1]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(close)), batch.column(1).filter(pa.array(close))], ["a", "b"])

    of = lambda side: classes.select(F.col("doc_id").alias(side), F.col("n").alias("n" + side), F.col("sketch").alias("s" + side))
    known = pairs.join(of("a"), "a").join(of("b"), "b")
    known = known.where(F.least("na", "nb") >= F.lit(least - 1e-9) * F.greatest("na", "nb"))
    return known.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(give_back(run), "a long, b long").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach ``percent`` / 100, from the whole texts."""
    pairs = stored(pairs)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    ids = stored(ids.join(classes.select("doc_id", "digest"), "doc_id"))
    few = ids.count() <= BROADCAST_IDS
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    texts = wanted.join(F.broadcast(ids) if few else ids, "doc_id").select("doc_id", "digest", "text")
    sizes = stored(pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / GROUP_PAIRS).cast("long").alias("parts")))
    part = F.pmod(F.xxhash64("b"), F.col("parts"))
    heads = sizes.join(texts, sizes["a"] == texts["doc_id"])
    heads = heads.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "digest", "text")
    members = pairs.join(texts, pairs["b"] == texts["doc_id"]).select("a", "b", "digest", "text")
    members = members.join(sizes, "a").select("a", part.alias("part"), "b", "digest", "text")
    rows = heads.unionByName(members)
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads = None, {}  # the texts of a, by digest: one id can hold several
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, piece, b, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                if (a, piece) != now:
                    now, heads = (a, piece), {}
                own = shingles(text.as_py())
                if xxhash.xxh3_128_digest(own.tobytes()) != digest:
                    continue  # another text under the same id
                if b is None:
                    heads[digest] = own
                    continue
                for head in heads.values():
                    both = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * both >= percent * (len(head) + len(own) - both):
                        found.append((a, b))
                        break
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return stored(rows.mapInArrow(give_back(run), "a long, b long"))


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key of the first band that each pair of band lists shares."""
    first = (a == b).argmax(1)
    return a[np.arange(len(a)), first]


def _across(entries: DataFrame, labels: DataFrame, classes: DataFrame, least: float, forest: bool) -> DataFrame:
    """Candidates (a, b) of different components in a band, similar by size and sketch.

    With ``forest`` only a spanning forest of them in each tile.
    """
    placed = entries.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    placed = placed.select("band", "doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    mixed = placed.groupBy("band").agg(F.count("*").alias("n"), F.min("component_id").alias("x"), F.max("component_id").alias("y"))
    mixed = stored(mixed.where("x <> y").select("band", F.ceil(F.col("n") / TILE).cast("long").alias("tiles")))
    side = F.pmod(F.xxhash64("doc_id"), F.col("tiles"))
    rows = placed.join(mixed, "band").withColumn("side", side)
    rows = rows.join(classes.select("doc_id", F.col("n").alias("size"), "sketch", "bands"), "doc_id")
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda j: F.struct(F.least(j, side).alias("a"), F.greatest(j, side).alias("b")),
    )
    rows = rows.withColumn("tile", F.explode(pair)).select("band", "tile.a", "tile.b", "side", "doc_id", "component_id", "size", "sketch", "bands")
    count = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, "band", "a", "b").sortWithinPartitions("band", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def compared() -> pa.RecordBatch:
            ids, parts, sizes = (np.asarray([r[i] for r in held], np.int64) for i in (1, 2, 3))
            sides = np.asarray([r[0] for r in held])
            bits, bands = unpacked([r[4] for r in held]), np.asarray([r[5] for r in held], np.int64)
            left, right = np.flatnonzero(sides == now[1]), np.flatnonzero(sides == now[2])
            pairs, near = [], []
            for i in left:
                others = right[right > i] if now[1] == now[2] else right
                others = others[parts[others] != parts[i]]
                if not len(others):
                    continue
                size = np.full(len(others), sizes[i])
                guess, close = likely(size, np.broadcast_to(bits[i], (len(others), *bits.shape[1:])), sizes[others], bits[others], least)
                pairs.append(np.stack([np.full(close.sum(), i), others[close]]))
                near.append(guess[close])
            found = np.concatenate(pairs, 1) if pairs else np.zeros((2, 0), np.int64)
            if forest and found.size:  # a spanning forest of the components, most similar pairs first
                joined = {c: c for c in parts.tolist()}

                def root(c: int) -> int:
                    while joined[c] != c:
                        joined[c] = c = joined[joined[c]]
                    return c

                chosen = []
                for k in np.argsort(-np.concatenate(near), kind="stable"):
                    a, b = root(int(parts[found[0, k]])), root(int(parts[found[1, k]]))
                    if a != b:
                        joined[a] = b
                        chosen.append(k)
                found = found[:, chosen]
            elif found.size:  # every pair in the first of its shared bands only
                first = [_first_shared(bands[found[0, k : k + SLICE]], bands[found[1, k : k + SLICE]]) for k in range(0, found.shape[1], SLICE)]
                found = found[:, np.concatenate(first) == now[0]]
            ends = np.sort(ids[found], 0).tolist()
            out = list(zip(*ends))
            columns = list(zip(*out)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

        for batch in batches:
            for *tile, row_side, key, component, size, sketch, keys in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != now:
                    if now is not None:
                        yield compared()
                    now, held = tile, []
                held.append((row_side, key, component, size, sketch, keys))
        if now is not None:
            yield compared()

    return rows.mapInArrow(give_back(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    least = percent / 100
    with Scratch(docs.sparkSession) as scratch:
        sets = stored(_sketched(docs))
        sound = sets.where("doc_id is not null and digest is not null")
        reps = stored(sound.groupBy("digest").agg(F.min("doc_id").alias("rep")))
        classes = sound.join(reps.withColumnRenamed("digest", "d"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("d")))
        classes = stored(classes.select("doc_id", "digest", "n", "bands", "sketch").dropDuplicates(["digest"]))
        entries = classes.select("doc_id", F.explode("bands").alias("band"))

        pivots = entries.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
        pivots = stored(pivots.select("band", "pivot"))
        stars = entries.join(pivots, "band").where("doc_id <> pivot")
        stars = stars.select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
        release_shuffles(docs.sparkSession)
        links = _confirmed(_similar(stars, classes, least), docs, classes, percent)
        # The texts under one id belong together.
        twins = sound.join(reps, "digest").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        twins = twins.join(sound.groupBy("doc_id").agg(F.count_distinct("digest").alias("k")).where("k > 1").select(F.col("doc_id").alias("b")), "b", "left_semi")
        links = links.union(twins.select("a", "b").distinct())
        labels = components(links)
        forest = True
        while True:
            release_shuffles(docs.sparkSession)  # those of the finished round would otherwise pile up
            found = stored(_across(entries, labels, classes, least, forest))
            if found.isEmpty():
                break  # no candidates between different components are left
            release_shuffles(docs.sparkSession)
            more = _confirmed(found, docs, classes, percent)
            if not more.isEmpty():
                links = links.union(more)
                labels = components(links)
            if not forest:
                break
            forest = not more.isEmpty()

        named = reps.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        named = stored(named.select(F.col("digest").alias("d"), F.coalesce("component_id", "rep").alias("component_id")))
        scratch.drop_all_but(sets, named)
    out = sets.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    out = out.join(named, F.col("digest") == F.col("d"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row of each group of near-duplicate texts: that of the least id, and of one id that of the least hash.

    Texts are compared by themselves: rows of one id with unrelated texts all stay.
    Of rows that repeat both id and text one stays; rows with a null id all stay.
    """
    with Scratch(docs.sparkSession) as scratch:
        key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", text_or_empty()))
        keyed = docs.select(key.alias("doc_id"), text_or_empty().alias("text"))
        parts = near_duplicates(keyed, percent).where("doc_id is not null").select(F.col("doc_id").alias("_key"), "component_id")
        ids = docs.select(key.alias("_key"), F.col("doc_id").alias("_id")).where("_key is not null").distinct()
        found = stored(parts.distinct().join(ids, "_key"))
        first = found.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("first"), F.count("*").alias("n"))
        several = first.where("n > 1").select("component_id", "first")
        gone = stored(found.join(several, "component_id").where("_key <> first._key").select("_key"))
        again = docs.select(key.alias("_key")).where("_key is not null").groupBy("_key").count().where("count > 1").select("_key")
        again = stored(again)
        scratch.drop_all_but(gone, again)
    few = gone.count() <= BROADCAST_IDS
    rest = docs.withColumn("_key", key).join(F.broadcast(gone) if few else gone, "_key", "left_anti")
    if not again.isEmpty():
        once = rest.join(again, "_key", "left_anti").select(*rest.columns)
        rest = once.unionByName(rest.join(again, "_key", "left_semi").select(*rest.columns).dropDuplicates(["_key"]))
    return rest.select(*docs.columns)
