"""Removal of repeated passages by prefix-partitioned suffix trees (operator 12).

A passage of ``WINDOW`` words that also begins earlier (in a document of
smaller id, or earlier in the same one) is removed, word by word.

1. *Candidate suffixes.*  Of the ``ANCHOR``-word grams inside a window the one of
   least hash is its anchor, which equal windows have in common.  Neighbouring
   windows with one anchor make a *stretch*.  Stretches whose anchor occurs once
   hold no repeat and go no further.  Equal stretches are folded, before and in
   the shuffle, into the earliest one, their leader: whatever its copies hold begins
   earlier in the leader, so only the leader's suffixes enter the trees.
2. *Groups.*  The suffixes of the leaders of one anchor are a group of bounded
   size.  Where an anchor has more than ``GROUP`` leaders, its suffixes are split by
   their first 4, then 8, then 16 words, until a group is small enough.  A prefix
   that reaches a whole window is a node by itself; its first suffix is an
   aggregated minimum, so that no task holds such a group.
3. *Subtrees.*  A task takes groups of together at most some ``GROUP`` stretches and
   splits their suffixes again by prefixes of growing length into pieces of at most
   ``SUBTREE``; neighbouring light prefixes share a piece.  Sorting a piece gives the
   leaves of its subtree in order, the common prefixes of neighbours give its internal
   nodes.  The nodes at least ``WINDOW`` words deep are the maximal repeats; the
   earliest leaf of each is its first occurrence and stays.

Groups are formed by 64-bit hashes, which may only put more into one group; leaves
are compared by 64-bit hashes of all their words.  Texts are written once, dealt out by
their key into buckets, so that the three passes that need words shuffle no text.

Cases: a null or empty text has no words; texts of less than a window lose nothing;
rows of one id with different texts are ordered by a hash of the text, rows of one id
and text count as one document and get the same result each; a null id comes after
all others; a very long text takes memory of some 60 bytes a word in one task; extra
columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, release_shuffles, shared_folder, sized_batches, text_or_empty
from .words import Powers, hashed_words, scramble

#: Words of a passage, and of the grams of which the one of least hash is a passage's anchor.
WINDOW = 20
ANCHOR = 8
#: Most stretches of a group that one task holds, and most suffixes of a subtree.
GROUP = 10_000
SUBTREE = 65_536
#: Lengths of the prefixes that split the suffixes of larger groups.
PREFIXES = (4, 8, 16)
#: Bytes of texts worked on together while stretches are cut.
CUT_BYTES = 2 << 20

_U = np.uint64
#: A place is the number of the first window times this, plus the number of further windows.
_PLACE = 16
_LAST_ID = (1 << 63) - 1


class Cutter:
    """Stretches of windows with a common anchor, of many documents at a time."""

    def __init__(self, window: int = WINDOW, anchor: int = ANCHOR):
        self.window, self.anchor = window, anchor
        self.choices = window - anchor + 1
        if not 0 < self.choices <= _PLACE:
            raise ValueError(f"a window may have at most {_PLACE} places for its anchor")
        self.powers = Powers()

    def cut(self, documents: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(document, first window, windows, hash of the anchor, hash of the stretch) of all stretches."""
        sizes = np.array([len(d) for d in documents], np.int64)
        words = np.concatenate(documents) if documents else np.zeros(0, np.uint64)
        n = len(words)
        if n < self.window or sizes.max() < self.window:
            return tuple(np.zeros(0, np.int64 if k < 3 else np.uint64) for k in range(5))
        sums = self.powers.sums(words)
        all_starts = np.arange(n - self.anchor + 1)
        grams = scramble(self.powers.parts(sums, all_starts, all_starts + self.anchor))
        begins = np.cumsum(sizes) - sizes
        m = n - self.window + 1
        low = grams & _U(0xFFFFFFFFFFFFFFE0)  # the place within the window takes the lowest bits: the leftmost of the least
        least = low[:m].copy()
        for k in range(1, self.choices):
            np.minimum(least, low[k : m + k] + _U(k), out=least)
        document = np.repeat(np.arange(len(documents), dtype=np.int32), sizes)
        starts = np.flatnonzero(document[:m] == document[self.window - 1 :])
        least = least[starts]
        at = starts + (least & _U(31)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        first = starts[new]
        last = starts[np.append(new[1:], len(starts)) - 1]
        count = last - first + 1
        content = self.powers.parts(sums, first, last + self.window)
        content = scramble(content + (count * 32 + at[new] - first).astype(np.uint64))
        owner = document[first]
        return owner, first - begins[owner], count, least[new] >> _U(5), content


def pieces(words: np.ndarray, members: np.ndarray, limit: int, depth: int = 0) -> Iterator[np.ndarray]:
    """``members`` (rows of ``words``) split by prefixes of growing length into sets of at most ``limit``.

    Rows that are equal all along stay together whatever their number.
    """
    if len(members) <= limit or depth == words.shape[1]:
        yield members
        return
    column = words[members, depth]
    order = np.argsort(column, kind="stable")
    members, column = members[order], column[order]
    bounds = np.append(np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])), len(members))
    begin = 0
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - begin > limit and low > begin:
            yield members[begin:low]
            begin = low
        if high - begin > limit:
            yield from pieces(words, members[begin:high], limit, depth + 1)
            begin = high
    if begin < len(members):
        yield members[begin:]


def deep_nodes(words: np.ndarray, members: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the subtree of ``members`` in order, and the bounds of its nodes ``depth`` or more words deep.

    Leaves that share no node of that depth with another are nodes of one leaf.
    """
    own = words[members]
    order = np.lexsort(own.T[::-1])
    own = own[order]
    unlike = own[1:] != own[:-1]
    shared = np.where(unlike.any(axis=1), unlike.argmax(axis=1), words.shape[1])  # length of the common prefix
    return members[order], np.concatenate([[0], np.flatnonzero(shared < depth) + 1])


def first_occurrences(words: np.ndarray, ranks: np.ndarray, limit: int = SUBTREE) -> np.ndarray:
    """Whether each suffix (row of ``words``) is the one of least rank among the equal ones."""
    first = np.zeros(len(words), bool)
    for members in pieces(words, np.arange(len(words)), limit):
        leaves, bounds = deep_nodes(words, members, words.shape[1])
        least = np.minimum.reduceat(ranks[leaves], bounds)
        first[leaves] = ranks[leaves] == np.repeat(least, np.diff(np.append(bounds, len(leaves))))
    return first


def dense_ranks(*columns: np.ndarray) -> np.ndarray:
    """Places of the rows in the order of ``columns``, the same for equal rows."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _firsts_of(rows: list[tuple], window: int, limit: int):
    """(text, did, place, mask) of stretches that hold first occurrences; rows are (did, text, place, words)."""
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint64)
    did, text, place = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    counts = place % _PLACE + 1
    lengths = counts + window - 1
    owner = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = (np.cumsum(lengths) - lengths)[owner] + offset
    words = data[begins[:, None] + np.arange(window)]
    ranks = dense_ranks(did[owner], text[owner], place[owner] // _PLACE + offset)
    masks = np.zeros(len(rows), np.int64)
    np.add.at(masks, owner, first_occurrences(words, ranks, limit) * (1 << offset))
    kept = np.flatnonzero(masks)
    return text[kept], did[kept], place[kept], masks[kept]


_FIRSTS = "text long, did long, place long, mask long"


def subtree_firsts(suffixes: DataFrame, key: str, window: int, group: int, limit: int) -> DataFrame:
    """First occurrences in groups (by ``key``) of stretches, each group built in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text", "did", "place", "mask"]
        held: list[tuple] = []
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and len(held) >= group:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in _firsts_of(held, window, limit)], names)
                    held = []
                last = row[0]
                held.append(row[1:])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _firsts_of(held, window, limit)], names)

    dealt = suffixes.select(key, "did", "text", "place", "words").repartition(key).sortWithinPartitions(key)
    return dealt.mapInArrow(run, _FIRSTS)


def _bucketed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per id and text, (text, did, no_id, copies, blob), dealt into buckets by the first two."""
    spark = docs.sparkSession
    did, body = F.col(id_column).cast("long"), text_or_empty(text_column)
    known = docs.select(
        F.xxhash64(did, did.isNull(), body).alias("text"),
        F.coalesce(did, F.lit(_LAST_ID)).alias("did"),
        did.isNull().alias("no_id"),
        body.alias("body"),
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blobs = pa.array([packer.compress(t.as_buffer()) for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], blobs], ["text", "did", "no_id", "blob"])

    packed = known.mapInArrow(compress, "text long, did long, no_id boolean, blob binary")
    rows = packed.groupBy("text", "did").agg(
        F.first("no_id").alias("no_id"), F.count(F.lit(1)).alias("copies"), F.first("blob").alias("blob")
    )
    name = f"llm_texts_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = rows.write.format("parquet").bucketBy(buckets, "text", "did")
    writer.option("path", shared_folder(spark)).saveAsTable(name)
    return spark.table(name)


def _cut_rows(texts: DataFrame, window: int, anchor: int, anchors_only: bool = False) -> DataFrame:
    """All stretches of the texts: (anchor, content, text, did, place), or their anchors only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "content", "text", "did", "place"][: 1 if anchors_only else None]
        cutter, powers, unpack = Cutter(window, anchor), Powers(), zstandard.ZstdDecompressor()

        def cut(keys: list[tuple], group: list[bytes]) -> pa.RecordBatch:
            owner, first, count, anchors, content = cutter.cut(hashed_words(group, powers))
            if anchors_only:
                return pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64))], names)
            text, did = (np.array(k, np.int64)[owner] for k in zip(*keys))
            columns = [anchors.view(np.int64), content.view(np.int64), text, did, first * _PLACE + count - 1]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        keys: list[tuple] = []
        group: list[bytes] = []
        held = 0
        for batch in batches:
            for text, did, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = unpack.decompress(blob.as_buffer())
                if group and held + len(own) > CUT_BYTES:
                    yield cut(keys, group)
                    keys, group, held = [], [], 0
                keys.append((text, did))
                group.append(own)
                held += len(own)
        if group:
            yield cut(keys, group)

    shape = "anchor long" if anchors_only else "anchor long, content long, text long, did long, place long"
    return texts.select("text", "did", "blob").mapInArrow(run, shape)


def _with_words(texts: DataFrame, leaders: DataFrame, window: int, split: bool) -> DataFrame:
    """The words (hashes) of stretches, or of each of their windows: (anchor, did, text, place, words)."""
    schema = pa.schema([("anchor", pa.int64()), ("did", pa.int64()), ("text", pa.int64()), ("place", pa.int64()), ("words", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]):
        powers, unpack = Powers(), zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            for text, did, anchors, places, blob in zip(*columns, batch.column(4)):
                data = hashed_words([unpack.decompress(blob.as_buffer())], powers)[0].tobytes()
                for anchor, place in zip(anchors, places):
                    start, more = divmod(place, _PLACE)
                    for k in range(more + 1 if split else 1):
                        end = start + k + window + (0 if split else more)
                        part = data[8 * (start + k) : 8 * end]
                        yield (anchor, did, text, (start + k) * _PLACE if split else place, part), len(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sized_batches(rows(batches), schema)

    wanted = leaders.groupBy("text", "did").agg(*[F.collect_list(c).alias(c) for c in ("anchor", "place")])
    found = wanted.join(texts.select("text", "did", "blob"), ["text", "did"])
    return found.select("text", "did", "anchor", "place", "blob").mapInArrow(
        run, "anchor long, did long, text long, place long, words binary"
    )


def _first(of: str = "first"):
    return [F.col(f"{of}.{c}").alias(c) for c in ("text", "did", "place")]


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    group: int = GROUP,
    limit: int = SUBTREE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every text without the words of passages that begin earlier.

    Returns (id, n_words, n_removed, removed, kept): ``removed`` lists the spans
    (first word, word after the last) taken out, ``kept`` joins the other words by
    one space.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = _bucketed(docs, id_column, text_column)
    release_shuffles(spark)
    counts = _cut_rows(texts, window, anchor, anchors_only=True).groupBy("anchor").count()
    repeated = scratch.keep(counts.where("count > 1").select("anchor"))
    stretches = scratch.keep(_cut_rows(texts, window, anchor).join(repeated, "anchor", "left_semi"))
    scratch.drop(repeated)
    earliest = F.min(F.struct("did", "text", "place")).alias("first")
    leaders = scratch.keep(stretches.groupBy("anchor", "content").agg(earliest).select("anchor", *_first()))
    counts = leaders.groupBy("anchor").agg(F.count(F.lit(1)).alias("leaders"))
    counted = leaders.join(counts, "anchor")

    one = counted.where("leaders = 1").select(
        "text", "did", "place", F.expr(f"shiftleft(2L, cast(place % {_PLACE} as int)) - 1").alias("mask")
    )
    some = _with_words(texts, counted.where(f"leaders > 1 AND leaders <= {group}"), window, split=False)
    firsts = one.union(subtree_firsts(some, "anchor", window, group, limit))
    crowded = counted.where(f"leaders > {group}")
    if crowded.limit(1).count():
        firsts = firsts.union(_prefix_firsts(scratch, _with_words(texts, crowded, window, split=True), window, group, limit))

    marks = stretches.select("text", "did", "place", F.lit(0).cast("long").alias("mask")).union(firsts)
    listed = marks.groupBy("text", "did").agg(F.collect_list("place").alias("places"), F.collect_list("mask").alias("masks"))
    listed = scratch.keep(listed)
    scratch.drop_all_but(listed)
    return _without(texts, listed, window).withColumnRenamed("id", id_column)


def _prefix_firsts(scratch: Scratch, suffixes: DataFrame, window: int, group: int, limit: int) -> DataFrame:
    """First occurrences among suffixes split by ever longer prefixes until their groups are small enough."""
    found = None
    pending = scratch.keep(suffixes.drop("anchor"))
    for length in [p for p in PREFIXES if p < window]:
        keyed = pending.withColumn("prefix", F.xxhash64(F.substring("words", 1, 8 * length)))
        keyed = keyed.join(keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")), "prefix")
        small = scratch.keep(subtree_firsts(keyed.where(f"n <= {group}"), "prefix", window, group, limit))
        found = small if found is None else found.union(small)
        pending, done = scratch.keep(keyed.where(f"n > {group}").select(*pending.columns)), pending
        scratch.drop(done)
    nodes = pending.groupBy("words").agg(F.min(F.struct("did", "text", "place")).alias("first"))
    nodes = nodes.select(*_first(), F.lit(1).cast("long").alias("mask"))
    return nodes if found is None else found.union(nodes)


def _without(texts: DataFrame, listed: DataFrame, window: int) -> DataFrame:
    """All texts without the words of the listed windows."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(span)), ("kept", pa.binary())]
    )

    def removed_spans(n: int, places: list[int], masks: list[int]) -> tuple[list[int], list[int]]:
        place, mask = np.array(places, np.int64), np.array(masks, np.int64)
        again = np.zeros(n + 1, np.int64)
        candidates = place[mask == 0]
        np.add.at(again, candidates // _PLACE, 1)
        np.add.at(again, candidates // _PLACE + candidates % _PLACE + 1, -1)
        again = np.cumsum(again) > 0
        firsts = mask != 0
        for k in range(_PLACE):
            has = firsts & (mask >> k & 1 == 1)
            again[place[has] // _PLACE + k] = False
        cover = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(again[:n])
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + window, -1)
        edges = np.diff(np.concatenate([[0], (np.cumsum(cover)[:n] > 0).astype(np.int8), [0]]))
        return np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()

    def rows(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:5]]
            for did, no_id, copies, places, masks, blob in zip(*columns, batch.column(5)):
                words = unpack.decompress(blob.as_buffer()).split()
                starts, ends = removed_spans(len(words), places, masks) if places else ([], [])
                kept = [w for a, b in zip([0, *ends], [*starts, len(words)]) for w in words[a:b]]
                text = b" ".join(kept)
                spans = [{"start": a, "end": b} for a, b in zip(starts, ends)]
                row = None if no_id else did, len(words), len(words) - len(kept), spans, text
                for _ in range(copies):
                    yield row, len(text) + 24 * len(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sized_batches(rows(batches), schema)

    joined = texts.join(listed, ["text", "did"], "left")
    out = joined.select("did", "no_id", "copies", "places", "masks", "blob").mapInArrow(
        run, "id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept binary"
    )
    return out.withColumn("kept", F.col("kept").cast("string"))
