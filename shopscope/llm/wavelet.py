"""Token ids in wavelet matrices, one compressed file per shard (operator 7).

Texts are encoded, cut into ranges of ascending doc_id, and each range is
written as shards.  A shard holds one wavelet matrix: for each bit of an id,
from the highest, one bit plane with the ids stably parted by the bits above;
the counts of ones before every 512 bits are added when it is loaded.  Rank and select on the planes
give the token at a position, the count of a token up to a position and the
places where it occurs, from the shard alone.  A shard is one row in one
Parquet file: (range, part, n_tokens, doc_ids, lengths, matrix).

Cases: a null or empty text is a document with the end id only; documents
with a null id stand first; rows that repeat an id are documents of their
own, in order of their text's hash; a text longer than a shard gets a shard
of its own; an empty table gives an empty folder listing no document.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty, with_offsets
from .ranges import key_bounds, with_range
from .vocab import encoder

#: Bits per rank block, characters per range aimed at, tokens per shard aimed at.
RANK_BLOCK = 512
RANGE_CHARS = 4_000_000
SHARD_TOKENS = 1_500_000
#: Bytes of ids in one output batch.
BATCH_BYTES = 8 << 20
#: Shards whose starts (16 bytes each) are sent to every executor; the starts of more shards are joined by a shuffle.
BROADCAST_SHARDS = 500_000

_HEAD = struct.Struct("<4sIQ")
_MAGIC = b"WVM1"


class WaveletMatrix:
    """Rank/select structure over a sequence of unsigned integers below ``2 ** levels``."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros

    @cached_property
    def ranks(self) -> list[np.ndarray]:
        return [self._block_ranks(p) for p in self.planes]

    @staticmethod
    def _block_ranks(plane: np.ndarray) -> np.ndarray:
        """Ones before each block of RANK_BLOCK bits."""
        ones = np.bitwise_count(plane).astype(np.int64)
        step = RANK_BLOCK // 8
        edges = np.arange(0, len(ones), step)
        return np.concatenate([[0], np.cumsum(np.add.reduceat(ones, edges))]) if len(ones) else np.zeros(1, np.int64)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, zeros = [], []
        at = np.asarray(ids)
        for bit in range(levels - 1, -1, -1):
            ones = (at >> at.dtype.type(bit)) & at.dtype.type(1) == 1
            planes.append(np.packbits(ones))
            low = at[~ones]
            zeros.append(len(low))
            at = np.concatenate([low, at[ones]])
        return cls(len(ids), planes, zeros)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(_MAGIC, len(self.planes), self.n)
        return head + np.asarray(self.zeros, "<u8").tobytes() + b"".join(p.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, levels, n = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        zeros = np.frombuffer(data, "<u8", levels, _HEAD.size).tolist()
        at, size = _HEAD.size + 8 * levels, (n + 7) // 8
        planes = [np.frombuffer(data, np.uint8, size, at + i * size) for i in range(levels)]
        return cls(n, planes, zeros)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // RANK_BLOCK
        first = block * RANK_BLOCK // 8
        plane = self.planes[level]
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(plane[first : i // 8]).sum())
        return ones + ((int(plane[i // 8]) >> (8 - i % 8)).bit_count() if i % 8 else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of a kind in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][i // 8]) >> (7 - i % 8) & 1
            ones = self._rank1(level, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _span(self, token: int, end: int) -> tuple[int, int]:
        start = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if token >> (len(self.zeros) - 1 - level) & 1:
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """How often ``token`` stands before position ``end`` (default: everywhere)."""
        if token < 0 or token >> len(self.zeros):
            return 0
        start, stop = self._span(token, self.n if end is None else end)
        return stop - start

    def occurrences(self, token: int) -> list[int]:
        """Ascending positions of ``token``."""
        if token < 0 or token >> len(self.zeros):
            return []
        start, stop = self._span(token, self.n)
        found = []
        for at in range(start, stop):
            for level in range(len(self.zeros) - 1, -1, -1):
                bit = token >> (len(self.zeros) - 1 - level) & 1
                at = self._select(level, bit, at - self.zeros[level] if bit else at)
            found.append(at)
        return sorted(found)

    def decode(self) -> np.ndarray:
        """All tokens in order: the stable partings undone from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        at = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            back = np.empty_like(at)
            back[~ones] = at[: self.zeros[level]]
            back[ones] = at[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            at = back
        return at


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every text, append ``end_id`` and write the shards to ``path``."""
    wanted = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    size = wanted.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    bounds = key_bounds(wanted, "id", -(-size // RANGE_CHARS))
    parts = min(len(bounds) + 1, int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = np.asarray([end_id], enc.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                ids = pa.array([ids + last for ids in enc.encode_many([bytes(t.as_buffer()) for t in rows.column(1)])], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), ids], ["id", "tie", "ids"])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        levels = max(1, (enc.library.get_vocab_size() - 1).bit_length(), int(end_id).bit_length())
        limit = SHARD_TOKENS * enc.dtype.itemsize
        held: list[tuple] = []
        now, part, size = None, 0, 0

        def written() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x for _, x in held), enc.dtype)
            lengths = [len(x) // enc.dtype.itemsize for _, x in held]
            row = [now], [part], [len(ids)], [[k for k, _ in held]], [lengths], [WaveletMatrix.build(ids, levels).to_bytes()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names)

        for batch in batches:
            for where, key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if held and (where != now or size + len(ids) > limit):
                    yield written()
                    part, size, held = (part + 1 if where == now else 0), 0, []
                now = where
                held.append((key, ids))
                size += len(ids)
        if held:
            yield written()

    names = ["range", "part", "n_tokens", "doc_ids", "lengths", "matrix"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    schema = "range long, part long, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"
    tokens = wanted.withColumn("tie", F.xxhash64("text")).select("id", "text", "tie")
    tokens = tokens.mapInArrow(encode, "id long, tie long, ids binary")
    placed = with_range(tokens, "id", bounds).select("range", "id", "tie", "ids")
    placed = placed.repartition(parts, "range").sortWithinPartitions("range", F.col("id").asc_nulls_first(), "tie")
    written_rows = placed.mapInArrow(shards, schema)
    written_rows.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the shards at ``path``: (doc_id, start, n_tokens, ids).

    ``start`` counts the ids of all documents before; ``ids`` are
    little-endian unsigned 32-bit integers.
    """
    found = spark.read.parquet(path)
    rank = F.col("range") * F.lit(1 << 32) + F.col("part")
    starts = with_offsets(found.select(rank.alias("shard"), "n_tokens"), "shard", "n_tokens", "shard_start")
    if found.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, keys, lengths, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                ids = WaveletMatrix.from_bytes(matrix).decode().astype("<u4", copy=False)
                ends = np.cumsum(lengths)
                begin = 0
                while begin < len(keys):
                    base = int(ends[begin] - lengths[begin])
                    stop = max(begin + 1, int(np.searchsorted(ends, base + BATCH_BYTES // 4, side="right")))
                    pick = range(begin, stop)
                    row = (
                        [keys[i] for i in pick],
                        [start + int(ends[i] - lengths[i]) for i in pick],
                        [lengths[i] for i in pick],
                        [ids[ends[i] - lengths[i] : ends[i]].tobytes() for i in pick],
                    )
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names)
                    begin = stop

    names = ["doc_id", "start", "n_tokens", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    # The few shards learn their starts before they are decoded: ids are not shuffled again.
    packed = found.select(rank.alias("shard"), "doc_ids", "lengths", "matrix").join(starts.select("shard", "shard_start"), "shard")
    packed = packed.select("shard_start", "doc_ids", "lengths", "matrix")
    return packed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the shards."""
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
