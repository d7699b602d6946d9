"""Packing documents into token sequences along a space-filling curve (operator 2).

A document's token ids are hashed into a count vector of ``FEATURES`` places,
scaled to length 1 and projected to ``DIMENSIONS`` fixed random directions;
the normal distribution function spreads each coordinate over a grid, and the
cell's number along the Hilbert curve is the document's key.  Documents are
range-sorted by that key (neighbours on the curve have similar words) and laid
end to end; a sequence is the next ``length`` tokens, so only the very last
one is padded.  Range bounds are fixed before the shuffle, and copies, which
share a key, are spread by a hash of their id, so no task has to hold them all.

Cases: a null or empty text is the end id alone; rows that repeat an id are
documents of their own, and null ids are allowed (ties are settled by the
text's hash); very long texts are cut into many sequences; an empty table
gives no pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored, text_or_empty, with_offsets
from .ranges import key_bounds, with_range
from .vocab import encoder

SEQUENCE_TOKENS = 2048
FEATURES = 4096
DIMENSIONS = 3
#: Bits per dimension of the curve's grid; the rest of the 63-bit key spreads copies.
GRID_BITS = 10
#: Tokens per range aimed at.
RANGE_TOKENS = 2_000_000
BATCH_PIECES = 2000

_PROJECTION = np.random.default_rng(7).standard_normal((FEATURES, DIMENSIONS)).astype(np.float32)
_erf = np.vectorize(math.erf, otypes=[float])


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (rows of integers below ``2 ** bits``) along the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    step = 1 << (bits - 1)
    while step > 1:  # from axes to the transposed key: undo the turns of each level
        low = step - 1
        for i in range(dims):
            flip = x[i] & step != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        turn = np.where(x[-1] & step != 0, turn ^ (step - 1), turn)
        step >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def grid_cell(ids: np.ndarray) -> np.ndarray:
    """The grid cell of a document, from its token ids."""
    places = (ids.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - (FEATURES.bit_length() - 1))
    counts = np.bincount(places, minlength=FEATURES).astype(np.float32)
    length = float(np.sqrt(counts @ counts)) or 1.0
    return counts @ _PROJECTION / length


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """(id, curve, tie, n, ids) of every document; ids in the encoder's byte layout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = np.asarray([end_id], enc.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                ids = [enc.encode(t.as_py()) + last for t in rows.column(1)]
                points = np.stack([grid_cell(np.frombuffer(x, enc.dtype)) for x in ids])
                side = 1 << GRID_BITS
                cells = np.clip(np.floor(side * 0.5 * (1 + _erf(points / math.sqrt(2)))), 0, side - 1)
                spread = np.asarray(rows.column(3).to_numpy(zero_copy_only=False), np.int64) & 0x7FFFFFFF
                curve = hilbert_keys(cells, GRID_BITS) << 31 | spread
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(curve), rows.column(2), pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "curve", "tie", "n", "ids"],
                )

    text = text_or_empty(text_column)
    wanted = docs.select(
        F.col(id_column).cast("long").alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("tie"),
        F.xxhash64(F.coalesce(F.col(id_column).cast("long"), F.lit(-1)), text).alias("spread"),
    )
    return wanted.mapInArrow(give_back(run), "id long, curve long, tie long, n long, ids binary")


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = SEQUENCE_TOKENS,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens.

    Returns (id, start, length, doc_tokens, sequence_id, offset, ids) with
    ``ids`` as little-endian unsigned 32-bit integers.
    """
    tokens = stored(token_table(docs, tokenizer, end_id, id_column, text_column))
    total = tokens.agg(F.sum("n").alias("n")).first()["n"] or 0
    bounds = key_bounds(tokens, "curve", -(-total // RANGE_TOKENS))
    sizes = with_range(tokens.select("curve", "n"), "curve", bounds).groupBy("range").agg(F.sum("n").alias("n"))
    # One row per range, of which there are MAX_RANGES at most.
    begins = {r["range"]: r["start"] for r in with_offsets(sizes, "range", "n").collect()}
    parts = min(len(bounds) + 1, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(tokenizer).dtype
        now, at, rows = None, 0, []
        for batch in batches:
            for where, key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4))):
                if where != now:
                    now, at = where, begins[where]
                whole = np.frombuffer(ids, kind).astype("<u4")
                n, start = len(whole), 0
                while start < n:
                    offset = at % length
                    size = min(length - offset, n - start)
                    rows.append((key, start, size, n, at // length, offset, whole[start : start + size].tobytes()))
                    start, at = start + size, at + size
                    if len(rows) >= BATCH_PIECES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [*[pa.int64()] * 6, pa.binary()]
    placed = with_range(tokens, "curve", bounds).select("range", "id", "curve", "tie", "ids")
    placed = placed.repartition(parts, "range").sortWithinPartitions("range", "curve", "id", "tie")
    out = placed.mapInArrow(
        give_back(cut), "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return out.withColumnRenamed("id", id_column)
