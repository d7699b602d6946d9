"""BPE encoding and decoding with content-defined chunk reuse (operator 9).

A rolling hash over the bytes of a text places cuts that depend on the last
``WINDOW`` bytes only, so passages that documents share fall into the same
chunks wherever they stand.  The inside of a chunk, between its first and its
last white space, is encoded once per worker and reused from a bounded memo.
The texts across chunk joins are then repaired: the word that a cut went
through is re-encoded by the tokenizers library together with a neighbour on
either side, and accepted when the neighbours get exactly the ids they have
in their chunks; without agreement the whole text is re-encoded.

Cases: a null or empty text has no tokens and decodes to the empty string;
null ids, repeated rows and extra columns pass through row by row; very long
texts are handled in one piece of memory of their own size; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .vocab import SEPARATORS, TextEncoder, encoder

#: Bytes that decide a cut, and the mean distance of cuts in bytes (a power of two).
WINDOW = 48
MEAN_CHUNK = 1024
#: Bytes of chunk text kept in the memo of one worker.
MEMO_BYTES = 32 << 20
#: Bytes of ids and decoded text in one output batch.
BATCH_BYTES = 8 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_KEYS = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64)


class Cutter:
    """Positions where the rolling hash of the last ``WINDOW`` bytes cuts a text."""

    def __init__(self, mean: int = MEAN_CHUNK):
        self.shift = np.uint64(64 - (mean.bit_length() - 1))
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1 << 14)
            steps = np.full(size, _BASE, np.uint64)
            back = np.full(size, _BASE_INVERSE, np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)

    def cuts(self, data: bytes) -> list[int]:
        """Byte positions, ascending, each the start of a character, without 0 and the end."""
        n = len(data)
        if n <= WINDOW:
            return []
        self._reach(n)
        octets = np.frombuffer(data, np.uint8)
        sums = np.cumsum(_BYTE_KEYS[octets] * self.inverses[:n], dtype=np.uint64)
        rolled = sums[WINDOW - 1 :].copy()
        rolled[1:] -= sums[: n - WINDOW]
        rolled *= self.powers[WINDOW - 1 : n]
        at = np.flatnonzero(rolled >> self.shift == 0) + WINDOW
        at = at[at < n]
        return at[(octets[at] & 0xC0) != 0x80].tolist()


class Chunk:
    """A chunk between two cuts: the word parts at its ends, and the ids of what lies between them."""

    __slots__ = ("head", "ids", "first", "last", "tail")

    def __init__(self, text: str, enc: TextEncoder):
        pieces = text.split()
        self.head = pieces.pop(0) if pieces and not text[0].isspace() else ""
        self.tail = pieces.pop() if pieces and not text[-1].isspace() else ""
        self.ids = enc.encode(" ".join(pieces))
        self.first, self.last = (pieces[0], pieces[-1]) if pieces else ("", "")


class ChunkEncoder:
    """Encodes whole texts from reused chunks; equal to the library's encoding."""

    def __init__(self, file: str):
        self.enc = encoder(file)
        self.cutter = Cutter()
        self.memo: dict[bytes, Chunk] = {}
        self.held = 0

    def _chunk(self, data: bytes) -> Chunk:
        got = self.memo.get(data)
        if got is None:
            got = Chunk(data.decode(), self.enc)
            self.held += 2 * len(data) + 500
            if self.held > MEMO_BYTES:
                self.memo.clear()
                self.held = 0
            self.memo[data] = got
        return got

    def _repair(self, before: str, middle: str, after: str) -> bytes | None:
        """Ids of ``middle`` read off a re-encoding with its neighbours; None without agreement."""
        left, right = self.enc.encode(before), self.enc.encode(after)
        got = self.enc.whole(" ".join(x for x in (before, middle, after) if x))
        if got.startswith(left) and got.endswith(right) and len(got) >= len(left) + len(right):
            return got[len(left) : len(got) - len(right)]
        return None

    def encode(self, text: str) -> bytes:
        data = text.encode()
        cuts = self.cutter.cuts(data)
        if not cuts or not self.enc.words or any(s in text for s in SEPARATORS):
            return self.enc.encode(text)
        out, open_text, before = [], "", ""
        for a, b in zip([0, *cuts], [*cuts, len(data)]):
            piece = data[a:b]
            shown = piece.decode()
            if len(shown.split(None, 1)) == 1 and not shown[0].isspace() and not shown[-1].isspace():
                open_text += shown  # no white space: the word goes on
                continue
            chunk = self._chunk(piece)
            middle = open_text + chunk.head
            if middle:
                ids = self._repair(before, middle, chunk.first) if a else self.enc.encode(middle)
                if ids is None:
                    return self.enc.whole(text)
                out.append(ids)
            out.append(chunk.ids)
            open_text, before = chunk.tail, chunk.last
        if open_text:
            out.append(self.enc.encode(open_text))
        return b"".join(out)


_CHUNKERS: dict[str, ChunkEncoder] = {}


def encode_decode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode every text of ``docs``.

    Returns (id, n_tokens, ids, decoded): ``ids`` are little-endian unsigned
    32-bit integers, ``decoded`` is the library's ``decode`` of them with
    special tokens kept.  ``tokenizer`` is a file that every worker has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _CHUNKERS:
            _CHUNKERS[tokenizer] = ChunkEncoder(tokenizer)
        chunker = _CHUNKERS[tokenizer]
        enc = chunker.enc
        plain = enc.library.decoder is None
        tokens = [enc.library.id_to_token(i) or "" for i in range(enc.library.get_vocab_size())] if plain else []
        names = ["id", "n_tokens", "ids", "decoded"]
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(chunker.encode(text.as_py()), enc.dtype)
                listed = ids.tolist()
                decoded = " ".join([tokens[i] for i in listed]) if plain else enc.library.decode(listed, skip_special_tokens=False)
                rows.append((key, len(ids), ids.astype("<u4").tobytes(), decoded))
                size += 4 * len(ids) + len(decoded)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    types = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
    wanted = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    out = wanted.mapInArrow(run, "id long, n_tokens long, ids binary, decoded string")
    return out.withColumnRenamed("id", id_column)
