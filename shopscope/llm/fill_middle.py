"""Fill-in-middle transformation by in-place block rotation (operator 13).

A text is cut at line ends into prefix, middle and suffix.  The sentinels are
inserted before each of the three parts in one bytearray, and the parts are
brought into their order by exchanging neighbouring blocks: reversing either
block and then both together moves them past each other inside the buffer
(three-reversal rotation).  The inverse finds the sentinels in the output,
makes the opposite exchange and deletes them, which gives back the exact text.

Which cut and which form a document gets depends on its id and the seed only,
so that a lost executor's rows come out the same again.

Cases: a null text counts as empty; an empty text and one that holds a
sentinel stay as they are (form ``plain``, both lengths null); a null id is
hashed as an empty number; a very long text takes memory of a few times its
own size; repeated rows and extra columns do not matter, each row is worked
on by itself; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Choice:
    """What an id decides: two cut numbers and the draws for transforming at all and for the form."""

    first: int
    second: int
    transform: int
    form: int

    @staticmethod
    def of(seed: int, key: int | None) -> Choice:
        digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
        return Choice(*(int(digest[i : i + 8], 16) for i in range(0, 32, 8)))


def line_ends(text: np.ndarray) -> np.ndarray:
    """Ends of the lines of ``text`` (bytes); the last line may lack its line feed."""
    ends = np.flatnonzero(text == 0x0A) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return ends


def reverse(block: np.ndarray) -> None:
    """Reverse ``block`` in place, holding half of it besides."""
    half = len(block) // 2
    low = block[:half].copy()
    block[:half] = block[len(block) - half :][::-1]
    block[len(block) - half :] = low[::-1]


def exchange(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks ``start:middle`` and ``middle:end`` of ``buffer`` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view[start:middle])
    reverse(view[middle:end])
    reverse(view[start:end])


def rotate(buffer: bytearray, prefix: int, middle: int, form: str) -> None:
    """Turn the text in ``buffer``, cut after ``prefix`` and ``prefix + middle`` bytes, into ``form``."""
    buffer[prefix + middle : prefix + middle] = SUFFIX
    buffer[prefix:prefix] = MIDDLE
    buffer[0:0] = PREFIX
    middle_at = len(PREFIX) + prefix
    suffix_at = middle_at + len(MIDDLE) + middle
    exchange(buffer, middle_at if form == PSM else 0, suffix_at, len(buffer))


def restore(buffer: bytearray, form: str) -> None:
    """Turn an output of :func:`rotate` back into its text; needs nothing but the output and its form."""
    if form == PLAIN:
        return
    suffix_at, middle_at = buffer.index(SUFFIX), buffer.index(MIDDLE)
    if form == PSM:
        exchange(buffer, suffix_at, middle_at, len(buffer))
        middle_at, suffix_at = suffix_at, suffix_at + len(buffer) - middle_at
    else:
        prefix_at = buffer.index(PREFIX)
        suffix_length = prefix_at
        exchange(buffer, 0, prefix_at, len(buffer))
        middle_at, suffix_at = middle_at - suffix_length, len(buffer) - suffix_length
    del buffer[suffix_at : suffix_at + len(SUFFIX)]
    del buffer[middle_at : middle_at + len(MIDDLE)]
    del buffer[: len(PREFIX)]


def code_points(text: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def transform(text: bytes | memoryview, choice: Choice, rate: int = 100, spm_share: int = 50):
    """(lines, form, code points of prefix and of middle or None, output as bytearray) of one text."""
    buffer = bytearray(text)
    view = np.frombuffer(buffer, np.uint8)
    ends = line_ends(view)
    n = len(ends)
    if not n or choice.transform % 100 >= rate or any(s in buffer for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, buffer
    low, high = sorted((choice.first % (n + 1), choice.second % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    counts = code_points(view[:a]), code_points(view[a:b])
    del view  # a bytearray with views cannot grow
    form = SPM if choice.form % 100 < spm_share else PSM
    rotate(buffer, a, b - a, form)
    return n, form, *counts, buffer


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm_share: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every text of ``docs`` in fill-in-middle form.

    Returns (id, n, form, prefix_chars, middle_chars, output, restored): ``n``
    counts lines, ``restored`` is rebuilt from ``output`` and ``form`` alone.
    ``rate`` is the share of texts transformed and ``spm_share`` the share of
    those that begin with the suffix, both in hundredths.
    """
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n", pa.int64()),
            ("form", pa.string()),
            ("prefix_chars", pa.int64()),
            ("middle_chars", pa.int64()),
            ("output", pa.binary()),
            ("restored", pa.binary()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, form, prefix, middle, buffer = transform(text.as_buffer(), Choice.of(seed, key), rate, spm_share)
                output = bytes(buffer)
                restore(buffer, form)
                yield (key, n, form, prefix, middle, output, bytes(buffer)), 2 * len(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sized_batches(rows(batches), schema)

    wanted = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    out = wanted.mapInArrow(
        run, "id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary"
    )
    texts = [F.col(c).cast("string").alias(c) for c in ("output", "restored")]
    return out.select(F.col("id").alias(id_column), "n", "form", "prefix_chars", "middle_chars", *texts)
