"""Periodic runs of words by string synchronising sets (operator 11).

A run is a maximal stretch of words with smallest period q that holds at least
``EXPONENT`` periods.  Its period is found at the dyadic scale t (a power of
two) with t <= q < 2t:

* Every fragment of t words has a hash.  A position is *synchronising* if the
  least hash of the t + 1 fragments beginning at it or up to t words later
  belongs to the first or the last of them.  This depends on the 2t words from the
  position only, its *context*, so equal contexts are selected alike, wherever
  they stand.
* Fragments of period t/4 or less repeat themselves and are left out of the
  selection.  They lie in highly periodic regions, which are detected
  separately: the periods under ``FIRST_SCALE`` by comparing words directly, all
  others at the scales below.  These regions supply the omitted small periods.
* A run of t <= q < 2t has a synchronising position among its first t, and the
  next position with the same context is exactly q further on.  So each position
  and the next one of equal context propose their distance, if it is between t
  and 2t.  Proposals that chain up are joined, extended word by word on the
  words themselves to both sides, and kept if the run is long enough and its
  period has no proper divisor that is a period.

Hashes select and propose only; every reported run is confirmed on the words.
The work is about n log n for n words, and no list of positions per period is
held.  Documents of one Arrow batch are worked on together, in groups of about
``GROUP_WORDS`` words, each ended by a word of its own.

Cases: a null or empty text has no words and no runs; texts under 6 words have
no runs; a null id is as good as any other; a very long text is one group of its
own, in memory of some 100 bytes a word; repeated rows and extra columns do not
matter, each row is worked on by itself; equal exponents are settled by start,
then period; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized_batches, text_or_empty
from .words import scramble

#: Periods that a run holds at least, and the least number of words of a reported run.
EXPONENT = 4
LEAST_WORDS = 6
#: The first scale with synchronising sets; smaller periods are compared directly.
FIRST_SCALE = 4
#: Words worked on together.
GROUP_WORDS = 400_000
#: Words compared at once while a run is extended, to begin with.
STEP = 64

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64

Rewrite = Callable[[int | None, int], np.ndarray | None]


def doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of fragments of 2t words from those of t words; fragments over the end stay apart."""
    out = h * _U(0x9E3779B97F4A7C15) + _U(t)
    out[:-t] += h[t:]
    return scramble(out)


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of at least ``least`` true values."""
    edges = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    return starts[long], ends[long]


def is_primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no proper divisor of ``period`` is a period of the run at ``start`` too."""
    left, prime = period, 2
    block = words[start : start + period]
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime == 0:
            part = period // prime
            if np.array_equal(block, words[start + part : start + part + period]):
                return False
            while left % prime == 0:
                left //= prime
        prime += 1
    return True


def agreeing(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on (step 1) or before it (step -1) equal the word ``period`` further on."""
    found, size, n = 0, STEP, len(words)
    while True:
        if step > 0:
            a, b = at + found, min(at + found + size, n - period)
            unlike = np.flatnonzero(words[a:b] != words[a + period : b + period])
            if len(unlike):
                return found + int(unlike[0])
        else:
            a, b = max(at - found - size, 0), at - found
            unlike = np.flatnonzero(words[a:b] != words[a + period : b + period])
            if len(unlike):
                return found + (b - a - 1 - int(unlike[-1]))
        if b - a < size:
            return found + max(b - a, 0)
        found += size
        size *= 2


def synchronising(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions whose least hash of the t + 1 fragments from them on is that of the first or the last one."""
    values = np.where(periodic, _NONE, h)
    low, width = values, 1
    while width < t:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:-1], low[1:])  # over t + 1 fragments
    n = len(low)
    return np.flatnonzero((low != _NONE) & ((low == values[:n]) | (low == values[t : t + n])))


def proposals(h: np.ndarray, places: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of stretches joined from equal contexts (hashes ``h``) at distances of t to 2t - 1."""
    contexts = h[places]
    order = np.argsort(contexts, kind="stable")
    ranked, at = contexts[order], places[order]
    gaps = at[1:] - at[:-1]
    good = np.flatnonzero((ranked[1:] == ranked[:-1]) & (gaps >= t) & (gaps < 2 * t))
    if not len(good):
        return []
    start, period = at[good], gaps[good]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    new = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] > start[:-1] + 2 * t)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    return list(zip(start[first].tolist(), (start[last] + 2 * t + period[last]).tolist(), period[first].tolist()))


def runs_of(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of all stretches of at least EXPONENT periods, by start, then period, of each document.

    Documents are arrays of word codes (not negative); equal words have equal codes.
    """
    sizes = np.array([len(d) for d in documents], np.int64)
    found: list[set[tuple[int, int, int]]] = [set() for _ in documents]
    kept = np.flatnonzero(sizes >= EXPONENT)
    if not len(kept):
        return [[] for _ in documents]
    # The kept documents, each ended by a code of its own: no stretch reaches over an end.
    words = np.concatenate([x for d in kept for x in (documents[d].astype(np.int64), np.array([-1 - d], np.int64))])
    begins = np.concatenate([[0], np.cumsum(sizes[kept] + 1)])[:-1]

    def add(start: int, length: int, period: int) -> None:
        if is_primitive(words, start, period):
            k = int(np.searchsorted(begins, start, side="right")) - 1
            found[kept[k]].add((start - int(begins[k]), length, period))

    for period in range(1, FIRST_SCALE):
        if len(words) > period:
            for a, b in zip(*stretches(words[:-period] == words[period:], (EXPONENT - 1) * period)):
                add(int(a), int(b - a) + period, period)

    h = scramble(words.view(np.uint64) + _U(0x9E3779B97F4A7C15))
    width, t = 1, FIRST_SCALE
    while True:
        long = sizes[kept] >= EXPONENT * t
        if not long.any():
            return [sorted(x) for x in found]
        if not long.all():  # only documents that can hold a run of this scale go on
            stay = np.repeat(long, sizes[kept] + 1)
            words, h, kept = words[stay], h[stay], kept[long]
            begins = np.concatenate([[0], np.cumsum(sizes[kept] + 1)])[:-1]
        while width < t:
            h = doubled(h, width)
            width *= 2
        marks = np.zeros(len(words) + 1, np.int64)
        for d, begin in zip(kept.tolist(), begins.tolist()):
            for start, length, period in found[d]:
                if EXPONENT * period <= t <= length:
                    marks[begin + start] += 1
                    marks[begin + start + length - t + 1] -= 1
        places = synchronising(h, t, np.cumsum(marks)[:-1] > 0)
        ends = begins + sizes[kept]
        places = places[places + 2 * t <= ends[np.searchsorted(begins, places, side="right") - 1]]
        contexts = doubled(h, t)
        reached: dict[int, int] = {}  # by period, the end of the last run
        for a, b, period in proposals(contexts, places, t):
            if b <= reached.get(period, 0):
                continue
            right = a + agreeing(words, a, period, 1)
            left = a - agreeing(words, a, period, -1)
            reached[period] = right + period
            if right - left >= (EXPONENT - 1) * period:
                add(left, right - left + period, period)
        t *= 2


def group_documents(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of every document of a batch, coded and worked on in groups of bounded size."""
    out: list[list[tuple[int, int, int]]] = []
    group: list[np.ndarray] = []
    codes: dict[bytes, int] = {}
    held = 0
    for own in words:
        if group and held + len(own) > GROUP_WORDS:
            out += runs_of(group)
            group, codes, held = [], {}, 0
        group.append(np.array([codes.setdefault(w, len(codes)) for w in own], np.int64))
        held += len(own)
    return out + runs_of(group)


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    rewrite: Rewrite | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The periodic runs of every text and the text without their repeats.

    Returns (id, runs, best, collapsed): ``runs`` by start, then period; ``best``
    is the run of greatest length / period (null without runs); ``collapsed``
    joins the words that no run holds after its first period.  ``rewrite``, given
    an id and a number of words, may name the word to take at each place.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("id", pa.int64()), ("runs", pa.list_(run)), ("best", run), ("collapsed", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            words = [bytes(text.as_buffer()).split() for text in batch.column(1)]  # at the six white spaces of ASCII
            if rewrite is not None:
                for k, key in enumerate(keys):
                    taken = rewrite(key, len(words[k]))
                    if taken is not None:
                        words[k] = [words[k][i] for i in taken.tolist()]
            for key, own, runs in zip(keys, words, group_documents(words)):
                runs = [r for r in runs if r[1] >= least]
                best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                if runs:
                    gone = np.zeros(len(own) + 1, np.int64)
                    for start, length, period in runs:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    own = [own[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                text = b" ".join(own)
                named = [dict(zip(("start", "length", "period"), r)) for r in runs]
                yield (key, named, best and dict(zip(("start", "length", "period"), best)), text), len(text) + 24 * len(runs)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sized_batches(rows(batches), schema)

    shape = "struct<start:long,length:long,period:long>"
    wanted = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    out = wanted.mapInArrow(run_batches, f"id long, runs array<{shape}>, best {shape}, collapsed binary")
    return out.select(F.col("id").alias(id_column), "runs", "best", F.col("collapsed").cast("string").alias("collapsed"))
