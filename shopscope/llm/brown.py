"""Brown class-based n-grams (operator 3).

Words are counted over all training documents.  Every word that occurs at
least ``MIN_COUNT`` times is put into one of ``CLASSES`` classes by exchange
clustering, so the clustered vocabulary grows with the corpus: starting from
classes dealt by frequency, every pass judges each word by the classes before
and after it and moves it to the class that raises the likelihood of the class
bigrams most.  Passes go on until the likelihood, counted anew after each,
stops rising.  Rarer words belong to classes by their shape (kind of
characters and length), the end of a text to its own.

Which word stands how often beside which is one Spark table, packed by blocks
of words: the neighbours of the ``HEADS`` most frequent words are spread over
all blocks and added up by class in every pass, all other words are whole in
one row.  Beside it a pass needs the class of each clustered word, one byte a
word, and workers find a word's number by its 64-bit hash (16 bytes a word).

A token has log10 P(class | class before) + log10 P(word | class), with class
transitions smoothed towards class frequencies and words of shape classes
smoothed for the unseen.  Counts of words with at least ``COUNT_SHARE`` of all
tokens go to the workers as one table of bounded size; all others are joined
by word, where none of them can be hot.

Cases: a null or empty text is the end token alone; rows with a null id are
training rows; rows that repeat an id are scored row by row; very long texts
are read whole; without training rows every word is unknown and the base
score 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored, text_or_empty

#: Occurrences from which a word is clustered, and the share of all tokens from which counts are sent (500,000 words).
MIN_COUNT = 5
COUNT_SHARE = 2e-6
CLASSES = 48
#: The passes end when one raises the mean log-likelihood of a token (in nats) by less than this.
LEAST_GAIN = 1e-3
#: Parts of the words that move one after the other in a pass, and most frequent words, whose neighbours are spread.
PARTS = 3
HEADS = 2048
#: Tokens to a block of words, and neighbours to a row and to a group of words judged at a time.
BLOCK_TOKENS = 300_000
ROW_PAIRS = 2048
GROUP_WORDS = 256
#: Moved words handed on together, and counts that are added up in one row.
MOVES_GIVEN = 20_000
ROW_CELLS = 16
#: Counts whose gains are tabled for a pass.
STEPS = 64
#: Weight of class frequencies in transitions, and of unseen words in shape classes.
TRANSITION_PRIOR = 100.0
EMISSION_PRIOR = 0.5
#: Words or pairs counted in a task before they are handed on.
HELD_WORDS = 400_000
HELD_PAIRS = 2_000_000
#: Pairs that are added to those held, or made ready to be handed on, at a time.
STEP_PAIRS = 500_000
#: Bytes of texts whose words are numbered together.
GROUP_BYTES = 4_000_000
#: Neighbour rows handed on together, and words looked up in a task of the join of rare words.
ROWS_GIVEN = 256
JOIN_WORDS = 200_000

#: The end token (no word is empty), its class, and the number of classes that are not clustered.
END = b""
END_CLASS = 0
SHAPES = 16
FIXED = 1 + SHAPES


def shape_classes(words: pa.Array) -> np.ndarray:
    """Classes of words by their kinds of characters and their lengths in bytes."""
    words = words.cast(pa.binary())
    named = words.view(pa.string())
    alpha, plain, alnum = (is_so(named).to_numpy(zero_copy_only=False) for is_so in (pc.ascii_is_alpha, pc.string_is_ascii, pc.ascii_is_alnum))
    kind = np.where(alpha, 0, np.where(~plain, 1, np.where(alnum, 2, 3)))
    return 1 + 4 * kind + np.minimum(3, pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) // 4)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, the place of every word among the distinct words, and these.

    The ASCII functions know A-Z and the blanks meant here only.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    empty = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) == 0)
    if len(empty):  # beside blanks at either end
        full = np.ones(len(words), bool)
        full[empty] = False
        words, owner = words.filter(pa.array(full)), owner[full]
    found = words.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.bincount(owner, minlength=len(texts)), codes, found.dictionary.cast(pa.string()).view(pa.binary())


def with_ends(sizes: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    """``values`` of the words of texts with ``sizes`` words each, and ``end`` after each text."""
    out = np.full(len(values) + len(sizes), end, np.int64)
    out[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
    return out


def bytes_of(words: pa.Array) -> list[bytes]:
    """to_pylist() of a binary array without nulls, without an Arrow object a word."""
    if not len(words):
        return []
    _, offsets, data = words.cast(pa.binary()).buffers()
    cuts = np.frombuffer(offsets, "<i4", len(words) + 1, 4 * words.offset).tolist()
    first, whole = cuts[0], data.slice(cuts[0], cuts[-1] - cuts[0]).to_pybytes()
    return [whole[a - first : b - first] for a, b in zip(cuts, cuts[1:])]


def hashes_of(words: pa.Array) -> np.ndarray:
    marks = np.fromiter(map(xxhash.xxh3_64_intdigest, bytes_of(words)), np.uint64, len(words))
    return (marks ^ np.uint64(1 << 63)).view(np.int64)


def grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in groups of bounded size of their texts in ``column`` (a longer text is the last of its group)."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start, used = 0, 0
        while start < batch.num_rows:
            stop = min(batch.num_rows, int(np.searchsorted(ends, used + GROUP_BYTES - size)) + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - used
            start, used = stop, int(ends[stop - 1])
            if size >= GROUP_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def numbers_of(words: pa.Array, hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Numbers of distinct words: from ``numbers`` for those whose hash is in the ascending ``hashes``, else the shape class."""
    marks = hashes_of(words)
    at = np.searchsorted(hashes, marks)
    listed = at < len(hashes)
    listed[listed] = hashes[at[listed]] == marks[listed]
    out = np.zeros(len(words), np.int64)
    out[listed] = numbers[at[listed]]
    rest = np.flatnonzero(~listed)
    out[rest] = shape_classes(words.take(pa.array(rest)))
    return out


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``texts`` (column text), ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.Table:
            table = pa.Table.from_batches(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return table.rename_columns({"n_sum": "n"}).select(["word", "n"])

        for group in grouped(batches, 0):
            _, codes, words = words_of(group.column(0))
            times = np.bincount(codes, minlength=len(words))
            words = pa.concat_arrays([words, pa.array([END], pa.binary())])
            held.append(pa.RecordBatch.from_arrays([words, pa.array([*times, group.num_rows], pa.int64())], ["word", "n"]))
            size += len(words)
            if size > 2 * HELD_WORDS:
                held = summed().to_batches()
                size = sum(b.num_rows for b in held)
                if size > HELD_WORDS:
                    yield from held
                    held, size = [], 0
        if held:
            yield from summed().to_batches()

    return texts.mapInArrow(give_back(run), "word binary, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def _packed(w: np.ndarray, o: np.ndarray, n: np.ndarray) -> bytes:
    return w.astype("<i4").tobytes() + o.astype("<i4").tobytes() + n.astype("<i8").tobytes()


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts (never negative) in as few bytes each as the largest needs."""
    most = int(x.max(initial=0))
    return x.astype(next(k for k in ("<u1", "<u2", "<u4", "<i8") if most <= np.iinfo(k).max))


def packed_runs(w: np.ndarray, o: np.ndarray, n: np.ndarray) -> bytes:
    """As :func:`spread` reads them: each run of one token is named once, counts take few bytes."""
    firsts = np.flatnonzero(np.diff(w, prepend=-1))
    runs, times = _narrow(np.diff(firsts, append=len(w))), _narrow(n)
    head = np.array([len(w), len(firsts), runs.itemsize, times.itemsize], "<i4")
    return b"".join(x.tobytes() for x in (head, w[firsts].astype("<i4"), o.astype("<i4"), runs, times))


def spread(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, o, n) of rows of :func:`packed_runs`, as of :func:`unpacked`."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    kinds = {1: "<u1", 2: "<u2", 4: "<u4", 8: "<i8"}
    for row in rows:
        size, runs, wide, each = np.frombuffer(row, "<i4", 4).tolist()
        at = 16 + 4 * runs + 4 * size
        parts[0].append(np.repeat(np.frombuffer(row, "<i4", runs, 16), np.frombuffer(row, kinds[wide], runs, at)))
        parts[1].append(np.frombuffer(row, "<i4", size, 16 + 4 * runs))
        parts[2].append(np.frombuffer(row, kinds[each], size, at + wide * runs))
    w, o, n = (np.concatenate(p, dtype=np.int64, casting="unsafe") for p in parts)
    return w, o, n


def unpacked(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, o, n) of packed rows: token w stands n times before token o, or after token ~o where o is negative."""
    parts: list[list[np.ndarray]] = [[], [], []]
    for row in rows:
        size = len(row) // 16
        parts[0].append(np.frombuffer(row, "<i4", size))
        parts[1].append(np.frombuffer(row, "<i4", size, 4 * size))
        parts[2].append(np.frombuffer(row, "<i8", size, 8 * size))
    w, o, n = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
    return w.astype(np.int64), o.astype(np.int64), n


def merged(keys: np.ndarray, counts: np.ndarray, fresh: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct ``keys`` and their ``counts``, with one more for each entry of ``fresh``; counts may be reused."""
    if not fresh:
        return keys, counts
    every = np.concatenate(fresh)
    every.sort()
    firsts = np.flatnonzero(np.diff(every, prepend=-1))
    new, times = every[firsts], np.diff(firsts, append=len(every))
    if not len(keys):
        return new, times
    at = np.searchsorted(keys, new)
    known = keys[np.minimum(at, len(keys) - 1)] == new
    counts[at[known]] += times[known]
    return np.insert(keys, at[~known], new[~known]), np.insert(counts, at[~known], times[~known])


def by_block(
    keys: np.ndarray, counts: np.ndarray, space: int, blocks: int, pack: Callable[..., bytes] = _packed
) -> Iterator[list[tuple[int, bytes]]]:
    """(block, neighbours packed by ``pack``) of the pairs ``keys`` (token before * ``space`` + token after), some STEP_PAIRS at a time.

    Every pair goes to the block of its first token and, where the second is a
    clustered word, to that of the second too.  A range of blocks is made at a
    time, so that beside the pairs themselves only their blocks are held whole.
    In a block the pairs stand by token.
    """
    if not len(keys):
        return
    left, right = (keys // space).astype(np.int32), (keys % space).astype(np.int32)

    def placed(w: np.ndarray, o: np.ndarray) -> np.ndarray:
        return np.where(w < FIXED + HEADS, blocks + o % blocks, w % blocks).astype(np.int32)

    ahead, behind = placed(left, right), placed(right, left)
    behind[right < FIXED] = 2 * blocks  # no block
    sizes = np.bincount(ahead, minlength=2 * blocks) + np.bincount(behind, minlength=2 * blocks + 1)[:-1]
    lows = np.flatnonzero(np.diff(np.cumsum(sizes) // STEP_PAIRS, prepend=-1))
    for low, high in zip(lows, [*lows[1:], 2 * blocks]):
        a = np.flatnonzero((ahead >= low) & (ahead < high))
        b = np.flatnonzero((behind >= low) & (behind < high))
        block = np.concatenate([ahead[a], behind[b]])
        if not len(block):
            continue
        w = np.concatenate([left[a], right[b]])
        order = np.argsort(block.astype(np.int64) * space + w)
        block, w, o = block[order], w[order], np.concatenate([right[a], ~left[b]])[order]
        n = np.concatenate([counts[a], counts[b]])[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        yield [(int(block[x]), pack(w[x:y], o[x:y], n[x:y])) for x, y in zip(starts, [*starts[1:], len(block)])]


def count_pairs(texts: DataFrame, hashes: np.ndarray, numbers: np.ndarray, tokens: int) -> DataFrame:
    """(part, pairs): the neighbours of every token, packed as :func:`spread` reads them.

    Tokens are numbered: fixed classes first, then the clustered words by
    frequency; the first word of a text stands after an end.  Neighbours on
    the right are listed for every token, on the left for clustered words.
    Part -1 holds the fixed and the HEADS next tokens, in any number of rows;
    every other token is whole in one row of part 0 to PARTS - 1.
    """
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((hashes, numbers))
    space = FIXED + len(numbers)
    blocks = PARTS * (1 + tokens // (PARTS * BLOCK_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, numbers = sent.value
        keys, counts, fresh = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            for rows in by_block(keys, counts, space, blocks, packed_runs):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary()))], ["block", "pairs"])

        for group in grouped(batches, 0):
            sizes, codes, words = words_of(group.column(0))
            # An end before, between and after the texts.
            ids = np.concatenate([[END_CLASS], with_ends(sizes, numbers_of(words, listed, numbers)[codes], END_CLASS)])
            every = ids[:-1] * space + ids[1:]
            for at in range(0, len(every), STEP_PAIRS):
                fresh.append(every[at : at + STEP_PAIRS])
                size += len(fresh[-1])
                if size >= STEP_PAIRS:
                    keys, counts = merged(keys, counts, fresh)
                    fresh, size = [], 0
                    if len(keys) > HELD_PAIRS:
                        yield from given()
                        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = merged(keys, counts, fresh)
        fresh = []
        yield from given()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def given() -> Iterator[pa.RecordBatch]:
            w, o, n = spread(held)
            keys = (w << 32) + (o + (1 << 31))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            firsts = np.flatnonzero(np.diff(keys, prepend=-1))
            keys, n = keys[firsts], np.add.reduceat(n, firsts)
            w, o = keys >> 32, (keys & 0xFFFFFFFF) - (1 << 31)
            firsts = np.flatnonzero(np.diff(w, prepend=-1)) if now < blocks else np.arange(0, len(w), ROW_PAIRS)
            cuts = [0]
            for a, b in zip(firsts, [*firsts[1:], len(w)]):  # whole words, until a row is full
                if b - cuts[-1] > ROW_PAIRS and a > cuts[-1]:
                    cuts.append(int(a))
            cuts.append(len(w))
            part = now % PARTS if now < blocks else -1
            for at in range(0, len(cuts) - 1, ROWS_GIVEN):
                some = cuts[at : at + ROWS_GIVEN + 1]
                rows = [packed_runs(w[a:b], o[a:b], n[a:b]) for a, b in zip(some, some[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["part", "pairs"])

        for batch in batches:
            for block, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if held:
                        yield from given()
                    now, held = block, []
                held.append(row.as_py())
        if held:
            yield from given()

    # Blocks are dealt evenly to tasks of one part each: every pass opens each file of a part, so there are to be few.
    slots = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // (PARTS + 1))
    block = F.col("block")
    place = F.when(block < blocks, (block % PARTS + 1) * slots + F.floor(block / PARTS) % slots).otherwise((block - blocks) % slots)
    rows = texts.mapInArrow(give_back(run), "block long, pairs binary")
    rows = rows.repartitionById((PARTS + 1) * slots, place.cast("int")).sortWithinPartitions("block")
    return stored(rows.mapInArrow(give_back(joined), "part int, pairs binary"), "part")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(n: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, same: float) -> tuple[int, float]:
    """The clustered class that a word of class ``own`` fits best, and the gain in log-likelihood.

    ``n``: class bigram counts; ``left``/``right``: counts of classes before
    and after the word; ``same``: how often it follows itself.
    """
    n = n.copy()
    n[own] -= right
    n[:, own] -= left
    n[own, own] += same
    left, right = left.copy(), right.copy()
    left[own] -= same
    right[own] -= same
    n = np.maximum(n, 0)
    rows, columns = n.sum(1) + left, n.sum(0) + right  # all rows and columns get the word's neighbours back
    to = np.arange(FIXED, len(n))
    out, into = n[to], n[:, to].T
    gain = (_xlogx(out + right) - _xlogx(out)).sum(1) + (_xlogx(into + left) - _xlogx(into)).sum(1)
    corner = n[to, to]
    gain -= _xlogx(corner + right[to]) + _xlogx(corner + left[to]) - 2 * _xlogx(corner)
    gain += _xlogx(corner + right[to] + left[to] + same) - _xlogx(corner)
    gain -= _xlogx(rows[to] + right.sum() + same) - _xlogx(rows[to])
    gain -= _xlogx(columns[to] + left.sum() + same) - _xlogx(columns[to])
    best = int(np.argmax(gain))
    return FIXED + best, float(gain[best] - gain[own - FIXED])


def gain_steps(n: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What counts up to STEPS add to x log x of the class bigrams ``n`` (by columns, then by rows) and of their margins."""
    steps = np.arange(STEPS + 1.0)[:, None, None]
    cells = []
    for table in (n.T, n):
        counts = np.maximum(table[:, FIXED:], 0)
        cells.append(_xlogx(counts + steps) - _xlogx(counts))
    margins = []
    for sums in (n.sum(1)[FIXED:], n.sum(0)[FIXED:]):
        sums = np.maximum(sums, 0)
        margins.append(_xlogx(sums + steps[:, 0]) - _xlogx(sums))
    return cells, margins


def _stepped(table: np.ndarray, base: np.ndarray, by: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """xlogx(base + by) - xlogx(base), from ``table`` where ``by`` is at most STEPS; ``at``: rows of ``base``."""
    few = by <= STEPS
    step = np.where(few, by, 0).astype(np.int64)
    out = table[step] if at is None else table[step, at]
    large = np.flatnonzero(~few)
    if len(large):
        counts = np.maximum(base if at is None else base[at[large]], 0)
        out[large] = _xlogx(counts + by[large, None]) - _xlogx(counts)
    return out


def best_classes(
    n: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, same: np.ndarray, steps: tuple | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`best_class` of many words: a row of ``left`` and ``right`` and an entry of ``own`` and ``same`` each.

    ``steps`` are the :func:`gain_steps` of ``n``.  Most neighbours occur a few
    times, so what they add to a class is looked up; only cells that hold the
    word itself, and large counts, are computed for the word.
    """
    cells, margins = steps or gain_steps(n)
    more_by = lambda x, by: _xlogx(x + by) - _xlogx(x)
    words, at = np.arange(len(own)), own - FIXED
    corner = n[own, own] - right[words, own] - left[words, own] + same  # without the word
    rest_left, rest_right = left.copy(), right.copy()
    rest_left[words, own] -= same
    rest_right[words, own] -= same
    gain = np.zeros((len(own), len(n) - FIXED))
    # Each neighbouring class k of a word: counts between it and all candidate classes, without the word.
    for table, side, other, rest, step in ((n.T, right, left, rest_right, cells[0]), (n, left, right, rest_left, cells[1])):
        w, k = np.nonzero(rest)
        if not len(w):
            continue
        by = rest[w, k]
        more = _stepped(step, table[:, FIXED:], by, k)
        more[np.arange(len(w)), at[w]] = more_by(np.maximum(table[k, own[w]] - side[w, k], 0), by)
        inside = np.flatnonzero(k == own[w])
        if len(inside):
            counts = table[k[inside]][:, FIXED:] - other[w[inside], FIXED:]
            more[inside] = more_by(np.maximum(counts, 0), by[inside, None])
        inner = np.flatnonzero(k >= FIXED)
        more[inner, k[inner] - FIXED] = 0  # the diagonal comes below, from both sides at once
        firsts = np.flatnonzero(np.diff(w, prepend=-1))
        gain[w[firsts]] += np.add.reduceat(more, firsts, 0)
    added = rest_left[:, FIXED:] + rest_right[:, FIXED:] + same[:, None]
    w, k = np.nonzero(added)
    diagonal = np.where(k == at[w], corner[w], n[FIXED + k, FIXED + k])
    gain[w, k] += more_by(np.maximum(diagonal, 0), added[w, k])
    for sums, side, rest, step in ((n.sum(1), right, rest_right, margins[0]), (n.sum(0), left, rest_left, margins[1])):
        by = rest.sum(1) + same
        more = _stepped(step, sums[FIXED:], by)
        more[words, at] = more_by(np.maximum(sums[own] - side.sum(1), 0), by)
        gain -= more
    best = gain.argmax(1)
    return FIXED + best, gain[words, best] - gain[words, at]


def _sides(w: np.ndarray, o: np.ndarray, n: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of ascending ``w``, and how often classes stand before and after each, and it beside itself."""
    firsts = np.flatnonzero(np.diff(w, prepend=-1))
    place = np.repeat(np.arange(len(firsts)), np.diff([*firsts, len(w)]))
    after = o >= 0
    cell = place * (2 * size) + of[np.where(after, o, ~o)] + size * after
    both = np.bincount(cell, n, len(firsts) * 2 * size).reshape(-1, 2 * size)
    left, right = both[:, :size], both[:, size:]
    own = np.flatnonzero(o == w)
    return w[firsts], left, right, np.bincount(place[own], n[own], len(firsts))


def _moved(n: np.ndarray, own: int, to: int, left: np.ndarray, right: np.ndarray, same: float) -> None:
    """Update the class bigrams for a word that moves, its neighbours staying."""
    n[own] -= right
    n[:, own] -= left
    n[own, own] += same
    left, right = left.copy(), right.copy()
    left[own] -= same
    right[own] -= same
    n[to] += right
    n[:, to] += left
    n[to, to] += same


def _moved_at_once(n: np.ndarray, own: np.ndarray, to: np.ndarray, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> None:
    """:func:`_moved` of many words (a row of ``left`` and ``right`` each), none of them seeing the others' moves."""
    old, new = np.eye(len(n))[own], np.eye(len(n))[to]
    n -= old.T @ right + left.T @ old
    n += np.diag(same @ (old + new))
    beside = old * same[:, None]
    n += new.T @ (right - beside) + (left - beside).T @ new


def likelihood(n: np.ndarray) -> float:
    """Log-likelihood of the classes in nats, up to a constant, from the class bigrams."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(0)).sum() - _xlogx(n.sum(1)).sum())


def exchange(pairs: DataFrame, n_words: int, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Class of each numbered token, and the class bigram counts.

    ``pairs`` is the table of :func:`count_pairs`; fixed classes stay.  Passes
    over all words are repeated until the likelihood stops rising.
    """
    sc = pairs.sparkSession.sparkContext
    total = FIXED + max(1, min(classes, n_words))
    heads, wide = FIXED + min(HEADS, n_words), 2 * total + 1
    of = np.concatenate([np.arange(FIXED), FIXED + np.arange(n_words) % (total - FIXED)]).astype(np.uint8)

    def counted(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class bigrams, and of each head classes before, after, and itself beside itself."""
        sent = sc.broadcast(of)

        def run(batches: Iterator[pa.RecordBatch], first: int, space: int) -> Iterator[pa.RecordBatch]:
            classes_of = sent.value.astype(np.int64)
            sums = np.zeros(-(-(first + space) // ROW_CELLS) * ROW_CELLS)
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    w, o, n = spread(batch.column(0).slice(at, 128).to_pylist())
                    after = o >= 0
                    ahead = np.flatnonzero(after)
                    sums[:first] += np.bincount(classes_of[w[ahead]] * total + classes_of[o[ahead]], n[ahead], first)
                    if space:
                        cell = w * wide + np.where(after, total, 0) + classes_of[np.where(after, o, ~o)]
                        sums[first : first + space] += np.bincount(cell, n, space)
                        own = np.flatnonzero(w == o)
                        sums[first : first + space] += np.bincount(w[own] * wide + 2 * total, n[own], space)
            cells = sums.reshape(-1, ROW_CELLS).astype(np.int64)
            filled = np.flatnonzero(cells.any(1))
            columns = np.ascontiguousarray(cells[filled].T)
            yield pa.RecordBatch.from_arrays([pa.array(filled), *map(pa.array, columns)], ["row", *names])

        # At most 65 x 65 + 2,065 x 131 counts, 16 to a row; the second only where heads are read.
        names = [f"n{i}" for i in range(ROW_CELLS)]
        schema = ", ".join(f"{c} long" for c in ["row", *names])
        of_heads, of_rest = (pairs.where(f"part {x} -1").select("pairs") for x in ("=", ">"))
        rows = of_heads.mapInArrow(lambda b: run(b, total * total, heads * wide), schema)
        rows = rows.union(of_rest.mapInArrow(lambda b: run(b, total * total, 0), schema))
        rows = rows.groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
        sent.destroy()
        cells = np.zeros((-(-(total * total + heads * wide) // ROW_CELLS), ROW_CELLS))
        cells[rows["row"].to_numpy()] = np.stack([rows[c].to_numpy() for c in names], 1)
        sums = cells.ravel()[: total * total + heads * wide]
        return sums[: total * total].reshape(total, total), sums[total * total :].reshape(heads, wide)

    def judged(of: np.ndarray, n: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of a part with a better class, that class, and the change of the class bigrams."""
        sent = sc.broadcast((of, n))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            classes_of, counts = sent.value
            classes_of = classes_of.astype(np.int64)
            change, steps = np.zeros_like(counts), gain_steps(counts)
            moves: list[tuple[np.ndarray, np.ndarray]] = []

            def given() -> pa.RecordBatch:
                w, to = (np.concatenate(x) for x in zip(*moves))
                moves.clear()
                return pa.RecordBatch.from_arrays([pa.array(w), pa.array(to.astype(np.float64))], ["w", "v"])

            for batch in batches:
                for at in range(0, batch.num_rows, 32):
                    rows = spread(batch.column(0).slice(at, 32).to_pylist())
                    firsts = np.flatnonzero(np.diff(rows[0], prepend=-1))[::GROUP_WORDS]
                    for a, b in zip(firsts, [*firsts[1:], len(rows[0])]):
                        w, left, right, same = _sides(*(x[a:b] for x in rows), classes_of, total)
                        own = classes_of[w]
                        to, gain = best_classes(counts, own, left, right, same, steps)
                        better = np.flatnonzero((gain > 1e-6) & (to != own))
                        _moved_at_once(change, *(x[better] for x in (own, to, left, right, same)))
                        moves.append((w[better], to[better]))
                    if sum(len(w) for w, _ in moves) > MOVES_GIVEN:
                        yield given()
            if moves:
                yield given()
            cells = np.flatnonzero(change)
            yield pa.RecordBatch.from_arrays([pa.array(-1 - cells, pa.int64()), pa.array(change.ravel()[cells])], ["w", "v"])

        given = pairs.where(F.col("part") == part).select("pairs").mapInArrow(run, "w long, v double")
        given = given.groupBy("w").agg(F.sum("v").alias("v")).toArrow()  # a row for each word that moves, and 65 x 65
        sent.destroy()
        w, v = given["w"].to_numpy(), given["v"].to_numpy()
        change = np.zeros(total * total)
        change[-1 - w[w < 0]] = v[w < 0]
        return w[w >= 0], v[w >= 0].astype(np.uint8), change.reshape(total, total)

    n, near = counted(of)
    best, gained = (of, n), likelihood(n)
    while n_words and total - FIXED > 1:
        of, n = of.copy(), n.copy()
        for w in range(FIXED, heads):
            left, right, same = near[w, :total], near[w, total : 2 * total], near[w, -1]
            to, gain = best_class(n, int(of[w]), left, right, same)
            if gain > 1e-6 and to != of[w]:
                _moved(n, int(of[w]), to, left, right, same)
                of[w] = to
        for part in range(PARTS if n_words > HEADS else 0):
            words, to, change = judged(of, np.maximum(n, 0), part)
            of = of.copy()
            of[words] = to
            n = n + change
        n, near = counted(of)
        now = likelihood(n)
        rise, gained = now - gained, max(now, gained)
        if rise > 0:
            best = (of, n)
        if rise < LEAST_GAIN * n.sum():
            break
    return best[0].astype(np.int64), best[1]


def _clustered(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes and the counts of the words that are clustered, 16 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hashes_of(batch.column(0))), batch.column(1)], ["h", "n"])

    wanted = vocabulary.where((F.length("word") > 0) & (F.col("n") >= MIN_COUNT)).select("word", "n")
    rows = wanted.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toArrow()
    hashes, times = rows["h"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], times[order]


def score(docs: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base and model log10 probabilities of every text.

    ``training`` marks the rows that are learnt from.  Returns (id,
    n_tokens, n_known, train_tokens, base_score, score).
    """
    spark = docs.sparkSession
    text = text_or_empty(text_column)
    learnt = docs.where(training).select(text.alias("text"))
    vocabulary = stored(count_words(learnt))
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, types = sums["n"] or 0, sums["v"]
    # At most 1 / COUNT_SHARE words can have that share.
    common = vocabulary.where(F.col("n") >= COUNT_SHARE * tokens).where(F.length("word") > 0).orderBy(F.desc("n"), "word").toArrow()
    words, counts = common["word"].to_pylist(), common["n"].to_numpy().astype(np.float64)
    ends = vocabulary.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    hashes, times = _clustered(vocabulary)
    order = np.lexsort((hashes, -times))  # numbers by frequency
    numbers = np.empty(len(order), np.int64)
    numbers[order] = FIXED + np.arange(len(order))
    of, n = exchange(count_pairs(learnt, hashes, numbers, tokens), len(numbers))
    kind = of[numbers]  # class of each clustered word, by hash

    # Shape classes: their tokens and types over the vocabulary, without the clustered words.
    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shape_classes(batch.column(0))), batch.column(1)], ["k", "n"])

    of_shape = vocabulary.where((F.length("word") > 0) & (F.col("n") < MIN_COUNT))
    of_shape = of_shape.mapInArrow(shapes, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    mass, kinds = np.zeros(len(n)), np.zeros(len(n))
    for r in of_shape.collect():
        mass[r["k"]], kinds[r["k"]] = r["n"], r["v"]
    below = np.log10(mass + EMISSION_PRIOR * (kinds + 1))  # emission of a shape class: log10(c + prior) - below

    share = (n.sum(0) + 1) / (n.sum() + len(n))
    moves = np.log10((n + TRANSITION_PRIOR * share) / (n.sum(1, keepdims=True) + TRANSITION_PRIOR))
    class_of = numbers_of(common["word"].combine_chunks(), hashes, kind)
    per_class = np.bincount(kind, times, len(n))
    below[FIXED:] = np.log10(np.maximum(per_class[FIXED:], 1))
    emission = np.log10(counts + np.where(class_of >= FIXED, 0, EMISSION_PRIOR)) - below[class_of]
    base_of = np.log10(counts + 1)
    sent = spark.sparkContext.broadcast((words, class_of, hashes, kind, emission, base_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed_words, of_listed, marked, kinds_of, emitted, based = sent.value
        # Places: 0 for words that are not listed, then the end, then the listed words.
        number = {w: i for i, w in enumerate([END, *listed_words], 1)}.get
        listed_kinds = np.concatenate([[0, END_CLASS], of_listed]).astype(np.int64)
        emitted, based = np.concatenate([[0.0, 0.0], emitted]), np.concatenate([[0.0, 0.0], based])
        for group in grouped(batches, 1):
            sizes, codes, own = words_of(group.column(1))
            place_of = np.fromiter(map(number, bytes_of(own), repeat(0)), np.int64, len(own))
            # Words that are not listed have a number among themselves.
            unlisted = np.flatnonzero(place_of == 0)
            names = own.take(pa.array(unlisted))
            shapes = numbers_of(names, marked, kinds_of)
            kind_of, name_of = listed_kinds[place_of], np.full(len(own), -1)
            kind_of[unlisted], name_of[unlisted] = shapes, np.arange(len(names))
            places, kinds = with_ends(sizes, place_of[codes], 1), with_ends(sizes, kind_of[codes], END_CLASS)
            size = sizes + 1
            owner = np.repeat(np.arange(len(size)), size)
            before = np.concatenate([[END_CLASS], kinds[:-1]])  # the first word of a text stands after an end
            added = lambda x: np.bincount(owner, x, len(size))  # noqa: E731, B023
            model = added(moves[before, kinds]) + added(emitted[places])
            # A row for each text and one for each of its unlisted words.
            name = name_of[codes]
            rare, times = np.unique((np.repeat(np.arange(len(sizes)), sizes) * max(1, len(names)) + name)[name >= 0], return_counts=True)
            of_text, of_word = rare // max(1, len(names)), rare % max(1, len(names))
            marks = hashes_of(group.column(1).cast(pa.binary()))
            keys = group.column(0).cast(pa.int64())
            rows_of = np.concatenate([np.arange(len(size)), of_text])
            wide = lambda x: np.concatenate([np.zeros(len(size), x.dtype), x])  # noqa: E731, B023
            # The text's own row has a key that is no word (words hold no blank), and its sums.
            texts = [b" %d %d" % (key or 0, mark) for key, mark in zip(keys.to_pylist(), marks.tolist())]
            sums = np.stack([size, added(places > 1), added(based[places]), model], 1)
            starts = np.concatenate([4 * np.arange(len(size) + 1), np.full(len(rare), 4 * len(size))])
            whole = pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(rows_of)),
                    pa.array(marks[rows_of]),
                    pa.concat_arrays([pa.array(texts, pa.binary()), names.take(pa.array(of_word))]),
                    pa.array(wide(times).astype(np.int64)),
                    pa.array(wide(shapes[of_word]).astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(starts.astype(np.int32)), pa.array(sums.ravel()), mask=pa.array(np.arange(len(rows_of)) >= len(size))
                    ),
                ],
                column_names,
            )
            yield from (whole.slice(i, 50_000) for i in range(0, whole.num_rows, 50_000))

    column_names = ["id", "mark", "word", "times", "shape", "own"]
    wanted = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    rows = wanted.mapInArrow(give_back(run), "id long, mark long, word binary, times long, shape int, own array<double>")
    rare = vocabulary.where((F.col("n") < F.lit(COUNT_SHARE * tokens)) & (F.length("word") > 0)).withColumnRenamed("n", "c")
    # Parts of a bounded number of words, so that each is looked up in memory and the rows of texts need no sorting.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + types // JOIN_WORDS)
    joined = rows.repartition(parts, "word").join(rare.repartition(parts, "word").hint("shuffle_hash"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    lower = F.element_at(F.array(*[F.lit(float(x)) for x in below]), F.col("shape") + 1)
    prior = F.when((F.col("shape") >= FIXED) & (c > 0), 0.0).otherwise(EMISSION_PRIOR)
    emit = F.when(F.col("times") > 0, F.col("times") * (F.log10(c + prior) - lower)).otherwise(0.0)
    own = lambda i: F.coalesce(F.col("own")[i], F.lit(0.0))
    sums = joined.groupBy("id", "mark").agg(
        F.count("own").alias("rows"),
        F.sum(own(0)).cast("long").alias("n_tokens"),
        F.sum(own(1).cast("long") + F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(own(2) + F.col("times") * F.log10(c + 1)).alias("base"),
        F.sum(own(3) + emit).alias("model"),
    )
    # Equal rows were added up: share out, and give each its row back.
    one = lambda name: F.col(name) / F.col("rows")
    whole = float(np.log10(tokens + types + 1))
    n_tokens = one("n_tokens").cast("long")
    end_base, end_known = float(np.log10(ends + 1)), int(ends > 0)
    return sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select(
        F.col("id").alias(id_column),
        n_tokens.alias("n_tokens"),
        (one("n_known").cast("long") + F.lit(end_known)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (one("base") + F.lit(end_base) - n_tokens * F.lit(whole)).alias("base_score"),
        one("model").alias("score"),
    )
