"""Personal data in whole texts (operator 1): patterns plus a character-level BiLSTM-CRF.

Base spans come from exact patterns per kind (e-mail, IP address, card,
phone).  A character-level bidirectional LSTM with CRF transitions, trained in
numpy from labelled spans, adds spans that the patterns miss, such as numbers
without the plus sign or addresses with blanks around the ``@``.  Training
windows are cut around the spans of a bounded sample, for each kind, of all the
documents that hold one, and of rewritten variants of them.

Every span of these kinds holds a digit or an ``@``, so the model reads all
text within ``REACH`` characters of such a character; the rest cannot belong
to a span.  Each stretch is covered by overlapping windows; the windows' scores
are merged over the stretch, and one Viterbi pass with the learnt transitions
reconciles all of it at once, so no seam of windows cuts a span.  A model
span is kept if it has the shape of its kind (checksum and lengths included)
and overlaps no base span.

Cases: a null or empty text has no spans; texts of any length are read whole
and in time linear in their length; repeated rows and null ids pass through
row by row; an empty table gives no rows and trains nothing; other columns
are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .char_crf import CharCrf, char_classes
from .common import give_back, stored, text_or_empty

DIGITS = "0123456789"
KINDS = ("email", "ip", "card", "phone")
#: Documents with spans of each kind, and without any, that train the tagger, at most, and windows cut from them, at most.
TRAIN_DOCUMENTS = 300
TRAIN_WINDOWS = 4000
#: Rewritings of each labelled span, at most: fewer where there are spans enough.
REWRITINGS = 16
ROUNDS, BATCH, HIDDEN = 360, 48, 20
#: Window length, distance of window starts, and characters read around a digit or ``@``.
WINDOW, STRIDE, REACH = 96, 48, 64

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is tried from its first digit only: later starts fail or match alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_STRETCH = re.compile(r"[0-9@]+")


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn checksum."""
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, found from their ``@``."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > free and _LOCAL.match(text[start - 1]):
                start -= 1
        if domain and start < at:
            found.append((start, domain.end()))
            free = domain.end()
            at = text.find("@", free)
        else:
            free = at + 1  # the local part of a later address cannot reach over this sign
            at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The pattern spans of each kind, by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not _ANCHOR.search(text):
        return found
    found["email"] = email_spans(text)
    found["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            found["phone"].append(m.span())
    return found


# -- the model's spans ---------------------------------------------------------
_SIGN = re.compile(r"\s*([@.])\s*")
_BRACKETED = re.compile(r"[(\[{]\s*([@.])\s*[)\]}]")
_ADDRESS = re.compile(r"[^\s@]+@[\w-]+(?:\.[\w-]+)+")
_PART = re.compile(r"[^0-9A-Za-z]{1,5}")
_NUMBER = re.compile(r"[+(]{0,2}[0-9][0-9\s()./_+-]*[0-9]")


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without blanks and closing punctuation at its ends."""
    while start < end and text[start] in " \n,;:.":
        start += 1
    while start < end and text[end - 1] in " \n,;:.":
        end -= 1
    return start, end


def plausible(kind: str, text: str) -> bool:
    """Whether a span that only the model found can be of its kind, however it is written."""
    if kind == "email":  # one @ and a dotted host, blanks only around the signs
        return _ADDRESS.fullmatch(_SIGN.sub(r"\1", _BRACKETED.sub(r"\1", text))) is not None
    numbers = re.findall("[0-9]+", text)
    if kind == "ip":  # four parts up to 255, a dot between each
        between = re.split("[0-9]+", text)
        dotted = all(_PART.fullmatch(x) and x.count(".") == 1 for x in between[1:-1])
        return len(numbers) == 4 and not between[0] and not between[-1] and dotted and all(map(_small, numbers))
    digits = "".join(numbers)
    if not _NUMBER.fullmatch(text):
        return False
    return 8 <= len(digits) <= 15 if kind == "phone" else 16 <= len(digits) <= 19 and luhn(digits)


def _whole(text: str, start: int, end: int) -> tuple[int, int]:
    """The span with the digits that its ends cut off, and an opening bracket or plus sign before it."""
    if start < end and text[start] in DIGITS:
        while start and text[start - 1] in DIGITS:
            start -= 1
    while start and text[start - 1] in "+(" and text[start] in "(" + DIGITS:
        start -= 1
    if start < end and text[end - 1] in DIGITS:
        while end < len(text) and text[end] in DIGITS:
            end += 1
    return start, end


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text within REACH of a digit or ``@``, joined where they meet."""
    out: list[list[int]] = []
    for m in _STRETCH.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def windows(length: int) -> list[int]:
    """Starts of the overlapping windows over a stretch of this length."""
    return list(range(0, max(1, length - WINDOW + STRIDE), STRIDE))


#: Weight of each place of a window: what stands near an edge has seen little of one side.
_WEIGHTS = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]


def merged_scores(emitted: np.ndarray) -> np.ndarray:
    """Tag scores of every character of a stretch from those of its windows (window, place, tags).

    Where windows overlap, their scores are averaged, each by its distance from the window's edge.
    """
    n, size, tags = emitted.shape
    total = np.zeros(((n - 1) * STRIDE + size, tags), np.float32)
    weight = np.zeros((len(total), 1), np.float32)
    for k, own in enumerate(emitted):
        total[k * STRIDE : k * STRIDE + size] += own * _WEIGHTS
        weight[k * STRIDE : k * STRIDE + size] += _WEIGHTS
    return total / weight


class Tagger:
    """Adds model spans to texts, many windows at a time."""

    def __init__(self, model: CharCrf | None):
        self.model = model

    def added(self, texts: list[str], base: list[dict]) -> list[dict[str, list[tuple[int, int]]]]:
        """For each text the model's spans by kind, beside its base spans."""
        found = [{k: [] for k in KINDS} for _ in texts]
        if self.model is None:
            return found
        jobs = [(i, a, b) for i, text in enumerate(texts) for a, b in stretches(text)]
        now, taken = -1, bytearray()
        for at in range(0, len(jobs), 256):
            part = jobs[at : at + 256]
            rows = []
            for i, a, b in part:
                codes = char_classes(texts[i][a:b])
                starts = windows(len(codes))
                padded = np.zeros(starts[-1] + WINDOW, np.int64)
                padded[: len(codes)] = codes
                rows += [padded[s : s + WINDOW] for s in starts]
            emitted = np.concatenate([self.model.emissions(np.stack(rows[k : k + 1024])).transpose(1, 0, 2) for k in range(0, len(rows), 1024)])
            row, scores = 0, []
            for _, a, b in part:
                n = len(windows(b - a))
                scores.append(merged_scores(emitted[row : row + n])[: b - a])
                row += n
            for (i, a, b), tags in zip(part, self.model.decode_long(scores, WINDOW)):
                if not tags.any():
                    continue
                if i != now:  # the stretches of a text follow each other
                    now, taken = i, bytearray(len(texts[i]))
                    for x, y in (span for spans in base[i].values() for span in spans):
                        taken[x:y] = b"\x01" * (y - x)
                self._spans(texts[i], a, tags, taken, found[i])
        return found

    @staticmethod
    def _spans(text: str, a: int, merged: np.ndarray, taken: bytearray, found: dict) -> None:
        """Add the runs of one kind's tag to ``found``, but where a character is taken already."""
        steps = np.flatnonzero(np.diff(merged, prepend=0, append=0))
        for s, e in zip(steps[:-1], steps[1:]):
            if not merged[s]:
                continue
            kind = KINDS[merged[s] - 1]
            start, end = _whole(text, *_trimmed(text, a + int(s), a + int(e)))
            if plausible(kind, text[start:end]) and not any(taken[start:end]):
                found[kind].append((start, end))
                taken[start:end] = b"\x01" * (end - start)


# -- training --------------------------------------------------------------------
def _variants(kind: str, text: str, rng: np.random.Generator) -> str:
    """A rewriting of a labelled span that the patterns do not match."""
    if kind != "email" and rng.integers(4):  # other digits, so that the form is learnt and not the number
        top = 10 if kind != "ip" else 3
        text = re.sub("[0-9]", lambda _: str(rng.integers(top)), text)
    digits = re.sub("[^0-9]", "", text)
    pick = lambda *given: given[rng.integers(len(given))]

    def grouped(own: str, sizes: tuple[int, ...], sign: str) -> str:
        out = []
        while own:
            size = pick(*sizes)
            out.append(own[:size])
            own = own[size:]
        if len(out) > 1 and len(out[-1]) < 2:
            out[-2:] = [out[-2] + out[-1]]
        return sign.join(out)

    if kind == "email":
        name, _, host = text.partition("@")
        sign = pick(" @ ", " @", "@ ", "[@]", "(@)")
        return name + sign + host.replace(".", pick(".", ".", " . ", ". ", "[.]"))
    if kind == "ip":
        return text.replace(".", pick(" . ", "[.]", ". ", " .", "(.)"))
    if kind == "card":
        return grouped(digits, pick((4,), (4,), (4, 5, 6)), pick(".", "/", "  ", " - ", "_"))
    body = (digits + "5550142")[: int(rng.integers(8, 12))]
    sign = pick(" ", " ", "-", ".", "/")
    form = rng.integers(5)
    if form == 0:
        tail = digits[-10:].rjust(10, "5")
        return pick("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}").format(tail[:3], tail[3:6], tail[6:])
    if form == 1:
        return f"00{body[:2]}{sign}" + grouped(body[2:], (2, 3, 4, 7), sign)
    if form == 2:
        return "0" + grouped(body, (3, 4), sign)
    if form == 3:
        return pick(f"(0{body[:2]}) ", f"0{body[:3]}/") + grouped(body[3:], (4, 8), pick("", " "))
    return digits[-10:].rjust(10, "5")


def _other_number(rng: np.random.Generator) -> str:
    """Digits that are no personal data: years, dates, prices, amounts, times, versions, decimals."""
    n = lambda a, b: int(rng.integers(a, b))
    year = n(1800, 2030)
    forms = (
        f"{year}", f"{year}-{year + n(1, 30)}", f"{year}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29):02}.{n(1, 13):02}.{year}",
        f"{n(1, 13):02}/{n(1, 29):02}/{year}", f"${n(1, 999)}.{n(0, 100):02}", f"{n(1, 999)},{n(0, 1000):03},{n(0, 1000):03}",
        f"{n(1, 99)} {n(0, 1000):03} {n(0, 1000):03}", f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}", f"{n(1, 9)}.{n(0, 20)}.{n(0, 20)}",
        f"{n(0, 10)}.{n(10**8, 10**9)}", f"pp. {n(100, 500)}-{n(500, 999)}", f"{n(1, 100)}%", f"{year}-{n(1, 13):02}-{n(1, 29):02} {n(0, 24):02}:{n(0, 60):02}",
        f"{n(1, 99)}, {n(1, 99)}, {n(1, 99)}, {n(1, 99)}", f"{n(2, 99)} x {n(2, 99)} = {n(100, 9999)}",
    )
    return forms[n(0, len(forms))]


def training_windows(texts: list[str], limit: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character classes and their tags, around labelled spans and other digits."""
    rng = np.random.default_rng(11)
    xs, ys = [], []

    def add(text: str, spans: list[tuple[int, int, int]], centre: int) -> None:
        start = max(0, centre - int(rng.integers(10, WINDOW - 10)))
        x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        own = char_classes(text[start : start + WINDOW])
        x[: len(own)] = own
        for a, b, tag in spans:
            y[max(0, a - start) : max(0, b - start)] = tag
        xs.append(x)
        ys.append(y)

    every = [base_spans(text) for text in texts]
    count = sum(len(x) for base in every for x in base.values())
    times = min(REWRITINGS, max(2, limit // (2 * max(1, count))))
    for text, base in zip(texts, every):
        if len(xs) >= limit:
            break
        spans = sorted((a, b, i + 1) for i, k in enumerate(KINDS) for a, b in base[k])
        for a, b, tag in spans:
            add(text, spans, a)
            left, right = text[max(0, a - WINDOW) : a], text[b : b + WINDOW]
            for _ in range(times):
                other = _variants(KINDS[tag - 1], text[a:b], rng)
                add(left + other + right, [(len(left), len(left) + len(other), tag)], len(left))
            for _ in range(1 + times // 4):
                add(left + _other_number(rng) + right, [], len(left))
        for m in list(_STRETCH.finditer(text))[:4]:
            if not any(a <= m.start() < b for a, b, _ in spans):
                add(text, spans, m.start())
    if not xs:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.stack(xs[:limit]), np.stack(ys[:limit])


def training_sample(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> list[str]:
    """Of all documents with pattern spans of a kind those of least hash, for each kind; as many with other digits or ``@``.

    The patterns run over every text; a task hands on TRAIN_DOCUMENTS texts of each sort at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(len(KINDS) + 1)]  # heaps of (-hash, text), the greatest hash first
        for batch in batches:
            for mark, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = piece.as_py()
                if not _ANCHOR.search(text):
                    continue
                base = base_spans(text)
                for i in [i for i, k in enumerate(KINDS) if base[k]] or [len(KINDS)]:
                    if len(held[i]) < TRAIN_DOCUMENTS:
                        heapq.heappush(held[i], (-mark, text))
                    else:
                        heapq.heappushpop(held[i], (-mark, text))
        for i, own in enumerate(held):
            for at in range(0, len(own), 50):
                part = own[at : at + 50]
                columns = [pa.array([i] * len(part), pa.int32()), pa.array([-h for h, _ in part], pa.int64()), pa.array([t for _, t in part], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["sort", "h", "text"])

    text = text_or_empty(text_column)
    mark = F.shiftright(F.xxhash64(F.col(id_column).cast("string"), text, F.lit("pii")), 1)
    found = stored(docs.select(mark.alias("h"), text.alias("text")).mapInArrow(give_back(run), "sort int, h long, text string"))
    sorts = []
    for i in range(len(KINDS) + 1):
        rows = found.where(F.col("sort") == i).select("h", "text").orderBy("h", "text").limit(TRAIN_DOCUMENTS).collect()
        sorts.append([r["text"] for r in rows])
    # Every sort in turn, so that the bounded windows hold all of them.
    return list(dict.fromkeys(t for turn in zip_longest(*sorts) for t in turn if t is not None))


def train(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> CharCrf | None:
    """Fit the tagger on a bounded sample of the documents with labelled spans, and of others with digits or ``@``."""
    x, y = training_windows(training_sample(docs, text_column, id_column))
    if not y.any():
        return None
    model = CharCrf(len(KINDS) + 1, HIDDEN)
    model.fit(x, y, ROUNDS, BATCH)
    return model


def span_text(spans: dict[str, list[tuple[int, int]]]) -> str:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def find(docs: DataFrame, model: CharCrf | None, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` columns ``keep`` with base and all spans of each text.

    Adds ``base`` and ``spans`` (arrays of kind, start, end; code points, end
    exclusive), ``base_text`` and ``span_text`` (their comma-joined form).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            base = [base_spans(t) for t in texts]
            more = tagger.added(texts, base)
            every = [{k: b[k] + m[k] for k in KINDS} for b, m in zip(base, more)]
            columns = list(batch.columns[:-1])
            for spans in (base, every):
                listed = [[{"kind": k, "start": a, "end": b} for k in KINDS for a, b in sorted(s[k])] for s in spans]
                columns.append(pa.array(listed, kind))
            columns += [pa.array([span_text(s) for s in spans], pa.string()) for spans in (base, every)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = [*keep, "base", "spans", "base_text", "span_text"]
    wanted = docs.select(*keep, text_or_empty(text_column).alias("_text"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1])
    span = "array<struct<kind: string, start: long, end: long>>"
    return wanted.mapInArrow(give_back(run), f"{own}, base {span}, spans {span}, base_text string, span_text string")


def redact(text: str, spans: list[dict]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans as one."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind']}>"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: CharCrf | None, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_column`` masked; null texts stay null, other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            given = batch.column(at).to_pylist()
            texts = [t or "" for t in given]
            base = [base_spans(t) for t in texts]
            more = tagger.added(texts, base)
            masked = [
                t if t is None else redact(t, [{"kind": k, "start": a, "end": b} for k in KINDS for a, b in s[k] + m[k]])
                for t, s, m in zip(given, base, more)
            ]
            columns = list(batch.columns)
            columns[at] = pa.array(masked, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(give_back(run), docs.schema)


