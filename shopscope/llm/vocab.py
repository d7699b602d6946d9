"""Encoding whole texts with a tokenizer file, word by word.

The tokenizers library encodes about one MB a second, too slow for a corpus.
For files that drop white space, a word between blanks always gets the same
ids, so ``TextEncoder`` keeps the ids of the words it has met in a bounded memo
and asks the library only for new ones.  For many texts at a time the new words of
Latin letters are encoded together: the last byte of each is replaced by a sign of its
own, and the tiktoken library encodes the outcome with the ranks of the same file.
For byte-level files whose ids rank
their merges, texts of Latin letters are encoded by the tiktoken library with
the ranks of the same file; any other text goes to the tokenizers library
whole.  Results equal ``Tokenizer.encode`` for every text.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import cached_property

import numpy as np

from .words import Powers, word_table

#: Entries of the word memo of one Python worker (about 150 bytes each); the older half goes beyond that.
MEMO_ENTRIES = 700_000
#: Ids kept by :meth:`TextEncoder.encode_many` for the words it has met, and bytes of texts it works on together.
POOL_IDS = 8_000_000
GROUP_BYTES = 2 << 20
#: Longest word that goes to the tiktoken library, whose time for a word grows with the square of it.
LONGEST_WORD = 400

# The letters and signs whose classes and lower case do not depend on the Unicode version.
LETTERS = "A-Za-zÀ-ÖØ-öø-įıĲ-ɏ"
SIGNS = r"!-/:-@\[-`{-~"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# The split of byte-level files before their merges, and texts for which all libraries agree on its classes.
BYTE_PATTERN = CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LATIN = re.compile("[\t\n\r -~\xa1-\u024f]*")
# Blanks for Python that are no white space for the tokenizers.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def public_path(name: str) -> str:
    """Place of a public tokenizer file, looked up where the code runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SPACE, _LETTER, _DIGIT, _SIGN = range(4)


def _letter_classes() -> np.ndarray:
    """The class of each code point of :data:`_PLAIN_WORD`; pieces are stretches of one class, and single digits."""
    found = np.full(0x180, _SPACE, np.uint8)
    for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]:
        kind = unicodedata.category(chr(c))[0]
        found[c] = {"L": _LETTER, "N": _DIGIT}.get(kind, _SIGN)
    return found


# Words that are cut into pieces alike by all libraries and stay as long in lower case.
_PLAIN_WORD = re.compile("[!-&(-~\xa1-\u012f\u0131-\u017f]+")


class MarkedWords:
    """Encodes words of Latin letters for a vocabulary that marks the ends of words.

    Each byte stands for itself, a byte over 0x7F as U+0100 and more; the last byte of
    a word as U+0080 and more, or U+0200 and more if it is over 0x7F.
    """

    def __init__(self, model: dict, octets: dict[str, int]):
        import tiktoken

        ends = model.get("end_of_word_suffix") or ""
        ranks: dict[bytes, int] = {}
        for token, rank in model["vocab"].items():
            body = token[: -len(ends)] if ends and token.endswith(ends) else token
            if all(c in octets for c in body):
                data = [octets[c] for c in body]
                signs = [b if b < 0x80 else 0x100 + b for b in data]
                if len(body) < len(token) and signs:
                    signs[-1] = 0x80 + data[-1] if data[-1] < 0x80 else 0x200 + data[-1]
                ranks.setdefault("".join(map(chr, signs)).encode(), rank)
        spare = 1 + max(ranks.values())
        for b in range(256):  # never left over: the two bytes of a sign are joined first
            if bytes([b]) not in ranks:
                ranks[bytes([b])] = spare
                spare += 1
        pattern = "[!-~\u0180-\u01ff]*[\u0080-\u00ff\u0280-\u02ff]"
        self.ending = np.zeros(spare, bool)
        for token, rank in model["vocab"].items():
            self.ending[rank] = token.endswith(ends)
        self.encoding = tiktoken.Encoding("marked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.classes = _letter_classes()

    @staticmethod
    def fits(model: dict, octets: dict[str, int]) -> bool:
        """Whether the ids of the file rank its merges, below them all single bytes."""
        ids, ends = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        places = [ids.get(a + b, -1) for a, b in pairs]
        single = [ids.get(c + e, 1 << 30) for c in octets for e in ("", ends)]
        return bool(ends) and places == sorted(set(places)) and max(single) < min(places, default=1 << 30)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` (each of :data:`_PLAIN_WORD`), one after another, and the end of each word's ids."""
        points = np.frombuffer(" ".join([*words, ""]).lower().encode("utf-16-le"), "<u2")
        kinds = self.classes[points]
        last = np.ones(len(kinds), bool)  # last sign of a piece, the part of a word that is encoded by itself
        last[:-1] = (kinds[1:] != kinds[:-1]) | (kinds[:-1] == _DIGIT)
        shown = kinds != _SPACE
        pieces = np.cumsum(last & shown)[~shown]  # pieces up to the end of each word
        points, last = points[shown], last[shown]
        wide = points >= 0x80
        places = np.cumsum(1 + wide) - 1  # of the last byte of each
        signs = np.empty(places[-1] + 1, "<u2")
        signs[places[~wide]] = points[~wide] + 0x80 * last[~wide].astype(np.uint16)
        signs[places[wide] - 1] = 0x1C0 + (points[wide] >> 6)
        signs[places[wide]] = np.where(last[wide], 0x280, 0x180) + (points[wide] & 0x3F)
        ids = self.encoding.encode_to_numpy(signs.tobytes().decode("utf-16-le"), disallowed_special=())
        return ids, (np.flatnonzero(self.ending[ids]) + 1)[pieces - 1]


class TextEncoder:
    """Ids of whole texts as little-endian bytes of ``dtype`` (uint16 where the vocabulary fits)."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.file = file
        with open(file, encoding="utf-8") as f:
            layout = json.load(f)
        size = 1 + max([*layout["model"]["vocab"].values(), *(t["id"] for t in layout["added_tokens"])])
        self.dtype = np.dtype("<u2") if size <= 65536 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = layout["pre_tokenizer"]["type"] != "ByteLevel"
        self.table = _byte_letters()
        self.parts = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[0-9]|[{SIGNS}]+")
        self.memo = _Memo(self)
        self.part_memo: dict[str, bytes] = {}
        self.ranked = None if self.words else self._ranked(layout["model"])
        self.known = KnownWords(self.dtype)
        self.powers = Powers()
        octets = {shown: b for b, shown in self.table.items()}
        self.marked = MarkedWords(layout["model"], octets) if self.words and MarkedWords.fits(layout["model"], octets) else None

    @cached_property
    def library(self):
        """The tokenizer itself; byte-level files need it for odd texts only."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.file)
        found.no_truncation()
        found.no_padding()
        return found

    def _ranked(self, model: dict):
        """A tiktoken encoding with the ranks of the file; None if its ids do not rank its merges."""
        import tiktoken

        octets = {shown: b for b, shown in self.table.items()}
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        places = [ids.get(a + b, -1) for a, b in pairs]
        single = [ids.get(c, 1 << 30) for c in octets]
        if places != sorted(set(places)) or max(single) > min(places, default=1 << 30):
            return None
        used = {*places, *single}
        ranks = {bytes(octets[c] for c in t): i for t, i in ids.items() if i in used}
        return tiktoken.Encoding("ranked", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        """The library's ids of ``text``."""
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        got = self.part_memo.get(part)
        if got is None:
            if len(self.part_memo) >= MEMO_ENTRIES // 4:
                self.part_memo.clear()
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.table)
            got = array(self.code, [t.id for t in self.library.model.tokenize(shown)]).tobytes()
            self.part_memo[part] = got
        return got

    def piece(self, piece: str) -> bytes:
        """Ids of a piece without white space."""
        if piece.isascii() and piece.isalpha():
            return self._part(piece.lower())
        if "<|" in piece:
            return self.whole(piece)
        low = piece.lower()
        parts = self.parts.findall(low)
        if sum(map(len, parts)) != len(low) or len(low) != len(piece):
            return self.whole(piece)
        return b"".join(map(self._part, parts))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; equal to the library's for every text."""
        if self.words:
            if any(s in text for s in SEPARATORS):
                return self.whole(text)
            return b"".join(map(self.memo.__getitem__, text.split()))
        if self.ranked is None or not (text.isascii() or _LATIN.fullmatch(text)) or "<|" in text:
            return self.whole(text)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(self.dtype).tobytes()


    def _fresh(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words``, one after another, and the end of each word's ids."""
        shown = [w.decode() for w in words]
        plain = [len(w) <= LONGEST_WORD and "<|" not in w and bool(_PLAIN_WORD.fullmatch(w)) for w in shown]
        if all(plain):
            return self.marked.encode(shown)
        own: list[np.ndarray] = [np.frombuffer(self.piece(w), self.dtype) if not p else None for w, p in zip(shown, plain)]
        if any(plain):
            ids, ends = self.marked.encode([w for w, p in zip(shown, plain) if p])
            split = iter(np.split(ids, ends[:-1]))
            own = [next(split) if x is None else x for x in own]
        return np.concatenate(own), np.cumsum([len(x) for x in own])

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts (UTF-8); equal to :meth:`encode` of each."""
        if self.marked is None:
            return [self.encode(t.decode()) for t in texts]
        out: list[bytes] = []
        group: list[bytes] = []
        held = 0
        for text in texts:
            if group and held + len(text) > GROUP_BYTES:
                out += self._encode_group(group)
                group, held = [], 0
            group.append(text)
            held += len(text)
        return out + (self._encode_group(group) if group else [])

    def _encode_group(self, texts: list[bytes]) -> list[bytes]:
        data = b"\n".join(texts)
        hashes, starts, ends = word_table(data, self.powers)
        self.known.trim()
        at, size = self.known.find(hashes)
        missing = np.flatnonzero(size < 0)
        if len(missing):
            _, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            new = missing[first]
            ids, stops = self._fresh([data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            sizes = np.diff(stops, prepend=0)
            base = self.known.add(hashes[new], ids.astype(self.dtype), sizes)
            at[missing], size[missing] = (base + stops - sizes)[which], sizes[which]
        total = np.cumsum(size)
        taken = self.known.pool[np.repeat(at - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        stops = np.concatenate([[0], total])[bounds].tolist()
        return [taken[a:b].tobytes() for a, b in zip([0, *stops], stops)]


class KnownWords:
    """Ids of words by their 64-bit hash, in a table with one place for each hash; a newer word takes the place."""

    BITS = 21

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(1 << self.BITS, np.uint64)
        self.at = np.zeros(1 << self.BITS, np.int64)
        self.size = np.full(1 << self.BITS, -1, np.int32)
        self.pool = np.zeros(0, self.dtype)

    def trim(self) -> None:
        """Forget all words once their ids have become too many."""
        if len(self.pool) > POOL_IDS:
            self.clear()

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin in the pool, and how many they are (-1: not known)."""
        place = hashes >> np.uint64(64 - self.BITS)
        return self.at[place], np.where(self.hashes[place] == hashes, self.size[place], -1)

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Keep words with their ids; returns where the ids begin in the pool."""
        place, base = hashes >> np.uint64(64 - self.BITS), len(self.pool)
        self.hashes[place], self.at[place], self.size[place] = hashes, base + np.cumsum(sizes) - sizes, sizes
        self.pool = np.concatenate([self.pool, ids])
        return base


class _Memo(dict):
    """Ids by piece, filled on demand; of a full memo the younger half is kept."""

    def __init__(self, owner: TextEncoder):
        super().__init__()
        self.owner, self.older = owner, {}

    def __missing__(self, piece: str) -> bytes:
        got = self.older.get(piece)
        if got is None:
            got = self.owner.piece(piece)
        if len(self) >= MEMO_ENTRIES // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = got
        return got


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(file: str) -> TextEncoder:
    """The encoder of this Python worker; workers keep their memo from task to task."""
    if file not in _ENCODERS:
        _ENCODERS[file] = TextEncoder(file)
    return _ENCODERS[file]
