"""Public tokenizers at corpus speed.

A byte-level BPE never merges across the pieces its pre-tokenizer cuts, so the ids of a text are the ids
of its pieces on end. Workers cut whole batches of UTF-8 bytes with array operations that follow the
pre-tokenizer's pattern, have the tokenizers library encode every piece they have not met, and look the
rest up. Texts with characters outside the range for which the cutting is written (Latin letters, below U+0180)
or holding the opening of a special token's string go to the library whole; it gives such a string the special token's id, as its file says.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
_P, _L, _N, _SPACE, _WHITE = range(5)
_TOP = 0x180


def _kind(c: int) -> int:
    if c == 32:
        return _SPACE
    if 9 <= c <= 13 or c in (0x85, 0xA0):
        return _WHITE
    return {"L": _L, "N": _N}.get(unicodedata.category(chr(c))[0], _P)


_KIND = np.array([_kind(c) for c in range(_TOP)], np.uint8)
_ASCII = np.concatenate([_KIND[:128], np.zeros(128, np.uint8)])
_LOWER = np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(_TOP)], np.uint16)
_LOWER_ASCII = np.concatenate([_LOWER[:128], np.arange(128, 256)]).astype(np.uint8)
#: Text cut at a time: the powers and sums for it stay in the processor's cache.
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Pieces that a worker remembers before it starts afresh; bounds its memory.
REMEMBERED = 1 << 20
_SLOTS = 21


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        powers = np.full(n + 1, base, np.uint64)
        powers[0] = 1
        return np.cumprod(powers, dtype=np.uint64)


class _Pieces:
    """Hash table from a piece's 64-bit key to its ids, by open addressing over arrays."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << _SLOTS, np.uint64)
        self.at = np.full(1 << _SLOTS, -1, np.int32)
        self.n = 0
        self.ids = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(REMEMBERED + 1, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 where it is new."""
        slot = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = np.where(self.keys[slot] == keys, self.at[slot], -1)
        left = np.flatnonzero((out < 0) & (self.at[slot] >= 0))
        while left.size:
            slot[left] = (slot[left] + 1) & ((1 << _SLOTS) - 1)
            s = slot[left]
            out[left] = np.where(self.keys[s] == keys[left], self.at[s], -1)
            left = left[(out[left] < 0) & (self.at[s] >= 0)]
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Distinct keys that find() doesn't know."""
        n, end = len(keys), self.start[self.n]
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[end : end + len(ids)] = ids
        self.start[self.n + 1 : self.n + n + 1] = end + np.cumsum(lengths)
        number = np.arange(self.n, self.n + n, dtype=np.int32)
        self.n += n
        slot = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        while n:
            free = self.at[slot] < 0
            self.at[slot[free]] = number[free]  # the last of those that want one slot gets it
            self.keys[slot[free]] = keys[free]
            lost = self.at[slot] != number
            self.keys[slot[~lost]] = keys[~lost]
            slot, keys, number = (slot[lost] + 1) & ((1 << _SLOTS) - 1), keys[lost], number[lost]
            n = len(slot)


class Encoder:
    """Ids of UTF-8 texts by one of the public byte-level BPE files."""

    def __init__(self, name: str, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path or public_tokenizers.path(name))
        self.words = name == WORD_BPE
        # The library's model by itself, for pieces whose bytes are already spelled in its alphabet, one to a line.
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spell = {b: alphabet.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        rest = iter(range(256, 256 + 68))
        self.spell = {b: chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else chr(next(rest)) for b in range(256)} | self.spell
        line = self.spell[10]
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(line, "isolated")
        self.line_id = self.model.encode(line).ids[0]
        self.known = _Pieces()
        self.up, self.down = _powers(_BASE, _CHUNK + 1), _powers(_INVERSE, _CHUNK + 1)

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        got = self.library.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in got]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """data: the texts' bytes on end; offsets: where each begins, and the end. Ids on end, and their offsets."""
        ids, counts = [], [np.zeros(1, np.int64)]
        first = 0
        while first < len(offsets) - 1:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _CHUNK, "right")) - 1)
            a, b = offsets[first], offsets[last]
            safe = b - a <= _CHUNK
            if safe:
                part, at = data[a:b], offsets[first : last + 1] - a
                wrong = self._wrong(part, at)
                safe = not wrong.any()
            if safe:
                x, n = self._cut(part, at)
                ids.append(x)
                counts.append(n)
            else:
                for i in range(first, last):
                    text, at = data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]])
                    if len(text) > _CHUNK or self._wrong(text, at).any():
                        x = self.whole([text.tobytes()])[0]
                    else:
                        x = self._cut(text, at)[0]
                    ids.append(x)
                    counts.append(np.array([len(x)]))
            first = last
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.cumsum(np.concatenate(counts))

    def _wrong(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bytes for which the cutting isn't written."""
        follows, lead = (data & 0xC0) == 0x80, data >= 0xC0
        wrong = (data >= 0xC6) | (data == 0xC0) | (data == 0xC1)
        if len(data):
            wrong[1:] |= follows[1:] != lead[:-1]
            wrong[0] |= follows[0]
            wrong[-1] |= lead[-1]
            wrong[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
            wrong[:-1] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)
        return wrong

    def _cut(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of safe texts, and how many each has."""
        n, docs = len(data), len(at) - 1
        if not n:
            return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
        kind = _ASCII[data]
        lead = np.flatnonzero(data >= 0xC0)
        point = (data[lead].astype(np.uint16) & 0x1F) << 6 | data[lead + 1] & 0x3F
        kind[lead] = kind[lead + 1] = _KIND[point]
        if self.words:
            data = _LOWER_ASCII[data]
            low = _LOWER[point]
            data[lead], data[lead + 1] = 0xC0 | low >> 6, 0x80 | low & 0x3F
        begin = np.zeros(n + 1, bool)
        begin[at] = True
        white = kind >= _SPACE
        start = begin[:n].copy()
        same = np.empty(n, bool)  # the byte before is of this text and kind
        same[0] = False
        same[1:] = kind[1:] == kind[:-1]
        same &= ~start
        whites = np.zeros(n, bool)
        whites[1:] = white[:-1]
        whites &= ~begin[:n]  # the byte before is of this text and white space
        if self.words:
            start |= np.where(white, ~whites, ~same)
            start |= (kind == _N) & ((data & 0xC0) != 0x80)
        else:
            after_space = np.zeros(n, bool)
            after_space[1:] = kind[:-1] == _SPACE
            after_space &= ~begin[:n]
            start |= np.where(white, ~whites, ~same & ~after_space)
            ends = white.copy()  # the last byte of white space that text follows
            ends[:-1] &= ~white[1:]
            ends[-1] = False
            ends &= ~begin[1:]
            e = np.flatnonzero(ends)
            start[e - ((data[e] & 0xC0) == 0x80)] = True
        marks = np.flatnonzero(data == 39)
        if marks.size:
            self._contractions(data, kind, begin, start, marks)
        s = np.flatnonzero(start)
        e = np.append(s[1:], n)
        if self.words:
            solid = ~white[s]
            s, e = s[solid], e[solid]
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
            keys = (sums[e] - sums[s]) * self.down[s] ^ (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            keys = (keys ^ keys >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD)
        which = self.known.find(keys)
        if (new := np.flatnonzero(which < 0)).size:
            if self.known.n + new.size > REMEMBERED:
                self.known.clear()
                new = np.arange(len(keys))
            _, one = np.unique(keys[new], return_index=True)
            self._learn(data, s[new[one]], e[new[one]], keys[new[one]])
            which = self.known.find(keys)
        first = self.known.start[which]
        lengths = self.known.start[which + 1] - first
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.known.ids[np.repeat(first - total[:-1], lengths) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(s, at)])

    def _contractions(self, data, kind, begin, start, marks) -> None:
        n = len(data)
        before = np.where(begin[marks], _WHITE, kind[np.maximum(marks - 1, 0)])
        free = (before == _L) | (before == _N) | (before == _WHITE)
        if self.words:
            free |= before == _SPACE
        ends = np.searchsorted(np.flatnonzero(begin), marks, "right")
        ends = np.flatnonzero(begin)[ends]
        room = ends - marks
        x = data[np.minimum(marks + 1, n - 1)]
        y = data[np.minimum(marks + 2, n - 1)]
        one = free & (room >= 2) & np.isin(x, np.frombuffer(b"stmd", np.uint8))
        two = free & (room >= 3) & (((x == 114) | (x == 118)) & (y == 101) | (x == 108) & (y == 108))
        for at, size in ((marks[one], 2), (marks[two], 3)):
            start[at] = True
            start[at + 1] = False
            at = at[at + size < n] + size
            # what follows starts a piece, but for white space that a rule above already parts or joins
            start[at[kind[at] < _SPACE]] = True

    def _learn(self, data, s, e, keys) -> None:
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        lines = np.array([b"\n" in p for p in pieces])
        if lines.any():
            got = self.whole([pieces[i] for i in np.flatnonzero(lines)])
            self.known.add(keys[lines], np.concatenate(got), np.array([len(x) for x in got]))
        keys, pieces = keys[~lines], [p for p, odd in zip(pieces, lines.tolist(), strict=True) if not odd]
        for k in range(0, len(pieces), 4000):
            some = pieces[k : k + 4000]
            text = b"\n".join(some).decode("latin-1").translate(self.spell)
            got = np.array(self.model.encode_batch_fast([text])[0].ids + [self.line_id], np.uint32)
            cuts = np.flatnonzero(got == self.line_id)
            self.known.add(keys[k : k + 4000], got[got != self.line_id], np.diff(cuts, prepend=-1) - 1)


_encoders: dict[tuple[str, str | None], Encoder] = {}


def encoder(name: str, path: str | None = None) -> Encoder:
    """One per worker process."""
    if (name, path) not in _encoders:
        _encoders[name, path] = Encoder(name, path)
    return _encoders[name, path]
