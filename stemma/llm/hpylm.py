"""Language-model scores by a hierarchical Pitman-Yor model of words.

Words are dishes of restaurants of contexts: the two words before, the word before, none. A context's parent lacks its farthest word, so all contexts
with one last word share a parent; the parent of the restaurant without a context is uniform over the V words of the training texts and one class of all
others. A dish's tables in a restaurant are its customers in the parent.

1. Words before a word are counted in fixed arrays of cells (a hash of the word, of the pair), from which follows how triples of words are dealt: all that follows a
   word goes to one bucket, unless its cell is heavy; then its contexts of two words are dealt to several, and the words after a heavy pair too. All of a triple is in
   one bucket, a restaurant's dishes may be in several.
2. Buckets take all texts' triples and keep them with their numbers in the training texts, and the places where they occur.
3. Gibbs sweeps, each one pass over the buckets (all dishes of a level together, given the tables before, each without its own: dishes of up to SMALL customers from the
   exact distribution of their number of tables, larger ones from a Poisson law at its saddle point). Between them hubs, by word, sum what buckets tell: the customers
   of pairs of words that several buckets hold, and those of the root, which are the tables of all restaurants of one word; Spark sums the customers and tables of
   shared restaurants. Discounts follow from the dishes, and strengths are sampled from a grid, given numbers of restaurants by size over all buckets.
4. After the last sweep the predictive probabilities of SAMPLES seatings are averaged and sums go back to the documents.

Draws follow from hashes of what is drawn, and everything else from sums over all buckets, so scores do not depend, but for rounding, on how the rows are partitioned, on the
number of buckets, which follows the bytes of the corpus, or on HEAVY and HEAVY_PAIR, which bound what a bucket holds. Equality of 56-bit hashes stands in for equality of
words, of 40-bit ones for that of the words before one word.

Nulls and the like: a null, empty or blank text is its end alone; rows without an id are not learned from and count as held out; repeated rows
come out as often as they came in; without training rows every word is of the class of the others, with probability 1.
"""

from __future__ import annotations

import math
import struct
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import LOWER, dropped, groups, mix64, pack, record_batch, shuffle_partitions, staged, trim, tune, unpack, word_hashes, words_by_number

_U = np.uint64
#: Hashes of a document's end, as a word, and of what stands before its first.
END, START = _U(xxhash.xxh64_intdigest(b"")) >> _U(8), _U(xxhash.xxh64_intdigest(b" ")) >> _U(8)
#: Sweeps before the first sample, and samples.
BURN_IN, SAMPLES = 1, 2
#: Dishes of up to so many customers are seated from the exact distribution of their tables.
SMALL = 128
#: Dishes of up to so many by products of odds, which stay within range; beyond by logs, some sizes together.
FEW = 16
_SIZES = [*((n, n) for n in range(2, FEW + 1)), (17, 24), (25, 32), (33, 48), (49, 64), (65, 96), (97, SMALL)]
#: Bytes of text in a run of documents, and of text to a bucket.
RUN, BUCKET = 12 << 20, 6 << 20
#: Tokens after a word's cell, and after a pair's, beyond which it is dealt to several buckets.
HEAVY, HEAVY_PAIR = 1 << 17, 1 << 19
#: Jobs that the buckets are dealt to, one after another, to halve the space of the exchange.
WAVES = 2
_TOLD = "route long, kind int, key long, a long, b long, payload binary"
_TOLD_SCHEMA = pa.schema([("route", pa.int64()), ("kind", pa.int32()), *((c, pa.int64()) for c in ("key", "a", "b")), ("payload", pa.binary())])
#: Kinds of rows: a run's own, sums, a bucket's body, occurrences and state, its words to hubs, their answers, shared restaurants of one and two words, numbers,
#: a bucket's samples, and its tables to hubs.
RUNS, SUMS, BODY, PLACES, STATE, HUB, ANSWER, ROOM_ONE, ROOM_TWO, STAT, SAMPLE, NEWS = range(2, 14)
_PAYLOADS = RUNS, SUMS, BODY, PLACES, STATE, HUB, ANSWER, SAMPLE, NEWS
#: Bytes of a body, or of what is like it, to a row.
PART = 1 << 18
#: Numbers, by size: restaurants by customers and by tables, dishes with one and with two customers, the root's dishes by customers; tokens and words.
C_ONE, T_ONE, C_TWO, T_TWO, D_ONE, D_TWO, ROOT, TOTAL = range(8)
#: Parquet's writer looks at its memory after each row.
_ROWS_OF_MEGABYTES = {"parquet.enable.dictionary": "false", "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
_DDL = "route long, kind int, payload binary"
_SCHEMA = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_KEY = np.dtype([("h", "<u8")])
_FEW = np.dtype([("n", "<u4")])
_LONG = np.dtype([("n", "<i8")])
_PAIR = np.dtype([("w", "<u4"), ("n", "<u4")])
_TRIPLE = np.dtype([("u", "<u4"), ("w", "<u4"), ("doc", "<u4")])
_PLACE = np.dtype([("triple", "<u4"), ("doc", "<u4")])
_SHARED = np.dtype([("w", "<u4"), ("v", "<u8"), ("c", "<i8"), ("t", "<i8")])
_SUM = np.dtype([("doc", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def uniform(keys: np.ndarray, k: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that follow from keys and k alone."""
    return ((mix64(keys + np.multiply(k, 0x9E3779B97F4A7C15, dtype=_U, casting="unsafe")) >> _U(12)).astype(np.float64) + 0.5) * 2.0**-52


@lru_cache(4)
def _stirling(discount: float) -> np.ndarray:
    return stirling(discount)


def stirling(discount: float, most: int = SMALL) -> np.ndarray:
    """Logs of the generalised Stirling numbers [c, t]: ways to seat c customers at t tables, each weighed by its discounted seatings."""
    s = np.zeros((most + 1, most + 1))
    s[1, 1] = 1
    for n in range(1, most):
        t = np.arange(1, n + 2)
        s[n + 1, 1 : n + 2] = s[n, t - 1] + (n - discount * t) * s[n, t]
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(s, 0))


def poisson(mean: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Poisson numbers from two uniform ones each; of means above 30 by the normal law."""
    out = np.maximum(0, np.rint(mean + np.sqrt(-2 * mean * np.log(one)) * np.cos(2 * np.pi * two))).astype(np.int64)
    few = np.flatnonzero(mean <= 30)
    term, n = np.exp(-mean[few]), np.zeros(len(few), np.int64)
    total = term.copy()
    for k in range(1, 100):
        n += total < one[few]
        term = term * mean[few] / k
        total += term
    out[few] = n
    return out


@dataclass
class Parent:
    """What the parent says of dishes, each of which takes its own tables away first: customers and tables of the dish, its base probability, and
    customers and tables of the whole restaurant."""

    mine: np.ndarray
    seated: np.ndarray
    base: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    discount: float
    strength: float

    def probability(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Of dishes x after own tables (a row of numbers for each, or one number) have been given back."""
        wide = (slice(None), None) if np.ndim(own) == 2 else slice(None)
        mine, seated = self.mine[x][wide] + own, self.seated[x][wide]
        kept = np.minimum(seated, mine)
        share = (self.strength + self.discount * (self.tables[x][wide] - seated + kept)) * self.base[x][wide]
        return np.maximum((np.maximum(mine - self.discount * kept, 0) + share) / (self.strength + self.customers[x][wide] + own), 1e-300)


def constant(base: np.ndarray) -> Parent:
    """A parent whose probabilities no table changes."""
    none = np.zeros(len(base))
    return Parent(none, none, base, none, none, 0.0, 1e18)


def seat(c: np.ndarray, t_before: np.ndarray, others: np.ndarray, parent: Parent, discount: float, strength: float, keys: np.ndarray | None) -> np.ndarray:
    """Tables of dishes with c customers each, drawn by keys; without keys their means. others: tables of the restaurant's other dishes."""
    t = np.minimum(c, 1).astype(np.int64 if keys is not None else float)
    ways = _stirling(discount)

    def odds(n: int, x: np.ndarray) -> np.ndarray:
        """Weights of 1 to n tables, that of one being 1."""
        own, out = np.arange(1, n), np.ones((len(x), n))
        step = strength + discount * (others[x, None] + own)
        step *= parent.probability(x, own[None])
        step *= np.exp(ways[n, 2 : n + 1] - ways[n, 1:n])
        np.cumprod(step, axis=1, out=out[:, 1:])
        return out

    def scaled(n: int, x: np.ndarray) -> np.ndarray:
        """The same by logs, the largest being 1, of up to n tables: none of more tables than customers."""
        out = np.log(strength + discount * (others[x, None] + np.arange(n)))
        np.cumsum(out, axis=1, out=out)
        out += np.cumsum(np.log(parent.probability(x, np.arange(n)[None])), axis=1)
        out += ways[c[x], 1 : n + 1]
        return np.exp(out - out.max(1, keepdims=True))

    many = np.flatnonzero(c > 1)
    small = many[c[many] <= SMALL]
    small = small[np.argsort(c[small].astype(np.uint8), kind="stable")]
    sizes = c[small]
    for low, n in _SIZES:
        a, b = np.searchsorted(sizes, [low, n + 1]).tolist()
        rows = (1 << 21) // n
        for i in range(a, b, rows):
            x = small[i : min(b, i + rows)]
            weight = odds(n, x) if n <= FEW else scaled(n, x)
            if keys is None:
                t[x] = weight @ np.arange(1, n + 1) / weight.sum(1)
                continue
            np.cumsum(weight, axis=1, out=weight)
            t[x] = 1 + (weight[:, :-1] < weight[:, -1:] * uniform(keys[x], c[x])[:, None]).sum(1)
    large = many[c[many] > SMALL]
    if large.size:
        n, rate = c[large].astype(float), np.zeros(len(large))
        base = parent.probability(large, t_before[large])
        for _ in range(8):  # the saddle point of the distribution, for a mean that is part of its own rate
            open_rate = np.maximum((strength + discount * (others[large] + rate)) * base / discount, 1e-300)
            low, high, log_rate, log_n = np.full(len(large), -700.0), np.zeros(len(large)), np.log(open_rate * discount), np.log(n)
            for _ in range(50):
                y = (low + high) / 2
                over = log_rate + np.log(-np.expm1(np.minimum(y, -1e-300))) + (discount - 1) * y > log_n
                low, high = np.where(over, y, low), np.where(over, high, y)
            rate = np.minimum(open_rate * -np.expm1(discount * high), n - 1)
        if keys is None:
            t[large] = 1 + rate
            return t
        key = keys[large]
        few = rate < (n - 1) / 2  # the rarer kind of customer is drawn: who opens a table, or who does not
        drawn = poisson(np.where(few, rate, n - 1 - rate), uniform(key, 201), uniform(key, 202))
        t[large] = np.clip(np.where(few, 1 + drawn, n - drawn), 1, n)
    return t


def estimate_discount(one: float, two: float) -> float:
    """From the numbers of dishes with one and with two customers."""
    return min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5


#: Strengths that are tried.
STRENGTHS = 0.01 * 1.8 ** np.arange(27)


def sample_strength(customers: np.ndarray, tables: np.ndarray, discount: float, rng: np.random.Generator) -> float:
    """Given restaurants' customers and tables: from its distribution over a grid, under a gamma prior of shape and rate 1."""
    return strength_of_sizes(np.unique(customers, return_counts=True), np.unique(tables, return_counts=True), discount, rng)


def strength_of_sizes(customers: tuple, tables: tuple, discount: float, rng: np.random.Generator) -> float:
    """The same of how many restaurants have so many customers, so many tables: (numbers, restaurants) each."""
    weight = np.log(STRENGTHS) - STRENGTHS
    for (sizes, times), step, sign in ((tables, discount, 1), (customers, 1.0, -1)):
        sizes, times = sizes[sizes > 1], times[sizes > 1]
        if len(sizes):
            rising = np.array([[math.lgamma(y / step + n) for n in sizes.tolist()] for y in STRENGTHS.tolist()])
            weight += sign * (rising @ times - times.sum() * np.array([math.lgamma(y / step + 1) for y in STRENGTHS.tolist()]))
    weight = np.cumsum(np.exp(weight - weight.max()))
    return float(STRENGTHS[np.searchsorted(weight, rng.random() * weight[-1])])


class Restaurants:
    """A level: dishes with customers c in restaurants of."""

    def __init__(self, of: np.ndarray, size: int, keys: np.ndarray, strength: float):
        self.of, self.size, self.keys, self.strength = of, size, keys, strength

    def reseat(self, c: np.ndarray, parent: Parent, sweep: int, rng: np.random.Generator) -> np.ndarray:
        """Tables of each dish with customers c."""
        self.c = c
        if sweep == 0:
            self.t = np.minimum(c, 1)
        self.discount = estimate_discount(float((c == 1).sum()), float((c == 2).sum()))
        tables = np.bincount(self.of, weights=self.t, minlength=self.size)
        self.t = seat(c, self.t, tables[self.of] - self.t, parent, self.discount, self.strength, self.keys + _U(sweep))
        self.total()
        self.strength = sample_strength(self.customers, self.tables, self.discount, rng)
        return self.t

    def total(self) -> None:
        self.customers, self.tables = np.bincount(self.of, weights=self.c, minlength=self.size), np.bincount(self.of, weights=self.t, minlength=self.size)

    def predict(self, base: np.ndarray) -> np.ndarray:
        some = self.customers[self.of]
        own = np.maximum(self.c - self.discount * self.t, 0) + (self.strength + self.discount * self.tables[self.of]) * base
        return np.where(some > 0, own / np.maximum(self.strength + some, 1e-300), base)

    def parent(self, dish: np.ndarray, base: np.ndarray, own: np.ndarray) -> Parent:
        """For dishes below, of which dish is each one's here, base its probability there, and own its tables."""
        of = self.of[dish]
        return Parent(self.c[dish] - own, self.t[dish], base, self.customers[of] - own, self.tables[of], self.discount, self.strength)


class Dealer:
    """Which bucket an occurrence of a word after others goes to."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, buckets: int):
        self.shift = _U(64 - (len(words).bit_length() - 1))
        self.words, self.pairs, self.buckets = np.maximum(1, -(-words // HEAVY)).astype(_U), np.maximum(1, -(-pairs // HEAVY_PAIR)).astype(_U), buckets

    def cells(self, v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (mix64(v) >> self.shift).astype(np.int64), self.pair_cells(v, mix64(u >> _U(16)))

    def pair_cells(self, v: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        return (mix64(v + mixed) >> self.shift).astype(np.int64)

    def split(self, v: np.ndarray) -> np.ndarray:
        """Whether what follows words v is dealt to several buckets."""
        return self.words[(mix64(v) >> self.shift).astype(np.int64)] > 1

    def split_pairs(self, v: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Whether what follows u and v is."""
        return self.split(v) & (self.pairs[self.cells(v, u)[1]] > 1)

    def route(self, h: np.ndarray, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of occurrences of words h[word] after h[two], h[one]: all those of one triple go to one bucket."""
        out = self._bucket(h, np.zeros(len(h), _U))[one]
        heavy = np.flatnonzero(self.split(h)[one])
        if heavy.size:
            v, u = h[one[heavy]], h[two[heavy]]
            cell, pair = self.cells(v, u)
            part = mix64((u >> _U(16)) + _U(1)) % self.words[cell]
            if (self.pairs > 1).any():
                part += mix64(h[word[heavy]] + _U(3)) % self.pairs[pair] << _U(32)
            out[heavy] = self._bucket(v, part)
        return out

    def _bucket(self, v: np.ndarray, part: np.ndarray) -> np.ndarray:
        return ((mix64(v + mix64(part + _U(2))) >> _U(32)) * _U(self.buckets) >> _U(32)).astype(np.int64)


def grouped(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of so many bits, sorted, and the number of each one's among them."""
    low = max(1, (len(key) - 1).bit_length())
    if bits + low > 64:
        return np.unique(key, return_inverse=True)
    both = key.astype(_U) << _U(low) | np.arange(len(key), dtype=_U)
    both.sort()
    order = (both & _U((1 << low) - 1)).astype(np.int32)
    both >>= _U(low)
    new = np.empty(len(key), bool)
    new[:1] = True
    np.not_equal(both[1:], both[:-1], out=new[1:])
    number = np.empty(len(key), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return both[new], number


class Run:
    """Occurrences of a run of documents: words, the two before each as hashes by local number, and the document."""

    def __init__(self, text: pa.Array):
        names, word, of, size = words_by_number(text)
        # By local number: words, the end, what stands before the first.
        self.h = np.append(word_hashes(names), [END, START])
        self.n = np.bincount(of, minlength=size).astype(np.int64) + 1
        ends = np.cumsum(self.n) - 1
        self.word = np.full(int(self.n.sum()), len(names), np.int32)
        inner = np.ones(len(self.word), bool)
        inner[ends] = False
        self.word[inner] = word
        self.doc = np.repeat(np.arange(size, dtype=np.int32), self.n)
        self.one, self.two = np.empty_like(self.word), np.empty_like(self.word)
        first = ends - self.n + 1
        self.one[1:] = self.word[:-1]
        self.one[first] = len(names) + 1
        self.two[1:] = self.one[:-1]
        self.two[first] = len(names) + 1

    def routes(self, dealer: Dealer) -> np.ndarray:
        return dealer.route(self.h, self.one, self.two, self.word)

    def coder(self):
        """For local numbers: their different hashes, with so many bits taken away, as a frame, and each one's number there."""
        there, number = np.zeros(len(self.h), bool), np.zeros(len(self.h), np.uint32)
        rank = np.argsort(self.h).astype(np.int32)
        place = np.empty_like(rank)
        place[rank] = np.arange(len(rank), dtype=np.int32)

        def code(x: np.ndarray, less: int = 0) -> tuple[bytes, np.ndarray]:
            x = place[x]
            if len(x) < len(there) >> 8:
                kinds = np.unique(x)
            else:
                there[x] = True
                kinds = np.flatnonzero(there)
                there[kinds] = False
            number[kinds] = np.arange(len(kinds))
            return pack((self.h[rank[kinds]] >> _U(less)).view(_KEY)), number[x]

        return code


def _frames(*parts: bytes) -> bytes:
    return b"".join(struct.pack("<q", len(p)) + p for p in parts)


def _parts(body: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(body):
        (n,) = struct.unpack_from("<q", body, at)
        out.append(body[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _hashes(body: bytes) -> np.ndarray:
    return unpack(body, _KEY)["h"]


def _edges(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    start = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return start, np.append(start[1:], len(x))[: len(start)]


def _runs(batches):
    """Batches of documents, by RUN bytes."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.nbytes
            if size >= RUN:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _text(table: pa.Table, name: str) -> pa.Array:
    column = table[name]
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _count_cells(cells: int):
    blank = Dealer(np.zeros(cells, np.int64), np.zeros(cells, np.int64), 1)

    def run(batches):
        total = np.zeros((2, cells), np.int64)
        for t in _runs(batches):
            r = Run(_text(t, "text"))
            n = np.bincount(r.one, minlength=len(r.h))
            total[0] += np.bincount(blank.cells(r.h, r.h)[0], weights=n, minlength=cells).astype(np.int64)
            total[1] += np.bincount(blank.pair_cells(r.h[r.one], mix64(r.h >> _U(16))[r.two]), minlength=cells)
        flat = total.ravel()
        at = np.flatnonzero(flat)
        for i in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[i : i + (1 << 16)]), pa.array(flat[at[i : i + (1 << 16)]])], names=["cell", "n"])
        trim()

    return run


def _send_pairs(dealer: Dealer):
    """Of each run and bucket: different pairs of words with their number in training texts."""

    def run(batches):
        for t in _runs(batches):
            text, learn = _text(t, "text"), t["learn"].to_numpy()
            r = Run(text)
            route = r.routes(dealer)
            bits = len(r.h).bit_length()
            if 2 * bits + dealer.buckets.bit_length() <= 62:
                key = (route.astype(_U) << _U(2 * bits) | r.one.astype(_U) << _U(bits) | r.word.astype(_U)) << _U(1) | learn[r.doc].astype(_U)
                key.sort()
                start = _edges(key >> _U(1))[0]
                n = np.add.reduceat((key & _U(1)).astype(np.int64), start)
                key = key[start] >> _U(1)
                mask = (1 << bits) - 1
                word, one, route = (x.astype(np.int64) for x in (key & _U(mask), key >> _U(bits) & _U(mask), key >> _U(2 * bits)))
            else:  # more buckets and words than one number holds
                key = np.lexsort((r.word, r.one, route))
                word, one, route = (x[key].astype(np.int64) for x in (r.word, r.one, route))
                start = np.flatnonzero(np.concatenate([[True], (np.diff(word) != 0) | (np.diff(one) != 0) | (np.diff(route) != 0)]))
                n = np.add.reduceat(learn[r.doc[key]].astype(np.int64), start)
                word, one, route = word[start], one[start], route[start]
            code = r.coder()
            rows = []
            for a, b in zip(*map(np.ndarray.tolist, _edges(route)), strict=True):
                i, j = _edges(one[a:b])
                x = np.empty(b - a, _PAIR)
                words, x["w"] = code(word[a:b])
                x["n"] = n[a:b]
                rows.append((int(route[a]), 1, _frames(pack(r.h[one[a:b][i]].view(_KEY)), pack((j - i).astype(np.uint32).view(_FEW)), words, pack(x))))
            for i in range(0, len(rows), 64):
                yield record_batch(_SCHEMA, *(list(c) for c in zip(*rows[i : i + 64], strict=True)))
            del r, key, route, n, start, one, word, rows, code
        trim()

    return run


def _numbered(dictionaries: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of packets with dictionaries of their own: all hashes, and the numbers among these."""
    words, place = np.unique(np.concatenate(dictionaries), return_inverse=True)
    place = place.astype(np.int32)
    at, out = 0, []
    for d, x in zip(dictionaries, numbers, strict=True):
        out.append(place[at : at + len(d)][x])
        at += len(d)
    return words, np.concatenate(out).astype(np.int64)


def _send_triples(dealer: Dealer, keys: list[str], wave: int):
    """Of each run and bucket: triples of words with their document; from the first wave on also what concerns the run itself."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for t in _runs(batches):
            text, learn = _text(t, "text"), t["learn"].to_numpy()
            r = Run(text)
            route = r.routes(dealer)
            mine = np.flatnonzero(route % WAVES == wave)
            bits, low = len(r.h).bit_length(), max(1, (len(route) - 1).bit_length())
            if bits + low + dealer.buckets.bit_length() <= 64:
                mine = (route[mine].astype(_U) << _U(bits) | r.one[mine].astype(_U)) << _U(low) | mine.astype(_U)
                mine.sort()
                mine = (mine & _U((1 << low) - 1)).astype(np.int64)
            else:
                mine = mine[np.lexsort((r.one[mine], route[mine]))]
            route = route[mine]
            code = r.coder()
            rows = []
            for a, b in zip(*map(np.ndarray.tolist, _edges(route)), strict=True):
                at = mine[a:b]
                one = r.one[at]
                i, j = _edges(one)
                x = np.empty(b - a, _TRIPLE)
                words, x["w"] = code(r.word[at])
                before, x["u"] = code(r.two[at], 16)
                x["doc"] = r.doc[at] << 1 | learn[r.doc[at]]
                rows.append((int(route[a]), 1, _frames(struct.pack("<q", number), pack(r.h[one[i]].view(_KEY)), pack((j - i).astype(np.uint32).view(_FEW)), words, before, pack(x))))
            if wave == 0:
                sink = pa.BufferOutputStream()
                own = t.select([*keys, "learn"])
                with pa.ipc.new_stream(sink, own.schema) as w:
                    w.write_table(own)
                rows.append((number, 2, _frames(sink.getvalue().to_pybytes(), r.n.astype("<i8").tobytes())))
            for i in range(0, len(rows), 64):
                yield record_batch(_SCHEMA, *(list(c) for c in zip(*rows[i : i + 64], strict=True)))
            number += 1
            del r, route, mine, rows, code
        trim()

    return run


def _told(route, kind: int, key=0, a=0, b=0, payload=None) -> pa.RecordBatch:
    """Rows of _TOLD of one kind; a number stands in each row."""
    n = len(payload) if payload is not None else len(key)
    whole = [pa.array(np.full(n, x, np.int64) if np.ndim(x) == 0 else np.asarray(x, np.int64)) for x in (route, key, a, b)]
    payload = pa.array(payload, pa.binary()) if payload is not None else pa.nulls(n, pa.binary())
    return pa.RecordBatch.from_arrays([whole[0], pa.array(np.full(n, kind, np.int32)), *whole[1:], payload], schema=_TOLD_SCHEMA)


def _in_parts(route: int, kind: int, body: bytes, a: int = 0) -> pa.RecordBatch:
    """A body as rows of PART bytes."""
    parts = [body[i : i + PART] for i in range(0, len(body), PART)]
    return _told(route, kind, key=range(len(parts)), a=a, payload=parts)


def _whole(rows: list) -> bytes:
    return b"".join(x for *_, x in sorted(rows, key=lambda r: r[0]))


def _told_groups(batches):
    """Rows of _TOLD sorted by route, a whole route at a time: by kind, the (key, a, b, payload) of each."""
    now, held = None, {}
    for b in batches:
        for r, k, *x in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r != now:
                if held:
                    yield now, held
                now, held = r, {}
            held.setdefault(k, []).append(x)
    if held:
        yield now, held


def _sizes(which: int, x: np.ndarray) -> pa.RecordBatch:
    """How often each number occurs."""
    if x.size and x.max() < 1 << 20:
        times = np.bincount(x)
        size = np.flatnonzero(times)
        times = times[size]
    else:
        size, times = np.unique(x, return_counts=True)
    return _told(which, STAT, size, times)


def _pack_few(x: np.ndarray) -> bytes:
    return pack(x.astype(np.uint32).view(_FEW))


def _few(body: bytes) -> np.ndarray:
    return unpack(body, _FEW)["n"].astype(np.int64)


def _pack_long(x: np.ndarray) -> bytes:
    return pack(x.astype(np.int64).view(_LONG))


def _longs(body: bytes) -> np.ndarray:
    return unpack(body, _LONG)["n"]


def _hub_of(h: np.ndarray, hubs: int) -> np.ndarray:
    return ((mix64(h + _U(4)) >> _U(32)) * _U(hubs) >> _U(32)).astype(np.int64)


class Bucket:
    """What stands in a bucket, sorted: words before (one), words before those (befores), words; pairs of words (pair_one, pair_word), contexts of two words
    (context_one, context_two), and triples: pair (parent), context (of), and number in training texts (c)."""

    def __init__(self, body: bytes):
        one, befores, words, per_one, pair_word, per_pair, of, contexts, context_two, c = _parts(body)
        self.one, self.befores, self.words = _hashes(one), _hashes(befores), _hashes(words)
        self.pair_one, self.pair_word = np.repeat(np.arange(len(self.one)), _few(per_one)), _few(pair_word)
        self.parent = np.repeat(np.arange(len(self.pair_one)), _few(per_pair))
        contexts = _few(contexts)
        self.context_one, self.context_two = np.repeat(np.arange(len(self.one)), contexts), _few(context_two)
        self.of = _few(of) + (np.cumsum(contexts) - contexts)[self.pair_one[self.parent]]
        self.c = _few(c)
        self.c_both = self.by_context(self.c)

    def by_pair(self, x: np.ndarray) -> np.ndarray:
        """Sums over triples."""
        return np.bincount(self.parent, weights=x, minlength=len(self.pair_one)).astype(np.int64)

    def by_one(self, x: np.ndarray) -> np.ndarray:
        """Sums over pairs."""
        return np.bincount(self.pair_one, weights=x, minlength=len(self.one)).astype(np.int64)

    def by_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights=x, minlength=len(self.context_one)).astype(np.int64)

    @staticmethod
    def frozen(held: list[bytes]) -> tuple[bytes, bytes]:
        """Of packets of triples: the body of a bucket, and its occurrences by run."""
        runs, v, u, w, few, ui, wi, doc = [], [], [], [], [], [], [], []
        for body in held:
            number, heads, sizes, words, before, x = _parts(body)
            x = unpack(x, _TRIPLE)
            runs.append((struct.unpack("<q", number)[0], len(x)))
            v.append(_hashes(heads))
            u.append(_hashes(before))
            w.append(_hashes(words))
            few.append(unpack(sizes, _FEW)["n"])
            ui.append(x["u"])
            wi.append(x["w"])
            doc.append(x["doc"])
        doc = np.concatenate(doc)
        words, wi = _numbered(w, wi)
        befores, ui = _numbered(u, ui)
        one, vi = np.unique(np.concatenate(v), return_inverse=True)
        vi = np.repeat(vi, np.concatenate(few))
        del v, u, w, few
        ubits = len(befores).bit_length()
        pairs, pair_of = grouped(vi * len(words) + wi, (len(one) * len(words)).bit_length())
        del vi, wi
        triples, triple_of = grouped(pair_of.astype(_U) << _U(ubits) | ui.astype(_U), len(pairs).bit_length() + ubits)
        del ui, pair_of
        pairs, parent, two_word = pairs.astype(np.int64), (triples >> _U(ubits)).astype(np.int64), (triples & _U((1 << ubits) - 1)).astype(np.int64)
        pair_one = pairs // len(words)
        contexts, of = grouped(pair_one[parent].astype(_U) << _U(ubits) | two_word.astype(_U), len(one).bit_length() + ubits)
        per_context = np.bincount((contexts >> _U(ubits)).astype(np.int64), minlength=len(one))
        c = np.bincount(triple_of[(doc & 1).astype(bool)], minlength=len(parent))
        sizes, a = np.array(runs, np.int64).reshape(-1, 2), 0
        x = np.empty(len(doc), _PLACE)
        for _, n in runs:  # in the order of triples, which are told by their distances
            both = triple_of[a : a + n].astype(_U) << _U(32) | (doc[a : a + n] >> 1).astype(_U)
            both.sort()
            x["triple"][a : a + n], x["doc"][a : a + n] = np.diff(both >> _U(32), prepend=_U(0)), both & _U(0xFFFFFFFF)
            a += n
        return _frames(
            *(pack(x.view(_KEY)) for x in (one, befores, words)),
            *map(_pack_few, (np.bincount(pair_one, minlength=len(one)), pairs % len(words), np.bincount(parent, minlength=len(pairs)))),
            *map(_pack_few, (of - (np.cumsum(per_context) - per_context)[pair_one[parent]], per_context, contexts & _U((1 << ubits) - 1), c)),
        ), _frames(sizes.tobytes(), pack(x))

    def deal(self, dealer: Dealer, hubs: int) -> None:
        """Which restaurants other buckets hold dishes of, and the order in which words and the pairs of such restaurants are told to hubs."""
        self.split = dealer.split(self.one)
        self.split_two = self.split[self.context_one]
        some = np.flatnonzero(self.split_two)
        self.split_two[some] = dealer.split_pairs(self.one[self.context_one[some]], self.befores[self.context_two[some]] << _U(16))
        hub = _hub_of(self.words, hubs)
        # Few hubs are few bits, which numpy sorts by digits.
        self.order, rank = np.argsort(hub.astype(np.min_scalar_type(hubs)), kind="stable"), np.empty(len(hub), np.int64)
        self.hubs, self.start = np.unique(hub[self.order], return_index=True)
        rank[self.order] = np.arange(len(hub))
        shared = np.flatnonzero(self.split[self.pair_one])
        place = rank[self.pair_word[shared]]
        order = np.argsort(place, kind="stable")
        self.shared, self.place = shared[order], place[order]
        self.ends = np.append(self.start[1:], len(hub))

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the restaurants of one and of two words that other buckets hold dishes of: their names there."""
        two = np.flatnonzero(self.split_two)
        both = mix64(mix64(self.one[self.context_one[two]]) + mix64(self.befores[self.context_two[two]] + _U(6)))
        return self.one[self.split].view(np.int64), both.view(np.int64)

    def tell_words(self, route: int) -> pa.RecordBatch:
        """To hubs, once: words and their numbers in training texts."""
        seen = np.bincount(self.pair_word, weights=self.by_pair(self.c), minlength=len(self.words)).astype(np.int64)
        at = [self.order[a:b] for a, b in zip(self.start.tolist(), self.ends.tolist(), strict=True)]
        return _told(self.hubs, HUB, key=route, payload=[_frames(pack(self.words[x].view(_KEY)), _pack_few(seen[x])) for x in at])

    def tell(self, route: int, t: np.ndarray, t_two: np.ndarray):
        """Tables of triples and pairs: as the next sweep's state, to hubs, and in numbers of restaurants by customers and tables."""
        c_two = self.by_pair(t)
        whole = ~self.split[self.pair_one]
        t_two = np.where(whole, np.minimum(t_two, c_two), t_two)  # of shared pairs, hubs know all customers
        yield _in_parts(route, STATE, _frames(_pack_few(t), _pack_long(t_two)))
        light = np.bincount(self.pair_word[whole], weights=t_two[whole], minlength=len(self.words)).astype(np.int64)[self.order]
        news = []
        for a, b in zip(self.start.tolist(), self.ends.tolist(), strict=True):
            i, j = np.searchsorted(self.place, [a, b])
            x = np.empty(j - i, _SHARED)
            x["w"], x["v"], x["c"], x["t"] = self.place[i:j] - a, self.one[self.pair_one[self.shared[i:j]]], c_two[self.shared[i:j]], t_two[self.shared[i:j]]
            news.append(_frames(_pack_few(light[a:b]), pack(x)))
        yield _told(self.hubs, NEWS, key=route, payload=news)
        t_both = self.by_context(t)
        for which, split, x in ((C_ONE, self.split, self.by_one(c_two)), (T_ONE, self.split, self.by_one(t_two)), (C_TWO, self.split_two, self.c_both), (T_TWO, self.split_two, t_both)):
            yield _sizes(which, x[~split])
        for which, x in ((D_ONE, c_two[whole]), (D_TWO, self.c)):
            yield _sizes(which, x[(x == 1) | (x == 2)])
        one, two = self.names()
        if len(one):
            yield _told(route, ROOM_ONE, key=one)
        if len(two):
            yield _told(route, ROOM_TWO, key=two, a=self.c_both[self.split_two], b=t_both[self.split_two])


def _build(dealer: Dealer, hubs: int):
    """Of each bucket: its body, its occurrences, and what it tells before the first sweep, when each dish has one table."""

    def run(batches):
        for route, rows in groups(own := _set_apart(batches)):
            body, places = Bucket.frozen([b for _, b in rows])
            yield _in_parts(route, BODY, body)
            yield _in_parts(route, PLACES, places)
            x = Bucket(body)
            x.deal(dealer, hubs)
            yield x.tell_words(route)
            t = np.minimum(x.c, 1)
            yield from x.tell(route, t, np.minimum(x.by_pair(t), 1))
            del x, t, body, places
            for b in own.kept():
                yield _told(b.column(0).to_numpy(), RUNS, payload=b.column(2).to_pylist())
        for b in own.kept():
            yield _told(b.column(0).to_numpy(), RUNS, payload=b.column(2).to_pylist())
        trim()

    return run


def _meet(batches):
    """Hubs: sums over buckets of each word's number in training texts, of the customers of shared pairs, and of the root's; answers in the order of the messages."""
    for hub, kinds in _told_groups(batches):
        routes, names, seen, light, shared = [], [], [], [], []
        for (route, _, _, body), (_, _, _, news) in zip(*(sorted(kinds[k], key=lambda r: r[0]) for k in (HUB, NEWS)), strict=True):
            (h, c), (cu, x) = _parts(body), _parts(news)
            routes.append(route)
            names.append(_hashes(h))
            seen.append(_few(c))
            light.append(_few(cu))
            shared.append(unpack(x, _SHARED))
        sizes, few = [len(x) for x in names], [len(x) for x in shared]
        words, place = np.unique(np.concatenate(names), return_inverse=True)
        c, cu = (np.bincount(place, weights=np.concatenate(x), minlength=len(words)).astype(np.int64) for x in (seen, light))
        x = np.concatenate(shared)
        word = place[np.repeat(np.cumsum(sizes) - sizes, few) + x["w"]]
        one, vi = np.unique(x["v"], return_inverse=True)
        pairs, where = np.unique(word * max(1, len(one)) + vi, return_inverse=True)
        customers, tables = np.bincount(where, weights=x["c"], minlength=len(pairs)).astype(np.int64), np.zeros(len(pairs), np.int64)
        np.maximum.at(tables, where, x["t"])
        tables = np.minimum(tables, customers)
        if len(pairs):
            cu += np.bincount(pairs // len(one), weights=tables, minlength=len(words)).astype(np.int64)
            yield _told(-1, ROOM_ONE, one.view(np.int64), *(np.bincount(pairs % len(one), weights=y, minlength=len(one)).astype(np.int64) for y in (customers, tables)))
        yield _sizes(D_ONE, customers[(customers == 1) | (customers == 2)])
        yield _sizes(ROOT, cu[cu > 0])
        yield _told(TOTAL, STAT, [0, 1], [c.sum(), (c > 0).sum()])
        a = i = 0
        for route, n, m in zip(routes, sizes, few, strict=True):
            at, pair = place[a : a + n], where[i : i + m]
            yield _told(route, ANSWER, key=hub, payload=[_frames(*map(_pack_long, (c[at], cu[at], customers[pair], tables[pair])))])
            a, i = a + n, i + m
    trim()


@dataclass
class Common:
    """What all buckets share at a sweep: the number of known words, the root's customers, discount and strength, its tables by a word's customers (size, tables) and
    in all; discounts and strengths of the restaurants of one and of two words."""

    tokens: int
    kinds: int
    customers: int
    discount: float
    strength: float
    size: np.ndarray
    tables: np.ndarray
    all_tables: float
    one: tuple[float, float]
    two: tuple[float, float]


def _common(stats: dict, sweep: int, seed: int) -> Common:
    """From numbers of restaurants and dishes by size over all buckets."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    rng = np.random.default_rng([seed, sweep])

    def times(which: int, n: int) -> float:
        size, k = stats.get(which, none)
        return float(k[size == n].sum())

    levels = []
    for d, c, t in ((D_ONE, C_ONE, T_ONE), (D_TWO, C_TWO, T_TWO)):
        discount = estimate_discount(times(d, 1), times(d, 2))
        levels.append((discount, strength_of_sizes(stats.get(c, none), stats.get(t, none), discount, rng) if sweep else 1.0))
    n, kinds = int(times(TOTAL, 0)), int(times(TOTAL, 1))
    # Words with as many customers are alike to the root: it works on the numbers of such words, of which there are few, with mean numbers of tables.
    size, many = stats.get(ROOT, none)
    customers, discount, strength, tables = int(size @ many), estimate_discount(times(ROOT, 1), times(ROOT, 2)), 1.0, float(kinds)
    mean = np.zeros(len(size))
    for _ in range(6 if customers else 0):
        mean = seat(size, np.ones(len(size)), np.full(len(size), max(tables - 1, 0.0)), constant(np.full(len(size), 1 / (kinds + 1))), discount, strength, None)
        tables = float(mean @ many)
        strength = sample_strength(np.array([customers]), np.array([round(tables)]), discount, rng)
    return Common(n, kinds, customers, discount, strength, size, mean, float(mean @ many), *levels)


class Seating:
    """All of a bucket's restaurants: from its tables and customers of triples, tables of pairs, what is told of shared pairs' customers, of the root's customers by word, and
    of customers and tables of shared restaurants of one and of two words."""

    def __init__(self, x: Bucket, *told: np.ndarray):
        self.x, self.told = x, told
        self.t, self.t_two, shared, self.cu, c_one, t_one, c_both, t_both = told
        self.c_two = x.by_pair(self.t)
        self.c_two[x.shared] = shared
        self.c_one, self.t_one = x.by_one(self.c_two), x.by_one(self.t_two)
        self.c_both, self.t_both = x.c_both.copy(), x.by_context(self.t)
        self.c_one[x.split], self.t_one[x.split], self.c_both[x.split_two], self.t_both[x.split_two] = c_one, t_one, c_both, t_both

    def frozen(self) -> bytes:
        return _frames(_pack_few(self.told[0]), *map(_pack_long, self.told[1:]))

    @staticmethod
    def thawed(x: Bucket, body: bytes) -> Seating:
        t, *told = _parts(body)
        return Seating(x, _few(t), *map(_longs, told))

    def root(self, common: Common) -> tuple[np.ndarray, np.ndarray]:
        """Of words: tables in the root, and chances there."""
        if len(common.size):
            tables = common.tables[np.minimum(np.searchsorted(common.size, self.cu), len(common.size) - 1)] * (self.cu > 0)
        else:
            tables = np.zeros(len(self.cu))
        new = (common.strength + common.discount * common.all_tables) / (common.kinds + 1)
        return tables, (np.maximum(self.cu - common.discount * tables, 0) + new) / (common.strength + common.customers)

    def predict(self, common: Common) -> np.ndarray:
        """Chances of triples."""
        x = self.x
        up = predicted(self.root(common)[1][x.pair_word], self.c_two, self.t_two, self.c_one[x.pair_one], self.t_one[x.pair_one], *common.one)
        return predicted(up[x.parent], x.c, self.t, self.c_both[x.of], self.t_both[x.of], *common.two)

    def sweep(self, common: Common, sweep: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """New tables of triples and of pairs."""
        x = self.x
        key = mix64(x.one[x.pair_one] + mix64(x.words[x.pair_word] + _U(seed)))
        tables, chance = self.root(common)
        t_two = np.minimum(self.c_two, 1)
        at = np.flatnonzero(self.c_two > 1)  # the others have no choice
        of, word, old = x.pair_one[at], x.pair_word[at], self.t_two[at]
        room = Parent(self.cu[word] - old, tables[word], np.full(len(at), 1 / (common.kinds + 1)), common.customers - old, np.full(len(at), common.all_tables), common.discount, common.strength)
        t_two[at] = seat(self.c_two[at], old, self.t_one[of] - old, room, *common.one, key[at] + _U(11 + sweep))
        # The restaurants' tables in all are those before the sweep: the dishes of a shared one are in many buckets.
        t = np.minimum(x.c, 1)
        at = np.flatnonzero(x.c > 1)
        up, two, old = x.parent[at], x.of[at], self.t[at]
        of, key = x.pair_one[up], mix64(key[up] + mix64(x.befores[x.context_two[two]]) + _U(7))
        room = Parent(self.c_two[up] - old, t_two[up], chance[x.pair_word[up]], self.c_one[of] - old, self.t_one[of], *common.one)
        t[at] = seat(x.c[at], old, self.t_both[two] - old, room, *common.two, key + _U(sweep))
        return t, t_two


def _sweep(dealer: Dealer, hubs: int, commons: list[Common], seed: int):
    """Of each bucket, from its body, state, hubs' answers and shared restaurants: a sweep and what it tells, and the seatings that are samples; after the last sweep,
    sums by document. commons: of all sweeps up to this one."""
    sweep = len(commons) - 1

    def bucket(route: int, kinds: dict):
        x = Bucket(_whole(kinds.pop(BODY)))
        x.deal(dealer, hubs)
        t, t_two = _parts(_whole(kinds.pop(STATE)))
        t_two, c_shared, count, cu = _longs(t_two), np.zeros(len(x.shared), np.int64), np.zeros(len(x.words), np.int64), np.zeros(len(x.words), np.int64)
        which = {h: k for k, h in enumerate(x.hubs.tolist())}
        for hub, _, _, answer in kinds.pop(ANSWER, []):
            a, b = x.start[which[hub]], x.ends[which[hub]]
            i, j = np.searchsorted(x.place, [a, b])
            count[x.order[a:b]], cu[x.order[a:b]], c_shared[i:j], t_two[x.shared[i:j]] = map(_longs, _parts(answer))
        rooms = []
        for kind, name in zip((ROOM_ONE, ROOM_TWO), x.names(), strict=True):
            told = np.array([r[:3] for r in kinds.pop(kind, [])], np.int64).reshape(-1, 3)
            told = told[np.argsort(told[:, 0])]
            told = told[np.searchsorted(told[:, 0], name)]
            rooms += [told[:, 1], told[:, 2]]
        now = Seating(x, _few(t), t_two, c_shared, cu, *rooms)
        samples = {}
        for r in kinds.pop(SAMPLE, []):
            samples.setdefault(r[1], []).append(r)
        samples = {k: _whole(rows) for k, rows in samples.items()}
        if sweep < BURN_IN + SAMPLES:
            for k, body in samples.items():
                yield _in_parts(route, SAMPLE, body, k)
            if sweep > BURN_IN:
                yield _in_parts(route, SAMPLE, now.frozen(), sweep)
            yield from x.tell(route, *now.sweep(commons[sweep], sweep, seed))
            return
        total = now.predict(commons[sweep])
        for k in sorted(samples):
            total += Seating.thawed(x, samples[k]).predict(commons[k])
        runs, places = _parts(_whole(kinds.pop(PLACES)))
        places = unpack(places, _PLACE)
        word = x.pair_word[x.parent]
        score, known, add = np.log10(np.maximum(total / SAMPLES, 1e-300)), (count > 0)[word], np.log10(count + 0.5)[word]
        a = 0
        for number, n in np.frombuffer(runs, "<i8").reshape(-1, 2).tolist():
            triple = np.cumsum(places["triple"][a : a + n], dtype=np.int64)
            some, where = np.unique(places["doc"][a : a + n], return_inverse=True)
            y = np.empty(len(some), _SUM)
            y["doc"], y["known"] = some, np.bincount(where, weights=known[triple])
            y["base"], y["score"] = np.bincount(where, weights=add[triple]), np.bincount(where, weights=score[triple])
            yield _told(number, SUMS, key=[0], payload=[struct.pack("<q", route) + pack(y)])
            a += n

    def run(batches):
        for route, kinds in _told_groups(batches):
            for *_, own in kinds.pop(RUNS, []):
                yield _told(route, RUNS, payload=[own])
            if kinds:
                yield from bucket(route, kinds)
        trim()

    return run


def predicted(base, c, t, customers, tables, discount: float, strength: float) -> np.ndarray:
    """Of dishes with customers c at t tables, in restaurants with so many in all, of chances base in the parent; of an empty one, the parent's."""
    own = np.maximum(c - discount * t, 0) + (strength + discount * tables) * base
    return np.where(customers > 0, own / np.maximum(strength + customers, 1e-300), base)


class _set_apart:
    """Hands rows of kind 2 through, beside the batches without them."""

    def __init__(self, batches):
        self.batches, self.rows = batches, []

    def __iter__(self):
        for b in self.batches:
            other = pc.equal(b.column(1), 2)
            if pc.any(other).as_py():
                self.rows.append(b.filter(other))
                b = b.filter(pc.invert(other))
            yield b

    def kept(self):
        while self.rows:
            yield self.rows.pop()


def _add_up(keys: list[str], shift: float):
    def run(batches):
        for _, rows in groups(batches):
            (own,) = [b for k, b in rows if k == 2]
            ids, tokens = _parts(own)
            ids, tokens = pa.ipc.open_stream(ids).read_all(), np.frombuffer(tokens, "<i8")
            sums = np.zeros(len(tokens), _SUM)
            # By bucket, so that a sum comes out alike however rows arrive.
            for body in sorted((b for k, b in rows if k == 3), key=lambda b: (b[:8], len(b), b)):
                s = unpack(body[8:], _SUM)
                for f in ("known", "base", "score"):
                    sums[f][s["doc"]] += s[f]
            made = pa.table({"n_tokens": tokens, "n_known": sums["known"].astype(np.int64), "base_score": sums["base"] - tokens * shift, "score": sums["score"].copy()})
            for i in range(0, len(tokens), 5000):
                part = pa.Table.from_arrays([*ids.select(keys).slice(i, 5000).columns, *made.slice(i, 5000).columns], names=[*keys, *made.column_names])
                yield from part.combine_chunks().to_batches()

    return run


def score(docs: DataFrame, learn, seed: int = 11) -> DataFrame:
    """docs(key..., text) -> (key..., n_tokens, n_known, train_tokens, base_score, score), logs to base 10. learn: a condition on docs, true for the rows to learn
    from. The last column is the text, whatever its name; ``learn`` and ``text`` are no keys' names."""
    spark = docs.sparkSession
    tune(spark)
    *keys, text = docs.columns
    rows = docs.select(*keys, F.col(text).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(spark)
    buckets = max(1, -(-volume // BUCKET))
    hubs = max(min(buckets, 32), buckets // 64)

    def dealt(df, *by):
        return df.repartition(parts, "route").sortWithinPartitions("route", *by)

    def of_kind(df, *kinds):
        payload = [F.col(f"payload{k}") for k in kinds if k in _PAYLOADS] or [F.lit(None).cast("binary")]
        return df.where(F.col("kind").isin(*kinds)).select("route", "kind", "key", "a", "b", F.coalesce(*payload).alias("payload"))

    def kept(df):
        # A column to each kind, so that only what is asked for is read.
        return staged(df.select("route", "kind", "key", "a", "b", *(F.when(F.col("kind") == k, F.col("payload")).alias(f"payload{k}") for k in _PAYLOADS)), options=_ROWS_OF_MEGABYTES)

    cells = 1 << min(22, max(16, (volume >> 14).bit_length()))
    heavy = rows.select("text").mapInArrow(_count_cells(cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    heavy = heavy.where((F.col("n") > HEAVY) & (F.col("cell") < cells) | (F.col("n") > HEAVY_PAIR)).toArrow()
    total = np.zeros(2 * cells, np.int64)
    total[heavy["cell"].to_numpy()] = heavy["n"].to_numpy()
    dealer = Dealer(total[:cells], total[cells:], buckets)

    built = [kept(dealt(rows.mapInArrow(_send_triples(dealer, keys, wave), _DDL), "kind").mapInArrow(_build(dealer, hubs), _TOLD)) for wave in range(WAVES)]
    told, spent, commons = built, [], []
    for sweep in range(BURN_IN + SAMPLES + 1):
        said = reduce(DataFrame.union, told)
        with _few_rows_a_batch(spark):
            met = kept(dealt(of_kind(reduce(DataFrame.union, built), HUB).union(of_kind(said, NEWS)), "kind", "key").mapInArrow(_meet, _TOLD))
        all_told = said.union(met)
        shared = all_told.where(F.col("kind").isin(ROOM_ONE, ROOM_TWO)).select("route", "kind", "key", "a", "b")
        rooms = staged(shared.groupBy("kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
        one = F.col("kind") == ROOM_ONE
        as_sizes = [rooms.select(F.when(one, first).otherwise(second).cast("long").alias("route"), F.col(x).alias("key"), F.lit(1).cast("long").alias("a")) for x, first, second in (("a", C_ONE, C_TWO), ("b", T_ONE, T_TWO))]
        found = reduce(DataFrame.union, [all_told.where(F.col("kind") == STAT).select("route", "key", "a"), *as_sizes]).groupBy("route", "key").agg(F.sum("a").alias("a")).toArrow().sort_by([("route", "ascending"), ("key", "ascending")])
        which, size, times = (found[c].to_numpy() for c in found.column_names)
        commons.append(_common({k: (size[which == k], times[which == k]) for k in np.unique(which).tolist()}, sweep, seed))
        back = shared.where("route >= 0").select("route", "kind", "key").join(rooms, ["kind", "key"]).select("route", "kind", "key", "a", "b", F.lit(None).cast("binary").alias("payload"))
        back = back.union(of_kind(met, ANSWER))
        last = sweep == BURN_IN + SAMPLES
        kinds = (BODY, PLACES, RUNS) if last else (BODY,)
        new = []
        for wave in range(WAVES):
            for half in range(2 if last else 1):  # the last shuffle is the largest
                mine = of_kind(built[wave], *kinds).union(of_kind(said, STATE, SAMPLE).union(back).where(F.col("route") % WAVES == wave))
                if last:
                    mine = mine.where(F.floor(F.col("route") / WAVES) % 2 == half)
                with _few_rows_a_batch(spark):
                    new.append(kept(dealt(mine, "kind", "key").mapInArrow(_sweep(dealer, hubs, commons, seed), _TOLD)))
            if last:
                dropped(built[wave])
        dropped(rooms)
        dropped(met, *spent)
        told = spent = new
    both, common = of_kind(reduce(DataFrame.union, new), RUNS, SUMS), commons[-1]
    both = both.select("route", "kind", "payload")
    schema = rows.select(*keys, *(F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known")), *(F.lit(0.0).alias(c) for c in ("base_score", "score"))).schema
    scored = dealt(both, "kind").mapInArrow(_add_up(keys, math.log10(common.tokens + 0.5 * (common.kinds + 1))), schema)
    return scored.select(*keys, "n_tokens", "n_known", F.lit(common.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@contextmanager
def _few_rows_a_batch(spark):
    """Rows of staged tables may be of megabytes each."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, "64")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def perplexity(scored: DataFrame) -> DataFrame:
    """Of rows of ``score``: tokens, and the perplexity of a token by the model and by the base."""
    n = F.sum("n_tokens")
    return scored.agg(n.alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("score") / n).alias("perplexity"), F.pow(F.lit(10.0), -F.sum("base_score") / n).alias("base_perplexity"))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(True))


def score_corpus(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, more...): learns from the rows that are not held out, scores all; more is left out."""
    key, text = docs.columns[:2]
    return score(docs.select(key, text), ~held_out(key)).select(key, held_out(key).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
