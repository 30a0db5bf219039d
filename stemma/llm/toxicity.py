"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon's words plain and obfuscated, how near they stand to second-person
words, capitals, punctuation, digits and signs within words, repeated letters, and lengths. The lexicon is the words that the labelled texts' classes
tell apart, by document counts, and a short fixed list of little weight. Trees are grown by histograms on the logistic loss; scores of folds
that neither a lexicon nor a tree ensemble has seen give the isotonic curve.

The model is fitted on a bounded sample of labelled rows (``sample``, by a hash of the id); scoring covers every row.

Nulls and the like: a null or empty text has the features of no words and gets the score that such texts get; labels that are
null or whose document is missing don't count; of unequal labels for one id the greater counts; without both classes every score is the share of toxic
labels (0 where there are none). Repeated rows come out as often as they came in. Ids are read as long integers; a row without one is held out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import LOWER, as_bytes, staged, trim, tune

# Insults, and words of address, in four languages.
INSULTS = "idiot moron clown stupid dumb pathetic worthless disgusting loser trash scum garbage imbecile fool jerk bastard bitch whore slut asshole shit fuck fucking retard crap hate ugly filthy vermin connard salope merde imbécile débile crétin ordure abruti dummkopf idiota imbécil estúpido estúpida mierda puta pendejo basura arschloch scheiße trottel vollidiot abschaum widerlich".split()
ADDRESS = "you your yours yourself u ur ya tu toi te ton ta tes vous votre vos du dich dir dein deine deinen ihr euch sie tú ti usted ustedes vosotros vuestro".split()
_LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")
_STRIP = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_SIGNS = "«»‹›„“”‚‘’…–—¡¿·"
#: Weight of a word of the fixed list; learned ones have the log of their odds.
PRIOR = 0.25
FOLDS = 3
_RUN = re.compile(rb"([a-z])\1\1+")
_INNER = re.compile(rb"[a-z][0-9@$!*|+._-]+[a-z]")
FEATURES = (
    "hits_per_word", "hits", "distinct_hits", "weight_per_word", "weight", "hidden_hits", "hits_near_address", "address_per_word", "capitals", "shouted_words", "exclamations", "punctuation", "inner_signs", "letter_runs", "word_length", "words",
)


def _key(word: bytes) -> bytes:
    """A word without signs and disguise: figures and signs that stand for letters, letters repeated three times or more."""
    return _RUN.sub(rb"\1", word.translate(_LEET).translate(None, _STRIP))


def lowered(text: bytes) -> bytes:
    """Small letters of any script; quotation marks and the like that are no ASCII are blanks."""
    if text.isascii():
        return text.translate(LOWER)
    low = text.decode("utf-8", "replace").lower()
    for sign in _SIGNS:
        if sign in low:
            low = low.replace(sign, " ")
    return low.encode()


def features(texts: list[bytes], lexicon: dict[bytes, float]) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    address = {w.encode() for w in ADDRESS}
    get = lexicon.get
    for row, text in zip(out, texts, strict=True):
        low = lowered(text)
        words = low.split()
        n = len(words)
        row[15] = np.log1p(n)
        if not n:
            continue
        raw = np.frombuffer(text, np.uint8)
        kinds = np.bincount(raw, minlength=256)
        upper, letters = kinds[65:91].sum(), kinds[65:91].sum() + kinds[97:123].sum() + kinds[192:].sum()
        marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
        plain = [w.strip(_STRIP) for w in words]
        at = [i for i, w in enumerate(plain) if w in lexicon]
        weights = [get(plain[i]) for i in at]
        hidden = 0
        if kinds[48:58].sum() + kinds[36] + kinds[64] + kinds[42] or _INNER.search(low) or _RUN.search(low):
            seen = set(at)
            for i, w in enumerate(words):
                if i not in seen and (not w.isalpha() or _RUN.search(w)):
                    for k in (_key(w), _key(plain[i])):  # a sign at an end may be a letter or none
                        if k != plain[i] and k in lexicon and len(k) > 2:
                            hidden += 1
                            at.append(i)
                            weights.append(get(k))
                            break
        you = [i for i, w in enumerate(plain) if w in address]
        near = 0
        if you and at:
            y = np.array(you)
            k = np.searchsorted(y, at)
            gap = np.minimum(np.abs(y[np.minimum(k, len(y) - 1)] - at), np.abs(y[np.maximum(k - 1, 0)] - at))
            near = int((gap <= 5).sum())
        row[:15] = (
            len(at) / n, np.log1p(len(at)), np.log1p(len({plain[i] for i in at})), sum(weights) / n, sum(weights), hidden, near, len(you) / n,
            upper / max(1, letters), min(n, sum(map(bytes.isupper, text.split()))) / n if upper > 0.2 * letters else 0.0, kinds[33] / n, marks / n,
            len(_INNER.findall(low)) / n if kinds[48:58].sum() + marks else 0.0, len(_RUN.findall(low)) / n, len(low) / n,
        )
    return out


@dataclass
class Trees:
    """Boosted trees of depth 3 on the logistic loss, grown over quantile histograms."""

    rounds: int = 80
    rate: float = 0.15
    bins: int = 64
    ridge: float = 1.0
    least: int = 8
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)
            feature, cut, node = np.zeros(7, int), np.full(7, self.bins + 1), np.zeros(len(y), int)
            for level in range(3):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-6)
                for j in range(b.shape[1]):
                    slot = (node - first) * (self.bins + 1) + b[:, j]
                    size = count * (self.bins + 1)
                    gs, hs, ns = (np.cumsum(np.bincount(slot, weights=w, minlength=size).reshape(count, -1), 1) for w in (g, h, np.ones(len(y))))
                    gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                    gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(ns < self.least) | (nt - ns < self.least)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(count), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + count][better], cut[first : first + count][better] = j, k[better]
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - 7
            value = self.rate * np.bincount(leaf, weights=g, minlength=8) / (np.bincount(leaf, weights=h, minlength=8) + self.ridge)
            score += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        at = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(3):
                node = 2 * node + 1 + (b[at, feature[node]] > cut[node])
            out += value[node - 7]
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the least-squares nondecreasing curve, by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    xs, where = np.unique(score[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), where)
    counts = np.diff(np.append(where, len(y))).astype(float)
    blocks: list[list[float]] = []  # sum, count, first knot
    for i, (s, c) in enumerate(zip(sums, counts, strict=True)):
        blocks.append([s, c, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, _ = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += c2
    starts = [int(b[2]) for b in blocks]
    ends = [s - 1 for s in starts[1:]] + [len(xs) - 1]
    # One success and one failure, with the weight of a row between them, keep the ends within 0 and 1.
    prior = float(y.mean())
    values = [(b[0] + prior) / (b[1] + 1) for b in blocks]
    values = np.maximum.accumulate(values)
    return np.concatenate([[xs[s], xs[e]] for s, e in zip(starts, ends, strict=True)]), np.repeat(values, 2)


@dataclass
class Model:
    lexicon: dict[bytes, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    share: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        return np.clip(np.interp(self.trees.predict(features(texts, self.lexicon)), *self.knots), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, lexicon_words: int = 400, seed: int = 7) -> Model:
    """docs(doc_id, text), labels(doc_id, toxic): a model from at most sample labelled rows."""
    tune(docs.sparkSession)
    labels = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # At most sample rows of two numbers, so small enough to send everywhere.
    chosen = labels.orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed)), "doc_id").limit(sample)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"))
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Model({}, None, None, 1.0 if bad else 0.0)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(FOLDS)).cast("int")
    rows = rows.select("doc_id", "toxic", fold.alias("fold"), F.col("text").cast("binary").alias("text"))

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for y, k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2)), strict=True):
                words = {w.strip(_STRIP) for w in lowered(text).split()}
                seen.update((w, y, k) for w in words if 3 <= len(w) <= 48 and w.decode("utf-8", "replace").isalpha())
        at = list(seen.items())
        for i in range(0, len(at), 10_000):
            part = at[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([x[0][0] for x in part], pa.binary()), pa.array([x[0][1] for x in part], pa.int32()), pa.array([x[0][2] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int64())], names=["word", "toxic", "fold", "n"])

    found = rows.select("toxic", "fold", "text").mapInArrow(count, "word binary, toxic int, fold int, n long")
    sizes = {(r.toxic, r.fold): r.n for r in rows.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}

    def among(toxic: int, but: int):
        return F.coalesce(F.sum(F.when((F.col("toxic") == toxic) & (F.col("fold") != but), F.col("n"))), F.lit(0))

    # For each fold a lexicon of the others, and one of all (of no fold but).
    choices = [*range(FOLDS), -1]
    counts = staged(found.groupBy("word").agg(*[among(y, k).alias(f"{'ab'[1 - y]}{k + 1}") for k in choices for y in (0, 1)]))

    def lexicon(but: int) -> dict[bytes, float]:
        some, none = (sum(n for (y, k), n in sizes.items() if y == t and k != but) for t in (1, 0))
        a, b = F.col(f"a{but + 1}"), F.col(f"b{but + 1}")
        odds = F.log((a + 0.5) / (some + 1.0)) - F.log((b + 0.5) / (none + 1.0))
        # How far apart the shares of the classes are, in standard errors.
        spread = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        told = counts.select("word", odds.alias("odds"), spread.alias("spread")).where((a >= 3) & (odds > 1.0) & (spread > 3.0))
        learned = told.orderBy(F.desc("spread"), "word").limit(lexicon_words).collect()
        return {w.encode(): PRIOR for w in INSULTS} | {bytes(r.word): float(r.odds) for r in learned}

    lexicons = [lexicon(k) for k in choices]

    def run(batches):
        for b in batches:
            texts = as_bytes(b.column(3))
            x = np.concatenate([features(texts, words) for words in lexicons], 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "toxic", "fold", "x"])

    got = rows.mapInArrow(run, "doc_id long, toxic int, fold int, x array<double>").toArrow().sort_by("doc_id")
    x, y, of = np.array(got["x"].to_pylist()).reshape(-1, len(choices), len(FEATURES)), np.array(got["toxic"].to_pylist(), float), np.array(got["fold"].to_pylist())
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        part = of != k
        if 0 < y[part].sum() < part.sum() and part.sum() < len(part):
            unseen[~part] = Trees().fit(x[part, k], y[part]).predict(x[~part, k])
    return Model(lexicons[-1], Trees().fit(x[:, -1], y), isotonic(unseen, y), bad / (bad + good))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs(key..., text) -> (key..., score)."""
    spark = docs.sparkSession
    tune(spark)
    *keys, text = docs.columns
    docs = docs.select(*keys, F.col(text).cast("binary").alias(text))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            if b.num_rows:
                s = sent.value.score(as_bytes(b.column(len(keys))))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s)], names=[*keys, "score"])
        trim()

    return docs.mapInArrow(run, docs.drop(text).withColumn("score", F.lit(0.0)).schema)


def held_out(key: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def reject(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Documents that score below the threshold, as they came in."""
    names = docs.columns
    model = fit(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), labels.where(~held_out()))
    scored = score(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").alias("text")), model)
    return scored.where(F.col("score") < threshold).select("row.*")
