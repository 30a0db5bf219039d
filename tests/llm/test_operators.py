"""Corpus operators against brute force, on small fixtures with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

random.seed(3)
WORDS = "the of and to in alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


LONG = prose(9000, 1)
PASSAGE = prose(40, 99)
TEXTS = [
    (0, prose(60, 2)), (1, None), (2, ""), (3, "   \n"), (4, prose(30, 4) + " " + PASSAGE + " " + prose(30, 5)), (5, PASSAGE), (6, prose(60, 2)), (7, prose(60, 2) + " tail"), (8, LONG), (9, LONG[:40000] + " x"), (10, "a" * 300),
    (11, "a" * 260), (12, "Élan où ça öß " * 8), (13, "É" * 49), (14, "one two"), (15, "It's WE'LL they're  \n\n ok<|endoftext|>一二三"), (16, PASSAGE[20:] + " " + prose(50, 7)), (17, prose(60, 2)), (18, "you idiot moron, you id1ot!!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# --- decontamination ----------------------------------------------------------
ITEMS = [(1, PASSAGE), (2, "one two"), (3, None), (None, PASSAGE), (4, ""), (5, prose(60, 2)), (1, PASSAGE), (1, "alpha beta gamma"), (6, " ".join(PASSAGE.split()[5:17]))]


@pytest.mark.parametrize(("limit", "share"), [(100_000, 2000), (60, 2000), (60, 1), (4, 2)])
def test_decontamination(spark, docs, monkeypatch, limit, share):
    from stemma.llm import decontaminate as D

    monkeypatch.setattr(D, "SHARE", share)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r for r in D.digest(D.contamination(docs, items, automaton_words=limit), "doc_id").collect()}
    assert len(got) == len(TEXTS)
    for i, t in TEXTS:
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == D.brute_force(t, ITEMS), i
        assert r.contaminated == (r.n_hit > 0)


def test_decontamination_random():
    from stemma.llm.decontaminate import WindowAutomaton, _merge, brute_force, words

    r = random.Random(5)
    for k in range(200):
        letters = "ab" if k % 2 else "abcd"
        items = [(j, " ".join(r.choice(letters) for _ in range(r.randint(0, 9)))) for j in range(4)]
        a = WindowAutomaton([(str(j), words(t.encode())) for j, t in items], 4)
        text = " ".join(r.choice(letters + "z") for _ in range(30))
        ((n, spans, ids),) = a.scan([text.encode()])
        want = brute_force(text, items, 4)
        assert (n, sum(y - x for x, y in _merge(spans)), len(ids)) == want[:3], (items, text)


def test_decontaminate_keeps_columns(spark, docs):
    from stemma.llm.decontaminate import decontaminate

    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    more = docs.withColumn("n_words", F.lit("mine")).withColumn("spans", F.lit(1))
    out = decontaminate(more, items, max_coverage=0.8)
    assert out.columns == more.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert 5 not in got and PASSAGE[:60] not in got[4] and got[0] == TEXTS[0][1] and got[1] is None
    assert got[4].split() == (prose(30, 4) + " " + prose(30, 5)).split()


def test_decontamination_beside_columns_of_any_name(spark, docs):
    from stemma.llm import decontaminate as D

    items = spark.createDataFrame([(1, TEXTS[0][1])], "item_id long, text string")
    odd = docs.select("doc_id", F.lit("r").alias("row"), F.lit("s").alias("spans"), F.lit("i").alias("items"), F.lit(1).alias("n_words"), F.lit("m").alias("maybe"), "text")
    for limit in (100_000, 4):
        got = D.contamination(odd, items, 10, limit)
        assert got.columns == ["doc_id", "row", "maybe", "text", "n_words", "spans", "items"]
        assert {r.row + r.maybe for r in got.collect()} == {"rm"}


def test_decontamination_empty(spark, docs, none):
    from stemma.llm import decontaminate as D

    items = spark.createDataFrame([], "item_id long, text string")
    assert D.digest(D.contamination(docs, items), "doc_id").where("contaminated").count() == 0
    assert D.contamination(none, items).count() == 0


# --- url filter ------------------------------------------------------------------
def test_url_filter(spark):
    from stemma.llm.urlfilter import as_of, intervals

    day = 86400
    log = [("a", "x.example.com", 10 * day, True), ("a", "x.example.com", 50 * day, False), ("a", "x.example.com", 50 * day, False), ("b", "example.com", 20 * day, True), ("a", "y.org/p/q", 5 * day, True), ("a", "y.org/p/q", 5 * day, False), (None, "z", 1, True), ("a", None, 1, True), ("c", "z.net", 3 * day, False)]
    spans = intervals(spark.createDataFrame(log, "list string, key string, at long, added boolean"))
    assert spans.count() == 3
    caps = [(1, "http://x.example.com/", 9 * day), (2, "http://X.Example.com:80/a", 10 * day), (3, "http://x.example.com/", 50 * day), (4, "https://u@y.org/p/q/r?x#y", 400 * day), (5, None, 5), (6, "http://y.org/p", 6 * day), (7, "http://x.example.com/", None), (2, "http://X.Example.com:80/a", 10 * day), (8, "nonsense", 1)]
    got = as_of(spark.createDataFrame(caps, "id long, url string, fetched long"), spans).collect()
    seen = {r.id: (r.n_entries, r.lists, r.entry, r.blocked) for r in got}
    assert len(got) == len(caps)
    assert seen == {1: (0, "", None, False), 2: (1, "a", "x.example.com", True), 3: (1, "b", "example.com", True), 4: (1, "a", "y.org/p/q", True), 5: (0, "", None, False), 6: (0, "", None, False), 7: (0, "", None, False), 8: (0, "", None, False)}


def test_url_filter_times_far_out(spark):
    """One capture in milliseconds and one before all time cost a stretch each, not all those between."""
    from stemma.llm.urlfilter import as_of, intervals

    day = 86400
    spans = intervals(spark.createDataFrame([("a", "x.org", 10 * day, True), ("b", "x.org", 1 << 61, True), ("c", "x.org", -(1 << 40), True), ("c", "x.org", 0, False)], "list string, key string, at long, added boolean"))
    caps = [(1, "http://x.org/", 1_700_000_000_000, 0), (2, "http://x.org/", -(1 << 39), 0), (3, "http://x.org/", 11 * day, 0), (4, "http://x.org/", 1 << 62, 0)]
    got = {r.id: r.lists for r in as_of(spark.createDataFrame(caps, "id long, url string, fetched long, stretch int"), spans).collect()}
    assert got == {1: "a", 2: "c", 3: "a", 4: "a,b"}


def test_url_filter_empty(spark):
    from stemma.llm.urlfilter import as_of, intervals

    spans = intervals(spark.createDataFrame([], "list string, key string, at long, added boolean"))
    caps = spark.createDataFrame([(1, "http://a.b/", 5)], "id long, url string, fetched long")
    assert as_of(caps, spans).first()["blocked"] is False
    assert as_of(caps.limit(0), spans).count() == 0


# --- tokenizers -------------------------------------------------------------------
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    from stemma.llm.tokens import Encoder

    r = random.Random(1)
    sets = ["abcXYZéßÄ'' ''  \n\t\x85\xa0\x1c12²½ .,!?-_<|>#stremvldİ一́İſŁ", "abXéÄ'' '' \n\t\x85\xa012² .,stremvld"]
    texts = ["".join(r.choice(r.choice(sets)) for _ in range(r.randint(0, 40))) for _ in range(3000)] + [t or "" for _, t in TEXTS]
    raw = [t.encode() for t in texts]
    e = Encoder(name)
    ids, at = e.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    for i, x in enumerate(fresh(name).encode_batch(texts, add_special_tokens=False)):
        assert x.ids == ids[at[i] : at[i + 1]].tolist(), texts[i]


def fresh(name):
    """The library as it loads the file."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def library_ids(name, texts, end):
    return [np.array(x.ids + [end], "<u4") for x in fresh(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "a<|endoftext|>", "<|endoftext|> b", "<|endoftext|><|endoftext|>", "x <|endoftext|>\n<|startoftext|> y", "<|endoftext|", "<|endof text|>", "<|ENDOFTEXT|>", "hello <|endoftext|> world", "<<|endoftext|>>", "é<|endoftext|>一"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_strings_of_special_tokens(name):
    from stemma.llm.tokens import Encoder

    raw = [t.encode() for t in SPECIAL]
    ids, at = Encoder(name).encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [x.ids for x in fresh(name).encode_batch(SPECIAL, add_special_tokens=False)]
    assert any(x[-1] > 49000 for x in got if x)


def test_special_tokens_through_queries(spark):
    from stemma.llm.grammar import round_trip
    from stemma.llm.packing import Capacity, pack

    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    want = [(i, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(library_ids("byte_bpe_50k.json", SPECIAL, 2))]
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in round_trip(docs).orderBy("doc_id").collect()] == want
    want = [(i, len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(library_ids("word_bpe_49k.json", SPECIAL, 0))]
    assert [(r.doc_id, r.length, r.ids_crc32) for r in pack(docs, Capacity(tokens=2048)).orderBy("doc_id").collect()] == want


def test_shards(spark, docs, none):
    from stemma.llm.grammar import round_trip

    rows = [*TEXTS, (None, "x"), (4, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(round_trip(df).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    at = 0
    for r, (i, _), ids in zip(got, order, library_ids("byte_bpe_50k.json", [t for _, t in order], 2), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert round_trip(none).count() == 0


def test_grammar_round_trip():
    from stemma.llm import grammar as G

    r = np.random.default_rng(0)
    for _ in range(150):
        x = r.integers(0, r.integers(1, 4) + 1, r.integers(0, 300)).astype(np.uint32)
        s, rules, first = G.compress(x, r.choice([0.0, 0.03, 1.0]))
        assert (G.expand(s, *G.expansions(rules, first)) == x).all()
    x = np.tile(r.integers(0, 50, 500), 40).astype(np.uint32)
    shard = G.Shard(G.write_body(x, np.array([len(x)])))
    assert len(shard.symbols) < len(x) / 8
    for a, b in ((0, 1), (4095, 4200), (100, 19999), (5, 5)):
        assert (shard.ids(a, b) == x[a:b]).all()
    with pytest.raises(ValueError):
        G.Shard(b"RPG2" + bytes(60))


def test_grammar_goes_on_to_the_end():
    """No pair is left that stands in more than three places that do not overlap."""
    from stemma.llm import grammar as G

    r = np.random.default_rng(5)
    for kinds, n in ((3, 5000), (40, 30_000), (2000, 60_000)):
        ids = np.concatenate([r.integers(0, kinds, n), np.tile(r.integers(0, kinds, 90), 40), np.full(300, 1)]).astype(np.uint32)
        symbols, rules, first = G.compress(ids)
        assert (G.expand(symbols, *G.expansions(rules, first)) == ids).all()
        last, places = {}, {}
        for i, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)):
            if last.get(pair, -2) < i - 1:
                last[pair] = i
                places[pair] = places.get(pair, 0) + 1
        assert max(places.values()) <= 3, max(places.values())


# --- suffixes ----------------------------------------------------------------------
def test_suffixes(spark, docs, none):
    from stemma.llm import suffixes as S

    got = {r.doc_id: tuple(r)[1:] for r in S.digest(S.repeats(docs)).collect()}
    for (i, _), want in zip(TEXTS, S.brute_force(TEXTS), strict=True):
        assert got[i] == want, i
    assert S.repeats(none).count() == 0


def test_suffixes_hard_cases(spark):
    from stemma.llm import suffixes as S

    r = random.Random(8)
    base = "".join(r.choice("abcdefgh ") for _ in range(4000))
    rows = []
    for i in range(60):
        a = r.randrange(3500)
        cut = list(base[a : a + r.randint(20, 400)])
        for _ in range(r.randint(0, 4)):
            cut[r.randrange(len(cut))] = r.choice("XYZ")
        rows.append((r.randint(0, 40), "".join(cut) + ("".join(r.choice("ab") for _ in range(r.randint(0, 90))))))
    rows += [(None, base[:200]), (3, "ab" * 100), (4, "ab" * 80), (4, "ab" * 80), (5, "a\0b" * 40), (6, "a\0b" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    key = lambda t: (-1 if t[0] is None else t[0], *t[1:])
    got = sorted((tuple(x) for x in S.digest(S.repeats(df)).collect()), key=key)
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, S.brute_force(rows), strict=True)), key=key)


def test_suffixes_beside_columns_of_any_name(spark, docs):
    from stemma.llm import suffixes as S

    names = ("doc", "row", "kind", "block", "route", "payload", "again", "more", "text2")
    odd = docs.select("*", *[F.lit(c).alias(c) for c in names], F.lit("x").alias("spans"), F.lit("y").alias("kept"))
    got = S.repeats(odd, 50)
    assert got.columns == ["doc_id", *names, "n_bytes", "n_removed", "spans", "kept"]
    assert {tuple(r) for r in S.digest(got).collect()} == {tuple(r) for r in S.digest(S.repeats(docs, 50)).collect()}
    assert {r.block for r in got.collect()} == {"block"}


def test_suffix_rows_follow_the_texts_and_not_the_partitions(spark, tmp_path, monkeypatch):
    from stemma.llm import suffixes as S

    docs = spark.createDataFrame([(i, prose(80, i % 150)) for i in range(300)], "doc_id long, text string")
    counted, plain = [], S.staged

    def counting(df, *more):
        out = plain(df, *more)
        counted[-1] += out.count()
        return out

    monkeypatch.setattr(S, "staged", counting)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (8, 211):
        counted.append(0)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            S.repeats(docs.repartition(8), 50).count()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert counted[1] <= 1.5 * counted[0]


@pytest.mark.parametrize("hot", [0, 3, 10**9])
def test_suffixes_of_common_strings(spark, monkeypatch, hot):
    """One string of 16 bytes amid very many others, whose suffixes are dealt by more than it."""
    from stemma.llm import suffixes as S

    for name, value in (("HOT", hot), ("BLOCK", 1 << 12), ("BUCKET", 1 << 11)):
        monkeypatch.setattr(S, name, value)
    r = random.Random(4)
    common, texts = "0123456789abcdef0123456789abcdef", []
    for _ in range(150):
        around = ["".join(r.choice("xyzw") for _ in range(60)) for _ in range(2)]
        texts.append(around[0] + common + around[1])
    for _ in range(150):
        a, b = r.choice(texts), r.choice(texts)
        k, j = r.randint(0, 60), r.randint(92, 152)
        texts.append(a[k : k + 30] + a[k + 30 : j] + b[: r.randint(0, 90)])
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {tuple(x) for x in S.digest(S.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 50)).collect()}
    assert got == {(i, *w) for (i, _), w in zip(rows, S.brute_force(rows, 50), strict=True)}


def test_merge_runs():
    from stemma.llm.suffixes import front_code, merge_runs

    r = random.Random(2)
    for _ in range(100):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(1, 8))) for _ in range(r.randint(0, 9))) for _ in range(r.randint(1, 6))]
        order, shared = merge_runs([(list(front_code(x)[0]), x) for x in runs])
        merged = [runs[i][j] for i, j in order]
        assert merged == sorted(x for run in runs for x in run)
        for k in range(1, len(merged)):
            a, b = merged[k - 1], merged[k]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert shared[k] == n


def test_suffix_stage_keeps_columns(spark, docs):
    from stemma.llm.suffixes import deduplicate

    more = docs.withColumn("kept", F.lit(1)).withColumn("row", F.lit("r"))
    out = deduplicate(more)
    assert out.columns == more.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == TEXTS[0][1] and got[6].text == "" and got[1].text is None and got[6].row == "r" and len(got) == len(TEXTS)


# --- packing -----------------------------------------------------------------------
def test_packing(spark, docs, none):
    from stemma.llm.packing import Capacity, pack

    got = sorted(pack(docs, Capacity(tokens=256)).collect())
    want = []
    for (i, _), ids in zip(TEXTS, library_ids("word_bpe_49k.json", [t for _, t in TEXTS], 0), strict=True):
        want += [(i, k, 256 * k, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // 256)) for p in [ids[256 * k : 256 * k + 256]]]
    assert [tuple(r)[:5] for r in got] == want
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1
    assert pack(none).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_plan_holds_every_capacity(score):
    from stemma.llm.packing import Capacity, plan

    r = random.Random(4)
    for _ in range(30):
        counts = {r.randint(1, 64): r.randint(1, 200) for _ in range(12)}
        rows = plan(counts, Capacity(64, 5, 2500 if max(counts) <= 50 else 4096), score)
        bins: dict[int, list[int]] = {}
        for length, rank, ranks, each, first, offset in rows:
            for k in range(ranks):
                bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
        assert sum(map(len, bins.values())) == sum(counts.values())
        for b in bins.values():
            at = 0
            for o, n in sorted(b):
                assert o == at
                at += n
            assert at <= 64 and len(b) <= 5 and sum(n * n for _, n in b) <= 4096


def test_production_packs_by_three_capacities(monkeypatch):
    import corpus_pipeline
    from stemma.llm import packing, queries

    given = []
    monkeypatch.setattr(packing, "pack", lambda docs, capacity: given.append(capacity))
    monkeypatch.setattr(corpus_pipeline, "pack", packing.pack)
    monkeypatch.setattr(queries, "_docs", lambda spark, sf_dir: None)
    queries.op5_pack(None, "")
    corpus_pipeline.packing(None, type("Docs", (), {"select": lambda self, *c: self})(), "")
    assert given == [packing.Capacity(2048, 2048, 2048 * 2048)] * 2


def test_plan_weighs_more_than_tokens():
    """With all three capacities a piece goes elsewhere than the bin with least room for tokens, and no more bins are used."""
    from stemma.llm import packing as P

    r = random.Random(12)
    differ = 0
    for _ in range(20):
        counts = {r.randint(1, 2048): r.randint(1, 9) for _ in range(60)}
        scalar, vector = (P.plan(counts, c) for c in (P.Capacity(2048), P.Capacity(2048, 2048, 2048 * 2048)))
        differ += scalar != vector
        used = [max(b + -(-n // each) for _, _, n, each, b, _ in rows) for rows in (scalar, vector)]
        assert used[1] <= used[0] + 1
    assert differ > 10


# --- simhash ------------------------------------------------------------------------
def test_simhash(spark, docs, none):
    from stemma.llm import simhash as S

    want = S.brute_force(dict(TEXTS))
    got = S.near_duplicates(docs).select("doc_id", S.hex_fingerprint().alias("f"), "component_id").collect()
    assert {r.doc_id: (r.f, r.component_id) for r in got} == want
    assert S.near_duplicates(none).count() == 0


@pytest.mark.parametrize("blocks", [0, 2, 4])
def test_anchors_find_all_links(spark, monkeypatch, blocks):
    from stemma.llm import simhash as S

    r = np.random.default_rng(blocks)
    seeds = r.integers(0, 1 << 62, 60)
    fps = {int(x) for x in seeds}
    for x in seeds.tolist():
        for _ in range(12):
            y = x
            for b in r.integers(0, 63, r.integers(1, 5)).tolist():
                y ^= 1 << b
            fps.add(y)
    monkeypatch.setattr(S, "blocks_for", lambda n: blocks)
    monkeypatch.setattr(S, "HOT", 5)
    fps = sorted(fps)
    got = {r.node: r.root for r in S.connected_components(S.links(spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3))).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    assert all(got.get(x, x) == find(x) for x in fps)


def test_large_groups_link_without_pairs():
    from stemma.llm.simhash import _linked

    r = np.random.default_rng(1)
    fp = np.unique(r.integers(0, 1 << 12, 400))
    home = np.ones(len(fp), bool)
    home[::3] = False
    edges = _linked(np.zeros(len(fp), np.int64), home, fp, 3)
    assert sum(len(a) for a, _ in edges) <= 3 * len(fp)
    assert all(((int(x) ^ int(y)).bit_count() <= 3) for a, b in edges for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("leaders", [0, 2])
def test_near_copies_met_apart(spark, monkeypatch, leaders):
    """Copies of copies, few of them similar to a leader, whose shares meet in a grid."""
    from stemma.llm import shingles as S

    monkeypatch.setattr(S, "LEADERS", leaders)
    monkeypatch.setattr(S, "SHARE", 7)
    r = random.Random(21)
    texts, pool = {}, [prose(120, 70), prose(120, 71), prose(90, 72)]
    for i in range(160):
        words = r.choice(pool[-40:] + pool[:3]).split()
        for _ in range(r.randint(0, 5)):
            words[r.randrange(len(words))] = r.choice("alpha beta gamma delta eta".split()) + str(r.randint(0, 99))
        pool.append(" ".join(words))
        texts[i] = pool[-1]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in S.similar_groups(df).collect()}
    assert got == S.brute_force(texts) and 3 < len(set(got.values())) < 150


def test_near_copies_go_by_fingerprints_first(spark, monkeypatch):
    """With no round of bands at all, copies that differ in at most three bits are one group, others are not."""
    from stemma.llm import shingles as G
    from stemma.llm import simhash as S

    monkeypatch.setattr(G, "LEADERS", -1)
    texts = {}
    for i in range(60):
        words = prose(400, 600 + i // 6).split()
        if i % 6:
            words[i * 7 % 400] = f"w{i}"
        texts[i] = " ".join(words)
    fps = {i: S.fingerprint(t.encode(), 5) for i, t in texts.items()}
    want = {i: i for i in texts}
    for _ in texts:
        for i in texts:
            want[i] = min(want[j] for j in texts if (fps[i] ^ fps[j]).bit_count() <= 3)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in G.similar_groups(df).collect()}
    assert got == want and 10 <= len(set(want.values())) < 50


def test_keep_first(spark, docs):
    from stemma.llm.simhash import keep_first

    rows = docs.unionByName(docs.where("doc_id = 0")).withColumn("fp", F.lit("x"))
    got = [r.doc_id for r in keep_first(rows).collect()]
    assert sorted(got) == sorted(set(got)) and {0, 1, 2, 3, 4, 14} <= set(got) and not {6, 17} & set(got)


def test_near_copies_beyond_three_bits(spark):
    from stemma.llm import shingles as G
    from stemma.llm import simhash as S

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    r = random.Random(12)
    for k in range(40):  # one large group of near copies, some of which meet 0.8 only through others
        words = prose(120, 500).split()
        for _ in range(r.randint(0, 4)):
            words[r.randrange(120)] = f"w{r.randrange(999)}"
        texts[10_000 + k] = " ".join(words)
    texts |= {20_000: None, 20_001: "", 20_002: " \n", 20_003: "one two", 20_004: "One two", 20_005: "one two three"}
    want = G.brute_force(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.component_id for x in G.similar_groups(df).collect()} == want
    kept = {x.doc_id for x in S.keep_first(df).collect()}
    assert kept == {i for i, c in want.items() if i == c}
    assert not {145, 177} & kept and want[145] == 6 and want[177] == 1
    assert G.similar_groups(df.limit(0)).count() == 0


# --- html -----------------------------------------------------------------------------
def test_html(spark):
    from stemma.llm.htmltext import extract, main_text

    para = "A long enough paragraph of prose with several words in it, &amp; a sign. " * 3
    page = f"""<html><head><title>T</title><style>x</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies. {para}</p></div>
      <article><h1>Head&nbsp;line</h1><p>{para}<p><b>Short.<br>two</p><ul><li>one<li>two</ul><div class="share">Share</div><form>Name</form></article><aside><p>{para}</p></aside>
      <section id="comments"><p>Reader: {para}</p></section><script>var a = "</p>";</script><footer>Foot {para}</footer></body>"""
    flat = " ".join(para.replace("&amp;", "&").split())
    assert main_text(page).split("\n") == ["Head line", flat, "Short. two", "one", "two"]
    plain = f"<body><div id=menu><a>a</a></div><div><h2>Title</h2><p>{para}</p><p>Ok.</p><p>{para}</p></div><div class='ad'>{para}</div></body>"
    assert main_text(plain).split("\n") == ["Title", flat, "Ok.", flat]
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<p>"), (5, "x", "no tags"), (5, "x", "no tags")], "page_id long, url string, html string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract(df).collect())
    assert got[1:] == [(2, "", 0), (3, "", 0), (4, "", 0), (5, "no tags", 7), (5, "no tags", 7)]
    assert extract(df.limit(0)).count() == 0


def test_html_of_any_kind():
    import time

    from stemma.llm.htmltext import main_text

    assert main_text("<![foo[x]]>hello world") == "hello world"
    for odd in ("<!", "<![", "<!DOCTYPE", "<!x y>a", "<?php echo 1 ?>b", "<![CDATA[c]]>d", "</", "<a b='", "&#xFFFFFFFFFF;e", "<p><![if !IE]>f<![endif]>"):
        assert isinstance(main_text(odd), str)
    assert main_text("<article><p>The price of one.</p><div class='share-price'>A share cost ten.</div></article>") == "The price of one.\nA share cost ten."
    assert main_text("<div id='register-of-wrecks'><article><p>All hands were lost.</p></article></div><footer>x</footer>") == "All hands were lost."
    assert main_text("<div class='widget'><p>Only this page's whole text, in a box of that name.</p></div>") == "Only this page's whole text, in a box of that name."
    assert main_text("<main><h1>Title</h1><p>Lede</p><article><p>" + "Long words of prose here. " * 20 + "</p></article></main>").startswith("Title\nLede\nLong")
    long, short = "Words of the first story. " * 12, "Words of the second one. " * 8
    assert main_text(f"<article><p>{long}</p></article><article><p>{short}</p></article>") == f"{long.strip()}\n{short.strip()}"
    text = "Sentence of the story, long enough. " * 9
    for boiler in ("<div class='ad'>Buy this</div>", "<div class='related-posts'>See also</div>", "<div id='comments'><p>I disagree.</p></div>", "<div class='cookie-consent'>We use them</div>", "<ul class='share-buttons'><li>Tell</li></ul>"):
        assert main_text(f"<body><div><h1>Head</h1><p>{text}</p>{boiler}<p>{text}</p></div></body>") == f"Head\n{text.strip()}\n{text.strip()}"
    began = time.perf_counter()
    for many in ("<b>" * 200_000 + "</i>" * 200_000 + "x", "<div>" * 300_000 + "y", "<p><b>" * 100_000 + "z", "<ul><li><b>" * 50_000 + "</li><li>" * 50_000, "<table><tr><td>" * 50_000, "<article>" * 100_000 + "w"):
        main_text(many)
    assert time.perf_counter() - began < 60


def test_html_keeps_articles_of_any_wrapping():
    """An element or a name alone does not lose an article; boilerplate of the same kind goes."""
    from stemma.llm.htmltext import main_text

    p = "Words of the story, which are long enough to count. " * 8
    body = f"<h1>Head</h1><p>Lede</p><p>{p}</p>"
    want = f"Head\nLede\n{p.strip()}"
    boiler = "<nav><a href=/>Home</a></nav>"
    for page in (
        f"<form id=aspnet action=x>{boiler}<div>{body}</div><input name=a></form>", f"<form>{boiler}<article>{body}</article></form><footer>f</footer>", f"<dialog open>{body}</dialog>", f"<div role=form>{body}</div>",
        f"<div id=page><header><h1>Head</h1><p>Lede</p></header><div><p>{p}</p></div></div>", f"{boiler}<article>{body}<form>Your name <input></form><dialog>Log in</dialog></article>",
    ):
        assert main_text(f"<body>{page}</body>") == want, page
    for kept in ("<p class='cookies'>Bake them.</p>", "<div class='ministers-comments'>He said so.</div>", "<div class='subscription-history'>It began then.</div>", "<div id='sponsored-study'>It found none.</div>"):
        assert main_text(f"<article>{body}{kept}</article>").startswith(want + "\n")
    for gone in ("<div class='reader-comments'>I disagree.</div>", "<div id='comments'>No.</div>", "<div class='newsletter-signup'>Join</div>", "<div class='cookie-banner'>We use</div>", "<section class='user-comments'>No!</section>", "<div class='sponsored'>Buy</div>"):
        assert main_text(f"<body><header><h1>Site</h1></header><article>{body}{gone}</article></body>") == want, gone
    assert main_text(f"<body><header><h1>Site</h1></header><div>{body}</div></body>") == want
    # A paragraph ends where a block begins, however many elements of text are open in it.
    assert main_text("<article><p>" + "<i>" * 12 + "one<div>two</div></article>") == "one\ntwo"


def test_html_precision_and_recall(spark):
    """On pages whose article is marked: its words, by a pattern of its own, against those taken."""
    import html
    import re
    from collections import Counter

    from stemma.llm.htmltext import extract

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    raw = {r.page_id: r.html for r in pages.collect()}
    hit = wanted = taken = 0
    for r in extract(pages).collect():
        body = re.search(r"<article\b[^>]*>(.*)</article>", raw[r.page_id] or "", re.S)
        if body:
            inner = re.sub(r"<(script|style|aside|nav|form|footer)\b.*?</\1>|<!--.*?-->", " ", body[1], flags=re.S)
            want, got = Counter(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()), Counter(r.text.split())
            hit, wanted, taken = hit + (want & got).total(), wanted + want.total(), taken + got.total()
    assert wanted > 10_000 and hit >= 0.99 * wanted and hit >= 0.99 * taken, (hit, wanted, taken)


def test_html_columns(spark):
    from stemma.llm.htmltext import extract

    df = spark.createDataFrame([(1, "u", "<p>a  b</p>", "t", 5), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in extract(df).orderBy("page_id").collect()] == [(None, None, "", 0), (1, "u", "a b", 3)]


# --- language model --------------------------------------------------------------------
def test_runs_of_many_words_and_buckets(monkeypatch):
    """More buckets and words than one 64-bit key holds: the same pairs and triples are sent."""
    from collections import Counter

    import pyarrow as pa
    from pyspark import TaskContext

    from stemma.llm import hpylm as H
    from stemma.llm.common import unpack

    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    r = random.Random(6)
    texts = [" ".join(f"w{r.randrange(200_000)}" for _ in range(6000)) for _ in range(30)] + ["one two one two one two"]
    batch = pa.record_batch({"text": pa.array(texts), "learn": pa.array([i % 3 > 0 for i in range(31)])})
    run = H.Run(batch.column(0))
    h, learn = run.h.tolist(), [i % 3 > 0 for i in range(31)]
    pairs, triples = Counter(), Counter()
    for u, v, w, d in zip(run.two.tolist(), run.one.tolist(), run.word.tolist(), run.doc.tolist(), strict=True):
        pairs[h[v], h[w]] += learn[d]
        triples[h[u] >> 16, h[v], h[w], d, learn[d]] += 1
    for buckets in (8, 1 << 30):
        dealer = H.Dealer(np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), buckets)
        got = Counter()
        for b in H._send_pairs(dealer)([batch]):
            for route, body in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                heads, few, words, x = H._parts(body)
                x, words = unpack(x, H._PAIR), H._hashes(words)
                for v, w, n in zip(np.repeat(H._hashes(heads), unpack(few, H._FEW)["n"]).tolist(), words[x["w"]].tolist(), x["n"].tolist(), strict=True):
                    got[v, w] += n
        assert got == pairs
        got = Counter()
        for wave in range(H.WAVES):
            for b in H._send_triples(dealer, [], wave)([batch]):
                for kind, body in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    if kind == 1:
                        _, heads, few, words, before, x = H._parts(body)
                        x = unpack(x, H._TRIPLE)
                        for v, u, w, d in zip(np.repeat(H._hashes(heads), unpack(few, H._FEW)["n"]).tolist(), H._hashes(before)[x["u"]].tolist(), H._hashes(words)[x["w"]].tolist(), x["doc"].tolist(), strict=True):
                            got[u, v, w, d >> 1, bool(d & 1)] += 1
        assert got == triples
        bits, low = len(run.h).bit_length(), (len(run.word) - 1).bit_length()
        assert (bits + low + buckets.bit_length() > 64) == (buckets > 8)


def test_rows_are_packed_by_strided_copies():
    """Frames are what they were; laying bytes together costs a few copies, not a step for each byte."""
    import time

    import zstandard

    from stemma.llm.common import pack, unpack

    for kind in ([("h", "<u8")], [("u", "<u4"), ("w", "<u4"), ("doc", "<u4")], [("doc", "<u4"), ("base", "<f8")]):
        kind = np.dtype(kind)
        for n in (0, 1, 1000):
            x = np.frombuffer(random.Random(n).randbytes(n * kind.itemsize), kind)
            raw = b"".join(np.ascontiguousarray(x[f]).view(np.uint8).reshape(n, x.dtype[f].itemsize).T.tobytes() for f in kind.names)
            assert pack(x) == zstandard.compress(n.to_bytes(8, "little") + raw, 1)
            assert unpack(pack(x), kind).tobytes() == x.tobytes()
        assert unpack(pack(x[::3]), kind).tobytes() == x[::3].tobytes()

    def seconds(f, *args):
        spent = []
        for _ in range(5):
            start = time.process_time()
            f(*args)
            spent.append(time.process_time() - start)
        return min(spent)

    x = np.zeros(1 << 20, [("h", "<u8")])
    assert seconds(pack, x) < 8 * seconds(np.ascontiguousarray, x.view(np.uint8).reshape(-1, 8).T)


def test_language_model(spark, docs, none):
    from collections import Counter

    from stemma.llm import hpylm as H

    rows = TEXTS + [(100 + i, prose(80, 1000 + i)) for i in range(60)] + [(None, "alpha beta")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tok = [H.words_of((t or "").encode()) + [b""] for _, t in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(w for h, ws in zip(held, tok, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in H.score_corpus(df).collect()}
    assert len(got) == len(rows)
    better = 0.0
    for (i, _), h, ws in zip(rows, held, tok, strict=True):
        r = got[i]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert r.score < 0
        better += r.score - r.base_score if i and i >= 100 else 0
    assert better > 0
    assert H.score_corpus(none).count() == 0


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    from stemma.llm import hpylm as H

    df = spark.createDataFrame([*TEXTS, *((100 + i, prose(60, 2000 + i)) for i in range(80))], "doc_id long, text string")
    one, two = ({r.doc_id: r.score for r in H.score_corpus(df.repartition(k)).collect()} for k in (2, 8))
    assert one == pytest.approx(two, rel=1e-12)
    monkeypatch.setattr(H, "BUCKET", 4096)
    monkeypatch.setattr(H, "HEAVY", 300)
    monkeypatch.setattr(H, "HEAVY_PAIR", 20)
    one, two = ({r.doc_id: r.score for r in H.score_corpus(df.repartition(k)).collect()} for k in (1, 5))
    assert one == pytest.approx(two, rel=1e-12) and all(math.isfinite(x) and x <= 0 for x in one.values())


def test_scores_do_not_depend_on_the_buckets(spark, monkeypatch):
    """Nor on which words' and pairs' restaurants are dealt to several."""
    from stemma.llm import hpylm as H

    df = spark.createDataFrame([*TEXTS, *((100 + i, prose(60, 2000 + i)) for i in range(80))], "doc_id long, text string")
    got = []
    for bucket, heavy, pair in ((H.BUCKET, H.HEAVY, H.HEAVY_PAIR), (4096, H.HEAVY, H.HEAVY_PAIR), (4096, 300, 20)):
        monkeypatch.setattr(H, "BUCKET", bucket)
        monkeypatch.setattr(H, "HEAVY", heavy)
        monkeypatch.setattr(H, "HEAVY_PAIR", pair)
        got.append({r.doc_id: r.score for r in H.score_corpus(df).collect()})
    assert got[1] == pytest.approx(got[0], rel=1e-9) and got[2] == pytest.approx(got[0], rel=1e-9)


def test_model_beats_its_base_on_held_out_texts(spark):
    from stemma.llm import hpylm as H

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = H.perplexity(H.score_corpus(docs).where("held_out")).first()
    assert r.perplexity < 0.2 * r.base_perplexity


def direct_sampler(train, test, rounds, seed=3):
    """Gibbs sampling customer by customer with every table kept, discounts from counts, strengths drawn from a grid: log10 of each test text."""
    r = random.Random(seed)
    kinds = len({w for t in train for w in t})
    rooms = [{}, {}, {}]  # by length of context: context -> word -> customers of each table
    hyper = [[0.5, 1.0] for _ in range(3)]

    def prob(ctx, w, k):
        if k < 0:
            return 1 / (kinds + 1)
        d, th = hyper[k]
        up = prob(ctx[1:], w, k - 1)
        room = rooms[k].get(ctx)
        if not room:
            return up
        c, t = sum(map(sum, room.values())), sum(map(len, room.values()))
        own = room.get(w, [])
        return (sum(own) - d * len(own) + (th + d * t) * up) / (th + c)

    def add(ctx, w, k):
        if k < 0:
            return
        d, th = hyper[k]
        room = rooms[k].setdefault(ctx, {})
        t = sum(map(len, room.values()))
        own = room.setdefault(w, [])
        weights = [n - d for n in own] + [(th + d * t) * prob(ctx[1:], w, k - 1)]
        i = r.choices(range(len(weights)), weights)[0]
        if i == len(own):
            own.append(1)
            add(ctx[1:], w, k - 1)
        else:
            own[i] += 1

    def drop(ctx, w, k):
        if k < 0:
            return
        own = rooms[k][ctx][w]
        i = r.choices(range(len(own)), own)[0]
        own[i] -= 1
        if not own[i]:
            own.pop(i)
            drop(ctx[1:], w, k - 1)
        if not own:
            del rooms[k][ctx][w]
        if not rooms[k][ctx]:
            del rooms[k][ctx]

    def spots(t):
        line = ["^", "^", *t]
        return [((line[i], line[i + 1]), line[i + 2]) for i in range(len(t))]

    def fit_hyper():
        for k in range(3):
            sizes = [sum(own) for room in rooms[k].values() for own in room.values()]
            one, two = sizes.count(1), sizes.count(2)
            hyper[k][0] = min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5

            def fits(th, k=k):
                d, out = hyper[k][0], -th
                for room in rooms[k].values():
                    c, t = sum(map(sum, room.values())), sum(map(len, room.values()))
                    out += sum(math.log(th + d * i) for i in range(1, t)) - math.lgamma(th + c) + math.lgamma(th + 1)
                return out

            grid = [0.01 * 1.6**i for i in range(20)]
            w = [fits(x) + math.log(x) for x in grid]
            hyper[k][1] = r.choices(grid, [math.exp(x - max(w)) for x in w])[0]

    seen = [s for t in train for s in spots(t)]
    for ctx, w in seen:
        add(ctx, w, 2)
    total = [[0.0] * len(t) for t in test]
    kept = 0
    for k in range(rounds):
        for ctx, w in seen:
            drop(ctx, w, 2)
            add(ctx, w, 2)
        fit_hyper()
        if k >= rounds // 3:
            kept += 1
            for row, t in zip(total, test, strict=True):
                for i, (ctx, w) in enumerate(spots(t)):
                    row[i] += prob(ctx, w, 2)
    return [sum(math.log10(x / kept) for x in row) for row in total]


def test_scores_agree_with_a_direct_sampler(spark):
    from stemma.llm import hpylm as H

    rows = [(i, prose(50, 3000 + i % 40)) for i in range(60)]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tok = [[*t.lower().split(), ""] for _, t in rows]
    want = direct_sampler([t for t, h in zip(tok, held, strict=True) if not h], tok, 24)
    got = {r.doc_id: r for r in H.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    off = [got[i].score - w for (i, _), w in zip(rows, want, strict=True)]
    base = [got[i].base_score - w for (i, _), w in zip(rows, want, strict=True)]
    n = sum(map(len, tok))
    assert abs(sum(off)) < 0.03 * n and sum(map(abs, off)) < 0.1 * sum(map(abs, base))


def test_word_probabilities_sum_to_one():
    from stemma.llm import hpylm as H

    r = np.random.default_rng(1)
    c = np.array([5, 1, 0, 400, 2, 40, 0, 1], np.int64)
    base = np.array([0.1, 0.2, 0.05, 0.3, 0.1, 0.05, 0.1, 0.1])
    level = H.Restaurants(np.array([0, 0, 0, 0, 0, 1, 1, 1]), 2, np.arange(8).astype(np.uint64), 1.0)
    for k in range(3):
        t = level.reseat(c, H.constant(base), k, r)
        assert ((t >= np.minimum(c, 1)) & (t <= c)).all()
    p = level.predict(base)
    assert math.isclose(p[:5].sum(), 1 + (level.strength + level.discount * level.tables[0]) / (level.strength + 408) * (base[:5].sum() - 1))


def test_everyone_is_seated():
    from stemma.llm import hpylm as H

    c = np.array([1, 2, 31, 32, 33, 70, 71, 100, 500, 1000])
    t = H.seat(c, c, np.full(len(c), 1e12), H.constant(np.ones(len(c))), 0.5, 1.0, np.arange(len(c)).astype(np.uint64))
    assert t.tolist() == c.tolist()
    # The number of tables of many like dishes against that of seating them customer by customer, weighed by each step's chances.
    for n, others, base in ((6, 0, 0.3), (60, 0, 0.3), (60, 50, 0.2), (140, 0, 0.3), (140, 200, 0.1), (160, 500, 0.5), (160, 40, 0.01)):
        many = H.seat(np.full(20_000, n), np.ones(20_000), np.full(20_000, others), H.constant(np.full(20_000, base)), 0.6, 2.0, np.arange(20_000).astype(np.uint64))
        ways = H.stirling(0.6, n)[n, 1:]
        weight = ways + np.cumsum(np.log(2.0 + 0.6 * (others + np.arange(n)))) + np.arange(1, n + 1) * math.log(base)
        weight = np.exp(weight - weight.max())
        mean = (weight * np.arange(1, n + 1)).sum() / weight.sum()
        assert abs(many.mean() - mean) < (0.02 if n <= H.SMALL else 0.2) * mean, (n, others, base, many.mean(), mean)


def test_sizes_seated_together_draw_what_each_draws():
    """Every size once, in few calls; tables are those of the log weights of each size by itself."""
    from stemma.llm import hpylm as H

    assert [n for low, high in H._SIZES for n in range(low, high + 1)] == list(range(2, H.SMALL + 1)) and len(H._SIZES) < 32
    r = np.random.default_rng(4)
    c = r.integers(2, H.SMALL + 1, 4000)
    keys, others, base = np.arange(4000).astype(np.uint64), r.integers(0, 50, 4000), r.random(4000)
    got, ways = H.seat(c, c, others, H.constant(base), 0.6, 2.0, keys), H.stirling(0.6)
    for i, n in enumerate(c.tolist()):
        weight = np.cumsum(np.log(2.0 + 0.6 * (others[i] + np.arange(n)))) + np.arange(1, n + 1) * math.log(base[i]) + ways[n, 1 : n + 1]
        weight = np.cumsum(np.exp(weight - weight.max()))
        assert got[i] == 1 + (weight[:-1] < weight[-1] * H.uniform(keys[i : i + 1], n)).sum()


# --- toxicity ----------------------------------------------------------------------------
def test_toxicity(spark, none):
    from stemma.llm import toxicity as T

    r = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        words = prose(r.randint(20, 80), i).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["blarg", "idiot", "fnord"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (7, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = T.fit(df, lab.where(~T.held_out()))
    assert b"blarg" in model.lexicon and b"the" not in model.lexicon
    got = {x.doc_id: x.score for x in T.score(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= 0.7) == (i % 6 == 0) for i in held) > 0.97 * len(held)
    kept = T.reject(df.withColumn("score", F.lit("mine")), lab)
    assert kept.columns == ["doc_id", "text", "score"] and 5001 in {x.doc_id for x in kept.collect()}
    constant = T.fit(df, lab.limit(0))
    assert {x.score for x in T.score(df, constant).collect()} == {0.0}
    assert T.score(none, model).count() == 0


def test_stretched_insult_of_plain_letters_counts():
    from stemma.llm import toxicity as T

    hidden, near = T.FEATURES.index("hidden_hits"), T.FEATURES.index("hits_near_address")
    got = T.features([b"you stuuupid one", b"you stuuupid! one", b"you goooood one"], {b"stupid": 1.0})
    assert got[:, hidden].tolist() == [1, 1, 0] and got[:, near].tolist() == [1, 1, 0]


def test_isotonic():
    from stemma.llm.toxicity import isotonic

    r = np.random.default_rng(0)
    s = r.normal(size=500)
    x, y = isotonic(s, (r.random(500) < 1 / (1 + np.exp(-3 * s))).astype(float))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and 0 <= y[0] <= y[-1] <= 1


# --- media ---------------------------------------------------------------------------------
def test_media(spark, docs, none):
    from stemma.llm import mjpeg as M

    got = {r.doc_id: r for r in M.features(M.to_media(docs)).collect()}
    for i, t in TEXTS:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        media = M.store(raw)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[0].feature == got[6].feature and got[1].media_sha256 == got[2].media_sha256
    assert M.to_media(none).count() == 0
    shots = M.clips(M.to_media(docs.where("doc_id = 8")).select("doc_id", "media")).collect()
    assert shots[0].first_frame == 0 and shots[-1].end_s == (shots[-1].last_frame + 1) / 25


def test_shots():
    from stemma.llm.mjpeg import decode, histogram_distances, shots, store

    r = np.random.default_rng(3)
    dark, light = r.integers(0, 60, 576 * 30), r.integers(180, 255, 576 * 20)
    ((samples, rate),) = decode([store(np.concatenate([dark, light]).astype(np.uint8).tobytes())])
    assert shots(histogram_distances(samples)) == [(0, 29), (30, 49)] and rate == 25
    with pytest.raises(ValueError):
        decode([b"RIFF" + bytes(40)])


# --- columns beside those that an operator reads ---------------------------------
def test_columns_of_any_name_are_left_out(spark, docs):
    from stemma.llm import grammar, hpylm, mjpeg, packing

    odd = docs.select("*", *[F.lit("x").alias(c) for c in ("route", "kind", "part", "n_tokens", "learn", "media", "piece", "rank", "h", "c")])
    for run in (grammar.round_trip, packing.pack, hpylm.score_corpus, lambda d: mjpeg.features(mjpeg.to_media(d))):
        plain, more = run(docs), run(odd)
        assert plain.columns == more.columns
        drop = [c for c in plain.columns if c in ("sequence_id", "offset")]
        assert sorted(map(repr, plain.drop(*drop).collect())) == sorted(map(repr, more.drop(*drop).collect()))
