"""The grouped prefix join against all pairs."""

import random

import pytest

from stemma.llm import jaccard


def _texts():
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    out: list[tuple[int | None, str | None]] = []
    add = lambda w: out.append((len(out), " ".join(w)))
    # A family of near copies around the threshold, chains of edits, and copies.
    base = prose(120)
    for k in range(40):
        w = list(base)
        for _ in range(k % 6):
            w[r.randrange(len(w))] = r.choice(words)
        add(w)
    for _ in range(3):
        w = prose(80)
        for _ in range(8):
            add(w)
            w = list(w)
            w[r.randrange(len(w))] = r.choice(words)
            w[r.randrange(len(w))] = r.choice(words)
    # Strangers that share a passage, and sizes just apart.
    passage = prose(30)
    for k in range(30):
        add(prose(4 + k % 5) + passage + prose(k % 3))
    for _ in range(30):
        add(prose(r.randint(1, 60)))
    for n in (3, 4, 5, 20, 27, 28):
        add(["one"] + [f"x{k}" for k in range(n)])
        add(["one"] + [f"x{k}" for k in range(n)] + ["end"])
    add(["same"] * 500)
    add(["same"] * 9)
    add(prose(3) * 400)
    r.shuffle(out)
    out = [(k, t) for k, (_, t) in enumerate(out)]
    long = " ".join(prose(12000))
    out += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "A b"), (1004, "a  B\x0b"), (1005, "a b c d"), (1006, "A\tB C\nD"), (None, out[0][1]), (None, "lone words here and there"), (2, out[2][1]), (2, "other text of the same id"), (-5, out[9][1]), (1007, long), (1008, long + " and more"), (1009, "\x85  É"), (1010, "\x85  é")]
    return out


@pytest.mark.parametrize(("small", "leaders", "share"), [(4, 3, 2000), (1, 0, 3), (2, 1, 5)])
def test_against_all_pairs(spark, monkeypatch, small, leaders, share):
    for name, value in (("SMALL", small), ("LEADERS", leaders), ("SHARE", share)):
        monkeypatch.setattr(jaccard, name, value)
    texts = _texts()
    want = sorted(jaccard.brute_force(texts), key=str)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = jaccard.linked_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    sizes = {}
    for _, _, c in want:
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 20 and sum(v == 1 for v in sizes.values()) > 50


def test_thresholds_are_whole_numbers(spark):
    """17 of 20 shingles are 85 %, 16 of 19 are not."""
    words = [f"t{k}" for k in range(40)]
    texts = [(0, " ".join(words[:20])), (1, " ".join(words[:20] + ["a", "b", "c"])), (2, " ".join(words[20:39])), (3, " ".join(words[20:39] + ["a", "b", "c"]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {0: (17, 0), 1: (20, 0), 2: (16, 2), 3: (19, 3)}


def test_prefix_holds_a_common_shingle():
    for percent in (50, 80, 85, 100):
        for n in range(1, 60):
            for m in range(1, n + 1):
                if 100 * m >= percent * n:
                    # The least overlap of sets that are similar enough leaves too few others to fill a prefix.
                    least = next(o for o in range(m + 1) if 100 * o >= percent * (n + m - o))
                    assert n - least < jaccard.prefix_length(n, percent) and m - least < jaccard.prefix_length(m, percent)


def test_empty(spark):
    assert jaccard.linked_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = jaccard.linked_components(spark.createDataFrame([(7, None), (8, None)], "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(7, 0, 7), (8, 0, 8)]


def test_tables(spark):
    where = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text")
    want = sorted(jaccard.brute_force([tuple(r) for r in docs.collect()]))
    assert sorted(map(tuple, jaccard.linked_components(docs).collect())) == want
