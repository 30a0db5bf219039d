"""The audit of filters against every order run document by document."""

from stemma.llm import audit

PLAIN = " ".join(f"word{i}" for i in range(220))
DOCS = [
    (0, PLAIN, "a"), (1, PLAIN, "b"), (2, None, "a"), (3, "", None), (4, " \t\n", ""), (5, PLAIN + " #", "a"), (6, PLAIN.upper(), "a"), (7, "one two " * 300, "b"), (8, "One $ one", "b"), (None, PLAIN, "a"), (None, "lone", "c"),
    (9, "lone", "c"), (9, "lone", "c"), (9, "lone", "d"), (10, "lone", "c"), (1, PLAIN, "b"), (11, "É\x0bé\x0cÉ x " * 90, "d"), (12, "x " * 200000, "d"), (0, PLAIN + "\x85", "a"),
]
LABELS = [(0, 1, 0), (0, None, 1), (1, 0, 1), (5, 1, None), (6, 1, 1), (8, None, None), (9, 1, 1), (9, 1, 1), (None, 1, 1), (77, 1, 1), (12, 1, 0)]
COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def _run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, part string").repartition(5)
    return audit.interactions(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_every_order(spark):
    got = _run(spark, DOCS, LABELS)
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in got.collect()]
    want = audit.brute_force(DOCS, LABELS)
    assert len(rows) == len(want) == 600 * 5 and set(rows) == want


def test_totals_do_not_depend_on_the_order(spark):
    rows = _run(spark, DOCS, LABELS).collect()
    for part in {r.part for r in rows}:
        last = {(r.kept, sum(x.removed for x in rows if x.part == part and x.filter_order == r.filter_order)) for r in rows if r.part == part and r.step == 5}
        assert len(last) == 1


def test_a_copied_text_of_a_third(spark):
    docs = [(i, PLAIN if i % 3 == 0 else PLAIN + f" {i}", "ab"[i % 2]) for i in range(300)]
    rows = {(r.part, r.filter_order, r.step): r for r in _run(spark, docs, []).collect()}
    assert rows["a", "EABCD", 1].removed == 49 and rows["b", "EABCD", 1].removed == 50


def test_empty_and_unlabelled(spark):
    assert _run(spark, [], LABELS).count() == 0
    rows = _run(spark, [(1, None, None)], []).collect()
    assert {r.part for r in rows} == {""} and len(rows) == 600 and {r.kept for r in rows if r.filter_order[0] == "A"} == {0}


def test_columns_of_any_name(spark):
    d = spark.createDataFrame([(1, "x", "p", 5, "q", True)], "doc_id long, text string, part string, n int, digest string, A boolean")
    got = audit.interactions(d, spark.createDataFrame([(1, 1, 1, "z")], "doc_id long, quality int, toxic int, part string"))
    assert got.columns == COLUMNS and got.where("step = 1 and filter_order = 'ABCDE' and good_lost = 1").count() == 1
