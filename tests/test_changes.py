"""Change feeds and facets against their definitions."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from versegrid.operators import changes
from versegrid.operators.facets import facets

ROW = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", ""]), st.sampled_from([None, "a", "b"]), st.sampled_from([None, 0.0, -0.0, 1.5]))
SCHEMA = "k int, a string, b string, x double"


@given(st.lists(ROW, max_size=7), st.lists(ROW, max_size=7))
@settings(max_examples=12, deadline=None)
def test_feed_turns_one_state_into_the_other(spark, old, new):
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).select("x", "b", "a", "k")
    told = changes.feed(a, b, ["k"])
    got = told.collect()
    bag = lambda rows, k: Counter(r for r in rows if r[0] == k)
    for k in {r[0] for r in old + new}:
        before, after, ops = bag(old, k), bag(new, k), [r.op for r in got if r.k == k]
        want = [] if before == after else ["delete"] if not after else ["update" if before else "insert"] * sum(after.values())
        assert ops == want, (k, before, after)
    for _ in range(2):
        a = changes.applied(a, told, ["k"])
        assert Counter(map(tuple, a.select("k", "a", "b", "x").collect())) == Counter(new)


def test_several_keys_and_clashing_names(spark):
    old = spark.createDataFrame([(1, "a", 5, "x"), (1, "b", 5, "x")], "k int, j string, n int, op_ string")
    new = spark.createDataFrame([(1, "a", 6, "x"), (2, "b", 5, "x")], "k int, j string, n int, op_ string")
    assert sorted(map(tuple, changes.feed(old, new, ["k", "j"]).collect())) == [("delete", 1, "b", None, None), ("insert", 2, "b", 5, "x"), ("update", 1, "a", 6, "x")]


def test_facets(spark):
    works = spark.createDataFrame([(1, "A", "P"), (2, None, ""), (3, "A", None), (4, "C", "P")], "id bigint, author string, category string")
    refs = spark.createDataFrame([(1, "Romans", "romans", 8), (1, "Romans", "romans", 2), (1, "Genesis", "genesis", 1), (2, "Romans", "romans", 8), (9, "Jude", "jude", 1)], "manuscript_id bigint, book string, book_slug string, chapter int")
    rows = facets(refs, works, ["P"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The join of references with works deals both sides, or none; the groupings take one exchange.
    assert plan.count("Exchange hashpartitioning") <= 3 and "Expand" in plan
    got = {(r.facet, r.author or r.category or r.book or r.chapter, r.id): (r.n, r.n_chosen, r.works, r.first_slug, r.first_chapter) for r in rows.collect()}
    assert got == {
        ("author", "A", None): (3, 3, 2, "genesis", 1), ("author", "Unknown", None): (1, 0, 1, "romans", 8), ("author", "C", None): (0, 0, 1, None, None),
        ("category", "P", None): (3, 3, 2, "genesis", 1), ("category", "Other", None): (1, 0, 2, "romans", 8),
        ("work_book", "Romans", 1): (2, 2, 0, "romans", 2), ("work_book", "Genesis", 1): (1, 1, 0, "genesis", 1), ("work_book", "Romans", 2): (1, 0, 0, "romans", 8),
        ("chapter", 8, None): (2, 1, 0, "romans", 8), ("chapter", 2, None): (1, 1, 0, "romans", 2), ("chapter", 1, None): (1, 1, 0, "genesis", 1), ("all", None, None): (4, 3, 4, "genesis", 1),
    }
    assert facets(refs.limit(0), works.limit(0), []).where("n > 0").count() == 0
    assert {r.n_chosen for r in facets(refs, works, []).collect()} == {0}
