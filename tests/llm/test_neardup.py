"""Near duplicates against all pairs."""

import random
from itertools import combinations

from assayer.llm import neardup
from assayer.llm.components import components


def brute(rows, words, percent):
    sets = {}
    for key, text in rows:
        own = (text or "").encode().lower().split()
        k = min(words, len(own)) or 1
        sets[key] = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def edited(source, words, edits):
    own = list(words)
    for _ in range(edits):
        own[source.randrange(len(own))] = source.choice("abcdefghij") + str(source.randrange(50))
    return " ".join(own)


def test_against_all_pairs(spark, monkeypatch):
    source = random.Random(1)
    rows = []
    # Groups with more and more edits, whose members link in part only.
    for group in range(5):
        base = [f"w{source.randrange(900)}" for _ in range(80)]
        rows += [edited(source, base, source.randrange(9)) for _ in range(30 if group else 90)]
    rows = list(enumerate(rows)) + [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 4, 80)
    found = neardup.near_duplicates(docs, 4, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_documents(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[2].component_id == 1 and not by_id[2].kept and by_id[1].kept
    assert all(by_id[k].n_shingles == 0 and by_id[k].kept for k in (3, 4, 5))
    assert by_id[6].n_shingles == 1
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "x y"), (3, "x z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS place")
    kept = neardup.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 3]
    # Both texts of id 3 stay: sharing an id does not make rows copies.


def test_only_texts_decide_what_stays(spark):
    """Rows that share an id or have none are compared like all others."""
    words = [f"w{i}" for i in range(60)]
    one, two, near = " ".join(words[:30]), " ".join(words[30:]), " ".join([*words[:29], "other"])
    rows = [(1, one, 1), (1, two, 2), (None, one, 3), (None, two, 4), (None, None, 5), (2, near, 6)]
    rows += [(3, two, 7), (3, two, 8), (4, "", 9), (4, "", 10), (None, "alone among all these words", 11)]
    rows += [(None, "alone among all these words", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    kept = sorted(r.key for r in neardup.one_of_each(docs).collect())
    assert kept[:2] == [1, 2] and kept[2:-1] == [5, 9, 10] and kept[-1] in (11, 12) and len(kept) == 6
    assert neardup.one_of_each(docs).columns == docs.columns
    assert neardup.one_of_each(docs.filter("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, k) for k in range(6, 40)] + [(3, 3)]
    found = components(spark.createDataFrame([*links, (None, 4)], "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(100, 141), 100),
        **dict.fromkeys(range(5, 40), 5),
    }
