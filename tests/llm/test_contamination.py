"""Seeds find every place the rule allows."""

import random

from assayer.llm import decontaminate


def test_substitutions_anywhere(spark):
    source = random.Random(6)
    word = lambda: f"w{source.randrange(10**6)}"
    item = [word() for _ in range(30)]
    docs, want = [], set()
    for i in range(120):
        cut = source.randrange(16)
        part = item[cut : cut + 15]
        spoilt = source.sample(range(15), i % 4)
        part = [word() if k in spoilt else w for k, w in enumerate(part)]
        before = [word() for _ in range(source.randrange(9))]
        docs.append((i, " ".join([*before, *part]).upper() + "!"))
        if i % 4 <= 2:
            want.add(i)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id long, text string")
    found = decontaminate.contaminated(frame, bench).collect()
    assert {r.doc_id for r in found} == want
    assert all(r.best_window >= 13 and r.item_id == 1 for r in found)


def test_short_items_and_odd_documents(spark, odd_docs, no_docs):
    items = [(1, "three four five six, SEVEN eight"), (2, "one two three"), (3, "four five six eight nine ten")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(odd_docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.start) for r in found} == {(1, 1, 2), (2, 1, 2), (None, 1, 2)}
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(odd_docs, bench.filter("false")).count() == 0


def test_blocks_of_items_agree(spark, docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "SEEDS", 2500)
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()} == whole
