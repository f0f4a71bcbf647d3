"""Memory of the Python workers: one function a task, little for what cannot match."""

import random
import tracemalloc

from wattflow.llm import ngram_jaccard, repeats
from wattflow.llm.common import prepare


def test_wanted_texts_are_dropped_and_shingled_in_different_tasks(spark, monkeypatch):
    prepare(spark)
    word = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(word)), (2, " ".join([*word[:-1], "x"])), (3, " ".join([*word, "y"])),
            (4, "else what"), (5, None), (5, " ".join([*word, "z"])), (None, " ".join(word))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, stage = [], ngram_jaccard.stage

    def seen(df, name="stage"):
        if name == "whole-sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(ngram_jaccard, "stage", seen)
    got = ngram_jaccard.jaccard_components(docs, n=3, percent=80).collect()
    assert plans
    for plan in plans:
        nodes = [x.lstrip(" :+-") for x in plan.splitlines()]
        last, first = [i for i, x in enumerate(nodes) if x.startswith("MapInArrow")]
        assert any(x.startswith("Exchange") for x in nodes[last:first]), plan
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
        (0, 0), (1, 1), (2, 1), (3, 1), (4, 4), (5, 1), (5, 5)]


def test_contexts_of_a_common_gram_that_match_nothing_take_little_memory():
    rnd = random.Random(5)
    side = lambda: bytes(rnd.choices(b"abcdefgh ", k=rnd.randint(0, 186)))
    lone = [(a, side()) for a in (side() for _ in range(600))]
    pair = [(b"p" + b"same " * 20, b"same " * 20 + b"q"), (b"r" + b"same " * 20, b"same " * 20 + b"s")]
    contexts = [a + b"G" * 64 + z for a, z in lone + pair]
    offsets = [len(a) for a, _ in lone + pair]
    tracemalloc.start()
    try:
        got = repeats.covered(contexts, offsets, 250)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [repeats.merge(s) for s in got] == [[]] * 600 + [[(1, 265)], [(1, 265)]]
    assert peak < 4_000_000
