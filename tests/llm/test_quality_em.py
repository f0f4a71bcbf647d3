"""Quality rules: exact counts of very long texts, and the fitted verdict against plain numpy EM."""

import numpy as np
from pyspark.sql import functions as F

from wattflow.llm import quality_rules as qr


def test_words_of_a_very_long_text_do_not_collide(spark, monkeypatch):
    # as in a text of trillions of words, twelve bits are left to the hash of a window
    monkeypatch.setattr(qr, "_position_bits", lambda: F.lit(52))
    long = F.concat_ws(" ", F.sequence(F.lit(1), F.lit(60_000)).cast("array<string>"))
    df = spark.range(2).select(F.col("id").alias("doc_id"),
                               F.when(F.col("id") == 0, long).otherwise(F.concat(long, F.lit(" 7 8 9 10"))).alias("text"))
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in qr.text_statistics(df).select(
        "doc_id", "n_words", "n_repeat_words").collect()}
    assert got == {0: (60_000, 0), 1: (60_004, 8)}


def fit_by_hand(votes, rounds=20):
    prior, right = 0.8, np.full((votes.shape[1], 2), 0.8)

    def odds():
        good, bad = votes == qr.GOOD, votes == qr.BAD
        a, b = right.T
        return np.log(prior / (1 - prior)) + good @ np.log(a / (1 - b)) + bad @ np.log((1 - a) / b)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds()))
        voted = votes != qr.ABSTAIN
        right = np.stack([((p[:, None] * (votes == qr.GOOD)).sum(0) + 8) / ((p[:, None] * voted).sum(0) + 10),
                          (((1 - p)[:, None] * (votes == qr.BAD)).sum(0) + 8) / (((1 - p)[:, None] * voted).sum(0) + 10)], 1)
        prior = min(0.999, max(0.001, p.mean()))
    return 1 / (1 + np.exp(-odds()))


def test_posterior(docs):
    names = [f"v_{r}" for r in qr.RULES]
    rows = qr.score_quality(docs).collect()
    votes = np.array([[r[n] for n in names] for r in rows])
    judged = np.array([not r.base_failed for r in rows])
    want = fit_by_hand(votes[judged])
    got = np.array([r.posterior for r in rows])[judged]
    assert np.abs(got - want).max() < 1e-9 and len(set(got)) > 2
    assert [r.kept for r in rows if not r.base_failed] == list(want >= 0.5)
    assert not any(r.kept for r in rows if r.base_failed)
