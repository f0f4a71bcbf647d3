"""Toxicity scores from a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import held_out, row_type, whole_row
from wattflow.llm.linear import logistic, sigmoid

#: FIXED VALUES: closed word classes of the grammar.
THREATS = "kill hurt destroy attack punish beat burn töten schlagen tuer frapper matar golpear".split()
TARGETS = "you your yours he him his she her they them du dich ihr euch sie tu toi vous tú usted ustedes".split()
NEGATIONS = "not no never nor nobody nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = ("said says say told tells quoted quote called reported wrote sagte sagt dit disait "
           "dijo dice").split()

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:|\n]").findall

# token classes
OTHER, BREAK, STRONG, WEAK, THREAT, TARGET, NEGATION, REPORT = range(8)

# The transducers. Each is (state, class) -> state; a clause starts in state 0.
# Their product reads one clause; a matched word is written with the states the
# others are in (negated, reported) and with the clause's target at its end.
NEGATION_REACH = 3  # a negation reaches the third word after it
NEGATED = {(s, c): (NEGATION_REACH if c == NEGATION else max(0, s - 1))
           for s in range(NEGATION_REACH + 1) for c in range(8)}
REPORTED = {(s, c): (1 if c == REPORT else s) for s in range(2) for c in range(8)}
TARGETED = {(s, c): (1 if c == TARGET else s) for s in range(2) for c in range(8)}

KINDS = ("insult", "insult_targeted", "insult_negated", "insult_reported",
         "weak", "weak_negated", "weak_reported", "threat", "threat_targeted")
N_FEATURES = 2 * len(KINDS) + 2


def read_clause(classes: list[int], weights: list[float], out: np.ndarray) -> float:
    """Run the composed transducers over one clause; add the matches to ``out``."""
    neg = rep = tgt = 0
    found: list[tuple[int, int, int]] = []
    weight = 0.0
    for c, w in zip(classes, weights):
        if c in (STRONG, WEAK, THREAT):
            found.append((c, neg, rep))
            weight += 0.0 if neg or rep else w
        neg, rep, tgt = NEGATED[neg, c], REPORTED[rep, c], TARGETED[tgt, c]
    for c, n, r in found:
        if c == STRONG:
            kind = 2 if n else 3 if r else 1 if tgt else 0
        elif c == WEAK:
            kind = 5 if n else 6 if r else 4
        else:
            kind = 8 if tgt else 7
        out[kind] += 1
    return weight


class Grammar(dict):
    """word -> (class, weight), with learned insults; unknown words are looked
    up by whole word, then by their longest learned stem."""

    def __init__(self, lexicon: dict[str, float], strong: float = 4.0, max_words: int = 500_000):
        super().__init__()
        self.lexicon, self.strong, self.max_words = lexicon, strong, max_words
        self.fixed = {w: c for c, words in ((THREAT, THREATS), (TARGET, TARGETS),
                                            (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}

    def __missing__(self, word: str) -> int:
        if len(self) > self.max_words:
            self.clear()
        c = self[word] = self._class(word)
        return c

    def weight(self, word: str) -> float:
        w = self.lexicon.get(word)
        if w is None:
            for k in range(min(STEMS[-1], len(word) - 1), STEMS[0] - 1, -1):
                w = self.lexicon.get(word[:k] + "*")
                if w is not None:
                    return w
        return w or 0.0

    def _class(self, word: str) -> int:
        if not word[0].isalpha():
            return BREAK
        if word in self.fixed:
            return self.fixed[word]
        w = self.weight(word)
        return STRONG if w >= self.strong else WEAK if w > 0 else OTHER

    def features(self, text: str) -> np.ndarray:
        """Counts of matched clauses by kind, their shares of the text, and the
        weight of unnegated, unreported matches, over one whole text."""
        out = np.zeros(N_FEATURES)
        tokens = _TOKEN(text.lower())
        if not tokens:
            return out
        classes = np.fromiter(map(self.__getitem__, tokens), np.uint8, len(tokens))
        hits = np.flatnonzero((classes >= STRONG) & (classes <= THREAT))
        if not len(hits):
            return out
        counts = np.zeros(len(KINDS))
        breaks = np.flatnonzero(classes == BREAK)
        words = len(tokens) - len(breaks)
        weight, done = 0.0, -1
        for h in hits:
            if h < done:
                continue  # in a clause that has been read
            i = np.searchsorted(breaks, h)
            start = breaks[i - 1] + 1 if i else 0
            done = breaks[i] if i < len(breaks) else len(tokens)
            part = classes[start:done].tolist()
            weight += read_clause(part, [self.weight(t) if STRONG <= c <= WEAK else 0.0 for t, c in
                                         zip(tokens[start:done], part)], counts)
        n = len(KINDS)
        out[:n] = np.log1p(counts)
        out[n:2 * n] = np.sqrt(counts / max(1, words))
        out[2 * n] = np.log1p(weight)
        out[2 * n + 1] = np.sqrt(weight / max(1, words))
        return out


STEMS = range(4, 9)


def _candidates(text: str) -> set[str]:
    """Words of a text and their stems (first letters, marked by a star)."""
    words = {t for t in _TOKEN(text.lower()) if t[0].isalpha() and len(t) < 40}
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


class Model:
    def __init__(self, lexicon: dict[str, float], weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          bound: int = 12_000, lexicon_size: int = 4000) -> Model:
    """Learn the insult lexicon and the weights of the matched clause kinds.

    Labels come from rows outside the held-out fold. About ``bound`` of them
    are used, taken by a hash of the id in the share the count allows: half
    for the lexicon (words and stems far more frequent in toxic texts,
    counted on Spark, at most ``lexicon_size`` kept), half for the weights
    (a dozen numbers a document go to the driver), so the weights are not
    fitted to words that the same texts brought in. Without both classes the
    lexicon is empty and every score is the share of toxic labels.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    n = known.count()
    known = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(max(1, n))) < bound)
    half = F.pmod(F.xxhash64(F.concat(F.lit("half"), F.col("doc_id").cast("string"))), F.lit(2))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(known, "doc_id").where(F.col("text").isNotNull()).select(
        "text", "toxic", half.alias("half"))

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tox, clean = {}, {}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                into = tox if y else clean
                for w in ["", *_candidates(text)]:  # "" counts the documents
                    into[w] = into.get(w, 0) + 1
            words = [*tox, *(w for w in clean if w not in tox)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array([tox.get(w, 0) for w in words], pa.int64()),
                 pa.array([clean.get(w, 0) for w in words], pa.int64())], names=["w", "t", "c"])

    counts = (sample.where("half = 0").select("text", "toxic").mapInArrow(mine, "w string, t long, c long")
              .groupBy("w").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 3 or w = ''"))
    ranked = (counts.orderBy((F.col("w") == "").desc(), (F.log(F.col("t") / (F.col("c") + 0.5)) * F.sqrt("t")).desc(),
                             "w").limit(lexicon_size + 1).collect())
    lexicon: dict[str, float] = {}
    if ranked and ranked[0]["w"] == "" and ranked[0]["t"] and ranked[0]["c"]:
        n_t, n_c = ranked[0]["t"], ranked[0]["c"]
        least = max(3, 0.004 * n_t)
        for r in ranked[1:]:
            odds = log((r["t"] + 0.1) / n_t) - log((r["c"] + 0.5) / n_c)
            if r["t"] >= least and odds >= 1.5:
                lexicon[r["w"]] = min(odds, 8.0)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Grammar(lexicon)
        for b in batches:
            x = [g.features(t).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1)], names=["x", "y"])

    rows = sample.where("half = 1").select("text", "toxic").mapInArrow(describe, "x binary, y int").collect()
    if not rows:
        return Model(lexicon, np.zeros(N_FEATURES + 1))
    rows.sort(key=lambda r: (bytes(r["x"]), r["y"]))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float64).reshape(len(rows), N_FEATURES)
    return Model(lexicon, logistic(x, np.array([min(1, r["y"]) for r in rows], np.float64)))


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                   cut: float = 0.3, with_row: bool = False) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= ``cut``), one row per input
    row (with ``with_row`` also that row, as the struct ``row_in``).

    Whole texts, cut into clauses at punctuation and line ends; only clauses
    that hold a lexicon or threat word are run through the transducers. Null
    and empty texts match nothing and get the score of no match. No shuffle;
    the broadcast model is bounded by the lexicon size. Only texts are read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        g = Grammar(m.lexicon)
        for b in batches:
            x = np.zeros((b.num_rows, N_FEATURES))
            for i, t in enumerate(b.column(1)):
                x[i] = g.features(t.as_py() or "")
            s = sigmoid(x @ m.weights[:-1] + m.weights[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= cut).astype(np.int32)), *b.columns[2:]],
                names=["doc_id", "score", "predicted", *b.schema.names[2:]])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"), *whole_row(df, with_row))
    return src.mapInArrow(run, "doc_id long, score double, predicted int" + row_type(src, with_row))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, train(docs, labels)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
