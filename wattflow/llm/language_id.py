"""Language identification: family first, then one-versus-one linear SVMs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import held_out, row_type, text_groups, whole_row
from wattflow.llm.linear import linear_svm, sigmoid

#: FIXED VALUES: families of language codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "pt", "it", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk", "bg"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "mr", "bn", "pa", "gu", "ur"],
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}

DIM = 2048
_LETTER = regex.compile(r"\p{L}").search


def features(texts: list[str]) -> np.ndarray:
    """Square roots of hashed letter 1-, 2- and 3-gram shares, each of unit length.

    Whole texts; case is folded and every other character is a blank, so
    layout, digits and symbols do not matter.
    """
    out = np.empty((len(texts), DIM), np.float32)
    for i, j in text_groups(texts):
        for at in range(i, j, 256):
            part = texts[at:min(j, at + 256)]
            code = np.frombuffer("\n".join(t.lower().replace("\n", " ") for t in part)
                                 .encode("utf-32-le", "surrogatepass"), np.uint32)
            doc = np.cumsum(code == 10) * DIM
            code = np.where((code >= 97) & ((code <= 122) | (code >= 0xAA)), code, 32).astype(np.uint64)
            counts = np.zeros(len(part) * DIM, np.int64)
            gram = code
            for n in range(3):
                if n:
                    gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n:]
                bucket = ((gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(53)).astype(np.int64)
                solid = code[n:] != 32 if not n else np.ones(len(gram), bool)
                counts += np.bincount((doc[:len(gram)] + bucket)[solid], minlength=len(counts))
            x = np.sqrt(counts.reshape(len(part), DIM)).astype(np.float32)
            out[at:at + len(part)] = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return out


class Model:
    """One-versus-rest SVMs over families, one-versus-one SVMs inside each."""

    def __init__(self, x: np.ndarray, lang: np.ndarray):
        self.langs = sorted(set(lang))
        family = np.array([FAMILY_OF.get(c, c) for c in lang])
        self.families = sorted(set(family))
        one = [np.r_[np.zeros(x.shape[1]), 1.0]]  # a single family: always certain
        self.family_w = np.array([linear_svm(x, np.where(family == f, 1, -1)) for f in self.families]
                                 if len(self.families) > 1 else one)
        self.members = {f: sorted(set(lang[family == f])) for f in self.families}
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                rows = (lang == a) | (lang == b)
                self.pairs[a, b] = linear_svm(x[rows], np.where(lang[rows] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score: share of the family among the families, times
        the mean pairwise confidence of the winner inside it."""
        fam = sigmoid(4 * (x @ self.family_w[:, :-1].T + self.family_w[:, -1]))
        share = fam / fam.sum(axis=1, keepdims=True)
        chosen = share.argmax(axis=1)
        pred, score = np.empty(len(x), object), share.max(axis=1)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(chosen == i)
            names = self.members[f]
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(names)))
            for (a, b) in combinations(range(len(names)), 2):
                w = self.pairs[names[a], names[b]]
                p = sigmoid(4 * (x[rows] @ w[:-1] + w[-1]))
                votes[:, a] += p
                votes[:, b] += 1 - p
            best = votes.argmax(axis=1)
            pred[rows] = np.array(names, object)[best]
            if len(names) > 1:
                score[rows] *= votes.max(axis=1) / (len(names) - 1)
        return pred.tolist(), score


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 1000, languages: int = 20) -> Model | None:
    """Fit on about ``per_language`` documents a language outside the held-out fold.

    The bound is this parameter: documents are taken by a hash of their id, in
    the share that the language's count allows, so the sample is the same on
    every run. Its features, ``per_language`` * languages * 8 KB, go to the
    driver; with more than ``languages`` languages each brings fewer, so the
    whole stays under ``per_language`` * ``languages`` * 8 KB (about 160 MB).
    None if no row can be learned from.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return None
    per_language = max(1, per_language * languages // max(languages, len(counts)))
    size = F.coalesce(*[F.when(F.col("lang") == k, F.lit(n)) for k, n in sorted(counts.items())])
    sample = rows.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), size) < per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            ok = [i for i, t in enumerate(texts) if _LETTER(t)]
            x = features([texts[i] for i in ok])
            rows = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(pa.array(ok, pa.int64())), pa.array([xxhash.xxh3_128_digest(r) for r in rows], pa.binary()),
                 pa.array(rows, pa.binary())], names=["lang", "key", "x"])

    # one Arrow copy of the sample and one sorted matrix; the order does not depend on the partitions
    got = sample.select("text", "lang").mapInArrow(run, "lang string, key binary, x binary").toArrow()
    if not got.num_rows:
        return None
    order = got.select(["lang", "key"]).append_column("at", pa.array(range(got.num_rows))).sort_by(
        [("lang", "ascending"), ("key", "ascending")])["at"].to_numpy()
    x = np.empty((len(order), DIM), np.float32)
    at = 0
    for chunk in got["x"].chunks:
        for v in chunk:
            x[at] = np.frombuffer(v.as_buffer(), np.float32)
            at += 1
    lang = np.array(got["lang"].to_pylist(), object)[order]
    del got
    return Model(x[order], lang)


def predict_language(df: DataFrame, model: Model | None, id_col: str = "doc_id",
                     text_col: str = "text", with_row: bool = False) -> DataFrame:
    """doc_id, lang_pred and score of every whole text, one row per input row
    (with ``with_row`` also that row, as the struct ``row_in``).

    Null texts, texts without a letter and, if there was nothing to learn
    from, all texts are ``und`` with score 0. No shuffle; the broadcast model
    has a size fixed by the languages learned. Nothing but the text is read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            ok = [i for i, t in enumerate(texts) if t and m and _LETTER(t)]
            for at in range(0, len(ok), 1024):
                part = ok[at:at + 1024]
                names, s = m.predict(features([texts[i] for i in part]))
                score[part] = s
                for i, name in zip(part, names):
                    pred[i] = name
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(score), *b.columns[2:]],
                names=["doc_id", "lang_pred", "score", *b.schema.names[2:]])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"), *whole_row(df, with_row))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double" + row_type(src, with_row))


def language_query(docs: DataFrame) -> DataFrame:
    return predict_language(docs, train(docs)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
