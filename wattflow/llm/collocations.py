"""Phrase collocations by set-oriented mining of occurrence relations."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattflow.llm.common import prepare
from wattflow.session import stage

#: FIXED VALUES: letters folded, ends of pieces.
UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PIECE_ENDS = re.compile(rb"[.,;:!?\x0A-\x0D]")

LONGEST = 4
BLOCK_WORDS = 500_000
#: Words in all blocks that a task fills at a time, however many languages there are.
OPEN_WORDS = 2_000_000
HELD_PHRASES = 400_000
#: Rows of a batch of phrases.
SENT_PHRASES = 50_000
#: A block is a row of megabytes. Each is a row group of its own, else readers
#: and writers hold those of a whole file at once.
ONE_BLOCK = {"parquet.block.row.count.limit": "1"}
#: An Arrow batch takes no further block from this size on.
BATCH_BYTES = "1m"
#: Bits of a filter of frequent groups; its size does not depend on the input.
FILTER_BITS = 26
#: Bits of a hash that counting keeps; equal ones of different groups only let more through.
HASH_BITS = 48
RELATION = ("block long, lang string, words array<string>, counts array<long>, sizes array<int>, word array<int>, "
            "starts array<boolean>")


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b" " + word)


class _Block:
    """Occurrences of words of one language in order of piece and position.

    ``words`` are the distinct ones; ``word`` numbers each occurrence's;
    ``sizes`` are the lengths of stretches of words that follow each other in
    one piece; ``starts`` tells where a phrase of the relation begins (written
    as an empty list where that is everywhere).
    """

    def __init__(self, lang: str):
        self.lang, self.number, self.sizes, self.said = lang, {}, [], []

    def add(self, text: bytes) -> None:
        number = self.number
        for piece in PIECE_ENDS.split(text.translate(UPPER)):
            before = len(self.said)
            self.said += [number.setdefault(w, len(number)) for w in piece.replace(b"\t", b" ").split(b" ") if w]
            if len(self.said) > before:
                self.sizes.append(len(self.said) - before)

    def close(self) -> _Block:
        self.word, self.words = np.array(self.said, np.int32), list(self.number)
        self.starts = np.ones(len(self.word), bool)
        return self

    @staticmethod
    def read(b: pa.RecordBatch, i: int) -> _Block:
        out = _Block(b.column("lang")[i].as_py())
        out.words = b.column("words")[i].values.cast(pa.binary()).to_pylist()
        out.word = b.column("word")[i].values.to_numpy()
        out.sizes = b.column("sizes")[i].values.to_numpy()
        starts = b.column("starts")[i].values
        out.starts = starts.to_numpy(zero_copy_only=False) if len(starts) else np.ones(len(out.word), bool)
        return out

    def row(self, block: int) -> pa.RecordBatch:
        lists = [pa.array(self.words, pa.binary()).cast(pa.string()),
                 pa.array(np.bincount(self.word, minlength=len(self.words))),
                 pa.array(np.array(self.sizes, np.int32)), pa.array(self.word),
                 pa.array([] if self.starts.all() else self.starts, pa.bool_())]
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([self.lang]),
             *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]],
            names=["block", "lang", "words", "counts", "sizes", "word", "starts"])

    def longer(self) -> np.ndarray:
        """Merge join of the relation with itself at the next position: where
        the occurrences begin that are one word longer."""
        inside = np.ones(len(self.word), bool)  # the next word follows in the same piece
        inside[np.cumsum(self.sizes) - 1] = False
        return np.flatnonzero(self.starts[:-1] & self.starts[1:] & inside[:-1])

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases of ``length`` words that begin at ``at``."""
        lang = self.lang.encode("utf-8")
        of = np.fromiter((word_hash(lang, w) for w in self.words), np.uint64, len(self.words))
        h = np.zeros(len(at), np.uint64)
        for j in range(length):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) ^ of[self.word[at + j]]
        return h >> np.uint64(64 - HASH_BITS)

    def keep(self, at: np.ndarray, length: int) -> _Block:
        """The relation of the phrases of ``length`` words that begin at ``at``."""
        out = _Block(self.lang)
        starts, used = np.zeros(len(self.word), bool), np.zeros(len(self.word) + length, bool)
        starts[at] = True
        for j in range(length):
            used[at + j] = True
        used = used[:len(self.word)]
        kinds, out.word = np.unique(self.word[used], return_inverse=True)
        out.word = out.word.astype(np.int32)
        out.words = [self.words[k] for k in kinds]
        ends = np.zeros(len(self.word), bool)  # last words of the new stretches
        ends[np.cumsum(self.sizes) - 1] = True
        ends |= ~np.r_[used[1:], False]
        out.sizes = np.diff(np.flatnonzero(ends[used]) + 1, prepend=0)
        out.starts = starts[used]
        return out

    def counts(self, at: np.ndarray, length: int) -> pa.Table:
        """The distinct phrases that begin at ``at``, as text, and their counts; exact."""
        group = self.word[at].astype(np.int64)
        for j in range(1, length):
            group = np.unique(group * len(self.words) + self.word[at + j], return_inverse=True)[1]
        _, first, n = np.unique(group, return_index=True, return_counts=True)
        words = pa.array(self.words, pa.large_binary())
        parts = [words.take(pa.array(self.word[at[first] + j])) for j in range(length)]
        return pa.table({"phrase": pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())), "n": n})


class _Filter:
    """A set of hashes, as bits at their upper digits: none is missed, some
    more may pass the more it holds."""

    def __init__(self, groups: DataFrame):
        rows = groups.select(F.shiftright("hash", HASH_BITS - FILTER_BITS + 6).alias("at"), F.expr(
            f"shiftleft(1L, cast(shiftright(hash, {HASH_BITS - FILTER_BITS}) & 63 as int))").alias("bit")).groupBy(
            "at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2 ** (FILTER_BITS - 6) rows
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        self.bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(HASH_BITS - FILTER_BITS)
        return (self.bits.view(np.uint64)[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK_WORDS occurrences; a text is never split. With
    many languages the longest one goes out earlier."""
    number = TaskContext.get().partitionId() << 32
    opened: dict[str, _Block] = {}
    said = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            block = opened.setdefault(lang, _Block(lang))
            said -= len(block.said)
            block.add(text.as_py().encode("utf-8"))
            said += len(block.said)
            if len(block.said) < BLOCK_WORDS and said >= OPEN_WORDS:
                block = max(opened.values(), key=lambda x: len(x.said))
            elif len(block.said) < BLOCK_WORDS:
                continue
            said -= len(block.said)
            yield opened.pop(block.lang).close().row(number)
            number += 1
    for block in opened.values():
        if block.said:
            yield block.close().row(number)
            number += 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Block]]:
    for b in batches:
        for i, number in enumerate(b.column("block").to_pylist()):
            yield number, _Block.read(b, i)


class _Step:
    """What tasks do with each block of a relation: ``length`` words make a
    group, in a relation of phrases of one word less (``words`` is the filter
    of the frequent ones if these are single words), or, where ``done``, of
    that length. ``groups`` is the filter of the frequent groups, once known."""

    def __init__(self, length: int, words: Broadcast | None, groups: Broadcast | None, done: bool = False):
        self.length, self.words, self.groups, self.done = length, words, groups, done

    def _at(self, block: _Block) -> np.ndarray:
        if self.done:
            return np.flatnonzero(block.starts)
        if self.words is not None:
            first = np.unique(block.word, return_index=True)[1]
            block.starts = self.words.value.has(block.hashes(first, 1))[block.word]
        at = block.longer()
        return at if self.groups is None else at[self.groups.value.has(block.hashes(at, self.length))]

    def hashed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches):
            h, n = np.unique(block.hashes(self._at(block), self.length), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["hash", "n"])

    def named(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts by text, added up over the blocks of a task while there is room."""
        held: dict[str, pa.Table] = {}
        for _, block in _blocks(batches):
            mine = block.counts(self._at(block), self.length)
            if block.lang in held:
                mine = pa.concat_tables([held[block.lang], mine]).group_by("phrase", use_threads=False).aggregate(
                    [("n", "sum")]).select(["phrase", "n_sum"]).rename_columns(["phrase", "n"])
            held[block.lang] = mine
            if sum(t.num_rows for t in held.values()) > HELD_PHRASES:
                yield from _phrase_rows(held)
        yield from _phrase_rows(held)

    def kept(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches):
            at = self._at(block)
            if len(at):
                yield block.keep(at, self.length).row(number)


def _phrase_rows(held: dict[str, pa.Table]) -> Iterator[pa.RecordBatch]:
    for lang, t in held.items():
        for b in t.to_batches(max_chunksize=SENT_PHRASES):
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), b.num_rows), b.column("phrase").cast(pa.string()),
                 b.column("n")], names=["lang", "phrase", "n"])
    held.clear()


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h = [word_hash(lang.encode("utf-8"), w.encode("utf-8")) for lang, w in zip(*(c.to_pylist() for c in b.columns))]
        yield pa.RecordBatch.from_arrays(
            [pa.array((np.array(h, np.uint64) >> np.uint64(64 - HASH_BITS)).view(np.int64))], names=["hash"])


@contextmanager
def _block_by_block(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand large blocks to Python one at a time: an Arrow
    batch lies beside the heap, in buffers that double as they grow."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def frequent_phrases(df: DataFrame, least: int = 30, text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """(words a language, frequent phrases by length 1 to LONGEST).

    Each table of phrases has lang, phrase and n. The tables are exact: hashes
    only decide which groups are counted under their own text.
    """
    prepare(df.sparkSession)
    spark = df.sparkSession.sparkContext
    src = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    relation = stage(src.mapInArrow(_relation, RELATION), "occurrences-1", ONE_BLOCK)
    totals = relation.select("lang", F.size("word").cast("long").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("total"))
    in_block = relation.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        "lang", F.col("x.words").alias("phrase"), F.col("x.counts").alias("n"))

    def frequent(counts: DataFrame, length: int) -> DataFrame:
        return stage(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least),
                     f"frequent-{length}")

    tables = [frequent(in_block, 1)]
    words = spark.broadcast(_Filter(tables[0].select("lang", "phrase").mapInArrow(_word_hashes, "hash long")))
    with _block_by_block(df.sparkSession):
        for length in range(2, LONGEST + 1):
            counted = relation.mapInArrow(_Step(length, words, None).hashed, "hash long, n long").groupBy("hash").agg(
                F.sum("n").alias("n")).where(F.col("n") >= least)
            step = _Step(length, words, spark.broadcast(_Filter(counted)))
            if length < LONGEST:
                relation = stage(relation.mapInArrow(step.kept, RELATION), f"occurrences-{length}", ONE_BLOCK)
                step, words = _Step(length, None, None, done=True), None
            tables.append(frequent(relation.mapInArrow(step.named, "lang string, phrase string, n long"), length))
    return totals, tables


def mine_collocations(df: DataFrame, least: int = 30, top: int = 2000, absorbed_percent: int = 80,
                      text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases of 2 to LONGEST words: lang, rank,
    phrase, a, l, r, n, score.

    1. The relation of word occurrences, sorted by piece and position, is
       written in blocks of one language.
    2. Words are counted by their text, longer groups by a hash, first within
       a block. Of those met ``least`` times, a filter of fixed size goes to
       all tasks.
    3. The semi-join: occurrences whose group is in the filter stay, and are
       written as the relation of this length. What the filter lets through
       beyond is harmless, as these groups are counted again by their own text.
    4. The relation is merge-joined with itself at the next position of the
       same piece, and so on up to LONGEST words.
    5. A phrase scores floor(2000000 a / (l + r)) over its cut of least score
       (the first of equal ones); one with ``absorbed_percent`` of its
       occurrences inside a longer phrase is dropped.

    Occurrences are never shuffled, only the distinct groups of a task, so no
    key is hot. A longer phrase that absorbs a phrase does so through one that
    is one word longer, as that one occurs no less often. Null texts are
    empty, null languages ``und``; ids do not matter, repeated rows count as
    often as they occur, other columns are ignored; an empty table gives an
    empty result. With far more frequent groups than the filter has bits it
    holds nothing back, and more groups are counted.
    """
    totals, tables = frequent_phrases(df, least, text_col, lang_col)
    tables = [t.withColumn("ws", F.split("phrase", " ")) for t in tables]

    def words(a: int, z: int) -> Column:
        return F.concat_ws(" ", F.slice("ws", a, z - a + 1)).alias("phrase")

    found = None
    for size in range(2, LONGEST + 1):
        t, cuts = tables[size - 1].withColumnRenamed("n", "a"), []
        for k in range(1, size):
            first = tables[k - 1].select("lang", F.col("phrase").alias(f"first{k}"), F.col("n").alias(f"l{k}"))
            rest = tables[size - k - 1].select("lang", F.col("phrase").alias(f"rest{k}"), F.col("n").alias(f"r{k}"))
            t = t.withColumn(f"first{k}", words(1, k)).withColumn(f"rest{k}", words(k + 1, size))
            t = t.join(first, ["lang", f"first{k}"]).join(rest, ["lang", f"rest{k}"])
            cuts.append(f"named_struct('score', (cast(a as decimal(20, 0)) * 2000000) div (cast(l{k} as decimal(20, 0)) "
                        f"+ r{k}), 'k', {k}, 'l', l{k}, 'r', r{k})")
        # one struct a cut: the least score first, then the shorter first part
        t = t.withColumn("cut", F.expr(f"least({', '.join(cuts)})" if len(cuts) > 1 else cuts[0]))
        if size < LONGEST:
            longer = tables[size].select("lang", "n", F.explode(F.array(words(1, size), words(2, size + 1))).alias("phrase"))
            t = t.join(longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer")), ["lang", "phrase"], "left").where(
                f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {int(absorbed_percent)}")
        t = t.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        found = t if found is None else found.unionByName(t)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
