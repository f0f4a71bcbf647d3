"""Periodic runs of words by a suffix automaton with link-cut access."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import SPACE, prepare, row_type, whole_row

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def suffix_automaton(text: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and greatest lengths of the states (1 is the root, 0 no
    state), and the state of every prefix, shortest first."""
    link, length, moves = [0, 0], [0, 0], [{}, {}]
    ends, last = [], 1
    for n, c in enumerate(text, 1):
        new = len(link)
        link.append(1)
        length.append(n)
        moves.append({})
        p = last
        while p and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                moves.append(dict(moves[q]))
                link[q] = link[new] = twin
                while p and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
        ends.append(new)
        last = new
    return link, length, ends


class LinkCutPaths:
    """Preferred paths of a rooted tree, each a splay tree ordered by depth.

    A path has one colour, kept at the root of its splay tree: the last access
    that went through it (0: none). ``access`` makes the way from a node to the
    root one path of a new colour; what hung below it stays behind as a path of
    the old colour.
    """

    def __init__(self, parent: Sequence[int]):
        self.up = list(parent)  # the parent in the splay tree; at its root, the node above the path
        self.upper, self.lower = [0] * len(parent), [0] * len(parent)
        self.colour = [0] * len(parent)

    def _turn(self, x: int, p: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        g = up[p]
        if upper[p] == x:
            b = upper[p] = lower[x]
            lower[x] = p
        else:
            b = lower[p] = upper[x]
            upper[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if upper[g] == p:
                upper[g] = x
            elif lower[g] == p:
                lower[g] = x

    def _splay(self, x: int) -> None:
        up, upper, lower = self.up, self.upper, self.lower
        top = x
        p = up[x]
        while p and (upper[p] == x or lower[p] == x):
            g = up[p]
            if g and (upper[g] == p or lower[g] == p):
                top = g
                if (upper[g] == p) == (upper[p] == x):
                    self._turn(p, g)
                else:
                    self._turn(x, p)
                self._turn(x, up[x])
            else:
                top = p
                self._turn(x, p)
            p = up[x]
        self.colour[x] = self.colour[top]

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """(old colour, lowest node) of the path segments from ``node`` up to
        the root, which all take the new colour."""
        up, lower, colours = self.up, self.lower, self.colour
        met, below, x = [], 0, node
        while x:
            self._splay(x)
            c = colours[x]
            if lower[x]:
                colours[lower[x]] = c
            lower[x] = below
            if c:
                met.append((c, x))
            below, x = x, up[x]
        self._splay(node)
        colours[node] = colour
        return met


def runs(text: Sequence[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of ``text``, by start, then period.

    ``periods`` is at least 2. Words are appended one by one: the access from
    the state of the prefix of length n meets segments of suffixes that ended
    last at some place e. The longest suffix of a segment, of m words, also
    ends at e, so the m + n - e words before n have the period n - e; with m
    at least n - e they hold a square. As nearer ends go with shorter suffixes,
    that period is the smallest one, and m cannot grow to the left; a run is
    told when the next word breaks it, hence once.
    """
    link, length, ends = suffix_automaton(text)
    paths = LinkCutPaths(link)
    found, size = [], len(text)
    for n, state in enumerate(ends, 1):
        for e, node in paths.access(state, n):
            q, m = n - e, length[node]
            if m >= (periods - 1) * q and m + q >= least and (n == size or text[n] != text[e]):
                found.append((e - m, m + q, q))
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def stretches(codes: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int]]:
    """Ranges of words outside which no run can lie.

    Each window of three words inside a run is met again one period on or
    back, inside it (given 6 words and 3 periods at least; with fewer, all
    words are one range). So windows whose nearest twin is further off than
    the range they lie in divided by ``periods`` are left out, which
    may shorten the ranges, and so on until nothing changes.
    """
    n = len(codes)
    if n < least:
        return []
    if least < 6 or periods < 3:
        return [(0, n)]
    base = int(codes.max()) + 1
    pair = codes[:-1] * base + codes[1:]
    if base > 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * base + codes[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    gap = np.diff(order)[same]
    near = np.full(n - 2, n + 1)
    near[order[1:][same]] = gap
    left = order[:-1][same]
    near[left] = np.minimum(near[left], gap)
    live = np.flatnonzero(near <= n // periods)
    while len(live):
        cut = np.flatnonzero(np.diff(live) != 1) + 1
        first, past = np.r_[0, cut], np.r_[cut, len(live)]
        words = past - first + 2
        most = np.where(words >= least, words // periods, 0)
        keep = near[live] <= np.repeat(most, past - first)
        if keep.all():
            return [(int(live[a]), int(live[z - 1]) + 3) for a, z in zip(first, past)]
        live = live[keep]
    return []


def find_runs(words: Sequence, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """Runs of a sequence of hashable words: an automaton for each stretch that may hold some."""
    number = dict(zip(dict.fromkeys(words), count()))
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out = []
    for a, z in stretches(codes, least, periods):
        out += [(a + s, n, q) for s, n, q in runs(codes[a:z].tolist(), least, periods)]
    return out


def _strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; the first of equal ones."""
    best = None
    for r in found:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def collapse_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS,
                  periods: int = LEAST_PERIODS, with_row: bool = False) -> DataFrame:
    """doc_id, runs, strongest and collapsed of every whole text, one row per input row.

    Words are what lies between white space. ``runs`` are all stretches of
    words with smallest period q and at least max(``least``, ``periods`` * q)
    words that no neighbour extends, by start, then period; ``strongest`` is
    the one of most periods (the first of equal ones; null if there is none);
    ``collapsed`` are the words outside and in the first period of every run
    that holds them, joined by blanks. Null, empty and blank texts have no runs
    and an empty ``collapsed``. Null ids, repeated ids and rows are judged row
    by row, other columns ignored (``with_row`` adds the input row as the
    struct ``row_in``); an empty table gives an empty result. No shuffle;
    memory is that of one text: some hundred bytes a word of its stretches.
    """
    prepare(df.sparkSession)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    *whole_row(df, with_row))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, spans, best, kept = [0], [], [], []
            for t in b.column(1):
                words = (t.as_py() or "").encode("utf-8").split()
                found = find_runs(words, least, periods)
                spans += found
                offsets.append(len(spans))
                best.append(_strongest(found))
                if found:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s, n, q in found:
                        gone[s + q] += 1
                        gone[s + n] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                kept.append(b" ".join(words))
            cols = list(zip(*spans)) or [(), (), ()]
            values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                 pa.array([r and dict(zip(("start", "length", "period"), r)) for r in best], run_type),
                 pa.array(kept, pa.binary()).cast(pa.string()), *b.columns[2:]],
                names=["doc_id", "runs", "strongest", "collapsed", *b.schema.names[2:]])

    return src.mapInArrow(run, f"doc_id long, runs array<{RUN}>, strongest {RUN}, collapsed string"
                          + row_type(src, with_row))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten (by the checksum of its id)
    repeats a stretch of its words up to its end; see the query's contract.
    Texts without words and rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    w = F.when(h % 10 == 0, F.array_remove(F.split("text", f"[{SPACE}]+"), ""))
    chosen = chosen.withColumn("g", F.floor(h / 10).cast("long")).withColumn("w", w).withColumn("n", F.size("w"))
    a = (F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)

    def place(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    again = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", place(i))))
    return chosen.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def runs_query(docs: DataFrame) -> DataFrame:
    found = collapse_runs(with_planted_periods(docs))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
