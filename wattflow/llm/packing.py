"""Best-fit packing by bin completion over the global length histogram."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattflow.llm.bpe import BYTE_CHARS, Vocabulary, WordEncoder, vocabulary
from wattflow.llm.common import ragged
from wattflow.session import stage

#: tiktoken's pattern engine gives up on runs of more than 1,000,000 blanks;
#: texts with a run of more than half of that go to the package's own encoder.
MAX_BLANKS = 500_000
Pattern = tuple[tuple[int, int], ...]  # ((length, times in a sequence), ...), longest first


@functools.lru_cache(maxsize=2)
def token_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary file ``path``, run by tiktoken: its ids stand
    in merge order, so they serve as ranks; one encoder a worker process."""
    v = Vocabulary(path)
    byte_of = {c: b for b, c in BYTE_CHARS.items()}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for i, t in enumerate(v.tokens)
             if t not in v.special}
    return tiktoken.Encoding(path, pat_str=v.pattern, mergeable_ranks=ranks,
                             special_tokens=v.special)


def token_ids(path: str, text: str) -> np.ndarray:
    """Ids (unsigned 32-bit) of a whole text of any length, special tokens'
    strings included, none added."""
    if len(text) > MAX_BLANKS and any(m.end() - m.start() > MAX_BLANKS
                                      for m in re.finditer(r"\s+", text)):
        enc = WordEncoder(vocabulary(path))  # not the cached one: such words are too large to keep
        pieces = enc.v.pieces(text)
        words = np.fromiter(map(enc.__getitem__, pieces), np.int64, len(pieces))
        enc.flush()
        return enc.ids[ragged(enc.start[words], enc.length[words])].astype("<u4")
    return token_encoder(path).encode_to_numpy(text, allowed_special="all").astype("<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    if n <= capacity:
        return [(0, n)]
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: always the longest that fits."""
    left, plan = counts.copy(), []
    for size in range(capacity, 0, -1):
        while left[size]:
            room, filling = capacity, []
            for s in _fitting(left, size, capacity):
                k = int(min(room // s, left[s]))
                if k:
                    filling.append((s, k))
                    room -= k * s
            plan.append(_take(left, tuple(filling)))
    return plan


def _fitting(left: np.ndarray, size: int, capacity: int) -> list[int]:
    return [int(s) for s in np.flatnonzero(left[:size + 1])[::-1] if s]


def _take(left: np.ndarray, filling: Pattern) -> tuple[Pattern, int]:
    """Apply a filling as often as the histogram allows."""
    times = int(min(left[s] // k for s, k in filling))
    for s, k in filling:
        left[s] -= k * times
    return filling, times


def completions(left: np.ndarray, size: int, capacity: int, width: int, steps: int) -> list[Pattern]:
    """Some undominated fillings around one document of the largest length.

    Depth first over shorter lengths, longest first. A filling is dominated
    if a remaining document still fits beside it or one of its documents can
    be exchanged for a longer one that fits; only maximal fillings are kept
    and of those the ``width`` with least waste. Not all are seen: the search
    ends after ``steps`` nodes, ``8 * width + 1`` fillings or the first without
    waste.
    """
    sizes = _fitting(left, size, capacity)
    found: dict[Pattern, int] = {}
    budget = [steps]

    def extend(i: int, room: int, filling: list[tuple[int, int]]) -> None:
        budget[0] -= 1
        if budget[0] < 0 or len(found) > 8 * width:
            return
        while i < len(sizes) and sizes[i] > room:
            i += 1
        if i == len(sizes):
            used = dict(filling)
            for s, k in filling[1:]:  # dominated: a longer document fits in place of one of these
                if any(t > s and t <= s + room and left[t] > used.get(t, 0) for t in sizes):
                    return
            found[tuple(filling)] = room
            return
        s = sizes[i]
        most = int(min(room // s, left[s] - (1 if filling[0][0] == s else 0)))
        for k in range(most, -1, -1):
            if k and filling[0][0] == s:
                extend(i + 1, room - k * s, [(s, k + 1), *filling[1:]])
            elif k:
                extend(i + 1, room - k * s, [*filling, (s, k)])
            elif i + 1 < len(sizes) or not most:  # else a document that still fits is left out
                extend(i + 1, room, filling)
            if budget[0] < 0 or (found and min(found.values()) == 0):
                return

    extend(0, capacity - size, [(size, 1)])
    return sorted(found, key=lambda f: (found[f], [-s for s, _ in f]))[:width]


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = 4000, width: int = 3,
                   steps: int = 400) -> list[tuple[Pattern, int]]:
    """Few sequences for a histogram of lengths, as (filling, times).

    Branch and bound over a beam: a node fills sequences around the longest
    remaining length, branching over the fillings of ``completions`` (at most
    ``width``), least waste first; a filling is applied as often as the counts
    allow and no less often, so the depth depends on the distinct lengths and
    not on the number of documents. A branch is pruned when its waste so far
    leaves no room to beat the incumbent (sequences used + ceil(remaining
    tokens / capacity)); the first incumbent, and one more at every 16th node,
    is best-fit decreasing on what remains. Ends at the waste bound or after
    ``nodes`` nodes, with the best plan found; short of the bound that plan
    need not be the best there is.
    """
    weights = np.arange(len(counts), dtype=np.int64)
    bound = -(-int((counts * weights).sum()) // capacity)
    best = best_fit(counts, capacity)
    best_n = sum(t for _, t in best)
    visited = 0
    stack: list[tuple[np.ndarray, list[tuple[Pattern, int]], int]] = [(counts.copy(), [], 0)]
    while stack and visited < nodes and best_n > bound:
        left, plan, used = stack.pop()
        visited += 1
        sizes = np.flatnonzero(left)
        if not len(sizes):
            if used < best_n:
                best, best_n = plan, used
            continue
        if used + -(-int((left * weights).sum()) // capacity) >= best_n:
            continue  # too much waste on this branch
        if visited % 16 == 1:
            rest = best_fit(left, capacity)
            if used + sum(t for _, t in rest) < best_n:
                best, best_n = [*plan, *rest], used + sum(t for _, t in rest)
        for filling in reversed(completions(left, int(sizes[-1]), capacity, width, steps)):
            after = left.copy()
            taken = _take(after, filling)
            stack.append((after, [*plan, taken], used + taken[1]))
    return best


class Places:
    """Where the i-th piece of a length goes: sequence and offset."""

    def __init__(self, plan: list[tuple[Pattern, int]]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for filling, times in plan:
            at = 0
            for s, k in filling:
                by_length.setdefault(s, []).append((k * times, first, k, at))
                at += s * k
            first += times
        self.runs = {}
        for s, runs in by_length.items():
            n, seq, k, at = (np.array(x, np.int64) for x in zip(*runs))
            self.runs[s] = (np.cumsum(n) - n, seq, k, at)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for s in np.unique(length):
            mine = np.flatnonzero(length == s)
            first, base, k, at = self.runs[int(s)]
            r = rank[mine]
            i = np.searchsorted(first, r, side="right") - 1
            inside = r - first[i]
            seq[mine] = base[i] + inside // k[i]
            off[mine] = at[i] + (inside % k[i]) * s
        return seq, off


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
                   nodes: int = 4000) -> DataFrame:
    """Tokenise, cut and pack every document; one row per piece.

    Tasks tokenise whole texts, append ``end_id`` and cut only what is longer
    than ``capacity``. Pieces (no texts) are staged once with their partition
    and running number within (partition, length). The search sees only the
    histogram of lengths, at most ``capacity`` numbers whatever the input, and
    gives fillings with multiplicities, also bounded; counts by (partition,
    length) are summed into offsets, so each piece knows its rank among the
    pieces of its length and from that its sequence and offset. No group of
    pieces ever meets in one task. With ``with_ids`` rows carry the token ids.

    Null and empty texts are one piece holding ``end_id``. Repeated rows are
    packed each for itself. An empty table gives an empty result. Other
    columns are ignored.
    """
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            doc, piece, start, length, crc, raw = [], [], [], [], [], []
            for row, text in enumerate(b.column(1)):
                ids = np.append(token_ids(tokenizer_path, text.as_py() or ""), np.uint32(end_id))
                for p, (s, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[s:s + n]
                    doc.append(row)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        raw.append(part.astype(np.int32))
            n = np.array(length, np.int64)
            rank = np.zeros(len(n), np.int64)
            order = np.argsort(n, kind="stable")
            run = n[order]
            starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else run
            sizes = np.diff(np.r_[starts, len(run)])
            rank[order] = np.arange(len(run)) - np.repeat(starts, sizes)
            rank += seen[n]
            np.add.at(seen, n, 1)
            cols = [b.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(n), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(raw, pa.list_(pa.int32())))
            cols += [pa.array(np.full(len(n), pid)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = PIECES + ", ids array<int>" * with_ids + ", pid long, rank long"
    names = [c.split()[0] for c in schema.split(", ")]
    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"))
    pieces = stage(src.mapInArrow(tokenise, schema), "pieces")

    counts = stage(pieces.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        histogram[r["length"]] = r["n"]
    places = df.sparkSession.sparkContext.broadcast(
        Places(bin_completion(histogram, capacity, nodes)))
    before = (Window.partitionBy("length").orderBy("pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("r0"))
    ranked = pieces.join(offsets, ["pid", "length"]).withColumn("rank", F.col("rank") + F.col("r0"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, off = places.value.find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(off)],
                                             names=out)

    keep = [c for c in names if c not in ("pid", "rank")]
    out = [*keep, "sequence_id", "offset"]
    out_schema = PIECES + ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    return ranked.select(*keep, "rank").mapInArrow(place, out_schema)
