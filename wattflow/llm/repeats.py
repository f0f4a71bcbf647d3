"""Removal of long repeated substrings with suffix arrays over aligned contexts."""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import row_type, whole_row
from wattflow.llm.suffix_array import longest_matches
from wattflow.session import stage

GRAM = 64  # bytes of an anchor
_BASE = 0x5851F42D4C957F2D | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes from each place on, by prefix sums."""
    n = len(data)
    up, down = _powers(1 << max(16, int(n).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * up[:n - k + 1]
    h ^= h >> np.uint64(31)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of every w consecutive ones, by minima inside blocks."""
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    blocks = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray, doc_end: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of ``length`` bytes inside one document each.

    A window's anchor is its gram of least hash (the first of equal ones), so
    equal windows have it at the same place. ``data`` holds documents one
    after another, ``doc_end`` their ends. Returns for each anchor its place,
    the first start and last start of the windows it stands for, its hash.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = gram_hashes(data, GRAM)
    bits = np.uint64(int(len(h)).bit_length())
    keyed = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
    least = window_minima(keyed, length - GRAM + 1)
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(place))
    doc = np.searchsorted(doc_end, start, side="right")
    inside = doc < len(doc_end)
    inside[inside] = start[inside] + length <= doc_end[doc[inside]]
    place, start = place[inside], start[inside]
    if not len(place):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[new[1:], len(place)] - 1
    return place[new], start[new], start[last], h[place[new]]


def covered(contexts: list[bytes], offsets: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For contexts aligned at a common gram (at ``offsets``), the ranges of
    each that match another one over at least ``length`` bytes through it.

    Bytes of a side that no other context has from the gram on, and contexts
    whose two sides together are then too short, cannot match and are left
    out. Of the rest, columns where no two contexts part are one symbol: a
    block of columns and the class of contexts that agree from the gram to its
    far end. The suffix array of the contexts' block strings, weighted by
    bytes, gives for each block start the longest match; unequal ends keep
    contexts apart. Memory follows the blocks that two contexts or more share.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if len(contexts) == 2:  # their one common stretch
        before, after = (_common(*s) for s in ([c[:o][::-1] for c, o in zip(contexts, offsets)],
                                               [c[o:] for c, o in zip(contexts, offsets)]))
        return [[(o - before, o + after)] if before + after >= length else [] for o in offsets]
    live = list(range(len(contexts)))
    for turn in range(4):  # each pass may leave out more; what is left in vain costs time only
        n = len(live)
        sides = [_shared([contexts[c][:offsets[c]][::-1] for c in live]),
                 _shared([contexts[c][offsets[c]:] for c in live])]
        may = sides[0][2] + sides[1][2] >= length
        if may.all() or turn == 3:
            break
        live = [c for c, ok in zip(live, may) if ok]
    if not n:
        return out
    cuts, base, labels, blocks = [], [], [], []
    symbols = n  # the numbers below are the contexts' ends
    for by_text, common, kept in sides:
        cut = np.unique(np.r_[0, common, kept])
        label = np.zeros((n, len(cut) - 1), np.int32)
        number = []
        for i, end in enumerate(cut[1:]):
            label[by_text, i] = np.r_[0, np.cumsum(common < end)]
            number.append(symbols)
            symbols += n
        cuts.append(cut)
        base.append(np.array(number, np.int64))
        labels.append(label)
        blocks.append(np.searchsorted(cut, kept))
    text, weight = array("q"), array("q")
    starts: list[tuple[int, int, int]] = []  # place in text, context, its blocks to the left
    widths = [np.diff(cut) for cut in cuts]
    for c in range(n):
        k, m = (int(b[c]) for b in blocks)
        starts.append((len(text), live[c], k))
        text.frombytes(np.r_[(base[0][:k] + labels[0][c, :k])[::-1], base[1][:m] + labels[1][c, :m],
                             c].astype(np.int64).tobytes())  # c: an end that no other context has
        weight.frombytes(np.r_[widths[0][:k][::-1], widths[1][:m], 0].astype(np.int64).tobytes())
    best = longest_matches(text, weight)
    left = cuts[0].tolist()
    for at, c, k in starts:  # a match begins left of the gram or at it
        for i in range(k + 1):
            if best[at + i] >= length:
                byte = offsets[c] - left[k - i]
                out[c].append((byte, byte + best[at + i]))
    return out


def _shared(side: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Ascending order of the texts, the bytes that neighbours in it have in
    common, and for each text the most that it has in common with another."""
    by_text = sorted(range(len(side)), key=side.__getitem__)
    common = np.array([_common(side[a], side[b]) for a, b in zip(by_text, by_text[1:])], np.int64)
    kept = np.zeros(len(side), np.int64)
    kept[by_text] = np.maximum(np.r_[0, common], np.r_[common, 0])[:len(side)]
    return by_text, common, kept


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n)
    return int((x != np.frombuffer(b, np.uint8, n)).argmax())


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and where each text ends (a start in front)."""
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int32 if col.type == pa.string() else np.int64)
    at = at[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at * 0
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def _groups(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes, so that arrays stay in the cache."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, side="right")) - 1)
        yield i, j
        i = j


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            data, at = _utf8(b.column("t"))
            row = b.column("row").to_numpy()
            for i, j in _groups(at, 200_000):
                part = data[at[i]:at[j]]
                end = at[i + 1:j + 1] - at[i]
                place, lo, hi, h = anchors(part, end, length)
                doc = np.searchsorted(end, lo, side="right")
                base = np.r_[0, end][doc]
                raw = part.tobytes()
                ctx = [xxhash.xxh3_64_intdigest(raw[a:z], seed=o) for a, z, o in
                       zip(lo.tolist(), (hi + length).tolist(), (place - lo).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.array(ctx, np.uint64).view(np.int64)),
                     pa.array(row[i:j][doc]), pa.array((lo - base).astype(np.int32)),
                     pa.array((hi + length - base).astype(np.int32)),
                     pa.array((place - lo).astype(np.int32))],
                    names=["gram", "ctx", "row", "lo", "hi", "off"])
    return run


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, wanted in zip(b.column("t"), b.column("wanted")):
            raw, wanted = text.as_py().encode("utf-8"), wanted.as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([w["gram"] for w in wanted], pa.int64()),
                 pa.array([w["ctx"] for w in wanted], pa.int64()),
                 pa.array([w["off"] for w in wanted], pa.int32()),
                 pa.array([raw[w["lo"]:w["hi"]] for w in wanted], pa.binary())],
                names=["gram", "ctx", "off", "bytes"])


def _match_contexts(length: int):
    """Streams contexts sorted by gram; one gram's contexts are held at a time."""
    def result(gram: int, group: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        found = covered([g[2] for g in group], [g[1] for g in group], length)
        for (ctx, _, _), spans in zip(group, found):
            for a, z in merge(spans):
                yield gram, ctx, a, z

    def batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        g, c, a, z = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(a, pa.int32()),
             pa.array(z, pa.int32())], names=["gram", "ctx", "a", "z"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, group, rows = None, [], []
        for b in batches:
            for g, c, o, data in zip(*(b.column(x).to_pylist() for x in ("gram", "ctx", "off", "bytes"))):
                if g != gram:
                    if len(group) > 1:
                        rows += result(gram, group)
                    gram, group = g, []
                group.append((c, o, data))
            if rows:
                yield batch(rows)
                rows = []
        if len(group) > 1:
            rows += result(gram, group)
        if rows:
            yield batch(rows)

    return run


def repeated_spans(rows: DataFrame, length: int) -> DataFrame:
    """(row, spans) of the rows (row, t) that hold repeated substrings."""
    found = stage(rows.where(F.octet_length("t") >= length).mapInArrow(
        _find_anchors(length), "gram long, ctx long, row long, lo int, hi int, off int"), "anchors")
    per_context = found.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("n"))
    repeated = (per_context.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("n"))
                .where("n > 1"))
    hit = stage(found.join(repeated.select("gram", "contexts"), "gram"), "repeated-anchors")
    # contexts met twice repeat as a whole
    twice = hit.groupBy("gram", "ctx").count().where("count > 1").select("gram", "ctx")
    whole = hit.join(twice, ["gram", "ctx"], "left_semi").select("row", F.col("lo").alias("a"), F.col("hi").alias("z"))
    # of the others, one row a distinct context brings its bytes
    alone = hit.where("contexts > 1")
    wanted = (alone.dropDuplicates(["gram", "ctx"]).groupBy("row")
              .agg(F.collect_list(F.struct("gram", "ctx", "lo", "hi", "off")).alias("wanted")))
    texts = rows.join(wanted, "row").dropDuplicates(["row"]).select("t", "wanted")
    matches = stage(texts.mapInArrow(_cut_contexts, "gram long, ctx long, off int, bytes binary")
                    .repartition("gram").sortWithinPartitions("gram", "ctx")
                    .mapInArrow(_match_contexts(length), "gram long, ctx long, a int, z int"), "matches")
    partial = alone.join(matches, ["gram", "ctx"]).select(
        "row", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("z")).alias("z"))
    return (whole.unionByName(partial).distinct().groupBy("row")
            .agg(F.collect_list(F.struct("a", "z")).alias("spans")))


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(df: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, with_row: bool | None = None) -> DataFrame:
    """Cut out every byte covered by a ``length``-byte string that also starts
    anywhere else, in the same or another document; all occurrences go.

    1. A window's anchor is its 64-byte gram of least hash; equal windows have
       equal anchors, and one anchor stands for many windows. Tasks emit an
       anchor's hash, its place and a digest of the bytes its windows span.
    2. Anchors met once are dropped. Of those met again, contexts that are
       equal as a whole are covered outright, whatever their number; one of
       each is kept as a witness for the others.
    3. Contexts that differ meet by gram, and the longest match of each place is
       read off a suffix array of the contexts, built by grouping.
    4. Spans join back to the whole texts, are merged, and cut.

    One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256;
    with ``with_text`` also ``kept_text`` (characters that were cut inside are
    left out whole) and, unless ``with_row`` is false, the input row as the
    struct ``row_in``. Null, empty and
    short texts keep all their bytes. Repeated rows are copies of each other.
    Other columns are ignored. Grams, contexts and rows are told apart by 64-bit
    hashes; the match lengths are exact.
    """
    with_row = with_text if with_row is None else with_row
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cols = [F.col(id_col).alias("doc_id"), text.alias("t"),
            F.xxhash64(F.col(id_col), text, F.col(id_col).isNull()).alias("row")]
    src = df.select(*cols, *whole_row(df, with_row))
    spans = repeated_spans(src.select("row", "t"), length)
    extra = ["row_in"] if with_row else []
    joined = src.join(spans, "row", "left").select("doc_id", "t", "spans", *extra)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + (
        ["kept_text"] if with_text else []) + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, count, digest, kept_texts = [], [], [], [], []
            for t, s in zip(b.column("t"), b.column("spans")):
                raw = t.as_py().encode("utf-8")
                cut = merge([(x["a"], x["z"]) for x in s.as_py() or []])
                parts, at = [], 0
                for a, z in cut:
                    parts.append(raw[at:a])
                    at = z
                parts.append(raw[at:])
                n.append(len(raw))
                removed.append(sum(z - a for a, z in cut))
                count.append(len(cut))
                digest.append(hashlib.sha256(b"".join(parts)).hexdigest())
                if with_text:
                    kept_texts.append("".join(p.decode("utf-8", errors="ignore") for p in parts))
            out = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                   pa.array(count, pa.int64()), pa.array(digest, pa.string())]
            if with_text:
                out.append(pa.array(kept_texts, pa.string()))
            if with_row:
                out.append(b.column("row_in"))
            yield pa.RecordBatch.from_arrays(out, names=names)

    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {RESULT}"
    if with_text:
        schema += ", kept_text string"
    schema += row_type(src, with_row)
    return joined.mapInArrow(run, schema)
