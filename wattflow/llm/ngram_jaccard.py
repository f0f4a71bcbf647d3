"""Exact n-gram Jaccard join with rare-first prefix filtering."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattflow.llm.common import ragged
from wattflow.llm.components import components
from wattflow.session import stage

#: The frequency table: so many counters of hashed n-grams, 2 MB, whatever the
#: input; tables travel in so many pieces.
BUCKET_BITS, CHUNKS = 18, 64
#: The suffix filter compares the sizes of so many parts of two sets.
PARTS = 8
#: And once more, for each pair that is to be verified, of so many parts.
FINE_PARTS = 128
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


class Shingler:
    """Distinct n-word shingles of a whole text as sorted 64-bit hashes.

    Words are runs of anything but the six ASCII white space characters; A-Z
    are lower-cased. Fewer than n words form one shingle; no words, none.
    """

    def __init__(self, n: int):
        self.n, self.words = n, _WordHash()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ w[i:len(w) - n + 1 + i]) * _ODD
            h ^= h >> np.uint64(29)
        h.sort()
        return h[np.r_[True, h[1:] != h[:-1]]]


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Common shingles that sets of sizes n and m need at least."""
    return -(-percent * (n + m) // (100 + percent))


def parts(h: np.ndarray) -> int:
    """Sizes of eight parts of a set, modulo 256, as the bytes of a long."""
    return int.from_bytes(np.bincount((h & np.uint64(7)).astype(np.int64), minlength=PARTS)
                          .astype(np.uint8).tobytes(), "little", signed=True)


def fine_parts(h: np.ndarray) -> bytes:
    """Sizes of ``FINE_PARTS`` parts of a set, modulo 256."""
    at = (h >> np.uint64(3)) % np.uint64(FINE_PARTS)
    return np.bincount(at.astype(np.int64), minlength=FINE_PARTS).astype(np.uint8).tobytes()


def _close_sets(percent: int):
    """The pairs whose fine parts leave enough overlap possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(v.as_py() for v in b.column(c)), np.uint8).reshape(-1, FINE_PARTS)
                    for c in ("fine_a", "fine_b"))
            n, m = _column(b, "n_a"), _column(b, "n_b")
            d = x - y
            d = np.minimum(d, np.uint8(0) - d).astype(np.int64).sum(axis=1)
            yield b.select(["a", "b"]).filter(pa.array(d <= n + m - 2 * least_overlap(n, m, percent)))

    return run


def part_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At most the number of shingles in one set and not in the other."""
    x = np.ascontiguousarray(a).view(np.uint8).reshape(-1, PARTS)
    y = np.ascontiguousarray(b).view(np.uint8).reshape(-1, PARTS)
    d = x - y
    return np.minimum(d, np.uint8(0) - d).astype(np.int64).sum(axis=1)


def may_link(n: np.ndarray, i: np.ndarray, s: np.ndarray, m: np.ndarray, j: np.ndarray,
             t: np.ndarray, percent: int) -> np.ndarray:
    """Length, positional and suffix filters for sets of sizes n and m that
    share the shingle at places i and j of their rare-first orders."""
    need = least_overlap(n, m, percent)
    ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    ok &= 1 + np.minimum(n - i, m - j) - 1 >= need
    ok[ok] = part_distance(s[ok], t[ok]) <= (n + m - 2 * need)[ok]
    return ok


def _column(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).to_numpy(zero_copy_only=False)


def fixed_table(df: DataFrame, slots: Callable[[], Callable[[object], np.ndarray]], bits: int,
                dtype: type) -> np.ndarray:
    """Counts, over all rows, in a table of 2 ** bits slots, whatever the input.

    ``slots()`` gives, in a task, the function from a row's value to its
    slots. Tasks add up their rows, tables travel in ``CHUNKS`` compressed
    pieces and meet piece by piece; the sum goes to the driver. Counts stop at
    the type's maximum.
    """
    size, top = (1 << bits) // CHUNKS, np.iinfo(dtype).max

    def held(x: np.ndarray) -> np.ndarray:
        return np.minimum(x.astype(np.int64), top).astype(dtype)

    def pieces(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(rows), pa.int32()),
             pa.array([zlib.compress(held(x).tobytes(), 1) for x in rows.values()], pa.binary())], names=["chunk", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = slots(), np.zeros(1 << bits, np.uint32)
        for b in batches:
            for value in b.column(0):
                np.add.at(total, find(value.as_py()), 1)
        yield pieces(dict(enumerate(total.reshape(CHUNKS, size))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, data in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(zlib.decompress(data.as_py()), dtype).astype(np.int64)
                sums[c] = held(sums[c] + x if c in sums else x)
        yield pieces(sums)

    kind = "chunk int, counts binary"
    out = np.zeros((CHUNKS, size), dtype)
    for r in df.mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind).collect():
        out[r["chunk"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), dtype)
    return out.ravel()


def shingle_frequencies(docs: DataFrame, n: int) -> np.ndarray:
    """Documents per n-gram bucket, over all documents (2 MB)."""
    def slots() -> Callable[[str | None], np.ndarray]:
        shingles = Shingler(n)
        return lambda text: bucket(shingles(text))

    return fixed_table(docs.select("text"), slots, BUCKET_BITS, np.int64)


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set), its rare-first prefix and
    part sizes: all that candidate search needs, about a tenth of the set."""
    order = docs.sparkSession.sparkContext.broadcast(shingle_frequencies(docs, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, freq = Shingler(n), order.value
        for b in batches:
            size, node, prefix, sketch, fine = [], [], [], [], []
            for t in b.column(1):
                h = shingles(t.as_py())
                size.append(len(h))
                if not len(h):
                    node.append(None)
                    prefix.append(b"")
                    sketch.append(0)
                    fine.append(b"")
                    continue
                node.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
                keep = len(h) - -(-percent * len(h) // 100) + 1
                f = freq[bucket(h)]
                if keep < len(h):  # the keep rarest, in order of (frequency, hash)
                    least = np.partition(f, keep - 1)[keep - 1]
                    h2, f2 = h[f <= least], f[f <= least]
                else:
                    h2, f2 = h, f
                prefix.append(h2[np.lexsort((h2, f2))][:keep].tobytes())
                sketch.append(parts(h))
                fine.append(fine_parts(h))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(prefix, pa.binary()), pa.array(sketch, pa.int64()), pa.array(fine, pa.binary())],
                names=["doc_id", "n_shingles", "node", "prefix", "parts", "fine"])

    return stage(docs.mapInArrow(
        run, "doc_id long, n_shingles long, node long, prefix binary, parts long, fine binary"), "sets")


POSTING = "key long, n long, node long, pos long"
POSTING_COLUMNS = ["key", "n", "node", "pos"]


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data = [x.as_py() for x in b.column("prefix")]
        length = np.array([len(x) // 8 for x in data], np.int64)
        row = np.repeat(np.arange(len(data)), length)
        cols = [np.frombuffer(b"".join(data), np.int64), _column(b, "n")[row], _column(b, "node")[row],
                ragged(np.zeros(len(data), np.int64), length)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=POSTING_COLUMNS)


def _with_neighbours(percent: int):
    """Drops postings that cannot pair; streams rows sorted by (key, n, node).

    A posting stays if the one before or after has its key and a compatible
    length (lengths are sorted, so otherwise none has). Rows at a partition's
    ends stay, as their neighbours cannot be seen.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_live = None, True  # the last row, not yet judged against its next
        for b in batches:
            if not b.num_rows:
                continue
            cols = [_column(b, c) for c in POSTING_COLUMNS]
            if held is not None:
                cols = [np.r_[h, c] for h, c in zip(held, cols)]
            key, n = cols[0], cols[1]
            near = (key[1:] == key[:-1]) & (100 * n[:-1] >= percent * n[1:])
            live = np.r_[held_live, near]
            live[:-1] |= near
            held, held_live = [c[-1:] for c in cols], bool(live[-1])
            live[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(c[live]) for c in cols], names=POSTING_COLUMNS)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=POSTING_COLUMNS)

    return run


def _with_hub(percent: int):
    """Keeps the pairs of a posting with its key's hub that pass the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, h = ([_column(b, p + c) for c in ("n", "pos", "parts")] for p in ("", "hub_"))
            ok = may_link(*x, *h, percent)
            node, hub = _column(b, "node")[ok], _column(b, "hub_node")[ok]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(hub)], names=["node", "hub"])

    return run


def _all_pairs(percent: int):
    """All pairs of a key's postings that lie in different components and
    pass the filters; rows come sorted by (key, n, node), group after group."""
    names = ["key", "node", "n", "pos", "parts", "label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for b in batches:
            cols = [_column(b, c) for c in names]
            if rest is not None:
                cols = [np.r_[r, c] for r, c in zip(rest, cols)]
            if not len(cols[0]):
                continue
            at = int(np.searchsorted(cols[0], cols[0][-1]))  # the last key may go on
            rest = [c[at:] for c in cols]
            yield from pairs([c[:at] for c in cols])
        if rest is not None:
            yield from pairs(rest)

    def pairs(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, node, n, pos, sketch, label = cols
        i, d = np.arange(len(key)), 0
        while len(i):  # the d-th neighbours of all rows at once
            d += 1
            i = i[i + d < len(key)]
            i = i[(key[i + d] == key[i]) & (100 * n[i] >= percent * n[i + d])]
            p = i[label[i] != label[i + d]]
            q = p + d
            good = may_link(n[p], pos[p], sketch[p], n[q], pos[q], sketch[q], percent)
            if good.any():
                x, y = node[p[good]], node[q[good]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


#: Slots of the table that tells which documents' texts are wanted: 4 MB.
WANTED_BITS = 22


def _whole_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, sorted hashes) of the given (node, doc_id), from their texts.

    A table of fixed size of hashed ids lets tasks drop most other texts
    before the shuffle; the join then settles which are wanted. It is always a
    merge join: as a broadcast join, both functions would run in one task, and
    each core would hold two Python workers, there and for the rest of the job.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << WANTED_BITS))
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(fixed_table(
        nodes.select(slot.alias("slot")), lambda: lambda s: np.array([s]), WANTED_BITS, np.uint8) > 0))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for b in batches:
            at = _column(b, "slot")
            keep = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            yield b.filter(pa.array(keep.astype(bool))).select(["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for b in batches:
            h = [shingles(t.as_py()) for t in b.column("text")]
            node = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in h], np.int64)
            same = node == _column(b, "node")  # an id may come with several texts
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([x.tobytes() for x in h], pa.binary())],
                names=["node", "h"]).filter(pa.array(same))

    some = (docs.where("doc_id is not null").select("doc_id", "text", slot.alias("slot"))
            .mapInArrow(drop, "doc_id long, text string"))
    rows = some.join(nodes.hint("merge"), "doc_id").select("node", "text").mapInArrow(run, "node long, h binary")
    return stage(rows.dropDuplicates(["node"]), "whole-sets")


def _verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link, each verified once on whole sets."""
    for c in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                                        F.col("fine").alias(f"fine_{c}")), c)
    pairs = stage(pairs.mapInArrow(_close_sets(percent), "a long, b long"), "close-pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _whole_sets(docs, stage(nodes.select("node", "doc_id").join(used, "node"), "pair-nodes"), n)
    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("h").alias("x")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("h").alias("y")), "b"))
    return stage(joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def _mixed(live: DataFrame, links: DataFrame | None) -> DataFrame:
    """Postings with the component of their node so far, of the keys whose
    postings lie in different components; the others need no further test."""
    if links is None:
        marked = live.withColumn("label", F.col("node"))
    else:
        labels = components(links).withColumnRenamed("component", "label")
        marked = live.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marked = stage(marked, "marked")
    keys = (marked.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
            .where("lo <> hi").select("key"))
    return marked.join(keys, "key", "left_semi")


def _hub_pairs(mixed: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of postings with one hub a key: in the first turn the node that
    stands for most documents, later one drawn by a hash, the same over all
    keys; each node tries the two hubs it shares most keys with."""
    weight = F.col("docs") if turn == 0 else F.lit(0)
    rank = F.struct(weight, F.xxhash64("node", F.lit(turn)))
    hub = F.struct("node", "n", "pos", "parts", "label")
    hubs = mixed.groupBy("key").agg(F.max_by(hub, rank).alias("h")).select(
        "key", *[F.col("h").getField(c).alias(f"hub_{c}") for c in ("node", "n", "pos", "parts", "label")])
    pairs = (mixed.join(hubs, "key").where("label <> hub_label")
             .select("node", "n", "pos", "parts", "hub_node", "hub_n", "hub_pos", "hub_parts")
             .mapInArrow(_with_hub(percent), "node long, hub long"))
    order = Window.partitionBy("node").orderBy(F.desc("count"), "hub")
    return (pairs.groupBy("node", "hub").count().withColumn("r", F.row_number().over(order)).where("r <= 2")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())


def jaccard_components(df: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id",
                       text_col: str = "text", hub_turns: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Two documents link when 100 * |A & B| >= percent * |A | B| over their
    distinct n-word shingles; component_id is the smallest doc_id reachable.

    1. All documents' n-grams are counted in a table of fixed size, which
       orders n-grams rare first; equal sets become one node.
    2. Each node posts the prefix of that order in which any partner shares
       an n-gram. Postings are range partitioned by (n-gram, size, node), so a
       frequent n-gram is spread over tasks, and those without a neighbour of
       compatible length are dropped.
    3. ``hub_turns`` turns verify pairs of nodes with one hub a key: families of near
       copies grow together around hubs, without all their pairs being formed.
    4. Of n-grams whose postings still lie in different components, all
       pairs across components that pass the length, positional and suffix
       filters are verified, once each. Pairs inside a component need no test.

    Null and blank texts have no shingles, link with nothing and are their own
    component; null ids get none. Repeated rows share a component. An id with
    several texts takes part with each. Other columns are ignored; an empty
    table gives an empty result. Shingles and sets are compared by 64-bit hashes.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = shingle_sets(docs, n, percent)
    nodes = (sets.where("node is not null and doc_id is not null").groupBy("node")
             .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("docs"),
                  F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"),
                  F.first("parts").alias("parts"), F.first("fine").alias("fine")))
    nodes = stage(nodes, "nodes")
    live = (nodes.mapInArrow(_postings, POSTING).repartitionByRange("key", "n", "node")
            .sortWithinPartitions("key", "n", "node").mapInArrow(_with_neighbours(percent), POSTING))
    live = stage(live.join(nodes.select("node", "docs", "parts"), "node"), "postings")

    links = tested = None
    mixed = _mixed(live, None)
    for turn in range(hub_turns):
        pairs = _hub_pairs(mixed, percent, turn)
        pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        new = _verify(pairs, docs, nodes, n, percent)
        links = new if links is None else links.unionByName(new)
        tested = pairs if tested is None else tested.unionByName(pairs)
        mixed = _mixed(live, links)
    pairs = (mixed.select("key", "node", "n", "pos", "parts", "label").repartition("key")
             .sortWithinPartitions("key", "n", "node").mapInArrow(_all_pairs(percent), "a long, b long").distinct())
    pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    last = _verify(pairs, docs, nodes, n, percent)
    group = components(last if links is None else links.unionByName(last))
    rows = sets.join(group, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = (rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id")))
    return rows.join(least, "c", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
