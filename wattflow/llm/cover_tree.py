"""Exact near-duplicate vectors by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import ragged
from wattflow.llm.components import components
from wattflow.session import stage

#: Radii of the nested levels, halving; above them are the cells, below the
#: last one the points.
RADII = (0.5, 0.25, 0.125, 0.0625)
#: Slack of the bounds on distances, above their rounding (about 1e-7 near 0).
EPS = 1e-6
#: Most products held at once while pairs of nodes are expanded.
CELLS = 1 << 21


def distance(cosine: np.ndarray) -> np.ndarray:
    """Distance of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _net(x: np.ndarray, rows: np.ndarray, r: float) -> np.ndarray:
    """The centre of each of ``rows``: centres lie further apart than about
    ``r`` (single precision; covering radii are measured afterwards), every
    other row within it of its own. The first row is a centre."""
    near = 1.0 - r * r / 2.0
    centre, free = np.empty(len(rows), np.int64), np.arange(len(rows))
    while len(free):
        first = rows[free[:256]]
        close = x[first] @ x[first].T >= near
        np.fill_diagonal(close, True)
        held, picked = np.zeros(len(first), bool), []
        for k in range(len(first)):
            if not held[k]:
                picked.append(k)
                held |= close[k]
        dots = x[rows[free]] @ x[first[picked]].T
        dots[picked, np.arange(len(picked))] = 2.0
        best = dots.argmax(axis=1)
        found = dots[np.arange(len(free)), best] >= near
        centre[free[found]] = first[picked][best[found]]
        free = free[~found]
    return centre


def grow(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A cover tree over unit vectors: nested nets of halving radii.

    Returns the rows in depth-first order, each node's centre first; for each
    of them the topmost level it is a centre of (``len(RADII)``: none); and the
    true covering radius of its node at every level, over all vectors below.
    """
    n, depth = len(x), len(RADII)
    single, own = x.astype(np.float32), np.arange(len(x))
    path, groups = np.empty((n, depth), np.int64), [own]
    for level, r in enumerate(RADII):
        path[:, level] = own
        below = []
        for rows in groups:
            centre = _net(single, rows, r)
            path[rows, level] = centre
            by = np.lexsort((rows, rows != centre, centre))
            cuts = np.flatnonzero(np.diff(centre[by])) + 1
            below += [g for g in np.split(rows[by], cuts) if len(g) > 1]
        groups = below
    radius = np.zeros((n, depth))
    for level in range(depth):
        rows = np.flatnonzero(path[:, level] != own)
        c = path[rows, level]
        np.maximum.at(radius[:, level], c, distance(np.einsum("ij,ij->i", x[rows], x[c])))
    centre_of = path == own[:, None]
    top = np.where(centre_of.any(axis=1), centre_of.argmax(axis=1), depth)
    keys, above = [path[:, 0]], path[:, 0]
    for below in [*path.T[1:], own]:
        keys += [below != above, below]
        above = below
    order = np.lexsort(keys[::-1])
    return order, top[order], radius[order]


class CoverTree:
    """The tree of ``grow`` over vectors in its order. A node of a level covers
    the rows [start, end); its centre is the row ``start``."""

    def __init__(self, x: np.ndarray, top: np.ndarray, radius: np.ndarray):
        self.x, self.single = x, x.astype(np.float32)
        starts = [np.flatnonzero(top <= level) for level in range(len(RADII))] + [np.arange(len(x))]
        self.levels = []  # start, end, covering radius, first child, children
        for level, at in enumerate(starts):
            if level == len(RADII):
                self.levels.append((at, at + 1, np.zeros(len(x)), at, np.zeros(len(x), np.int64)))
                break
            first = np.searchsorted(starts[level + 1], at)
            self.levels.append((at, np.r_[at[1:], len(x)], radius[at, level], first,
                                np.diff(np.r_[first, len(starts[level + 1])])))


def _close_pairs(a: CoverTree, b: CoverTree, level: int, i: np.ndarray, j: np.ndarray,
                 reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of all pairs of the nodes i and j of a level, those that may hold a
    link, by products in single precision with its error as a margin."""
    at, _, ra, _, _ = a.levels[level]
    bt, _, rb, _, _ = b.levels[level]
    margin = (a.x.shape[1] + 8) * 2.0 ** -22
    for j in (j[rb[j] == 0], j[rb[j] > 0]):
        step = max(1, CELLS // max(1, len(j)))
        right = b.single[bt[j]].T
        for k in range(0, len(i) if len(j) else 0, step):
            part = i[k:k + step]
            far = (ra[part] + reach + EPS).astype(np.float32)[:, None]
            if rb[j[0]] > 0:
                far = far + rb[j].astype(np.float32)[None, :]
            p, q = np.divmod(np.flatnonzero(a.single[at[part]] @ right >= 1.0 - margin - far * far / 2), len(j))
            yield part[p], j[q]


def links(a: CoverTree, b: CoverTree, cosine: float) -> Iterator[tuple[np.ndarray, ...]]:
    """All pairs with a product of at least ``cosine``, as arrays of ranges
    (from, to in a; from, to in b): every row of one with every row of the other.

    Both trees are descended together, level by level. A pair of nodes dies
    when its centres are further apart than both covering radii and the
    threshold; it is reported whole when they are so close that all below must
    link; else the children of both meet.
    """
    reach = float(distance(np.float64(cosine)))
    depth = len(a.levels) - 1

    def judge(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        at, ae, ra, fa, na = a.levels[level]
        bt, be, rb, fb, nb = b.levels[level]
        step = max(1, CELLS // a.x.shape[1])
        for k in range(0, len(i), step):
            p, q = i[k:k + step], j[k:k + step]
            dots = np.einsum("ij,ij->i", a.x[at[p]], b.x[bt[q]])
            if level == depth:
                whole = dots >= cosine
            else:
                d, r = distance(dots), ra[p] + rb[q]
                whole = ((d + r + EPS <= reach) & (r > 0)) | ((r == 0) & (dots >= cosine))
            if whole.any():
                yield at[p[whole]], ae[p[whole]], bt[q[whole]], be[q[whole]]
            if level < depth:
                more = ~whole & (r > 0) & (d <= r + reach + EPS)
                yield from children(level, p[more], q[more])

    def children(level: int, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        _, _, _, fa, na = a.levels[level]
        _, _, _, fb, nb = b.levels[level]
        size = na[p] * nb[q]
        for k in np.flatnonzero(size > 1024):
            mine, theirs = (np.arange(f[n], f[n] + m[n]) for f, m, n in ((fa, na, p[k]), (fb, nb, q[k])))
            for i, j in _close_pairs(a, b, level + 1, mine, theirs, reach):
                yield from judge(level + 1, i, j)
        p, q, size = p[size <= 1024], q[size <= 1024], size[size <= 1024]
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // CELLS)) + 1
        for p, q, size in zip(np.split(p, cuts), np.split(q, cuts), np.split(size, cuts)):
            at = ragged(np.zeros(len(p), np.int64), size)
            wide = np.repeat(nb[q], size)
            if len(at):
                yield from judge(level + 1, np.repeat(fa[p], size) + at // wide, np.repeat(fb[q], size) + at % wide)

    for i, j in _close_pairs(a, b, 0, np.arange(len(a.levels[0][0])), np.arange(len(b.levels[0][0])), reach):
        yield from judge(0, i, j)


def _roots(up: np.ndarray) -> np.ndarray:
    while True:
        after = up[up]
        if (after == up).all():
            return up
        up = after


def _join(up: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The forest ``up``, flat, with the trees of every i and j joined under
    the smallest row."""
    up = _roots(up)
    while True:
        lo, hi = np.minimum(up[i], up[j]), np.maximum(up[i], up[j])
        apart = lo != hi
        if not apart.any():
            return up
        i, j = lo[apart], hi[apart]
        up = up.copy()
        np.minimum.at(up, j, i)
        up = _roots(up)


class _Block:
    """One block's own vectors and what its visitors link to."""

    def __init__(self, ids: np.ndarray, weight: np.ndarray, tree: CoverTree, cosine: float):
        self.ids, self.weight, self.tree, self.cosine = ids, weight, tree, cosine
        self.links, self.up = np.zeros(len(ids), np.int64), np.arange(len(ids))
        self.links, _, self.up = self._meet(weight, tree, 0)
        self.links -= weight  # each with itself

    def _meet(self, weight: np.ndarray, tree: CoverTree, base: int) -> tuple[np.ndarray, ...]:
        """Links of the rows of ``tree``, of the own rows, and the forest over
        own rows and, from ``base`` on, those."""
        up = np.r_[self.up, np.arange(base, base + len(weight))] if base else self.up
        mine, theirs = np.zeros(len(self.ids) + 1, np.int64), np.zeros(len(weight) + 1, np.int64)
        total, visit = np.r_[0, np.cumsum(self.weight)], np.r_[0, np.cumsum(weight)]
        for i0, i1, j0, j1 in links(tree, self.tree, self.cosine):
            for at, n, ends in ((theirs, total[j1] - total[j0], (i0, i1)), (mine, visit[i1] - visit[i0], (j0, j1))):
                np.add.at(at, ends[0], n)
                np.add.at(at, ends[1], -n)
            # a range whose rows share a partner is one class
            pairs = [(base + i0, j0)]
            for shift, lo, hi in ((base, i0, i1), (0, j0, j1)):
                wide = np.unique(np.stack([lo, hi])[:, hi - lo > 1], axis=1)
                rest = ragged(wide[0], wide[1] - wide[0])
                pairs.append((shift + rest, shift + np.repeat(wide[0], wide[1] - wide[0])))
            up = _join(up, *(np.concatenate(c) for c in zip(*pairs)))
        return np.cumsum(theirs)[:-1], np.cumsum(mine)[:-1], up

    def visit(self, ids: np.ndarray, weight: np.ndarray, tree: CoverTree) -> tuple[np.ndarray, ...]:
        """id, links, root of the visitors that link to own rows."""
        n = len(self.ids)
        theirs, mine, up = self._meet(weight, tree, n)
        self.links += mine
        self.up = up[:n]  # roots are the smallest rows, so own ones
        p = np.flatnonzero(theirs)
        return ids[p], theirs[p], self.ids[up[n + p]]

    def close(self) -> tuple[np.ndarray, ...]:
        p = np.flatnonzero(self.links)
        return self.ids[p], self.links[p], self.ids[self.up[p]]


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in col), np.float64).reshape(len(col), dim)


def _units(dim: int) -> Callable:
    """Unit vectors in double precision; shorter ones are filled up with
    zeros; null unless all components are finite and one is not zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("embedding"):
                v = v.as_py()
                x = np.zeros(dim)
                if v is not None and None not in v:
                    x[:len(v)] = v
                top = np.abs(x).max(initial=0.0)
                if not np.isfinite(top) or not top:
                    out.append(None)
                    continue
                x /= top
                out.append((x / np.sqrt((x * x).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("n"), pa.array(out, pa.binary())],
                                             names=["rep", "n", "unit"])
    return run


def pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the furthest from those before: nested nets."""
    if not len(x):
        return x
    picked, d = [0], distance(x @ x[0])
    while len(picked) < min(n, len(x)):
        k = int(d.argmax())
        if d[k] <= EPS:
            break
        picked.append(k)
        d = np.minimum(d, distance(x @ x[k]))
    return x[picked]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """The rows of sorted batches by runs of equal keys, each as one batch."""
    at, held = None, []
    for b in batches:
        key = np.stack([b.column(k).to_numpy() for k in keys])
        cut = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if b.num_rows else []
        for i, j in zip(cut, [*cut[1:], b.num_rows]):
            here = tuple(key[:, i].tolist())
            if here != at:
                if held:
                    yield at, pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                at, held = here, []
            held.append(b.slice(i, j - i))
    if held:
        yield at, pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def near_duplicates(df: DataFrame, cosine: float = 0.9, id_col: str = "vec_id",
                    vec_col: str = "embedding", block: int = 4096, sample: int = 8192,
                    max_cells: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    1. Equal vectors become one row with a count (its least id stands for it).
    2. The top of the tree, at most ``max_cells`` centres by farthest-first
       traversal of a sample of about ``sample`` vectors, cuts the space into
       cells; every vector goes to its nearest centre, once, and the covering
       radius of each cell is taken over all its vectors. Cells are split into
       blocks of about ``block`` vectors.
    3. A cover tree is grown over each block, once. Of two blocks, the nodes
       of one visit the other, but only those whose covering radius and the
       threshold reach the covering radius of its cell. A task holds one block
       and one visiting block at a time.
    4. In a task, both trees are traversed together; only link counts and a
       spanning set of links leave it.
    5. Links become components in Spark.

    The sample only shapes cells; every pair at or above ``cosine`` is found.
    Vectors that are null, zero, or hold null or non-finite components link
    with nothing; shorter vectors are filled up with zeros. Rows without an id
    link with nothing and have no component. Repeated rows are copies that
    link with each other. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    equal = (rows.where("vec_id is not null and embedding is not null").groupBy("embedding")
             .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    dim = rows.agg(F.max(F.size("embedding"))).first()[0]
    dim = max(1, dim or 1)
    units = stage(equal.repartition("rep").mapInArrow(_units(dim), "rep long, n long, unit binary")
                  .where("unit is not null"), "units")
    total = units.count()
    drawn = units.where(F.pmod(F.xxhash64("rep"), F.lit(max(1, total))) < sample).select("rep", "unit").collect()
    drawn.sort(key=lambda r: r["rep"])
    points = np.frombuffer(b"".join(bytes(r["unit"]) for r in drawn), np.float64).reshape(-1, dim)
    top = pivots(points, min(max_cells, -(-total // block)))
    if not len(top):  # few vectors and an empty draw: one cell around an axis
        top = np.eye(1, dim)

    spark = df.sparkSession.sparkContext
    centre = spark.broadcast(top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                dots = _vectors(b.column("unit"), dim) @ centre.value.T
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(dots.argmax(axis=1)), pa.array(distance(dots.max(axis=1)))],
                    names=["rep", "n", "unit", "cell", "d"])

    placed = stage(units.mapInArrow(assign, "rep long, n long, unit binary, cell long, d double"), "vector-cells")
    stats = placed.groupBy("cell").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).collect()  # max_cells rows
    radius, blocks = np.full(len(top), -1.0), np.zeros(len(top), np.int64)
    for s in stats:
        radius[s["cell"]], blocks[s["cell"]] = s["r"], -(-s["n"] // block)
    cells = spark.broadcast((radius, blocks, np.cumsum(blocks) - blocks))
    reach = float(distance(np.float64(cosine))) + EPS

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, blocks, first = cells.value
        for b in batches:
            cell = b.column("cell").to_numpy()
            home = first[cell] + b.column("salt").to_numpy() % np.maximum(1, blocks[cell])
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(cell), *b.select(["rep", "n", "unit"]).columns],
                                             names=["home", "cell", "rep", "n", "unit"])

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius, blocks, first = cells.value
        for (home, cell), t in _runs(batches, ["home", "cell"]):
            x = _vectors(t.column("unit"), dim)
            order, top, covering = grow(x)
            x, t = x[order], t.select(["rep", "n", "unit"]).take(pa.array(order))
            start = np.flatnonzero(top == 0)
            apart = distance(x[start] @ centre.value.T)
            near = (apart <= radius + covering[start, :1] + reach) & (radius >= 0)
            near[:, cell] = True
            size = np.diff(np.r_[start, len(x)])
            for c in np.flatnonzero(near.any(axis=0)):
                to = np.arange(first[c], first[c] + blocks[c])
                to = to[(to == home) | ((to > home) ^ ((to + home) % 2 == 1))]
                row = ragged(start[near[:, c]], size[near[:, c]])
                part = t.take(pa.array(row))
                radii = pa.array([r.tobytes() for r in covering[row]], pa.binary())
                for k in to.tolist():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), k)), pa.array(np.full(len(row), -1 if k == home else home)),
                         pa.array(row), pa.array(top[row].astype(np.int32)), radii, *part.columns],
                        names=["block", "visitor", "pos", "top", "radii", "rep", "n", "unit"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, current = None, None

        def batch(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["id", "links", "root"])

        for (key, visitor), t in _runs(batches, ["block", "visitor"]):
            tree = CoverTree(_vectors(t.column("unit"), dim), t.column("top").to_numpy(),
                             np.frombuffer(b"".join(v.as_py() for v in t.column("radii")), np.float64)
                             .reshape(t.num_rows, len(RADII)))
            ids, n = t.column("rep").to_numpy(), t.column("n").to_numpy()
            if visitor < 0:  # sorted first: every block that is visited has rows
                if current:
                    yield batch(current.close())
                at, current = key, _Block(ids, n, tree, cosine)
            elif key == at:
                yield batch(current.visit(ids, n, tree))
        if current:
            yield batch(current.close())

    trees = (placed.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "rep"), F.lit(1 << 30)))
             .mapInArrow(settle, "home long, cell long, rep long, n long, unit binary")
             .repartition("home").sortWithinPartitions("home", "rep")
             .mapInArrow(plant, "block long, visitor long, pos long, top int, radii binary, "
                                "rep long, n long, unit binary"))
    found = stage(trees.repartition("block").sortWithinPartitions("block", "visitor", "pos")
                  .mapInArrow(link, "id long, links long, root long"), "vector-links")
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = equal.join(units.select("rep"), "rep").join(linked, F.col("rep") == F.col("id"), "left").drop("id") \
        .join(group, F.col("rep") == F.col("node"), "left") \
        .select("embedding", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                F.coalesce("component", "rep").alias("component"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return rows.join(classes, "embedding", "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
