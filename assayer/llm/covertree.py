"""All pairs of vectors within a cosine, by balls of cover trees in cells around pivots.

On unit vectors, cosine >= c is distance <= limit = sqrt(2 - 2 c), so that the
triangle inequality holds.  Each vector goes to the cell of its nearest pivot.
A cell is cut into blocks of bounded size; near copies in a block are balls, so
narrow that all members link, each with a cover tree of its own: nested levels
of centres with halving radii, each node with the true radius that covers what
is below it.  Any other vector is a ball alone.

For x in cell p and y in cell q, (x - y)(p - q) is at most |x - y| |p - q|, and
it is the sum of x's gap (x p - x q) and y's gap (y q - y p).  So, of two that
link, one has a gap of at most half of limit |p - q|: it visits the other's
cell.  A visitor is compared with the residents of a cell by some coordinates
and the length of the rest, which bound the cosine from above; what is left is
compared in full.  A pair of balls whose nearest points are too far apart is
pruned, one whose farthest points are near enough is accepted whole, any other
is traversed down both trees, to leaves that are compared point by point.

Whole cells are put together into chunks, written once; each pair of chunks is
a task that reads the two from there, so that the vectors are shuffled once,
however many chunks they are compared with.  What leaves a task is a count and
one link for each ball, and counts for the points of balls that were opened,
never the pairs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import BUCKETS, cut, ship

COSINE = 0.9
#: Vectors in a block, about; a cell with more is cut into several blocks.
BLOCK = 4096
#: Pivots, taken from the vectors themselves by a hash, about, at most.
PIVOTS = 65536
#: Bytes of the vectors in a chunk, about; small tables have chunks of at least so many vectors.
CHUNK, LEAST = 16 << 20, 2048
#: Rows that say which cells are large, about.
SAMPLE = 20_000
#: Coordinates that are compared before the others.
FIRST = 24
#: Members that a ball has at least, and the radius up to which two do.
MEMBERS, TIGHT = 8, 0.01
LEAF = 64
#: A node is opened into centres only if they are at most this share of its points.
SPREAD = 1 / 8
MARGIN = 1e-9
#: The same for sums of products of single precision.
SINGLE = 1e-5
#: Products of vectors and cells at once, and the visitors and residents that are compared at once.
TILE = 1 << 22
GUESTS, HELD = 4096, 1024
#: What a task gets at once to find the nearest pivots.
ROWS = 1 << 22
HALF = 2**0.5


def limit_of(cosine: float) -> float:
    return float(np.sqrt(2 - 2 * cosine))


@dataclass
class Node:
    """Points ``start`` to ``stop`` of a block's order, all within ``radius`` of ``centre``."""

    centre: int
    radius: float
    start: int
    stop: int
    children: list[Node] = field(default_factory=list)


def build(points: np.ndarray) -> tuple[np.ndarray, Node]:
    """(order of the points, root) of the cover tree over unit vectors; each node's points are together."""

    order: list[int] = []

    def grow(rows: np.ndarray, centre: int, reach: float) -> Node:
        away = np.sqrt(np.maximum(0, 2 - 2 * (points[rows] @ points[centre])))
        node = Node(centre, float(away.max(initial=0)) + MARGIN, len(order), len(order) + len(rows))
        groups, rest = [], rows
        reach /= 2
        while node.radius < reach:  # levels that hold the centre alone
            reach /= 2
        if len(rows) > LEAF and reach > 1e-3:
            at = centre
            while len(rest) and len(groups) <= SPREAD * len(rows):
                near = 2 - 2 * (points[rest] @ points[at]) <= reach * reach
                near |= rest == at
                groups.append((rest[near], at))
                rest = rest[~near]
                at = rest[0] if len(rest) else -1
        if len(groups) < 2 or len(rest) == len(rows):
            order.extend(rows.tolist())
            return node
        # Centres that stay single have no structure to use: they and what is left are one leaf.
        loose = [g for g, _ in groups if len(g) == 1] + [rest]
        node.children = [grow(g, c, reach) for g, c in groups if len(g) > 1]
        single = np.concatenate(loose)
        if not node.children:
            order.extend(rows.tolist())
        elif len(single):
            start = len(order)
            order.extend(single.tolist())
            away = np.sqrt(np.maximum(0, 2 - 2 * (points[single] @ points[centre])))
            node.children.append(Node(centre, float(away.max()) + MARGIN, start, start + len(single)))
        return node

    root = grow(np.arange(len(points)), 0, 4.0)
    return np.array(order, np.int64), root


class Links:
    """Counts of the links between two balls' points."""

    def __init__(self, left: int, right: int) -> None:
        self.left, self.right = np.zeros(left, np.int64), np.zeros(right, np.int64)

    def whole(self, a: Node, b: Node) -> None:
        """Every point of one node links with every point of the other."""
        self.left[a.start : a.stop] += b.stop - b.start
        self.right[b.start : b.stop] += a.stop - a.start

    def some(self, linked: np.ndarray, left: int, right: int) -> None:
        """Links by a table of rows from ``left`` and columns from ``right``."""
        self.left[left : left + linked.shape[0]] += linked.sum(axis=1)
        self.right[right : right + linked.shape[1]] += linked.sum(axis=0)


def traverse(a: Node, b: Node, left: np.ndarray, right: np.ndarray, links: Links, cosine: float) -> None:
    """Find all links between the points of two trees."""
    limit = limit_of(cosine)
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        away = float(np.sqrt(max(0.0, 2 - 2 * left[a.centre] @ right[b.centre])))
        if away - a.radius - b.radius > limit + MARGIN:
            continue
        if away + a.radius + b.radius < limit - MARGIN:
            links.whole(a, b)
        elif a.children and (a.radius >= b.radius or not b.children):
            stack += [(x, b) for x in a.children]
        elif b.children:
            stack += [(a, x) for x in b.children]
        else:
            for at in range(a.start, a.stop, 1024):
                end = min(at + 1024, a.stop)
                links.some(left[at:end] @ right[b.start : b.stop].T >= cosine, at, b.start)


def balls(points: np.ndarray, limit: float) -> list[np.ndarray]:
    """Places of each ball's members among unit vectors, the centre first; each place is in one ball."""
    single = points.astype(np.float32)
    cosines = single @ single.T
    free, found = np.ones(len(points), bool), []
    for reach, least in ((limit / 4, MEMBERS), (min(TIGHT, limit / 4), 2)):
        near = cosines >= 1 - reach * reach / 2
        many = np.where(free, (near & free).sum(axis=1), 0)
        if many.max(initial=0) < least:
            continue
        for at in np.argsort(-many, kind="stable"):
            if many[at] < least:
                break
            members = np.flatnonzero(near[at] & free) if free[at] else []
            if len(members) >= least and 2 * _radius(points[members], points[at]) < limit - MARGIN:
                free[members] = False
                found.append(np.r_[at, members[members != at]])
    return found + [np.array([x]) for x in np.flatnonzero(free)]


def _radius(points: np.ndarray, centre: np.ndarray) -> float:
    return float(np.sqrt(np.maximum(0, 2 - 2 * (points @ centre))).max()) + MARGIN


def _rows(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the places of the valid vectors and their components: no nulls, finite, not all zero."""
    values = vectors.values
    values = values if pa.types.is_floating(values.type) else values.cast(pa.float64())
    values, starts = values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    lengths = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        rows = values[starts[at][:, None] + np.arange(length)]
        good = np.isfinite(rows).all(axis=1) & rows.any(axis=1)
        yield at[good], rows[good]


def _units(rows: np.ndarray) -> np.ndarray:
    """Unit vectors of doubles."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _pivots(vectors: DataFrame, total: int) -> dict[int, np.ndarray]:
    """Different vectors by a hash, as units, by their length; a length without any has one cell around zero."""
    some = min(PIVOTS, int(0.3 * total**0.75) + 1)
    dealt = F.pmod(F.xxhash64("embedding"), F.lit(max(total, 1)))
    sample = vectors.select("embedding").filter(F.col("embedding").isNotNull() & (dealt < some)).distinct()
    found: dict[int, list] = {}
    for part in sample.toArrow().column(0).chunks:
        for _, rows in _rows(part):
            if len(rows):
                found.setdefault(rows.shape[1], []).append(_units(rows).astype(np.float32))
    return {dim: np.unique(np.concatenate(units), axis=0) for dim, units in found.items()}


def _first(dim: int, pivots: np.ndarray | None) -> np.ndarray:
    """Orthonormal columns: the axes along which the pivots are longest."""
    if dim <= FIRST or pivots is None:
        return np.eye(dim)[:, :FIRST]
    pivots = pivots.astype(np.float64)
    return np.linalg.eigh(pivots.T @ pivots)[1][:, -FIRST:]


def _celled(
    numbered: DataFrame, pivots: dict[int, np.ndarray], parts: dict[tuple[int, int], int], kind: str
) -> DataFrame:
    """(rid, vec_id, dim, cell, part, vector): the cell is the nearest pivot of the same length; dim 0 if not valid."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cells = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            raw: list[bytes | None] = [None] * batch.num_rows
            for at, rows in _rows(batch.column(2)):
                dims[at] = dim = rows.shape[1]
                if dim in pivots:
                    units, step = _units(rows).astype(np.float32), max(1, ROWS // len(pivots[dim]))
                    for k in range(0, len(at), step):
                        cells[at[k : k + step]] = (units[k : k + step] @ pivots[dim].T).argmax(axis=1)
                for i, row in zip(at.tolist(), rows.astype(kind)):
                    raw[i] = row.tobytes()
            many = [parts.get(x, 1) if x[0] else BUCKETS for x in zip(dims.tolist(), cells.tolist())]
            mixed = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
            part = (mixed % np.array(many, np.uint64)).astype(np.int32)
            arrays = [pa.array(dims), pa.array(cells), pa.array(part), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], schema.names)

    schema = numbered.select("rid", "vec_id").schema
    for name in ("dim", "cell", "part"):
        schema = schema.add(name, T.IntegerType())
    schema = schema.add("vector", T.BinaryType())
    return numbered.select("rid", "vec_id", "embedding").mapInArrow(work, schema)


def _dealing(
    vectors: DataFrame, pivots: dict[int, np.ndarray], total: int, kind: str
) -> tuple[dict[tuple[int, int], int], int]:
    """How many parts the large cells are dealt in, and how many chunks there are, by a sample of the rows."""
    some = vectors.sample(SAMPLE / total, seed=1) if total > SAMPLE else vectors
    some = some.select(F.lit(0).cast("bigint").alias("rid"), "vec_id", "embedding")
    cells = _celled(some, pivots, {}, kind).groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    times = total / max(1, sum(r.n for r in cells))
    size = times * sum(r.n * r.dim for r in cells) * np.dtype(kind).itemsize
    chunks = max(1, int(-(-size // CHUNK)), min(8, total // LEAST))
    most = max(1, total // chunks // 8)
    return {(r.dim, r.cell): int(-(-r.n * times // most)) for r in cells if r.dim and r.n * times > most}, chunks


def _placed(node: Node, order: np.ndarray) -> Node:
    """The same tree, with centres as places in the order."""
    place = np.empty_like(order)
    place[order] = np.arange(len(order))

    def move(node: Node) -> Node:
        return Node(int(place[node.centre]), node.radius, node.start, node.stop, [move(c) for c in node.children])

    return move(node)


@dataclass
class Side:
    """A chunk's vectors of one length: points in balls, balls in cells, each together."""

    dim: int
    cells: np.ndarray
    #: The cells' pivots; a cell's balls are from its edge to the next one, a ball's points from its bound to the next.
    pivots: np.ndarray
    edges: np.ndarray
    bounds: np.ndarray
    radius: np.ndarray
    centre: np.ndarray
    rids: np.ndarray
    trees: dict[int, Node]
    rows: np.ndarray | None = None

    @staticmethod
    def of(
        rids: np.ndarray, cells: np.ndarray, rows: np.ndarray, pivots: np.ndarray | None, limit: float, block: int
    ) -> Side:
        """``rows`` are in the order of cells."""
        order, lengths, radius, centre, trees, owner = [], [], [], [], {}, []
        ends = np.flatnonzero(np.diff(cells)) + 1
        cuts = [x for a, b in zip([0, *ends], [*ends, len(cells)]) for x in range(a, b, block)]
        for start, stop in zip(cuts, [*cuts[1:], len(cells)]):
            points = _units(rows[start:stop])
            for ball in balls(points, limit):
                own = points[ball]
                radius.append(_radius(own, own[0]) if len(ball) > 1 else 0.0)
                at = 0
                if len(ball) > LEAF:
                    placed, root = build(own)
                    trees[len(lengths)] = root = _placed(root, placed)
                    ball, at = ball[placed], root.centre
                centre.append(at)
                lengths.append(len(ball))
                order.append(ball + start)
                owner.append(cells[start])
        bounds, owner = np.r_[0, np.cumsum(lengths)].astype(np.int32), np.array(owner)
        order = np.concatenate(order)
        begin = np.flatnonzero(np.r_[True, np.diff(owner) != 0])
        cells = owner[begin]
        dim = rows.shape[1]
        held = np.zeros((len(cells), dim), np.float32) if pivots is None else pivots[cells]
        centre = bounds[:-1] + np.array(centre, np.int32)
        edges = np.r_[begin, len(owner)]
        return Side(dim, cells, held, edges, bounds, np.array(radius), centre, rids[order], trees, rows[order])

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def units(self, balls: np.ndarray) -> np.ndarray:
        return _units(self.rows[self.centre[balls]])

    def node(self, ball: int) -> tuple[Node, np.ndarray]:
        """A ball's tree, and its points."""
        start, stop = self.bounds[ball], self.bounds[ball + 1]
        leaf = Node(int(self.centre[ball] - start), float(self.radius[ball]), 0, int(stop - start))
        return self.trees.get(ball, leaf), _units(self.rows[start:stop])


def _chunks(
    celled: DataFrame, pivots: dict[int, np.ndarray], count: int, cosine: float, block: int, kind: str
) -> DataFrame:
    """(meta, vectors, names): a row for each chunk, the sides of its lengths pickled, their vectors, all rows' ids."""
    limit = limit_of(cosine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [x for x in batches if x.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).combine_chunks()
        del found
        names = pa.BufferOutputStream()
        with pa.ipc.new_stream(names, table.select([0, 1]).schema) as out:
            out.write_table(table.select([0, 1]))
        rids, dims, cells = (table.column(c).to_numpy() for c in (0, 2, 3))
        order = np.lexsort((rids, cells, dims))
        sides, vectors = [], []
        for dim in np.unique(dims[dims > 0]):
            at = order[dims[order] == dim]
            raw = b"".join(table.column(5).take(pa.array(at)).to_pylist())
            rows = np.frombuffer(raw, kind).reshape(-1, dim)
            side = Side.of(rids[at], cells[at], rows, pivots.get(int(dim)), limit, block)
            vectors.append(side.rows.tobytes())
            side.rows = None
            sides.append(side)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([pickle.dumps(sides)], pa.binary()),
                pa.array([b"".join(vectors)], pa.binary()),
                pa.array([names.getvalue().to_pybytes()], pa.binary()),
            ],
            ["meta", "vectors", "names"],
        )

    dealt = celled.repartition(count, "dim", "cell", "part").coalesce(count)
    return dealt.mapInArrow(work, "meta binary, vectors binary, names binary")


def _sides(meta: pa.Scalar, vectors: pa.Scalar, kind: str) -> dict[int, Side]:
    sides, raw, at = pickle.loads(meta.as_buffer()), np.frombuffer(vectors.as_buffer(), kind), 0
    for side in sides:
        size = len(side.rids) * side.dim
        side.rows = raw[at : at + size].reshape(-1, side.dim)
        at += size
    return {side.dim: side for side in sides}


class Parts:
    """What is linked, as labels: alike if connected."""

    def __init__(self, count: int) -> None:
        self.label = np.arange(count)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            one, other = self.label[a], self.label[b]
            apart = one != other
            a, b, one, other = a[apart], b[apart], one[apart], other[apart]
            np.minimum.at(self.label, np.maximum(one, other), np.minimum(one, other))
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped


class Visits:
    """One side's balls visit the other side's cells."""

    def __init__(self, one: Side, two: Side, cosine: float, first: np.ndarray) -> None:
        self.one, self.two, self.cosine, self.limit = one, two, cosine, limit_of(cosine)
        self.same = one.rids[0] == two.rids[0]
        left, right = len(one.radius), len(two.radius)
        self.offset = 0 if self.same else left
        self.parts = Parts(self.offset + right)
        self.counts = np.zeros(self.offset + right, np.int64)
        self.points: list[tuple[np.ndarray, np.ndarray]] = []
        self.products, self.flags = np.empty(GUESTS * HELD, np.float32), np.zeros(GUESTS * HELD, bool)
        self.cell = [np.repeat(np.arange(len(s.cells)), np.diff(s.edges)) for s in (one, two)]
        # By the bound z w <= (first coordinates) + (lengths of the rest), and what the radii r and s add to the limit:
        # z w + r s + (r r / 2 + limit r) + (s s / 2 + limit s) >= cosine.
        self.unit, self.probe = self._bounds(one, first, visitor=True)
        self.other, self.held = self._bounds(two, first, visitor=False)

    def _bounds(self, side: Side, first: np.ndarray, visitor: bool) -> tuple[np.ndarray, np.ndarray]:
        count, some = len(side.radius), first.shape[1]
        units, bounds = np.empty((count, side.dim), np.float32), np.empty((count, some + 4), np.float32)
        for at in range(0, count, 1 << 14):
            own = slice(at, at + (1 << 14))
            exact = side.units(np.arange(count)[own])
            units[own] = exact
            bounds[own, :some] = near = exact @ first
            bounds[own, some] = np.sqrt(np.maximum(0, 1 - (near * near).sum(axis=1)))
        bounds[:, some + 1] = side.radius
        more = side.radius * side.radius / 2 + self.limit * side.radius
        bounds[:, some + 2], bounds[:, some + 3] = (more, 1) if visitor else (1, more)
        return units, bounds

    def run(self) -> None:
        one, two = self.one, self.two
        pivots = np.c_[two.pivots, np.ones(len(two.pivots), np.float32)]
        step = max(64, TILE // len(pivots))
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for at in range(0, len(one.radius), step):
            # z visits q from p if z p - z q <= h |p - q| with h = limit / 2 + r; the norm is at most
            # sqrt(2) - p q / sqrt(2), so if (z - h p / sqrt(2)) q >= z p - sqrt(2) h.
            units, home = self.unit[at : at + step], one.pivots[self.cell[0][at : at + step]]
            reach = (self.limit / 2 + one.radius[at : at + step]).astype(np.float32)
            least = (units * home).sum(axis=1) - HALF * reach
            moved = np.c_[units - (reach / HALF)[:, None] * home, -least].astype(np.float32)
            visits = pivots @ moved.T >= -SINGLE
            for q in range(len(pivots)):
                guests = np.flatnonzero(visits[q])
                for k in range(0, len(guests), GUESTS):
                    some = guests[k : k + GUESTS] + at
                    probe = self.probe.take(some, axis=0)
                    for start in range(two.edges[q], two.edges[q + 1], HELD):
                        held = self.held[start : min(start + HELD, two.edges[q + 1])]
                        hits = self._hits(probe, held)
                        if len(hits):
                            z, w = np.divmod(hits, len(held))
                            pending.append((some[z], w + start))
                            waiting += len(z)
                    if waiting > 1 << 17:
                        self._full(pending)
                        waiting = 0
        self._full(pending)

    def _hits(self, probe: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Places, row by row, of the products that reach the cosine; eight of them are looked at as one."""
        shape, size = (len(probe), len(held)), len(probe) * len(held)
        table = np.matmul(probe, held.T, out=self.products[:size].reshape(shape))
        flags = self.flags[: -(-size // 8) * 8]
        flags[size:] = False
        np.greater_equal(table, self.cosine - SINGLE, out=flags[:size].reshape(shape))
        words = np.flatnonzero(flags.view(np.uint64))
        if not len(words):
            return words
        word, bit = np.nonzero(flags.reshape(-1, 8)[words])
        return words[word] * 8 + bit

    def _full(self, pending: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Compare the balls of pairs that may be near enough; empties the list."""
        if not pending:
            return
        every, all_others = (np.concatenate(x) for x in zip(*pending))
        pending.clear()
        for at in range(0, len(every), 1 << 17):
            z, w = every[at : at + (1 << 17)], all_others[at : at + (1 << 17)]
            away = np.einsum("ij,ij->i", self.unit.take(z, axis=0), self.other.take(w, axis=0))
            far = self.limit + self.one.radius[z] + self.two.radius[w]
            near = away >= 1 - far * far / 2 - SINGLE
            if near.any():
                self._pairs(z[near], w[near])

    def _pairs(self, z: np.ndarray, w: np.ndarray) -> None:
        one, two = self.one, self.two
        u, v = one.units(z), two.units(w)
        p, q = (s.pivots[c[x]].astype(np.float64) for s, c, x in ((one, self.cell[0], z), (two, self.cell[1], w)))
        # Of two that both visit, the one with the smaller gap is counted; both tasks get the same numbers.
        norm = HALF - (p * q).sum(axis=1) / HALF
        gap = ((p - q) * u).sum(axis=1) - one.radius[z] * norm
        back = ((q - p) * v).sum(axis=1) - two.radius[w] * norm
        ids = one.rids[one.centre[z]] < two.rids[two.centre[w]]
        mine = (gap < back) | ((gap == back) & ids)
        z, w = z[mine], w[mine]
        cosines = (u[mine] * v[mine]).sum(axis=1)
        away, wide = np.sqrt(np.maximum(0, 2 - 2 * cosines)), one.radius[z] + two.radius[w]
        alone = (one.sizes[z] == 1) & (two.sizes[w] == 1)
        whole = np.where(alone, cosines >= self.cosine, away + wide < self.limit - MARGIN)
        np.add.at(self.counts, z[whole], two.sizes[w[whole]])
        np.add.at(self.counts, w[whole] + self.offset, one.sizes[z[whole]])
        linked = whole.copy()
        for k in np.flatnonzero(~alone & ~whole & (away - wide <= self.limit + MARGIN)):
            (a, left), (b, right) = one.node(z[k]), two.node(w[k])
            links = Links(len(left), len(right))
            traverse(a, b, left, right, links, self.cosine)
            linked[k] = links.left.any()
            for side, ball, counts in ((one, z[k], links.left), (two, w[k], links.right)):
                at = np.flatnonzero(counts)
                self.points.append((side.rids[side.bounds[ball] + at], counts[at]))
        self.parts.link(z[linked], w[linked] + self.offset)

    def found(self) -> pa.RecordBatch:
        """(rid, n, root, ball): links of each member of a ball, or of one point, and what the ball is connected with."""
        ids = [s.rids[s.centre] for s in ((self.two,) if self.same else (self.one, self.two))]
        sizes = [s.sizes for s in ((self.two,) if self.same else (self.one, self.two))]
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        label = self.parts.label
        at = np.flatnonzero((self.counts > 0) | (label != np.arange(len(label))))
        more = np.concatenate([x for x, _ in self.points]) if self.points else ids[:0]
        counts = np.concatenate([n for _, n in self.points]) if self.points else self.counts[:0]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[ids[at], more]),
                pa.array(np.r_[self.counts[at], counts]),
                pa.array(np.r_[ids[label[at]], more]),
                pa.array(np.r_[sizes[at] > 1, np.zeros(len(more), bool)]),
            ],
            ["rid", "n", "root", "ball"],
        )


def _found(chunks: DataFrame, pivots: dict[int, np.ndarray], count: int, cosine: float, kind: str) -> DataFrame:
    """(rid, n, root, ball): what each pair of ``count`` chunks has of links; see Visits.found."""
    first = {dim: _first(dim, units) for dim, units in pivots.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                left, right = _sides(row[0], row[1], kind), _sides(row[2], row[3], kind)
                for dim in left.keys() & right.keys():
                    axes = first[dim] if dim in first else _first(dim, None)
                    visits = Visits(left[dim], right[dim], cosine, axes)
                    visits.run()
                    yield visits.found()

    one = chunks.select(F.col("meta").alias("one"), F.col("vectors").alias("left"))
    two = chunks.select(F.col("meta").alias("two"), F.col("vectors").alias("right"))
    pairs = one.crossJoin(two.hint("shuffle_replicate_nl"))
    found = pairs.mapInArrow(work, "rid bigint, n bigint, root bigint, ball boolean")
    return found.coalesce(8 * count)  # a task takes pair after pair, so that tasks and files don't grow with the pairs


def _members(chunks: DataFrame) -> DataFrame:
    """(rid, centre, others): the members of balls, without those that are alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for meta in batch.column(0):
                for side in pickle.loads(meta.as_buffer()):
                    many = np.repeat(side.sizes, side.sizes)
                    at = np.flatnonzero(many > 1)
                    centres = np.repeat(side.rids[side.centre], side.sizes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(side.rids[at]), pa.array(centres[at]), pa.array(many[at] - 1, pa.int64())],
                        ["rid", "centre", "others"],
                    )

    return chunks.select("meta").mapInArrow(work, "rid bigint, centre bigint, others bigint")


def _names(chunks: DataFrame, schema: T.StructType) -> DataFrame:
    """(rid, vec_id) of all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names in batch.column(0):
                yield from pa.ipc.open_stream(names.as_buffer())

    return chunks.select("names").mapInArrow(work, schema)


def near_copies(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Rows that are null, zero, or hold a null or non-finite component link with
    nothing; nor do vectors of different lengths.  Repeated rows are vectors
    of their own, so with equal ids each counts the other, and both are kept
    if they are the first.  A row without an id takes the smallest id it is
    connected with, or null.
    """
    ship(vectors.sparkSession)
    element = vectors.schema["embedding"].dataType.elementType
    kind = "f4" if isinstance(element, T.FloatType) else "f8"
    total = vectors.count()
    pivots = _pivots(vectors, total)
    parts, count = _dealing(vectors, pivots, total, kind)
    numbered = vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "embedding")
    chunks = cut(_chunks(_celled(numbered, pivots, parts, kind), pivots, count, cosine, block, kind))
    members, found = cut(_members(chunks)), cut(_found(chunks, pivots, count, cosine, kind))
    names = cut(_names(chunks, numbered.select("rid", "vec_id").schema))
    per = found.groupBy("rid", "ball").agg(F.sum("n").alias("n"))
    whole = per.filter("ball").select(F.col("rid").alias("of"), "n")
    counts = per.filter("NOT ball").select("rid", "n").union(members.select("rid", "others"))
    counts = counts.union(members.join(whole, F.col("centre") == F.col("of")).select("rid", "n"))
    counts = counts.groupBy(F.col("rid").alias("counted")).agg(F.sum("n").alias("n_links"))
    roots = components(found.select("rid", "root").union(members.select("rid", "centre")))
    named = names.join(counts, F.col("rid") == F.col("counted"), "left")
    placed = named.join(roots, F.col("rid") == F.col("node"), "left").withColumn(
        "place", F.coalesce("component", "rid")
    )
    least = placed.groupBy("place").agg(F.min("vec_id").alias("component_id")).withColumnRenamed("place", "_place")
    return placed.join(least, F.col("place") == F.col("_place")).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
