"""Random forest on quantile-binned columns, grown on all rows by passes and by shuffled subtrees.

Rows are binned once and go in even blocks, as in boosting. Large nodes are split level by level, all
trees in a pass: tasks count positives and negatives by node, column and bin, and the counts are
added up by tree before the best cuts are taken on the executors. These tables grow with the nodes and
not with the rows. The rows that a tree draws are found once and go on with their nodes, level by level, in files of
the executor's scratch folder, until their node is a leaf; where these are not found, the rows are drawn again. Where a node's rows are fewer bytes than the tables its subtree would need, they are
shuffled once, in bundles of at most ``LOCAL_ROWS`` rows of one tree, and the whole subtree is grown
where they arrive. Both ways give the same tree. The driver holds node arrays, bounded by trees and depth.

How often a tree draws a row (Poisson, mean one) is told by a hash of the row's id and the tree, the
columns of a node by a hash of its place in the tree. So no partitioning changes a forest, its
first k trees are a forest of k trees, and its trees cut at a depth are those of that maximum depth.

Cuts lower the Gini impurity most; a node without a cut that lowers it stays a leaf. A missing value
goes with the largest ones. Without rows every score is zero.
"""

from __future__ import annotations

import base64
import io
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import ledgersift.ml as package
from ledgersift.ml.boosting import LocalParts, _file, _Written, binned, quantile_edges, store_binned

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

#: Rows of a bundle of subtrees, at most, and bytes of one of them.
LOCAL_ROWS, ROW_BYTES = 262_144, 20
#: Rows shuffled for subtrees in one job, and in one of its partitions; also the rows of trees that grow together.
JOB_ROWS, PART_ROWS = 100_000_000, 2_000_000
#: Counts of a task in one pass, and of one entry of its output.
PASS_CELLS, ENTRY_CELLS = 8_000_000, 500_000
#: Counts of the nodes that a bundle cuts at once.
LOCAL_CELLS = 500_000
#: Rows that a task gathers before it sends them to their bundles.
SENT_ROWS = 500_000


@dataclass
class ForestTree:
    """Node ``i`` sends bins above ``cut[i]`` of a column to ``child[i] + 1``, the others to ``child[i]``.

    Leaves have column -1; ``value`` is the share of positives among a node's drawn rows.
    """

    column: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(column, cut, child, value) -> ForestTree:
        return ForestTree(
            np.asarray(column, dtype=np.int16), np.asarray(cut, dtype=np.uint8),
            np.asarray(child, dtype=np.int32), np.asarray(value, dtype=np.float64),
        )

    def places(self, bins: np.ndarray, depth: int, at: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """The node of each row at depth 0, 1 and so on, or so many steps after ``at``; a row stays at its leaf."""
        leaf = self.column < 0  # a leaf leads to itself: no bin is above 255
        column = np.where(leaf, 0, self.column).astype(np.int64)
        cut = np.where(leaf, 255, self.cut).astype(np.uint8)
        child = np.where(leaf, np.arange(len(leaf)), self.child)
        at = np.zeros(len(bins), dtype=np.int64) if at is None else at
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        yield at
        for _ in range(depth):
            at = child.take(at) + (flat.take(first + column.take(at)) > cut.take(at))
            yield at

    def leaf_of(self, bins: np.ndarray, depth: int, at: np.ndarray | None = None) -> np.ndarray:
        for at in self.places(bins, depth, at):
            pass
        return at


@dataclass
class Forest:
    """Edges of the columns, and trees of at most ``depth`` levels of cuts."""

    edges: list[np.ndarray]
    trees: list[ForestTree]
    depth: int

    def scores(self, values: np.ndarray, counts: list[int], depths: list[int] | None = None) -> np.ndarray:
        """Sums of the first k trees cut at a depth: a column for each depth and, within it, each count."""
        bins, wanted = binned(values, self.edges), sorted(set(counts))
        depths = sorted(set(depths)) if depths else [self.depth]
        total, out = np.zeros((len(depths), len(values))), []
        for k, tree in enumerate(self.trees[: wanted[-1]], start=1):
            for level, at in enumerate(tree.places(bins, depths[-1])):
                if level in depths:
                    total[depths.index(level)] += tree.value[at]
            if k in wanted:
                out.append(total.copy())
        return np.stack(out, axis=1).reshape(-1, len(values)).T

    def to_text(self) -> str:
        named = {f"{name}": np.concatenate([getattr(t, name) for t in self.trees]) for name in ("column", "cut", "child", "value")}
        sizes = {"sizes": np.array([len(t.column) for t in self.trees]), "widths": np.array([len(e) for e in self.edges])}
        held = io.BytesIO()
        np.savez_compressed(held, **named, **sizes, edges=np.concatenate(self.edges), depth=np.array(self.depth))
        return base64.b64encode(held.getvalue()).decode()

    @staticmethod
    def from_text(text: str) -> Forest:
        data = np.load(io.BytesIO(base64.b64decode(text)))
        ends = np.cumsum(data["sizes"])[:-1]
        parts = [np.split(data[name], ends) for name in ("column", "cut", "child", "value")]
        return Forest(np.split(data["edges"], np.cumsum(data["widths"])[:-1]), [ForestTree(*p) for p in zip(*parts)], int(data["depth"]))


@dataclass
class Plan:
    """What to grow."""

    trees: int
    depth: int
    least: int  # drawn rows of a child
    seed: int
    n_columns: int
    n_bins: int

    @property
    def tried(self) -> int:
        """Columns that a node tries: the root of their number."""
        return int(np.ceil(np.sqrt(self.n_columns)))

    @property
    def cells(self) -> int:
        """Counts of a node."""
        return self.tried * self.n_bins * 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _start(number: int, seed: int, purpose: int) -> np.ndarray:
    return _mixed(np.array([((seed & 0xFFFFFFFF) << 32) + number * 4 + purpose], dtype=np.uint64))


def _poisson_table() -> np.ndarray:
    """Draws by 16 bits of a hash."""
    upto, term, edges = 0.0, np.exp(-1.0), []
    for k in range(1, 9):
        upto += term
        edges.append(upto)
        term /= k
    return np.searchsorted(np.array(edges), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


_POISSON = _poisson_table()


def times_drawn(rows: np.ndarray, number: int, seed: int) -> np.ndarray:
    """How often a tree draws each row, by a hash of its id."""
    return _POISSON.take((_mixed(rows.astype(np.int64).view(np.uint64) ^ _start(number, seed, 0)) >> np.uint64(48)).view(np.int64))


def tried_columns(heaps: np.ndarray, number: int, plan: Plan) -> np.ndarray:
    """The columns that nodes of these places (root 1, children 2h and 2h + 1) try, in order."""
    places = heaps[:, None] * np.uint64(plan.n_columns) + np.arange(plan.n_columns, dtype=np.uint64)
    keys = _mixed(places + _start(number, plan.seed, 1))
    return np.sort(np.argsort(keys, axis=1, kind="stable")[:, : plan.tried], axis=1)


def node_counts(bins: np.ndarray, positive: np.ndarray, weight: np.ndarray, slot: np.ndarray, columns: np.ndarray, n_bins: int) -> np.ndarray:
    """Drawn rows by node, column tried, bin, and label."""
    size, flat, first = len(columns) * n_bins * 2, bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    below, weight, out = slot * (2 * n_bins) + positive, weight.astype(np.float64), []
    for k in range(columns.shape[1]):
        place = below + 2 * flat.take(first + columns[:, k].take(slot)).astype(np.int64)
        out.append(np.bincount(place, weight, minlength=size).reshape(len(columns), n_bins, 2))
    return np.stack(out, axis=1)


def add_counts(total: np.ndarray, bins: np.ndarray, positive: np.ndarray, weight: np.ndarray, slot: np.ndarray, columns: np.ndarray) -> None:
    """Add ``node_counts`` to a table of whole numbers, at the rows' places only if they are few beside the table."""
    n_tried, n_bins = columns.shape[1], total.shape[2]
    if total.size <= 4 * n_tried * len(slot):
        total += node_counts(bins, positive, weight, slot, columns, n_bins).astype(total.dtype)
        return
    cells, flat, first = total.reshape(-1), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    below, weight = slot * (n_tried * 2 * n_bins) + positive, weight.astype(total.dtype)
    for k in range(n_tried):
        place = below + 2 * (k * n_bins + flat.take(first + columns[:, k].take(slot)).astype(np.int64))
        np.add.at(cells, place, weight)


def best_cuts(counts: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of each node: whether it is cut, place of the column, bin, and counts of all, of left and of right rows."""
    counts = counts.astype(np.float64)
    n, total = len(counts), counts[:, 0].sum(axis=1)
    nothing = np.zeros(n, dtype=np.int64)
    if counts.shape[2] < 2:
        return nothing.astype(bool), nothing, nothing, total, total, np.zeros_like(total)
    left = counts.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    n_left, n_right, n_all = left.sum(axis=-1), right.sum(axis=-1), total.sum(axis=-1)
    pure = lambda c, size: (c[..., 0] ** 2 + c[..., 1] ** 2) / np.maximum(size, 1.0)
    gain = pure(left, n_left) + pure(right, n_right) - pure(total, n_all)[:, None, None]
    gain = np.where((n_left >= least) & (n_right >= least), gain, -np.inf).reshape(n, -1)
    best = gain.argmax(axis=1)  # ties: the first
    rows, column, cut = np.arange(n), best // (counts.shape[2] - 1), best % (counts.shape[2] - 1)
    lower = left[rows, column, cut]
    return gain[rows, best] > 1e-12 * n_all, column, cut, total, lower, total - lower


def _open(both: np.ndarray, least: int) -> np.ndarray:
    """Whether nodes with these counts may be cut."""
    return (both.sum(axis=1) >= 2 * least) & (both.min(axis=1) > 0)


def _shares(both: np.ndarray) -> np.ndarray:
    return both[:, 1] / np.maximum(both.sum(axis=1), 1.0)


def _order(slot: np.ndarray, n: int) -> np.ndarray:
    """The places of rows by rising slot below ``n``; short numbers are sorted in one sweep."""
    return np.argsort(slot.astype(np.uint16) if n <= 1 << 16 else slot, kind="stable")


def _children(heaps: np.ndarray) -> np.ndarray:
    return np.stack([2 * heaps, 2 * heaps + np.uint64(1)], axis=1).ravel()


def grow_here(bins, positive, weight, slot, heaps: np.ndarray, left: np.ndarray, number: int, plan: Plan) -> ForestTree:
    """Subtrees of some nodes of a tree, from all their rows; the nodes themselves come first.

    ``heaps`` are the nodes' places, ``left`` the levels that may follow each.
    """
    n = len(heaps)
    total = np.stack([np.bincount(slot, weight * (positive == c), minlength=n) for c in (0, 1)], axis=1)
    parts = [[np.full(n, -1), np.zeros(n, int), np.zeros(n, int), _shares(total)]]
    nodes, size = np.arange(n), n  # numbers of the open nodes; all nodes
    while True:
        going = _open(total, plan.least) & (left > 0)
        if not going.any():
            break
        renumbered = np.where(going, np.cumsum(going) - 1, -1)
        slot = renumbered[slot]
        rows = np.flatnonzero(slot >= 0)
        rows = rows[_order(slot[rows], len(renumbered))]
        bins, positive, weight, slot = bins[rows], positive[rows], weight[rows], slot[rows]
        heaps, left, nodes = heaps[going], left[going], nodes[going]
        columns = tried_columns(heaps, number, plan)
        step = max(1, LOCAL_CELLS // plan.cells)
        found = []
        for first in range(0, len(heaps), step):
            a, b = np.searchsorted(slot, [first, first + step])
            counts = node_counts(bins[a:b], positive[a:b], weight[a:b], slot[a:b] - first, columns[first : first + step], plan.n_bins)
            found.append(best_cuts(counts, plan.least))
        cuts, column, cut, _, lower, upper = (np.concatenate(f) for f in zip(*found))
        column = columns[np.arange(len(heaps)), column]
        child = size + 2 * (np.cumsum(cuts) - 1)
        own = [np.concatenate(p) for p in zip(*parts)]
        for values, new in zip(own, (column, cut, child)):
            values[nodes[cuts]] = new[cuts]
        total = np.stack([lower[cuts], upper[cuts]], axis=1).reshape(-1, 2)
        parts = [own, [np.full(len(total), -1), np.zeros(len(total), int), np.zeros(len(total), int), _shares(total)]]
        nodes, size = size + np.arange(len(total)), size + len(total)
        rows = np.flatnonzero(cuts[slot])
        bins, positive, weight, slot = bins[rows], positive[rows], weight[rows], slot[rows]
        above = bins[np.arange(len(rows)), column[slot]] > cut[slot]
        slot = 2 * (np.cumsum(cuts) - 1)[slot] + above
        heaps, left = _children(heaps[cuts]), np.repeat(left[cuts] - 1, 2)
    return ForestTree.of(*(np.concatenate(p) for p in zip(*parts)))


@dataclass
class _Growing:
    """A tree, its open nodes, and those whose subtrees are to be grown from their rows."""

    tree: ForestTree
    nodes: np.ndarray
    heaps: np.ndarray
    counts: np.ndarray
    aside: list

    def put_aside(self, chosen: np.ndarray, left: int) -> None:
        self.aside += [(int(i), int(h), left, int(c)) for i, h, c in zip(self.nodes[chosen], self.heaps[chosen], self.counts[chosen])]
        self.nodes, self.heaps, self.counts = self.nodes[~chosen], self.heaps[~chosen], self.counts[~chosen]

    def split(self, nodes: np.ndarray, heaps: np.ndarray, found: tuple, number: int, plan: Plan) -> tuple:
        """Record the cuts of some nodes; the children that may be cut, as nodes, places and counts."""
        cuts, column, cut, total, lower, upper = found
        t, size = self.tree, len(self.tree.column)
        t.value[nodes] = _shares(total)
        column = tried_columns(heaps, number, plan)[np.arange(len(nodes)), column]
        both = np.stack([lower[cuts], upper[cuts]], axis=1).reshape(-1, 2)
        t.column[nodes[cuts]], t.cut[nodes[cuts]] = column[cuts], cut[cuts]
        t.child[nodes[cuts]] = size + 2 * np.arange(int(cuts.sum()))
        self.append(ForestTree.of(np.full(len(both), -1), np.zeros(len(both)), np.zeros(len(both)), _shares(both)))
        going = _open(both, plan.least)
        return (size + np.arange(len(both)))[going], _children(heaps[cuts])[going], both.sum(axis=1)[going].astype(np.int64)

    def append(self, more: ForestTree) -> None:
        self.tree = ForestTree(*(np.concatenate([a, b]) for a, b in zip(vars(self.tree).values(), vars(more).values())))

    def graft(self, nodes: np.ndarray, grown: ForestTree) -> None:
        """Put subtrees in the place of their first nodes."""
        n, size = len(nodes), len(self.tree.column)
        moved = np.where(grown.column >= 0, grown.child + (size - n), 0).astype(np.int32)
        grown = ForestTree(grown.column, grown.cut, moved, grown.value)
        self.tree = ForestTree(*(v.copy() for v in vars(self.tree).values()))  # other bundles hold the one before
        for own, new in zip(vars(self.tree).values(), vars(grown).values()):
            own[nodes] = new[:n]
        self.append(ForestTree(*(v[n:] for v in vars(grown).values())))


def _drawn(folder: str, number: int, tree: ForestTree, level: int, plan: Plan) -> Iterator[tuple[np.ndarray, ...]]:
    """bins, positive, times drawn and node of a partition's rows that a tree draws, block by block."""
    sizes = np.fromfile(_file(folder, "sizes"), dtype=np.int64)
    with open(_file(folder, "bins"), "rb") as of_bins, open(_file(folder, "label"), "rb") as of_label, open(_file(folder, "row"), "rb") as of_row:
        for n in sizes.tolist():
            bins = np.fromfile(of_bins, dtype=np.uint8, count=n * plan.n_columns).reshape(n, plan.n_columns)
            label, row = np.fromfile(of_label, dtype=np.float64, count=n), np.fromfile(of_row, dtype=np.int64, count=n)
            weight = times_drawn(row, number, plan.seed)
            used = np.flatnonzero(weight > 0)
            own = np.take(bins, used, axis=0)
            yield own, (label.take(used) > 0.5).astype(np.int64), weight.take(used), tree.leaf_of(own, level)


def _live(folder: str, number: int, tree: ForestTree, level: int, plan: Plan) -> Iterator[tuple[np.ndarray, ...]]:
    """The same, of the rows that were in open nodes when they were last written."""
    for before in range(level, -1, -1):
        if os.path.exists(_file(folder, "live", number, before)):
            break
    else:
        yield from _drawn(folder, number, tree, level, plan)
        return
    with open(_file(folder, "live", number, before), "rb") as file:
        while len(size := np.fromfile(file, dtype=np.int64, count=1)):
            n = int(size[0])
            bins = np.fromfile(file, dtype=np.uint8, count=n * plan.n_columns).reshape(n, plan.n_columns)
            both, at = np.fromfile(file, dtype=np.uint8, count=n), np.fromfile(file, dtype=np.int32, count=n).astype(np.int64)
            yield bins, (both & 1).astype(np.int64), both >> 1, tree.leaf_of(bins, level - before, at)


def _within(rows: tuple[np.ndarray, ...], slot_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Those rows whose node has a slot, and the slot; their nodes come last."""
    slot = slot_of.take(rows[3])
    inside = np.flatnonzero(slot >= 0)
    own = rows if len(inside) == len(slot) else tuple(v.take(inside, axis=0) for v in rows)
    return *own[:3], slot.take(inside), own[3]


def _forget(folder: str, first: int) -> None:
    """Remove the files of trees before the first that is grown now."""
    for name in os.listdir(folder):
        if name.startswith("live-") and "." not in name and int(name.split("-")[1]) < first:
            os.remove(_file(folder, name))


def _slots(size: int, nodes: np.ndarray) -> np.ndarray:
    slot_of = np.full(size, -1, dtype=np.int64)
    slot_of[nodes] = np.arange(len(nodes))
    return slot_of


def _groups(items: list, size, most: int) -> Iterator[list]:
    """Items in groups of at most ``most`` in all, but for a single larger one."""
    group, total = [], 0
    for item in items:
        if group and total + size(item) > most:
            yield group
            group, total = [], 0
        group.append(item)
        total += size(item)
    if group:
        yield group


def _cut_pass(blocks: LocalParts, items: list, level: int, plan: Plan) -> dict:
    """The cuts of some nodes of some trees, from one pass: for each tree's number, ``best_cuts`` of its nodes.

    Items are (number, tree, nodes, places, whether these are all open nodes of the tree).
    """
    # broadcasts are pickled by reference, so trees go as their arrays
    sent = blocks.context.broadcast([(number, tuple(vars(tree).values()), *rest) for number, tree, *rest in items])
    step = max(1, ENTRY_CELLS // plan.cells)

    def count(folder: str) -> list[np.ndarray]:
        _forget(folder, sent.value[0][0])
        totals = []
        for number, arrays, nodes, heaps, every in sent.value:
            tree, columns = ForestTree(*arrays), tried_columns(heaps, number, plan)
            slots, counts = _slots(len(tree.column), nodes), np.zeros((*columns.shape, plan.n_bins, 2), dtype=np.int32)
            with _Written(folder) as out:
                for rows in _live(folder, number, tree, level, plan):
                    *own, at = _within(rows, slots)
                    add_counts(counts, *own, columns)
                    if every:
                        bins, positive, weight, _ = own
                        for values in (np.array([len(at)]), bins, weight * np.uint8(2) + positive.astype(np.uint8), at.astype(np.int32)):
                            out.put(values, "live", number, level)
            if every and level > 1 and os.path.exists(old := _file(folder, "live", number, level - 2)):
                os.remove(old)
            totals.append(counts)
        return totals

    def run(folder: str) -> Iterator[tuple]:
        try:
            totals = count(folder)
        except FileNotFoundError:
            yield (-1, 0), np.zeros(0, dtype=np.int32)
            return
        for i, counts in enumerate(totals):
            for first in range(0, len(counts), step):
                yield (i, first), counts[first : first + step]

    add = lambda a, b: np.add(a, b, dtype=np.int64)
    entries = sum(-(-len(item[2]) // step) for item in items)
    cuts = lambda c: best_cuts(c, plan.least) if len(c) else None
    for again in (False, True):
        summed = blocks.run(run, again).reduceByKey(add, min(entries, blocks.getNumPartitions()))
        # some numbers for each node: bounded by the settings
        entries_found = sorted(summed.mapValues(cuts).collect(), key=lambda e: e[0])
        if entries_found[0][0][0] >= 0:
            break
    found: dict = {}
    for (i, first), cuts_found in entries_found:
        found.setdefault(items[i][0], []).append(cuts_found)
    sent.destroy()
    return {number: tuple(np.concatenate(p) for p in zip(*parts)) for number, parts in found.items()}


def _grow_aside(blocks: LocalParts, bundles: list, plan: Plan) -> list:
    """Subtrees of bundles (number, tree, nodes set aside), each grown from its shuffled rows."""
    by_tree: dict = {}
    for i, (number, tree, own) in enumerate(bundles):
        by_tree.setdefault(number, (tree, []))[1].extend((node, i, slot, left) for slot, (node, _, left, _) in enumerate(own))
    # broadcasts are pickled by reference, so trees go as their arrays
    trees = [(number, tuple(vars(tree).values()), *map(np.array, zip(*nodes))) for number, (tree, nodes) in by_tree.items()]
    sent = blocks.context.broadcast((trees, [(number, own) for number, _, own in bundles]))
    rows = sum(n for _, _, own in bundles for *_, n in own)
    parts = min(len(bundles), max(blocks.getNumPartitions(), -(-rows // PART_ROWS)))

    def emit(folder: str) -> Iterator[tuple]:
        held: dict = {}
        n_held = 0
        for number, arrays, nodes, bundle, slot, left in sent.value[0]:
            tree = ForestTree(*arrays)
            slots = _slots(len(tree.column), nodes)
            # a tree draws its rows once for all its bundles, however many these are
            for rows in _drawn(folder, number, tree, plan.depth - int(left.min()), plan):
                *rows, place, _ = _within(rows, slots)
                own = bundle.take(place) - bundle[0]
                order = _order(own, int(bundle[-1] - bundle[0]) + 1)
                bins, positive, weight, place = (v.take(order, axis=0) for v in (*rows, place))
                columns = bins, positive.astype(np.uint8), weight, slot.take(place).astype(np.int32)
                ends = np.cumsum(np.bincount(own)).tolist()
                for i, (a, b) in enumerate(zip([0, *ends], ends), start=int(bundle[0])):
                    if a < b:
                        held.setdefault(i, []).append([c[a:b].tobytes() for c in columns])
                n_held += len(order)
                if n_held >= SENT_ROWS:
                    yield from ((i, tuple(map(b"".join, zip(*found)))) for i, found in held.items())
                    held, n_held = {}, 0
        yield from ((i, tuple(map(b"".join, zip(*found)))) for i, found in held.items())

    def emit_or_tell(folder: str) -> Iterator[tuple]:
        if os.path.exists(_file(folder, "sizes")):
            yield from emit(folder)
        else:
            yield -1, None

    def grow(entries: Iterator[tuple]) -> Iterator[tuple]:
        held: dict = {}
        for i, part in entries:
            held.setdefault(i, []).append(part)
        if held.pop(-1, None):
            yield -1, None
            return
        for i in sorted(held):
            number, own = sent.value[1][i]
            joined = [b"".join(p) for p in zip(*held.pop(i))]
            bins = np.frombuffer(joined[0], dtype=np.uint8).reshape(-1, plan.n_columns)
            positive, weight = (np.frombuffer(b, dtype=np.uint8) for b in joined[1:3])
            slot = np.frombuffer(joined[3], dtype=np.int32).astype(np.int64)
            heaps, left = np.array([a[1] for a in own], dtype=np.uint64), np.array([a[2] for a in own])
            yield i, grow_here(bins, positive.astype(np.int64), weight, slot, heaps, left, number, plan)

    for again in (False, True):
        found = blocks.run(emit_or_tell, again).partitionBy(parts, lambda i: max(i, 0)).mapPartitions(grow).collect()  # nodes: bounded by the settings
        if all(i >= 0 for i, _ in found):
            break
    sent.destroy()
    return found


def grow_forest(df: DataFrame, plan_of, bins: int = 32, edges: list[np.ndarray] | None = None, depth: int = 5) -> Forest:
    """Fit a forest to rows (x array<double>, label, weight, row); ``plan_of(columns, bins)`` gives its plan."""
    if edges is None:
        n_columns = (df.select(F.size("x")).first() or [1])[0]
        names = [f"x{i}" for i in range(n_columns)]
        edges = quantile_edges(df.select(*[F.col("x")[i].alias(c) for i, c in enumerate(names)]), names, bins)
    plan: Plan = plan_of(len(edges), max(len(e) for e in edges) + 1)
    leaf = lambda: ForestTree.of([-1], [0], [0], [0.0])
    n_rows = df.count()
    if not n_rows:
        return Forest(edges, [leaf() for _ in range(plan.trees)], plan.depth)
    first = lambda: (np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.uint64), np.array([n_rows]))
    growing = [_Growing(leaf(), *first(), []) for _ in range(plan.trees)]
    blocks = LocalParts(store_binned(df, edges, n_rows), len(edges), by_column=False)
    try:
        return Forest(edges, _grown(blocks, growing, plan, n_rows), plan.depth)
    finally:
        blocks.free()


def _cut_all(blocks: LocalParts, growing: list[_Growing], chosen: range, plan: Plan) -> None:
    """Cut the large nodes of some trees, level by level."""
    parts = blocks.getNumPartitions()
    for level in range(max(plan.depth, 1)):
        left = plan.depth - level
        for number in chosen:
            g = growing[number]
            tables = parts * plan.cells * 4.0 * np.minimum(2.0**left - 1, g.counts)
            g.put_aside((g.counts <= LOCAL_ROWS) & (g.counts * ROW_BYTES < tables) if plan.depth else np.zeros(1, dtype=bool), left)
        step = max(1, PASS_CELLS // plan.cells)
        items = [(number, a) for number in chosen for a in range(0, len(growing[number].nodes), step)]
        after: dict = {}
        for group in _groups(items, lambda item: min(step, len(growing[item[0]].nodes) - item[1]), step):
            sent = []
            for n, a in group:
                g = growing[n]
                sent.append((n, g.tree, g.nodes[a : a + step], g.heaps[a : a + step], len(g.nodes) <= step))
            least = plan if plan.depth else Plan(**(vars(plan) | {"least": 2**62}))  # the root alone
            for number, found in _cut_pass(blocks, sent, level, least).items():
                nodes, heaps = next(s[2:4] for s in sent if s[0] == number)
                after.setdefault(number, []).append(growing[number].split(nodes, heaps, found, number, plan))
        for number in chosen:
            g = growing[number]
            g.nodes, g.heaps, g.counts = (np.concatenate(p) for p in zip(*after[number])) if number in after else (g.nodes[:0], g.heaps[:0], g.counts[:0])


def _grown(blocks: LocalParts, growing: list[_Growing], plan: Plan, n_rows: int) -> list[ForestTree]:
    for group in _groups(list(range(len(growing))), lambda _: n_rows, JOB_ROWS):
        _cut_all(blocks, growing, range(group[0], group[-1] + 1), plan)
    bundles = [(n, g.tree, own) for n, g in enumerate(growing) for own in _groups(g.aside, lambda a: a[3], LOCAL_ROWS)]
    for job in _groups(bundles, lambda b: sum(a[3] for a in b[2]), JOB_ROWS):
        for i, grown in _grow_aside(blocks, job, plan):
            growing[job[i][0]].graft(np.array([a[0] for a in job[i][2]]), grown)
    return [g.tree for g in growing]


class _ForestParams(HasFeaturesCol, HasLabelCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts, at most 30", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column, at most 256", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least drawn rows of a child", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "id by which rows are drawn", TypeConverters.toString)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)


_DEFAULTS = {
    "numTrees": 20, "maxDepth": 5, "maxBins": 32, "minInstancesPerNode": 1, "seed": 42,
    "idCol": "tx_id", "labelCol": "label", "featuresCol": "features",
}


class RandomForestClassifier(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """The forest as a stage of a pipeline, by the parameter names of Spark's own."""

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self._set(**self._input_kwargs)

    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def _fit(self, df: DataFrame) -> RandomForestClassificationModel:
        get = self.getOrDefault
        row = F.xxhash64(get("idCol")) if get("idCol") in df.columns else F.monotonically_increasing_id()
        rows = df.select(
            vector_to_array(F.col(get("featuresCol"))).alias("x"),
            F.col(get("labelCol")).cast("double").alias("label"),
            F.lit(1.0).alias("weight"),
            row.alias("row"),
        )
        plan = lambda columns, bins: Plan(get("numTrees"), get("maxDepth"), max(1, get("minInstancesPerNode")), get("seed"), columns, bins)
        forest = grow_forest(rows, plan, get("maxBins"))
        return RandomForestClassificationModel(
            ensemble=forest.to_text(), featuresCol=get("featuresCol"), numTrees=get("numTrees"), maxDepth=get("maxDepth")
        )


class RandomForestClassificationModel(Model, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction; saved and loaded with its pipeline."""

    ensemble = Param(Params._dummy(), "ensemble", "edges and trees as text", TypeConverters.toString)

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    @property
    def forest(self) -> Forest:
        return Forest.from_text(self.getOrDefault(self.ensemble))

    def with_scores(self, df: DataFrame, name: str, counts: list[int], depths: list[int] | None = None) -> DataFrame:
        """``df`` with the array ``name`` of ``Forest.scores``."""
        shared = df.sparkSession.sparkContext.broadcast(self.getOrDefault(self.ensemble))  # bounded by the settings
        made: list[Forest] = []

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            if not made:
                made.append(Forest.from_text(shared.value))
            if not len(features):
                return pd.Series([], dtype=object)
            return pd.Series(list(made[0].scores(np.stack(features.to_numpy()).astype(np.float64), counts, depths)))

        return df.withColumn(name, score(vector_to_array(F.col(self.getOrDefault(self.featuresCol)))))

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = float(self.getNumTrees)
        s = F.col("_sum")[0]
        p = s / trees
        added = {
            "rawPrediction": array_to_vector(F.array(trees - s, s)),
            "probability": array_to_vector(F.array(1.0 - p, p)),
            "prediction": F.when(s > trees - s, 1.0).otherwise(0.0),
        }
        return self.with_scores(df, "_sum", [self.getNumTrees]).withColumns(added).drop("_sum")
