"""Boosted trees on quantile-binned columns, of the second order or of the first.

Columns are cut into bins once, at approximate quantiles. Every level of a tree is one pass
over the binned rows: each task adds up the gradients and hessians of the logistic loss by
node, column and bin, and the sums are added up in a tree, so the driver gets a few tables
of fixed size, whatever the number of rows. A split takes the largest gain with L2
weights on the leaves; rows and columns are sampled anew for each tree. Trees of the first
order count rows instead of hessians: a split lowers the variance of the residuals most.

Gradients are rounded to whole multiples of a power of two, so sums do not depend on the
order of addition: another partitioning, or a task that runs again, gives the same trees.
Rows are dealt out evenly by their id and stored in blocks of ``BLOCK_ROWS``, each of them a few
byte strings. Where a partition's tasks run, its bins, margins, gradients and nodes go on in files
of the executor's scratch folder, step by step. So a level moves no rows: each row goes on by one node,
and only those of the smaller child of each pair are added up, as the other child is what is left
of its parent. A file is written whole under its step's name and never changed; a task that does not
find those of the step before makes its part again, from the stored blocks and all trees so far.

A missing value goes with the largest ones. Rows are sampled by a hash of their id, where
there is one, else of their place in the stored table.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle, keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import ledgersift.ml as package
from ledgersift.operators.layout import dealt
from ledgersift.session import work_path

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

#: Trees that are sent together, once, for the parts that must be made again.
ROUNDS_PER_TABLE = 20
#: Partial sums that the driver adds up itself; more are added up in groups before.
SUMS_TO_DRIVER = 64
#: Sums of so many bits stay exact in the doubles that count them, for an Arrow batch.
GRADIENT_BITS = 36
BLOCK_ROWS = 32_768
#: Bytes that go with a partition's number: a shorter input waits 40 ms for its acknowledgement on the way to the task.
FILLING = 1 << 18


@dataclass
class Tree:
    """Node ``i`` sends bins above ``cut[i]`` of a column to ``child[i] + 1``, the others to ``child[i]``.

    Leaves have column -1; ``gradient`` and ``hessian`` are the sums of a node's sampled rows.
    """

    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gradient: list[float] = field(default_factory=list)
    hessian: list[float] = field(default_factory=list)

    def add(self, gradient: float, hessian: float, value: float) -> int:
        for values, new in zip(vars(self).values(), (-1, 0, 0, value, gradient, hessian)):
            values.append(new)
        return len(self.column) - 1

    def steps(self) -> tuple[np.ndarray, ...]:
        """Column, cut and first child of every node; a leaf leads to itself, as no bin is above 255."""
        column, cut, child = (np.array(v, dtype=np.int64) for v in (self.column, self.cut, self.child))
        leaf = column < 0
        column[leaf], cut[leaf], child[leaf] = 0, 255, np.flatnonzero(leaf)
        return column, cut, child

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        column, cut, child = self.steps()
        levels = np.zeros(len(column), dtype=np.int64)  # children follow their parents
        for node in np.flatnonzero(np.array(self.column) >= 0):
            levels[child[node] : child[node] + 2] = levels[node] + 1
        at = np.zeros(len(bins), dtype=np.int64)
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(int(levels.max(initial=0))):
            at = child[at] + (flat[first + column[at]] > cut[at])
        return at


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of edges below each value, column by column; NaN is above all."""
    return np.stack([np.searchsorted(e, values[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def quantile_edges(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Distinct approximate quantiles of each column, at most ``bins`` - 1 (of at most 256)."""
    found = df.approxQuantile(columns, [k / bins for k in range(1, bins)], 0.25 / bins)
    return [np.unique(np.array(q, dtype=np.float64)) for q in found]


def gradients(
    margin: np.ndarray, label: np.ndarray, weight: np.ndarray, unit: float, newton: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the logistic loss, in whole units; the weight itself without ``newton``."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - label) * weight / unit), np.rint((p * (1.0 - p) * weight if newton else weight) / unit)


def drawn(rows: np.ndarray, number: int, seed: int, rate: float) -> np.ndarray:
    """Whether each row takes part in a round, by a hash of its id."""
    if rate >= 1.0:
        return np.ones(len(rows), dtype=bool)
    x = rows.astype(np.int64).view(np.uint64) ^ np.uint64((seed * 1_000_003 + number) & 0xFFFFFFFF) << np.uint64(17)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11) < np.uint64(int(rate * (1 << 53)))


def best_split(g: np.ndarray, h: np.ndarray, l2: float, least_hessian: float) -> tuple[int, int, float] | None:
    """(column, bin, gain) of the best cut of a node; sums by column and bin. Ties: the first."""
    left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
    total_g, total_h = g[0].sum(), h[0].sum()
    right_g, right_h = total_g - left_g, total_h - left_h
    with np.errstate(divide="ignore", invalid="ignore"):  # empty sides are ruled out below
        gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - total_g**2 / (total_h + l2)
    gain = np.where((left_h >= least_hessian) & (right_h >= least_hessian), gain, -np.inf)
    if not gain.size or not gain.max() > 1e-9:
        return None
    at = int(gain.argmax())
    return at // gain.shape[1], at % gain.shape[1], float(gain.flat[at]) / 2


@dataclass
class Booster:
    """Edges of the columns, and trees whose leaf values already hold the learning rate."""

    edges: list[np.ndarray]
    trees: list[Tree]

    def margins(self, values: np.ndarray, trees: int | None = None) -> np.ndarray:
        bins = binned(values, self.edges)
        total = np.zeros(len(values))
        for tree in self.trees[:trees]:
            total += np.array(tree.value)[tree.leaf_of(bins)]
        return total

    def to_json(self) -> str:
        return json.dumps({"edges": [e.tolist() for e in self.edges], "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Booster:
        data = json.loads(text)
        return Booster([np.array(e) for e in data["edges"]], [Tree(**t) for t in data["trees"]])


@dataclass
class Rounds:
    """How to boost: number and depth of trees, sampling, and regularisation."""

    trees: int = 200
    depth: int = 6
    rate: float = 0.1
    l2: float = 1.0
    least_hessian: float = 1.0
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    newton: bool = True
    first_rate: float | None = None  # of the first tree, if it differs


_STORED = "bins binary, label binary, weight binary, row binary"
_KINDS = {"label": np.float64, "weight": np.float64, "row": np.int64}
Block = tuple[bytes, ...]


def _unpacked(block: Block, n_columns: int) -> tuple[np.ndarray, ...]:
    """bins, label, weight and row of the rows of a block."""
    bins = np.frombuffer(block[0], dtype=np.uint8).reshape(-1, n_columns)
    return bins, *(np.frombuffer(b, dtype=kind) for b, kind in zip(block[1:], _KINDS.values()))


def _stored(blocks: DataFrame, name: str) -> RDD:
    """Blocks written to a table, and read from there."""
    path = work_path(blocks.sparkSession, name)
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(_STORED).parquet(path).rdd.map(lambda r: tuple(map(bytes, r)))


def store_binned(df: DataFrame, edges: list[np.ndarray], n_rows: int) -> RDD:
    """The binned blocks of rows (x array, label, weight, row), dealt out by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            flat = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            values = np.asarray(flat, dtype=np.float64).reshape(rows.num_rows, len(edges))
            both = [binned(values, edges), *[rows.column(c).to_numpy().astype(kind) for c, kind in _KINDS.items()]]
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], type=pa.binary()) for v in both], names=["bins", *_KINDS])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block()
                held.clear()
        if held:
            yield block()

    rows = dealt(df.select("x", "label", "weight", "row"), "row", n_rows)
    return _stored(rows.mapInArrow(run, _STORED), "binned-rows")


@dataclass
class _Pass:
    """One pass over the rows: the level of a tree, what to count, and what the passes before left.

    ``slot_of`` tells the place of the nodes to be counted, -1 of the others; ``last`` is the last tree
    and its last level that was counted, ``lasts`` all trees before, in broadcasts.
    """

    number: int
    level: int
    tree: Tree
    slot_of: np.ndarray
    n_slots: int
    columns: list[int]
    last: Tree | None
    last_level: int
    lasts: list
    n_columns: int
    n_bins: int
    unit: float
    even: float  # the weight of every row, if all rows count alike; else 0
    rounds: Rounds

    @property
    def shape(self) -> tuple[int, ...]:
        return 2, self.n_slots, len(self.columns), self.n_bins

    @property
    def node_kind(self) -> type:
        return np.uint16 if self.rounds.depth < 15 else np.int32


def _file(folder: str, *name) -> str:
    return os.path.join(folder, "-".join(map(str, name)))


class _Written:
    """Files of a folder that get their names when all of them are whole."""

    def __init__(self, folder: str):
        os.makedirs(folder, exist_ok=True)
        self.folder, self.mark, self.files = folder, uuid.uuid4().hex, {}

    def put(self, values: np.ndarray, *name) -> None:
        path = _file(self.folder, *name)
        if path not in self.files:
            self.files[path] = open(f"{path}.{self.mark}", "wb")
        np.ascontiguousarray(values).tofile(self.files[path])

    def __enter__(self) -> _Written:
        return self

    def __exit__(self, kind, *_) -> None:
        for path, file in self.files.items():
            file.close()
            if kind is None:
                os.replace(file.name, path)
            else:
                os.remove(file.name)


def _write_rows(folder: str, blocks: Iterator[Block], n_columns: int, by_column: bool) -> None:
    """A partition's rows as files, bins row by row or column by column in each block; the blocks' sizes come last."""
    sizes = []
    with _Written(folder) as out:
        out.put(np.zeros(0), "bins")
        for block in blocks:
            bins, *others = _unpacked(block, n_columns)
            sizes.append(len(bins))
            out.put(bins.T if by_column else bins, "bins")
            for name, values in zip(_KINDS, others):
                out.put(values, name)
    with _Written(folder) as out:
        out.put(np.array(sizes, dtype=np.int64), "sizes")


def _step(at: np.ndarray, bins: np.ndarray, steps: tuple[np.ndarray, ...]) -> np.ndarray:
    """The next node of each row; ``bins`` by column."""
    column, cut, child = steps
    above = bins.ravel().take(column.take(at) * bins.shape[1] + np.arange(bins.shape[1])) > cut.take(at)
    return child.take(at) + above


def _replayed(bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    """Margins by all trees before, added one by one."""
    margin, own = np.zeros(bins.shape[1]), bins.T
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.leaf_of(own)]
    return margin


def _advance(at_pass: _Pass, folder: str) -> np.ndarray:
    """Sums of a partition, as whole units by kind, slot, column and bin; its files go on by a step.

    Raises FileNotFoundError where the partition's rows are not on this machine.
    """
    p, number, level = at_pass, at_pass.number, at_pass.level
    sizes = np.fromfile(_file(folder, "sizes"), dtype=np.int64)
    files: dict = {}

    def has(*name) -> bool:
        return os.path.exists(_file(folder, *name))

    def read(kind, count: int, *name) -> np.ndarray:
        if name not in files:
            files[name] = open(_file(folder, *name), "rb")
        return np.fromfile(files[name], dtype=kind, count=count)

    if level:
        ready = has("margin", number) and has("gradient", number) and has("at", number, level - 1)
    else:
        ready = number == 0 or (has("margin", number - 1) and has("at", number - 1, p.last_level))
    trees = [] if ready else [Tree(**values) for sent in p.lasts for values in sent.value]
    steps, before = p.tree.steps(), p.last.steps() if p.last else None
    fresh, total = not (ready and level), np.zeros(p.shape, dtype=np.int64)  # whether gradients are to be made
    with _Written(folder) as out:
        for n in sizes.tolist():
            bins = read(np.uint8, n * p.n_columns, "bins").reshape(p.n_columns, n)
            if fresh:
                label = read(np.float64, n, "label")
                if not ready:
                    margin = _replayed(bins, trees)
                elif number == 0:
                    margin = np.zeros(n)
                else:
                    ended = _step(read(p.node_kind, n, "at", number - 1, p.last_level), bins, before)
                    margin = read(np.float64, n, "margin", number - 1) + np.array(p.last.value).take(ended)
                weight = p.even or read(np.float64, n, "weight")
                g, h = gradients(margin, label, weight, p.unit, p.rounds.newton)
                if p.rounds.row_share < 1.0:
                    used = drawn(read(np.int64, n, "row"), number, p.rounds.seed, p.rounds.row_share)
                    g, h = np.where(used, g, 0.0), np.where(used, h, 0.0)
                out.put(margin, "margin", number)
                out.put(g, "gradient", number)
                if not p.even:
                    out.put(h, "hessian", number)
                at = np.zeros(n, dtype=np.int64)
                for _ in range(level):
                    at = _step(at, bins, steps)
            else:
                at = _step(read(p.node_kind, n, "at", number, level - 1), bins, steps)
                g = read(np.float64, n, "gradient", number)
                h = None if p.even else read(np.float64, n, "hessian", number)
            out.put(at.astype(p.node_kind), "at", number, level)
            slot = p.slot_of.take(at)
            rows = np.flatnonzero(slot >= 0)
            whole = len(rows) == n
            if not whole:
                slot, g, h = slot.take(rows), g.take(rows), None if p.even else h.take(rows)
            first, size = slot * p.n_bins, p.n_slots * p.n_bins
            for k, column in enumerate(p.columns):
                place = first + (bins[column] if whole else bins[column].take(rows))
                for kind, values in enumerate((g, None if p.even else h)):  # all rows alike: they are counted
                    counted = np.bincount(place, values, minlength=size)
                    total[kind, :, k] += counted.reshape(p.n_slots, p.n_bins).astype(np.int64)
    for file in files.values():
        file.close()
    if p.even:
        total[1] *= int(np.rint(p.even / p.unit))
    _forget(folder, number, level)
    return total


def _forget(folder: str, number: int, level: int) -> None:
    """Remove files that no pass needs any more, were it run again; those of other steps stay."""
    for name in os.listdir(folder):
        kind, *step = name.split("-")
        if "." in name or not step:
            continue
        tree, *own = map(int, step)
        if tree < number - (level == 0) or (tree == number and own and own[0] < level - 1):
            os.remove(_file(folder, name))


class LocalParts:
    """The rows of a fit: stored blocks, and files of each partition in the scratch folder of its executor.

    A partition is for each core, as every pass waits for all of them. Short rows stand for the partitions; they
    are persisted, so that tasks run where the files are.
    """

    def __init__(self, blocks: RDD, n_columns: int, by_column: bool):
        self.context, name, filling = blocks.context, f"rows-{uuid.uuid4().hex}", FILLING
        self.blocks = blocks.coalesce(self.context.defaultParallelism)

        def folder(part: int) -> str:
            local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or tempfile.gettempdir()
            return os.path.join(local, f"{name}-{part}")

        def write(part: int, blocks: Iterator[Block]) -> Iterator[tuple]:
            _write_rows(folder(part), blocks, n_columns, by_column)
            yield part, bytes(filling)

        self.folder, self.write = folder, write
        self.parts = self.blocks.mapPartitionsWithIndex(write).persist(StorageLevel.MEMORY_AND_DISK)

    def getNumPartitions(self) -> int:
        return self.blocks.getNumPartitions()

    def run(self, work, again: bool = False) -> RDD:
        """What ``work(folder)`` yields for all partitions, made anew from the blocks if ``again``.

        ``work`` raises FileNotFoundError, before it yields, where a partition's files are not on this machine.
        """
        folder, write = self.folder, self.write

        def each(parts: Iterator[tuple]) -> Iterator:
            for part, _ in parts:  # read to the end, or the worker would not be used again
                yield from work(folder(part))

        if again:
            return self.blocks.mapPartitionsWithIndex(lambda part, blocks: each(write(part, blocks)))
        return self.parts.mapPartitions(each)

    def free(self) -> None:
        folder = self.folder
        self.parts.foreach(lambda part: shutil.rmtree(folder(part[0]), ignore_errors=True))
        self.parts.unpersist()


class _Rows:
    """The rows of a fit, whose files go on step by step."""

    def __init__(self, blocks: RDD, n_columns: int, n_bins: int, unit: float, even: float, rounds: Rounds):
        self.context, self.trees, self.sent = blocks.context, [], []
        self.parts = LocalParts(blocks, n_columns, by_column=True)
        self.fixed = {"n_columns": n_columns, "n_bins": n_bins, "unit": unit, "even": even, "rounds": rounds}
        self.level, self.last_level, self.held, self.recent = 0, 0, None, None

    def _pass(self, tree: Tree, slot_of: np.ndarray, n_slots: int, columns: list[int]) -> _Pass:
        lasts = self.sent + ([self.recent] if self.recent is not None else [])
        last = self.trees[-1] if self.trees else None
        return _Pass(len(self.trees), self.level, tree, slot_of, n_slots, columns, last, self.last_level, lasts, **self.fixed)

    def add(self, tree: Tree) -> None:
        """Go on with one more tree."""
        self.trees.append(tree)
        self.last_level, self.level, self.held = self.level - 1, 0, None
        if self.recent is not None:
            self.recent.destroy()
        own = self.trees[len(self.sent) * ROUNDS_PER_TABLE :]
        self.recent = self.context.broadcast([vars(t) for t in own])  # pickled by reference: without classes
        if len(own) == ROUNDS_PER_TABLE:
            self.sent.append(self.recent)
            self.recent = None

    def free(self) -> None:
        self.parts.free()
        for sent in self.sent + ([self.recent] if self.recent is not None else []):
            sent.destroy()

    def _summed(self, one: _Pass) -> np.ndarray:
        """Sums over all partitions; those whose files are not found are made again."""

        def work(folder: str) -> Iterator[tuple]:
            try:
                yield [], _advance(one, folder)
            except FileNotFoundError:
                yield [int(folder.rsplit("-", 1)[1])], np.zeros(one.shape, dtype=np.int64)

        both = lambda a, b: (a[0] + b[0], a[1] + b[1])
        partial = self.parts.run(work)
        if partial.getNumPartitions() > SUMS_TO_DRIVER:
            missing, found = partial.treeReduce(both)
        else:
            missing, found = reduce(both, partial.collect())
        made = self.parts.run(work, again=True)
        for first in range(0, len(missing), SUMS_TO_DRIVER):
            _, sums = reduce(both, self.context.runJob(made, list, missing[first : first + SUMS_TO_DRIVER]))
            found = found + sums
        return found

    def sums(self, tree: Tree, nodes: list[int], columns: list[int]) -> np.ndarray:
        """Gradients and hessians by node, column and bin as whole units: [2, node, column, bin].

        But for the root nodes come in pairs, and one of each is what the other leaves of the parent.
        """
        counted = nodes if self.held is None else [a if tree.hessian[a] <= tree.hessian[a + 1] else a + 1 for a in nodes[::2]]
        slot_of = np.full(len(tree.column), -1, dtype=np.int64)
        slot_of[counted] = np.arange(len(counted))
        found = self._summed(self._pass(tree, slot_of, len(counted), columns))
        if self.held is not None:
            parents = {tree.child[n]: i for i, n in enumerate(self.held[0]) if tree.column[n] >= 0}
            rest = self.held[1][:, [parents[a] for a in nodes[::2]]] - found
            second = (np.array(counted) != np.array(nodes[::2]))[None, :, None, None]
            pairs = np.stack([np.where(second, rest, found), np.where(second, found, rest)], axis=2)
            found = pairs.reshape(2, len(nodes), *found.shape[2:])
        self.held = nodes, found
        self.level += 1
        return found


def grow(sums, columns: list[int], rounds: Rounds) -> Tree:
    """One tree, level by level; ``sums(tree, nodes, columns)`` gives gradients and hessians."""
    tree = Tree()
    value = lambda g, h: float(-rounds.rate * g / (h + rounds.l2)) if h + rounds.l2 > 0 else 0.0
    nodes = [tree.add(0.0, 0.0, 0.0)]
    for level in range(rounds.depth):
        found = sums(tree, nodes, columns)
        if level == 0:
            g, h = (float(x[0, 0].sum()) for x in found)
            tree.gradient[0], tree.hessian[0], tree.value[0] = g, h, value(g, h)
        after = []
        for node, g, h in zip(nodes, found[0], found[1]):
            split = best_split(g, h, rounds.l2, rounds.least_hessian)
            if split is None:
                continue
            k, cut, _ = split
            sides = [(float(g[k][s].sum()), float(h[k][s].sum())) for s in (slice(None, cut + 1), slice(cut + 1, None))]
            children = [tree.add(a, b, value(a, b)) for a, b in sides]
            tree.column[node], tree.cut[node], tree.child[node] = columns[k], cut, children[0]
            after += children
        if not after:
            break
        nodes = after
    return tree


def chosen_columns(n_columns: int, number: int, rounds: Rounds) -> list[int]:
    """The columns of a round, in order."""
    count = max(1, int(np.ceil(rounds.column_share * n_columns - 1e-9)))
    rng = np.random.default_rng([rounds.seed, number])
    return sorted(rng.choice(n_columns, count, replace=False).tolist())


def boost(df: DataFrame, rounds: Rounds, edges: list[np.ndarray] | None = None, bins: int = 64) -> Booster:
    """Fit trees to rows (x array<double>, label, weight, row)."""
    if edges is None:
        n_columns = df.select(F.size("x")).first()[0]
        names = [f"x{i}" for i in range(n_columns)]
        edges = quantile_edges(df.select(*[F.col("x")[i].alias(c) for i, c in enumerate(names)]), names, bins)
    n_columns, n_bins = len(edges), max(len(e) for e in edges) + 1
    heaviest, lightest, weighed, n_rows = df.agg(F.max(F.abs("weight")), F.min("weight"), F.count("weight"), F.count(F.lit(1))).first()
    if not n_rows:
        return Booster(edges, [])
    # whole units: exact within a block as doubles, and over all rows as 64-bit numbers
    bits = min(GRADIENT_BITS, 61 - int(n_rows).bit_length())
    unit = 2.0 ** (np.ceil(np.log2(heaviest or 1.0)) - bits)
    alike = not rounds.newton and rounds.row_share >= 1.0 and lightest == heaviest and weighed == n_rows
    rows = _Rows(store_binned(df, edges, n_rows), n_columns, n_bins, unit, float(heaviest) if alike else 0.0, rounds)
    sums = lambda *asked: rows.sums(*asked) * unit
    try:
        for number in range(rounds.trees):
            rate = rounds.first_rate if number == 0 else None
            rows.add(grow(sums, chosen_columns(n_columns, number, rounds), replace(rounds, rate=rate or rounds.rate)))
    finally:
        rows.free()
    return Booster(edges, rows.trees)


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column, at most 256", TypeConverters.toInt)
    regLambda = Param(Params._dummy(), "regLambda", "L2 weight of leaf values", TypeConverters.toFloat)
    leastHessian = Param(Params._dummy(), "leastHessian", "least hessian sum of a child", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows of each tree", TypeConverters.toFloat)
    columnRate = Param(Params._dummy(), "columnRate", "share of columns of each tree", TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "id by which rows are sampled", TypeConverters.toString)


_DEFAULTS = {
    "maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "maxBins": 64, "regLambda": 1.0, "leastHessian": 1.0,
    "subsamplingRate": 1.0, "columnRate": 1.0, "seed": 42, "idCol": "tx_id", "labelCol": "label", "featuresCol": "features",
}


class BoostedTreesClassifier(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Second-order boosting as a stage of a pipeline; ``weightCol`` may weigh the frauds."""

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._setDefault(**_DEFAULTS)
        self._set(**self._input_kwargs)

    def getMaxIter(self) -> int:
        return self.getOrDefault(self.maxIter)

    def _rounds(self) -> Rounds:
        get = self.getOrDefault
        return Rounds(
            get("maxIter"), get("maxDepth"), get("stepSize"), get("regLambda"), get("leastHessian"),
            get("subsamplingRate"), get("columnRate"), get("seed"),
        )

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        get = self.getOrDefault
        weight = F.col(get("weightCol")).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        by_id = get("idCol") in df.columns
        row = F.xxhash64(get("idCol")) if by_id else F.monotonically_increasing_id()
        rows = df.select(
            vector_to_array(F.col(get("featuresCol"))).alias("x"),
            F.col(get("labelCol")).cast("double").alias("label"),
            weight.alias("weight"),
            row.alias("row"),
        )
        booster = boost(rows, self._rounds(), bins=get("maxBins"))
        return BoostedTreesModel(ensemble=booster.to_json(), featuresCol=get("featuresCol"))


class GradientTreesClassifier(BoostedTreesClassifier):
    """First-order boosting: each tree fits the residuals of the logistic loss by least squares.

    The margin is twice the usual score, so that its logistic is the probability: the
    first tree fits the labels (-1 and 1) whole, the others four times the residual, by ``stepSize``.
    """

    @keyword_only
    def __init__(self, **settings):
        own = self._input_kwargs  # the parent's constructor clears them
        super().__init__()
        self._setDefault(maxIter=20, maxDepth=5, maxBins=32, regLambda=0.0, leastHessian=1.0)
        self._set(**own)

    def _rounds(self) -> Rounds:
        rounds = super()._rounds()
        return replace(rounds, rate=8.0 * rounds.rate, newton=False, first_rate=4.0)


class BoostedTreesModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, probability and prediction; saved and loaded with its pipeline."""

    ensemble = Param(Params._dummy(), "ensemble", "edges and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._set(**self._input_kwargs)

    def getMaxIter(self) -> int:
        return len(self.booster.trees)

    @property
    def booster(self) -> Booster:
        return Booster.from_json(self.getOrDefault(self.ensemble))

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.getOrDefault(self.ensemble))  # bounded by the settings
        made: list[Booster] = []

        @F.pandas_udf("double")
        def margin(features: pd.Series) -> pd.Series:
            if not made:
                made.append(Booster.from_json(shared.value))
            return pd.Series(made[0].margins(np.stack(features.to_numpy()).astype(np.float64)) if len(features) else [], dtype=float)

        names = ("rawPrediction", "probability", "prediction")
        m = F.col("_margin")
        p = 1.0 / (1.0 + F.exp(-m))
        out = df.withColumn("_margin", margin(vector_to_array(F.col(self.getOrDefault(self.featuresCol)))))
        added = (array_to_vector(F.array(-m, m)), array_to_vector(F.array(1.0 - p, p)), F.when(m > 0, 1.0).otherwise(0.0))
        return out.withColumns(dict(zip(names, added))).drop("_margin")
