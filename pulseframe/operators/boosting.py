"""Gradient boosting over histograms, several models and classes at once.

Features are cut into bins once; a bin of its own holds missing values. The rows travel as blocks of packed bins, targets and
margins. A round grows one tree for each output (a class of a several-class model, or the one output of a regression), all of
them together, a wave at a time: each task brings its blocks' margins up to date, works out the gradients, drops its rows down
the trees as far as they have grown and adds up gradients per node, feature and bin; one aggregate adds the tasks' sums. Of two
sibling nodes only the smaller one is counted, the other is the parent less its sibling.

Where all cores can run at the same time, they grow the trees together in one job (``grown_together``): each task of a barrier stage keeps its rows
with their margins, and for every wave writes its sums to a file in the shared folder, a part of it for each task. A task adds up its part, some of the
features, and tells the others the best split of each node; all then split alike. The driver sees the finished trees only. Where the tasks
cannot all run at once, or a task would hold more than ``HELD`` rows, each wave is a job and the driver splits, as told below.

A tree grows best-first: of all its open leaves the one with the highest gain is split next, until it has enough leaves. A wave
asks for the children of every open leaf that the remaining splits could still reach, so a tree takes as many waves as it has
levels, not splits. A node of at most ``SMALL`` rows is not taken further in waves: one last pass deals the rows of all such nodes to
tasks, a node each, which grow what is left of the tree below it; the splits so found compete with the others by gain. Gradients are rounded to whole numbers of a small unit and summed as such: sums, and so trees, do not
depend on how the rows are dealt. Of a wave that is a job the driver holds the histograms of a round (outputs x leaves x features x bins).
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
import sys
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.names import ref
from pulseframe.session import discard, scratch

# Tasks get this module's functions by value, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The bin of missing values; the others are below it.
MISSING = 255
BLOCK_ROWS = 1 << 16
#: Rows of a node that one task may grow on alone (some 200 bytes each at a dozen features, so 200 MB).
SMALL = 1 << 20
#: Rows that a task of ``grown_together`` may hold (some 120 bytes each for four outputs, so 1 GB), and rows for which one more task pays.
HELD = 1 << 23
TASK_ROWS = 1 << 12
#: Rounds after which the margins are written with the rows, so that tasks catch up with few trees.
REFRESH = 10
#: Least sum of second derivatives on each side of a split.
LEAST_WEIGHT = 1e-3
UNIT_BITS = 28


@dataclass(frozen=True)
class Growth:
    """How trees grow. The settings of the risk model."""

    rounds: int = 100
    step: float = 0.1
    bins: int = 255
    leaves: int = 31
    smallest_leaf: int = 20


class Task(NamedTuple):
    """One model: a class number per row (``classes`` of them) or, with ``classes`` 0, a number; ``features`` by position."""

    target: str
    classes: int
    features: tuple[int, ...]

    @property
    def outputs(self) -> int:
        return self.classes or 1


class Tree(NamedTuple):
    """Nodes in arrays; ``feature`` is -1 at a leaf, whose value already has the step in it."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def add_to(self, margin: np.ndarray, bins: np.ndarray) -> None:
        """``bins`` is feature by row."""
        rows = {0: np.arange(bins.shape[1])}
        for node in range(len(self.feature)):
            mine = rows.pop(node)
            if self.feature[node] < 0:
                margin[mine] += self.value[node]
                continue
            goes = goes_left(bins[self.feature[node], mine], self.cut[node], self.missing_left[node])
            rows[int(self.left[node])], rows[int(self.right[node])] = mine[goes], mine[~goes]


def goes_left(bins: np.ndarray, cut: int, missing_left: bool) -> np.ndarray:
    left = bins <= cut
    return left | (bins == MISSING) if missing_left else left


@dataclass
class Node:
    sums: np.ndarray | None = None  # (3, features, 256): gradient, second derivative, rows
    total: tuple[int, int, int] = (0, 0, 0)
    split: tuple | None = None  # gain, feature, cut, missing_left, totals of the left side
    left: int = -1
    right: int = -1


@dataclass
class Growing:
    """A tree while it grows. ``unit`` is (of the gradient, of the second derivative); not ``eager``, it opens one leaf at a time."""

    features: tuple[int, ...]
    growth: Growth
    unit: tuple[float, float]
    total_rows: int
    small: int = SMALL
    eager: bool = True
    nodes: list[Node] = field(default_factory=lambda: [Node()])
    started: bool = False
    accepted: list[int] = field(default_factory=list)

    def wanted(self) -> list[int]:
        """Nodes whose histograms the next wave must bring; none once all leaves that count are small or cannot be split."""
        if not self.started:
            return [] if self.total_rows <= self.small else [0]
        out = []
        opened = [n for n in self.open_leaves() if self.nodes[n].total[2] > self.small]
        for node in opened:
            out += self._open(node)
        # Children too small to split need no histogram: the next look decides again.
        return out if out or not opened else self.wanted()

    def open_leaves(self) -> list[int]:
        """Split best-first as far as gains are known; the open leaves whose children must be looked at to go on.

        A leaf that must be looked at counts as split, so that no leaf is named that the splits left over cannot reach.
        """
        if not self.started:
            return [0]
        self.accepted, waiting, opened, leaves = [], [], [], 1
        if self.nodes[0].split:
            waiting.append((-self.nodes[0].split[0], 0))
        while waiting and leaves < self.growth.leaves:
            _, node = heapq.heappop(waiting)
            leaves += 1
            if self.nodes[node].left < 0:
                opened.append(node)
                if not self.eager:
                    break
                continue
            if not opened:
                self.accepted.append(node)
            for child in (self.nodes[node].left, self.nodes[node].right):
                if self.nodes[child].split:
                    heapq.heappush(waiting, (-self.nodes[child].split[0], child))
        return opened

    def _open(self, number: int) -> list[int]:
        """Give a node its children; the smaller one's histogram is wanted unless neither child can be split."""
        left, right = self._add_children(number)
        if max(left.total[2], right.total[2]) < 2 * self.growth.smallest_leaf:
            return []
        node = self.nodes[number]
        return [node.left if left.total[2] <= right.total[2] else node.right]

    def _add_children(self, number: int) -> tuple[Node, Node]:
        node = self.nodes[number]
        left = node.split[4]
        right = tuple(a - b for a, b in zip(node.total, left, strict=True))
        node.left, node.right = len(self.nodes), len(self.nodes) + 1
        self.nodes += [Node(total=left), Node(total=right)]
        return self.nodes[node.left], self.nodes[node.right]

    def graft(self, number: int, total: tuple[int, int, int], below: list[tuple[int, tuple, int, int]]) -> None:
        """Put the subtree that a task has grown (node, split, left, right; numbered from 0) in the place of an open leaf."""
        self.started = True
        self.nodes[number].total = total
        place = {0: number}
        for node, split, left, right in below:
            mine = place[node]
            self.nodes[mine].split = split
            if left >= 0:
                self._add_children(mine)
                place[left], place[right] = self.nodes[mine].left, self.nodes[mine].right

    def take(self, brought: dict[int, np.ndarray], width: int) -> None:
        """The wave's histograms; siblings follow by subtraction."""
        zero = np.zeros((3, width, 256), np.int64)
        if not self.started:
            self.started, root = True, self.nodes[0]
            root.sums = brought.get(0, zero)
            root.total = tuple(int(x) for x in root.sums[:, self.features[0]].sum(axis=1))
            root.split = self.best_split(root)
            return
        for node in self.nodes:
            if node.left < 0 or self.nodes[node.left].sums is not None or node.sums is None:
                continue
            pair = self.nodes[node.left], self.nodes[node.right]
            small = 0 if pair[0].total[2] <= pair[1].total[2] else 1
            if max(pair[0].total[2], pair[1].total[2]) >= 2 * self.growth.smallest_leaf:
                pair[small].sums = brought.get((node.left, node.right)[small], zero)
                pair[1 - small].sums = node.sums - pair[small].sums
                for child in pair:
                    child.split = self.best_split(child)
            node.sums = None  # its children have all that is still needed of it

    def best_split(self, node: Node) -> tuple | None:
        """The split of the highest gain; of equal ones missing values right before left, then the first feature and cut."""
        found = self.best_among(node, self.features, node.sums[:, list(self.features)])
        return found and (found[0], *found[2:])

    def best_among(self, node: Node, features: tuple[int, ...], chosen: np.ndarray) -> tuple | None:
        """The best split on some features, whose sums are ``chosen``: gain, side that missing values were tried on, and the rest of the split."""
        if node.total[2] < 2 * self.growth.smallest_leaf:
            return None
        total = np.array(node.total, np.int64)
        upto = np.cumsum(chosen[:, :, :MISSING], axis=2)
        sides = np.stack([upto, upto + chosen[:, :, MISSING:]])  # (missing right or left, sum, feature, cut)
        g, h, n = (sides[:, k] for k in range(3))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = self._worth(g, h) + self._worth(total[0] - g, total[1] - h) - self._worth(total[0], total[1])
        least = LEAST_WEIGHT / self.unit[1]
        sound = (n >= self.growth.smallest_leaf) & (total[2] - n >= self.growth.smallest_leaf) & (h >= least) & (total[1] - h >= least)
        sound[1] &= chosen[2, :, MISSING:] > 0
        gain = np.where(sound, gain, -np.inf)
        at = int(np.argmax(gain))
        side, feature, cut = (int(x) for x in np.unravel_index(at, gain.shape))
        if not gain[side, feature, cut] > 0:
            return None
        left = tuple(int(x) for x in sides[side, :, feature, cut])
        no_missing = chosen[2, feature, MISSING] == 0
        missing_left = 2 * left[2] > node.total[2] if no_missing else side == 1
        return float(gain[side, feature, cut]), side, features[feature], cut, bool(missing_left), left

    def _worth(self, g, h):
        g = np.asarray(g, np.float64) * self.unit[0]
        return g * g / (np.asarray(h, np.float64) * self.unit[1])

    def shape(self) -> list[tuple[int, int, int, bool, int, int]]:
        """Splits as far as the tree has been opened, parents first."""
        return [(i, *x.split[1:4], x.left, x.right) for i, x in enumerate(self.nodes) if x.left >= 0]

    def value(self, number: int) -> float:
        """Of a leaf, with the step in it."""
        g, h = self.nodes[number].total[0] * self.unit[0], self.nodes[number].total[1] * self.unit[1]
        return -self.growth.step * g / h if h > 0 else 0.0

    def finished(self) -> Tree:
        keep, number = set(self.accepted), {0: 0}
        order = [0]
        for node in order:
            if node in keep:
                for child in (self.nodes[node].left, self.nodes[node].right):
                    number[child] = len(order)
                    order.append(child)
        columns: list[list] = [[], [], [], [], [], []]
        for node in order:
            x = self.nodes[node]
            if node in keep:
                row = (x.split[1], x.split[2], x.split[3], number[x.left], number[x.right], 0.0)
            else:
                row = (-1, 0, False, -1, -1, self.value(node))
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        kinds = (np.int32, np.int32, bool, np.int32, np.int32, np.float64)
        return Tree(*(np.array(c, k) for c, k in zip(columns, kinds, strict=True)))


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=0))
    return e / e.sum(axis=0)


def gradients(tasks: list[Task], targets: list[np.ndarray], margin: np.ndarray, units: list[tuple[float, float]]) -> Iterator[tuple]:
    """(gradient, second derivative) of each output, in whole units; None for second derivatives that are all 1."""
    at = 0
    for task, target in zip(tasks, targets, strict=True):
        if task.classes:
            p = softmax(margin[at : at + task.classes])
            for k in range(task.classes):
                g, h = p[k] - (target == k), p[k] * (1 - p[k])
                yield np.rint(g / units[at + k][0]).astype(np.int64), np.rint(h / units[at + k][1]).astype(np.int64)
        else:
            yield np.rint((margin[at] - target) / units[at][0]).astype(np.int64), None
        at += task.outputs


def bin_numbers(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many edges are below each value; missing values have a bin of their own."""
    return np.where(np.isnan(values), MISSING, np.searchsorted(edges, values, side="left")).astype(np.uint8)


def bin_edges(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Edges of each column, at most ``bins - 1``: between neighbouring distinct values where these are few, else quantiles.

    A sketch says which columns have few distinct values; these are brought, and the quantiles of the other columns only are worked out.
    """
    if not 2 <= bins <= MISSING:
        raise ValueError(f"bins must be 2 to {MISSING}")
    value = {c: F.when(~F.isnan(ref(c).cast("double")), ref(c).cast("double")) for c in columns}
    points = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    about = df.agg(*[F.approx_count_distinct(value[c]).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    few = [i for i in range(len(columns)) if about[f"n{i}"] <= 2 * bins]
    known: dict[int, list[float]] = {i: [] for i in few}
    if few:
        each = F.array(*[F.struct(F.lit(i).alias("i"), value[columns[i]].alias("v")) for i in few])
        for i, v in df.select(F.explode(each).alias("x")).select("x.i", "x.v").where("v IS NOT NULL").distinct().collect():
            known[i].append(v)
    exact = {i: values for i, found in known.items() if len(values := np.unique(np.array(found, np.float64))) <= bins}
    other = [i for i in range(len(columns)) if i not in exact]
    told = df.agg(*[F.percentile_approx(value[columns[i]], points, 100 * bins).alias(f"q{i}") for i in other]).first() if other else {}
    return [
        (exact[i][1:] + exact[i][:-1]) / 2 if i in exact else np.unique(np.array(told[f"q{i}"] or [], np.float64))
        for i in range(len(columns))]


def packed(
    df: DataFrame, features: list[str], tasks: list[Task], edges: list[np.ndarray], base: np.ndarray, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Blocks of rows: bins (feature by row), targets, margins, each as bytes."""
    targets = [t.target for t in tasks]
    source = plain_rows(df, features, tasks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                column = lambda name: part.column(name).to_numpy(zero_copy_only=False).astype(np.float64)  # noqa: E731, B023
                bins = np.stack([bin_numbers(column(f"f{i}"), e) for i, e in enumerate(edges)])
                goals = np.stack([column(f"t{i}") for i in range(len(targets))])
                margin = np.repeat(base[:, None], part.num_rows, axis=1)
                yield block(part.num_rows, bins, goals, margin)

    return source.mapInArrow(pack, "n int, bins binary, targets binary, margins binary")


def block(n: int, bins: np.ndarray, targets: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([n], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (bins, targets, margin)]]
    return pa.RecordBatch.from_arrays(cells, ["n", "bins", "targets", "margins"])


def blocks(batches: Iterator[pa.RecordBatch], outputs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for n, *parts in zip(*(batch.column(c) for c in ("n", "bins", "targets", "margins")), strict=True):
            bins, targets, margin = (p.as_buffer() for p in parts)
            rows = n.as_py()
            yield (
                np.frombuffer(bins, np.uint8).reshape(-1, rows), np.frombuffer(targets, np.float64).reshape(-1, rows),
                np.frombuffer(margin, np.float64).reshape(outputs, rows).copy(),
            )


def caught_up(since: list[list[Tree]], units: list):
    """Task function: blocks with margins that have the trees ``since`` the last write in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(since)
        for bins, targets, margin in blocks(batches, len(units)):
            forest.add_to(margin, bins)
            yield block(bins.shape[1], bins, targets, margin)

    return run


class Forest:
    """Trees of some rounds, all gone through at once: each leaf is a bit, each split on which a row goes right takes away the bits of the
    leaves on its left, and the first bit that is left is the row's leaf. ``masks`` has what is left after all splits on a feature at a bin.

    Trees of over 64 leaves are gone through one by one.
    """

    def __init__(self, rounds: list[list[Tree]]):
        self.rounds = rounds
        flat = [tree for trees in rounds for tree in trees]
        most = max((int((t.feature < 0).sum()) for t in flat), default=0)
        self.masks: dict[int, np.ndarray] | None = None if most > 64 else {}
        if self.masks is None:
            return
        kind = np.uint32 if most <= 32 else np.uint64
        self.values = np.zeros((len(flat), 32 if most <= 32 else 64))
        every = np.arange(256, dtype=np.uint8)
        for i, t in enumerate(flat):
            for feature, cut, missing_left, first, after in self._numbered(t, self.values[i]):
                mask = self.masks.setdefault(feature, np.full((256, len(flat)), np.iinfo(kind).max, kind))
                mask[~goes_left(every, cut, missing_left), i] &= kind(~((1 << after) - (1 << first)) & int(np.iinfo(kind).max))

    @staticmethod
    def _numbered(tree: Tree, values: np.ndarray) -> Iterator[tuple[int, int, bool, int, int]]:
        """Feature, cut, side of missing values, first leaf on the left and first one after these, of each split; fills in leaf values."""
        leaves = 0
        waiting: list[tuple[int, int]] = [(0, -1)]
        while waiting:
            node, first = waiting.pop()
            if first >= 0:  # its left side is numbered
                yield int(tree.feature[node]), int(tree.cut[node]), bool(tree.missing_left[node]), first, leaves
            elif tree.feature[node] < 0:
                values[leaves] = tree.value[node]
                leaves += 1
            else:
                waiting += [(int(tree.right[node]), -1), (node, leaves), (int(tree.left[node]), -1)]

    def add_to(self, margin: np.ndarray, bins: np.ndarray) -> None:
        if self.masks is None:
            for trees in self.rounds:
                for k, tree in enumerate(trees):
                    tree.add_to(margin[k], bins)
            return
        count, outputs = len(self.values), len(margin)
        own = np.arange(count) * self.values.shape[1]
        step = (1 << 18) // max(count, 1) + 1
        for at in range(0, bins.shape[1] if count else 0, step):
            part, here = bins[:, at : at + step], margin[:, at : at + step]
            value = np.broadcast_to(self.values[:, 0], (part.shape[1], count))
            if self.masks:
                left = None
                for feature, mask in self.masks.items():
                    found = mask.take(part[feature], axis=0)
                    left = found if left is None else np.bitwise_and(left, found, out=left)
                value = self.values.ravel().take(first_bit(left) + own)
            for r in range(0, count, outputs):
                here += value[:, r : r + outputs].T


def first_bit(x: np.ndarray) -> np.ndarray:
    """Number of the lowest bit that is set, read off the exponent of that power of two."""
    lowest = x & (~x + x.dtype.type(1))
    if x.dtype == np.uint32:
        return (lowest.astype(np.float32).view(np.int32) >> 23) - 127
    return (lowest.astype(np.float64).view(np.int64) >> 52) - 1023


def dropped(rows: dict[int, np.ndarray], bins: np.ndarray, splits: list[tuple]) -> dict[int, np.ndarray]:
    """Rows of every node; ``rows`` has those of some, the splits are parents first."""
    for node, feature, cut, missing_left, left, right in splits:
        if left not in rows:
            goes = goes_left(bins[feature, rows[node]], cut, missing_left)
            rows[left], rows[right] = rows[node][goes], rows[node][~goes]
    return rows


class Codes(NamedTuple):
    """Features of few bins share one code, so that rows are added up once for all of them; ``used`` has the bins of each."""

    features: tuple[int, ...]
    used: tuple[np.ndarray, ...]
    code: np.ndarray


#: Codes that features share, at most; they stay in a core's cache. Below 2**16; the second is for many rows.
SHARED = 8192
SHARED_BY_MANY = 1 << 16


def fused(bins: np.ndarray, shared: int = SHARED) -> list[Codes]:
    """All features of ``bins`` (feature by row), those with the fewest bins together."""
    used = [np.flatnonzero(np.bincount(b, minlength=256)) for b in bins]
    groups: list[list[int]] = []
    size = 0
    for f in sorted(range(len(bins)), key=lambda f: len(used[f])):
        size = size * len(used[f])
        if not groups or size > shared:
            groups.append([])
            size = len(used[f])
        groups[-1].append(f)
    out = []
    for group in groups:
        code = np.zeros(bins.shape[1], np.uint16)
        for f in group:
            rank = np.zeros(256, np.uint16)
            rank[used[f]] = np.arange(len(used[f]))
            code *= np.uint16(len(used[f]))
            code += rank.take(bins[f])
        out.append(Codes(tuple(group), tuple(used[f] for f in group), code))
    return out


def histogram(codes: list[Codes], mine: np.ndarray, g: np.ndarray, h: np.ndarray | None) -> np.ndarray:
    """(3, features, 256) sums over the rows ``mine``."""
    weights = [None if x is None else x.take(mine).astype(np.float64) for x in (g, h)]
    return tabulated(codes, (c.code.take(mine) for c in codes), weights)


def tabulated(codes: list[Codes], held: Iterable[np.ndarray], weights: list[np.ndarray | None]) -> np.ndarray:
    """(3, features, 256) sums of rows, whose codes are ``held``. Whole numbers far below 2**53: the float sums of a block are exact."""
    out = np.zeros((3, sum(len(c.features) for c in codes), 256), np.int64)
    for (features, used, _), at in zip(codes, held, strict=True):
        shape, at = tuple(map(len, used)), at.astype(np.intp)
        sums = [None if w is None else np.bincount(at, w, math.prod(shape)) for w in weights] + [np.bincount(at, minlength=math.prod(shape))]
        for i, (f, bins) in enumerate(zip(features, used, strict=True)):
            others = tuple(j for j in range(len(shape)) if j != i)
            for k, each in enumerate(sums):
                if each is not None:
                    out[k, f, bins] = each.reshape(shape).sum(axis=others)
    if weights[1] is None:
        out[1] = out[2]
    return out


def loaded(batches: Iterator[pa.RecordBatch], features: int, targets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(bins by feature and row, targets) of all rows of a partition of blocks."""
    bins, goals = [np.zeros((features, 0), np.uint8)], [np.zeros((targets, 0))]
    for batch in batches:
        for n, x, y in zip(batch.column("n").to_pylist(), batch.column("bins"), batch.column("targets"), strict=True):
            bins.append(np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, n))
            goals.append(np.frombuffer(y.as_buffer(), np.float64).reshape(-1, n))
    return np.concatenate(bins, axis=1), list(np.concatenate(goals, axis=1))


class Exchange:
    """What tasks of a barrier stage tell one another, by files in a shared folder; a task is killed, and its waiting ends, when another one fails.

    (Spark's own barriers look once a second.) ``parts[task][output]`` has the places (feature x 256 + bin) whose sums a task adds up.
    """

    def __init__(self, here: BarrierTaskContext, path: str, parts: list[list[np.ndarray]]):
        self.me, self.of, self.parts, self.turn = here.partitionId(), len(parts), parts, 0
        self.store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))
        # A stage that starts again takes a folder of its own.
        self.root = f"{root}/{here.allGather(uuid.uuid4().hex)[0]}"
        self.store.create_dir(self.root, recursive=True)

    def _name(self, turn: int, task: int) -> str:
        return f"{self.root}/{turn}-{task}"

    def _shared(self, chunks: list[bytes], start: int = 0, length: int | None = None) -> list[pa.Buffer]:
        """Write this task's file of the turn, under its name once it is whole; the files of all tasks, or ``length`` bytes of each."""
        mine = self._name(self.turn, self.me)
        with self.store.open_output_stream(f"{mine}.part") as out:
            for chunk in chunks:
                out.write(chunk)
        self.store.move(f"{mine}.part", mine)
        found = []
        for task in range(self.of):
            name, pause = self._name(self.turn, task), 0.0005
            while self.store.get_file_info(name).type == fs.FileType.NotFound:
                time.sleep(pause)
                pause = min(2 * pause, 0.02)
            with self.store.open_input_file(name) as held:
                found.append(held.read_buffer() if length is None else held.read_at(length, start))
        if self.turn:  # all tasks are past the turn before
            self.store.delete_file(self._name(self.turn - 1, self.me))
        self.turn += 1
        return found

    def added_up(self, sums: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
        """``sums`` has (output, (3, features, 256)) in an order that is the same in all tasks; gives (3, places) of each."""
        chunks = [each.reshape(3, -1)[:, part[k]].tobytes() for part in self.parts for k, each in sums]
        sizes = [3 * sum(len(part[k]) for k, _ in sums) for part in self.parts]
        total = np.zeros(sizes[self.me], np.int64)
        for held in self._shared(chunks, 8 * sum(sizes[: self.me]), 8 * sizes[self.me]):
            total += np.frombuffer(held, np.int64)
        cuts = np.cumsum([3 * len(self.parts[self.me][k]) for k, _ in sums])[:-1]
        return [x.reshape(3, -1) for x in np.split(total, cuts)]

    def told(self, mine: list) -> list:
        """What each task says, to all of them."""
        return [x for said in self._shared([json.dumps(mine).encode()]) for x in json.loads(said.to_pybytes())]


class Held(NamedTuple):
    """The rows of a task: bins by feature, and the codes of ``codes``, four of a row in a word, so that one look brings four."""

    bins: np.ndarray
    codes: list[Codes]
    words: list[np.ndarray]

    @staticmethod
    def of(bins: np.ndarray) -> Held:
        codes = fused(bins, SHARED_BY_MANY if bins.shape[1] >= 1 << 18 else SHARED)
        words = []
        for at in range(0, len(codes), 4):
            four = np.zeros((bins.shape[1], 4), np.uint16)
            for j, c in enumerate(codes[at : at + 4]):
                four[:, j] = c.code
            words.append(four.view(np.uint64)[:, 0])
        return Held(bins, [c._replace(code=None) for c in codes], words)

    def histogram(self, mine: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """(3, features, 256) sums over the rows ``mine``; ``sums`` are as ``whole_gradients`` gives them."""
        some = lambda x: x if len(mine) == len(x) else x.take(mine)
        pairs = some(sums).view(np.int32).reshape(len(mine), sums.itemsize // 4)
        weights = [pairs[:, i].astype(np.float64) if i < pairs.shape[1] else None for i in range(2)]
        fours = [some(word).view(np.uint16).reshape(-1, 4) for word in self.words]
        return tabulated(self.codes, (fours[i // 4][:, i % 4] for i in range(len(self.codes))), weights)


class Member:
    """The rows that a task holds, and the trees of a round as far as they have grown; ``rows[output][node]`` are those of each open node."""

    def __init__(self, held: Held, growing: list[Growing], sums: list[np.ndarray]):
        self.held, self.growing, self.sums = held, growing, sums
        every = np.arange(held.bins.shape[1])
        self.rows = [{0: every} for _ in growing]

    def split(self, k: int) -> None:
        """Deal the rows of nodes that have got children to these."""
        rows, nodes = self.rows[k], self.growing[k].nodes
        waiting = [n for n in rows if nodes[n].left >= 0]
        while waiting:
            node = nodes[number := waiting.pop()]
            mine = rows.pop(number)
            goes = goes_left(self.held.bins[node.split[1]].take(mine), *node.split[2:4])
            rows[node.left], rows[node.right] = mine[goes], mine[~goes]
            waiting += [n for n in (node.left, node.right) if nodes[n].left >= 0]

    def histogram(self, k: int, number: int) -> np.ndarray:
        return self.held.histogram(self.rows[k][number], self.sums[k])

    def add_to(self, margin: np.ndarray) -> None:
        """Leaf values; a node that was opened but not split in the end is a leaf, whose rows its children have."""
        for k, tree in enumerate(self.growing):
            self.split(k)
            kept = set(tree.accepted)
            waiting: list[tuple[int, float | None]] = [(0, None)]
            while waiting:
                number, value = waiting.pop()
                if value is None and number not in kept:
                    value = tree.value(number)
                if number in self.rows[k]:
                    margin[k][self.rows[k][number]] += value
                else:
                    waiting += [(n, value) for n in (tree.nodes[number].left, tree.nodes[number].right)]


def grown_together(tasks: list[Task], edges: list[np.ndarray], base: np.ndarray, units: list, growth: Growth, n: int, path: str):
    """Function of the tasks of a barrier stage, which hold all rows between them: the first one gives the trees of all rounds."""
    owner = [t for t in tasks for _ in range(t.outputs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = BarrierTaskContext.get()
        me, of = here.partitionId(), len(here.getTaskInfos())
        bins, targets = loaded(batches, len(edges), len(tasks))
        mine = Held.of(bins)
        # The features of each output are dealt to the tasks.
        dealt, own = 0, [[[] for _ in owner] for _ in range(of)]
        for k, t in enumerate(owner):
            for f in t.features:
                own[dealt % of][k].append(f)
                dealt += 1
        places = [np.append(np.arange(len(e) + 1), MISSING) for e in edges]
        flat = [[np.concatenate([np.zeros(0, np.int64), *[f * 256 + places[f] for f in some]]) for some in each] for each in own]
        exchange = Exchange(here, path, flat)
        margin = np.repeat(base[:, None], bins.shape[1], axis=1)
        trees: list[list[Tree]] = []
        for _ in range(growth.rounds):
            growing = [Growing(t.features, growth, units[k], n, 0) for k, t in enumerate(owner)]
            member = Member(mine, growing, whole_gradients(tasks, targets, margin, units))
            held: list[dict[int, np.ndarray]] = [{} for _ in owner]
            while any(wanted := [g.wanted() for g in growing]):
                asked = [(k, node) for k, nodes in enumerate(wanted) for node in nodes]
                for k, nodes in enumerate(wanted):
                    if nodes:
                        member.split(k)
                sums = exchange.added_up([(k, member.histogram(k, node)) for k, node in asked])
                brought: list[dict[int, np.ndarray]] = [{} for _ in owner]
                for (k, node), each in zip(asked, sums, strict=True):
                    part = np.zeros((3, len(bins), 256), np.int64)
                    part.reshape(3, -1)[:, flat[me][k]] = each
                    brought[k][node] = part[:, own[me][k]]
                told = exchange.told([x for k, g in enumerate(growing) for x in judged(k, g, brought[k], held[k], own[me][k])])
                settled(growing, told)
            member.add_to(margin)
            trees.append([g.finished() for g in growing])
        if me == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([[tuple(t) for t in r] for r in trees])], pa.binary())], ["trees"])

    return run


def whole_gradients(tasks: list[Task], targets: list[np.ndarray], margin: np.ndarray, units: list, step: int = 1 << 15) -> list[np.ndarray]:
    """``gradients`` of all rows and outputs: four bytes each, which the units leave room for, and both of a row in one number where there are
    two; worked out for some rows at a time."""
    rows = margin.shape[1]
    out = [np.empty((rows, 2 if t.classes else 1), np.int32) for t in tasks for _ in range(t.outputs)]
    for at in range(0, rows, step):
        part = slice(at, at + step)
        for held, found in zip(out, gradients(tasks, [t[part] for t in targets], margin[:, part], units), strict=True):
            for i in range(held.shape[1]):
                held[part, i] = found[i]
    return [x.view(np.int64)[:, 0] if x.shape[1] == 2 else x[:, 0] for x in out]


def judged(k: int, tree: Growing, brought: dict[int, np.ndarray], held: dict[int, np.ndarray], own: list[int]) -> Iterator[list]:
    """The best split on a task's ``own`` features of each new node of output ``k``, and the root's totals. ``held`` are the sums of nodes without
    children; siblings follow by subtraction."""
    if not brought or not own:
        return
    if not tree.started:
        held[0] = brought[0]
        tree.nodes[0].total = tuple(int(x) for x in brought[0][:, 0].sum(axis=1))
        yield [k, 0, None, tree.nodes[0].total]
        new = [0]
    else:
        new = []
        for parent in [p for p in held if tree.nodes[p].left >= 0]:
            sums, pair = held.pop(parent), (tree.nodes[parent].left, tree.nodes[parent].right)
            for node, other in (pair, pair[::-1]):
                if node in brought:
                    held[node], held[other] = brought[node], sums - brought[node]
                    new += pair
    for node in new:
        if found := tree.best_among(tree.nodes[node], tuple(own), held[node]):
            yield [k, node, *found]


def settled(growing: list[Growing], told: list[list]) -> None:
    """Give each new node the best of the splits that the tasks found; of equal ones as ``best_split`` would."""
    best: dict[tuple[int, int], list] = {}
    for k, node, *found in told:
        if found[0] is None:
            growing[k].started, growing[k].nodes[node].total = True, tuple(found[1])
        elif (k, node) not in best or before(growing[k], found) < before(growing[k], best[k, node]):
            best[k, node] = found
    for (k, node), (gain, _, feature, cut, missing_left, left) in best.items():
        growing[k].nodes[node].split = gain, feature, cut, missing_left, tuple(left)


def before(tree: Growing, found: list) -> tuple:
    return -found[0], found[1], tree.features.index(found[2])


SUMS = "output int, node int, bin int, g long, h long, n long"


def counted(tasks: list[Task], units: list, since: list[list[Tree]], asked: list[tuple[list, list[int]]]):
    """Task function: sums of gradients per output, wanted node, feature and bin. ``asked`` has, per output, the splits so far and the
    wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        forest = Forest(since)
        for bins, targets, margin in blocks(batches, len(units)):
            forest.add_to(margin, bins)
            codes = fused(bins)
            for (k, (g, h)), (splits, wanted) in zip(enumerate(gradients(tasks, list(targets), margin, units)), asked, strict=True):
                rows = dropped({0: np.arange(bins.shape[1])}, bins, splits) if wanted else {}
                for node in wanted:
                    total = histogram(codes, rows[node], g, h)
                    held[k, node] = held[k, node] + total if (k, node) in held else total
        for (k, node), total in held.items():
            total = total.reshape(3, -1)
            at = np.flatnonzero(total[2])
            columns = [np.full(len(at), k, np.int32), np.full(len(at), node, np.int32), at.astype(np.int32), *total[:, at]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["output", "node", "bin", "g", "h", "n"])

    return run


ROWS = "slot int, n int, bins binary, g binary, h binary"


def thin(x: np.ndarray | None, mine: np.ndarray) -> bytes:
    """Numbers of some rows as bytes, four each where they fit; none for None."""
    if x is None:
        return b""
    part = x.take(mine)
    return (part.astype(np.int32) if np.abs(part).max() < 1 << 31 else part).tobytes()


def thick(held: list[pa.Scalar], sizes: list[int]) -> np.ndarray | None:
    """What ``thin`` made of several blocks."""
    parts = [x.as_buffer() for x in held]
    if not sum(p.size for p in parts):
        return None
    return np.concatenate([np.frombuffer(p, np.int32 if p.size == 4 * n else np.int64) for p, n in zip(parts, sizes, strict=True)]).astype(np.int64)


def handed_over(tasks: list[Task], units: list, since: list[list[Tree]], asked: list[tuple[list, list[int]]]):
    """Task function: the rows of the wanted nodes, with their gradients; ``slot`` counts the wanted nodes of all outputs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(since)
        for bins, targets, margin in blocks(batches, len(units)):
            forest.add_to(margin, bins)
            slot = 0
            for (g, h), (splits, wanted) in zip(gradients(tasks, list(targets), margin, units), asked, strict=True):
                rows = dropped({0: np.arange(bins.shape[1])}, bins, splits) if wanted else {}
                for slot, node in enumerate(wanted, slot):  # noqa: B007
                    mine = rows[node]
                    if len(mine):
                        cells = [pa.array([x], pa.int32()) for x in (slot, len(mine))]
                        cells += [pa.array([x], pa.binary()) for x in (bins[:, mine].tobytes(), thin(g, mine), thin(h, mine))]
                        yield pa.RecordBatch.from_arrays(cells, ["slot", "n", "bins", "g", "h"])
                slot += bool(wanted)

    return run


GROWN = (
    "slot int, below array<struct<node: int, gain: double, feature: int, cut: int, missing_left: boolean, g: bigint, h: bigint, "
    "n: bigint, left: int, right: int>>, g long, h long, n long"
)


def grown_alone(of_slot: list[tuple[tuple[int, ...], tuple[float, float], int]], growth: Growth):
    """Task function: best-first from the one small node whose rows a partition has, as far as its tree could still follow. ``of_slot`` has
    features, units and most leaves of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), HANDED)
        if not table.num_rows:
            return
        slot, sizes = table.column("slot")[0].as_py(), table.column("n").to_pylist()
        features, unit, leaves = of_slot[slot]
        parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, n) for x, n in zip(table.column("bins"), sizes, strict=True)]
        bins = np.concatenate(parts, axis=1)
        g, h = (thick(list(table.column(c)), sizes) for c in ("g", "h"))
        tree = Growing(features, replace(growth, leaves=leaves), unit, bins.shape[1], 0, False)
        codes, held = fused(bins), {0: np.arange(bins.shape[1])}
        while wanted := tree.wanted():
            dropped(held, bins, tree.shape())
            tree.take({n: histogram(codes, held[n], g, h) for n in wanted}, len(bins))
        below = [
            dict(node=i, gain=x.split[0], feature=x.split[1], cut=x.split[2], missing_left=x.split[3], g=x.split[4][0], h=x.split[4][1],
                 n=x.split[4][2], left=x.left, right=x.right)
            for i, x in enumerate(tree.nodes) if x.split
        ]
        total = tree.nodes[0].total
        yield pa.RecordBatch.from_pylist([dict(slot=slot, below=below, g=total[0], h=total[1], n=total[2])], GROWN_ARROW)

    return run


HANDED = pa.schema([("slot", pa.int32()), ("n", pa.int32()), ("bins", pa.binary()), ("g", pa.binary()), ("h", pa.binary())])
GROWN_ARROW = pa.schema([
    ("slot", pa.int32()),
    ("below", pa.list_(pa.struct([
        ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("cut", pa.int32()), ("missing_left", pa.bool_()),
        ("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("left", pa.int32()), ("right", pa.int32())]))),
    ("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
])


@dataclass
class Boosted:
    """A fitted model: margins are ``base`` plus the trees of all rounds; ``trees[round][output]``."""

    edges: list[np.ndarray]
    features: tuple[int, ...]
    classes: int
    base: np.ndarray
    trees: list[list[Tree]]

    @cached_property
    def forest(self) -> Forest:
        return Forest(self.trees)

    def margins(self, values: list[np.ndarray]) -> np.ndarray:
        """(output, row) of feature columns in the order they were fitted in."""
        bins = np.stack([bin_numbers(v, e) for v, e in zip(values, self.edges, strict=True)])
        out = np.repeat(self.base[:, None], bins.shape[1], axis=1)
        self.forest.add_to(out, bins)
        return out


def start_values(df: DataFrame, tasks: list[Task]) -> tuple[np.ndarray, list[tuple[float, float]], int]:
    """(first margins, units of gradients, rows): logs of class shares, means of numbers; one aggregate."""
    wanted = [F.count(F.lit(1)).alias("n")]
    for i, t in enumerate(tasks):
        goal = ref(t.target).cast("double")
        wanted += [F.count_if(goal == k).alias(f"c{i}_{k}") for k in range(t.classes)]
        wanted += [F.avg(goal).alias(f"mean{i}"), F.min(goal).alias(f"min{i}"), F.max(goal).alias(f"max{i}")]
    row = df.agg(*wanted).first()
    base, units = [], []
    for i, t in enumerate(tasks):
        if t.classes:
            base += [math.log(max(row[f"c{i}_{k}"], 0.5) / max(row["n"], 1)) for k in range(t.classes)]
            units += [(2.0**-UNIT_BITS, 2.0**-UNIT_BITS)] * t.classes
        else:
            mean = row[f"mean{i}"] or 0.0
            reach = max(abs((row[f"max{i}"] or 0.0) - mean), abs((row[f"min{i}"] or 0.0) - mean), 2.0**-40)
            base.append(mean)
            units.append((2.0 ** (math.ceil(math.log2(reach)) - UNIT_BITS), 1.0))
    return np.array(base), units, row["n"]


def running_at_once(spark: SparkSession) -> int:
    """Tasks that can run at the same time for as long as the session lasts; 0 where that cannot be told."""
    if str(spark.conf.get("spark.dynamicAllocation.enabled", "false")).lower() == "true":
        return 0
    try:
        context = spark.sparkContext._jsc.sc()
        return int(context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))
    except Exception:
        return 0


def fit_boosted(
    df: DataFrame, features: list[str], tasks: list[Task], growth: Growth | None = None, small: int | None = None
) -> list[Boosted]:
    """Fit all ``tasks`` side by side over one table. Rows with a missing target must be left out by the caller.

    A null or NaN feature is missing. An empty table, or one too small to split, gives models of the start values alone. With ``small``, each
    wave is a job and nodes of at most so many rows are finished in one task; without, that is so only where tasks cannot grow trees together.
    """
    growth = growth or Growth()
    spark = df.sparkSession
    edges = bin_edges(df, features, growth.bins)
    base, units, n = start_values(df, tasks)
    at_once = running_at_once(spark) if small is None else 0
    if 0 < n <= at_once * HELD:
        trees = by_barrier(df, features, tasks, edges, base, units, growth, n, min(at_once, -(-n // TASK_ROWS)))
    else:
        trees = by_waves(df, features, tasks, edges, base, units, growth, n, SMALL if small is None else small)
    out, at = [], 0
    for t in tasks:
        mine = slice(at, at + t.outputs)
        out.append(Boosted(edges, t.features, t.classes, base[mine], [r[mine] for r in trees]))
        at += t.outputs
    return out


def plain_rows(df: DataFrame, features: list[str], tasks: list[Task]) -> DataFrame:
    columns = [ref(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    return df.select(*columns, *[ref(t.target).cast("double").alias(f"t{i}") for i, t in enumerate(tasks)])


def by_barrier(
    df: DataFrame, features: list[str], tasks: list[Task], edges: list[np.ndarray], base: np.ndarray, units: list, growth: Growth, n: int, parts: int
) -> list[list[Tree]]:
    """All rounds in one job of ``parts`` tasks that run at the same time."""
    spark = df.sparkSession
    path = scratch(spark, "boosting")
    run = grown_together(tasks, edges, base, units, growth, n, path)
    # Rows are dealt where they come from few files; else blocks, small enough that all tasks get about as many rows.
    cores = spark.sparkContext.defaultParallelism
    dealt = df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
    blocks = packed(dealt, features, tasks, edges, base[:0], min(BLOCK_ROWS, 64 + n // (32 * parts))).select("n", "bins", "targets")
    try:
        # The shuffle behind it lets the stage start again as a whole when a task is lost, which a last stage may not.
        found = blocks.repartition(parts).mapInArrow(run, "trees binary", barrier=True).repartition(1).collect()
    finally:
        discard(spark, path)
    return [[Tree(*t) for t in r] for r in pickle.loads(found[0].trees)]


def by_waves(
    df: DataFrame, features: list[str], tasks: list[Task], edges: list[np.ndarray], base: np.ndarray, units: list, growth: Growth, n: int, small: int
) -> list[list[Tree]]:
    """A job for each wave."""
    spark = df.sparkSession
    owner = [t for t in tasks for _ in range(t.outputs)]
    trees: list[list[Tree]] = []
    path = scratch(spark, "boosting")
    # However few files the rows come from, all cores get blocks, and the same number of them.
    cores = spark.sparkContext.defaultParallelism
    dealt = df.repartition(cores * max(1, -(-n // (cores * BLOCK_ROWS))))
    packed(dealt, features, tasks, edges, base).write.parquet(path)
    held, written = spark.read.parquet(path).persist(), 0
    try:
        for done in range(growth.rounds if n else 0):
            growing = [Growing(t.features, growth, units[k], n, small) for k, t in enumerate(owner)]
            while any(left := [g.open_leaves() for g in growing]):
                if any(wanted := [g.wanted() for g in growing]):
                    asked = [(g.shape(), w) for g, w in zip(growing, wanted, strict=True)]
                    brought = collected(held.mapInArrow(counted(tasks, units, trees[written:], asked), SUMS), len(features))
                    for k, g in enumerate(growing):
                        if wanted[k]:
                            g.take(brought.get(k, {}), len(features))
                    continue
                left = [g.open_leaves() for g in growing]
                asked = [(g.shape(), w) for g, w in zip(growing, left, strict=True)]
                rows = held.mapInArrow(handed_over(tasks, units, trees[written:], asked), ROWS)
                slots = [(k, node) for k, nodes in enumerate(left) for node in nodes]
                of_slot = [(owner[k].features, units[k], growth.leaves - len(growing[k].accepted)) for k, _ in slots]
                # Exactly one node in a partition.
                dealt = rows.repartitionById(len(slots), F.col("slot"))
                for r in dealt.mapInArrow(grown_alone(of_slot, growth), GROWN).collect():
                    below = [(x.node, (x.gain, x.feature, x.cut, x.missing_left, (x.g, x.h, x.n)), x.left, x.right) for x in r.below]
                    k, node = slots[r.slot]
                    growing[k].graft(node, (r.g, r.h, r.n), below)
            trees.append([g.finished() for g in growing])
            if (done + 1) % REFRESH == 0 and done + 1 < growth.rounds:
                fresh = scratch(spark, "boosting")
                held.mapInArrow(caught_up(trees[written:], units), held.schema).write.parquet(fresh)
                held.unpersist()
                discard(spark, path)
                path, written = fresh, done + 1
                held = spark.read.parquet(path).persist()
    finally:
        held.unpersist()
        discard(spark, path)
    return trees


def collected(sums: DataFrame, width: int) -> dict[int, dict[int, np.ndarray]]:
    """A wave: the tasks' sums added up, as {output: {node: sums}}."""
    summed = sums.groupBy("output", "node", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    columns = [c.to_numpy() for c in summed.toArrow().columns]
    out: dict[int, dict[int, np.ndarray]] = {}
    if len(columns[0]):
        key = columns[0].astype(np.int64) << 32 | columns[1]
        for each in np.unique(key):
            at = np.flatnonzero(key == each)
            sums_of = np.zeros((3, width * 256), np.int64)
            sums_of[:, columns[2][at]] = np.stack([c[at] for c in columns[3:]])
            out.setdefault(int(each >> 32), {})[int(each & 0xFFFFFFFF)] = sums_of.reshape(3, width, 256)
    return out


TREES = (
    "model int, round int, output int, feature array<int>, cut array<int>, missing_left array<boolean>, left array<int>, "
    "right array<int>, value array<double>"
)
MODELS = "model int, features array<int>, classes int, base array<double>, edges array<array<double>>"


def save_boosted(spark: SparkSession, models: list[Boosted], path: str) -> None:
    """One row per model and one per tree."""
    about = [(i, list(m.features), m.classes, m.base.tolist(), [e.tolist() for e in m.edges]) for i, m in enumerate(models)]
    grown = [
        (i, r, k, *[x.tolist() for x in tree]) for i, m in enumerate(models) for r, trees in enumerate(m.trees) for k, tree in enumerate(trees)
    ]
    spark.createDataFrame(about, MODELS).coalesce(1).write.mode("overwrite").parquet(f"{path}/models")
    spark.createDataFrame(grown, TREES).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")


def load_boosted(spark: SparkSession, path: str) -> list[Boosted]:
    grown: dict[tuple[int, int], dict[int, Row]] = {}
    for row in spark.read.schema(TREES).parquet(f"{path}/trees").collect():
        grown.setdefault((row.model, row.round), {})[row.output] = row
    kinds = (np.int32, np.int32, bool, np.int32, np.int32, np.float64)

    def tree(row: Row) -> Tree:
        return Tree(*(np.array(x, k) for x, k in zip(row[3:], kinds, strict=True)))

    out = []
    for m in spark.read.schema(MODELS).parquet(f"{path}/models").orderBy("model").collect():
        rounds = sorted(r for i, r in grown if i == m.model)
        trees = [[tree(x) for _, x in sorted(grown[m.model, r].items())] for r in rounds]
        edges = [np.array(e, np.float64) for e in m.edges]
        out.append(Boosted(edges, tuple(m.features), m.classes, np.array(m.base, np.float64), trees))
    return out


def two_stage(features: list[Column], stage1: Boosted, stage2: Boosted) -> Column:
    """Struct of the first model's class and of the second model's number, which sees the class as a further feature.

    The trees run over Arrow batches.
    """
    width = len(features)
    _ = stage1.forest, stage2.forest  # made once, not in every task

    @F.arrow_udf("struct<class: int, number: double>")
    def run(rows: pa.Array) -> pa.Array:
        values = list(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T)
        signal = np.argmax(stage1.margins([*values, np.zeros(len(rows))]), axis=0)
        number = stage2.margins([*values, signal.astype(np.float64)])[0]
        return pa.StructArray.from_arrays([pa.array(signal, pa.int32()), pa.array(number)], ["class", "number"])

    return run(F.array(*[F.coalesce(f.cast("double"), F.lit(float("nan"))) for f in features]))
