"""Tree models grown by Spark: second-order boosting, and forests of any depth.

A node is an entry of a tree's arrays. Trees that don't depend on each other
(the classes of one boosting round, the trees of a forest) grow together:

- While a node has more than ``FIT_ROWS`` rows, its level is one job: each
  task adds up its rows' statistics in the bins of every feature, one shuffle
  adds the tasks' histograms of a node, and the split is chosen where they
  meet. One row a node reaches the driver.
- A node of at most ``FIT_ROWS`` rows is shuffled to one task, which grows the
  whole subtree. A hot node is above that size by definition, and split first.

Both ways sum the same statistics. Boosting uses the same bins in both, so
the size only decides where the work is done; a forest's large nodes split at
quantiles, its small ones at the middle of any two neighbouring values.

Rows carry an id. Bootstrap weights are a hash of (id, tree) and rows are
ordered by id in a task, so that a task that runs again gives the same tree.
"""

from __future__ import annotations

import json
import mmap
import tempfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .clean import materialize

FIT_ROWS = 250_000
BINS = 255           # at most; a missing value has a bin of its own
# Histograms of one job, at most, in cells: bounds a task's memory.
JOB_CELLS = 16 << 20
# Boosting rounds between two writings of the margins.
ROUNDS_KEPT = 10
# A subtree of more nodes is sent and kept as arrays, not as lists.
PACKED_NODES = 4096
# Subtrees that the driver fetches at once (each of FIT_ROWS rows at most), and bytes of trees that are sent to, and
# held by, a worker at once; rows that a worker scores with each such part of a model of several.
FETCHED = 8
PART_BYTES = 64 << 20
PART_ROWS = 1 << 16
# Trees of more nodes in all aren't compiled to expressions.
COMPILED_NODES = 200
TINY_GAIN = 1e-6
# Gains that differ by less than this share are equal.
TIE = 1e-10
MISSING = -1


# --- one tree -----------------------------------------------------------------

@dataclass
class Tree:
    """Node 0 is the root; ``feature`` is -1 at a leaf. Values <= ``cut`` go left."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0.0])
    missing_left: list = field(default_factory=lambda: [False])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    gain: list = field(default_factory=lambda: [0.0])
    value: list = field(default_factory=lambda: [[0.0]])

    def split(self, node: int, feature: int, cut: float, missing_left: bool, gain: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node] = int(feature), float(cut), bool(missing_left)
        self.left[node], self.right[node], self.gain[node] = at, at + 1, float(gain)
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0.0)
            self.missing_left.append(False)
            self.left.append(-1)
            self.right.append(-1)
            self.gain.append(0.0)
            self.value.append([0.0])
        return at, at + 1

    def graft(self, node: int, other: "Tree") -> None:
        """Put another tree's root in the place of a leaf."""
        at = len(self.feature) - 1          # other's node k > 0 becomes at + k
        for mine, new in ((self.left, other.left), (self.right, other.right)):
            new = [k + at if k > 0 else k for k in new]
            mine[node] = new[0]
            mine.extend(new[1:])
        for mine, new in ((self.feature, other.feature), (self.cut, other.cut), (self.missing_left, other.missing_left),
                          (self.gain, other.gain), (self.value, other.value)):
            mine[node] = new[0]
            mine.extend(new[1:])

    def depth(self) -> int:
        deep, level = 0, [0]
        while level := [c for n in level if self.feature[n] >= 0 for c in (self.left[n], self.right[n])]:
            deep += 1
        return deep


@dataclass
class Packed:
    """A tree of many nodes in arrays, about 18 bytes a node: the inner ones in order, and the leaves' values.

    ``low`` and ``high`` are a split's sides, at or below ``cut`` and above: the number of an inner
    node, or -1 less that of a leaf. Inner node 0 is the root, if there is one, else leaf 0."""
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    KINDS = ("<i2", "<f8", "?", "<i4", "<i4", "<f8")

    @staticmethod
    def of(tree: Tree, grafts: dict | None = None) -> "Packed":
        """``tree`` with the packed trees of ``grafts`` in the place of their leaves."""
        grafts = grafts or {}
        inner = np.array(tree.feature) >= 0
        own = np.array([not inner[k] and k not in grafts for k in range(len(inner))]) if grafts else ~inner
        refs = np.where(inner, np.cumsum(inner) - 1, -np.cumsum(own))
        n_inner, n_leaf = int(inner.sum()), int(own.sum())
        pieces = []
        for node, g in grafts.items():
            refs[node] = n_inner if len(g.feature) else -1 - n_leaf
            pieces.append((g, n_inner, n_leaf))
            n_inner, n_leaf = n_inner + len(g.feature), n_leaf + len(g.value)
        shift = lambda r, i, v: np.where(r >= 0, r + i, r - v)
        width = len(pieces[0][0].value[0]) if pieces else len(tree.value[0])
        value = np.array([v for v, o in zip(tree.value, own) if o], dtype=float).reshape(-1, width)
        parts = [(np.array(tree.feature)[inner], np.array(tree.cut, dtype=float)[inner], np.array(tree.missing_left)[inner],
                  refs[np.array(tree.left)[inner]], refs[np.array(tree.right)[inner]], np.array(tree.gain)[inner], value)]
        parts += [(g.feature, g.cut, g.missing_left, shift(g.low, i, v), shift(g.high, i, v), g.gain, g.value)
                  for g, i, v in pieces]
        cols = [np.concatenate(c) for c in zip(*parts)]
        return Packed(*[c.astype(k) for c, k in zip(cols, Packed.KINDS)], cols[-1])

    def tobytes(self) -> bytes:
        head = np.array([len(self.feature), *self.value.shape], dtype="<i8")
        return b"".join(a.tobytes() for a in (head, self.feature, self.cut, self.missing_left, self.low, self.high,
                                              self.gain, self.value))

    @staticmethod
    def frombytes(data, at: int = 0) -> "Packed":
        n, leaves, width = (int(v) for v in np.frombuffer(data, "<i8", 3, at))
        at, cols = at + 24, []
        for kind in Packed.KINDS:
            cols.append(np.frombuffer(data, kind, n, at))
            at += cols[-1].nbytes
        return Packed(*cols, np.frombuffer(data, "<f8", leaves * width, at).reshape(leaves, width))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``value``."""
        node = np.full(len(x), 0 if len(self.feature) else -1, dtype=np.int64)
        rows = np.flatnonzero(node >= 0)
        while len(rows):
            at = node[rows]
            v = x[rows, self.feature[at]]
            go = np.where(np.isnan(v), self.missing_left[at], v <= self.cut[at])
            node[rows] = at = np.where(go, self.low[at], self.high[at])
            rows = rows[at >= 0]
        return -1 - node


def mapped(trees: Iterable[bytes]) -> list[Packed]:
    """Packed trees in an unnamed file of this machine's temp folder, one after another: they grow with the training
    rows, and so take no memory that the system can't have back."""
    starts = []
    with tempfile.TemporaryFile(prefix="trees-") as f:
        for data in trees:
            starts.append(f.tell())
            f.write(data)
        f.flush()
        held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if starts else b""
    return [Packed.frombytes(held, at) for at in starts]


class Walker:
    """A tree as arrays, to find the leaves of many rows at once."""

    def __init__(self, tree: Tree):
        self.feature, self.cut = np.array(tree.feature), np.array(tree.cut)
        self.missing_left, self.value = np.array(tree.missing_left), np.array(tree.value)
        self.left, self.right = np.array(tree.left), np.array(tree.right)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, dtype=np.int64)
        while len(rows):
            at = node[rows]
            v = x[rows, self.feature[at]]
            go = np.where(np.isnan(v), self.missing_left[at], v <= self.cut[at])
            node[rows] = at = np.where(go, self.left[at], self.right[at])
            rows = rows[self.feature[at] >= 0]
        return node


# --- how a node is judged -----------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``newton``: columns gradient and hessian (variance: weighted target and weight, no
    penalty); ``gini``: a weight for each class. The last column counts rows."""
    kind: str
    reg: float = 0.0
    min_gain: float = 0.0
    min_child: float = 0.0
    to_purity: bool = False
    step: float = 1.0

    def score(self, s: np.ndarray, counted: bool = True) -> np.ndarray:
        """``counted``: whether ``s`` has the column that counts rows."""
        if self.kind == "gini":
            w = self.weight(s, counted)
            return sum(s[..., k] ** 2 for k in range(s.shape[-1] - counted)) / np.where(w > 0, w, 1.0)
        h = s[..., 1] + self.reg
        return s[..., 0] ** 2 / np.where(h > 0, h, 1.0)

    def weight(self, s: np.ndarray, counted: bool = True) -> np.ndarray:
        return sum(s[..., k] for k in range(s.shape[-1] - counted)) if self.kind == "gini" else s[..., 1]

    def value(self, s: np.ndarray) -> list:
        if self.kind == "gini":
            return (s[:-1] / max(s[:-1].sum(), 1e-300)).tolist()
        h = s[1] + self.reg
        return [float(self.step * s[0] / h) if h > 0 else 0.0]

    def values(self, s: np.ndarray) -> np.ndarray:
        """``value`` of every row."""
        if self.kind == "gini":
            return s[:, :-1] / np.maximum(s[:, :-1].sum(axis=1), 1e-300)[:, None]
        h = s[:, 1] + self.reg
        return np.where(h > 0, self.step * s[:, 0] / np.where(h > 0, h, 1.0), 0.0)[:, None]

    def better(self, gain: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Boosting leaves ties to the first feature, whatever the order of its sums."""
        if self.to_purity:
            return gain > best
        with np.errstate(invalid="ignore"):
            return gain - best > TIE * np.abs(gain)

    def usable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        # Half the last bit's worth of slack: sums in another order must not bar a split.
        low = self.min_child * (1 - 1e-12)
        return ((left[..., -1] > 0) & (right[..., -1] > 0)
                & (self.weight(left) >= low) & (self.weight(right) >= low))


def _both_sides(rule: Rule, left: np.ndarray, missing: np.ndarray | None, total: np.ndarray) -> tuple:
    """Gains with the missing rows, if any, on the right and on the left; the better, and which."""
    whole = rule.score(total)
    out = []
    for side in (left,) if missing is None else (left, left + missing):
        other = total - side
        gain = rule.score(side) + rule.score(other) - whole
        out.append(np.where(rule.usable(side, other), gain, -np.inf))
    if missing is None:
        return out[0], np.zeros(out[0].shape, dtype=bool)
    to_left = out[1] > out[0] + 1e-12 * np.abs(whole)
    return np.where(to_left, out[1], out[0]), to_left


# --- a subtree in one task ----------------------------------------------------

def _bins_of(x: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """The number of every value among its feature's; a missing one has the last number of all."""
    last = max([len(v) for v in values] + [1]) + 1
    return np.stack([np.where(np.isnan(x[:, f]), last, np.searchsorted(v, x[:, f]))
                     for f, v in enumerate(values)], axis=1).astype(np.int16 if last < 1 << 15 else np.int32)


def grow(x: np.ndarray, stats: np.ndarray, y: np.ndarray, rule: Rule, max_depth: int | None,
         per_node: int | None, cuts: list[np.ndarray] | None, key: list[int]) -> Tree:
    """A whole tree, level by level; with ``cuts`` on bins, else on values.

    With ``cuts``, ``x`` may already hold the numbers of the bins (``_bins_of``).

    ``per_node``: features tried at a node, drawn anew for each; more are
    tried until one can split it. A node goes on while it gains, or, to
    purity, while its rows' ``y`` differ and some feature parts them.

    Bins of a level are added up in one histogram while its cells are about
    as few as its rows. Else rows are read in the order of their values:
    every feature is sorted once, and a level only deals each order to the
    children, which keeps it sorted.
    """
    n, width = x.shape
    if cuts is None:
        values = [np.unique(x[:, f][~np.isnan(x[:, f])]) for f in range(width)]
    else:
        values = cuts
    size = max([len(v) for v in values] + [1]) + 2
    bins = x if x.dtype.kind == "i" else _bins_of(x, values)
    codes = np.ascontiguousarray(bins.T, dtype=np.int64)
    gaps = [bool((codes[f] == size - 1).any()) for f in range(width)]
    stats = np.asfortranarray(stats)
    cols = stats.shape[1]
    plain = [bool((stats[:, c] == 1).all()) for c in range(cols)]
    # Every row counts and no weight is asked for: both sides of an edge are usable, if no row is missing.
    sure = rule.min_child == 0 and bool((stats[:, -1] > 0).all())

    levels = []                  # arrays of the level's nodes
    rows, at, m, depth = np.arange(n), np.zeros(n, dtype=np.int64), min(n, 1), 0
    orders = None                # rows of each feature by (node, value, row)
    while m:
        first = np.searchsorted(at, np.arange(m))
        total = np.add.reduceat(stats[rows], first, axis=0)
        open_ = total[:, -1] > 1 if max_depth is None or depth < max_depth else np.zeros(m, dtype=bool)
        if rule.to_purity:
            open_ &= np.minimum.reduceat(y[rows], first) < np.maximum.reduceat(y[rows], first)
        best = np.full(m, -np.inf)
        chosen = np.zeros((m, 3), dtype=np.int64)      # feature, last code left, next code
        miss_left = np.zeros(m, dtype=bool)
        dense = cuts is not None and per_node is None and m * size <= max(4 * len(rows), 1 << 16)
        if not dense:
            # Rows of closed nodes are done.
            if not open_.all():
                live = open_[at]
                rows, at = rows[live], at[live]
                orders = None if orders is None else np.stack([o[live] for o in orders])
            if len(rows) and orders is None:
                orders = np.stack([rows[np.argsort(at * size + c[rows], kind="stable")] for c in codes])
            some = None
        if per_node is not None:
            seats = np.random.default_rng([*key, depth]).random((m, width)).argsort(axis=1)
        if dense:
            # All rows in their own order; those of no node of the level have one more, which is left out.
            corner = np.full(n, m * size)
            corner[rows] = at * size
            cells = np.empty((cols, m, size))
        for j in range(width if open_.any() else 0):
            tried = open_ if per_node is None or j < per_node else open_ & np.isinf(best)
            if not tried.any():
                break
            if dense:
                cell = corner + codes[j]
                number = np.bincount(cell, minlength=(m + 1) * size) if any(plain) else None
                for c in range(cols):
                    got = number if plain[c] else np.bincount(cell, stats[:, c], (m + 1) * size)
                    cells[c] = got[:m * size].reshape(m, size)
                sums = np.moveaxis(cells, 0, -1)
                left, lost = np.cumsum(sums[:, :-1], axis=1), sums[:, -1:]
                gain, to_left = _both_sides(rule, left, lost if gaps[j] else None, total[:, None])
                # A split is at a value that is there, as in the sorted order.
                gain = np.where(left[..., -1] > 0, gain, -np.inf)
                k = gain.argmax(axis=1)
                ids = np.arange(m)
                hit = np.flatnonzero(tried & rule.better(gain[ids, k], best))
                best[hit], miss_left[hit] = gain[hit, k[hit]], to_left[hit, k[hit]]
                chosen[hit, 0], chosen[hit, 1] = j, k[hit]
                continue
            if some is None or (per_node is not None and j >= per_node):
                # The same for all features that are tried at all open nodes.
                some = np.flatnonzero(tried[at])
                a = at[some]
                inside = a[1:] == a[:-1]
                begin = np.searchsorted(a, np.arange(m))
            f = np.full(m, j) if per_node is None else seats[:, j]
            if per_node is None:
                r = orders[j]
                c = codes[j].take(r)
            else:
                column = f.take(a)
                r = orders.ravel().take(column * len(at) + some)
                c = codes.ravel().take(column * n + r)
            edge = np.flatnonzero(inside & (c[1:] != c[:-1]))
            if not len(edge):
                continue
            gaps_here = any(gaps) if per_node is not None else gaps[j]
            counted = not sure or gaps_here
            used = cols if counted else cols - 1
            sums = np.stack([np.cumsum(stats[:, k].take(r)) for k in range(used)])
            before = np.where(begin > 0, sums[:, begin - 1], 0.0)
            e = a.take(edge)
            missing = None
            if gaps_here:
                missing = np.zeros((m, cols))
                lost = c == size - 1
                if lost.any():
                    np.add.at(missing, a[lost], stats[r[lost]])
                missing = missing[e]
            left = sums.take(edge, axis=1)
            left -= before.take(e, axis=1)
            whole = rule.score(total).take(e)
            if counted:
                gain, to_left = _both_sides(rule, left.T, missing, total.take(e, axis=0))
            else:
                right = total.T[:used].take(e, axis=1) - left
                gain = rule.score(left.T, False) + rule.score(right.T, False) - whole
                to_left = None
            groups = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
            top = np.maximum.reduceat(gain, groups)
            # The first edge of the greatest gain in each node.
            hits = np.flatnonzero(gain == np.repeat(top, np.diff(np.r_[groups, len(e)])))
            hits = hits[np.r_[True, e[hits][1:] != e[hits][:-1]]] if len(hits) else hits
            hits = hits[rule.better(top, best[e[groups]])]
            k = e[hits]
            best[k], miss_left[k] = gain[hits], False if to_left is None else to_left[hits]
            chosen[k, 0], chosen[k, 1], chosen[k, 2] = f[k], c[edge[hits]], c[edge[hits] + 1]
        if rule.to_purity:
            parts = np.isfinite(best)
        else:
            parts = best > max(rule.min_gain, TINY_GAIN)
        cut, split = np.zeros(m), np.flatnonzero(parts)
        for f in range(width):
            k = split[chosen[split, 0] == f]
            if not len(k):
                continue
            v, a, b = np.r_[values[f], np.inf], chosen[k, 1], chosen[k, 2]
            low = v[np.minimum(a, len(v) - 1)]
            if cuts is None:
                high = v[np.minimum(b, len(v) - 1)]
                with np.errstate(invalid="ignore"):
                    middle = (low + high) / 2
                # Infinite where only the missing rows go the other way.
                low = np.where(b == size - 1, np.inf, np.where((low <= middle) & (middle < high), middle, low))
            cut[k] = low
        levels.append((np.where(parts, chosen[:, 0], -1), cut, parts & miss_left, np.where(parts, best, 0.0), total))
        child = np.full(m, -1)
        child[split] = 2 * np.arange(len(split))
        keep = child[at] >= 0
        moved = np.full(n, -1)
        rows, at = rows[keep], at[keep]
        c = codes[chosen[at, 0], rows]
        moved[rows] = child[at] + np.where(c == size - 1, ~miss_left[at], c > chosen[at, 1])
        m, depth = 2 * len(split), depth + 1
        # 16 bits are sorted in linear time.
        moved = moved.astype(np.int16) if m < 1 << 15 else moved
        rows = rows[np.argsort(moved[rows], kind="stable")]
        at = moved[rows].astype(np.int64)
        if orders is not None:
            dealt = [(o, moved.take(o)) for o in orders]
            live = [(o[to >= 0], to[to >= 0]) for o, to in dealt]
            orders = np.stack([o.take(np.argsort(to, kind="stable")) for o, to in live])
    return _from_levels(levels, rule)


def _from_levels(levels: list[tuple], rule: Rule) -> Tree:
    """The levels' arrays as a tree; the children of a level's splits follow each other."""
    if not levels:
        return Tree()
    feature, cut, missing_left, gain, total = (np.concatenate(p) for p in zip(*levels))
    inner = feature >= 0
    left = np.where(inner, 2 * np.cumsum(inner) - 1, -1)
    return Tree(feature.tolist(), cut.tolist(), missing_left.tolist(), left.tolist(),
                np.where(inner, left + 1, -1).tolist(), gain.tolist(), rule.values(total).tolist())


# --- many trees by Spark ------------------------------------------------------

Stats = Callable[[np.ndarray, np.ndarray, np.ndarray, list, int], np.ndarray]


def _columns(batch: pa.RecordBatch) -> tuple:
    """ids, labels, features and margins of a batch."""
    n = batch.num_rows
    grid = [batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for k in (2, 3)]
    return (batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), *grid)


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of at least ``rows`` rows, but for the last."""
    block, n = [], 0
    for batch in batches:
        block.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield block
            block, n = [], 0
    if block:
        yield block


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers; a missing value is in the bin after the last."""
    return np.stack([np.where(np.isnan(x[:, f]), len(c) + 1, np.searchsorted(c, x[:, f]))
                     for f, c in enumerate(cuts)], axis=1)


def _best_of(hist: np.ndarray, cuts: list[np.ndarray], rule: Rule, tried: np.ndarray | None) -> tuple:
    """(gain, feature, cut, missing left, statistics left) from a node's histogram of (bins, columns)."""
    best = (-np.inf, 0, 0.0, False, None)
    at = 0
    for f, c in enumerate(cuts):
        cells = hist[at:at + len(c) + 2]
        at += len(c) + 2
        if tried is not None and f not in tried:
            continue
        left = np.cumsum(cells[:-1], axis=0)
        missing = cells[-1]
        gain, to_left = _both_sides(rule, left, missing, cells.sum(axis=0))
        k = int(np.argmax(gain))
        if rule.better(gain[k], best[0]):
            best = (gain[k], f, c[k] if k < len(c) else np.inf, to_left[k], left[k] + (missing if to_left[k] else 0))
    return best


def _level(data: DataFrame, trees: list[Tree], slots: list[tuple[int, int]], prepare, stats: Stats, rule: Rule,
           cuts: list[np.ndarray], per_node: int | None, seed: int) -> dict:
    """The best split of every (tree, node) in ``slots``: one grouped histogram job."""
    number = {s: k for k, s in enumerate(slots)}
    used = sorted({t for t, _ in slots})
    base = np.concatenate([[0], np.cumsum([len(c) + 2 for c in cuts])])
    cells = int(base[-1])
    partial = {t: trees[t] for t in used}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walkers = {t: Walker(tree) for t, tree in partial.items()}
        sums, state = {}, prepare()
        for batch in _batches(batches):
            ids, y, x, margin = _columns(batch)
            shared = state(x, margin)
            bins = _binned(x, cuts) + base[:-1]
            for t, walker in walkers.items():
                s = stats(ids, y, shared, t)
                leaf = walker.leaves(x)
                for node in np.unique(leaf):
                    k = number.get((t, int(node)))
                    mine = (leaf == node) & (s[:, -1] > 0)
                    if k is None or not mine.any():
                        continue
                    total = sums.setdefault(k, np.zeros((cells, s.shape[1])))
                    where = bins[mine].ravel()
                    for c in range(s.shape[1]):
                        total[:, c] += np.bincount(where, np.repeat(s[mine, c], len(cuts)), cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["slot", "hist"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for slot, hist in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = np.frombuffer(hist.as_buffer(), dtype=np.float64).reshape(cells, -1)
                sums[slot] = sums[slot] + h if slot in sums else h
        out = []
        for slot, hist in sums.items():
            t, node = slots[slot]
            tried = None
            if per_node is not None:
                tried = np.random.default_rng([seed, t, node, 1 << 20]).permutation(len(cuts))[:per_node]
            total = hist[:len(cuts[0]) + 2].sum(axis=0)
            gain, f, cut, miss, left = _best_of(hist, cuts, rule, tried)
            if tried is not None and not np.isfinite(gain):
                gain, f, cut, miss, left = _best_of(hist, cuts, rule, None)
            left = total if left is None else left
            out.append((slot, gain, f, cut, bool(miss), total.tolist(), left.tolist()))
        cols = list(zip(*out)) if out else [()] * 7
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_(), pa.list_(pa.float64()),
                 pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["slot", "gain", "feature", "cut", "miss", "total", "at_left"])

    parts = max(1, min(len(slots), data.sparkSession.sparkContext.defaultParallelism))
    found = (data.mapInArrow(add, "slot long, hist binary").repartitionById(parts, F.col("slot").cast("int"))
             .mapInArrow(choose, "slot long, gain double, feature long, cut double, miss boolean, "
                         "total array<double>, at_left array<double>").collect())
    return {slots[r.slot]: r for r in found}


def _subtrees(data: DataFrame, trees: list[Tree], slots: list[tuple[int, int, int]], prepare, stats: Stats,
              rule: Rule, max_depth: int | None, cuts: list[np.ndarray] | None, per_node: int | None,
              seed: int, large: bool = False) -> dict:
    """The whole subtree of every (tree, node, depth) in ``slots``, one task at a time each."""
    number = {(t, node): k for k, (t, node, _) in enumerate(slots)}
    used = sorted({t for t, _, _ in slots})
    partial = {t: trees[t] for t in used}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walkers = {t: Walker(tree) for t, tree in partial.items()}
        state = prepare()
        for batch in _batches(batches):
            ids, y, x, margin = _columns(batch)
            shared = state(x, margin)
            values = x if cuts is None else _bins_of(x, cuts)
            for t, walker in walkers.items():
                s = stats(ids, y, shared, t)
                leaf = walker.leaves(x)
                slot, block, grid = [], [], []
                for node in np.unique(leaf):
                    k = number.get((t, int(node)))
                    mine = (leaf == node) & (s[:, -1] > 0)
                    if k is not None and mine.any():
                        slot.append(k)
                        block.append(np.hstack([ids[mine, None].view(np.float64), y[mine, None], s[mine]]).tobytes())
                        grid.append(values[mine].tobytes())
                if slot:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot, pa.int64()), pa.array([s.shape[1]] * len(slot), pa.int64()),
                         pa.array([x.shape[1]] * len(slot), pa.int64()), pa.array(block, pa.binary()),
                         pa.array([values.dtype.str] * len(slot), pa.string()), pa.array(grid, pa.binary())],
                        names=["slot", "n_stats", "width", "block", "kind", "grid"])

    def finish(slot: int, blocks: list[np.ndarray], grids: list[np.ndarray]) -> pa.RecordBatch:
        rows, x = np.concatenate(blocks), np.concatenate(grids)
        order = np.argsort(rows[:, 0].copy().view(np.int64), kind="stable")
        rows, x = rows[order], x[order]
        t, node, depth = slots[slot]
        left = None if max_depth is None else max_depth - depth
        tree = grow(x, rows[:, 2:], rows[:, 1], rule, left, per_node, cuts, [seed, t, node])
        large = len(tree.feature) > PACKED_NODES
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int64()), pa.array([None if large else json.dumps(vars(tree))], pa.string()),
             pa.array([Packed.of(tree).tobytes() if large else None], pa.binary())], names=["slot", "tree", "packed"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, grids = None, [], []
        for batch in batches:
            for k in range(batch.num_rows):
                slot, n_stats, width = (batch.column(c)[k].as_py() for c in range(3))
                if now is not None and slot != now:
                    yield finish(now, blocks, grids)
                    blocks, grids = [], []
                now = slot
                blocks.append(np.frombuffer(batch.column(3)[k].as_buffer(), dtype=np.float64).reshape(-1, 2 + n_stats))
                grids.append(np.frombuffer(batch.column(5)[k].as_buffer(), batch.column(4)[k].as_py()).reshape(-1, width))
        if now is not None:
            yield finish(now, blocks, grids)

    # Slots are dealt in turn: by hash, one task could get most of the trees.
    parts = max(1, min(len(slots), data.sparkSession.sparkContext.defaultParallelism * 2))
    found = (data.mapInArrow(deal, "slot long, n_stats long, width long, block binary, kind string, grid binary")
             .repartitionById(parts, F.col("slot").cast("int")).sortWithinPartitions("slot")
             .mapInArrow(build, "slot long, tree string, packed binary"))
    # Many large trees are written and fetched a few at a time; the driver never has them all in memory.
    rows = found.collect() if not large else \
        materialize(found, "trees").repartition(-(-len(slots) // FETCHED)).toLocalIterator()
    done, keys = {}, []

    def packed() -> Iterator[bytes]:
        for r in rows:
            if r.packed:
                keys.append(slots[r.slot])
                yield r.packed
            else:
                done[slots[r.slot]] = Tree(**json.loads(r.tree))
    large_ones = mapped(packed())
    return done | dict(zip(keys, large_ones))


def grow_trees(data: DataFrame, n_rows: int, n_trees: int, prepare, stats: Stats, rule: Rule,
               max_depth: int | None, cuts: list[np.ndarray], exact: bool, per_node: int | None = None,
               seed: int = 0, fit_rows: int | None = None, n_stats: int = 3) -> list:
    """``n_trees`` independent trees over ``data`` (id, label, x, margin)."""
    fit_rows = FIT_ROWS if fit_rows is None else fit_rows
    trees = [Tree() for _ in range(n_trees)]
    large = [(t, 0, 0) for t in range(n_trees)] if n_rows > fit_rows else []
    small = [] if large else [(t, 0, 0) for t in range(n_trees)] if n_rows else []
    cells = sum(len(c) + 2 for c in cuts) * n_stats
    at_once = max(1, JOB_CELLS // cells)
    while large:
        grown = []
        for k in range(0, len(large), at_once):
            some = large[k:k + at_once]
            got = _level(data, trees, [(t, node) for t, node, _ in some], prepare, stats, rule, cuts, per_node, seed)
            for t, node, depth in some:
                r = got.get((t, node))
                if r is None:
                    continue
                tree, total = trees[t], np.array(r.total)
                tree.value[node] = rule.value(total)
                least = max(rule.min_gain, TINY_GAIN if not rule.to_purity else 1e-12 * abs(rule.score(total)))
                if not r.gain > least or (max_depth is not None and depth >= max_depth):
                    continue
                parts = [np.array(r.at_left), total - np.array(r.at_left)]
                for child, s in zip(tree.split(node, r.feature, r.cut, r.miss, r.gain), parts):
                    tree.value[child] = rule.value(s)
                    if max_depth is None or depth + 1 < max_depth:
                        (grown if s[-1] > fit_rows else small).append((t, child, depth + 1))
        large = grown
    if small:
        large = max_depth is None or 2 ** max_depth > PACKED_NODES
        done = _subtrees(data, trees, small, prepare, stats, rule, max_depth, None if exact else cuts, per_node, seed,
                         large)
        packed: dict = {}
        for (t, node, _), tree in done.items():
            if isinstance(tree, Packed):
                packed.setdefault(t, {})[node] = tree
            else:
                trees[t].graft(node, tree)
        whole = mapped(Packed.of(trees[t], grafts).tobytes() for t, grafts in packed.items())
        for t, tree in zip(packed, whole):
            trees[t] = tree
    return trees


# --- models -------------------------------------------------------------------

@dataclass
class TreeModel:
    """``kind``: softmax or sum (boosting), vote or mean (forest). Trees of an output are ``outputs`` apart."""
    kind: str
    outputs: int
    width: int
    base: list
    trees: list

    @property
    def numClasses(self) -> int:  # noqa: N802 (the name of Spark's models)
        return self.outputs

    @property
    def learns_missing(self) -> bool:
        return self.kind in ("softmax", "sum")

    @property
    def featureImportances(self) -> np.ndarray:  # noqa: N802
        """Forests: mean over trees of each one's share of the gain; boosting: mean gain of a feature's splits."""
        total, uses = np.zeros(self.width), np.zeros(self.width)
        for tree in self.trees:
            f, g = np.array(tree.feature), np.array(tree.gain)
            mine = np.bincount(f[f >= 0], g[f >= 0], self.width)
            if self.learns_missing:
                total += mine
                uses += np.bincount(f[f >= 0], minlength=self.width)
            elif mine.sum() > 0:
                total += mine / mine.sum()
        total = total / np.maximum(uses, 1) if self.learns_missing else total
        return total / total.sum() if total.sum() > 0 else total

    def _out(self, k: int) -> int:
        return k % self.outputs if self.kind == "softmax" else 0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Margins (boosting), class shares or means (forests): a column for each output."""
        return self._scores(x, [(0, self._walkers())], len(self.trees))

    def _scores(self, x: np.ndarray, parts: Iterable[tuple[int, list]], n_trees: int) -> np.ndarray:
        """``parts``: the number of a part's first tree, and its trees to walk, in order."""
        out = np.tile(np.array(self.base, dtype=float), (len(x), 1))
        for first, walkers in parts:
            for k, walker in enumerate(walkers, first):
                got = walker.value[walker.leaves(x)]
                if self.learns_missing:
                    out[:, self._out(k)] += got[:, 0]
                else:
                    out += got
        return out if self.learns_missing else out / max(n_trees, 1)

    def _walkers(self) -> list[Walker]:
        if "_cache" not in self.__dict__:
            self.__dict__["_cache"] = [t if isinstance(t, Packed) else Walker(t) for t in self.trees]
        return self.__dict__["_cache"]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_cache", "_held")}

    def _parts(self) -> Iterator[tuple[int, list]]:
        """The trees to walk in parts of ``PART_BYTES`` at most, or of one tree, with the number of the first."""
        first, size, walkers = 0, 0, self._walkers()
        for k, w in enumerate(walkers):
            own = sum(v.nbytes for v in vars(w).values())
            if k > first and size + own > PART_BYTES:
                yield first, walkers[first:k]
                first, size = k, 0
            size += own
        yield first, walkers[first:]

    def _on_workers(self, spark: SparkSession) -> list:
        """The parts for tasks, each sent once."""
        if "_held" not in self.__dict__:
            self.__dict__["_held"] = [(first, spark.sparkContext.broadcast(part)) for first, part in self._parts()]
        return self.__dict__["_held"]

    def _compiled(self, leaf: Callable, branch: Callable, add: Callable, over: Callable) -> list:
        """The scores built from ``leaf(value)``, ``branch(feature, cut, missing left, left, right)`` and sums."""
        def walk(tree: Tree, node: int, col: int):
            if tree.feature[node] < 0:
                return leaf(float(tree.value[node][col]))
            return branch(tree.feature[node], tree.cut[node], tree.missing_left[node],
                          walk(tree, tree.left[node], col), walk(tree, tree.right[node], col))
        cols = [leaf(float(b)) for b in self.base]
        for k, tree in enumerate(self.trees):
            if self.learns_missing:
                cols[self._out(k)] = add(cols[self._out(k)], walk(tree, 0, 0))
            else:
                cols = [add(c, walk(tree, 0, j)) for j, c in enumerate(cols)]
        return cols if self.learns_missing else [over(c, leaf(float(max(len(self.trees), 1)))) for c in cols]

    def expressions(self, x: list[Column]) -> list[Column]:
        """The scores as expressions, one for each output; for small models."""
        def branch(f, cut, missing_left, left, right):
            gap = x[f].isNull() | F.isnan(x[f])
            go = (gap | (x[f] <= F.lit(cut))) if missing_left else (~gap & (x[f] <= F.lit(cut)))
            return F.when(go, left).otherwise(right)
        return self._compiled(F.lit, branch, lambda a, b: a + b, lambda a, b: a / b)

    def sql(self, x: list[str]) -> list[str]:
        """The same scores as SQL text over column expressions; a missing value is NULL there."""
        def branch(f, cut, missing_left, left, right):
            gap = f"OR {x[f]} IS NULL" if missing_left else f"AND {x[f]} IS NOT NULL"
            return f"CASE WHEN {x[f]} <= {cut!r} {gap} THEN {left} ELSE {right} END"
        return self._compiled(lambda v: f"CAST({v!r} AS DOUBLE)", branch, lambda a, b: f"{a} + {b}",
                              lambda a, b: f"({a}) / {b}")

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction",
                  scores: str | None = None) -> DataFrame:
        """``df`` with the prediction (class number or value) and, if named, the scores.

        A small model is compiled to expressions; a large one runs over Arrow
        batches. Both add up the trees in the same order.
        """
        x = vector_to_array(F.col(features))
        small = not any(isinstance(t, Packed) for t in self.trees)
        if small and sum(len(t.feature) for t in self.trees) <= COMPILED_NODES:
            got = F.array(*self.expressions([F.get(F.col("_x"), k) for k in range(self.width)]))
            out = df.withColumn("_x", x).withColumn("_s", got).drop("_x")
        else:
            out = self._batched(df, features, x)
        best = F.col("_s")[0] if self.kind in ("sum", "mean") else \
            (F.array_position("_s", F.array_max("_s")) - 1).cast("double")
        out = out.withColumn(prediction, best)
        return out.withColumnRenamed("_s", scores) if scores else out.drop("_s")

    def _batched(self, df: DataFrame, features: str, x: Column) -> DataFrame:
        width, held, n_trees = self.width, self._on_workers(df.sparkSession), len(self.trees)
        frame = TreeModel(self.kind, self.outputs, self.width, self.base, [])

        def parts() -> Iterator[tuple[int, list]]:
            for first, part in held:
                yield first, part.value
                if len(held) > 1:
                    # A worker that kept every part would hold the whole model; it is read from disk again.
                    vars(part).pop("_value", None)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(_batches(batches), PART_ROWS if len(held) > 1 else 1):
                x = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for b in block])
                scores, start = frame._scores(x, parts(), n_trees), 0
                for batch in block:
                    s = scores[start:start + batch.num_rows]
                    start += len(s)
                    at = pa.array(np.arange(len(s) + 1, dtype=np.int32) * s.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.ListArray.from_arrays(at, pa.array(s.ravel()))], names=["row", "_s"])
        rows = df.select(F.struct(*[c for c in df.columns if c != features]).alias("row"), x.alias("x"))
        schema = rows.select("row", F.array(F.lit(0.0)).alias("_s")).schema
        return rows.mapInArrow(run, schema).select("row.*", "_s")

    def probabilities(self, scores: Column) -> Column:
        """Class probabilities of the scores: softmax of margins, or the class shares themselves."""
        if self.kind != "softmax":
            return scores
        e = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
        return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))

    def save(self, spark: SparkSession, path: str) -> None:
        kinds = "tree int, body string, packed binary"
        rows = [(-1, json.dumps([self.kind, self.outputs, self.width, self.base]), None)]
        spark.createDataFrame(rows, kinds).write.mode("overwrite").parquet(path)
        for first, part in self._parts():
            rows = [(k, None, bytearray(t.tobytes())) if isinstance(t, Packed) else (k, json.dumps(vars(t)), None)
                    for k, t in enumerate(self.trees[first:first + len(part)], first)]
            spark.createDataFrame(rows, kinds).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        stored = spark.read.parquet(path)
        if "packed" not in stored.columns:
            stored = stored.withColumn("packed", F.lit(None).cast("binary"))
        head = json.loads(stored.where("tree < 0").first().body)
        trees, keys = {}, []

        def packed() -> Iterator[bytes]:
            for r in stored.where("tree >= 0").toLocalIterator():
                if r.packed:
                    keys.append(r.tree)
                    yield r.packed
                else:
                    trees[r.tree] = Tree(**json.loads(r.body))
        large = mapped(packed())
        trees |= dict(zip(keys, large))
        return TreeModel(*head, [trees[k] for k in sorted(trees)])


def table_for(df: DataFrame, id_col: str, margins: list | None = None) -> DataFrame:
    """``df`` (features, label, id) as the rows that trees grow on, written to the shared folder."""
    start = F.array(*[F.lit(float(m)) for m in margins or [0.0]])
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
                     F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"),
                     start.alias("margin"))
    return materialize(rows, "tree-rows")


def quantile_cuts(data: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Cut points of every feature at equal shares of rows, from one mergeable sketch each, in one pass."""
    probs = F.split(F.lit(" ".join(str(k / bins) for k in range(1, bins))), " ").cast("array<double>")
    one = lambda k: F.when(~F.isnan(F.get("x", k)), F.get("x", k))
    got = data.agg(*[F.percentile_approx(one(k), probs, 100 * bins).alias(f"q{k}") for k in range(width)]).first()
    return [np.unique(np.array(q if q is not None else [], dtype=float)) for q in got]


def _none():
    return lambda x, margin: None


@dataclass
class BoostedTrees:
    """Regularised second-order boosting: ``task`` class (softmax, a tree for each class and round) or value."""
    task: str
    rounds: int = 100
    depth: int = 6
    step: float = 0.3
    reg: float = 1.0
    min_gain: float = 0.0
    min_child: float = 1.0
    bins: int = BINS
    seed: int = 0
    id_col: str = "applicant_id"
    cuts: list | None = None

    def fit(self, df: DataFrame) -> TreeModel:
        """``df`` has ``features`` (a vector; NaN is missing), ``label`` and the id."""
        first = df.agg(F.count(F.lit(1)), F.max("label"), F.avg("label"), F.max(F.size(vector_to_array("features")))).first()
        n, top, mean, width = first
        if not n:
            raise ValueError("no training rows")
        outputs = int(top) + 1 if self.task == "class" else 1
        base = [0.5] * outputs if self.task == "class" else [float(mean)]
        model = TreeModel("softmax" if self.task == "class" else "sum", outputs, width, base, [])
        data = table_for(df, self.id_col, base).persist(StorageLevel.MEMORY_AND_DISK)
        cuts = self.cuts if self.cuts is not None else quantile_cuts(data, width, self.bins)
        rule = Rule("newton", self.reg, self.min_gain, self.min_child, step=self.step)
        pending: list[Tree] = []
        for r in range(self.rounds):
            trees = grow_trees(data, n, outputs, self._margins(pending, outputs), self._stats, rule, self.depth, cuts,
                               exact=False, seed=self.seed)
            pending += trees
            model.trees += trees
            if (r + 1) % ROUNDS_KEPT == 0 and r + 1 < self.rounds:
                new = materialize(self._advance(data, pending, outputs), "tree-rows").persist(StorageLevel.MEMORY_AND_DISK)
                data.unpersist()
                data, pending = new, []
        data.unpersist()
        return model

    @staticmethod
    def _margins(pending: list[Tree], outputs: int):
        """Per task: a function from (features, margins) to margins after the pending trees."""
        trees = list(pending)

        def prepare():
            walkers = [Walker(t) for t in trees]

            def state(x, margin):
                margin = margin.copy()
                for k, w in enumerate(walkers):
                    margin[:, k % outputs] += w.value[w.leaves(x), 0]
                return margin
            return state
        return prepare

    def _stats(self, ids, y, margin, t) -> np.ndarray:
        """Negative gradient, hessian and one, of output ``t``."""
        if self.task == "value":
            return np.stack([y - margin[:, 0], np.ones(len(y)), np.ones(len(y))], axis=1)
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        p = p[:, t] / p.sum(axis=1)
        return np.stack([(y == t) - p, np.maximum(2 * p * (1 - p), 1e-16), np.ones(len(y))], axis=1)

    def _advance(self, data: DataFrame, pending: list[Tree], outputs: int) -> DataFrame:
        prepare = self._margins(pending, outputs)

        def run(batches):
            state = prepare()
            for batch in _batches(batches):
                _, _, x, margin = _columns(batch)
                m = state(x, margin)
                at = pa.array(np.arange(len(m) + 1, dtype=np.int32) * outputs)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.ListArray.from_arrays(at, pa.array(m.ravel()))], names=batch.schema.names)
        return data.mapInArrow(run, data.schema)


def poisson(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Bootstrap weights: Poisson of mean one, from a hash of (id, tree, seed)."""
    h = ids.astype(np.int64).view(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53
    return np.searchsorted(_POISSON, u, side="right").astype(float)


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))


@dataclass
class Forest:
    """Bagged trees, grown until their leaves are pure unless ``depth`` is given."""
    task: str
    trees: int = 200
    depth: int | None = None
    per_node: str = "sqrt"      # features tried at a node: sqrt or all
    bins: int = BINS
    seed: int = 0
    id_col: str = "applicant_id"
    fit_rows: int | None = None

    def fit(self, df: DataFrame) -> TreeModel:
        n, top, width = df.agg(F.count(F.lit(1)), F.max("label"), F.max(F.size(vector_to_array("features")))).first()
        if not n:
            raise ValueError("no training rows")
        outputs = int(top) + 1 if self.task == "class" else 1
        data = table_for(df, self.id_col).persist(StorageLevel.MEMORY_AND_DISK)
        cuts = quantile_cuts(data, width, self.bins) if n > (self.fit_rows or FIT_ROWS) else [np.zeros(0)] * width
        seed, gini = self.seed, self.task == "class"

        def stats(ids, y, _, t):
            w = poisson(ids, t, seed)
            seen = (w > 0).astype(float)
            if gini:
                one = np.zeros((len(y), outputs))
                one[np.arange(len(y)), y.astype(np.int64)] = w
                return np.hstack([one, seen[:, None]])
            return np.stack([w * y, w, seen], axis=1)

        tried = max(1, int(width ** 0.5)) if self.per_node == "sqrt" else None
        rule = Rule("gini" if gini else "newton", to_purity=True)
        trees = grow_trees(data, n, self.trees, _none, stats, rule, self.depth, cuts, exact=True, per_node=tried,
                           seed=seed, fit_rows=self.fit_rows, n_stats=outputs + 1 if gini else 3)
        data.unpersist()
        return TreeModel("vote" if gini else "mean", outputs, width, [0.0] * outputs, trees)
