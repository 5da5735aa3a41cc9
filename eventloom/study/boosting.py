"""Gradient-boosted trees that grow leaf by leaf, on histograms that Spark adds up.

Values are binned once.  A step is one grouped aggregation over (node, feature, bin) of
gradients, hessians and rows, which tasks add up batch by batch first; what comes to the driver is at most 255 bins a feature for each
node that is looked at, whatever the number of rows.  There the best split of each leaf is
found, and the leaf that gains most is split next.  The histogram of a node's right child is
the difference of its own and its left child's.

Gradients and hessians are added up as whole numbers, so a model does not depend on how rows
are partitioned, and SQL over the same bins finds the same splits.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import running_totals
from ..functions.storage import materialise

MAX_BINS = 255
#: Sums of gradients and hessians are whole multiples of these parts of one.
PARTS = {"logistic": 1 << 24, "squared": 1 << 20}
LEAST_HESSIAN = 1e-3
TOLERANCE = 1e-7
#: Rows of one task: with few rows a step is a single task and needs no exchange.
TASK_ROWS = 50_000
#: Trees whose scores are computed anew in each step before they are written with the rows.
WRITE_EVERY = 8

_SHAPE = "feature:array<int>,bin:array<int>,left:array<int>,right:array<int>,depth:int"
_CELLS = "node int, feature int, bin int, g long, h long, n long"
_TREE = f"struct<{_SHAPE},threshold:array<double>,value:array<double>>"


@dataclass
class Growth:
    """How trees grow and when boosting ends."""

    rounds: int = 300
    rate: float = 0.08
    leaves: int = 31
    least_rows: int = 40
    l2: float = 1.0
    patience: int = 10


# --- Bins -----------------------------------------------------------------------------


def bin_table(values: DataFrame, most: int = MAX_BINS) -> DataFrame:
    """``feature, bin, low, high`` of a table ``feature, value``: one bin per distinct value of
    a feature, or, of a feature with more than ``most``, bins of about equally many rows."""
    counts = values.groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("one", F.lit(1))
    placed = running_totals(counts, ["feature"], ["value"], {"rows": "n", "rank": "one"})
    by_rows = F.floor((F.col("rows") - F.col("n")) * F.lit(most) / F.col("rows_all"))
    number = F.when(F.col("rank_all") <= most, F.col("rank") - 1).otherwise(by_rows).cast("int")
    return placed.groupBy("feature", number.alias("bin")).agg(F.min("value").alias("low"), F.max("value").alias("high"))


def thresholds(bins: DataFrame, features: int) -> list[list[float]]:
    """The values half-way between the bins of each feature; at most 254 for each."""
    rows = sorted(bins.collect(), key=lambda r: (r["feature"], r["bin"]))
    out: list[list[float]] = []
    for f in range(features):
        own = [r for r in rows if r["feature"] == f]
        out.append([(a["high"] + b["low"]) / 2.0 for a, b in zip(own, own[1:])])
    return out


def with_bins(frame: DataFrame, values: str, cuts: list[list[float]], out: str = "bins") -> DataFrame:
    """Adds the bin of each entry of the array ``values``: how many cuts are not above it."""
    names = [f"_v{f}" for f in range(len(cuts))]
    wide = frame.withColumns({n: F.col(values)[f] for f, n in enumerate(names)})
    cut = [f for f, c in enumerate(cuts) if c]
    if cut:
        splits = [[-math.inf, *cuts[f], math.inf] for f in cut]
        wide = Bucketizer(
            splitsArray=splits, inputCols=[names[f] for f in cut], outputCols=[f"_b{f}" for f in cut]
        ).transform(wide)
    bins = [F.col(f"_b{f}").cast("int") if cuts[f] else F.lit(0) for f in range(len(cuts))]
    return wide.withColumn(out, F.array(*bins)).select(*frame.columns, out)


# --- Trees ----------------------------------------------------------------------------


@dataclass
class Node:
    """A leaf, until it gets children."""

    histogram: np.ndarray  # (sum of gradients, of hessians, rows) by feature and bin
    depth: int
    split: tuple[float, int, int] | None = None  # gain, feature, bin
    children: tuple[int, int] | None = None

    def totals(self) -> np.ndarray:
        return self.histogram[0].sum(axis=0)


def best_split(histogram: np.ndarray, growth: Growth, parts: int) -> tuple[float, int, int] | None:
    """The gain, feature and last bin on the left of the best split: of equal gains the first
    feature and bin.  None if nothing gains."""
    left = np.cumsum(histogram, axis=1)
    whole = left[:, -1:, :]
    right = whole - left

    def score(x: np.ndarray) -> np.ndarray:
        g, h = x[..., 0] / parts, x[..., 1] / parts
        return g * g / (h + growth.l2)

    gain = score(left) + score(right) - score(whole)
    fits = np.minimum(left[..., 2], right[..., 2]) >= growth.least_rows
    fits &= np.minimum(left[..., 1], right[..., 1]) >= LEAST_HESSIAN * parts
    gain = np.where(fits, gain, -np.inf)
    at = int(np.argmax(gain))
    feature, last = divmod(at, gain.shape[1])
    return (float(gain[feature, last]), feature, last) if gain[feature, last] > 0 else None


@dataclass
class Tree:
    """Nodes in the order they were looked at; the root is the first."""

    nodes: list[Node]
    growth: Growth
    parts: int
    splits: list[int] = field(default_factory=list)

    def __post_init__(self):
        self._look(self.nodes[0])

    def _look(self, node: Node) -> None:
        node.split = best_split(node.histogram, self.growth, self.parts)

    def wanted(self) -> list[int]:
        """Grows anew, best leaf first; the leaves whose children must be looked at next.

        A leaf whose children are not known is set aside, as if neither would be split, and the
        next best one is taken.  ``splits`` is final when there is no such leaf.
        """
        self.splits, leaves, unknown = [], [0], []
        while len(leaves) + 2 * len(unknown) < self.growth.leaves:
            gaining = [i for i in leaves if self.nodes[i].split]
            if not gaining:
                break
            best = min(gaining, key=lambda i: (-self.nodes[i].split[0], i))
            leaves.remove(best)
            if self.nodes[best].children is None:
                unknown.append(best)
            else:
                self.splits.append(best)
                leaves += self.nodes[best].children
        return unknown

    def add_children(self, parent: int, left: np.ndarray) -> None:
        node = self.nodes[parent]
        node.children = (len(self.nodes), len(self.nodes) + 1)
        for histogram in (left, node.histogram - left):
            self.nodes.append(Node(histogram, node.depth + 1))
            self._look(self.nodes[-1])

    def asking(self, asked: list[int]) -> tuple[dict, dict[int, int]]:
        """The tree with all nodes looked at and new children of those ``asked`` for, and
        which of these are the left ones, by their place in ``asked``."""
        shown = {k: [-1] * (len(self.nodes) + 2 * len(asked)) for k in ("feature", "bin", "left", "right")}
        children = {i: n.children for i, n in enumerate(self.nodes) if n.children}
        children |= {i: (len(self.nodes) + 2 * k, len(self.nodes) + 2 * k + 1) for k, i in enumerate(asked)}
        for i, (left, right) in children.items():
            _, shown["feature"][i], shown["bin"][i] = self.nodes[i].split
            shown["left"][i], shown["right"][i] = left, right
        depth = 1 + max(self.nodes[i].depth for i in children)
        return shown | {"depth": depth}, {children[i][0]: k for k, i in enumerate(asked)}

    def grown(self, cuts: list[list[float]]) -> dict:
        """Arrays over the nodes of the finished tree, numbered in the order of the splits;
        leaves have the feature -1.  A node's value is what it would add as a leaf."""
        number, order = {0: 0}, [0]
        for i in self.splits:
            for child in self.nodes[i].children:
                number[child] = len(order)
                order.append(child)
        out: dict = {k: [] for k in ("feature", "threshold", "bin", "left", "right", "value", "rows")}
        inner = set(self.splits)
        for i in order:
            node = self.nodes[i]
            _, feature, last = node.split if i in inner else (0.0, -1, -1)
            left, right = (number[c] for c in node.children) if i in inner else (-1, -1)
            g, h, n = node.totals()
            value = -self.growth.rate * (g / self.parts) / (h / self.parts + self.growth.l2)
            cut = cuts[feature][last] if i in inner else 0.0
            for k, v in zip(out, (feature, cut, last, left, right, float(value), int(n)), strict=True):
                out[k].append(v)
        return out | {"depth": 1 + max(self.nodes[i].depth for i in inner)}


# Expressions are SQL text: each step builds a plan, and text takes one call.


def literal(value, kind: str) -> str:
    """A constant of any type; it is not part of generated code, so steps share theirs."""
    return f"from_json('{json.dumps({'v': value})}', 'v {kind}').v"


def node_of(tree: str, left: str) -> str:
    """The leaf that a row reaches; ``left`` says whether it goes left at the node ``n``."""
    onward = f"CASE WHEN get({tree}.feature, n) < 0 THEN n WHEN {left} THEN get({tree}.left, n) ELSE get({tree}.right, n) END"
    return f"aggregate(if({tree}.depth > 0, sequence(1, {tree}.depth), array()), 0, (n, i) -> {onward})"


def _by_bin(tree: str) -> str:
    return f"get(bins, get({tree}.feature, n)) <= get({tree}.bin, n)"


def added_up(base: str, trees: list[dict], left: Callable[[str], str]) -> str:
    if not trees:
        return base
    leaf = f"get(t.value, {node_of('t', left('t'))})"
    return f"aggregate({literal(trees, f'array<{_TREE}>')}, CAST({base} AS DOUBLE), (total, t) -> total + {leaf})"


# --- Histograms -----------------------------------------------------------------------


def cells_of(pending: list[dict], tree: dict, looked: dict[int, int], loss: str, features: int, widest: int) -> Callable:
    """What a task adds up: gradients, hessians and rows by (node, feature, bin) of the leaves
    in ``looked``, and the losses of the rows held back under node -1, whatever its rows.

    ``pending`` are the trees that the scores of the rows do not have yet.
    """
    parts, leaves = PARTS[loss], len(looked)
    number = np.array([looked.get(i, -1) for i in range(len(tree["feature"]))])

    def reached(tree: dict, bins: np.ndarray) -> np.ndarray:
        feature, last, left, right = (np.array(tree[k]) for k in ("feature", "bin", "left", "right"))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(tree["depth"]):
            of = feature[at]
            onward = np.where(bins[rows, of] <= last[at], left[at], right[at])
            at = np.where(of < 0, at, onward)
        return at

    def whole(x: np.ndarray) -> np.ndarray:
        """As multiples of the parts, halves away from zero; what is missing adds nothing."""
        x = np.nan_to_num(x * parts)
        return (np.sign(x) * np.floor(np.abs(x) + 0.5)).astype(np.int64)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = np.zeros((3, leaves * features * widest), np.int64), np.zeros(3, np.int64)
        for batch in batches:
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            raw, y = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("f", "y"))
            out = batch.column("out").fill_null(False).to_numpy(zero_copy_only=False)
            for known in pending:
                raw = raw + np.array(known["value"])[reached(known, bins)]
            if loss == "logistic":
                p = 1.0 / (1.0 + np.exp(-raw))
                g, h, missed = p - y, p * (1.0 - p), np.log(1.0 + np.exp(raw)) - y * raw
            else:
                g, h, missed = raw - y, np.ones(len(raw)), 0.5 * (raw - y) * (raw - y)
            held += [whole(missed[out]).sum(), whole(h[out]).sum(), out.sum()]
            node = number[reached(tree, bins)]
            used = np.flatnonzero(~out & (node >= 0))
            cell = (node[used, None] * features + np.arange(features)) * widest + bins[used]
            for total, of in zip(sums, (whole(g[used]), whole(h[used]), np.ones(len(used), np.int64)), strict=True):
                np.add.at(total, cell, of[:, None])
        at = np.flatnonzero(sums[2])
        place = [at // (features * widest), at // widest % features, at % widest]
        if held[2]:
            place, sums = [np.append(x, -1) for x in place], np.append(sums[:, at], held[:, None], axis=1)
        else:
            sums = sums[:, at]
        kinds = [pa.int32()] * 3 + [pa.int64()] * 3
        columns = [pa.array(x, k) for x, k in zip([*place, *sums], kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["node", "feature", "bin", "g", "h", "n"])

    return add_up


# --- Boosting -------------------------------------------------------------------------


@dataclass
class Boosted:
    """``loss`` is ``logistic`` or ``squared``; ``losses`` are those of the rows held back."""

    loss: str
    base: float
    trees: list[dict]
    losses: list[float]

    def raw(self, values: str) -> Column:
        """The score of an array of feature values before any link function."""

        def left(tree: str) -> str:
            return f"get({values}, get({tree}.feature, n)) < get({tree}.threshold, n)"

        return F.expr(added_up(f"CAST({self.base!r} AS DOUBLE)", self.trees, left))

    def score(self, values: str) -> Column:
        raw = self.raw(values)
        return 1.0 / (1.0 + F.exp(-raw)) if self.loss == "logistic" else raw

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: its place, what it splits on, and the value of a leaf."""
        rows = []
        for t, tree in enumerate(self.trees):
            columns = (tree[k] for k in ("feature", "threshold", "left", "right", "value", "rows"))
            rows += [(t, i, *row) for i, row in enumerate(zip(*columns, strict=True))]
        return spark.createDataFrame(
            rows, "tree int, node int, feature long, threshold double, left int, right int, value double, rows long"
        )


def boost(
    rows: DataFrame, values: str, label: str, loss: str, held_back: Column, growth: Growth = Growth(), features: int | None = None
) -> Boosted:
    """Boosted trees of an array of numbers.  ``held_back`` rows only tell when to stop: when
    none of the last ``patience`` losses is better than the one before them."""
    parts = PARTS[loss]
    narrow = rows.select(F.col(values).alias("x"), F.col(label).cast("double").alias("y"), held_back.alias("out"))
    narrow = materialise(narrow, "boosting")
    if features is None:
        features = len(narrow.select("x").first()[0])
    fitting = narrow.where(~F.col("out"))
    cuts = thresholds(bin_table(fitting.select(F.posexplode("x").alias("feature", "value"))), features)
    base = fitting.agg(F.sum(F.round(F.col("y") * parts).cast("bigint")) / F.count("*") / parts).first()[0]
    if loss == "logistic":
        base = math.log(base / (1.0 - base))
    widest = max(len(c) for c in cuts) + 1
    tasks = max(1, -(-narrow.count() // TASK_ROWS))
    scored = materialise(with_bins(narrow, "x", cuts).withColumn("f", F.lit(base)).drop("x"), "boosting")

    def histograms(pending: list[dict], tree: dict, looked: dict[int, int]) -> tuple[dict[int, np.ndarray], float | None]:
        """Histograms of the leaves in ``looked`` by their number there, and the loss of the
        rows held back, in one aggregation."""
        cells = scored.coalesce(tasks).mapInArrow(cells_of(pending, tree, looked, loss, features, widest), _CELLS)
        found = cells.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
        table = {k: v.to_numpy() for k, v in zip(found.columns, found.toArrow().columns, strict=True)}
        out = {}
        for i in looked.values():
            own = table["node"] == i
            out[i] = np.zeros((features, widest, 3))
            out[i][table["feature"][own], table["bin"][own]] = np.stack([table[k][own] for k in ("g", "h", "n")], axis=1)
        held = table["node"] == -1
        return out, float(table["g"][held][0] / table["n"][held][0] / parts) if held.any() else None

    stump = {"feature": [-1], "bin": [-1], "left": [-1], "right": [-1], "depth": 0}
    model = Boosted(loss, base, [], [])
    pending: list[dict] = []
    while True:
        # The loss after the last tree comes with the root of the next one.
        found, missed = histograms(pending, stump, {0: 0})
        if missed is not None:
            model.losses.append(missed)
        recent = model.losses[-growth.patience - 1 :]
        if len(model.trees) >= growth.rounds or (len(recent) > growth.patience and min(recent[1:]) >= recent[0] - TOLERANCE):
            return model
        tree = Tree([Node(found[0], 0)], growth, parts)
        while asked := tree.wanted():
            found, _ = histograms(pending, *tree.asking(asked))
            for k, i in enumerate(asked):
                tree.add_children(i, found[k])
        if not tree.splits:  # nothing gains any more
            return model
        model.trees.append(tree.grown(cuts))
        pending.append(model.trees[-1])
        if len(pending) == WRITE_EVERY:
            scored = materialise(scored.coalesce(tasks).withColumn("f", F.expr(added_up("f", pending, _by_bin))), "boosting")
            pending = []
