"""Gradient-boosted trees with column sampling, quantile loss and stopping by patience.

Spark's own boosted trees have none of these. A model is grown on blocks of divisions: a block holds the whole
history of some divisions, at most ROWS_PER_BLOCK rows, so it fits a task, and all blocks and all plans grow side by
side. As many divisions as fit a block share one model. A model is a table, of at most
`trees * 2**(depth + 1)` rows a block; rows to forecast meet the trees of their block, and nothing passes the driver.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.settings import Boosting

ROWS_PER_BLOCK = 250_000
BINS = 256
SMOOTHING = 1.0  # added to the rows of a leaf
TREE_SCHEMA = "plan string, block int, blocks int, tree int, node int, feature int, threshold double, value double, cover double"
_PER_NODE = ["node", "feature", "threshold", "value", "cover"]


# --- growing ------------------------------------------------------------------


def _uniform(keys: np.ndarray, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree, the same wherever the row lies."""
    x = keys ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


class _Grower:
    """Grows the trees of one block. bins: the bin of each column (first axis) and row."""

    def __init__(self, plan: Boosting, edges: list[np.ndarray], bins: np.ndarray, y: np.ndarray, held: np.ndarray, keys: np.ndarray):
        self.plan, self.edges, self.bins, self.y, self.held, self.keys = plan, edges, bins, y, held, keys
        self.sizes = np.array([len(e) + 1 for e in edges])
        train = y[~held]
        self.base = 0.0 if not len(train) else float(train.mean() if plan.quantile is None else _quantile(train, plan.quantile))
        self.forecast = np.full(len(y), self.base)

    def gradient(self) -> np.ndarray:
        if self.plan.quantile is None:
            return self.y - self.forecast
        return np.where(self.y > self.forecast, self.plan.quantile, self.plan.quantile - 1)

    def histograms(self, bins: np.ndarray, place: np.ndarray, places: int, gradient: np.ndarray, columns: np.ndarray) -> list[np.ndarray]:
        """For each column the sums of gradients and of rows by place and bin."""
        out = []
        for c, own in zip(columns, bins):
            size = self.sizes[c]
            at = own + place * size
            both = np.bincount(at, gradient, places * size), np.bincount(at, minlength=places * size)
            out.append(np.stack(both).reshape(2, places, size))
        return out

    @staticmethod
    def best_splits(sums: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place the gain, the position among the columns and the bin of its best split; a gain of 0 is none."""
        places = sums[0].shape[1]
        gain, position, cut = np.zeros(places), np.zeros(places, int), np.zeros(places, int)
        g, n = sums[0].sum(axis=2)
        stays = (g**2 / (n + SMOOTHING))[:, None]
        for i, part in enumerate(sums):
            if part.shape[2] < 2:
                continue
            left_g, left_n = np.cumsum(part, axis=2)[:, :, :-1]
            right_g, right_n = g[:, None] - left_g, n[:, None] - left_n
            worth = left_g**2 / (left_n + SMOOTHING) + right_g**2 / (right_n + SMOOTHING) - stays
            worth[(left_n < 1) | (right_n < 1)] = 0
            b = worth.argmax(axis=1)
            w = worth[np.arange(places), b]
            better = w > gain + 1e-9
            gain, position, cut = np.where(better, w, gain), np.where(better, i, position), np.where(better, b, cut)
        return gain, position, cut

    def tree(self, number: int) -> np.ndarray:
        """A tree: for each node its number, feature (-1: leaf), threshold, value and cover. Node k has the children 2k and 2k + 1."""
        plan, size = self.plan, 2 << self.plan.depth
        draw = np.random.Generator(np.random.PCG64([plan.seed, number]))
        columns = np.sort(draw.choice(len(self.edges), max(1, int(len(self.edges) * plan.column_share)), replace=False))
        rows = np.flatnonzero(~self.held & (_uniform(self.keys, number) < plan.row_share))
        gradient, bins = self.gradient()[rows], self.bins[np.ix_(columns, rows)]
        node = np.ones(len(rows), int)
        feature, cut_bin = np.full(size, -1), np.zeros(size, int)
        threshold, value, cover = np.zeros(size), np.zeros(size), np.zeros(size)
        open_, sums = np.array([1]), self.histograms(bins, np.zeros(len(rows), int), 1, gradient, columns)
        value[1], cover[1] = self._worth(gradient.sum(), len(rows)), len(rows)
        for level in range(plan.depth):
            gain, position, cut = self.best_splits(sums, columns)
            split = np.flatnonzero(gain > 0)
            if not len(split):
                break
            going = open_[split]
            feature[going], cut_bin[going] = columns[position[split]], cut[split]
            threshold[going] = [self.edges[c][b] for c, b in zip(feature[going], cut[split])]
            place = np.full(size, -1)
            place[going] = position[split]
            moving = np.flatnonzero(place[node] >= 0)
            at = node[moving]
            node[moving] = 2 * at + (bins[place[at], moving] > cut_bin[at])
            left = 2 * going
            for i, (k, b) in enumerate(zip(position[split], cut[split])):
                of_left = sums[k][:, split[i], : b + 1].sum(axis=1)
                of_right = sums[k][:, split[i], b + 1 :].sum(axis=1)
                for child, (g, n) in ((left[i], of_left), (left[i] + 1, of_right)):
                    value[child], cover[child] = self._worth(g, n), n
            if level + 1 == plan.depth:
                break
            # the smaller child is counted, the other has what else the parent has
            small = left + (cover[left + 1] < cover[left])
            place[:] = -1
            place[small] = np.arange(len(small))
            mine = np.flatnonzero(place[node] >= 0)
            counted = self.histograms(bins[:, mine], place[node[mine]], len(small), gradient[mine], columns)
            sums = [np.stack((c, p[:, split] - c), axis=2).reshape(2, -1, p.shape[2]) for c, p in zip(counted, sums)]
            open_ = np.stack((small, small ^ 1), axis=1).ravel()
        used = np.flatnonzero(cover > 0)
        if plan.quantile is not None:
            off = (self.y - self.forecast)[rows]
            order = np.argsort(node, kind="stable")
            for leaf, members in zip(*_runs(node[order], off[order])):
                value[leaf] = plan.rate * _quantile(members, plan.quantile)
        self.forecast += value[self._leaves(feature, cut_bin)]
        return np.stack((used, feature[used], threshold[used], value[used], cover[used]), axis=1)

    def _worth(self, gradient: float, rows: float) -> float:
        return self.plan.rate * gradient / (rows + SMOOTHING)

    def _leaves(self, feature: np.ndarray, cut_bin: np.ndarray) -> np.ndarray:
        node = np.ones(len(self.y), int)
        for _ in range(self.plan.depth):
            moving = np.flatnonzero(feature[node] >= 0)
            at = node[moving]
            node[moving] = 2 * at + (self.bins[feature[at], moving] > cut_bin[at])
        return node

    def grow(self) -> list[np.ndarray]:
        trees: list[np.ndarray] = []
        least, best = np.inf, 0
        for number in range(self.plan.trees if len(self.y) > self.held.sum() else 0):
            trees.append(self.tree(number))
            if not self.held.any():
                continue
            error = ((self.y - self.forecast)[self.held] ** 2).mean()
            if error < least:
                least, best = error, number + 1
            elif number + 1 - best >= self.plan.patience:
                break
        return trees[:best] if best else trees


def _quantile(values: np.ndarray, share: float) -> float:
    return float(np.quantile(values, share))


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys of sorted keys, and the values of each."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[starts], np.split(values, starts[1:])


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts between the bins of a column: all its values if they are few, else quantiles."""
    found = np.unique(values)
    return found if len(found) <= bins else np.unique(np.quantile(values, np.arange(bins) / bins, method="lower"))


def block_of(division: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(division), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def fit_trees(
    rows: DataFrame, columns: list[str], label: str, plans: dict[str, Boosting], key: list[str], division: str,
    only: dict[str, Column] | None = None, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """The tree table of all plans. Rows of is_validation, where there is such a column, are held out from plans with patience.

    only: the rows that a plan sees, where it doesn't see all.
    """
    only = only or {}
    seen = F.array_compact(F.array(*[F.when(only.get(p, F.lit(True)), F.lit(p)) for p in plans]))
    held = F.col("is_validation") if "is_validation" in rows.columns else F.lit(False)
    blocks = max(1, -(-rows.count() // rows_per_block))
    slim = rows.select(
        F.explode(seen).alias("plan"), block_of(F.col(division), blocks).alias("block"),
        F.xxhash64(*key).alias("key"), F.col(label).cast("double").alias("y"), held.alias("held"), *[F.col(c).cast("double") for c in columns],
    )

    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by("key").combine_chunks()
        plan = plans[group.column("plan")[0].as_py()]
        get = lambda c: group.column(c).to_numpy()
        held = get("held") if plan.patience else np.zeros(group.num_rows, bool)
        edges = [bin_edges(get(c)[~held]) if (~held).any() else np.zeros(1) for c in columns]
        bins = np.stack([np.searchsorted(e, get(c)) for c, e in zip(columns, edges)])
        grower = _Grower(plan, edges, bins, get("y"), held, get("key").view(np.uint64))
        trees = [np.array([[1.0, -1, 0, grower.base, 0]]), *grower.grow()]  # tree -1 is where every forecast starts
        nodes = np.concatenate(trees).T
        out = {"plan": [group.column("plan")[0].as_py()] * nodes.shape[1]}
        out |= {"block": group.column("block")[0].as_py() + np.zeros(nodes.shape[1], np.int32), "blocks": np.full(nodes.shape[1], blocks, np.int32)}
        out |= {"tree": np.concatenate([np.full(len(t), i, np.int32) for i, t in enumerate(trees, -1)])}
        out |= {c: v.astype(np.int32) if c in ("node", "feature") else v for c, v in zip(_PER_NODE, nodes)}
        return pa.table(out)

    return slim.groupBy("plan", "block").applyInArrow(grow, TREE_SCHEMA)


# --- forecasts and their parts --------------------------------------------------


class Trees:
    """A tree table as arrays, small enough to travel with every task."""

    def __init__(self, table: pa.Table):
        number, node = (table.column(c).to_numpy() for c in ("tree", "node"))
        value = table.column("value").to_numpy()
        self.base = float(value[number < 0][0])
        shape = (int(number.max(initial=-1)) + 1, int(node.max(initial=1)) + 1)
        self.feature, self.threshold, self.value, self.cover = np.full(shape, -1), np.zeros(shape), np.zeros(shape), np.zeros(shape)
        own = number >= 0
        for array, name in ((self.feature, "feature"), (self.threshold, "threshold"), (self.value, "value"), (self.cover, "cover")):
            array[number[own], node[own]] = table.column(name).to_numpy()[own]
        self.depth = int(np.log2(shape[1]))

    def forecast(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + (x[rows, f] > threshold[node]), node)
            out += value[node]
        return out

    def expected(self) -> float:
        """The mean forecast of the rows that the trees were grown on: where all attributions start."""
        return self.base + sum(sum(v for v, *_ in self._leaves(t)) for t in range(len(self.feature)))

    def _leaves(self, tree: int) -> Iterator[tuple[float, float, dict[int, tuple[float, list[tuple[float, bool]]]]]]:
        """Of each leaf: value times share of rows, value, and for each feature on its path the share of
        rows that its splits let through and the conditions they set."""
        feature, threshold, value, cover = self.feature[tree], self.threshold[tree], self.value[tree], self.cover[tree]
        todo: list[tuple[int, float, dict]] = [(1, 1.0, {})]
        while todo:
            node, share, path = todo.pop()
            f = int(feature[node])
            if f < 0:
                yield value[node] * share, value[node], path
                continue
            for child in (2 * node, 2 * node + 1):
                part = cover[child] / cover[node]
                before, conditions = path.get(f, (1.0, []))
                todo.append((child, share * part, path | {f: (before * part, [*conditions, (threshold[node], child % 2 == 1)])}))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley values of the features of each row, features outside a coalition averaged over the
        rows of the tree's nodes. They add up to the forecast less expected().

        A leaf counts by which of its path's conditions, taken by feature, a row meets: there are few such
        patterns, so their values are worked out once a leaf and looked up for every row.
        """
        out = np.zeros_like(x, dtype=float)
        for tree in range(len(self.feature)):
            for _, value, path in self._leaves(tree):
                features = list(path)
                met = np.ones((len(x), len(features)), bool)
                for i, f in enumerate(features):
                    for cut, right in path[f][1]:
                        met[:, i] &= (x[:, f] > cut) == right
                pattern = met @ (1 << np.arange(len(features)))
                out[:, features] += value * _shares(np.array([path[f][0] for f in features]))[pattern]
        return out


def _shares(through: np.ndarray) -> np.ndarray:
    """For each pattern of met features the Shapley value of each feature in a leaf of value one."""
    d = len(through)
    patterns = ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype(float)
    weights = np.array([1 / (d * _choose(d - 1, k)) for k in range(d)])
    out = np.zeros((1 << d, d))
    for i in range(d):
        poly = np.zeros((1 << d, d))  # coalitions of the other features by size
        poly[:, 0] = 1
        for j in range(d):
            if j != i:
                larger = poly[:, :-1] * patterns[:, j : j + 1]
                poly *= through[j]
                poly[:, 1:] += larger
        out[:, i] = (patterns[:, i] - through[i]) * (poly @ weights)
    return out


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _matrix(table: pa.Table, columns: list[str]) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().astype(float) for c in columns], axis=1)


def _with_trees(rows: DataFrame, trees: DataFrame, division: str, plan: Column, add, names: list[str]) -> DataFrame:
    """Rows beside the trees of their plan and block, with the columns that add makes of both. Without trees a row is left out."""
    blocks = F.coalesce(trees.agg(F.max("blocks")).scalar(), F.lit(1))
    dealt = rows.withColumns({"_plan": plan, "_block": block_of(F.col(division), blocks)})

    def run(mine: pa.Table, tree_table: pa.Table) -> pa.Table:
        mine = mine.drop_columns(["_plan", "_block"])
        if not tree_table.num_rows:
            mine = mine.slice(0, 0)
        made = add(mine, Trees(tree_table)) if mine.num_rows else [np.empty(0)] * len(names)
        for name, values in zip(names, made):
            mine = mine.append_column(name, pa.array(values))
        return mine

    schema = rows.withColumns({n: F.lit(0.0) for n in names}).schema
    return dealt.groupBy("_plan", "_block").cogroup(trees.groupBy("plan", "block")).applyInArrow(run, schema)


def with_forecast(rows: DataFrame, trees: DataFrame, columns: list[str], division: str, plan: Column, name: str = "yhat") -> DataFrame:
    """Adds the forecast of each row by the trees of its plan."""
    return _with_trees(rows, trees, division, plan, lambda mine, t: [t.forecast(_matrix(mine, columns))], [name])


def with_contributions(rows: DataFrame, trees: DataFrame, columns: list[str], division: str, plan: Column, names: list[str]) -> DataFrame:
    """Adds the base of all attributions and one column of contributions for each feature."""

    def add(mine: pa.Table, t: Trees) -> list[np.ndarray]:
        return [np.full(mine.num_rows, t.expected()), *np.ascontiguousarray(t.contributions(_matrix(mine, columns)).T)]

    return _with_trees(rows, trees, division, plan, add, ["base", *names])
