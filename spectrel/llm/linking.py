"""Classes of linked sets among nodes that share keys, confirmed on the full sets.

A node is a distinct set of 64-bit shingle hashes. Two nodes are linked if their Jaccard similarity is at least ``percent``
hundredths, that is if (100 + percent) * |x ^ y| <= (100 - percent) * (|x| + |y|), with ^ for the symmetric difference.
Nodes that share a key may be linked. Within a key, nodes are first compared with its best connected node, which is one
pair for each node and round. What is then left of keys with several components is gathered into clusters; these are cut
into cells of bounded size, and a cell is solved in one step that gives at most one edge less than it has nodes.

In a cell every set x is reduced to D(x) = x ^ p for a set p in the middle of all. As x ^ y = D(x) ^ D(y), sets x and y are
linked just if 2 * |D(x) & D(y)| >= |D(x)| + |D(y)| - bound, with bound = (100 - percent) * (|x| + |y|) / (100 + percent).
If x is not linked with p, that is positive for every y: for bound >= |D(x)| + |D(y)| would make x linked with p as well.
So it is enough to compare x with the sets that share one of the rarest elements of D(x) (prefix filter). Copies of one
text that differ from p by their own edits share next to nothing of D, so a large group costs little.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrel.operators.shared import written

from .columns import flat, joined, mix, shingle_sets, slices
from .components import components
from .hashfilter import key_filter, passes

STAR_ROUNDS = 3  # at most; a round is left out once few enough nodes are open for the cells
FEW_OPEN = 500_000
CELL_NODES = 4096  # nodes of a cluster that are compared in one step, and the bytes of their sets;
CELL_BYTES = 16 << 20  # a larger cluster becomes a grid of such cells


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit id of each non-empty set, equal for equal sets."""
    size = np.array([len(s) for s in sets])
    every = joined(sets, np.uint64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    return mix(np.add.reduceat(mix(every), first) ^ mix(np.bitwise_xor.reduceat(every, first) + size.astype(np.uint64))).view(np.int64)


def _full_sets(size: int, wanted, unnamed):
    """Rows (doc_id, node, shingles) of the texts with an id in ``wanted`` or without id and with a node in ``unnamed``.

    A task gives the set of a text without id once, however many such rows it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        any_unnamed = bool(unnamed.value.any())
        for batch in batches:
            ids = batch.column("doc_id")
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            hit = np.where(no_id, any_unnamed, passes(wanted.value, ids.fill_null(0).to_numpy(zero_copy_only=False)))
            batch, no_id = batch.filter(pa.array(hit)), no_id[hit]
            text, starts = flat(batch.column("text"))
            for a, b in slices(starts):
                sets = shingle_sets(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a], size)
                rows = [i for i, s in enumerate(sets) if len(s)]
                if not rows:
                    continue
                node = set_ids([sets[i] for i in rows])
                fresh = passes(unnamed.value, node) | ~no_id[a:b][rows]
                for k in np.flatnonzero(fresh & no_id[a:b][rows]):
                    fresh[k] = int(node[k]) not in given
                    given.add(int(node[k]))
                rows, node = np.array(rows)[fresh], node[fresh]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a).take(pa.array(rows)),
                        "node": pa.array(node),
                        "shingles": pa.array([sets[i].tobytes() for i in rows], pa.binary()),
                    }
                )

    return run


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def sets_of(docs: DataFrame, need: DataFrame, size: int) -> Step:
    """A step over ``docs`` that gives (doc_id, node, shingles) of the texts that ``need`` (node, label) names.

    The label is the smallest id of a node's texts. The rows pass filters of fixed size, so there may be some more, and
    several of one node.
    """
    context = docs.sparkSession.sparkContext
    wanted = context.broadcast(key_filter(need.where("label IS NOT NULL"), "label"))
    unnamed = context.broadcast(key_filter(need.where("label IS NULL"), "node"))
    return _full_sets(size, wanted, unnamed)


def one_set_each(docs: DataFrame, need: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of just the nodes in ``need``, one row each."""
    same_text = F.expr("f.node = w.node AND f.doc_id <=> w.label")  # a node without label has rows without id only
    rows = docs.mapInArrow(sets_of(docs, need, size), "doc_id bigint, node bigint, shingles binary")
    found = rows.alias("f").join(need.alias("w"), same_text, "left_semi")
    return found.select("node", "shingles").dropDuplicates(["node"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("set_a"), batch.column("set_b")
            good = []
            for x, y in zip(one, two):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                place = np.searchsorted(y, x)
                place[place == len(y)] = 0
                common = int(np.count_nonzero(y[place] == x))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _stars(members: DataFrame, tried: DataFrame | None) -> DataFrame:
    """For each node, the centre that it shares most keys with: (a, b). The centre of a key is its best connected node."""
    weight = members.groupBy("node").agg(F.sum("c").alias("weight"))
    centers = members.join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("center"))
    pairs = members.join(centers, "key").where("node <> center").groupBy(F.col("center").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("c"))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return pairs.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")).select("a", "b")


class _Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def roots(self) -> np.ndarray:
        while (self.parent != (up := self.parent[self.parent])).any():
            self.parent = up
        return self.parent

    def unite(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def middle(sets: list[np.ndarray]) -> int:
    """The set with the least sum of symmetric differences to all (an element in c of n sets adds n - 2 c where it is held)."""
    every = np.concatenate(sets)
    _, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    return int(np.argmin(np.add.reduceat((len(sets) - 2 * counts)[inverse], first)))


def links_within(sets: list[np.ndarray], roots: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of linked sets that join the components of ``roots`` (sets of one root are joined already).

    Sets are sorted, distinct and non-empty. Together with ``roots``, the pairs connect just what all links connect.
    """
    n, out = len(sets), []
    forest = _Forest(n)
    _, first_of, group = np.unique(roots, return_index=True, return_inverse=True)
    forest.parent = first_of[group].copy()
    size = np.array([len(s) for s in sets])
    p = middle(sets)
    apart = [np.setxor1d(s, sets[p], assume_unique=True) for s in sets]
    far = np.array([len(d) for d in apart])
    weight = (100 + percent) * far - (100 - percent) * size  # 2 (100 + percent) |D(x) & D(y)| >= weight(x) + weight(y)
    near_p = (100 + percent) * far <= (100 - percent) * (size + size[p])
    for i in np.flatnonzero(near_p):
        if i != p and forest.unite(p, int(i)):
            out.append((p, int(i)))
    others = np.flatnonzero(~near_p)
    if not len(others):
        return out
    every, ranks, counts = np.unique(np.concatenate(apart), return_inverse=True, return_counts=True)
    place = np.empty(len(every), np.int64)
    place[np.lexsort((every, counts))] = np.arange(len(every))  # the rarest elements come first
    bounds = np.cumsum([0] + far.tolist())
    ranks = place[ranks]
    apart = [np.sort(ranks[a:b]) for a, b in zip(bounds, bounds[1:])]
    held = np.zeros(len(every), bool)

    def compare(probes: np.ndarray, targets: np.ndarray, lightest_probe: int, lightest_target: int) -> None:
        def prefix(i: int, lightest: int) -> np.ndarray:
            common = -(-(int(weight[i]) + lightest) // (2 * (100 + percent)))
            return apart[i][: max(0, int(far[i]) - common + 1)]

        heads = [prefix(i, lightest_probe) for i in targets]
        keys = joined(heads, np.int64)
        owner = np.repeat(targets, [len(h) for h in heads])
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        for i in probes:
            head = prefix(i, lightest_target)
            low, high = np.searchsorted(keys, head), np.searchsorted(keys, head, side="right")
            some = [owner[a:b] for a, b in zip(low, high) if b > a]
            if not some:
                continue
            found = np.unique(np.concatenate(some))
            up = forest.roots()
            found = found[(up[found] != up[i]) & (100 * np.minimum(size[found], size[i]) >= percent * np.maximum(size[found], size[i]))]
            if not len(found):
                continue
            held[apart[i]] = True
            lengths = far[found]
            hits = np.concatenate([[0], np.cumsum(held[np.concatenate([apart[j] for j in found])])])
            ends = np.cumsum(lengths)
            common = hits[ends] - hits[ends - lengths]
            held[apart[i]] = False
            for j in found[2 * (100 + percent) * common >= weight[i] + weight[found]]:
                if forest.unite(int(i), int(j)):
                    out.append((int(i), int(j)))

    lightest = int(weight[others].min())
    compare(others, others, lightest, lightest)
    linked = np.flatnonzero(near_p)
    compare(others, linked, lightest, int(weight[linked].min()))
    return out


def _cell(percent: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node = table["node"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"].combine_chunks()]
        pairs = links_within(sets, table["root"].to_numpy(), percent)
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(node[a], pa.int64()), "b": pa.array(node[b], pa.int64())})

    return run


def _cluster_links(open_keys: DataFrame, placed: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) among the nodes of keys that are not connected yet; ``placed`` has the root of each node."""
    least = open_keys.groupBy("key").agg(F.min("node").alias("a"))
    clusters = written(components(open_keys.join(least, "key").select("a", F.col("node").alias("b"))), "clusters")
    rows = clusters.withColumnRenamed("root", "cluster").join(placed, "node").join(full, "node")
    bytes_of = F.sum(F.octet_length("shingles").cast("bigint"))
    cells = F.greatest(F.ceil(F.count("*") / CELL_NODES), F.ceil(bytes_of / CELL_BYTES)).cast("int")
    # only clusters of several cells need their number: few rows, so that rows of a large cluster are not dealt by it
    counted = written(rows.groupBy("cluster").agg(cells.alias("cells")).where("cells > 1"), "cells")
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    rows = rows.join(counted, "cluster", "left").withColumn("cells", F.coalesce("cells", F.lit(1))).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    rows = rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    return rows.select("cluster", "low", "high", "node", "root", "shingles").groupBy("cluster", "low", "high").applyInArrow(_cell(percent), "a bigint, b bigint")


def linked_groups(members: DataFrame, full: DataFrame, percent: int, likely: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) of every node that is linked with another: root is the smallest node of its class.

    ``members`` has (key, node, c) with c the number of nodes of the key, ``full`` the set of each of these nodes.
    ``likely`` may drop pairs (a, b) that can't be linked before their sets are fetched.
    """

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = likely(pairs) if likely else pairs
        whole = pairs.join(full.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").join(
            full.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"
        )
        return whole.mapInArrow(_confirm(percent), "a bigint, b bigint")

    links = tried = None
    open_keys = members
    for _ in range(STAR_ROUNDS):
        stars = written(_stars(open_keys, tried), "stars")
        found = written(confirmed(stars), "links")
        tried = stars if tried is None else tried.union(stars)
        links = found if links is None else links.union(found)
        groups = written(components(links), "groups")
        placed = members.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        open_keys = written(placed.join(mixed, "key"), "open_keys")
        placed = written(open_keys.select("node", "root").distinct(), "open_nodes")
        open_keys = open_keys.drop("root")
        n_open = placed.count()
        if n_open <= FEW_OPEN:
            break
    if not n_open:
        return groups
    more = written(_cluster_links(open_keys, placed, full, percent), "links")
    return written(components(links.union(more)), "groups")


def classes_of(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, root, component_id) of all nodes (node, label): the smallest id in the class of each."""
    labels = nodes.select("node", "label").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labels.groupBy("root").agg(F.min("label").alias("component_id"))
    return labels.join(least, "root").select("node", "root", "component_id")
