"""Operator 10: exact top-k inner products by dual-tree cover-tree search.

Queries and data are indexed together in one cover tree over space, built from the top. A node's children are a net of its
vectors, chosen farthest first, so that centres lie at least as far apart as the net's covering radius, and every vector goes to
its nearest centre. Nodes of more than BLOCK_ROWS vectors are split by Spark, level by level, until none is left; the tree goes
on within each block, by the same rule, down to leaves of LEAF_ROWS. The number of blocks grows with the data.

For a query node (centre a, covering radius r) and a data node (centre b, radius s) no inner product is above
a.b + |a| s + |b| r + r s. A pair of nodes is pruned when this is below the worst kth score of all queries in the query node.
First every block of queries is searched against the data of its own block, which gives kth scores to begin with. Then
pairs of nodes are expanded from the roots, level by level and as a DataFrame, and those that remain as pairs of blocks are
searched, each down its two trees, best bounds first, with kth scores that rise as it goes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

QUERY_EVERY = 20
#: A node of more vectors is split by Spark; a leaf of the tree within a block has at most so many.
BLOCK_ROWS, LEAF_ROWS = 4096, 32
#: Children of a node, at most: of one that Spark splits, and within a block.
FAN, INNER_FAN = 64, 8
#: A net is chosen from about so many of a node's vectors.
SAMPLE = 1024
#: Vectors that no net parts, such as equal ones, are dealt by hash beyond this depth; so are those of a net of one centre.
MOST_DEPTH = 12
#: A task takes a query block against about so many data blocks, or assigns so many blocks' vectors.
CHUNK = 16

ROWS = "vec_id long, v array<long>, dim int, node string, far double"
PACKED = "block string, dim int, kind int, n int, centre array<double>, radius double, ids binary, vectors binary, width int, tree binary, kth binary"
FIELDS = [x.split()[0] for x in PACKED.split(", ")]
FOUND = "block string, query_id long, vec_id long, score long, met long, of long"


def farthest_first(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Net of at most so many centres: (their rows, each point's centre, each point's distance to it). Stops at radius 0."""
    points = points.astype("f8")
    centres, owner = [0], np.zeros(len(points), "i8")
    near = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(centres) < most and near.max(initial=0) > 0:
        far = int(near.argmax())
        d = np.sqrt(((points - points[far]) ** 2).sum(axis=1))
        owner[d < near] = len(centres)
        near = np.minimum(near, d)
        centres.append(far)
    return np.array(centres), owner, near


def _matrix(rows: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), "i8")


class Tree:
    """The cover tree of one block: vectors in leaf order, and of each node its slice, centre, radius and children."""

    def __init__(self, v: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        self.v = v
        self.start, self.end, self.first, self.last = nodes.T
        sums = np.concatenate([np.zeros((1, v.shape[1])), np.cumsum(v, axis=0, dtype="f8")])
        self.centres = (sums[self.end] - sums[self.start]) / np.maximum(self.end - self.start, 1)[:, None]
        self.radii, self.norms = radii, np.sqrt((self.centres**2).sum(axis=1))
        self.most = float(abs(v.astype("f8")).max(initial=0))
        self.leaves = int((self.first == self.last).sum())


def planted(v: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cover tree of vectors: (their order, nodes as (start, end, first child, last child) in it, radii about the nodes' means)."""
    x = v.astype("f8")
    order, spans, kids, at = np.arange(len(v)), [(0, len(v))], [], 0
    while at < len(spans):
        a, b = spans[at]
        own: list[tuple[int, int]] = []
        if b - a > leaf:
            _, owner, _ = farthest_first(x[order[a:b]], INNER_FAN)
            order[a:b] = order[a:b][np.argsort(owner, kind="stable")]
            ends = (a + np.cumsum(np.bincount(owner))).tolist()
            # equal vectors have no net; they are cut into leaves
            own = list(zip([a, *ends[:-1]], ends, strict=True)) if len(ends) > 1 else [(i, min(i + leaf, b)) for i in range(a, b, leaf)]
        kids.append((len(spans), len(spans) + len(own)))
        spans += own
        at += 1
    x = x[order]
    radii = [float(np.sqrt(((x[a:b] - x[a:b].mean(axis=0)) ** 2).sum(axis=1).max())) for a, b in spans]
    return order, np.array([(*s, *k) for s, k in zip(spans, kids, strict=True)], "<i4"), np.array(radii, "<f8")


def _bounds(a: Tree, i: np.ndarray, b: Tree, j: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products between nodes i of a and j of b, with slack for rounding."""
    r, s = a.radii[i], b.radii[j]
    most = (a.norms[i] + r) * (b.norms[j] + s)
    return (a.centres[i] * b.centres[j]).sum(axis=1) + a.norms[i] * s + b.norms[j] * r + r * s + 1e-9 * (most + 1)


class Best:
    """The best k so far of each query of a tree, by score, then smaller id; kth are scores known to be reached."""

    def __init__(self, tree: Tree, ids: np.ndarray, k: int, kth: np.ndarray | None = None):
        self.tree, self.ids, self.k = tree, ids, k
        self.kth = np.full(len(ids), -np.inf) if kth is None else kth.copy()
        self.row, self.score, self.found = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "i8")
        #: Pairs of leaves whose products were taken, and all pairs of leaves there were.
        self.met = self.of = 0

    def _worst(self, nodes: np.ndarray) -> np.ndarray:
        least = {int(i): self.kth[self.tree.start[i] : self.tree.end[i]].min() for i in np.unique(nodes)}
        return np.array([least[int(i)] for i in nodes])

    def pairs(self, data: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of leaves (of the queries, of the data) that no pair of nodes above them rules out, with their bounds."""
        q, d = self.tree, data
        i, j = np.zeros(1, "i8"), np.zeros(1, "i8")
        out = []
        while len(i):
            bound = _bounds(q, i, d, j)
            keep = bound >= self._worst(i)
            i, j, bound = i[keep], j[keep], bound[keep]
            a, b = q.last[i] - q.first[i], d.last[j] - d.first[j]
            done = (a == 0) & (b == 0)
            out.append((i[done], j[done], bound[done]))
            i, j, a, b = (x[~done] for x in (i, j, a, b))
            # the node with children is opened; of two, both are
            n = np.maximum(a, 1) * np.maximum(b, 1)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(np.maximum(b, 1), n)
            i = np.where(np.repeat(a, n) > 0, np.repeat(q.first[i], n) + step // wide, np.repeat(i, n))
            j = np.where(np.repeat(b, n) > 0, np.repeat(d.first[j], n) + step % wide, np.repeat(j, n))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def see(self, data: Tree, ids: np.ndarray) -> None:
        """Searches the tree of a data block with the given ids."""
        q = self.tree
        self.of += q.leaves * data.leaves
        i, j, bound = self.pairs(data)
        order = np.lexsort((-bound, i))
        i, j, bound = i[order], j[order], bound[order]
        first = np.flatnonzero(np.diff(i, prepend=-1)).tolist()
        exact = q.most * data.most * max(q.v.shape[1], 1) < 2**53
        kind = "f8" if exact else "i8"
        for s, e in zip(first, [*first[1:], len(i)][: len(first)], strict=True):
            a, b = int(q.start[i[s]]), int(q.end[i[s]])
            x, at, step = q.v[a:b].astype(kind), s, 4
            while at < e:
                near = np.arange(at, min(at + step, e))
                near = near[bound[near] >= self.kth[a:b].min()]
                if not len(near):
                    break  # bounds fall from here
                self.met += len(near)
                at, step = at + step, step * 4
                cols = np.concatenate([np.arange(data.start[n], data.end[n]) for n in j[near]])
                self._take(a, x @ data.v[cols].astype(kind).T, self.ids[a:b], ids[cols])

    def _take(self, a: int, score: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries from row a on against ids."""
        same = own[:, None] == ids
        low = np.where(same, -np.inf, score)
        least = self.kth[a : a + len(own)]
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(low, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        r, c = np.nonzero((low >= least[:, None]) & ~same)
        if not len(r):
            return
        mine = (self.row >= a) & (self.row < a + len(own))
        row, value, found = (np.concatenate([old[mine], new]) for old, new in ((self.row, a + r), (self.score, score[r, c].astype("i8")), (self.found, ids[c])))
        order = np.lexsort((found, -value, row))
        row, value, found = row[order], value[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        last = rank == self.k - 1
        self.kth[row[last]] = np.maximum(self.kth[row[last]], value[last])
        top = rank < self.k
        self.row, self.score, self.found = (np.concatenate([old[~mine], new[top]]) for old, new in ((self.row, row), (self.score, value), (self.found, found)))


# --- the tree over blocks -----------------------------------------------------------------------------


def _nets(fan: int, block_rows: int):
    def run(group: pa.Table) -> pa.Table:
        """A node's net, from a sample of its vectors."""
        x = _matrix(group.sort_by("vec_id").column("v"))
        most = min(fan, max(2, -(-2 * group.column("n")[0].as_py() // block_rows)))
        centres = x[farthest_first(x, most)[0]]
        return pa.table({"node": group.column("node").slice(0, 1), "dim": group.column("dim").slice(0, 1), "net": pa.array([centres.astype("<i8").tobytes()])})

    return run


def _assign(by_hash: bool):
    """Vectors of a node, sorted behind its net, to the nearest centres, as children of the node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, net = None, np.zeros((0, 0))
        for batch in batches:
            names = batch.column("node").to_pylist()
            kinds = batch.column("kind").to_pylist()
            cuts = [i for i in range(len(names)) if i == 0 or kinds[i] == 0 or kinds[i - 1] == 0]
            for a, b in zip(cuts, [*cuts[1:], len(names)], strict=True):
                if kinds[a] == 0:
                    dim, held = batch.column("dim")[a].as_py(), batch.column("net")[a].as_py()
                    node, net = names[a], np.frombuffer(held, "<i8").reshape(-1, dim).astype("f8") if held else np.zeros((0, dim))
                    continue
                assert names[a] == node
                part = batch.slice(a, b - a)
                if by_hash or len(net) < 2:
                    child, far = part.column("deal").to_numpy(), np.zeros(b - a)
                else:
                    x = _matrix(part.column("v")).astype("f8")
                    child = ((net**2).sum(1) - 2 * x @ net.T).argmin(axis=1)
                    far = np.sqrt(((x - net[child]) ** 2).sum(1))
                columns = [*(part.column(c) for c in ("vec_id", "v", "dim")), pa.array([f"{node}.{c}" for c in child.tolist()]), pa.array(far)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "dim", "node", "far"])

    return run


def _grown(vectors: DataFrame, block_rows: int) -> DataFrame:
    """vectors with the block of the tree that each is in; a block's name is its path, begun by the vectors' length."""
    active, done = vectors.withColumn("node", F.col("dim").cast("string")), []
    for depth in range(MOST_DEPTH + 1):
        sizes = active.groupBy("node", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
        large = written(sizes, "nodes")
        if large.isEmpty():
            break
        done.append(active.join(large, "node", "left_anti").select("vec_id", "v", "dim", "node"))
        own = active.select("vec_id", "v", "node").join(large, "node")
        mark = F.pmod(F.xxhash64(F.lit(depth), "vec_id", "v"), F.lit(1 << 30))
        few = own.filter(mark < F.least(F.lit(1.0), F.lit(2.0 * SAMPLE) / F.col("n")) * F.lit(1 << 30))
        nets = few.groupBy("node").applyInArrow(_nets(FAN, block_rows), "node string, dim int, net binary")
        parts = F.ceil(F.col("n") / block_rows).cast("int")
        # without a net, the node's vectors are dealt by hash
        heads = large.join(nets.drop("dim"), "node", "left").select("node", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"), F.lit(CHUNK))).alias("deal"), "dim", "net")
        heads = heads.withColumns({"salt": F.floor(F.col("deal") / CHUNK).cast("int"), "kind": F.lit(0), "vec_id": F.lit(None).cast("long"), "v": F.lit(None).cast("array<long>")})
        body = own.withColumn("deal", F.pmod(F.xxhash64(F.lit(-1 - depth), "vec_id", "v"), parts).cast("int"))
        body = body.withColumns({"salt": F.floor(F.col("deal") / CHUNK).cast("int"), "kind": F.lit(1), "net": F.lit(None).cast("binary")})
        fields = ["node", "salt", "kind", "deal", "dim", "net", "vec_id", "v"]
        met = heads.select(*fields).unionByName(body.select(*fields)).repartition("node", "salt").sortWithinPartitions("node", "salt", "kind")
        active = written(met.mapInArrow(_assign(depth >= MOST_DEPTH - 1), ROWS), "level").drop("far")
    return functools.reduce(DataFrame.unionByName, [*done, active.select("vec_id", "v", "dim", "node")])


def _pack(every: int, leaf: int):
    def run(group: pa.Table) -> pa.Table:
        """A block as two trees, one of all its data and, if it has any, one of its queries."""
        block, dim = group.column("node")[0].as_py(), group.column("dim")[0].as_py()
        ids, v = group.column("vec_id").to_numpy(), _matrix(group.column("v")).reshape(len(group), dim)
        rows = []
        for kind, at in ((0, slice(None)), (1, ids % every == 0)):
            i, x = ids[at], v[at]
            if len(i):
                order, nodes, radii = planted(x, leaf)
                i, x = i[order], x[order]
                width = next(w for w in (1, 2, 4, 8) if w == 8 or abs(x).max(initial=0) < 2 ** (8 * w - 1))
                centre = x.mean(axis=0)
                rows.append((block, dim, kind, len(i), centre.tolist(), float(radii[0]), i.astype("<i8").tobytes(), x.astype(f"<i{width}").tobytes(), width, radii.tobytes() + nodes.tobytes(), None))
        kinds = [pa.string(), *[pa.int32()] * 3, pa.list_(pa.float64()), pa.float64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=FIELDS)

    return run


# --- the search ---------------------------------------------------------------------------------------


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[Tree, np.ndarray, np.ndarray | None]:
    row = {c: batch.column(c)[i].as_py() for c in ("n", "dim", "ids", "vectors", "width", "tree", "kth")}
    v = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(row["n"], row["dim"])
    count = len(row["tree"]) // 24  # of nodes, each a radius and four places
    radii, nodes = np.frombuffer(row["tree"], "<f8", count), np.frombuffer(row["tree"], "<i4", offset=8 * count).reshape(count, 4)
    return Tree(v, nodes.astype("i8"), radii), np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["kth"], "<f8") if row["kth"] else None


def _search(k: int):
    """Of rows sorted by query block, chunk and kind: each query block (kind 1, first) against its data blocks, best bounds first."""

    def out(block: str, best: Best) -> pa.RecordBatch:
        n = len(best.row)
        met, of = np.zeros(n + 1, "i8"), np.zeros(n + 1, "i8")
        met[-1], of[-1] = best.met, best.of
        columns = [pa.array([block] * (n + 1)), pa.array([*best.ids[best.row].tolist(), None], pa.int64()), pa.array([*best.found.tolist(), None], pa.int64()), pa.array([*best.score.tolist(), None], pa.int64()), pa.array(met), pa.array(of)]
        return pa.RecordBatch.from_arrays(columns, ["block", "query_id", "vec_id", "score", "met", "of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("to")[i].as_py(), batch.column("chunk")[i].as_py()
                tree, ids, kth = _unpacked(batch, i)
                if batch.column("kind")[i].as_py() == 1:
                    if best is not None:
                        yield out(at[0], best)
                    at, best = key, Best(tree, ids, k, kth)
                else:
                    assert at == key
                    best.see(tree, ids)
        if best is not None:
            yield out(at[0], best)

    return run


def _searched(packed: DataFrame, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """FOUND of the given pairs (to, block, bound) of query and data blocks; asked are the query blocks."""
    fields = ["kind", "bound", "dim", "n", "ids", "vectors", "width", "tree", "kth"]
    chunks = pairs.groupBy("to").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    data = pairs.join(chunks, "to").withColumn("chunk", F.pmod(F.xxhash64("block"), "chunks").cast("int"))
    queries = data.select("to", "chunk").distinct().join(asked.withColumnRenamed("block", "to"), "to").withColumn("bound", F.lit(None).cast("double"))
    rows = data.join(packed.filter("kind = 0"), "block")
    every = queries.select("to", "chunk", *fields).unionByName(rows.select("to", "chunk", *fields))
    dealt = every.repartition("to", "chunk").sortWithinPartitions("to", "chunk", F.desc("kind"), F.desc("bound"))
    return dealt.mapInArrow(_search(k), FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.filter("query_id is not null").withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _kths(k: int):
    def run(group: pa.Table) -> pa.Table:
        """A query block with each query's kth score so far, in the order of its ids."""
        head = group.filter(pc.is_valid(group.column("ids"))).slice(0, 1)
        ids = np.frombuffer(head.column("ids")[0].as_py(), "<i8")
        seen = group.filter(pc.is_valid(group.column("query_id")))
        q, s = seen.column("query_id").to_numpy(), seen.column("score").to_numpy().astype("f8")
        order = np.lexsort((-s, q))
        q, s = q[order], s[order]
        last = np.arange(len(q)) - np.searchsorted(q, q) == k - 1
        # ids may repeat, for different vectors of one vec_id; such queries start without a score
        names, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        top = np.full(len(names), -np.inf)
        top[np.searchsorted(names, q[last])] = s[last]
        kth = np.where(counts == 1, top, -np.inf)[inverse]
        columns = [head.column(c) if c != "kth" else pa.chunked_array([pa.array([kth.astype("<f8").tobytes()], pa.binary())]) for c in FIELDS]
        return pa.table([*columns, pa.array([float(kth.min())])], names=[*FIELDS, "worst"])

    return run


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(F.col(a), F.col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _frontier(heads: DataFrame, worst: DataFrame) -> DataFrame:
    """Pairs (to, block, bound) of query and data blocks that neither they nor any nodes above them rule out.

    heads are (block, kind, n, centre, radius), worst (block, worst) the least kth score of a query block. A node above blocks is
    their path's prefix; its centre is the mean of theirs and its radius covers them.
    """
    path = F.split("block", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.array_join(F.slice(path, 1, i), "."))
    rows = heads.join(worst, "block", "left").withColumn("node", F.explode(above))
    mean = rows.select("node", "kind", F.posexplode("centre").alias("i", "x")).groupBy("node", "kind", "i").agg(F.avg("x").alias("x"))
    mean = mean.groupBy("node", "kind").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p.x).alias("mid"))
    away = F.sqrt(F.aggregate(F.zip_with("centre", "mid", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    nodes = rows.join(mean, ["node", "kind"], "left").groupBy("node", "kind").agg(F.first("mid").alias("mid"), F.max(F.coalesce(away, F.lit(0.0)) + F.col("radius")).alias("radius"), F.min("worst").alias("worst"), F.bool_or(F.col("node") == F.col("block")).alias("leaf"))
    none = F.array().cast("array<double>")
    nodes = nodes.withColumn("mid", F.coalesce("mid", none)).withColumn("up", F.regexp_replace("node", r"\.?[^.]*$", ""))
    tree = written(nodes.withColumn("norm", F.sqrt(F.aggregate("mid", F.lit(0.0), lambda s, x: s + x * x))), "tree")
    q, d = ({c: F.col(c).alias(f"{side}_{c}") for c in ("node", "up", "mid", "radius", "norm", "leaf")} for side in ("q", "d"))
    queries = tree.filter("kind = 1").select(*q.values(), "worst")
    data = tree.filter("kind = 0").select(*d.values())
    open_ = queries.filter("q_up = ''").join(data, (F.col("q_node") == F.col("d_node")) & (F.col("d_up") == "")).select("q_node", "q_leaf", "d_node", "d_leaf", F.lit(None).cast("double").alias("bound"))
    reach = (F.col("q_norm") + F.col("q_radius")) * (F.col("d_norm") + F.col("d_radius"))
    bound = _dot("q_mid", "d_mid") + F.col("q_norm") * F.col("d_radius") + F.col("d_norm") * F.col("q_radius") + F.col("q_radius") * F.col("d_radius") + 1e-9 * (reach + 1)
    out = []
    while True:
        open_ = written(open_, "frontier")
        out.append(open_.filter("q_leaf and d_leaf").select(F.col("q_node").alias("to"), F.col("d_node").alias("block"), "bound"))
        left = open_.filter("not (q_leaf and d_leaf)")
        if left.isEmpty():
            return functools.reduce(DataFrame.unionByName, out)
        # a node with children gives way to them; one without stays beside the other's
        key = lambda s: F.when(F.col(f"{s}_leaf"), F.col(f"{s}_node")).otherwise(F.concat(F.lit("/"), f"{s}_node"))
        asked = left.select(key("q").alias("q_key"), key("d").alias("d_key"))
        own = lambda df, s: df.withColumn(f"{s}_key", F.explode(F.when(F.col(f"{s}_leaf"), F.array(f"{s}_node", F.concat(F.lit("/"), f"{s}_up"))).otherwise(F.array(F.concat(F.lit("/"), f"{s}_up")))))
        met = asked.join(own(queries, "q"), "q_key").join(own(data, "d"), "d_key")
        open_ = met.withColumn("bound", bound).filter("bound >= worst").select("q_node", "q_leaf", "d_node", "d_leaf", "bound")


def quantised(table: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v, dim): floor(scale * x) as longs; vectors that are null or hold a null or non-finite component go."""
    x = F.col("embedding")
    wide = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return table.filter(x.isNotNull() & F.col("vec_id").isNotNull() & sound).select("vec_id", wide.alias("v"), F.size(x).alias("dim"))


def search(vectors: DataFrame, k: int = 20, every: int = QUERY_EVERY) -> DataFrame:
    """FOUND: of each query the k best of every chunk of data blocks it met; rows without a query_id count pairs of leaves, met and of all."""
    vectors = written(vectors.distinct(), "vectors")
    packed = written(_grown(vectors, BLOCK_ROWS).groupBy("node").applyInArrow(_pack(every, LEAF_ROWS), PACKED), "packed")
    queries = packed.filter("kind = 1")
    own = queries.select(F.col("block").alias("to"), "block", F.lit(0.0).alias("bound"))
    first = written(_searched(packed, queries, own, k), "first")
    heads = packed.select("block", "kind", "n", "centre", "radius")
    if heads.filter("kind = 0 and block like '%.%'").isEmpty():  # every length is one block
        return first
    every_row = queries.select("*", F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("long").alias("score"))
    scores = first.filter("query_id is not null").select("block", "query_id", "score")
    asked = every_row.unionByName(scores, allowMissingColumns=True).groupBy("block").applyInArrow(_kths(k), PACKED + ", worst double")
    asked = written(asked, "asked")
    pairs = _frontier(heads, asked.select("block", "worst")).filter("to <> block")
    return first.unionByName(_searched(packed, asked.drop("worst"), written(pairs, "pairs"), k))


def top_k(vectors: DataFrame, k: int = 20, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to smaller vec_id.

    vectors is (vec_id long, v array<long>, dim int). Queries are the rows with vec_id divisible by every. Only vectors of
    the query's length are its candidates; equal rows count once; a row never meets its own vec_id. Columns beyond these three
    are ignored, and no vectors give no rows.
    """
    return _ranked(search(vectors.select("vec_id", "v", "dim"), k, every), k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 20
"""
