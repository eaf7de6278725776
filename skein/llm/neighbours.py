"""Near-duplicate vectors by NN-descent.

Equal vectors of a label form a node. Lists of the nearest nodes begin with neighbours in a forest of random projection
codes and get better by joining, at every node, its neighbours and reverse neighbours with one another. An audit compares
a bounded set of nodes with all others; while recall is below target, rounds go on, each with new trees. Edges at the
threshold stay.

A list that is full of such edges is saturated: it is enlarged to all nodes of its label, which its node is compared with
block by block, so no link of a large group, and none between groups with full lists, is lost to the length of lists. The
nodes of a label of which the last audit misses any link are all treated so. Labels without such nodes are neither sent
nor compared.

Contract for odd inputs: vectors of another length count as of another label; rows without label and vectors that are
null, empty, zero or hold null or non-finite components link with nothing and are components of their own; repeated rows
link with each other; ties in similarity go to the smaller node; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, checkpointed, lean, stored, table
from .components import components

THRESHOLD = 0.93
#: Length of lists, reverse neighbours that join, projection trees, nodes in a leaf, reach within a sorted leaf.
NEIGHBOURS, REVERSE, TREES, LEAF, REACH = 8, 8, 10, 16, 8
ROUNDS, MORE_ROUNDS, SETTLED = 3, 4, 0.002
#: The audit's nodes and target.
AUDITED, TARGET = 1024, 0.98
#: Blocks of the largest label, if they have these numbers of nodes and of vector components; rows compared at once.
BLOCKS, LEAST_BLOCK, MOST_VALUES, ROWS = 8, 256, 1 << 19, 512


def matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column; shorter ones are padded, which changes no product."""
    values, lens = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())
    wide = int(lens.max()) if len(lens) else 0
    if len(lens) and (lens == wide).all():
        x = values.reshape(-1, wide)
    else:
        x = np.zeros((len(lens), wide))
        x[np.arange(wide) < lens[:, None]] = values
    x = x / np.abs(x).max(axis=1, keepdims=True) if x.size else x  # so that squares stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vec: Column, label: Column) -> Column:
    v = vec.cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & vec.isNotNull() & sound, F.lit(False))


def group_of(vec: Column, label: Column) -> Column:
    return F.concat_ws("/", F.size(vec).cast("string"), label.cast("string"))


def node_of(vec: Column, label: Column) -> Column:
    """A 64-bit name of a vector within its label; 0.0 and -0.0 are the same."""
    return F.xxhash64(group_of(vec, label), F.transform(vec, lambda x: x + F.lit(0).cast("float")))


def _by_runs(df: DataFrame, by: list[str], kernel, schema: str, rows: int = 4096) -> DataFrame:
    """kernel(batch) over rows that were dealt and sorted by `by`; each batch holds whole runs of by[0]... of bounded
    length (the caller bounds them)."""
    names = df.columns

    def run(batches):
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([rest, batch] if rest is not None else [batch]).combine_chunks().to_batches()[0]
            key = whole.column(names.index(by[0])).to_numpy()
            cut = int(np.searchsorted(key, key[-1])) if (np.diff(key) >= 0).all() else int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
            rest = whole.slice(cut)
            if cut:
                yield from kernel(whole.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from kernel(rest)

    arrow_rows(df.sparkSession, rows)
    out = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by[0]).sortWithinPartitions(*by).mapInArrow(lean(run), schema)
    return out


def _edges(u: np.ndarray, v: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(sim)], names=["node", "other", "sim"])


EDGE = "node long, other long, sim double"


def _best(edges: DataFrame, most: int) -> DataFrame:
    """Of every node the `most` best edges."""
    one = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), "other")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _forest(nodes: DataFrame, bits: int, dims: int, seed: int = 5) -> DataFrame:
    """Edges of nodes near one another in the order of a tree's codes."""
    planes = np.random.default_rng(seed).standard_normal((TREES, bits + 1, dims))

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(2))
                for t in range(TREES):
                    side = x @ planes[t, :, : x.shape[1]].T
                    code = ((side[:, :bits] > 0) << np.arange(bits)[::-1]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.full(len(x), t, np.int32)), pa.array(code), pa.array(side[:, bits])], names=["node", "grp", "vec", "tree", "code", "side"])

    def near(batches):
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([rest, batch] if rest is not None else [batch]).combine_chunks().to_batches()[0]
            x, node, tree = matrix(whole.column(2)), whole.column(0).to_numpy(), whole.column(3).to_numpy()
            grp = whole.column(1).dictionary_encode().indices.to_numpy()
            for k in range(1, REACH + 1):
                a = np.flatnonzero((grp[k:] == grp[:-k]) & (tree[k:] == tree[:-k])) if len(node) > k else np.zeros(0, np.int64)
                if len(a):
                    sim = np.einsum("ij,ij->i", x[a], x[a + k])
                    yield _edges(np.concatenate([node[a], node[a + k]]), np.concatenate([node[a + k], node[a]]), np.concatenate([sim, sim]))
            rest = whole.slice(max(0, len(node) - REACH))

    spark = nodes.sparkSession
    kind = nodes.schema["vec"].dataType.simpleString()
    arrow_rows(spark, 4096)
    rows = nodes.select("node", "grp", "vec").mapInArrow(lean(coded), f"node long, grp string, vec {kind}, tree int, code long, side double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "grp", "tree", "code", "side").sortWithinPartitions("grp", "tree", "code", "side")
    return dealt.mapInArrow(lean(near), EDGE)


def _joined(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """A round: at every node, its neighbours and reverse neighbours meet; better edges than a node's worst stay."""
    order = Window.partitionBy("other").orderBy(F.col("sim").desc(), "node")
    back = graph.withColumn("place", F.row_number().over(order)).where(F.col("place") <= REVERSE).select(F.col("other").alias("at"), F.col("node").alias("member"))
    meet = graph.select(F.col("node").alias("at"), F.col("other").alias("member")).unionByName(back).distinct()
    worst = graph.groupBy("node").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("sim")).otherwise(-2.0).alias("worst"))
    rows = meet.join(nodes.select(F.col("node").alias("member"), "vec"), "member").join(worst.withColumnRenamed("node", "member"), "member", "left")
    rows = rows.select("at", "member", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "vec")
    wide = NEIGHBOURS + REVERSE

    def kernel(batch: pa.RecordBatch):
        at, member, worst_, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), matrix(batch.column(3))
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
        group = np.cumsum(np.concatenate([[0], at[1:] != at[:-1]]))
        for g in range(0, len(heads), 256):
            rows_ = np.flatnonzero((group >= g) & (group < g + 256))
            cube = np.zeros((256, wide, x.shape[1]))
            ids, limit = np.zeros((256, wide), np.int64), np.full((256, wide), 9.0)
            cell = (group[rows_] - g, place[rows_])
            cube[cell], ids[cell], limit[cell] = x[rows_], member[rows_], worst_[rows_]
            sims = cube @ cube.transpose(0, 2, 1)
            there = limit < 9
            ok = (sims > limit[:, :, None]) & there[:, :, None] & there[:, None, :] & (ids[:, :, None] != ids[:, None, :])
            b, i, j = np.nonzero(ok)
            if len(b):
                u, v, s = ids[b, i], ids[b, j], sims[b, i, j]
                first = np.lexsort((v, u))
                u, v, s = u[first], v[first], s[first]
                new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
                yield _edges(u[new], v[new], s[new])

    return _by_runs(rows, ["at"], kernel, EDGE)


def audit(nodes: DataFrame, graph: DataFrame, most: int = AUDITED) -> DataFrame:
    """grp, n, found: of up to `most` nodes, compared with all nodes of their label, how many links there are and how many
    the graph holds. A link with a saturated node at either end counts as found: all of these are compared."""
    rows = nodes.orderBy(F.xxhash64("node")).limit(most).select("node", "grp", "vec").collect()  # bounded
    x = matrix(pa.array([r["vec"] for r in rows], pa.list_(pa.float64())))
    grp, ids = np.array([r["grp"] for r in rows], object), np.array([r["node"] for r in rows], np.int64)
    sent = nodes.sparkSession.sparkContext.broadcast((x, grp, ids))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch.column(2))
                q, g, i = sent.value
                wide = max(q.shape[1], y.shape[1])
                q, y = np.pad(q, ((0, 0), (0, wide - q.shape[1]))), np.pad(y, ((0, 0), (0, wide - y.shape[1])))
                same = g[:, None] == np.array(batch.column(1).to_pylist(), object)
                a, b = np.nonzero((q @ y.T >= THRESHOLD) & same)
                yield _edges(i[a], batch.column(0).to_numpy()[b], np.ones(len(a)))

    arrow_rows(nodes.sparkSession, 4096)
    truth = nodes.select("node", "grp", "vec").mapInArrow(lean(run), EDGE) if rows else nodes.sparkSession.createDataFrame([], EDGE)
    truth = truth.where(F.col("node") != F.col("other")).select("node", "other")
    full = _saturated(graph)
    held = graph.select("node", "other", F.lit(True).alias("held")).unionByName(graph.select(F.col("other").alias("node"), F.col("node").alias("other"), F.lit(True).alias("held"))).distinct()
    of = truth.join(held, ["node", "other"], "left").join(full.select("node", F.lit(True).alias("own")), "node", "left").join(full.select(F.col("node").alias("other"), F.lit(True).alias("its")), "other", "left")
    named = of.join(nodes.select("node", "grp"), "node")
    return named.groupBy("grp").agg(F.count("*").alias("n"), F.count_if(F.coalesce("held", "own", "its", F.lit(False))).alias("found"))


def recall(audited: DataFrame) -> float:
    n, found = audited.agg(F.sum("n"), F.sum("found")).first()
    return found / n if n else 1.0


def _saturated(graph: DataFrame) -> DataFrame:
    return graph.groupBy("node").agg(F.min("sim").alias("least"), F.count("*").alias("held")).where((F.col("held") >= NEIGHBOURS) & (F.col("least") >= THRESHOLD)).select("node")


def descend(nodes: DataFrame) -> DataFrame:
    """The neighbour graph of nodes (node, grp, vec): node, other, sim, rank."""
    facts = nodes.groupBy("grp").agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims")).agg(F.max("n"), F.max("dims")).first()
    bits, dims = min(48, max(1, int(np.ceil(np.log2(max(2, (facts[0] or 2) / LEAF)))))), facts[1] or 1
    graph = checkpointed(_best(_forest(nodes, bits, dims), NEIGHBOURS))
    total = max(1, graph.count())
    for k in range(ROUNDS + MORE_ROUNDS):
        if k >= ROUNDS and recall(audit(nodes, graph)) >= TARGET:
            break
        more = _joined(graph, nodes)
        more = more.unionByName(_forest(nodes, bits, dims, 5 + k)) if k >= ROUNDS else more
        new = checkpointed(_best(graph.select("node", "other", "sim").unionByName(more), NEIGHBOURS))
        fresh = new.join(graph, ["node", "other"], "left_anti").count()
        graph = new
        if fresh <= SETTLED * total and k >= ROUNDS - 1 and recall(audit(nodes, graph)) >= TARGET:
            break
    return graph


def enlarged(nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """node of all nodes whose links the graph can't show: saturated ones, and those of labels where the audit misses any."""
    poor = audit(nodes, graph).where(F.col("found") < F.col("n")).select("grp")
    return checkpointed(_saturated(graph).unionByName(nodes.join(poor, "grp", "left_semi").select("node")).distinct())


def _rooted(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node of each node's component, when the edges i, j come to components with the given roots."""
    while True:
        a, b = root[i], root[j]
        new = a != b
        if not new.any():
            return root
        i, j, a, b = i[new], j[new], a[new], b[new]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _compared(t: pa.Table) -> pa.Table:
    """All links of full nodes between two blocks, or within one: of each node its links with such, weighed by copies, and
    the least node that it is joined with here."""
    low, high, block = t.column(1)[0].as_py(), t.column(2)[0].as_py(), t.column(3).to_numpy()
    node, copies = t.column(4).to_numpy(), t.column(5).to_numpy()
    x = matrix(t.column(6).combine_chunks())
    full = t.column(7).to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    root, links = np.arange(len(node)), np.zeros(len(node), np.int64)
    # full nodes of one block with all of the other, then the others of the first with full ones; within a block the same
    for ours, theirs in ((left[full[left]], right), (left[~full[left]], right[full[right]])):
        y = x[theirs].T
        for k in range(0, len(ours) if len(theirs) else 0, ROWS):
            own = ours[k : k + ROWS]
            a, b = np.nonzero(x[own] @ y >= THRESHOLD)
            a, b = own[a], theirs[b]
            if low == high:
                a, b = a[a != b], b[a != b]
            np.add.at(links, a, copies[b])
            if low != high:
                np.add.at(links, b, copies[a])
            root = _rooted(root, a, b)
    on = np.flatnonzero(links)
    return pa.table({"node": node[on], "other": node[root[on]], "links": links[on]})


def compared(nodes: DataFrame, full: DataFrame) -> DataFrame:
    """node, other and links of nodes (node, grp, copies, vec) that have links with the full ones (node): other is joined
    with the node, links is part of its number; a row for each pair of blocks."""
    nodes = nodes.join(full.select("node", F.lit(True).alias("full")), "node", "left").withColumn("full", F.coalesce("full", F.lit(False)))
    nodes = nodes.join(nodes.where("full").select("grp").distinct(), "grp", "left_semi")
    facts = nodes.groupBy("grp").agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims"))
    n, dims = facts.agg(F.max("n"), F.max("dims")).first()
    size = min(max(LEAST_BLOCK, -(-(n or 1) // BLOCKS)), max(LEAST_BLOCK, MOST_VALUES // (dims or 1)))
    dealt = nodes.join(facts.select("grp", F.ceil(F.col("n") / size).alias("blocks")), "grp")
    rows = dealt.select("grp", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "node", "copies", "vec", "full")
    pairs = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.select("grp", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "copies", "vec", "full")
    arrow_rows(nodes.sparkSession, 4096)
    return pairs.groupBy("grp", "low", "high").applyInArrow(_compared, "node long, other long, links long")


def near_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row (vec_id, embedding, label)."""
    vec, label = F.col("embedding"), F.col("label")
    marked = rows.select("vec_id", "embedding", "label", usable(vec, label).alias("ok"))
    good = marked.where("ok").select("vec_id", node_of(vec, label).alias("node"), group_of(vec, label).alias("grp"), vec.alias("vec"))
    nodes = stored(good.groupBy("node").agg(F.first("grp").alias("grp"), F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "vectors")
    graph = descend(nodes)
    full = enlarged(nodes, graph)
    whole = checkpointed(compared(nodes, full))
    listed = checkpointed(graph.where(F.col("sim") >= THRESHOLD).select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct())
    roots = components(listed.unionByName(whole.select(F.col("node").alias("u"), F.col("other").alias("v"))))
    both = listed.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(listed.select(F.col("v").alias("node"), F.col("u").alias("other")))
    free = both.join(full, "node", "left_anti").join(full.select(F.col("node").alias("other")), "other", "left_anti")  # links with full nodes are in `whole`
    links = free.join(nodes.select(F.col("node").alias("other"), "copies"), "other").select("node", F.col("copies").alias("links")).unionByName(whole.select("node", "links"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "copies", "least").join(roots, "node", "left").join(counted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(ids, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id")
    out = good.select("vec_id", "node").join(result, "node").select("vec_id", "n_links", "component_id")
    alone = marked.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
