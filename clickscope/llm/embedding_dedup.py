"""Embedding near-duplicates by NN-descent.

A neighbour list of each distinct vector is started from random hyperplane
leaves and refined: the neighbours of a vector, forward and backward, are compared with each other and
offered to each other's lists, until few entries change. Entries at or above the
threshold are links. A vector with as many links as its list holds is saturated: its whole component
is compared in pairs of blocks, which give each vector's number of links and edges that connect the
same vectors, never all pairs. The number of leaves a vector is in follows from their size, so that a
pair at the threshold starts in one leaf equally likely in tables of any size.

The recall is audited by two kinds of known links: those of a sample of vectors compared with all others of
their label, grown in blocks until enough links were seen, and those of vectors planted at the threshold beside
vectors of the table, which are evidence also where the table has few links or none. Audited links only judge:
neither they nor planted vectors are in the result. Below the target, lists and leaves are doubled and the
labels that miss links are run again; a recall that stays below it is an error.

Equal vectors of a label are one node with a multiplicity. All steps shuffle by
node, leaf or block; a dense leaf is split at random, a large component into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickscope.llm.common import connected_components, stage

NEIGHBOURS = 10
LEAF = 64
TABLES = 6          # at least
START = 0.999       # chance that a pair at the threshold shares a leaf of the first lists, before dense ones are split
CHANGED = 0.002     # stop refining below this share of list entries
BLOCK = 1024
AUDITED = 512       # vectors of a block of the audit, compared with all others
AUDITS = 16         # blocks at most; planted links don't depend on them
SEEN = 200          # true links after which the audit takes no further block
PLANTED = 512
RECALL = 0.99
ROUNDS = 6
SEED = 20240601


# ---------------------------------------------------------------- runs of rows

def runs(batches: Iterator[pa.RecordBatch], keys: int):
    """Of batches sorted by their first ``keys`` columns: (columns, bounds of whole runs), a
    list column as (values, offsets)."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            t = pa.concat_tables([held, t])
        k = np.stack([t.column(i).to_numpy() for i in range(keys)])
        bounds = np.concatenate(([0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1)) if t.num_rows else np.zeros(1, int)
        if bounds[-1]:
            yield _columns(t.slice(0, bounds[-1])), bounds
        held = t.slice(bounds[-1])
    if held is not None and held.num_rows:
        yield _columns(held), np.array([0, held.num_rows])


def _columns(t: pa.Table) -> list:
    out = []
    for c in t.combine_chunks().columns:
        c = c.chunk(0) if c.num_chunks else pa.array([], c.type)
        if pa.types.is_list(c.type):
            start = c.offsets[0].as_py()
            out.append((c.flatten().to_numpy(zero_copy_only=False), c.offsets.to_numpy() - start))
        else:
            out.append(c.to_numpy(zero_copy_only=False))
    return out


def units(vectors, a: int, b: int) -> np.ndarray:
    """Rows a to b as unit vectors in double precision."""
    values, at = vectors
    x = values[at[a]:at[b]].reshape(b - a, -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _out(rows: list, names: str) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names.split())


def _by_runs(df: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    names = " ".join(c.split()[0] for c in schema.split(", "))

    def run(batches):
        for cols, bounds in runs(batches, len(keys)):
            rows, size = [], 0
            for a, b in zip(bounds, bounds[1:]):
                if (found := work(cols, a, b)) is not None:
                    rows.append(found)
                    size += len(found[0])
                    if size > 200_000:
                        yield _out(rows, names)
                        rows, size = [], 0
            if rows:
                yield _out(rows, names)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


# ---------------------------------------------------------------- lists

LIST = "node long, other long, sim double"


def _leaves(nodes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``(grp, tab, sig, node, v)``: the side of ``bits`` random hyperplanes, for each table."""

    names = ["grp", "tab", "sig", "node", "v"]

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for n in np.unique(sizes):  # vectors of one length together
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, n).astype(np.float64)
                x /= np.abs(x).max(1, keepdims=True)
                rng = np.random.default_rng(seed + int(n))
                for tab in range(tables):  # one at a time: a batch holds its vectors once
                    sig = (x @ rng.normal(size=(n, bits)) > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(x), tab, np.int32)),
                                                      pa.array(sig), part.column(1), part.column(2)], names)

    element = dict(nodes.dtypes)["v"][6:-1]
    return nodes.select("grp", "node", "v").mapInArrow(run, f"grp long, tab int, sig long, node long, v array<{element}>")


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest other entries of each row."""
    n = len(sims)
    np.fill_diagonal(sims, -np.inf)
    k = min(k, n - 1)
    cols = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (n, 1))
    return np.repeat(np.arange(n), k), cols.ravel()


def _top(lists: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    return lists.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k).drop("r")


def leaf_bits(largest: int) -> int:
    """Hyperplanes that cut a label of ``largest`` vectors into leaves of about ``LEAF``."""
    return max(1, int(np.ceil(np.log2(max(2, largest / LEAF)))))


def tables_for(bits: int, threshold: float) -> int:
    """Tables in which a pair at the threshold shares a leaf at least once with a chance of ``START``."""
    together = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    return 1 if together >= START else int(np.ceil(np.log(1 - START) / np.log1p(-together)))


def start_lists(nodes: DataFrame, k: int, tables: int, largest: int, seed: int) -> DataFrame:
    """First lists: the nearest of a vector's leaves."""
    bits = leaf_bits(largest)
    leaves = _leaves(nodes, bits, tables, seed)
    dense = stage(leaves.groupBy("grp", "tab", "sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * LEAF)
                  .select("grp", "tab", "sig", F.ceil(F.col("n") / LEAF).alias("parts")), "nnd_dense")
    split = (leaves.join(dense, ["grp", "tab", "sig"], "left")
             .select("grp", F.col("tab").cast("long").alias("tab"), "sig",
                     F.coalesce(F.pmod(F.xxhash64("node", "tab"), "parts"), F.lit(0)).alias("part"), "node", "v"))

    def work(cols, a, b):
        if b - a < 2:
            return None
        x, node = units(cols[5], a, b), cols[4][a:b]
        sims = x @ x.T
        i, j = _best(sims, k)
        return node[i], node[j], sims[i, j]

    return _top(_by_runs(split, ["grp", "tab", "sig", "part"], work, LIST).dropDuplicates(["node", "other"]), k)


def offers(lists: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Neighbours of each vector, offered to each other where they'd enter the list.

    ``lists``: ``(node, other, sim, new)``. A pair of two old entries was compared before. Of a vector that
    many lists hold, ``k`` lists chosen by a hash take part in its comparisons.
    """
    back = lists.select(F.col("other").alias("at"), F.col("node").alias("who"), "new")
    few = Window.partitionBy("at").orderBy(F.desc("new"), F.xxhash64("at", "who"))
    back = back.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k).drop("r")
    edges = (lists.select(F.col("node").alias("at"), F.col("other").alias("who"), "new").unionByName(back)
             .groupBy("at", "who").agg(F.max("new").alias("new")))
    full = lists.groupBy("node").agg(F.min("sim").alias("last"), F.count(F.lit(1)).alias("n"))
    member = nodes.select("node", "v").join(full, "node", "left").select(
        F.col("node").alias("who"), F.when(F.col("n") >= k, F.col("last")).otherwise(-2.0).alias("last"), "v")
    rows = edges.join(member, "who").select("at", "who", F.col("new").cast("int").alias("new"), "last", "v")

    def work(cols, a, b):
        new = cols[2][a:b] > 0
        if b - a < 2 or not new.any():
            return None
        x, who, last = units(cols[4], a, b), cols[1][a:b], cols[3][a:b]
        sims = x @ x.T
        ok = (new[:, None] | new[None, :]) & (sims > last[:, None])
        np.fill_diagonal(ok, False)
        i, j = np.nonzero(ok)
        return (who[i], who[j], sims[i, j]) if len(i) else None

    return _by_runs(rows, ["at"], work, LIST).dropDuplicates(["node", "other"])


def refine(lists: DataFrame, nodes: DataFrame, k: int, n: int) -> DataFrame:
    """Neighbours-of-neighbours joins until few entries change."""
    lists = stage(lists.withColumn("new", F.lit(True)), "nnd_lists")
    while True:  # ends: lists only get nearer
        fresh = (offers(lists, nodes, k).withColumn("new", F.lit(True))
                 .join(lists.select("node", "other"), ["node", "other"], "left_anti"))
        lists = stage(_top(lists.withColumn("new", F.lit(False)).unionByName(fresh), k), "nnd_lists")
        if lists.where("new").count() <= CHANGED * n * k:
            break
    return lists


# ---------------------------------------------------------------- links

def _spread(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row of its connected component."""
    root, todo = np.full(len(linked), -1), np.arange(len(linked))
    for first in todo:
        if root[first] >= 0:
            continue
        inside = edge = linked[first] | (todo == first)
        while edge.any():
            edge = linked[edge].any(0) & ~inside
            inside = inside | edge
        root[inside & (root < 0)] = first
    return root


def within_components(nodes: DataFrame, places: DataFrame, threshold: float) -> DataFrame:
    """Links between nodes of one group, ``places``: ``(node, root)``, as ``(node, other, near)``: each node
    with the sum of ``m`` over its links within a pair of blocks, and a node it reaches by links there.

    So a group of n nodes gives n rows for each of its blocks, however many links it has. ``nodes``: ``(node, v, m)``.
    """
    sizes = places.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    dealt = (nodes.select("node", "m", "v").join(salted(places, sizes), "node").withColumn("mine", own)
             .withColumn("x", F.explode(every))
             .select("root", F.least("mine", "x").alias("i"), F.greatest("mine", "x").alias("j"), "mine", "node", "m", "v"))

    def work(cols, a, b):
        i, j, mine, node, m = cols[1][a], cols[2][a], cols[3][a:b], cols[4][a:b], cols[5][a:b]
        x = units(cols[6], a, b)
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if i != j:  # pairs within a block are those of (i, i)
            linked &= mine[:, None] != mine[None, :]
        near, low = linked @ m, node[_spread(linked)]
        some = linked.any(1)
        return (node[some], low[some], near[some]) if some.any() else None

    return _by_runs(dealt, ["root", "i", "j"], work, "node long, other long, near long")


def salted(places: DataFrame, small: DataFrame, parts: int = 64) -> DataFrame:
    """``places`` joined with ``small`` by ``root``; a root with many nodes is dealt over ``parts`` keys."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("salt")
    return (places.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int"))
            .join(small.select("*", salt), ["root", "salt"]).drop("salt"))


def audit_links(nodes: DataFrame, threshold: float, block: int = 0, blocks: int = 1) -> DataFrame:
    """All links ``(a, b)`` of the nodes that a hash deals into ``block``, compared with every other of their group."""
    sample = nodes.where(F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(blocks)) == block).select("grp", "node", "v").collect()
    groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for g in {r["grp"] for r in sample}:
        mine = [r for r in sample if r["grp"] == g]
        x = np.array([r["v"] for r in mine], np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        groups[g] = (np.array([r["node"] for r in mine], np.int64), x / np.sqrt((x * x).sum(1, keepdims=True)))

    def run(batches):
        for batch in batches:
            grp, node, v = _columns(pa.Table.from_batches([batch]))
            rows = []
            for g in np.unique(grp):
                if g in groups:
                    at = np.flatnonzero(grp == g)
                    values, off = v
                    x = np.stack([values[off[i]:off[i + 1]] for i in at]).astype(np.float64)
                    x /= np.abs(x).max(1, keepdims=True)
                    x /= np.sqrt((x * x).sum(1, keepdims=True))
                    ids, q = groups[g]
                    i, j = np.nonzero(x @ q.T >= threshold)
                    a, b = node[at[i]], ids[j]
                    rows.append((np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]))
            if rows and sum(len(r[0]) for r in rows):
                yield _out(rows, "a b")

    return nodes.select("grp", "node", "v").mapInArrow(run, "a long, b long").distinct()


def seen_links(nodes: DataFrame, threshold: float, n: int) -> DataFrame:
    """All links of a sample that grows in blocks until it has ``SEEN`` links, all nodes or ``AUDITS`` blocks."""
    blocks = -(-n // AUDITED)
    seen = None
    for block in range(min(blocks, AUDITS)):
        more = audit_links(nodes, threshold, block, blocks)
        seen = stage((more if seen is None else seen.unionByName(more)).distinct(), "nnd_audit")
        if seen.count() >= SEEN:
            break
    return seen


def plant(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(node, grp, v, base)``: beside each of the ``PLANTED`` nodes first by a hash, a vector that just
    reaches the threshold, in a random direction. One that rounding puts below it is left out."""
    element = dict(nodes.dtypes)["v"][6:-1]
    kind = np.float32 if element == "float" else np.float64
    wanted = min(1.0, threshold + 0.01 * (1 - threshold))  # rounding to floats stays above the threshold

    def run(batches):
        for batch in batches:
            for g, base, node, v in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x = np.array(v, np.float64) / np.abs(v).max()
                x /= np.sqrt(x @ x)
                y = np.random.default_rng([SEED, base % (1 << 64)]).normal(size=len(x))
                y -= (x @ y) * x
                size = np.sqrt(y @ y)
                z = wanted * x + np.sqrt(1 - wanted * wanted) * y / size if len(x) > 1 and size > 0 else x
                z = z.astype(kind).astype(np.float64)
                if x @ z / np.sqrt(z @ z) >= threshold:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node]), pa.array([g]), pa.array([z.tolist()], pa.list_(pa.float64())), pa.array([base])],
                        ["node", "grp", "v", "base"])

    few = nodes.orderBy(F.xxhash64(F.lit(SEED), "node"), "node").limit(PLANTED)
    return (few.select("grp", F.col("node").alias("base"), F.xxhash64(F.lit("planted"), "node").alias("node"), "v")
            .mapInArrow(run, "node long, grp long, v array<double>, base long")
            .withColumn("v", F.col("v").cast(f"array<{element}>")))


def found_of(truth: DataFrame, links: DataFrame, whole: DataFrame) -> DataFrame:
    """Of the pairs ``truth`` those that were found: a link, or two nodes of one group that was compared whole."""
    both = (truth.join(whole.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(whole.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra = rb").select("a", "b"))
    return truth.join(links.select("a", "b"), ["a", "b"]).select("a", "b").unionByName(both).distinct()


def find_links(nodes: DataFrame, threshold: float, k: int = NEIGHBOURS, tables: int = TABLES) -> tuple[DataFrame, DataFrame, float]:
    """What links nodes ``(node, grp, v, m)``: ``(node, near)`` with the sum of ``m`` over a node's links; edges ``(a, b)``
    that connect what links connect; and the audited recall, the lower of those of the sample's links and of the
    planted ones (1 if there are neither). An error if it stays below ``RECALL``."""
    if dict(nodes.dtypes)["v"] not in ("array<float>", "array<double>"):
        nodes = nodes.withColumn("v", F.col("v").cast("array<double>"))
    n = nodes.count()
    if not n:
        return (nodes.select("node", F.lit(0).cast("long").alias("near")),
                nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), 1.0)
    truth = seen_links(nodes, threshold, n)
    beside = stage(plant(nodes, threshold), "nnd_planted")
    known = stage(truth.withColumn("planted", F.lit(False))
                  .unionByName(beside.select(F.least("node", "base").alias("a"), F.greatest("node", "base").alias("b"), F.lit(True).alias("planted"))),
                  "nnd_known")
    expected = {r["planted"]: r["count"] for r in known.groupBy("planted").count().collect()}
    everything = stage(nodes.select("node", "grp", "v", "m")
                       .unionByName(beside.select("node", "grp", "v", F.lit(0).cast("long").alias("m"))), "nnd_all")
    largest = nodes.groupBy("grp").count().agg(F.max("count")).first()[0]
    tables = max(tables, tables_for(leaf_bits(largest), threshold))

    pairs, todo, size, recall = None, everything, n, 0.0
    for turn in range(ROUNDS):
        lists = refine(start_lists(todo, k, tables, largest, SEED + 1000 * turn), todo, k, size)
        near = lists.where(F.col("sim") >= threshold)
        new = near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        pairs = stage((new if pairs is None else pairs.unionByName(new)).distinct(), "nnd_links")
        places = connected_components(pairs)
        # a list full of links may have lost some: its whole component is compared
        each = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
        roots = places.join(each.where(F.col("c") >= k), "node").select("root").distinct()
        whole = stage(salted(places, roots), "nnd_whole")
        found = stage(found_of(known.select("a", "b"), pairs, whole).join(known, ["a", "b"]), "nnd_found_known")
        seen = {r["planted"]: r["count"] for r in found.groupBy("planted").count().collect()}
        recall = min((seen.get(kind, 0) / n_known for kind, n_known in expected.items()), default=1.0)
        if recall >= RECALL:
            break
        # again with longer lists and more leaves, for the labels that miss links
        missed = known.join(found, ["a", "b"], "left_anti").select(F.col("a").alias("node"))
        again = everything.join(missed, "node").select("grp").distinct()
        todo = stage(everything.join(F.broadcast(again), "grp", "left_semi"), "nnd_again")  # at most as many labels as known links
        size = todo.count()
        k, tables = 2 * k, 2 * tables
    else:
        raise RuntimeError(f"audited recall {recall:.3f} is below {RECALL}")

    ids = F.broadcast(beside.select("node"))
    own = pairs.join(ids.withColumnRenamed("node", "a"), "a", "left_anti").join(ids.withColumnRenamed("node", "b"), "b", "left_anti")
    inner = stage(within_components(everything.join(ids, "node", "left_anti"), whole.join(ids, "node", "left_anti"), threshold), "nnd_inner")
    both = own.select(F.col("a").alias("node"), F.col("b").alias("other")).union(own.select("b", "a"))
    degree = (both.join(whole.select("node"), "node", "left_anti").join(nodes.select(F.col("node").alias("other"), "m"), "other")
              .groupBy("node").agg(F.sum("m").alias("near"))
              .unionByName(inner.groupBy("node").agg(F.sum("near").cast("long").alias("near"))))
    edges = own.select("a", "b").union(inner.where("node <> other").select(F.least("node", "other"), F.greatest("node", "other"))).distinct()
    return degree, stage(edges, "nnd_edges"), recall


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = 0.98, k: int = NEIGHBOURS, tables: int = TABLES) -> tuple[DataFrame, float]:
    """``(vec_id, n_links, component_id, kept)`` for each input row, and the audited recall of the links.

    Vectors of equal non-null label and equal length link at a cosine of at least ``threshold``, in
    double precision. Null or empty vectors, vectors of zeros and those with null or non-finite components, and
    rows with a null label link with nothing. ``n_links`` counts other rows linked directly (copies
    too); ``component_id`` is the smallest id reachable (null ids excepted), ``kept`` whether it is the row's
    own. Every row is kept, repeats of an id are rows of their own; other columns are left out.
    """
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col(label).isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    group = F.xxhash64(F.col(label).cast("string"), F.size(e))
    rows = stage(vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                                F.when(valid, F.xxhash64(group, e)).alias("node"), F.when(valid, group).alias("grp"), e.alias("v")),
                 "nnd_rows")
    classes = stage(rows.where("node is not null").groupBy("node", "grp")
                    .agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least")), "nnd_classes")
    degree, edges, recall = find_links(classes.drop("least"), threshold, k, tables)
    places = connected_components(edges)
    classes = classes.drop("v", "grp")
    least = (classes.join(places, "node").groupBy("root").agg(F.min("least").alias("low")))
    found = stage(classes.join(degree, "node", "left").join(places, "node", "left").join(least, "root", "left")
                  .select("node", (F.col("m") - 1 + F.coalesce("near", F.lit(0))).alias("n"),
                          F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("low")).alias("low")), "nnd_found")
    out = rows.select("vec_id", "node").join(found, "node", "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("low")).alias("component_id"),
                      F.when(F.col("n").isNull(), F.lit(True)).otherwise(F.col("vec_id").eqNullSafe(F.col("low"))).alias("kept")), recall
