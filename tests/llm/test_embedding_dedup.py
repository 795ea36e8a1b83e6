import numpy as np
import pytest
from pyspark.sql import Row

from clickscope.llm import embedding_dedup as D


def brute(rows, threshold):
    fine = []
    for k, (_, e, label) in enumerate(rows):
        ok = label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        fine.append(np.asarray(e, np.float32).astype(float) / np.linalg.norm(np.asarray(e, np.float32).astype(float)) if ok else None)
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if fine[a] is not None and fine[b] is not None and rows[a][2] == rows[b][2] and len(fine[a]) == len(fine[b]) \
                    and fine[a] @ fine[b] >= threshold:
                links[a].append(b)
                links[b].append(a)
    root = [None] * len(rows)
    for k in range(len(rows)):
        if root[k] is None:
            group, stack = set(), [k]
            while stack:
                x = stack.pop()
                if x not in group:
                    group.add(x)
                    stack += links[x]
            low = min((rows[x][0] for x in group if rows[x][0] is not None), default=None)
            for x in group:
                root[x] = (low,)
    return sorted(((rows[k][0], len(links[k]), root[k][0], rows[k][0] == root[k][0]) for k in range(len(rows))), key=str)


def frame(spark, rows):
    return spark.createDataFrame([Row(vec_id=i, embedding=e, label=l, node="clash") for i, e, l in rows],
                                 "vec_id long, embedding array<float>, label int, node string")


def corpus(seed, n=260, dims=12):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims).tolist(), int(i % 3)) for i in range(n)]
    centre = rng.normal(size=dims)
    rows += [(1000 + i, (centre + rng.normal(0, 0.02, dims)).tolist(), 1) for i in range(60)]  # saturates lists
    rows += [(2000 + i, (np.array(rows[i][1]) * 2 + rng.normal(0, 0.03, dims)).tolist(), int(i % 3)) for i in range(0, 40, 2)]
    odd = [(3000, None, 1), (3001, [0.0] * dims, 1), (3002, [float("nan")] * dims, 1), (3003, [None] * dims, 1),
           (3004, rows[0][1], None), (3005, rows[0][1], 0), (3006, rows[0][1], 1), (None, rows[5][1], 2), (3007, [], 1),
           (3008, [1.0, 2.0], 1), (3009, [2.0, 4.0], 1), rows[7]]
    return rows + odd


def test_equals_brute_force(spark):
    rows = corpus(1)
    got, recall = D.near_duplicates(frame(spark, rows), k=6, tables=4)
    assert recall >= 0.9
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 0.98)


def test_empty_and_single(spark):
    for rows in ([], [(1, [1.0, 0.0], 1)]):
        got, recall = D.near_duplicates(frame(spark, rows))
        assert recall == 1 and sorted(map(tuple, got.collect())) == brute(rows, 0.98)


def components(edges, ids):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 7)
    rng = np.random.default_rng(2)
    x = (rng.normal(size=8) + rng.normal(0, 0.3, (40, 8))).astype(np.float32)
    m = rng.integers(0, 4, 40)
    nodes = spark.createDataFrame([(i, 1, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, m))], "node long, grp long, v array<float>, m long")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.95) & ~np.eye(40, dtype=bool)
    got = D.within_components(nodes, nodes.selectExpr("node", "0L as root"), 0.95).collect()
    near, blocks = np.zeros(40, int), -(-40 // 7)
    for r in got:
        near[r.node] += r.near
    assert near.tolist() == (linked @ m).tolist() and len(got) <= 40 * blocks < linked.sum() / 2
    want = components([(a, b) for a, b in zip(*np.nonzero(linked))], range(40))
    assert components([(r.node, r.other) for r in got], range(40)) == want


def test_spread_finds_components():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30):
        for share in (0, 0.03, 0.1, 1):
            linked = rng.random((n, n)) < share
            linked = (linked | linked.T) & ~np.eye(n, dtype=bool)
            want = components([(a, b) for a, b in zip(*np.nonzero(linked))], range(n))
            assert D._spread(linked).tolist() == [want[i] for i in range(n)]


NODES = "node long, grp long, v array<float>, m long"


def random_nodes(spark, seed, n, dims=12):
    x = np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32)
    return spark.createDataFrame([(i, i % 3, r.tolist(), 1) for i, r in enumerate(x)], NODES)


def test_start_chance_holds_at_every_size():
    for largest in (100, 40_000, 10**7, 10**9):
        bits = D.leaf_bits(largest)
        together = (1 - np.arccos(0.98) / np.pi) ** bits
        assert 1 - (1 - together) ** max(D.TABLES, D.tables_for(bits, 0.98)) >= 0.99


def test_a_table_without_links_is_no_evidence(spark, monkeypatch):
    """First lists that find nothing are not taken because the audited vectors have no links either."""
    turns, start = [], D.start_lists

    def weak_at_first(*args):
        turns.append(1)
        return start(*args) if len(turns) > 1 else start(*args).where("false")

    monkeypatch.setattr(D, "start_lists", weak_at_first)
    degree, edges, recall = D.find_links(random_nodes(spark, 3, 600), 0.98, k=6, tables=4)
    assert len(turns) == 2 and recall >= D.RECALL and edges.count() == degree.count() == 0


def test_audit_grows_until_links_were_seen(spark, monkeypatch):
    monkeypatch.setattr(D, "AUDITED", 50)
    monkeypatch.setattr(D, "SEEN", 1)
    x = np.random.default_rng(4).normal(size=(400, 12))
    at = random_nodes(spark, 4, 400).selectExpr("node", f"pmod(xxhash64({D.SEED}, node), 8) as b").collect()
    last = [r.node for r in at if r.b == 7][:2]  # the only link is between vectors of the last block
    x[last[1]] = x[last[0]] * 2 + 0.001
    nodes = spark.createDataFrame([(i, 1, r.tolist()) for i, r in enumerate(x)], "node long, grp long, v array<float>")
    assert [tuple(r) for r in D.seen_links(nodes, 0.98, 400).collect()] == [tuple(sorted(last))]


def linked_nodes(spark, seed, n, dims=12):
    """Nodes of two labels with sparse links, and the links by brute force."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[2::20] = x[0::20] + rng.normal(0, 0.02, x[2::20].shape)
    x, grp = x.astype(np.float32), np.arange(n) % 2
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    i, j = np.nonzero((u @ u.T >= 0.98) & (grp[:, None] == grp))
    nodes = spark.createDataFrame([(i, int(g), r.tolist(), 1) for i, (g, r) in enumerate(zip(grp, x))], NODES)
    return nodes, {(int(a), int(b)) for a, b in zip(i, j) if a < b}


def test_links_of_many_times_the_audited_vectors(spark, monkeypatch):
    monkeypatch.setattr(D, "AUDITED", 40)
    monkeypatch.setattr(D, "AUDITS", 2)
    monkeypatch.setattr(D, "PLANTED", 60)
    nodes, want = linked_nodes(spark, 5, 1200)
    degree, edges, recall = D.find_links(nodes, 0.98)
    got = [tuple(r) for r in edges.collect()]
    assert recall >= D.RECALL and len(want) >= 60 and len(got) == len(set(got)) and set(got) <= want
    assert 2 * len(want) >= sum(r.near for r in degree.collect()) >= 0.99 * 2 * len(want)


def test_audited_links_are_not_results(spark, monkeypatch):
    """Lists that find nothing are not filled up by the audit, whatever the size of the labels."""
    start = D.start_lists
    monkeypatch.setattr(D, "start_lists", lambda *args: start(*args).where("false"))
    monkeypatch.setattr(D, "ROUNDS", 2)
    nodes, want = linked_nodes(spark, 6, 200)
    with pytest.raises(RuntimeError):
        D.find_links(nodes, 0.98)


def test_only_labels_that_miss_links_run_again(spark, monkeypatch):
    turns, start = [], D.start_lists

    def blind_at_first(nodes, *args):
        turns.append(sorted(r.grp for r in nodes.select("grp").distinct().collect()))
        lists = start(nodes, *args)
        own = nodes.select("node", "grp")
        return lists if len(turns) > 1 else lists.join(own, "node").where("grp = 0").drop("grp")

    monkeypatch.setattr(D, "start_lists", blind_at_first)
    nodes, want = linked_nodes(spark, 7, 400)
    degree, edges, recall = D.find_links(nodes, 0.98)
    assert turns == [[0, 1], [1]] and sum(r.near for r in degree.collect()) == 2 * len(want)
