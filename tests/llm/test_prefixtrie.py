import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from snapmart.llm import prefixtrie as pt
from snapmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [r[2:] for r in sorted(v)] for c, v in convs.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - c % 5, [])[: h[c]] + v[h[c] :] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in sorted(convs.items()):
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in children[key]) if children[key] else 1
        own = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        saved[key] = own + sum(saved[k] for k in children[key])
    return sorted(
        (members[k][0], len(k), members[k[:-1]][0] if k else -1, len(members[k]), len(children[k]), leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest())
        for k in members
    )


def collected(df):
    assert df.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op13_prefix_trie"](spark, SF)) == brute(rows)


ODD = [
    (None, 1, "user", "lost"), (1, None, None, None), (1, None, "user", ""), (1, 3, "user", "é"), (1, 3, "user", "é"),
    *((5, t, "user" if t % 2 else "assistant", f"turn {t} " * 3) for t in range(120)),
    *((c, t, "user" if t % 2 else "assistant", f"turn {t} " * 3) for c in range(6, 10) for t in range(40 * (c - 5))),
    *((c, 0, "user", "the same first turn") for c in range(100, 300)),
    *((c, 1, "assistant", "word " * 30_000) for c in range(100, 104)),
    (401, 0, "system", "its family has no first one"), (402, 0, "system", "its family has no first one"),
]


@pytest.mark.parametrize("rebuild", [True, False])
def test_odd_rows(spark, rebuild):
    convs = spark.createDataFrame([(*r, "x") for r in ODD], SCHEMA).repartition(5)
    assert collected(pt.prefix_trie(convs, rebuild=rebuild)) == brute(ODD, rebuild)
    assert pt.prefix_trie(convs.limit(0), rebuild=rebuild).count() == 0


def test_conversations_without_turns_after_rebuilding(spark):
    gone = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0]
    rows = [(c, 0, "user", "only") for c in gone]  # their first ones are absent
    convs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = collected(pt.prefix_trie(convs))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == len(gone)


def random_tree(rng, n, shape):
    """(conv_id, depth, parent_conv_id, value) of trees: deep chains, stars, or mixed."""
    nodes = [(0, 0, None)]
    for i in range(1, n):
        c, d, _ = nodes[-1] if rng.random() < shape else rng.choice(nodes)
        nodes.append((i, d + 1, c))
    return [(*x, rng.randrange(-5, 1000)) for x in nodes]


@pytest.mark.parametrize("shape", [0.0, 0.8, 0.99, 1.0])
def test_contraction_equals_recursion(spark, shape):
    tree = random_tree(random.Random(3), 400, shape)
    kids = defaultdict(list)
    for c, d, p, v in tree:
        kids[p].append(c)
    value = {c: v for c, _, _, v in tree}
    total = {}
    for c, d, p, v in sorted(tree, key=lambda x: -x[1]):
        total[c] = (value[c] + sum(total[k][0] for k in kids[c]), 1 + sum(total[k][1] for k in kids[c]))
    nodes = spark.createDataFrame([(c, d, p, len(kids[c]), v) for c, d, p, v in tree], "conv_id long, depth long, parent_conv_id long, n_children long, v long")
    got = pt.subtree_totals(nodes, {"v": F.col("v"), "size": F.lit(1)}).collect()
    assert {r.conv_id: (r.v, r["size"]) for r in got} == total and len(got) == len(tree)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    made = []
    plain = pt._contracted
    monkeypatch.setattr(pt, "_contracted", lambda *a: made.append(1) or plain(*a))
    nodes = spark.range(1000).selectExpr("0L AS conv_id", "id AS depth", "if(id = 0, NULL, 0L) AS parent_conv_id", "if(id = 999, 0L, 1L) AS n_children")
    got = pt.subtree_totals(nodes, {"size": F.lit(1)})
    assert {r.depth: r["size"] for r in got.collect()} == {d: 1000 - d for d in range(1000)}
    assert len(made) <= 12


def test_ids_of_one_node_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 50)
    last = spark.range(3000).selectExpr("id * 7 - 500 AS conv_id", "id % 3 AS depth", "0L AS s1")
    got = {r.depth: r.ends_sha256 for r in pt.ends_digest(last, ["depth", "s1"]).collect()}
    want = {k: hashlib.sha256(",".join(str(i * 7 - 500) for i in range(3000) if i % 3 == k).encode()).hexdigest() for k in range(3)}
    assert got == want
