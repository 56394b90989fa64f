"""The prefix trie of conversations, and totals of its subtrees by parallel tree contraction.

Turns are numbered and their hashes added up by scans over one staged order, so a
conversation may span many tasks. A node is known by its depth and the sums of four
31-bit hashes of its turns, each hash being of place, role and text: two sequences are
taken for equal if all four sums agree.

``subtree_totals`` contracts the tree in rounds. Rake: a node without children gives its
sum to its parent and is done. Compress: a node with one child is taken out of its chain, its
child hangs on its parent, and the edge between them carries its sum. Who goes is told by
one bit of the depth, another one each round: it is set in the node's depth and not in
its parent's, so no two neighbours go at once and a chain halves. After about as many rounds as
the depth has bits, plus a few for each level of branching, the root alone is left. Going
back over the rounds, a node taken out has the total of the child it then had, plus what
lay between, plus its own sum. Each round is one staged table, smaller than the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import staged, utf8
from snapmart.operators.ids import drop_place, scan_groups, stage_in_order
from snapmart.sources.staging import discard

#: Conversations with neighbouring ids share turns; at most ``SHARED`` - 1 of them.
FAMILY, SHARED = 5, 9
_SUMS = ["s1", "s2", "s3", "s4"]
_HASHES = ["x1", "x2", "x3", "x4"]
#: Characters of a list of ids that one row carries to its digest.
PIECE = 1 << 16


def turns(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), the two halves of a 128-bit hash of role and text, and the bytes of the text.

    A conversation's rows follow turn (null first), then role and text. A null role or
    text is empty; rows without an id belong to no conversation.
    """
    rows = convs.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).isNotNull().alias("has_turn"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    rows = rows.withColumns({"h1": half(1), "h2": half(17), "bytes": F.octet_length(utf8("text")).cast("long")})
    order = ["conv_id", "has_turn", "turn", "role", "text"]
    ordered = stage_in_order(rows, order, keep=["conv_id", "h1", "h2", "bytes"])
    return drop_place(scan_groups(ordered, ["conv_id"], "place", "n"))


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family.

    From ``turns``: the conversations (conv_id, length), and their turns (conv_id, depth, h1, h2,
    bytes): the first h of the family's first one, then their own after their
    first h, where h is a checksum of the id modulo ``SHARED``.
    """
    own = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED))
    own = own.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    first = own.select(F.col("conv_id").alias("b"), F.col("n").alias("base_n"))
    own = own.join(first, F.col("base") == F.col("b"), "left")
    own = own.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("b", "base_n")
    own = staged(own.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "families")
    turn = ["h1", "h2", "bytes"]
    # At most FAMILY conversations with at most SHARED - 1 turns each meet here under one id.
    lent = numbered.where((F.col("place") < SHARED) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("b"), "place", *turn)
    heads = own.join(lent, (F.col("base") == F.col("b")) & (F.col("place") <= F.col("taken"))).select("conv_id", F.col("place").alias("depth"), *turn)
    tails = numbered.join(own.select("conv_id", "h", "taken"), "conv_id").where(F.col("place") > F.col("h"))
    tails = tails.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), *turn)
    return own.select("conv_id", "length"), heads.unionByName(tails)


def prefixes(said: DataFrame) -> DataFrame:
    """conv_id, depth, x1 to x4 (hashes of the turn at its depth), s1 to s4 (their sums up to it), bytes."""
    half = (1 << 31) - 1
    a, b = F.xxhash64("depth", "h1", "h2"), F.xxhash64("h2", "depth", "h1")
    pieces = [a.bitwiseAND(F.lit(half)), F.shiftrightunsigned(a, 33), b.bitwiseAND(F.lit(half)), F.shiftrightunsigned(b, 33)]
    rows = said.select("conv_id", "depth", *(p.alias(x) for p, x in zip(pieces, _HASHES, strict=True)), "bytes")
    sums = {s: F.col(x) for s, x in zip(_SUMS, _HASHES, strict=True)}
    return drop_place(scan_groups(stage_in_order(rows, ["conv_id", "depth"]), ["conv_id"], "n", "total", sums)).drop("n", "total")


def trie(lengths: DataFrame, rows: DataFrame) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, bytes (of its last
    text) and ends_sha256, from ``lengths`` (conv_id, length) and ``rows`` as ``prefixes`` gives them."""
    key = ["depth", *_SUMS]
    nodes = rows.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), *(F.max(x).alias(x) for x in _HASHES))
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), *(zero.alias(s) for s in _SUMS), "conv_id", "n_convs", zero.alias("bytes"), *(zero.alias(x) for x in _HASHES))
    nodes = staged(nodes.unionByName(root), "nodes")
    up = {"depth": F.col("depth") - 1} | {s: F.col(s) - F.col(x) for s, x in zip(_SUMS, _HASHES, strict=True)}
    parent = {c: f"p_{c}" for c in key}
    below = nodes.where("depth > 0").select(*(up[c].alias(parent[c]) for c in key), *key)
    kids = below.groupBy(*parent.values()).agg(F.count("*").alias("n_children"))
    same = lambda names: [F.col(c) == F.col(n) for c, n in names.items()]
    nodes_up = nodes.join(kids, same(parent), "left").drop(*parent.values())
    above = nodes.select(*(F.col(c).alias(n) for c, n in parent.items()), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes_up.withColumns({f"u_{c}": up[c] for c in key})
    # One row on the right a key; the children of one parent, on the left, can be split.
    linked = linked.join(above, [F.col(f"u_{c}") == F.col(n) for c, n in parent.items()], "left").drop(*parent.values(), *(f"u_{c}" for c in key))
    last = rows.join(lengths, "conv_id").where(F.col("depth") == F.col("length")).select("conv_id", *key)
    last = last.unionByName(lengths.where("length = 0").select("conv_id", zero.alias("depth"), *(zero.alias(s) for s in _SUMS)))
    ends = ends_digest(last, key).withColumnsRenamed({c: f"e_{c}" for c in key})
    out = linked.join(ends, same({c: f"e_{c}" for c in key}), "left")
    empty = F.sha2(F.lit(""), 256)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "bytes", F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def ends_digest(last: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of the ids of each node, ascending, joined by commas.

    The ids are sorted over all tasks and joined to pieces of at most ``PIECE`` characters; one
    task reads the pieces of a node in order, one after the other, as the hash asks for.
    """
    order = [*key, "conv_id"]
    pieces = last.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = ", ".join(f"{c} long" for c in key)
    n = len(key)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def piece() -> pa.RecordBatch:
            values = [pa.array([v], pa.int64()) for v in (*node, ids[0])]
            return pa.RecordBatch.from_arrays([*values, pa.array([",".join(map(str, ids))])], [*order, "ids"])

        for batch in batches:
            for *at, c in zip(*(batch.column(i).to_pylist() for i in range(n + 1)), strict=True):
                if ids and (at != node or size > PIECE):
                    yield piece()
                    ids, size = [], 0
                node = at
                ids.append(c)
                size += len(str(c)) + 1
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []
        for batch in batches:
            for *at, _, ids in zip(*(batch.column(i).to_pylist() for i in range(n + 2)), strict=True):
                if at == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield _rows(done)
                done = []
        if node is not None:
            yield _rows([(*node, sha.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:n]), pa.array(columns[n])], [*key, "ends_sha256"])

    packed = pieces.mapInArrow(pack, f"{kinds}, conv_id long, ids string").repartition(*key).sortWithinPartitions(*order)
    return packed.mapInArrow(digest, f"{kinds}, ends_sha256 string")


# ---- tree contraction ---------------------------------------------------------------

def subtree_totals(nodes: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(conv_id, depth) of each node, and the sums of ``values`` over its subtree, itself included.

    ``nodes`` has conv_id, depth, parent_conv_id (null at a root) and n_children; a parent is the
    node (parent_conv_id, depth - 1). Values are longs. Several trees may lie in one table.
    """
    names = list(values)
    zero = F.lit(0).cast("long")
    live = nodes.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), (F.col("depth") - 1).alias("pd"), F.col("n_children").alias("k"),
        *(v.cast("long").alias(f"own_{n}") for n, v in values.items()), *(zero.alias(f"edge_{n}") for n in names),
        zero.alias("vc"), zero.alias("vd"), *(zero.alias(f"cut_{n}") for n in names),
    )
    live = staged(live, "contract")
    bits = max(1, (live.agg(F.max("d")).first()[0] or 0).bit_length())
    rounds = [live]
    while rounds[-1].where("k > 0").limit(1).count():
        rounds.append(staged(_contracted(rounds[-1], names, (len(rounds) - 1) % bits), "contract"))

    totals = None
    while rounds:
        at = rounds.pop()
        mine = at.where("k = 0").select("c", "d", *(F.col(f"own_{n}").alias(n) for n in names))
        if totals is None:
            totals = staged(mine, "totals")
        else:
            # Nodes taken out when the next round was made hang on the child they had then.
            cut = later.where("vd IS NOT NULL").select("vc", "vd", "c", "d", *(f"cut_{n}" for n in names)).join(totals, ["c", "d"])
            cut = cut.select(F.col("vc").alias("c"), F.col("vd").alias("d"), *((F.col(n) + F.col(f"cut_{n}")).alias(n) for n in names))
            last, totals = totals, staged(mine.unionByName(totals).unionByName(cut), "totals")
            discard(last)
            discard(later)
        later = at
    discard(later)
    return totals.withColumnsRenamed({"c": "conv_id", "d": "depth"})


def _contracted(live: DataFrame, names: list[str], bit: int) -> DataFrame:
    """One round: rake, then compress. A row whose parent was taken out names it in vc, vd, with the value between."""
    raked = live.where("k = 0").groupBy(F.col("pc").alias("gc"), F.col("pd").alias("gd")).agg(
        F.count("*").alias("gone"), *(F.sum(F.col(f"own_{n}") + F.col(f"edge_{n}")).alias(f"add_{n}") for n in names)
    )
    zero = F.lit(0).cast("long")
    inner = live.where("k > 0").join(raked, (F.col("c") == F.col("gc")) & (F.col("d") == F.col("gd")), "left")
    inner = inner.select(
        "c", "d", "pc", "pd", (F.col("k") - F.coalesce("gone", zero)).alias("k"),
        *((F.col(f"own_{n}") + F.coalesce(f"add_{n}", zero)).alias(f"own_{n}") for n in names), *(f"edge_{n}" for n in names),
    )
    set_in = lambda depth: F.shiftright(F.col(depth), bit).bitwiseAND(F.lit(1)) == 1
    out = (F.col("k") == 1) & F.col("pc").isNotNull() & set_in("d") & ~set_in("pd")
    inner = inner.withColumn("out", F.coalesce(out, F.lit(False)))
    taken = inner.where("out").select(
        F.col("c").alias("vc"), F.col("d").alias("vd"), F.col("pc").alias("npc"), F.col("pd").alias("npd"),
        *(F.col(f"own_{n}").alias(f"v_own_{n}") for n in names), *(F.col(f"edge_{n}").alias(f"v_edge_{n}") for n in names),
    )
    left = inner.where("NOT out").drop("out").join(taken, (F.col("pc") == F.col("vc")) & (F.col("pd") == F.col("vd")), "left")
    gone = F.col("vd").isNotNull()
    return left.select(
        "c", "d", F.when(gone, F.col("npc")).otherwise(F.col("pc")).alias("pc"), F.when(gone, F.col("npd")).otherwise(F.col("pd")).alias("pd"), "k",
        *(f"own_{n}" for n in names),
        *((F.col(f"edge_{n}") + F.when(gone, F.col(f"v_own_{n}") + F.col(f"v_edge_{n}")).otherwise(zero)).alias(f"edge_{n}") for n in names),
        "vc", "vd",
        *(F.when(gone, F.col(f"edge_{n}") + F.col(f"v_own_{n}")).alias(f"cut_{n}") for n in names),
    )


def prefix_trie(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = True) -> DataFrame:
    """One row a node of the trie of (rebuilt) conversations.

    conv_id: the smallest conversation that begins with the node's turns; depth; parent_conv_id (null at the
    root); n_convs, conversations that begin with it; n_children; n_leaves, nodes without a child in its subtree, itself
    included; saved_tokens, bytes that storing each node's last text once saves, summed over its subtree; ends_sha256, of
    the ids that end here. With ``rebuild`` conversations begin like the first one of their family.

    See ``turns`` for nulls, ties and repeated rows (a repeated row is a turn of its own); other columns are not
    read. A conversation that is rebuilt without turns is a member of the root. An empty table has no nodes.
    """
    numbered = turns(convs, conv_id, turn, role, text)
    if rebuild:
        lengths, said = rebuilt(numbered)
    else:
        lengths = numbered.groupBy("conv_id").agg(F.count("*").alias("length"))
        said = numbered.select("conv_id", F.col("place").alias("depth"), "h1", "h2", "bytes")
    nodes = staged(trie(lengths, prefixes(said)), "trie")
    values = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}
    totals = subtree_totals(nodes, values)
    return nodes.drop("bytes").join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
