"""Prefix trie of conversations by fixed-length block hashing.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that begin with it.  A turn's hash depends on its place, and a
sequence's digest is the XOR of its turns' hashes (two 64-bit lanes), so digests
of prefixes are running XORs and long conversations can be cut anywhere.

1. Turns are numbered by range partitions and their counts; texts stay behind, a
   turn goes on as hash and bytes.  ``rebuilt`` puts the first turns of the leading
   conversation before the rest of each.
2. Turns are gathered into blocks of ``BLOCK`` turns.  Conversations are grouped by
   successive block digests: one row per distinct block after a distinct prefix.
3. Only where two blocks follow one prefix (siblings diverge) are turn boundaries
   refined, on these distinct blocks; other blocks' turns have the block's members.
4. Sums over subtrees need no descent.  A node's smallest member owns it, and a
   conversation owns a suffix of its path.  With S(c) the bytes of c's path before
   its first owned node (all of it if there is none) and P(v) the bytes above v:

       saved(v)  = sum of S(c) over members c but the smallest - (members - 1) P(v)
       leaves(v) = members c that own the childless node they end in

   so both are sums over members, made like the member counts: by block, then
   refined.

No group is collected: a first turn or a whole conversation that a third of all
share is counted by partial aggregates; a very long conversation is cut into
runs of ``RUN`` blocks with carried prefixes.  The hash of a node's ending ids is
sequential by definition: range partitions join the sorted ids to chunks, and a
task streams a node's chunks (no more than one is held).

Defined results: null role or text is empty; turns with equal place follow by role
and text; a repeated row is a further turn; rows of null ids belong to no
conversation; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

BLOCK, RUN = 4, 1024
LEAD, HEADS = 5, 9
CHUNK_BYTES = 1 << 18


def head_size(conv: Column) -> Column:
    """Turns that a conversation takes over."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def leading(conv: Column) -> Column:
    return conv - conv % LEAD


def numbered_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``conv, at`` (from 1)``, h1, h2, bytes`` of every turn, stored."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
                        text.alias("text")).where("conv is not null")
    content = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(sorted_.select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
        F.xxhash64(content).alias("h1"), F.xxhash64(F.lit(1), content).alias("h2"),
        F.octet_length("text").cast("long").alias("bytes")), "turns")
    runs = rows.groupBy("conv", "part").agg(F.count("*").alias("size"), F.min("place").alias("first"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    at = F.col("place") - F.col("first") + F.col("before") + 1
    return stored(rows.join(runs, ["conv", "part"]).select("conv", at.alias("at"), "h1", "h2", "bytes"), "numbered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations ``conv``, turns ``conv, at, h1, h2, bytes`` of all rebuilt ones)."""
    convs = turns.groupBy("conv").agg(F.max("at").alias("own"))
    heads = turns.where((F.col("conv") % LEAD == 0) & (F.col("at") < HEADS)).groupBy(
        F.col("conv").alias("lead")).agg(F.collect_list(F.struct("at", "h1", "h2", "bytes")).alias("head"))
    h, taken = head_size(F.col("conv")), F.filter("head", lambda t: t["at"] <= F.col("h"))
    plans = convs.select("conv", "own", leading(F.col("conv")).alias("lead"), h.alias("h")).join(
        heads, "lead", "left").select("conv", "own", "h", F.coalesce(taken, F.array()).alias("head"))
    plans = stored(plans, "plans")
    first = plans.select("conv", F.explode("head").alias("t")).select("conv", "t.*")
    rest = turns.join(plans.select("conv", "h", F.size("head").alias("k")), "conv").where(F.col("at") > F.col("h"))
    rest = rest.select("conv", (F.col("at") - F.col("h") + F.col("k")).alias("at"), "h1", "h2", "bytes")
    return plans.select("conv"), first.union(rest)


def _carried(df: DataFrame, value: dict[str, Column], keys: list[str], order: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({k: F.coalesce(v.over(before), F.lit(0)) for k, v in value.items()})


def blocks_of(turns: DataFrame) -> DataFrame:
    """``conv, block, s1, s2`` (digest before it)``, e1, e2`` (after it)``, size, above``
    (bytes before it)``, bytes, turns`` of every block."""
    at = F.col("at")
    seeded = turns.select("conv", F.floor((at - 1) / BLOCK).alias("block"), F.struct(
        "at", F.xxhash64(F.lit(7), at, "h1", "h2").alias("z1"), F.xxhash64(F.lit(11), "h2", "h1", at).alias("z2"),
        "bytes").alias("t"))
    blocks = seeded.groupBy("conv", "block").agg(
        F.bit_xor("t.z1").alias("z1"), F.bit_xor("t.z2").alias("z2"), F.sum("t.bytes").alias("bytes"),
        F.count("*").alias("size"), F.array_sort(F.collect_list("t")).alias("turns"))
    blocks = blocks.withColumn("run", F.floor(F.col("block") / RUN))
    inner = {"s1": F.bit_xor("z1"), "s2": F.bit_xor("z2"), "above": F.sum("bytes")}
    within = _carried(blocks, inner, ["conv", "run"], "block")
    runs = blocks.groupBy("conv", "run").agg(
        F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("bytes").alias("bytes"))
    runs = _carried(runs, {"c1": F.bit_xor("z1"), "c2": F.bit_xor("z2"), "more": F.sum("bytes")}, ["conv"], "run")
    runs = runs.where("run > 0").select("conv", "run", "c1", "c2", "more")
    both = within.join(runs, ["conv", "run"], "left").fillna(0, ["c1", "c2", "more"])
    s1, s2 = F.col("s1").bitwiseXOR(F.col("c1")), F.col("s2").bitwiseXOR(F.col("c2"))
    return both.select("conv", "block", s1.alias("s1"), s2.alias("s2"), s1.bitwiseXOR(F.col("z1")).alias("e1"),
                       s2.bitwiseXOR(F.col("z2")).alias("e2"), "size", (F.col("above") + F.col("more")).alias("above"),
                       "bytes", "turns")


def refined(groups: DataFrame, sums: list[str], least: str | None = None) -> DataFrame:
    """Nodes ``depth, x1, x2`` from distinct blocks: block rows become turn rows, and
    where ``forked`` those of equal digest are added up (``sums``; the least of ``least``).
    ``p1, p2`` is the parent, ``last`` the bytes of the last turn, ``over`` those before it."""
    start = F.struct(F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("s1").alias("x1"), F.col("s2").alias("x2"),
                     F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("last"),
                     F.col("above").alias("over"))

    def step(path, t):
        last = F.element_at(path, -1)
        node = F.struct(last["x1"].alias("p1"), last["x2"].alias("p2"), last["x1"].bitwiseXOR(t["z1"]).alias("x1"),
                        last["x2"].bitwiseXOR(t["z2"]).alias("x2"), t["at"].alias("depth"), t["bytes"].alias("last"),
                        (last["over"] + last["last"]).alias("over"))
        return F.concat(path, F.array(node))

    path = F.aggregate("turns", F.array(start), step)
    kept = sums + ([least] if least else [])
    turns = groups.select("forked", *kept, F.explode(F.slice(path, F.lit(2), F.size("turns"))).alias("v")).select(
        "forked", *kept, "v.*")
    node = ["depth", "x1", "x2", "p1", "p2", "last", "over"]
    added = turns.where("forked").groupBy("depth", "x1", "x2").agg(
        *(F.first(c).alias(c) for c in node[3:]), *(F.sum(c).alias(c) for c in sums),
        *([F.min(least).alias(least)] if least else []))
    return turns.where("not forked").select(*node, *kept).union(added.select(*node, *kept))


def ends_hash(ends: DataFrame) -> DataFrame:
    """``x1, x2, depth, ends_sha256`` of the ids ``conv`` ending at each node."""
    order = ["x1", "x2", "depth", "conv"]
    limit = CHUNK_BYTES

    def chunks(batches):
        # runs of one node in a sorted partition, at most about ``limit`` bytes each
        key, ids, size = None, [], 0
        for b in batches:
            for *k, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != key or size > limit:
                    if ids:
                        yield row(key, ids)
                    key, ids, size = k, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield row(key, ids)

    def row(key, ids):
        return key, int(ids[0]), ",".join(ids)

    def gathered(batches):
        rows, size = [], 0
        for r in chunks(batches):
            rows.append(r)
            size += len(r[2])
            if size > limit:
                yield frame(rows)
                rows, size = [], 0
        if rows:
            yield frame(rows)

    def frame(rows):
        return pa.RecordBatch.from_pydict({
            "x1": [r[0][0] for r in rows], "x2": [r[0][1] for r in rows],
            "depth": pa.array([r[0][2] for r in rows], pa.int64()), "first": [r[1] for r in rows],
            "ids": [r[2] for r in rows]})

    def hashed(batches):
        key, h, done = None, None, []
        for b in batches:
            for *k, ids in zip(*(b.column(n).to_pylist() for n in ("x1", "x2", "depth", "ids"))):
                if k != key:
                    if h is not None:
                        done.append((*key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield out(done)
            done = []
        if h is not None:
            yield out([(*key, h.hexdigest())])

    def out(done):
        names = ["x1", "x2", "depth", "ends_sha256"]
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names)

    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        gathered, "x1 long, x2 long, depth long, first long, ids string")
    return parts.repartition("x1", "x2", "depth").sortWithinPartitions("x1", "x2", "depth", "first").mapInArrow(
        hashed, "x1 long, x2 long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Nodes of the trie of all rebuilt conversations: ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    prepare(conversations.sparkSession)
    key = ["depth", "x1", "x2"]
    convs, turns = rebuilt(numbered_turns(conversations, id_col, turn_col, role_col, text_col))
    blocks = stored(blocks_of(turns), "blocks")

    place = ["block", "s1", "s2", "e1", "e2", "size"]
    groups = blocks.groupBy(*place).agg(F.count("*").alias("n"), F.min("conv").alias("least"),
                                        F.first("turns").alias("turns"), F.first("above").alias("above"))
    groups = stored(groups, "groups")
    forks = groups.groupBy("block", "s1", "s2").agg(F.count("*").alias("ways")).where("ways > 1").drop("ways")
    groups = groups.join(forks.withColumn("fork", F.lit(True)), ["block", "s1", "s2"], "left").withColumn(
        "forked", F.coalesce("fork", F.lit(False))).drop("fork")
    zero = F.lit(0).cast("long")
    # ends: the whole of each conversation (turnless ones end at the root)
    ends = blocks.groupBy("conv").agg(F.bit_xor(F.col("s1").bitwiseXOR(F.col("e1"))).alias("x1"),
                                      F.bit_xor(F.col("s2").bitwiseXOR(F.col("e2"))).alias("x2"),
                                      F.sum("size").alias("depth"), F.sum("bytes").alias("total"))
    ends = stored(convs.join(ends, "conv", "left").fillna(0), "ends")
    root = ends.agg(F.count("*").alias("n"), F.min("conv").alias("least")).where("n > 0").select(
        *(zero.alias(c) for c in ("depth", "x1", "x2")), F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), zero.alias("last"), zero.alias("over"), "n", "least")
    nodes = root.union(refined(groups, ["n"], "least").select(*root.columns))
    up = nodes.select(*key, "least").toDF("pd", "q1", "q2", "parent")
    nodes = nodes.join(up, (F.col("depth") - 1 == F.col("pd")) & (F.col("p1") == F.col("q1")) &
                       (F.col("p2") == F.col("q2")), "left").drop("pd", "q1", "q2")
    hashes = ends_hash(ends)
    counts = ends.groupBy(*key).agg(F.count("*").alias("n_ends"))
    nodes = nodes.join(counts.join(hashes, key), key, "left")
    nodes = stored(nodes.withColumn("n_ends", F.coalesce("n_ends", F.lit(0))), "nodes")

    # S(c) and whether c owns the childless node it ends in
    owned = nodes.where(F.col("parent").isNull() | (F.col("parent") != F.col("least"))).select(
        F.col("least").alias("conv"), F.col("over").alias("before"))
    tips = nodes.where("n_ends = n").select(F.col("least").alias("conv"), F.lit(1).cast("long").alias("tip"))
    sums = ends.join(owned, "conv", "left").join(tips, "conv", "left").select(
        "conv", F.coalesce("before", "total").alias("s"), F.coalesce("tip", F.lit(0)).alias("tip"))
    sums = stored(sums, "sums")
    by_block = blocks.select("conv", *place).join(sums, "conv").groupBy(*place).agg(
        F.sum("s").alias("s"), F.sum("tip").alias("tip"))
    totals = refined(groups.join(by_block, place), ["s", "tip"]).select(*key, "s", "tip")
    totals = totals.union(sums.agg(F.sum("s").alias("s"), F.sum("tip").alias("tip")).select(
        *(zero.alias(c) for c in key), "s", "tip"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"),
                                                F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    smallest = sums.select(F.col("conv").alias("least"), F.col("s").alias("own"))
    # of the smallest member: its S if that lies at or above the node (it owns the node), so S(c) of it is taken off
    out = nodes.join(totals, key).join(children, key, "left").join(smallest, "least")
    saved = F.col("s") - F.col("own") - (F.col("n") - 1) * F.col("over")
    return out.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("tip").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
