"""Prefix trie of conversations, built as burst tries (operator 13).

A turn is identified by a digest of its role and text; texts do not move after that. Turns are
placed by distributed numbering (a conversation may be spread over many tasks), and a
conversation becomes rows of at most ``SEGMENT`` turns that hold the digest of every prefix, so a
node of the trie is a digest. Equal segments under one prefix become one class with a count.

Per stratum (segments of one number; nearly always there is one only, the deepest goes first):

1. A container is the set of suffixes under a trie head. Oversized containers burst by the next
   turn, round by round, over blocks of 1, 2, 4, ... turns, so the number of rounds is logarithmic
   in the depth that many conversations share.
2. The remaining containers are dealt to tasks, sorted by suffix and swept: a stack of open nodes
   closes bottom-up into finished nodes of the subtree. A sweep streams; it holds one container's
   open path and the closed children whose parent is still open.
3. Heads (nodes whose container burst) get their counts from their classes, and the sums over
   their subtrees from the containers and heads below them, as partial aggregates.

The digest of a node's ending conversations is made from chunks of sorted ids that are dealt by
range and then streamed through SHA-256 in order (a hash of one text can't be split further).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm._store import salted_join, stored
from tabforge.operators.indexing import global_index

#: Turns of one conversation in a row.
SEGMENT = 4096
CONTAINER_ROWS = 512
CONTAINER_TURNS = 1 << 15
#: Ids in one chunk of the text that a node's ends are hashed from.
CHUNK_IDS = 1024
ROOT = bytes(16)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_CLASS = "w long, key binary, head binary, path binary, m int, sizes array<long>, conv_id long"
_NODE = ("key binary, depth int, parent_conv_id long, conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, above binary")
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size) of every rebuilt conversation, ``id`` a 16-byte digest of the turn
    and ``size`` the UTF-8 bytes of its text; a last row with a null id ends each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(body, 256), 1, 32)).alias("id"), F.octet_length(text).cast("long").alias("size"), F.rand(5).alias("tie"))
    own = global_index(turns, ["turn", "id", "tie"], "pos", group="conv_id").drop("turn", "tie")
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    convs = own.where("pos = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), h.alias("h"))
    heads = own.where("conv_id % 5 = 0 and pos < 8").select(F.col("conv_id").alias("base"), "pos", "id", "size")
    first = convs.join(heads, "base").where("pos < h").select("conv_id", F.lit(0).alias("part"), "pos", "id", "size")
    rest = own.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "id", "size")
    end = convs.select("conv_id", F.lit(2).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"),
                       F.lit(0).cast("long").alias("size"))
    parts = first.unionByName(rest).unionByName(end).withColumnRenamed("pos", "at")
    return global_index(parts, ["part", "at"], "pos", group="conv_id").select("conv_id", "pos", "id", "size")


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def _next_heads(full: DataFrame) -> DataFrame:
    """(conv_id, w, head) for the segments after the full ones: the digest of all turns before."""
    def one(batches):
        for batch in batches:
            sums = [_digest(*ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("w"), pa.array(sums, pa.binary())], names=["conv_id", "w", "sum"])

    def chain(batches):
        for batch in batches:                               # one digest per SEGMENT turns
            for c, sums in zip(batch.column("conv_id").to_pylist(), batch.column("sums").to_pylist()):
                out, head = [], ROOT
                for s in sums:
                    head = _digest(head, s["sum"])
                    out.append(head)
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(out)), pa.array(range(1, len(out) + 1), pa.int64()), pa.array(out, pa.binary())],
                                                 names=["conv_id", "w", "head"])

    sums = full.mapInArrow(one, "conv_id long, w long, sum binary").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("w", "sum"))).alias("sums"))
    return sums.mapInArrow(chain, "conv_id long, w long, head binary")


def segments(turns: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and segment: w (segment number), head (digest of all turns before
    it), path (digests of its prefixes, 16 bytes each), m (turns), sizes, key (its last node). A
    conversation ends in its segment of fewer than ``segment`` turns."""
    seg = turns.groupBy("conv_id", F.floor(F.col("pos") / segment).cast("long").alias("w")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("t"))
    t = F.filter("t", lambda x: x["id"].isNotNull())
    seg = stored(seg.select("conv_id", "w", F.transform(t, lambda x: x["id"]).alias("ids"), F.transform(t, lambda x: x["size"]).alias("sizes")), "segments")
    later = seg.where("w > 0").join(_next_heads(seg.where(F.size("ids") == segment).select("conv_id", "w", "ids")), ["conv_id", "w"])
    seg = seg.where("w = 0").withColumn("head", F.lit(ROOT)).unionByName(later)

    def run(batches):
        for batch in batches:
            paths, keys = [], []
            for head, ids in zip(batch.column("head").to_pylist(), batch.column("ids").to_pylist()):
                out, p = [], head
                for x in ids:
                    p = hashlib.blake2b(p + x, digest_size=16).digest()
                    out.append(p)
                if len(ids) == segment:                     # the node is the next segment's head
                    out[-1] = p = _digest(head, _digest(*ids))
                paths.append(b"".join(out))
                keys.append(p)
            cols = {"key": pa.array(keys, pa.binary()), "path": pa.array(paths, pa.binary()), "m": pa.array([len(p) // 16 for p in paths], pa.int32())}
            yield pa.RecordBatch.from_arrays([cols[n] if n in cols else batch.column(n) for n in ("w", "key", "head", "path", "m", "sizes", "conv_id")],
                                             names=["w", "key", "head", "path", "m", "sizes", "conv_id"])

    return seg.mapInArrow(run, _CLASS)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id): the hash of the ids ascending, joined by commas."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def pieces(batches):
        key, ids = None, []

        def text():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                                              names=["key", "first", "text"])
        for batch in batches:
            done: list[pa.RecordBatch] = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key or len(ids) == CHUNK_IDS:
                    if ids:
                        done.append(text())
                    key, ids = k, []
                ids.append(c)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if ids:
            yield text()

    def hashes(batches):
        key, sha = None, None
        for batch in batches:
            keys, out = [], []
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if k != key:
                    if sha:
                        keys.append(key)
                        out.append(sha.hexdigest())
                    key, sha = k, hashlib.sha256(t.encode())
                else:
                    sha.update(b"," + t.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], names=["key", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    chunks = ends.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, text string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashes, "key binary, ends_sha256 string")


def _node(j) -> Column:
    """Digest of the node at depth ``j`` of a class's path (0: the head)."""
    j = j if isinstance(j, Column) else F.lit(j)
    return F.when(j == 0, F.col("head")).otherwise(F.substring(F.col("path"), (j - 1) * 16 + 1, F.lit(16)))


def burst(classes: DataFrame, rows: int, turns: int) -> DataFrame:
    """``classes`` with ``e``: the depth of the container that holds the class (m + 1 if it ends at
    a burst head). Containers of more than ``rows`` classes, or of several with more than ``turns``
    turns to go, burst by their next turn."""
    done, live, a, step = [], classes, 0, 1
    while True:
        depth = F.explode(F.sequence(F.lit(a), F.least(F.col("m"), F.lit(a + step - 1))))
        at = live.select("key", "head", "path", "m", depth.alias("j")).select("key", "j", _node(F.col("j")).alias("node"), (F.col("m") - F.col("j")).alias("left"))
        size = at.groupBy("node").agg(F.count("*").alias("held"), F.sum("left").alias("turns"))
        big = stored(size.where((F.col("held") > rows) | ((F.col("held") > 1) & (F.col("turns") > turns))).select("node"), "burst")
        if big.isEmpty():
            done.append(live.withColumn("e", F.lit(a)))
            break
        last = salted_join(at, big, "node", "key", "left_semi").groupBy("key").agg((F.max("j") + 1).alias("e"))
        found = stored(live.join(last, "key", "left").withColumn("e", F.coalesce("e", F.lit(a))), "containers")
        on = (F.col("e") == a + step) & (F.col("m") >= a + step)
        done.append(found.where(~on))
        live = found.where(on).drop("e")
        a, step = a + step, 2 * step
        if live.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


class _Out:
    """Finished nodes of a sweep, given out in batches."""

    names = [c.split()[0] for c in _NODE.split(", ")]
    types = pa.schema([("key", pa.binary()), ("depth", pa.int32()), *((n, pa.int64()) for n in names[2:8]), ("ends_sha256", pa.string()), ("above", pa.binary())])

    def __init__(self):
        self.rows: list[tuple] = []

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) if self.rows else [[] for _ in self.names]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, self.types.types)], schema=self.types)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes sorted by container and path -> nodes. The top node of a container has no parent
    yet; ``above`` holds the digests of the heads over it."""
    out = _Out()
    # open nodes from the container's top down: [key, size, n, smallest, children, leaves, saved, ends, finished children]
    stack: list[list] = []
    top, box, above, path = 0, None, b"", b""

    def close() -> None:
        key, size, n, conv, children, leaves, saved, ends, kids = stack.pop()
        depth = top + len(stack)
        saved += (n - 1) * size
        leaves = leaves if children else 1
        for k in kids:
            out.rows.append((k[0], depth + 1, conv, *k[1:], None))
        if not stack:
            out.rows.append((key, depth, None, conv, n, children, leaves, saved, ends, above))
            return
        up = stack[-1]
        up[2] += n
        up[3] = conv if up[3] is None else min(up[3], conv)
        up[4] += 1
        up[5] += leaves
        up[6] += saved
        up[8].append((key, conv, n, children, leaves, saved, ends))

    def column(batch, name):
        return batch.column(name).to_pylist()

    for batch in batches:
        rows = zip(*(column(batch, c) for c in ("box", "head", "path", "m", "e", "sizes", "n", "conv_id", "ends_sha256", "x_children", "x_leaves", "x_saved")))
        for b, head, p, m, e, sizes, n, conv, ends, xc, xl, xs in rows:
            if b != box:
                while stack:
                    close()
                top, box, above = e, b, (head + p[:16 * (e - 1)] if e else b"")
                stack.append([b, sizes[e - 1] if e else 0, 0, None, 0, 0, 0, None, []])
            else:                                           # equal digests: equal prefixes, so bisect
                lo, hi = e, min(m, len(path) // 16)
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    if p[16 * mid - 16:16 * mid] == path[16 * mid - 16:16 * mid]:
                        lo = mid
                    else:
                        hi = mid - 1
                while len(stack) > lo - e + 1:
                    close()
            for j in range(e + len(stack), m + 1):
                stack.append([p[16 * j - 16:16 * j], sizes[j - 1], 0, None, 0, 0, 0, None, []])
            end = stack[-1]
            end[2] += n
            end[3] = conv if end[3] is None else min(end[3], conv)
            end[4:8] = [end[4] + xc, end[5] + xl, end[6] + xs, ends]
            path = p
            if len(out.rows) >= 20_000:
                yield out.batch()
    while stack:
        close()
    if out.rows:
        yield out.batch()


def _stratum(classes: DataFrame, rows: int, turns: int) -> DataFrame:
    """All nodes under the heads of one stratum, depth 0 (the heads) included."""
    held = stored(burst(classes, rows, turns), "held")
    boxes = held.where("e <= m").withColumn("box", _node(F.col("e")))
    swept = boxes.repartition("box").sortWithinPartitions("box", "path").mapInArrow(sweep, _NODE)
    if held.where("e > 0").isEmpty():
        return swept
    swept = stored(swept, "swept")
    inner = held.withColumn("j", F.explode(F.when(F.col("e") > 0, F.sequence(F.lit(0), F.least(F.col("e") - 1, F.col("m"))))))
    j = F.col("j")
    heads = stored(inner.groupBy(_node(j).alias("key")).agg(
        F.min("j").alias("depth"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.max(F.when(j > 0, F.element_at("sizes", F.greatest(j, F.lit(1))))).alias("size"),
        F.max(F.when(j == F.col("m"), F.col("ends_sha256"))).alias("ends_sha256"),
        F.max(F.when(j > 0, F.concat(F.col("head"), F.substring(F.col("path"), F.lit(1), (j - 1) * 16)))).alias("above")), "heads")
    # what a subtree adds to every head over it
    own = (F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))
    tops = swept.where(F.length("above") > 0)
    adds = (tops.select("above", F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves"))
            .unionByName(heads.where("depth > 0").select("above", own.alias("saved"), F.lit(0).cast("long").alias("leaves"))))
    adds = adds.withColumn("i", F.explode(F.sequence(F.lit(1), (F.length("above") / 16).cast("int"))))
    adds = adds.select(F.substring(F.col("above"), (F.col("i") - 1) * 16 + 1, F.lit(16)).alias("key"), "saved", "leaves",
                       (F.col("i") * 16 == F.length("above")).cast("long").alias("child"))
    sums = adds.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves"), F.sum("child").alias("n_children"))
    heads = stored(heads.join(sums, "key").select("key", "depth", "conv_id", "n_convs", "n_children", "n_leaves",
                                                  (F.col("saved") + own).alias("saved_tokens"), "ends_sha256", "above"), "heads")
    parents = heads.select(F.col("key").alias("over"), F.col("conv_id").alias("parent_conv_id"))
    loose = tops.drop("parent_conv_id").unionByName(heads)
    loose = loose.withColumn("over", F.substring(F.col("above"), F.length("above") - 15, F.lit(16)))
    names = [c.split()[0] for c in _NODE.split(", ")]
    return swept.where("above is null or length(above) = 0").unionByName(salted_join(loose, parents, "over", "key", "left").select(*names))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, container_rows: int = CONTAINER_ROWS,
                container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node of the trie over the rebuilt ``conversations`` (conv_id, turn, role, text):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 and ``key`` (the node's digest). Every result is the same for any ``segment``,
    ``container_rows`` and ``container_turns`` (which is raised to ``segment``); the driver takes
    one round per ``segment`` turns of the longest conversation.

    Defined cases: rows with a null conv_id take no part; a null turn comes first, and turns of
    equal number stand in the order of their digest, each as often as it occurs; null role or text
    is empty; ``c % 5`` has the sign of c; an empty table gives no rows; other columns are
    ignored."""
    seg = stored(segments(rebuilt_turns(conversations), segment), "paths")
    last = seg.agg(F.max("w")).first()[0]
    if last is None:
        return seg.sparkSession.createDataFrame([], ", ".join(f"{n} {'string' if n == 'ends_sha256' else 'long'}" for n in OUT) + ", key binary")
    ends = end_hashes(seg.where(F.col("m") < segment).select("key", "conv_id"))
    classes = seg.groupBy("w", "key").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("head").alias("head"), F.any_value("path").alias("path"),
        F.any_value("m").alias("m"), F.any_value("sizes").alias("sizes"))
    open_ = F.when(F.col("m") < segment, F.col("ends_sha256"))
    classes = stored(classes.join(ends, "key", "left").withColumn("ends_sha256", open_), "classes")
    below, parts = None, []
    for w in range(last, -1, -1):
        some = classes.where(F.col("w") == w).drop("w")
        zero = F.lit(0).cast("long")
        if below is None:
            some = some.select("*", zero.alias("x_children"), zero.alias("x_leaves"), zero.alias("x_saved"))
        else:                                               # full segments go on in the stratum below
            some = some.join(below, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "x_ends")).drop("x_ends")
            some = some.na.fill(0, ["x_children", "x_leaves", "x_saved"])
        nodes = stored(_stratum(some, container_rows, max(container_turns, segment)), "nodes")
        if w:
            below = nodes.where("depth = 0").select(
                "key", F.col("n_children").alias("x_children"), F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(0).alias("x_leaves"),
                F.col("saved_tokens").alias("x_saved"), F.col("ends_sha256").alias("x_ends"))
            nodes = nodes.where("depth > 0")
        parts.append(nodes.withColumn("depth", F.col("depth").cast("long") + w * segment))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA))).select(*OUT, "key")
