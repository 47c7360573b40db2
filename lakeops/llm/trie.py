"""Prefix trie of conversations by vertical bitmaps (operator 12).

A node is a distinct sequence of first turns (role, text). Conversations get places in the order of their
ids and are cut into shards of ``Rule.shard`` ids. For each shard, and each block of ``Rule.block`` positions, one
task indexes every (position, turn) as a bitmap of the shard's conversations and walks depth first: a node's
children are the intersections of its bitmap with the postings of the next position. That yields the shard's
part of each node: how many conversations are in it (popcount), which end there, and the smallest. A
bitmap of one is followed as a chain. Blocks after the first begin with the prefixes known from sums over
earlier blocks, so a conversation that holds most turns is spread over many tasks as well.

Parts of a node meet by the 128-bit XOR of its (position, turn) hashes and are added up. Sums over subtrees
need no descent: the nodes for which a conversation is the smallest member are the last ones of its chain,
so each conversation c has a weight U(c), the characters of those nodes, and a leaf or none. A node's
subtree then holds as many leaves as its members have, and with S(c) the characters of member c from the
node on, its saved tokens are the sum of S(c) - U(c) over all members but the smallest. A second pass adds these
weights by the same bitmaps, for nodes with two members or more.

Hot spots: a parent with very many children is looked up through a broadcast of the at most 4,096 parents
that have more than 1/4,096 of all nodes each; end lists of a node are hashed as a stream, shard after shard.
SHA-256 of one list is sequential by nature; the memory it takes is one Arrow batch.

Edge cases: rows without ``conv_id`` belong to no conversation and are left out. A null role or text is empty.
Turns are ordered by ``turn``, null first; equal ones by a hash of role and text. Repeated rows are turns
of their own. No conversations: no rows, not even a root. Other columns are unused, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import HOT_ROWS, lookup_join
from .ranks import group_offsets, sorted_parts
from .store import stored


@dataclass(frozen=True)
class Rule:
    shard: int = 1024  # conversations of one bitmap
    block: int = 128  # positions of one task


def numbered(conversations: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, shard, rank, a, b, chars) and conversations (conv_id, size, shard), both stored: ``rank``
    counts a conversation's turns from 0, (a, b) is the hash of role and text. Texts are read once."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), role, text).alias("b"),
        F.length(text).cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = sorted_parts(stored(rows, "turns"), ["conv_id", "turn", "a", "b", "row"], "sorted-turns")
    offsets = stored(group_offsets(parts, "conv_id"), "offsets")
    ids = sorted_parts(offsets.where("before = 0").select("conv_id", "size"), ["conv_id"], "conversations")
    shard = F.shiftleft("p", 32) + F.floor(F.col("i") / rule.shard)
    convs = stored(ids.select("conv_id", "size", shard.alias("shard")), "shards")
    at = offsets.select("conv_id", "p", "first", "before").join(convs.select("conv_id", "shard"), "conv_id")
    turns = parts.join(at, ["conv_id", "p"]).select("conv_id", "shard", (F.col("before") + F.col("i") - F.col("first")).alias("rank"), "a", "b", "chars")
    return stored(turns, "numbered-turns"), convs


def spliced(turns: DataFrame, convs: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Turns of conversations rebuilt: the first h turns of conversation c - c % group, then the own ones after the
    first h, where h = crc32(c) % heads. Rows (conv_id, shard, pos, a, b, chars)."""
    base = F.col("conv_id") - F.col("conv_id") % group
    split = convs.withColumns({"base": base, "h": F.crc32(F.col("conv_id").cast("string")) % heads})
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    split = split.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0))))
    split = stored(split.select("conv_id", "shard", "base", "h", "taken"), "splits")
    first = turns.where((F.col("conv_id") % group == 0) & (F.col("rank") < heads - 1))
    first = first.select(F.col("conv_id").alias("base"), "rank", "a", "b", "chars")  # few rows a group
    head = first.join(split, "base").where("rank < h").select("conv_id", "shard", F.col("rank").alias("pos"), "a", "b", "chars")
    cut = lookup_join(turns, split.select("conv_id", "h", "taken"), ["conv_id"], hot="measure", salt=["a", "rank"])
    tail = cut.where("rank >= h").select("conv_id", "shard", (F.col("taken") + F.col("rank") - F.col("h")).alias("pos"), "a", "b", "chars")
    return head.unionByName(tail)


_PART = (
    "shard bigint, blk bigint, depth bigint, i1 bigint, i2 bigint, p1 bigint, p2 bigint, n bigint, conv bigint, "
    "chars bigint, rest bigint, rests bigint, n_ends bigint, end_conv bigint, ends array<bigint>, members binary"
)
_WEIGHT = "i1 bigint, i2 bigint, used bigint, leaves bigint, conv bigint, own bigint"


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _bits(bitmap: int, size: int) -> np.ndarray:
    """Indices of the set bits."""
    packed = np.frombuffer(bitmap.to_bytes(size // 8 + 1, "little"), dtype=np.uint8)
    return np.flatnonzero(np.unpackbits(packed, bitorder="little"))


def _chain_sums(values: np.ndarray, start: np.ndarray, owner: np.ndarray, begin: np.ndarray, op: np.ufunc) -> np.ndarray:
    """Running ``op`` over each owner's rows, begun with its ``begin``; ``op`` must be its own or have an inverse."""
    total = op.accumulate(values)
    before = np.concatenate([np.zeros(1, values.dtype), total])[start]
    return op(total ^ before[owner] if op is np.bitwise_xor else total - before[owner], begin[owner])


def _walk(block: int):
    """The task of one shard and block of positions: turns and conversations in, parts of nodes out."""

    def walk(turns: pa.Table, heads: pa.Table) -> pa.Table:
        heads = heads.sort_by("conv_id")
        conv, e1, e2, echars, total, last = _numbers(heads, "conv_id", "e1", "e2", "echars", "total", "last")
        turns = turns.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
        own, pos, g1, g2, chars = _numbers(turns, "conv_id", "pos", "g1", "g2", "chars")
        shard, blk = heads.column("shard")[0].as_py(), heads.column("blk")[0].as_py()
        m, rows = len(conv), len(own)
        start = np.searchsorted(own, conv)
        count = np.searchsorted(own, conv, side="right") - start
        owner = np.repeat(np.arange(m), count)
        step = np.arange(rows) - start[owner]
        i1, i2 = (_chain_sums(g, start, owner, e, np.bitwise_xor) for g, e in ((g1, e1), (g2, e2)))
        rest = total[owner] - _chain_sums(chars, start, owner, echars, np.add) + chars
        p1, p2 = (np.where(step == 0, e[owner], np.concatenate([np.zeros(1, i.dtype), i])[:-1] if rows else i) for i, e in ((i1, e1), (i2, e2)))

        # Postings: rows by (position, turn); those with one row need no bitmap.
        by = np.lexsort((g2, g1, pos))
        new = np.ones(rows, dtype=bool)
        if rows:
            s = by[1:], by[:-1]
            new[1:] = (pos[s[0]] != pos[s[1]]) | (g1[s[0]] != g1[s[1]]) | (g2[s[0]] != g2[s[1]])
        number = np.cumsum(new) - 1
        code = np.empty(rows, dtype=np.int64)
        code[by] = number
        codes = code.tolist()
        size = np.bincount(number, minlength=1)
        postings: dict[int, int] = {}
        for r in by[size[number] > 1]:
            postings[codes[r]] = postings.get(codes[r], 0) | (1 << int(owner[r]))

        starts, counts = start.tolist(), count.tolist()
        alone = np.full(m, block)  # from which step on a conversation is alone
        found: list[tuple[int, int]] = []  # (row of the smallest member, bitmap)

        def descend(bitmap: int, at: int) -> None:
            todo = [(bitmap, at)]
            while todo:
                left, at = todo.pop()
                while left:
                    low = left & -left
                    c = low.bit_length() - 1
                    if at >= counts[c]:
                        left ^= low
                        continue
                    r = starts[c] + at
                    child = left & postings.get(codes[r], low)
                    left ^= child
                    if child == low:
                        alone[c] = at
                    else:
                        found.append((r, child))
                        todo.append((child, at + 1))

        if blk == 0:
            descend((1 << m) - 1, 0)
        else:
            entry: dict[tuple[int, int], int] = {}
            for c, key in enumerate(zip(e1.tolist(), e2.tolist())):
                entry[key] = entry.get(key, 0) | (1 << c)
            for bitmap in entry.values():
                descend(bitmap, 0)

        single = np.flatnonzero(step >= alone[owner])
        ends = pos == last[owner]
        out = {k: [] for k in ("depth", "i1", "i2", "p1", "p2", "n", "conv", "chars", "rest", "rests", "n_ends", "end_conv", "ends", "members")}

        def add(**values) -> None:
            for k, v in values.items():
                out[k].append(v)

        if blk == 0:
            done = conv[last < 0]
            add(depth=0, i1=0, i2=0, p1=None, p2=None, n=m, conv=int(conv[0]), chars=0, rest=int(total[0]), rests=int(total.sum()))
            add(n_ends=len(done), end_conv=int(done[0]) if len(done) else None, ends=done.tolist() if len(done) > 1 else None)
            add(members=((1 << m) - 1).to_bytes(m // 8 + 1, "little"))
        for r, bitmap in found:
            who = _bits(bitmap, m)
            mine = start[who] + step[r]
            done = conv[who[ends[mine]]]
            add(depth=int(pos[r]) + 1, i1=int(i1[r]), i2=int(i2[r]), p1=int(p1[r]), p2=int(p2[r]), n=len(who), conv=int(own[r]), chars=int(chars[r]))
            add(rest=int(rest[r]), rests=int(rest[mine].sum()), n_ends=len(done), end_conv=int(done[0]) if len(done) else None)
            add(ends=done.tolist() if len(done) > 1 else None, members=bitmap.to_bytes(m // 8 + 1, "little"))
        one = {"depth": pos[single] + 1, "i1": i1[single], "i2": i2[single], "p1": p1[single], "p2": p2[single]}
        one |= {"n": np.ones(len(single), dtype=np.int64), "conv": own[single], "chars": chars[single], "rest": rest[single], "rests": rest[single]}
        one |= {"n_ends": ends[single].astype(np.int64)}
        columns = {k: pa.concat_arrays([pa.array(out[k], pa.int64()), pa.array(v, pa.int64())]) for k, v in one.items()}
        columns["end_conv"] = pa.concat_arrays([pa.array(out["end_conv"], pa.int64()), pa.array(own[single], pa.int64(), mask=~ends[single])])
        columns["ends"] = pa.concat_arrays([pa.array(out["ends"], pa.list_(pa.int64())), pa.nulls(len(single), pa.list_(pa.int64()))])
        columns["members"] = pa.concat_arrays([pa.array(out["members"], pa.binary()), pa.nulls(len(single), pa.binary())])
        rows_out = len(columns["n"])
        fixed = {"shard": pa.array(np.full(rows_out, shard), pa.int64()), "blk": pa.array(np.full(rows_out, blk), pa.int64())}
        return pa.table(fixed | columns)

    return walk


def _weigh(parts: pa.Table, weights: pa.Table) -> pa.Table:
    """Weights of the members of each part of a node, added by its bitmap."""
    names = ["i1", "i2", "used", "leaves", "conv", "own"]
    if not parts.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    weights = weights.sort_by("conv_id")
    conv, used, leaf = _numbers(weights, "conv_id", "used", "leaf")
    i1, i2, least = _numbers(parts, "i1", "i2", "conv")
    at = np.searchsorted(conv, least)
    sums, leaves = used[at].copy(), leaf[at].copy()  # a part without a bitmap has one member
    for k, members in enumerate(parts.column("members").to_pylist()):
        if members is not None:
            who = _bits(int.from_bytes(members, "little"), len(conv))
            sums[k], leaves[k] = used[who].sum(), leaf[who].sum()
    return pa.table([pa.array(c, pa.int64()) for c in (i1, i2, sums, leaves, least, used[at])], names=names)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's end lists, which arrive sorted by node and shard."""
    now, digest = None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, ["i1", "i2", "sha"])

    for batch in batches:
        for i1, i2, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = ",".join(map(str, ends.as_py()))
            if (i1, i2) != now:
                if now:
                    yield row()
                now, digest = (i1, i2), hashlib.sha256(text.encode())
            else:
                digest.update(f",{text}".encode())
    if now:
        yield row()


def trie(turns: DataFrame, convs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of conversations
    ``convs`` (conv_id, shard), with or without ``turns`` (conv_id, shard, pos, a, b, chars)."""
    block = F.when(F.col("pos") < 0, F.lit(0)).otherwise(F.floor(F.col("pos") / rule.block)).cast("bigint")
    hashed = turns.select(
        "conv_id", "shard", "pos", F.xxhash64("pos", "a", "b").alias("g1"), F.xxhash64(F.lit(1), "pos", "a", "b").alias("g2"), "chars"
    )
    none = F.lit(0).cast("bigint")
    begin = convs.select("conv_id", "shard", F.lit(-1).cast("bigint").alias("pos"), none.alias("g1"), none.alias("g2"), none.alias("chars"))
    blocks = hashed.unionByName(begin).withColumn("blk", block).groupBy("conv_id", "shard", "blk")
    blocks = blocks.agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), F.sum("chars").alias("chars"), F.max("pos").alias("last"))
    own = Window.partitionBy("conv_id")
    before = own.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select(
        "shard", "blk", "conv_id",
        F.coalesce(F.bit_xor("x1").over(before), none).alias("e1"),
        F.coalesce(F.bit_xor("x2").over(before), none).alias("e2"),
        F.coalesce(F.sum("chars").over(before), none).alias("echars"),
        F.sum("chars").over(own).alias("total"),
        F.max("last").over(own).alias("last"),
    )
    heads = stored(heads, "heads")

    cut = hashed.withColumn("blk", block).groupBy("shard", "blk")
    parts = stored(cut.cogroup(heads.groupBy("shard", "blk")).applyInArrow(_walk(rule.block), _PART), "parts")

    met = parts.groupBy("i1", "i2").agg(
        F.min(F.struct("conv", "rest")).alias("least"),
        *[F.max(c).alias(c) for c in ("depth", "p1", "p2", "chars")],
        *[F.sum(c).alias(c) for c in ("n", "rests", "n_ends")],
        F.min("end_conv").alias("end_conv"),
    )
    met = met.select("i1", "i2", "p1", "p2", "depth", "chars", "n", "rests", "n_ends", "end_conv", F.col("least.conv").alias("conv"), F.col("least.rest").alias("rest"))
    met = stored(met, "nodes")
    children = met.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("i1"), F.col("p2").alias("i2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(met.join(children, ["i1", "i2"], "left").withColumn("n_children", F.coalesce("n_children", none)), "nodes")

    weights = nodes.groupBy(F.col("conv").alias("conv_id")).agg(F.sum("chars").alias("used"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    weights = heads.select("shard", "blk", "conv_id").join(weights, "conv_id", "left").fillna(0, ["used", "leaf"])
    shared = parts.join(nodes.where("n > 1").select("i1", "i2"), ["i1", "i2"]).select("shard", "blk", "i1", "i2", "conv", "members")
    weighed = shared.groupBy("shard", "blk").cogroup(weights.groupBy("shard", "blk")).applyInArrow(_weigh, _WEIGHT)
    sums = weighed.groupBy("i1", "i2").agg(F.sum("used").alias("used"), F.sum("leaves").alias("leaves"), F.min(F.struct("conv", "own"))["own"].alias("own"))

    several = nodes.where("n_ends > 1").select("i1", "i2")
    lists = parts.where("n_ends > 0").join(several, ["i1", "i2"]).select("i1", "i2", "shard", F.coalesce("ends", F.array("end_conv")).alias("ends"))
    lists = lists.repartition("i1", "i2").sortWithinPartitions("i1", "i2", "shard").select("i1", "i2", "ends")
    digests = lists.mapInArrow(_hash_ends, "i1 bigint, i2 bigint, sha string")

    parents = nodes.select(F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("conv").alias("parent_conv_id"), "n_children")
    hot = parents.where(F.col("n_children") > nodes.count() // HOT_ROWS).drop("n_children")  # HOT_ROWS at most
    placed = lookup_join(nodes, parents.drop("n_children"), ["p1", "p2"], hot=hot, salt=["i1"])
    whole = placed.join(sums, ["i1", "i2"], "left").join(digests, ["i1", "i2"], "left")
    alone = F.col("n") == 1
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.when(alone, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
        F.when(alone, 0).otherwise(F.col("rests") - F.col("used") - (F.col("rest") - F.col("own"))).cast("bigint").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.coalesce(F.col("end_conv").cast("string"), F.lit("")), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The trie of conversations as they are."""
    turns, convs = numbered(conversations, rule)
    return trie(turns.withColumnRenamed("rank", "pos"), convs, rule)


def spliced_trie(conversations: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The trie of conversations that begin as the first of their hundred does (``spliced``)."""
    turns, convs = numbered(conversations, rule)
    return trie(stored(spliced(turns, convs), "spliced-turns"), convs, rule)
