"""Prefix trie of conversations: minimal-perfect-hash node tables, one per shard, merged by sums.

A node is a distinct sequence of turns (role and text). Its digest is a pair of polynomial hashes modulo 2^61 - 1 over the
turns' SHA-256, which can be continued from any place, so no text moves and a long conversation can be cut.

1. Turns are dealt by ranges of (conversation, turn); a range is a shard. What a shard must know of those before it (how
   far its first conversation has come) is one small row per shard.
2. Each shard enumerates the distinct prefix digests of its conversations, gives them slots 0..n-1 by a minimal perfect
   hash, and scatters counts into flat arrays by slot. These local nodes, at most one of a kind per shard, are summed over
   the shards. The shard of a node's smallest member owns it.
3. Each shard takes the sums back, puts what it owns (childless or not, bytes saved) into arrays by slot, and adds it up
   through the array of parent slots, deepest nodes first. Every path to the root lies in the shard, so the sums over the
   shards are those over whole subtrees. Of a conversation that a range cuts, the shards before get the amount that leaves
   the top of the later part, again one small row per shard.
"""

import hashlib
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .shared import fixed

PRIME = (1 << 61) - 1
BASES = (1_475_698_713_021_257_791, 906_180_403_417_562_311)
EMPTY = (0, 0)
ROOT = 0


_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<array<long>>": pa.list_(pa.list_(pa.int64()))}


def _arrow(columns):
    """The Arrow schema of columns as Spark writes them."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def longer(digest, turn):
    """The digest of a sequence with one more turn; turn is a pair of numbers."""
    return (digest[0] * BASES[0] + turn[0]) % PRIME, (digest[1] * BASES[1] + turn[1]) % PRIME


def joined(digest, more, n):
    """The digest of a sequence followed by one of n turns."""
    return tuple((d * pow(b, n, PRIME) + m) % PRIME for d, b, m in zip(digest, BASES, more))


def _mixed(keys, level):
    """64 mixed bits of each key (a row of integers)."""
    x = np.full(len(keys), (level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for column in np.ascontiguousarray(keys.T).view(np.uint64):
        x ^= column
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x


class NodeTable:
    """Minimal perfect hash of distinct keys: slots 0..n-1, and -1 for any other key, since slots keep their keys.

    Level after level the keys left are thrown into twice as many places; a key alone in its place stays there, and its
    slot is the rank of that place among the occupied ones.
    """

    def __init__(self, keys):
        self.levels, left, taken = [], keys, 0
        while len(left):
            size = 2 * len(left) + 1
            place = (_mixed(left, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size)[place] == 1
            used = np.zeros(size, bool)
            used[place[alone]] = True
            self.levels.append((size, used, np.cumsum(used) - 1 + taken))
            taken, left = taken + int(alone.sum()), left[~alone]
        self.keys = keys[:0]
        slots = self._places(keys)
        self.keys = np.empty_like(keys)
        self.keys[slots] = keys

    def _places(self, keys):
        slots, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, used, rank) in enumerate(self.levels):
            place = (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = used[place]
            slots[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        return slots

    def slots(self, keys):
        """The slot of each key; a key that isn't in the table has -1, found by comparing it with the slot's own."""
        slots = self._places(keys)
        found = slots >= 0
        found[found] = (self.keys[slots[found]] == keys[found]).all(axis=1)
        return np.where(found, slots, -1)


def _borrowed(conv, family, turns):
    """How many turns a conversation takes from the first one of its family."""
    return 0 if conv == family else zlib.crc32(str(conv).encode()) % turns


def _lists(batches):
    """(family, conversation) and its turns within the range, as (hash, hash, bytes)."""
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        yield *key, [r[2:] for r in group]


_SUMMARY = "part long, first_conv long, family long, conv long, n long, head array<array<long>>, rests array<array<long>>"


def _summary_pass(borrow):
    """What later shards must know of this one: its last conversation's turns, and the head of the family it is in."""

    def run(batches):
        first, last, head = None, None, (None, [])
        for family, conv, turns in _lists(batches):
            first = conv if last is None else first
            if conv == family:
                head = (family, turns[:borrow])
            last = (family, conv, turns)
        if last is None:
            return
        family, conv, turns = last
        rests = []
        for skip in range(min(borrow, len(turns)) + 1):
            digest = EMPTY
            for t in turns[skip:]:
                digest = longer(digest, t)
            rests.append(list(digest))
        head = [list(t) for t in head[1]] if head[0] == family else []
        row = (TaskContext.get().partitionId(), first, family, conv, len(turns), head, rests)
        schema = _arrow(_SUMMARY)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    return run


class _State:
    """How far a conversation has come: its own turns read, and the rebuilt sequence's depth and digest."""

    def __init__(self, family, conv, head, turns, read=0, depth=0, digest=EMPTY):
        self.family, self.conv, self.head = family, conv, head
        self.borrowed = _borrowed(conv, family, turns)
        self.read, self.depth, self.digest = read, depth, digest

    def lent(self):
        """Goes over the borrowed turns."""
        for t in self.head[: self.borrowed]:
            yield self.take(t)

    def take(self, turn):
        parent = self.digest
        self.digest = longer(parent, turn)
        self.depth += 1
        return self.depth, *self.digest, *parent, turn[2]

    def after(self):
        return self.family, self.conv, self.head, self.read, self.depth, self.digest


def _states(summaries, turns, borrow):
    """part -> state before its first turn; None for the first part with rows."""
    before, state = {}, None
    for s in sorted(summaries, key=lambda s: s.part):
        before[s.part] = state
        same = state is not None and state[0] == s.family
        head = ((state[2] if same else []) + [tuple(t) for t in s.head])[:borrow]
        if same and state[1] == s.conv:
            now = _State(s.family, s.conv, head, turns, *state[3:])
        else:
            now = _State(s.family, s.conv, head, turns)
            for _ in now.lent():
                pass
        skip = min(max(0, now.borrowed - now.read), s.n)
        now.digest = joined(now.digest, s.rests[skip], s.n - skip)
        now.depth += s.n - skip
        now.read += s.n
        state = now.after()
    return before


_LOCAL = (
    "part long, depth long, d1 long, d2 long, p1 long, p2 long, conv long, n long, bytes long, ghost boolean, tail boolean, ends boolean"
)


def _batch(schema, columns):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _local_pass(before, goes_on, turns, borrow):
    """The shard's distinct nodes with their counts, and the node that each of its conversations ends at.

    A ghost stands for the node that a cut conversation had come to before; the tail is where one goes on in the next.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        schema = _arrow(_LOCAL)
        carried = before.get(part)
        members, ends, ghosts, tail = [], [], [], None
        state, head = None, (None, [])
        if carried is not None:
            head = (carried[0], list(carried[2]))
        for family, conv, own in _lists(batches):
            if state is not None:
                ends.append((state.conv, state.depth, *state.digest))
            if conv == family:
                known = head[1] if head[0] == family else []
                head = (family, (known + own[:borrow])[:borrow])
            lender = head[1] if head[0] == family else []
            if carried is not None and carried[:2] == (family, conv):
                state = _State(family, conv, lender, turns, *carried[3:])
                ghosts.append((state.depth, *state.digest))
            else:
                state = _State(family, conv, lender, turns)
                members.append((conv, ROOT, *EMPTY, -1, -1, 0))
                members.extend((conv, *node) for node in state.lent())
            skip = min(max(0, state.borrowed - state.read), len(own))
            members.extend((conv, *state.take(t)) for t in own[skip:])
            state.read += len(own)
        if state is None:
            return
        if part in goes_on:
            tail = (state.depth, *state.digest)
        else:
            ends.append((state.conv, state.depth, *state.digest))
        rows = np.array(members, np.int64).reshape(-1, 7)
        keys = np.unique(rows[:, 1:4], axis=0)
        table = NodeTable(keys)
        slot = table.slots(rows[:, 1:4])
        n = np.bincount(slot, minlength=len(keys))
        first = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(first, slot, rows[:, 0])
        rest = np.zeros((len(keys), 3), np.int64)
        rest[slot] = rows[:, 4:7]
        same, no = table.keys, np.zeros(len(keys), bool)
        columns = [np.full(len(keys), part), *same.T, rest[:, 0], rest[:, 1], first, n, rest[:, 2], no, no, no]
        yield _batch(schema, columns)
        for found, flags in ((ghosts, (True, False, False)), ([tail] if tail else [], (False, True, False))):
            for depth, d1, d2 in found:
                yield _batch(schema, [[v] for v in (part, depth, d1, d2, -1, -1, None, 0, 0, *flags)])
        for at in range(0, len(ends), 10_000):
            some = ends[at : at + 10_000]
            conv, depth, d1, d2 = zip(*some)
            none, k = [None] * len(some), len(some)
            yield _batch(schema, [[part] * k, depth, d1, d2, none, none, conv, none, none, [False] * k, [False] * k, [True] * k])

    return run


_PARTIAL = (
    "part long, depth long, d1 long, d2 long, conv long, parent long, n long, children long, leaves long, saved long, tail boolean"
)


def _sum_shard(local):
    """Sums over the subtrees within a shard, for each of its nodes; the owner's row has the node's own figures too.

    ``tail`` marks the nodes above the place where the shard's last conversation goes on. A row of depth -1 has what
    leaves the shard by its ghost, and whether the tail's share does too.
    """
    get = lambda name: local[name].to_numpy(zero_copy_only=False)
    keys = np.stack([get(c).astype(np.int64) for c in ("depth", "d1", "d2")], axis=1)
    ghost, tail, n_here = get("ghost").astype(bool), get("tail").astype(bool), get("n_here").astype(np.int64)
    real = n_here > 0
    table = NodeTable(np.unique(keys[real | ghost], axis=0))
    slot, size = table.slots(keys), len(table.keys)

    def scattered(name, rows, fill=0):
        out = np.full(size, fill, np.int64)
        out[slot[rows]] = get(name)[rows].astype(np.int64)
        return out

    every = real | ghost
    conv, n, children = (scattered(c, every) for c in ("conv", "n", "children"))
    owned = np.zeros(size, bool)
    owned[slot[real]] = get("owner")[real] == get("part")[real]
    depth = table.keys[:, 0]
    above = np.full((size, 3), -1, np.int64)
    above[slot[real]] = np.stack([keys[real, 0] - 1, get("p1")[real].astype(np.int64), get("p2")[real].astype(np.int64)], axis=1)
    parent = table.slots(above)
    # Values flow through parent slots, deepest nodes first.
    leaves = np.where(owned & (children == 0), 1, 0)
    saved = np.where(owned, (n - 1) * scattered("bytes", real), 0)
    marked = np.zeros(size, bool)
    marked[slot[tail]] = True
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
        marked[parent[level[marked[level]]]] = True
    whole = np.zeros(size, bool)
    whole[slot[real]] = True
    part = int(get("part")[0])
    above_conv = np.where(parent >= 0, conv[np.maximum(parent, 0)], -1)
    out = {
        "part": np.full(size, part), "depth": depth, "d1": table.keys[:, 1], "d2": table.keys[:, 2], "conv": np.where(owned, conv, -1),
        "parent": above_conv, "n": n, "children": children, "leaves": leaves, "saved": saved, "tail": marked,
    }
    columns = {k: list(v[whole]) for k, v in out.items()}
    columns["conv"] = [c if o else None for c, o in zip(columns["conv"], owned[whole])]
    columns["parent"] = [c if o and p >= 0 else None for c, o, p in zip(columns["parent"], owned[whole], parent[whole])]
    lost = slot[ghost & ~whole[slot]]
    if len(lost):
        g = int(lost[0])
        row = (part, -1, 0, 0, None, None, 0, 0, int(leaves[g]), int(saved[g]), bool(marked[g]))
        for k, v in zip(columns, row):
            columns[k].append(v)
    schema = _arrow(_PARTIAL)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), schema.types)], schema=schema)


_ENDS = "depth long, d1 long, d2 long, ends_sha256 string"


def _ends_pass(batches):
    """SHA-256 of each node's ids as they stream by in order."""
    schema = _arrow(_ENDS)

    def rows():
        for b in batches:
            yield from zip(*[c.to_pylist() for c in b.columns])

    found = []
    for key, group in groupby(rows(), key=lambda r: r[:3]):
        digest, between = hashlib.sha256(), ""
        for r in group:
            digest.update(f"{between}{r[3]}".encode())
            between = ","
        found.append((*key, digest.hexdigest()))
        if len(found) == 10_000:
            yield _batch(schema, list(zip(*found)))
            found = []
    if found:
        yield _batch(schema, list(zip(*found)))


def prefix_trie(conversations, family=None, borrow=0):
    """One row per node: conv_id (its smallest member), depth, parent_conv_id (the parent's conv_id, null at the root), n_convs,
    n_children, n_leaves, saved_tokens (longs), ends_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns are not looked at. Turns are taken by turn, nulls
    first, equal ones by the SHA-256 of role and text; a null role or text is empty. Repeated rows are turns of their own.
    Rows without a conv_id are in no conversation. An empty table gives no rows, not even a root.

    With ``family`` f, each conversation c takes its first crc32(c) % (borrow + 1) turns from conversation c - c % f, if
    there is one, in place of as many of its own.

    A node's members are the conversations that begin with it. n_leaves counts the childless nodes of its subtree,
    saved_tokens adds up (n_convs - 1) times the bytes of the last text over it, and ends_sha256 is that of the ids,
    ascending and joined by commas, of the members that end there. Two nodes are one when depth and 122 bits of hash are.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where(conv.isNotNull()).select(
        (conv - conv % family if family else conv).alias("family"),
        conv.alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    part_of = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = rows.select("family", "conv", "turn", part_of(1).alias("h1"), part_of(16).alias("h2"), "bytes", F.col("digest"))
    key = ["family", (F.col("conv") != F.col("family")).alias("later"), "conv", "turn", "digest"]
    # The row's number makes equal keys different, so that many equal rows can lie in several shards.
    ordered = rows.withColumn("_number", F.monotonically_increasing_id()).repartitionByRange(*key, "_number").sortWithinPartitions(*key)
    ordered = fixed(ordered.select("family", "conv", "h1", "h2", "bytes"))
    turns = borrow + 1
    summaries = ordered.mapInArrow(_summary_pass(borrow), _SUMMARY).collect()  # one row per shard
    before = _states(summaries, turns, borrow)
    following = sorted(summaries, key=lambda s: s.part)
    goes_on = {a.part for a, b in zip(following, following[1:]) if a.conv == b.first_conv}
    first = fixed(ordered.mapInArrow(_local_pass(before, goes_on, turns, borrow), _LOCAL))

    node = ["depth", "d1", "d2"]
    local = first.where("NOT ends")
    sums = local.where("n > 0").groupBy(*node).agg(
        F.sum("n").alias("n"), F.min(F.struct("conv", "part")).alias("owner"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    no = F.lit(None).cast("long")
    children = sums.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    children = children.groupBy(*node).agg(F.count(F.lit(1)).alias("children"))
    whole = sums.select(*node, "n", F.col("owner.conv").alias("conv"), F.col("owner.part").alias("owner"), F.lit(0).cast("long").alias("children"))
    whole = whole.union(children.select(*node, no, no, no, "children")).groupBy(*node)
    whole = whole.agg(*[F.max(c).alias(c) for c in ("n", "conv", "owner")], F.max("children").alias("children"))
    known = local.select("part", *node, "p1", "p2", F.col("n").alias("n_here"), "bytes", "ghost", "tail").join(whole, node)
    partial = fixed(known.groupBy("part").applyInArrow(_sum_shard, _PARTIAL))
    lost = {r.part: r for r in partial.where("depth = -1").collect()}  # at most one row per shard
    gained, leaves, saved = [], 0, 0
    for a, b in reversed(list(zip(following, following[1:]))):
        r = lost.get(b.part)
        leaves, saved = (r.leaves + leaves * r.tail, r.saved + saved * r.tail) if r is not None else (0, 0)
        gained.append((a.part, leaves, saved))
    session = conversations.sparkSession
    gained = session.createDataFrame(gained, "part long, more_leaves long, more_saved long")
    partial = partial.where("depth >= 0").join(F.broadcast(gained), "part", "left")  # one row per shard
    added = lambda name: F.sum(F.col(name) + F.when(F.col("tail"), F.coalesce(f"more_{name}", F.lit(0))).otherwise(0)).alias(name)
    ends = first.where("ends").select(*node, "conv").repartition(*node).sortWithinPartitions(*node, "conv").mapInArrow(_ends_pass, _ENDS)
    figures = partial.groupBy(*node).agg(F.max("conv").alias("conv"), F.max("parent").alias("parent"), F.max("n").alias("n"), F.max("children").alias("children"), added("leaves"), added("saved"))
    return figures.join(ends, node, "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
