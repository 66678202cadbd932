"""Prefix trie of conversations: vertical bitmaps per shard, nodes of all shards added up by their prefix.

Conversations are rebuilt first: the first h turns of conversation c - c % 5, then c's own turns after its first h.
Turns are told apart by a digest of role and text, so texts are read once and never shuffled, but where a
conversation has the same turn number twice.

A shard is a run of conversations by id, of about `SHARD_TURNS` turns. It indexes each (position, turn) as a bitset
of conversations. From the bitset of a node, its children are found depth first: the turn of the least member that is
left, intersected with the node's bitset, is a child, and goes out of the rest. Popcounts are the members, the least
bit is the least member, and the members without a further turn are the end list. A child of one conversation
has no further branch: its turns are taken as they are. Shards' nodes are added up by depth and prefix, a prefix being
the exclusive or of hashes of its (position, turn) pairs, 128 bits. Shards are ranges of ids, so that end lists put one
after the other are in order; they are hashed as a stream.

Sums over subtrees need no walk up the tree. A node is known by its least member and its depth, so the nodes that a
conversation is the least member of are a path, and the trie is made up of these paths. A subtree holds the rest of its
own path and all of the paths of its other members. So the shards run once more, over turns that several conversations
share, and add up the totals of their members' paths.

Long conversations are cut into segments of `SEGMENT` turns, each with the prefix that it starts from, and no step
puts a conversation, a node's children or its members into one task, but for the hashing of one node's end list,
which the digest makes a single stream.

Defined cases: rows without conv_id belong to no conversation; null role or text is empty; turns with the same number
are ordered by role and text, null as empty; repeated rows are turns of their own; a conversation that is rebuilt
without turns is a member and an end of the root; no rows give no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.common import stored, table
from tallyshelf.operators.joins import broadcast_rows_if_few

GROUP = 5
MOST_SHARED = 9
SEGMENT = 512
SHARD_TURNS = 1 << 16
KEY = ("depth", "k1", "k2")
_PLACE = 33  # bits that monotonically_increasing_id() has for the rows of a partition

_KEY_FIELDS = [("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
NODES = pa.schema([
    *_KEY_FIELDS,
    ("p1", pa.int64()),
    ("p2", pa.int64()),
    ("conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_bytes", pa.int64()),
    ("ends", pa.large_string()),
])
NODES_DDL = (
    "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_bytes long, ends string"
)
TOTALS = pa.schema([
    *_KEY_FIELDS,
    ("conv_id", pa.int64()),
    ("first_leaves", pa.int64()),
    ("first_saved", pa.int64()),
    ("leaves", pa.int64()),
    ("saved", pa.int64()),
])
TOTALS_DDL = (
    "depth long, k1 long, k2 long, conv_id long, first_leaves long, first_saved long, leaves long, saved long"
)
ENDS = pa.schema([*_KEY_FIELDS, ("ends_sha256", pa.string())])
ENDS_DDL = "depth long, k1 long, k2 long, ends_sha256 string"


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n_bytes, tie): `tie` orders turns with the same number and is null elsewhere."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    ).filter(F.col("conv_id").isNotNull())
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = turns.select(
        "conv_id", "turn", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), "role", "text"
    )
    same = turns.groupBy("conv_id", "turn").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    same = broadcast_rows_if_few(same.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "_n"))
    tie = F.lit(None).cast("struct<role:string,text:string>")
    if same is not None:
        rows = rows.join(same, (F.col("conv_id") == F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")), "left")
        tie = F.when(F.col("_n").isNotNull(), F.struct("role", "text"))
    return rows.select("conv_id", "turn", "digest", "n_bytes", tie.alias("tie"))


def _in_order(turns: DataFrame) -> DataFrame:
    """Turns with the part of the sorted table they are in, and their place there; stored."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("tie")]
    numbered = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = numbered.withColumn("_n", F.monotonically_increasing_id())
    return stored(
        numbered.select(
            "conv_id",
            F.shiftright("_n", _PLACE).alias("part"),
            F.col("_n").bitwiseAND((1 << _PLACE) - 1).alias("place"),
            "digest",
            "n_bytes",
        ),
        "turns",
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, n_bytes, last) of the rebuilt conversations, and (conv_id, n_turns) of each."""
    rows = _in_order(stored(turns, "digests"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    of_conv = Window.partitionBy("conv_id")
    edges = rows.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n")).select(
        "conv_id",
        "part",
        "first",
        base.alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h"),
        F.coalesce(F.sum("n").over(of_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(of_conv).alias("own"),
    )
    is_base = F.col("conv_id") == F.col("base")
    lengths = edges.filter(is_base & (F.col("before") == 0)).select("base", F.col("own").alias("base_turns"))
    taken = F.when(is_base, F.col("h") * 0).otherwise(F.least("h", F.coalesce("base_turns", F.lit(0))))
    skipped = F.when(is_base, F.col("h") * 0).otherwise(F.col("h"))
    edges = stored(
        edges.join(lengths, "base", "left")
        .withColumns({"taken": taken, "skipped": skipped})
        .withColumn("n_turns", F.col("taken") + F.greatest(F.col("own") - F.col("skipped"), F.lit(0)))
        .drop("base_turns", "own"),
        "edges",
    )
    convs = edges.filter(F.col("before") == 0).drop("part", "first", "before")

    def placed(of: DataFrame) -> DataFrame:
        """Turns with their place in their conversation. Edges are by part, so a long conversation is many keys."""
        place = F.col("before") + F.col("place") - F.col("first") + 1
        return rows.join(of, ["conv_id", "part"]).withColumn("at", place)

    own = placed(edges).filter(F.col("at") > F.col("skipped"))
    own = own.withColumn("depth", F.col("at") - F.col("skipped") + F.col("taken"))
    heads = placed(edges.filter(is_base & (F.col("before") < MOST_SHARED))).filter(F.col("at") < MOST_SHARED)
    heads = heads.select("base", F.col("at").alias("depth"), "digest", "n_bytes")
    shared = convs.filter(F.col("taken") > 0).join(heads, "base").filter(F.col("depth") <= F.col("taken"))
    columns = ["conv_id", "depth", "digest", "n_bytes", (F.col("depth") == F.col("n_turns")).alias("last")]
    return own.select(*columns).unionByName(shared.select(*columns)), convs.select("conv_id", "n_turns")


def _stream(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """What shards are made of: per segment and conversation a row with the prefix it starts from, then its turns."""
    hashed = turns.select(
        F.expr(f"(depth - 1) div {SEGMENT}").alias("segment"),
        "conv_id",
        "depth",
        F.xxhash64("digest", "depth").alias("k1"),
        F.xxhash64(F.lit(2), "depth", "digest").alias("k2"),
        "n_bytes",
        "last",
    )
    zero = F.lit(0).cast("long")
    starts = convs.select(
        zero.alias("segment"), "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"),
        zero.alias("n_bytes"), (F.col("n_turns") == 0).alias("last"),
    )
    stream = hashed.unionByName(starts)
    long = broadcast_rows_if_few(convs.filter(F.col("n_turns") > SEGMENT))
    if long is not None:
        parts = hashed.join(long, "conv_id").groupBy("conv_id", "segment", "n_turns")
        parts = parts.agg(F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
        upto = Window.partitionBy("conv_id").orderBy("segment")
        later = parts.select(
            (F.col("segment") + 1).alias("segment"), "conv_id",
            ((F.col("segment") + 1) * SEGMENT).alias("depth"),
            F.bit_xor("k1").over(upto).alias("k1"), F.bit_xor("k2").over(upto).alias("k2"),
            zero.alias("n_bytes"), F.lit(False).alias("last"), "n_turns",
        ).filter(F.col("depth") < F.col("n_turns"))
        stream = stream.unionByName(later.drop("n_turns"))
    return stored(stream, "stream")


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows in order, in groups of about `limit` that hold whole (segment, conversation) runs of one segment."""

    def cuts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        segment, conv = rows["segment"].to_numpy(), rows["conv_id"].to_numpy()
        new_segment = np.flatnonzero(np.diff(segment)) + 1
        return new_segment, np.flatnonzero((np.diff(segment) != 0) | (np.diff(conv) != 0)) + 1

    def split(rows: pa.Table) -> Iterator[pa.Table]:
        bounds = [0, *cuts(rows)[0].tolist(), rows.num_rows]
        for a, b in pairwise(bounds):
            yield rows.slice(a, b - a)

    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        kept.append(batch)
        size += batch.num_rows
        if size >= limit:
            rows = pa.Table.from_batches(kept).combine_chunks()
            runs = cuts(rows)[1]
            if len(runs):
                yield from split(rows.slice(0, int(runs[-1])))
                rows = rows.slice(int(runs[-1]))
            kept, size = rows.to_batches(), rows.num_rows
    if size:
        yield from split(pa.Table.from_batches(kept).combine_chunks())


class Shard:
    """The bitmap index of a shard and its nodes.

    A node is given as the row of its least member's turn. `shared` has (row, bitset, end bitset) of the nodes of
    several members, `single` marks the rows that are nodes of one member.
    """

    def __init__(self, rows: pa.Table) -> None:
        self.segment = rows["segment"][0].as_py()
        self.conv, self.depth = rows["conv_id"].to_numpy(), rows["depth"].to_numpy()
        self.n_bytes = rows["n_bytes"].to_numpy()
        self.last = rows["last"].to_numpy(zero_copy_only=False)
        keys = [rows[k].to_numpy() for k in ("k1", "k2")]
        n = len(self.conv)
        self.starts = np.flatnonzero(self.depth == self.segment * SEGMENT)
        self.n_convs = len(self.starts)
        self.conv_of = np.repeat(np.arange(self.n_convs), np.diff(self.starts, append=n))
        self.prefix = [self._prefixes(k) for k in keys]
        # Postings: rows of the same (position, turn), whose hashes hold the position.
        order = np.lexsort(keys)
        new = np.concatenate([[True], np.any([np.diff(k[order]) != 0 for k in keys], axis=0)])
        self._bounds = np.append(np.flatnonzero(new), n)
        self._order = order
        posting = np.empty(n, np.int64)
        posting[order] = np.cumsum(new) - 1
        self._posting = posting.tolist()
        self._alone = (np.diff(self._bounds) == 1)[posting].tolist()
        self._bitsets: dict[int, int] = {}
        self.single = np.zeros(n, bool)
        self.shared: list[tuple[int, int, int]] = []
        self._walk()

    def _prefixes(self, keys: np.ndarray) -> np.ndarray:
        """Exclusive or over each conversation's rows; its start row holds the prefix it starts from."""
        acc = np.bitwise_xor.accumulate(keys)
        before = np.where(self.starts > 0, acc[self.starts - 1], 0)
        return acc ^ before[self.conv_of]

    def bits(self, convs: np.ndarray) -> int:
        flags = np.zeros(self.n_convs, bool)
        flags[convs] = True
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    def members(self, bits: int) -> np.ndarray:
        data = bits.to_bytes(-(-self.n_convs // 8), "little")
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))

    def _bitset(self, row: int) -> int:
        k = self._posting[row]
        if k not in self._bitsets:
            rows = self._order[self._bounds[k] : self._bounds[k + 1]]
            self._bitsets[k] = self.bits(self.conv_of[rows])
        return self._bitsets[k]

    def _walk(self) -> None:
        starts, n = self.starts.tolist(), len(self.conv)
        stops = [*starts[1:], n]
        lengths = np.diff(self.starts, append=n)
        final = self.last[np.append(self.starts[1:], n) - 1]
        done, ends = {}, {}
        order = np.argsort(lengths, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            step = int(lengths[group[0]]) - 1
            done[step], ends[step] = self.bits(group), self.bits(group[final[group]])
        # Where the walk starts: conversations with the same prefix before this segment.
        first = [p[self.starts] for p in self.prefix]
        order = np.lexsort(first)
        new = np.flatnonzero(np.any([np.diff(p[order]) != 0 for p in first], axis=0)) + 1
        stack = []
        for group in np.split(order, new):
            if self.segment == 0:
                self.shared.append((starts[int(group.min())], self.bits(group), self.bits(group) & ends.get(0, 0)))
            if len(group) == 1:
                k = int(group[0])
                self.single[starts[k] + 1 : stops[k]] = True
            else:
                stack.append((self.bits(group), 0))
        while stack:
            node, step = stack.pop()
            rest = node & ~done.get(step, 0)
            step += 1
            while rest:
                least = rest & -rest
                k = least.bit_length() - 1
                row = starts[k] + step
                child = least if self._alone[row] else node & self._bitset(row)
                rest ^= child
                if child == least:
                    self.single[row : stops[k]] = True
                else:
                    self.shared.append((row, child, child & ends.get(step, 0)))
                    stack.append((child, step))

    def columns(self, rows: np.ndarray) -> list[np.ndarray]:
        return [self.depth[rows], *(p[rows] for p in self.prefix)]

    def nodes(self) -> pa.RecordBatch:
        shared = np.array([r for r, _, _ in self.shared], np.int64)
        single = np.flatnonzero(self.single)
        rows = np.concatenate([shared, single])
        root = self.depth[rows] == 0
        before = np.where(root, 0, rows - 1)
        counts = np.concatenate([[b.bit_count() for _, b, _ in self.shared], np.ones(len(single), np.int64)])
        lists = [",".join(map(str, self.conv[self.starts[self.members(e)]].tolist())) if e else None for _, _, e in self.shared]
        own = pc.if_else(pa.array(self.last[single]), pa.array(self.conv[single]).cast(pa.large_string()), None)
        arrays = [
            *map(pa.array, self.columns(rows)),
            *(pa.array(p[before], mask=root) for p in self.prefix),
            pa.array(self.conv[rows]),
            pa.array(counts.astype(np.int64)),
            pa.array(self.n_bytes[rows]),
            pa.concat_arrays([pa.array(lists, pa.large_string()), own]),
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=NODES)

    def totals(self, leaves: np.ndarray, saved: np.ndarray) -> pa.RecordBatch:
        """Sums over each node's members of two numbers that every row of a conversation has."""
        sums = []
        for _, bits, _ in self.shared:
            rows = self.starts[self.members(bits)]
            sums.append((leaves[rows].sum(), saved[rows].sum()))
        single = np.flatnonzero(self.single)
        rows = np.concatenate([np.array([r for r, _, _ in self.shared], np.int64), single])
        of_shared = np.array(sums, np.int64).reshape(-1, 2)
        arrays = [
            *self.columns(rows),
            self.conv[rows],
            leaves[rows],
            saved[rows],
            np.concatenate([of_shared[:, 0], leaves[single]]),
            np.concatenate([of_shared[:, 1], saved[single]]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], schema=TOTALS)


def _shard_nodes(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, limit):
            yield Shard(rows).nodes()

    return run


def _shard_totals(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, limit):
            yield Shard(rows).totals(rows["leaves"].to_numpy(), rows["saved"].to_numpy())

    return run


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its end lists, which come one after the other."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *row, ends in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ends")), strict=True):
            if row == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append([*key, digest.hexdigest()])
                key, digest = row, hashlib.sha256()
            digest.update(ends.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ENDS)], schema=ENDS)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([*key, digest.hexdigest()], ENDS)], schema=ENDS)


def _by_range(stream: DataFrame) -> DataFrame:
    order = ["segment", "conv_id", "depth"]
    return stream.repartitionByRange("segment", "conv_id").sortWithinPartitions(*order)


def _rest_of_path(nodes: DataFrame) -> DataFrame:
    """Nodes with `rest_leaves` and `rest_saved`, summed over their path from them on; segments are added up apart."""
    nodes = nodes.withColumn("segment", F.expr(f"depth div {SEGMENT}"))
    sums = [F.sum("leaf").alias("s_leaves"), F.sum("value").alias("s_saved")]
    per_segment = nodes.groupBy("conv_id", "segment").agg(*sums)
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    later = per_segment.select(
        "conv_id", "segment", F.sum("s_leaves").over(after).alias("more_leaves"), F.sum("s_saved").over(after).alias("more_saved")
    )
    later = broadcast_rows_if_few(later.filter(F.col("more_leaves").isNotNull()))
    on = Window.partitionBy("conv_id", "segment").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rest = nodes.withColumns({"rest_leaves": F.sum("leaf").over(on), "rest_saved": F.sum("value").over(on)})
    if later is None:
        return rest
    rest = rest.join(later, ["conv_id", "segment"], "left")
    return rest.withColumns({
        f"rest_{c}": F.col(f"rest_{c}") + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")
    })


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    stream = _stream(*rebuilt_turns(turn_digests(conversations)))
    partial = stored(_by_range(stream).mapInArrow(_shard_nodes(shard_turns), NODES_DDL), "partial")
    nodes = stored(
        partial.groupBy(*KEY).agg(
            F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        ),
        "nodes",
    )
    children = nodes.filter(F.col("depth") > 0).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    nodes = stored(
        nodes.join(children, list(KEY), "left").withColumns({
            "n_children": F.coalesce("n_children", F.lit(0)),
            "leaf": F.col("n_children").isNull().cast("long"),
            "value": (F.col("n_convs") - 1) * F.col("n_bytes"),
        }),
        "nodes",
    )
    paths = stored(
        nodes.groupBy("conv_id").agg(
            F.min("depth").alias("top"),
            F.greatest(F.min("depth") - 1, F.max(F.when(F.col("n_convs") > 1, F.col("depth")))).alias("shared"),
            F.sum("leaf").alias("leaves"),
            F.sum("value").alias("saved"),
        ),
        "paths",
    )
    # Sums over the members of nodes that have several.
    asked = stream.join(paths.drop("top"), "conv_id").filter(F.col("depth") <= F.col("shared")).drop("shared")
    totals = _by_range(stored(asked, "asked")).mapInArrow(_shard_totals(shard_turns), TOTALS_DDL).groupBy(*KEY).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.min(F.struct("conv_id", "first_leaves", "first_saved")).alias("own"),
    ).select(
        *KEY,
        (F.col("leaves") - F.col("own.first_leaves")).alias("other_leaves"),
        (F.col("saved") - F.col("own.first_saved")).alias("other_saved"),
    )
    # The parents of the paths' first nodes. Many may have the same parent: the skew join of adaptive execution splits these.
    tops = nodes.join(paths.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"]).filter(F.col("depth") > 0)
    tops = tops.select("conv_id", F.col("depth").alias("top"), (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    parents = tops.join(nodes.select(*KEY, F.col("conv_id").alias("parent")), list(KEY))
    parents = parents.select("conv_id", F.col("top").alias("depth"), "parent")
    ends = partial.filter(F.col("ends").isNotNull()).select(*KEY, "conv_id", "ends")
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").select(*KEY, "ends")
    ends = ends.mapInArrow(_hash_ends, ENDS_DDL)
    whole = (
        _rest_of_path(nodes)
        .join(parents, ["conv_id", "depth"], "left")
        .join(totals, list(KEY), "left")
        .join(ends, list(KEY), "left")
    )
    return whole.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("rest_leaves") + F.coalesce("other_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("rest_saved") + F.coalesce("other_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def q_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def trie_sql() -> str:
    """The same by grouping whole lists of turns; checksums are spelled out, as this SQL has no function for them."""
    bits = "list_reduce(list_prepend(xor(r, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)), lambda r, b: {bits}), 4294967295)"
    return f"""
with turn as (
    select conv_id::bigint as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place,
           coalesce(role, '') as role, coalesce(text, '') as body
    from conversations where conv_id is not null
), conv as (
    select c, list({{'role': role, 'body': body}} order by place) as turns from turn group by c
), conv_h as (
    select c, turns, ({crc}) % {MOST_SHARED} as h from conv
), built as (
    select a.c, case when a.c % {GROUP} = 0 then a.turns else
           list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) end as turns
    from conv_h a left join conv b on b.c = a.c - a.c % {GROUP}
), part as (
    select c, d, turns[1:d] as prefix, len(turns) = d as is_end,
           case when d = 0 then 0 else strlen(turns[d].body) end as n_bytes
    from (select c, turns, unnest(range(len(turns) + 1)) as d from built)
), node as (
    select prefix, d as depth, min(c) as conv_id, count(*) as n_convs, any_value(n_bytes) as n_bytes,
           sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where is_end), '')) as ends_sha256
    from part group by prefix, d
), member as (
    select p.c, n.depth, n.conv_id, n.n_convs, n.n_bytes from part p join node n on p.prefix = n.prefix and p.d = n.depth
), child as (
    select p.conv_id, p.depth, count(distinct m.conv_id) as n_children
    from member p join member m on p.c = m.c and m.depth = p.depth + 1 group by all
), pair as (
    select distinct a.conv_id, a.depth, b.conv_id as below, b.depth as below_depth, b.n_convs, b.n_bytes
    from member a join member b on a.c = b.c and b.depth >= a.depth
), sums as (
    select p.conv_id, p.depth, sum((p.n_convs - 1) * p.n_bytes)::bigint as saved_tokens,
           count(*) filter (where k.n_children is null) as n_leaves
    from pair p left join child k on k.conv_id = p.below and k.depth = p.below_depth group by all
), parent as (
    select distinct m.conv_id, m.depth, a.conv_id as parent_conv_id
    from member m join member a on m.c = a.c and a.depth = m.depth - 1
)
select n.conv_id, n.depth, parent.parent_conv_id, n.n_convs, coalesce(child.n_children, 0) as n_children,
       sums.n_leaves, sums.saved_tokens, n.ends_sha256
from node n join sums using (conv_id, depth) left join child using (conv_id, depth) left join parent using (conv_id, depth)
"""
