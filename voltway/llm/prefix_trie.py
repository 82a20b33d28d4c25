"""Prefix trie of conversations: sparse-table range minima over sorted LCPs.

Conversations are sorted by their turns, so those that share a prefix stand
together. Beside each stands how many turns it shares with the one before (its
LCP). A prefix of ``d`` turns of the conversation at rank ``i`` is shared by the
ranks around ``i`` up to the nearest LCPs below ``d``: two binary searches over a
sparse table of range minima, made for each candidate prefix by itself. Smallest
members are range minima too, and leaves and saved bytes are differences of
prefix sums over ranks.

Nothing needs one task or one row for a hot key:

* turns are numbered by a range sort over (conversation, turn, row) and the sums
  of what lies before each part;
* a conversation's sort key holds its turns up to the first that no other
  conversation has in that place, since nothing is shared from there on; the
  nodes behind are a chain that follows from the length alone;
* ranks are cut into blocks; a block has its own sparse table, one over the
  blocks' minima (``MOST_BLOCKS`` of them at most) leads a search that leaves its
  block to the block where it ends, and the staircase of that block's minima
  answers it in a join on the block;
* ids of a node's ends are joined in blocks and then stream through SHA-256.

Defined results: rows whose conv_id is null are left out; turns of a conversation
with equal (or null) turn are ordered by role and text; repeated rows are turns of
their own; null role and text count as empty; a conversation of any length and
text is taken whole; the remainder of a negative id has its sign; a table without
conversations has no nodes, any other a root; other columns are ignored whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltway.llm import common

#: Ranks a block, at least, and blocks at most.
BLOCK, MOST_BLOCKS = 1024, 65_536
#: Characters of a turn in a sort key.
WIDTH = 32
#: A conversation's first turns may come from the first of its group of so many ids.
GROUP, HEAD = 5, 9
DEPTHS_A_SLICE = 4096

RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def numbered(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest, size of turns (conv, turn, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            convs = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, convs[1:] != convs[:-1]])
            at = np.arange(len(convs)) - np.repeat(starts, np.diff(np.r_[starts, len(convs)])) + 1
            if convs[0] == last:
                at[: starts[1] if len(starts) > 1 else None] += n
            last, n = convs[-1], at[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(convs), part, np.int32)), pa.array(at)], names=["conv", "digest", "size", "part", "at"])

    order = ["conv", "turn", "role", "text", "row"]
    sorted_rows = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = sorted_rows.select("conv", F.unhex(F.substring(F.sha2(named, 256), 1, WIDTH)).alias("digest"), F.octet_length("text").cast("long").alias("size"))
    rows = common.written(rows.mapInArrow(run, "conv long, digest binary, size long, part int, at long"), "turns")
    parts = rows.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at")).alias("last")).collect()  # one row a part
    before, carried = [], (None, 0)
    for r in sorted(parts):
        offset = carried[1] if r["first"] == carried[0] else 0
        if offset:
            before.append((r["part"], r["first"], offset))
        carried = (r["last"]["conv"], r["last"]["at"] + (offset if r["first"] == r["last"]["conv"] else 0))
    offsets = F.broadcast(turns.sparkSession.createDataFrame(before, "part int, conv long, before long"))  # one row a part at most
    return rows.join(offsets, ["part", "conv"], "left").select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "size")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, digest, size) and lengths (conv, len) of the conversations with their groups' first turns."""
    head = common.remainder("conv", HEAD)
    counts = own.groupBy("conv").agg(F.max("pos").alias("n"))
    first = F.col("conv") - F.col("conv") % GROUP
    of_first = counts.select(F.col("conv").alias("first"), F.col("n").alias("n_first"))
    convs = counts.select("conv", "n", first.alias("first"), head.alias("head")).join(of_first, "first", "left")
    convs = common.written(convs.select("conv", "first", "n", "head", F.least("head", F.coalesce("n_first", F.lit(0))).alias("taken")), "conversations")
    heads = own.filter(F.col("pos") < HEAD).withColumnRenamed("conv", "first")
    led = convs.select("conv", "first", "taken").join(heads, "first").filter("pos <= taken")
    short = convs.filter("taken < head").select("conv", (F.col("head") - F.col("taken")).alias("lacking"))
    rest = own.filter(F.col("pos") > head).join(short, "conv", "left").withColumn("pos", F.col("pos") - F.coalesce("lacking", F.lit(0)))
    turns = led.select("conv", "pos", "digest", "size").unionByName(rest.select("conv", "pos", "digest", "size"))
    lengths = convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("len"))
    return common.written(turns, "rebuilt"), lengths


def keyed(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv, len, key and sizes of the turns up to the first that no other conversation has in its place."""
    shared = turns.groupBy("pos", "digest").agg(F.count("*").alias("n")).filter("n > 1").select("pos", "digest")
    rows = turns.join(shared, ["pos", "digest"]).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "size"))).alias("turns"))
    rows = rows.withColumn("turns", F.filter("turns", lambda t, i: t["pos"] == i + 1))
    key = F.array_join(F.transform("turns", lambda t: F.lower(F.hex(t["digest"]))), "")
    found = lengths.join(rows, "conv", "left")
    return found.select("conv", "len", F.coalesce(key, F.lit("")).alias("key"), F.coalesce(F.transform("turns", lambda t: t["size"]), F.array().cast("array<long>")).alias("sizes"))


def common_turns(a: str, b: str) -> int:
    n = min(len(a), len(b)) // WIDTH
    return next((k for k in range(n) if a[k * WIDTH : (k + 1) * WIDTH] != b[k * WIDTH : (k + 1) * WIDTH]), n)


ADJACENT = "part int, at long, conv long, len long, lcp long, shared long, split int, cum array<long>, key string, row_len long"


def adjacent(rows: DataFrame) -> DataFrame:
    """Rows in sorted order: place in its part, LCP with the row before, bytes shared with it, whether the row before ends a leaf.

    The first row of a part doesn't know the row before; first and last rows carry their keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, before, pending = TaskContext.get().partitionId(), 0, None, None
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out.clear()
            return batch

        names = [x.split()[0] for x in ADJACENT.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.string(), pa.int64()]
        for batch in batches:
            for conv, length, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv", "len", "key", "sizes")), strict=True):
                cum = np.cumsum([0, *sizes]).tolist()
                if before is None:
                    out.append((part, n, conv, length, None, None, None, cum, key, length))
                else:
                    if pending is not None:
                        out.append(pending)
                    lcp = common_turns(*before[:1], key)
                    pending = (part, n, conv, length, lcp, cum[lcp], int(before[1] > lcp), cum, None, length)
                before = (key, length)
                n += 1
                if len(out) >= 2000:
                    yield made()
        if pending is not None:
            out.append((*pending[:8], before[0], pending[9]))
        if out:
            yield made()

    order = ["key", "more", "conv"]
    sorted_rows = rows.withColumn("more", F.col("len") * WIDTH > F.length("key")).repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_rows.select("conv", "len", "key", "sizes").mapInArrow(run, ADJACENT)


def ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """rank, conv, len, lcp, shared, split, cum; and how many."""
    rows = common.written(adjacent(rows), "adjacent")
    sizes = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a part
    ends: dict[int, list] = {}
    for r in rows.filter("key is not null").select("part", "at", "key", "row_len", "cum").collect():  # two rows a part
        ends.setdefault(r["part"], []).append(r)
    fixed, offset, before = [], 0, None
    for part in sorted(sizes):
        own = sorted(ends[part], key=lambda r: r["at"])
        lcp = common_turns(before["key"], own[0]["key"]) if before else -1
        fixed.append((part, offset, lcp, own[0]["cum"][lcp] if before else 0, int(before["row_len"] > lcp) if before else 0))
        offset, before = offset + sizes[part], own[-1]
    parts = F.broadcast(rows.sparkSession.createDataFrame(fixed, "part int, offset long, first_lcp long, first_shared long, first_split int"))  # one row a part
    found = rows.join(parts, "part").select(
        (F.col("offset") + F.col("at")).alias("rank"), "conv", "len", F.coalesce("lcp", "first_lcp").alias("lcp"),
        F.coalesce("shared", "first_shared").alias("shared"), F.coalesce("split", "first_split").alias("split"), "cum",
    )
    return found, offset


class Minima:
    """Sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            below, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place after ``start`` whose value is below ``depth``; n if none."""
        at = start + 1
        for k in range(len(self.levels) - 1, -1, -1):
            fits = at + (1 << k) <= self.n
            high = self.levels[k][np.where(fits, at, 0)] >= depth
            at = at + np.where(fits & high, 1 << k, 0)
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``start`` whose value is below ``depth``; -1 if none."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            first = at - (1 << k) + 1
            high = self.levels[k][np.maximum(first, 0)] >= depth
            at = at - np.where((first >= 0) & high, 1 << k, 0)
        return at

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value from ``first`` to ``last``; the largest integer where there is none."""
        found = np.full(len(first), np.iinfo(np.int64).max)
        length = last - first + 1
        for k, level in enumerate(self.levels):
            own = (length >= 1 << k) & (length < 2 << k)
            found[own] = np.minimum(level[first[own]], level[last[own] - (1 << k) + 1])
        return found


class Block:
    """Ranks of one block: their columns, and the candidate prefixes with their extents in the block."""

    def __init__(self, row: pa.StructScalar, next_lcp: int):
        values = row.values
        column = lambda name: values.field(name).to_numpy(zero_copy_only=False).astype(np.int64)
        self.convs, self.lens, self.lcps, self.shared, self.splits = map(column, ("conv", "len", "lcp", "shared", "split"))
        self.cum = values.field("cum")
        self.n = len(self.convs)
        self.nexts = np.append(self.lcps[1:], next_lcp)
        self.low, self.ids = Minima(self.lcps), Minima(self.convs)
        self.sums = [np.cumsum(np.append(0, c)) for c in (self.shared, self.splits)]
        # Candidates: what a rank shares with the one before, then each longer prefix that it shares with the one after.
        longer = np.maximum(self.nexts - self.lcps, 0)
        longer[(self.lcps < 0) & (longer == 0)] = 1  # the root
        self.owner = np.concatenate([np.arange(self.n), np.repeat(np.arange(self.n), longer)])
        steps = np.arange(longer.sum()) - np.repeat(np.cumsum(longer) - longer, longer) + 1
        self.depth = np.concatenate([self.lcps, np.repeat(self.lcps, longer) + steps])
        asked = self.depth >= 0
        self.own = np.r_[np.zeros(self.n, bool), np.ones(len(steps), bool)]  # the prefix's first rank is here
        self.l = np.where(asked, self.low.left(self.owner, self.depth), self.owner)
        self.r = np.where(asked, self.low.right(self.owner, self.depth) - 1, self.owner)

    def asks(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths whose searches leave the block to the left, and to the right."""
        asked = self.depth >= 0
        return np.unique(self.depth[asked & (self.l < 0)]), np.unique(self.depth[asked & (self.r == self.n - 1)])

    def stairs(self, side: str) -> tuple[list, ...]:
        """Values below all before (from the side where a search comes in), their places, and what lies between the side and there."""
        lcps = self.lcps if side == "right" else self.lcps[::-1]
        lowest = np.minimum.accumulate(lcps)
        at = np.flatnonzero(np.r_[True, lowest[1:] < lowest[:-1]])
        if side == "right":
            ids = np.r_[np.iinfo(np.int64).max, np.minimum.accumulate(self.convs)][at]
            return lcps[at], at, ids, self.sums[0][at], self.sums[1][at]
        ids = np.minimum.accumulate(self.convs[::-1])[at]
        return lcps[at], self.n - 1 - at, ids, np.zeros_like(at), np.zeros_like(at)


ASKS = "kind string, block long, depth long, target long, low array<long>, place array<long>, id array<long>, shared array<long>, split array<long>"
ANSWER = ("kind", "depth", "target", "place", "id", "shared", "split")
FOUND = ("rank long, conv long, len long, lcp long, next long, up_rank long, up_conv long, solo_parent long, "
         "nodes array<struct<depth: long, conv_id: long, n_convs: long, parent: long, leaves: long, saved: long>>")


def shared_prefixes(rows: DataFrame, n: int) -> DataFrame:
    """FOUND: per rank its place in the trie, and the nodes shared by several conversations that start there."""
    width = max(BLOCK, -(-n // MOST_BLOCKS))
    block = F.floor(F.col("rank") / width).alias("block")
    fields = F.struct("rank", "conv", "len", "lcp", "shared", "split", "cum")
    blocks = common.written(rows.groupBy(block).agg(F.sort_array(F.collect_list(fields)).alias("rows")), "blocks")
    least = lambda name: F.array_min(F.transform("rows", lambda r: r[name])).alias(name)
    total = lambda name: F.aggregate("rows", F.lit(0).cast("long"), lambda s, r: s + r[name])
    summary = blocks.select("block", least("lcp"), least("conv"), F.col("rows")[0]["lcp"].alias("first"), total("shared").alias("shared"), total("split").alias("split"))
    known = sorted(summary.collect())  # MOST_BLOCKS rows at most
    lows, ids = (Minima(np.array([r[k] for r in known], np.int64)) for k in ("lcp", "conv"))
    firsts = np.array([*(r["first"] for r in known), -1], np.int64)
    before = [np.cumsum([0, *(r[k] for r in known)]) for k in ("shared", "split")]
    last = len(known)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = Block(row, int(firsts[at + 1]))
                left, right = own.asks()
                targets = lows.left(np.full(len(left), at - 1), left), lows.right(np.full(len(right), at), right)
                n_asks = len(left) + len(right)
                arrays = [own.stairs("left"), own.stairs("right")]
                made = [["left"] * len(left) + ["right"] * len(right) + ["left stairs", "right stairs"], [at] * (n_asks + 2), [*left, *right, None, None], [*targets[0], *targets[1], None, None]]
                lists = [[None] * n_asks + [a[k].tolist() for a in arrays] for k in range(5)]
                kinds = [pa.string()] + [pa.int64()] * 3 + [pa.list_(pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made + lists, kinds, strict=True)], names=[x.split()[0] for x in ASKS.split(", ")])

    asked = common.written(blocks.mapInArrow(ask, ASKS), "asks")
    stairs = asked.filter("low is not null").select(F.split("kind", " ")[0].alias("kind"), F.col("block").alias("target"), "low", "place", "id", "shared", "split")
    step = F.size(F.filter("low", lambda v: v >= F.col("depth"))) + 1
    answers = asked.filter("low is null").select("kind", "block", "depth", "target").join(stairs, ["kind", "target"])
    answers = answers.select("block", "kind", "depth", "target", *[F.element_at(c, step).alias(c) for c in ("place", "id", "shared", "split")])
    answers = answers.groupBy("block").agg(F.collect_list(F.struct(*ANSWER)).alias("answers"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row, answer in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                yield extents(Block(row, int(firsts[at + 1])), at, answer or [])

    def extents(own: Block, at: int, answer: list[dict]) -> pa.RecordBatch:
        start, n_rows = at * width, own.n
        said = {(a["kind"], a["depth"]): a for a in answer}
        # Within the block; whatever leaves it goes on through whole blocks and the answered one.
        conv = own.ids.least(np.maximum(own.l, 0), own.r)
        l, r = start + own.l, start + own.r
        shared, split = (s[own.r + 1] - s[np.maximum(own.l, 0) + 1] for s in own.sums)
        for kind, leaves in (("left", own.l < 0), ("right", own.r == n_rows - 1)):
            for depth in np.unique(own.depth[leaves & (own.depth >= 0)]).tolist():
                these = leaves & (own.depth == depth)
                a = said.get((kind, depth))
                target = a["target"] if a else last
                between = (target + 1, at - 1) if kind == "left" else (at + 1, target - 1)
                more = int(ids.least(np.array([between[0]]), np.array([between[1]]))[0])
                conv[these] = np.minimum(conv[these], min(more, a["id"]) if a else more)
                if kind == "left":
                    l[these] = target * width + a["place"]
                    continue
                r[these] = target * width + a["place"] - 1 if a else n - 1
                shared[these] += before[0][target] - before[0][at + 1] + (a["shared"] if a else 0)
                split[these] += before[1][target] - before[1][at + 1] + (a["split"] if a else 0)
        up_rank, up_conv = l[:n_rows].copy(), conv[:n_rows].copy()
        known_up = own.lcps >= 0
        chain, cum = own.own, own.cum
        owner, depth = own.owner[chain], own.depth[chain]
        first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
        conv_id, members = conv[chain], (r - l + 1)[chain]
        parent = np.where(first, up_conv[owner], np.r_[0, conv_id[:-1]] if len(owner) else conv_id)
        no_parent = depth == 0
        flat, starts = cum.values.to_numpy(zero_copy_only=False), cum.offsets.to_numpy()
        above = np.where(no_parent, 0, flat[np.where(no_parent, 0, starts[owner] + depth - 1)]) if len(owner) else depth
        saved = shared[chain] - (members - 1) * above
        offsets = np.searchsorted(owner, np.arange(n_rows + 1))
        solo = up_conv.copy()
        has = offsets[1:] > offsets[:-1]
        solo[has] = conv_id[offsets[1:][has] - 1]
        nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(depth), pa.array(conv_id), pa.array(members), pa.array(parent, mask=no_parent), pa.array(1 + split[chain]), pa.array(saved)],
            ["depth", "conv_id", "n_convs", "parent", "leaves", "saved"]))
        columns = [np.arange(start, start + n_rows), own.convs, own.lens, own.lcps, own.nexts]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in columns), pa.array(up_rank, mask=~known_up), pa.array(up_conv, mask=~known_up), pa.array(solo), nodes],
            names=[x.split()[0] for x in FOUND.split(", ")[:8]] + ["nodes"])

    return blocks.join(answers, "block", "left").mapInArrow(find, FOUND)


def end_digests(rows: DataFrame) -> DataFrame:
    """rank, depth, ends: SHA-256 over the ids that end in each shared node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for rank, depth, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (rank, depth) != node:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (rank, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield made(done)
                done = []
        if node:
            yield made([(*node, digest.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["rank", "depth", "ends"])

    node = F.when(F.col("len") > F.col("lcp"), F.col("rank")).otherwise(F.col("up_rank"))
    ended = rows.filter("len <= greatest(lcp, next, 0)").select(node.alias("node"), F.col("len").alias("depth"), F.floor(F.col("rank") / BLOCK).alias("slice"), "conv")
    slices = ended.groupBy("node", "depth", "slice").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = slices.repartition("node", "depth").sortWithinPartitions("node", "depth", "slice")
    return ordered.select("node", "depth", "ids").mapInArrow(run, "rank long, depth long, ends string")


def trie(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: the columns of RESULT."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    turns = conversations.select(F.col(id_column).cast("long").alias("conv"), F.col(turn_column).alias("turn"), text(role_column).alias("role"), text(text_column).alias("text"))
    return trie_of(*rebuilt(numbered(turns.filter("conv is not null"))))


def trie_of(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of turns (conv, pos, digest, size) of conversations (conv, len)."""
    rows, n = ranked(keyed(turns, lengths))
    empty: Column = F.sha2(F.lit(""), 256)
    if not n:
        kinds = {"ends_sha256": "string"}
        return lengths.limit(0).select(*[F.lit(None).cast(kinds.get(c, "long")).alias(c) for c in RESULT])
    found = common.written(shared_prefixes(rows, n), "prefixes")
    children = found.filter("len > lcp and lcp >= 0").groupBy(F.col("up_rank").alias("rank"), F.col("lcp").alias("depth")).agg(F.count("*").alias("children"))
    nodes = found.select("rank", "len", F.explode("nodes").alias("node")).select("rank", "len", "node.*")
    nodes = nodes.join(children, ["rank", "depth"], "left").join(end_digests(found), ["rank", "depth"], "left")
    shared = nodes.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", (F.coalesce("children", F.lit(0)) + (F.col("len") > F.col("depth")).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", empty).alias("ends_sha256"),
    )
    # From where nothing is shared a conversation's nodes are a chain; it is dealt out in slices of depths.
    since = F.greatest("lcp", "next", F.lit(0)) + 1
    chains = found.select("conv", "len", since.alias("since"), "solo_parent").filter("since <= len")
    chains = chains.withColumn("at", F.explode(F.sequence("since", "len", F.lit(DEPTHS_A_SLICE)))).repartition("conv", "at")
    depths = chains.withColumn("depth", F.explode(F.sequence("at", F.least(F.col("at") + DEPTHS_A_SLICE - 1, "len"))))
    one, ended = F.lit(1).cast("long"), F.col("depth") == F.col("len")
    alone = depths.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("since"), F.col("solo_parent")).otherwise(F.col("conv")).alias("parent_conv_id"), one.alias("n_convs"),
        (~ended).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(ended, F.sha2(F.col("conv").cast("string"), 256)).otherwise(empty).alias("ends_sha256"),
    )
    return shared.unionByName(alone)


def trie_sql(table: str = "conversations") -> str:
    """DuckDB SQL for ``trie``: every node against every other that starts with it."""
    crc = "xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(c::VARCHAR, ''), lambda b: [ord(b), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"
    return f"""WITH own AS (
        SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, role, text
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table}) WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, c - c % 5 AS b, {crc} % 9 AS h, list({{'r': role, 't': text}} ORDER BY pos) AS turns FROM own GROUP BY c),
    built AS (SELECT a.c, list_concat(coalesce(b.turns, [])[1 : a.h], a.turns[a.h + 1 :]) AS turns FROM convs a LEFT JOIN convs b ON a.b = b.c),
    members AS (SELECT c, d, turns[1 : d] AS path, d = len(turns) AS ends FROM built, unnest(range(len(turns) + 1)) AS t(d)),
    nodes AS (
        SELECT path, d, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids,
            CASE WHEN d > 0 THEN (count(*) - 1) * strlen(path[-1].t) ELSE 0 END AS saved FROM members GROUP BY path, d),
    kids AS (SELECT path[1 : d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
    full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path, d)),
    below AS (
        SELECT path[1 : t.d] AS path, t.d AS d, sum(saved)::BIGINT AS saved, count(*) FILTER (n_children = 0) AS leaves
        FROM full_nodes f, unnest(range(f.d + 1)) AS t(d) GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, b.leaves AS n_leaves, b.saved AS saved_tokens, sha256(n.ids) AS ends_sha256
    FROM full_nodes n JOIN below b USING (path, d) LEFT JOIN nodes p ON p.path = n.path[1 : n.d - 1] AND p.d = n.d - 1"""
