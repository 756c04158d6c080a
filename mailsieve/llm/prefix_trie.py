"""The trie of conversation prefixes, built as a burst trie.

A node of depth d is a distinct sequence of the first d turns; its members are the conversations
that begin with it. Its name is (smallest member, depth), which no other node has.

1. ``rebuild`` numbers the turns of each conversation and swaps in the first turns of another one.
   From there on a turn is a digest of role and text with the text's length: texts stay behind.
2. Equal sequences become one class with a weight. Sequences are compared by sums of hashes of
   (position, digest), which are added up map-side, so neither a conversation of very many turns
   nor a sequence of very many copies meets in one task.
3. A container holds the suffixes of the classes under one trie head; the root's comes first. A
   container of more than ``limit`` turns is burst: its head becomes a trie node, its suffixes go
   to one container per next turn. A container that stays whole while it is burst jumps to the end
   of what all its suffixes share, so a long common beginning costs one round and not one per turn.
4. Containers of one suffix are a chain of nodes, which each turn states on its own. All others
   hold ``limit`` turns at most: they are sorted and swept, the stack of open nodes giving
   members, children, leaves and savings of each node as it closes.
5. Sums of subtrees go up from the containers through the burst heads, round by round.

The list of members that end at a node is hashed in order of their numbers: sorted in ranges,
joined in runs of ``RUN`` ids, and the runs of one class hashed one after the other, as SHA-256
demands; the task that does so holds one run at a time.

Defined results: rows without a conversation id belong to none and are left out; a null role or
text is empty; turns come in order of their number, null first, then of role and text; equal rows
are turns of their own; a conversation left without turns is a member of the root only; an empty
table gives an empty result; extra columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import map_arrow, written
from mailsieve.llm.ranges import running_before

LIMIT = 1 << 10
RUN = 1 << 12
EVERY = 5
SWAPS = 9
_NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep", "end_weight",
]
_NODE_KINDS = ", ".join(f"{name} bigint" for name in _NODE)


# --- turns ------------------------------------------------------------------


def numbered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv, digest, size (bytes of the text) and pos (from 0) of each turn."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("conv"),
        conversations[turn_col].alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
    )
    narrow = written(rows.drop("role", "text"), "turn-digests")
    order = [F.col("turn")]
    # Texts travel only if turns of one number have to be put in order by them.
    tied = narrow.groupBy("conv", "turn").agg((F.min("digest") != F.max("digest")).alias("tied")).where("tied")
    if not tied.isEmpty():
        narrow, order = rows, [*order, F.col("role"), F.col("text")]
    return running_before(narrow, "conv", order, "one", ["conv", "digest", "size"], "pos")


def donor(conv: Column, every: int = EVERY) -> Column:
    return conv - conv % every


def swapped(conv: Column, swaps: int = SWAPS) -> Column:
    """How many first turns are taken from the donor."""
    return F.crc32(conv.cast("string")) % swaps


def rebuild(turns: DataFrame, every: int = EVERY, swaps: int = SWAPS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv, pos, digest, size), and all conversations (conv, n)."""
    turns = written(turns, "turns")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    plan = sizes.select("conv", "own", donor(F.col("conv"), every).alias("donor"), swapped(F.col("conv"), swaps).alias("swaps"))
    given = sizes.select(F.col("conv").alias("donor"), F.col("own").alias("given"))
    plan = written(
        plan.join(given, "donor", "left").select(
            "conv", "donor", "swaps", "own", F.least("swaps", F.coalesce("given", F.lit(0))).alias("taken")
        ),
        "rebuilding",
    )
    later = turns.join(plan.select("conv", "swaps", "taken"), "conv").where("pos >= swaps").select(
        "conv", (F.col("pos") - F.col("swaps") + F.col("taken")).alias("pos"), "digest", "size"
    )
    first = turns.where(F.col("pos") < swaps).withColumnRenamed("conv", "donor")
    first = first.join(plan.where("taken > 0").select("conv", "donor", "swaps"), "donor").where("pos < swaps")
    rebuilt = later.unionByName(first.select("conv", "pos", "digest", "size"))
    lengths = plan.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("swaps"), F.lit(0))).alias("n"))
    return written(rebuilt, "rebuilt-turns"), lengths


# --- classes of equal sequences ---------------------------------------------


def _classes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes (rep, weight, n), and members (conv, rep) of those with more than one."""
    marks = [F.sum(F.xxhash64(F.lit(i), "pos", "digest").cast("decimal(38,0)")).alias(f"mark{i}") for i in (1, 2)]
    keyed = lengths.join(turns.groupBy("conv").agg(*marks), "conv", "left").select(
        "conv", "n", *[F.coalesce(f"mark{i}", F.lit(0).cast("decimal(38,0)")).alias(f"mark{i}") for i in (1, 2)]
    )
    keyed = written(keyed, "sequence-keys")
    key = ["n", "mark1", "mark2"]
    classes = written(
        keyed.groupBy(*key).agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight")), "sequence-classes"
    )
    members = keyed.join(classes.where("weight > 1"), key).select("conv", "rep")
    return classes.select("rep", "weight", "n"), members


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (rep, conv) to runs of one class: rep, first, ids joined by commas."""
    for batch in batches:
        reps, convs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.union1d(np.flatnonzero(reps[1:] != reps[:-1]) + 1, np.arange(0, len(reps), RUN))
        edges = [*cuts.tolist(), len(reps)]
        runs = [(int(reps[a]), int(convs[a]), ",".join(map(str, convs[a:b].tolist()))) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        columns = zip(*runs, strict=True) if runs else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["rep", "first", "ids"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by class and first id to one hash per class."""
    rep, state = None, None

    def closed(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], ["rep", "ends_sha256"]
        )

    for batch in batches:
        found = []
        for row_rep, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if row_rep != rep:
                if state is not None:
                    found.append((rep, state.hexdigest()))
                rep, state = row_rep, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield closed(found)
    if state is not None:
        yield closed([(rep, state.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """rep and ends_sha256 of classes with more than one member."""
    dealt = members.select("rep", "conv").repartitionByRange("rep", "conv").sortWithinPartitions("rep", "conv")
    runs = map_arrow(dealt, _runs, "rep bigint, first bigint, ids string")
    gathered = runs.repartition("rep").sortWithinPartitions("rep", "first")
    return map_arrow(gathered, _hashed, "rep bigint, ends_sha256 string")


# --- containers -------------------------------------------------------------


def _jumped(stuck: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Containers that did not split, with their heads at the end of what all suffixes share.

    Returns their members at the new depth, and the nodes passed: conv_id, depth,
    parent_conv_id, n_convs, size, to (depth of the new head), old (the old head).
    """
    long = stuck.select("rep", "m", "depth").join(turns, (F.col("conv") == F.col("rep")) & (F.col("pos") >= F.col("depth")))
    leader = long.where("rep = m").select("m", "pos", F.col("digest").alias("lead"), F.col("size").alias("lead_size"))
    # A member whose sequence goes on after the leader's end is covered by the shortest length.
    differ = long.select("m", "pos", "digest").join(leader, ["m", "pos"]).where("digest != lead")
    shared = stuck.groupBy("m").agg(F.min("n").alias("shortest"), F.sum("weight").alias("n_convs"))
    ends = written(
        shared.join(differ.groupBy("m").agg(F.min("pos").alias("split")), "m", "left").select(
            "m", "n_convs", F.least("shortest", F.coalesce("split", "shortest")).alias("to")
        ),
        "jumps",
    )
    moved = stuck.join(ends.select("m", "to"), "m")
    heads = moved.where("rep = m")
    between = heads.select("m", "depth", "parent_m", "size", "to")
    # The old head, then one node per shared turn but the last, which is the new head's.
    chain = (
        between.where("to > depth").select(
            F.col("m").alias("conv_id"), "depth", F.col("parent_m").alias("parent_conv_id"), "size", "to", F.lit(True).alias("old")
        )
        .unionByName(
            leader.join(between.select("m", "depth", "to"), "m")
            .where("pos + 1 < to")
            .select(
                F.col("m").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("m").alias("parent_conv_id"),
                F.col("lead_size").alias("size"), "to", F.lit(False).alias("old"),
            )
        )
        .join(ends.select(F.col("m").alias("conv_id"), "n_convs"), "conv_id")
    )
    last = leader.join(ends.select("m", F.col("to")), "m").where("pos + 1 = to").select("m", F.col("lead_size").alias("new_size"))
    members = moved.join(last, "m", "left").select(
        "rep", "weight", "n", "m",
        F.col("to").alias("depth"),
        F.when(F.col("to") > F.col("depth"), F.col("m")).otherwise(F.col("parent_m")).alias("parent_m"),
        F.when(F.col("to") > F.col("depth"), F.col("new_size")).otherwise(F.col("size")).alias("size"),
    )
    return written(members, "jumped"), written(chain, "jump-nodes")


_MEMBER = ["rep", "weight", "n", "m", "depth", "parent_m", "size"]


def _burst(active: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Burst every container of ``active``: its heads as nodes, and its members one turn deeper."""
    stepped = written(
        active.join(turns.select(F.col("conv").alias("rep"), F.col("pos").alias("depth"), "digest", F.col("size").alias("next_size")), ["rep", "depth"]),
        "next-turns",
    )
    groups = written(
        stepped.groupBy("m", "depth", "digest").agg(
            F.min("rep").alias("child"),
            F.count(F.lit(1)).alias("members"),
            F.sum(F.col("n") - F.col("depth")).alias("turns"),
        ),
        "containers",
    )
    children = groups.groupBy("m", "depth").agg(F.count(F.lit(1)).alias("n_children"))
    heads = active.groupBy("m", "depth").agg(
        F.min("parent_m").alias("parent_conv_id"),
        F.max("size").alias("size"),
        F.sum("weight").alias("n_convs"),
        F.count(F.lit(1)).alias("members"),
        # One class at most ends at a node: classes are distinct.
        F.max(F.when(F.col("n") == F.col("depth"), F.struct("rep", "weight"))).alias("end"),
    )
    nodes = written(
        heads.join(children, ["m", "depth"], "left").select(
            F.col("m").alias("conv_id"), "depth", "parent_conv_id", "size", "n_convs", "members",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("end.rep").alias("end_rep"), F.col("end.weight").alias("end_weight"),
        ),
        "burst-heads",
    )
    whole = nodes.select(F.col("conv_id").alias("m"), "depth", F.col("members").alias("before"))
    sized = groups.join(whole, ["m", "depth"])
    deeper = stepped.join(sized, ["m", "depth", "digest"]).select(
        "rep", "weight", "n", F.col("child").alias("m"), (F.col("depth") + 1).alias("depth"), F.col("m").alias("parent_m"),
        F.col("next_size").alias("size"), "members", "turns", (F.col("members") == F.col("before")).alias("whole"),
    )
    return nodes, written(deeper, "members")


# --- sweep ------------------------------------------------------------------


class _Open:
    """A node of a container while it is swept."""

    __slots__ = ("children", "convs", "end", "leaves", "parent", "place", "rep", "saved", "size")

    def __init__(self, place: int, parent: _Open | None, size: int):
        self.place, self.parent, self.size = place, parent, size
        self.children = self.convs = self.leaves = self.saved = 0
        self.rep, self.end = None, (None, None)

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.convs - 1) * self.size
        if self.parent is not None:
            up = self.parent
            up.children += 1
            up.convs += self.convs
            up.leaves += self.leaves
            up.saved += self.saved
            up.rep = self.rep if up.rep is None else min(up.rep, self.rep)


def sweep(suffixes: list[tuple[int, int, list[bytes], list[int]]]) -> list[_Open]:
    """Nodes of one container from its sorted suffixes (rep, weight, digests, sizes), all of
    which begin with the head's own turn."""
    nodes: list[_Open] = []
    stack: list[_Open] = []
    before: list[bytes] = []
    for rep, weight, path, sizes in suffixes:
        common = 0
        for a, b in zip(before, path, strict=False):
            if a != b:
                break
            common += 1
        while len(stack) > common:
            stack.pop().close()
        for place in range(common, len(path)):
            stack.append(_Open(place, stack[-1] if stack else None, sizes[place]))
            nodes.append(stack[-1])
        top = stack[-1]
        top.end, top.convs = (rep, weight), top.convs + weight
        top.rep = rep if top.rep is None else min(top.rep, rep)
        before = path
    while stack:
        stack.pop().close()
    return nodes


def _sweeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by container and path; a container may go on in the next batch."""

    def rows(key: tuple, suffixes: list) -> list[tuple]:
        _, depth, parent = key
        return [
            (x.rep, depth + x.place, x.parent.rep if x.parent else parent, x.convs, x.children, x.leaves, x.saved, *x.end)
            for x in sweep(suffixes)
        ]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * len(_NODE)
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], _NODE)

    key, held = None, []
    for batch in batches:
        found = []
        for m, depth, parent, *suffix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (m, depth, parent) != key:
                if held:
                    found += rows(key, held)
                key, held = (m, depth, parent), []
            held.append(suffix)
        yield batch_of(found)
    if held:
        yield batch_of(rows(key, held))


def _swept(labelled: DataFrame) -> DataFrame:
    """Nodes of containers of at most ``limit`` turns."""
    suffixes = (
        labelled.groupBy("m", "depth", "parent_m", "rep", "weight")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "size"))).alias("suffix"))
        .select("m", "depth", "parent_m", "rep", "weight", F.col("suffix.digest").alias("path"), F.col("suffix.size").alias("sizes"))
    )
    dealt = suffixes.repartition("m", "depth").sortWithinPartitions("m", "depth", "path")
    return map_arrow(dealt, _sweeper, _NODE_KINDS)


def _chains(labelled: DataFrame) -> DataFrame:
    """Nodes of containers of one suffix: one per turn, from the head on.

    Only a suffix that stands for copies saves anything: what lies below a turn is the whole
    less what lies before it.
    """
    none = F.lit(None).cast("long")
    last, head = F.col("pos") + 1 == F.col("n"), F.col("pos") == F.col("depth") - 1
    columns = [
        F.col("rep").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        F.when(head, F.col("parent_m")).otherwise(F.col("rep")).alias("parent_conv_id"),
        F.col("weight").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.when(last, F.col("rep")).otherwise(none).alias("end_rep"),
        F.when(last, F.col("weight")).otherwise(none).alias("end_weight"),
    ]
    alone = labelled.where("weight = 1").withColumn("saved_tokens", F.lit(0).cast("long"))
    copies = labelled.where("weight > 1")
    keep = ["rep", "weight", "n", "depth", "parent_m", "pos"]
    before = running_before(copies, "rep", [F.col("pos")], "size", keep, "before")
    whole = copies.groupBy("rep").agg(F.sum("size").alias("whole"))
    shared = before.join(whole, "rep").withColumn(
        "saved_tokens", (F.col("weight") - 1) * (F.col("whole") - F.col("before"))
    )
    return alone.select(*columns).unionByName(shared.select(*columns))


def _chain_sums(chain: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes passed by a jump, with the sums of the heads they lead to; ``old`` marks old heads."""
    keep = ["conv_id", "depth", "parent_conv_id", "size", "to", "n_convs", "old"]
    before = running_before(chain, "conv_id", [F.col("depth")], "size", keep, "before")
    whole = chain.groupBy("conv_id").agg(F.sum("size").alias("whole"))
    led = heads.select("conv_id", F.col("depth").alias("to"), "n_leaves", F.col("saved_tokens").alias("below"))
    none = F.lit(None).cast("long")
    return before.join(whole, "conv_id").join(led, ["conv_id", "to"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("whole") - F.col("before"))).alias("saved_tokens"),
        none.alias("end_rep"), none.alias("end_weight"), "old", "to",
    )


# --- the trie ---------------------------------------------------------------


def trie(turns: DataFrame, lengths: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``turns`` (conv, pos, digest, size) and ``lengths`` (conv, n) as
    ``rebuild`` gives them; no container above ``limit`` turns is swept in one piece."""
    classes, members = _classes(turns, lengths)
    ends = _ends(members)
    # Copies need no turns of their own.
    turns = written(turns.join(classes.select(F.col("rep").alias("conv")), "conv", "left_semi"), "class-turns")
    smallest = classes.agg(F.min("rep").alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not smallest.n:
        return _finished(turns.sparkSession.createDataFrame([], _NODE_KINDS), ends)
    active = classes.select(
        "rep", "weight", "n",
        F.lit(smallest.m).cast("long").alias("m"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_m"), F.lit(0).cast("long").alias("size"),
    )
    rounds, leaves = [], None
    while True:
        nodes, deeper = _burst(active, turns)
        alone, small = F.col("members") == 1, F.col("turns") <= limit
        settled = deeper.where(alone | small).withColumn("round", F.lit(len(rounds)))
        leaves = settled if leaves is None else leaves.unionByName(settled)
        over = deeper.where(~alone & ~small)
        if over.isEmpty():
            rounds.append((nodes, None))
            break
        active, chain, stuck = over.where("not whole").select(*_MEMBER), None, over.where("whole").select(*_MEMBER)
        if not stuck.isEmpty():
            jumped, chain = _jumped(stuck, turns)
            active = active.unionByName(jumped)
        rounds.append((nodes, chain))

    leaves = written(leaves.drop("size"), "leaf-containers")
    labelled = written(
        leaves.join(turns.withColumnRenamed("conv", "rep"), "rep").where("pos >= depth - 1"), "leaf-turns"
    )
    found = [
        written(
            _chains(labelled.where("members = 1")).unionByName(_swept(labelled.where("members > 1"))), "leaf-nodes"
        )
    ]
    # Heads of containers pass their sums to the burst node above, those to the one above them.
    up = ["parent_conv_id", "depth", "n_leaves", "saved_tokens"]
    heads = leaves.where("rep = m").select(F.col("m").alias("conv_id"), "depth", "round")
    from_leaves = written(found[0].join(heads, ["conv_id", "depth"]).select(*up, "round"), "leaf-heads")
    from_heads = None
    for i in reversed(range(len(rounds))):
        nodes, chain = rounds[i][0], rounds[i - 1][1] if i else None
        below = from_leaves.where(F.col("round") == i).select(*up)
        below = below if from_heads is None else below.unionByName(from_heads)
        below = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below")
        )
        full = nodes.join(below, ["conv_id", "depth"], "left").select(
            *_NODE[:5],
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("size") + F.coalesce("below", F.lit(0))).alias("saved_tokens"),
            *_NODE[7:],
        )
        full = written(full, "burst-nodes")
        found.append(full)
        from_heads = full.select(*up)
        if chain is not None:
            # Heads that jumped reach the burst node through the nodes they passed.
            passed = written(_chain_sums(chain, full), "passed-nodes")
            found.append(passed.select(*_NODE))
            jumped = passed.where("old").select("conv_id", F.col("to").alias("depth"))
            direct = full.join(jumped, ["conv_id", "depth"], "left_anti")
            from_heads = direct.select(*up).unionByName(passed.where("old").select(*up))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _finished(every, ends)


def _finished(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes with the hash of the members that end there. A single member needs no join."""
    one = F.sha2(F.coalesce(F.col("end_rep").cast("string"), F.lit("")), 256).alias("ends_sha256")
    plain = nodes.where("end_weight is null or end_weight = 1").select(*_NODE[:7], one)
    shared = nodes.where("end_weight > 1").join(ends, F.col("end_rep") == F.col("rep"))
    return plain.unionByName(shared.select(*_NODE[:7], "ends_sha256"))


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    every: int = EVERY,
    swaps: int = SWAPS,
    limit: int = LIMIT,
) -> DataFrame:
    """The trie of all rebuilt conversations; see ``trie`` for its columns."""
    turns = numbered_turns(conversations, conv_col, turn_col, role_col, text_col)
    return trie(*rebuild(turns, every, swaps), limit)
