import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from mailsieve.llm import prefix_trie as T
from mailsieve.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos string, digest int, rep long"


def plain(rows):
    """Nodes of the trie, straight from the definition."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    members = defaultdict(list)
    for c in own:
        rest = abs(c) % 5 * (1 if c >= 0 else -1)  # the sign of the dividend, as in SQL
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - rest, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[x] for x in below)
    smallest = {path: min(c for c, _ in found) for path, found in members.items()}
    return sorted(
        (
            smallest[path],
            len(path),
            smallest[path[:-1]] if path else None,
            len(found),
            len(children[path]),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(c for c, end in found if end))).encode()).hexdigest(),
        )
        for path, found in members.items()
    )


def found(frame):
    return sorted(map(tuple, frame.collect()))


def frame_of(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).repartition(parts)


def test_query_equals_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(op13_prefix_trie(spark, small)) == plain(map(tuple, rows))


def random_rows(seed, convs=160):
    """Shared beginnings, many copies, long common prefixes and a very long conversation."""
    draw = random.Random(seed)
    rows = []
    for c in range(-12, convs):
        kind = draw.random()
        if kind < 0.3:
            texts = ["hello", "same", "same too", "end"]
        elif kind < 0.6:
            texts = ["hello", *[f"shared {i}" for i in range(30)], *[draw.choice("xyz") for _ in range(draw.randrange(4))]]
        elif kind < 0.65:
            texts = [f"long {i}" for i in range(200)] + [draw.choice("ab")]
        else:
            texts = [draw.choice(["hello", "é" * 5, "", "bye"]) for _ in range(draw.randrange(1, 7))]
        rows += [(c, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(texts)]
    return rows


@pytest.mark.parametrize("limit", [1, 40, 1 << 10])
def test_every_limit_gives_the_same_trie(spark, limit):
    """Bursts, jumps, chains and sweeps all take part at the small limits."""
    rows = random_rows(limit)
    assert found(T.prefix_trie(frame_of(spark, rows), limit=limit)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (0, None, "user", "first"), (0, 3, None, None), (0, 3, None, None), (0, 3, "a", ""),
        (0, 3, "", "z"), (1, 0, "user", "first"), (1, 0, "user", "FIRST"), (7, 2, "user", "x" * 100_000),
        (10**18, 0, "user", "big"), (-(10**18) - 3, 0, "user", "big"), (3, 0, "user", "only"), (4, 0, "user", "only"),
    ]
    assert found(T.prefix_trie(frame_of(spark, rows))) == plain(rows)
    assert found(T.prefix_trie(frame_of(spark, rows).limit(0))) == []
    # Conversation 3 has one turn and takes its place from a conversation that is not there.
    lone = [(c, 0, "user", "only") for c in (3, 4, 13)]
    assert found(T.prefix_trie(frame_of(spark, lone))) == plain(lone)


def test_ranges_split_a_conversation_of_most_rows(spark):
    rows = [(5, i // 2, "user", f"t{i % 7}") for i in range(3000)] + [(c, 0, "user", "t0") for c in range(100)]
    turns = T.numbered_turns(frame_of(spark, rows, 9))
    mine = sorted((r.pos, r.size) for r in turns.where("conv = 5").collect())
    assert [p for p, _ in mine] == list(range(3001))
    assert found(T.prefix_trie(frame_of(spark, rows))) == plain(rows)


def test_ids_beyond_one_run(spark, monkeypatch):
    monkeypatch.setattr(T, "RUN", 3)
    rows = [(c, 0, "user", "same") for c in range(0, 500, 5)]
    nodes = found(T.prefix_trie(frame_of(spark, rows)))
    assert nodes == plain(rows) and len(nodes) <= 3
