"""The prefix trie against plain dictionaries, and its roll-up against a plain walk."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from checks.compare import differences
from kitchenlight.llm import trie as T
from kitchenlight.llm.oracles import OP12_TRIE
from kitchenlight.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key binary, size int"


def plain(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: t[0])
    rebuilt = {}
    for conv, turns in convs.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = list(convs[conv - conv % 100]) if conv - conv % 100 in convs else []
        rebuilt[conv] = [t[1:] for t in base[:h] + turns[h:]]
    holders, children = defaultdict(list), defaultdict(int)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            holders[tuple(turns[:d])].append(conv)
    for node in holders:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in holders.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, held in holders.items():
        ends = ",".join(map(str, sorted(c for c in held if len(rebuilt[c]) == len(node))))
        parent = min(holders[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, count=120):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(1000), count):  # many bases are absent
        for turn in range(rng.randrange(1, 9)):
            text = "hello" if turn == 0 and conv % 3 else rng.choice(["a", "bé", "", None, "𝄞c"])
            rows.append((conv, turn if turn else None, rng.choice(["user", None]) if turn else "user", text))
    for turn in range(300):  # one conversation holds a third of all rows
        rows.append((999_999, turn, "user", "long"))
        if turn < 250:
            rows.append((999_998, turn, "user", "long"))
    rows += [(c, t, "user", "copy") for c in range(5000, 5040) for t in range(7)]
    rows += [(None, 1, "user", "nobody"), (100, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", b"", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("local_nodes", [20_000, 40, 1])
def test_nodes_equal_plain_dictionaries(spark, local_nodes):
    rows = conversations(local_nodes) if local_nodes > 1 else [r for r in conversations(5, 30) if r[1] is None or r[1] < 12]
    got = sorted((tuple(r) for r in T.prefix_trie(frame(spark, rows), local_nodes).collect()), key=str)
    assert got == plain(rows)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "forest", "alone"])
def test_roll_up_in_one_task_equals_a_walk(shape):
    rng = random.Random(shape)
    count = 1 if shape == "alone" else 400
    parent = np.array([-1] + [{"random": rng.randrange(i), "chain": i - 1, "star": 0, "forest": rng.choice([-1, rng.randrange(i)]), "alone": 0}[shape] for i in range(1, count)])
    values = np.array([[rng.randrange(9), rng.randrange(9)] for _ in range(count)])
    want, size = values.copy(), np.ones(count, np.int64)
    for i in range(count - 1, 0, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
            size[parent[i]] += size[i]
    assert (T.rolled_up(parent, size, values) == want).all()


def test_no_rows_no_nodes(spark):
    assert T.prefix_trie(frame(spark, [])).count() == 0
    assert T.prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_repeated_rows_are_turns(spark):
    rows = [(7, 1, "user", "x")] * 8
    got = sorted((tuple(r) for r in T.prefix_trie(frame(spark, rows)).collect()), key=str)
    assert got == plain(rows)


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(conv, t, "user", "x") for t in range(3)]
    got = [tuple(r) for r in T.prefix_trie(frame(spark, rows)).collect()]
    assert got == plain(rows) and got[0][:6] == (conv, 0, None, 1, 0, 1)


def test_query_equals_its_sql(spark):
    assert differences(QUERIES["op12_trie"](spark, SMALL), SMALL, OP12_TRIE) == ""
