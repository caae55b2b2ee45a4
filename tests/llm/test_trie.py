"""The prefix trie against a walk over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, block string"


def brute(rows) -> Counter:
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t for *_, t in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    ends = defaultdict(list)
    for c, path in paths.items():
        ends[path].append(c)
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def result(df) -> Counter:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r[n] for n in names) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(2)
    lines = ["", "hi", "ünïcode 😀", "what", "so"]
    rows = []
    for conv in [*range(0, 12), *range(100, 130), 200, 205, -3, -100, -101, 431, 432]:
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, turn, rng.choice(["user", None, "assistant"]), rng.choice(lines) if turn > 2 else lines[conv % 2]))
    rows += [(300 + i, t, "user", "same") for i in range(40) for t in range(9)]  # copies
    rows += [(500, t, "user", f"long {t % 7}") for t in range(70)]  # one long conversation
    rows += [(501, None, "user", "first"), (501, 3, None, None), (501, 5, "user", "x" * 5000), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return [(*r, "c", "c", "c") for r in rows]


@pytest.mark.parametrize("width", [3, trie.WIDTH])
def test_trie_matches_brute_force(spark, talks, tmp_path, monkeypatch, width):
    monkeypatch.setattr(trie, "WIDTH", width)
    spark.createDataFrame(talks, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = result(queries.op13_prefix_trie(spark, str(tmp_path)))
    assert got == brute(talks) and sum(got.values()) > 200


def test_repeated_turns_and_no_rows(spark, tmp_path):
    rows = [(7, 1, "user", "a", "", "", "")] * 3 + [(8, 1, "user", "a", "", "", "")]
    turns = trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r["conv"], r["pos"]) for r in turns.collect()) == [(7, 1), (7, 2), (7, 3), (8, 1)]
    nodes = trie.trie(turns, turns.select("conv").distinct())
    assert sorted((r["depth"], r["n_convs"], r["n_leaves"]) for r in nodes.collect()) == [(0, 2, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1)]
    empty = trie.numbered_turns(spark.createDataFrame([], SCHEMA))
    assert trie.trie(*trie.with_shared_openings(empty)).count() == 0


def test_running_values_do_not_depend_on_the_cuts(spark, monkeypatch):
    rows = [(k, i, (i * 37 + k) % 11) for k in range(3) for i in range(50)]
    frame = spark.createDataFrame(rows, "k long, i long, v long")
    expected = {(k, i): sum(v for k2, j, v in rows if k2 == k and j < i) for k, i, _ in rows}
    for width in (2, 7, 100):
        monkeypatch.setattr(trie, "WIDTH", width)
        got = trie.running(frame, "k", "i", {"s": "v"}, F.sum, Column.__add__).collect()
        assert {(r["k"], r["i"]): r["s"] for r in got} == expected
