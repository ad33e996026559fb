"""The conversation trie against walking every prefix of every conversation."""

import hashlib
import random
import zlib

import pytest

from martlet.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, c int"
FIGURES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            r, t = role or "", text or ""
            tie = hashlib.md5(f"{len(r)} {r}{t}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, r, t))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        saved[path] = sum(saved[p] for p in below) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path))))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children.get(path, [])),
                    leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    found = prefix_trie.conversation_trie(frame, **options)
    assert found.columns == FIGURES
    return sorted(map(tuple, found.collect()), key=str)


def some_rows(seed, convs, length, words=3):
    rnd = random.Random(seed)
    ids = rnd.sample(range(-150, 450), convs)
    return [(c, rnd.choice([None, t, t, t // 2]), rnd.choice(["user", "assistant", None]), rnd.choice([None, "", *["é" * k for k in range(words)]]))
            for c in ids for t in range(rnd.choice([1, 2, length]))]


@pytest.mark.parametrize("seed, width, chunk", [(1, 8, 4096), (2, 3, 2), (3, 1, 4096)])
def test_every_node_of_random_conversations(spark, monkeypatch, seed, width, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = some_rows(seed, 60, 19)
    assert got(spark, rows, width=width) == brute(rows)


def test_copies_a_long_conversation_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rows = [(c, t, "user", f"same {t}") for c in range(1000, 1060) for t in range(4)]
    rows += [(2000, t, "user", "again") for t in range(300)] + [(2001, None, None, None)] * 5
    rows += [(None, 1, "user", "lost"), (2105, 0, "user", "alone"), (2110, 3, "x" * 3000, "long " * 4000)]
    assert got(spark, rows) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(turnless, 0, "user", "gone")]
    assert got(spark, rows) == brute(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_no_conversation_no_node(spark):
    assert got(spark, []) == [] == got(spark, [(None, 0, "user", "x")])


def test_a_conversation_of_a_third_of_all_rows_spreads_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check_spread(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def check_spread(spark):
    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, -7, id) conv_id", "null turn", "'user' role", "'t' text")
    turns = prefix_trie.turn_table(rows)
    parts = prefix_trie.local_positions(turns).filter("c = -7").groupBy("part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 15_000
    assert sorted(r[0] for r in prefix_trie.positions(turns).filter("c = -7").select("at").collect()) == list(range(1, 20_001))
