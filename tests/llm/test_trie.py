from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lmtables.llm.prefix_trie import conversation_turns, prefix_trie
from lmtables.llm.queries import rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, id int, turns int, name int, mark int"
FIGURES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def spoken(rows):
    out = defaultdict(list)
    for key, turn, role, text in rows:
        if key is not None:
            out[key].append(((turn is not None, turn or 0), role or "", text or ""))
    return {k: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for k, v in out.items()}


def rebuilt_by_hand(said):
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = said.get(c - c % 100, [])[:h] + own[h:]
    return out


def by_hand(said):
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in said.items():
        ends[tuple(turns)].add(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node in members:
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        told = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), above, len(members[node]), len(children[node]),
                    sum(not children[n] for n in below), saved, told))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def found(trie):
    return sorted(map(tuple, trie.nodes.select(*FIGURES).collect()), key=repr)


def check(spark, rows, shards, **options):
    trie = prefix_trie(conversation_turns(table(spark, rows)), shards=shards, **options)
    said = spoken(rows)
    assert found(trie) == sorted(by_hand(said), key=repr)
    names = {r.name: r for r in trie.nodes.collect()}
    ended = {r.id: names[r.name].depth for r in trie.ends.collect()}
    assert ended == {c: len(t) for c, t in said.items()}


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_any_shards(spark, shards):
    draw = random.Random(7)
    rows = [(c, t, draw.choice("ua"), draw.choice(["", "x", "yy"])) for c in range(60) for t in range(draw.randrange(1, 6))]
    rows += [(c, t, "u", "hot") for c in range(100, 160) for t in range(3)]  # equal ones
    rows += [(c, 0, "u", "hot") for c in range(200, 230)] + [(c, 1, "a", f"{c}") for c in range(200, 230)]
    check(spark, rows, shards)


def test_equal_conversations_go_to_many_shards(spark):
    rows = [(c, t, "u", "same") for c in range(-30, 200) for t in range(2)]
    check(spark, rows, 7, ids_at_once=4)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, None, None, None), (1, 0, "u", "a"), (2, None, "", ""), (2, 0, "u", "a"), (2, 0, "u", "a"), (None, 0, "u", "z"),
            (3, 1, "u", "long " * 50_000), (4, 1, "u", "long " * 50_000), (5, 3, "ab", "c"), (6, 3, "a", "bc"),
            (7, 2, "u", "😀é"), (8, 2, "u", "😀é")]
    check(spark, rows, 5)
    assert prefix_trie(conversation_turns(table(spark, [])), shards=3).nodes.isEmpty()
    # Turns in a tie go by role, then by a digest of role and text: in one order, whatever the order of rows.
    tie = [(1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "z")]
    names = [{r.name for r in prefix_trie(conversation_turns(table(spark, t)), shards=2).nodes.collect()} for t in (tie, tie[::-1])]
    assert names[0] == names[1]


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(5, 0, "u", "a"), (105, 0, "u", "b"), (200, 0, "u", "c"), (230, 0, "u", "d")]
    rows += [(c, t, "u", f"{t}") for c in range(300, 420) for t in range(c % 5)]
    said = rebuilt_by_hand(spoken(rows))
    assert any(not turns for turns in said.values())
    trie = prefix_trie(rebuilt(conversation_turns(table(spark, rows))), shards=4)
    assert found(trie) == sorted(by_hand(said), key=repr)


def test_given_conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    said = rebuilt_by_hand(spoken([(r.conv_id, r.turn, r.role, r.text) for r in given.collect()]))
    assert found(prefix_trie(rebuilt(conversation_turns(given)))) == sorted(by_hand(said), key=repr)
