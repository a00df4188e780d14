from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lmtables.llm.merkle import ARITY, LEVELS, Appender, fold, folded, height, leaf_digest, manifest

SCHEMA = "source string, id long, digest binary, extra string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_by_hand(nodes):
    """Levels of a tree of hex digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def siblings_by_hand(levels, place):
    out = []
    for nodes in levels[:-1]:
        run = place // 16 * 16
        out += [nodes[i] for i in range(run, min(run + 16, len(nodes))) if i != place]
        place //= 16
    return out


def by_hand(rows):
    grouped = {}
    for source, id_, digest, _ in rows:
        grouped.setdefault(source, []).append((id_ is not None, id_ or 0, digest.hex()))
    order = sorted(grouped, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_by_hand([d for *_, d in sorted(grouped[s])]) for s in order}
    top = tree_by_hand([trees[s][-1][0] for s in order])
    out = []
    for spot, source in enumerate(order):
        for place, (known, id_, digest) in enumerate(sorted(grouped[source])):
            proof = siblings_by_hand(trees[source], place) + siblings_by_hand(top, spot)
            out.append((source, id_ if known else None, digest, trees[source][-1][0], "".join(proof)))
    return top[-1][0] if rows else None, out


def check(spark, rows, levels=LEVELS):
    made = manifest(spark.createDataFrame(rows, SCHEMA), levels=levels)
    got = made.witnesses.select(
        "source", "id", *(F.lower(F.hex(c)).alias(c) for c in ("digest", "subroot", "siblings")), "extra"
    ).collect()
    root, want = by_hand(rows)
    assert (made.root.hex() if made.root else None) == root
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    proofs = folded(made.witnesses, "digest", made.sources, keep=["id", "extra"]).collect()
    assert all(r.folded_root == root for r in proofs) and len(proofs) == len(rows)
    assert sorted(r.proof_sha256 for r in proofs) == sorted(h(w[-1]) for w in want)


def leaf(i):
    return hashlib.sha256(str(i).encode()).digest()


@pytest.mark.parametrize("count", [1, 2, 15, 16, 17, 33, 256, 257, 600])
def test_one_block(count):
    leaves = [leaf(i) for i in range(count)]
    tree = Appender(True)
    for digest in leaves:
        tree.append(digest)
    root = tree.close(height(count))
    levels = tree_by_hand([d.hex() for d in leaves])
    assert root.hex() == levels[-1][0]
    for place, witness in enumerate(tree.witnesses):
        assert bytes(witness).hex() == "".join(siblings_by_hand(levels, place))
        assert fold(leaves[place], bytes(witness), [(place, count)]) == root
        assert count == 1 or fold(leaf("x"), bytes(witness), [(place, count)]) != root


def test_sources(spark):
    draw = random.Random(3)
    sizes = {"b": 1, "a": 16, "é": 17, "": 40, None: 3, "src0": 700} | {f"host{i}": 1 for i in range(30)}
    rows = [(s, draw.randrange(10**6), leaf((s, i)), f"{i}") for s, n in sizes.items() for i in range(n)]
    check(spark, rows)


def test_block_roots_are_appended(spark):
    rows = [("hot", i, leaf(i), "") for i in range(16 * 16 + 1)] + [("one", 0, leaf("a"), "")]
    rows += [("even", i, leaf(-i), "") for i in range(32)] + [(f"s{i}", 1, leaf(f"s{i}"), "") for i in range(40)]
    check(spark, rows, levels=1)


def test_more_leaves_than_a_block(spark):
    check(spark, [("hot", i, leaf(i), "") for i in range(ARITY**LEVELS + 1)] + [(None, 0, leaf("a"), "")])


def test_nulls_repeats_and_no_rows(spark):
    rows = [(None, None, leaf(1), None)] * 3 + [("a", None, leaf(2), "x"), ("a", 5, leaf(2), "x"), ("a", 5, leaf(2), "x")]
    check(spark, rows)
    check(spark, [("only", 7, leaf(7), "")])
    empty = manifest(spark.createDataFrame([], SCHEMA))
    assert empty.root is None and empty.sources == 0 and empty.witnesses.isEmpty()
    assert folded(empty.witnesses, "digest", 0, keep=["id"]).isEmpty()


def test_leaf_digest(spark):
    rows = [(1, "é", None, "a" * 70_000), (None, "", "x", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    got = [bytes(r[0]).hex() for r in df.select(leaf_digest([F.col(c) for c in df.columns])).collect()]
    assert got == [h("1:1", "2:é", "-", "70000:" + "a" * 70_000), h("-", "0:", "1:x", "0:")]
