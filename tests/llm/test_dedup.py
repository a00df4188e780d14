from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

from lmtables.llm.quotient_dedup import QuotientFilter, exact_duplicates

DOCS = "doc_id long, text string, keep_id int, fp int, sha int"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for i, t in enumerate(norm):
        groups[t].append(i)
    out = []
    for t, members in groups.items():
        first = min(members, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            digest = hashlib.sha256(t.encode()).hexdigest()
            out.append((rows[i][0], rows[first][0], len(members), i == first, digest))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)
    return sorted((tuple(r) for r in exact_duplicates(df).collect()), key=repr)


def test_against_brute_force(spark):
    rows = [(9, "a  b"), (3, "a\tb"), (4, " a b"), (5, None), (6, ""), (7, "a b"), (7, "a b"), (None, "a b"), (None, "x")]
    rows += [(100 + i, "copy " * 500) for i in range(300)] + [(None, "copy " * 500)] + [(1000 + i, f"t{i}") for i in range(50)]
    rows += [(2000, "long " * 200_000), (2001, "long\n" * 200_000), (2002, "a\u00a0b"), (2003, "A b")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 60, 3000, dtype=np.uint64)
    values[:1200] = values[0]
    parts = [QuotientFilter.build(p, 48) for p in np.array_split(rng.permutation(values), 7)] + [QuotientFilter.build(values[:0], 48)]
    whole = QuotientFilter.merge([QuotientFilter.unpack(*p.pack()) for p in parts], 48)
    distinct, counts = np.unique(values, return_counts=True)
    assert (whole.fingerprints(48) == distinct).all() and (whole.counts == counts).all()
    assert whole.runs.sum() == len(distinct)
