from __future__ import annotations

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lmtables.llm.prefix_counts import (
    PrefixCounter,
    count_at,
    count_tokens,
    longest_within,
    prefix_index,
    segment_table,
    sizes_within,
    tokens_at,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
COUNTER = PrefixCounter(PATH)


def size(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


TEXTS = st.text(alphabet=st.characters(codec="utf-8"), max_size=25) | st.text("aB'sd <|endoftx>é\u0301 1½\n\x1c\x85\u3000", max_size=25)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 12))
def test_every_prefix_and_budget(text, budget):
    starts, before, least, segments = COUNTER.index(text)
    arrays = {s: COUNTER.segment_counts(s) for s in segments}
    counts = lambda k: arrays[segments[k]]
    exact = [size(text[:k]) for k in range(len(text) + 1)]
    assert [count_at(starts, before, counts, k) for k in range(len(text) + 1)] == exact
    assert COUNTER.total(text) == exact[-1]
    assert longest_within(starts, before, least, counts, budget) == max(k for k, n in enumerate(exact) if n <= budget)


def test_lookups_encode_nothing(monkeypatch):
    text = "it're  'll<|endoftext|>\n\n we'd " + "日本語" * 50 + " QmFzZTY0" * 9
    starts, before, least, segments = COUNTER.index(text)
    arrays = [COUNTER.segment_counts(s) for s in segments]
    exact = [size(text[:k]) for k in range(len(text) + 1)]
    for name in ("total", "byte_counts", "word_counts", "split"):
        monkeypatch.setattr(COUNTER, name, None)
    assert [count_at(starts, before, arrays.__getitem__, k) for k in range(len(text) + 1)] == exact
    for budget in range(max(exact) + 2):
        assert longest_within(starts, before, least, arrays.__getitem__, budget) == max(k for k, n in enumerate(exact) if n <= budget)


def test_stored_tables_answer_cuts_and_budgets(spark):
    texts = [None, "", " \n ", "we're here, they'll  go\n\nnow<|endoftext|><|endoftext|> x" * 2, "x" * 300, "日本 語" * 30, "we're here"]
    docs = spark.createDataFrame([(i, t, 0, 1) for i, t in enumerate(texts)], "doc_id long, text string, size int, tokens int").repartition(3)
    index, segments = prefix_index(docs, PATH), segment_table(docs, PATH)
    assert segments.count() == len({s for t in texts for s in COUNTER.segments(t or "")})
    asked = [(i, k) for i, t in enumerate(texts) for k in range(0, len(t or "") + 3)]
    cuts = spark.createDataFrame([*asked, *asked[:3], (3, -1), (3, None), (99, 1), (None, 1)], "doc_id long, size int")
    got = sorted(((r.doc_id, r.size, r.tokens) for r in tokens_at(index, segments, cuts).collect()), key=repr)
    exact = [(i, k, size((texts[i] or "")[:k])) for i, k in [*asked, *asked[:3]]]
    assert got == sorted([*exact, (3, -1, None), (3, None, None), (99, 1, None), (None, 1, None)], key=repr)
    budgets = spark.createDataFrame([(i, b) for i in range(len(texts)) for b in range(0, 40, 3)], "doc_id long, budget int")
    for r in sizes_within(index, segments, budgets).collect():
        text = texts[r.doc_id] or ""
        assert r.size == max(k for k in range(len(text) + 1) if size(text[:k]) <= r.budget), r
    none = docs.limit(0)
    assert tokens_at(prefix_index(none, PATH), segment_table(none, PATH), cuts.limit(0)).isEmpty()


def test_long_and_special():
    for text in ("x" * 3000, " " * 500 + "a", "a<|endoftext|>b<|endoftext|>", "日本語" * 200, "the cat's\n\n\n hat 12345"):
        assert COUNTER.total(text) == size(text)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in count_tokens(docs, PATH).collect():
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), size(texts[r.doc_id]))
        assert r.over_limit == (r.n_tokens > 512)
    index, segments = prefix_index(docs, PATH), segment_table(docs, PATH)
    cuts = docs.selectExpr("doc_id", "CAST(doc_id * 37 % (length(text) + 1) AS INT) AS size")
    got = tokens_at(index, segments, cuts).collect()
    assert len(got) == len(texts) and all(r.tokens == size(texts[r.doc_id][: r.size]) for r in got)


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "a b", 0), (None, "a b", 0), (5, "long text " * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, PATH).collect()}
    assert got == {(1, 0, 0, False), (2, 0, 0, False), (None, 3, 2, False), (5, 1_000_000, size(rows[4][1]), True)}
    assert count_tokens(docs, PATH).count() == 5 and count_tokens(docs.limit(0), PATH).isEmpty()
