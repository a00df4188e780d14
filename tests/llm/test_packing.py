from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lmtables.llm.vector_packing import PieceEncoder, fill_bins, pack, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = PieceEncoder(PATH)


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=30) | st.text("aB'sΣ<|endoftx>é\u0301 1½\n\x1c\x85", max_size=30))
def test_ids_are_the_librarys(text):
    assert list(ENCODER.encode(text)) == ids(text)


def test_special_strings_and_long_words():
    for text in ("a<|endoftext|>B <|startoftext|>", "Don'T", "x" * 5000, "日本" * 300, "ab1" * 2000):
        assert list(ENCODER.encode(text)) == ids(text)


def check(rows, texts, limit=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        want = np.array([*ids(text), 1], "<u4")
        place = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == place and r.doc_tokens == len(want)
            assert zlib.crc32(want[r.start : r.start + r.length].tobytes()) == r.ids_crc32
            place += r.length
        assert place == len(want)
    for members in sequences.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= limit
    sizes = [sum(r.length for r in m) for m in sequences.values()]
    return sum(limit - s for s in sizes if s & (s - 1)) / (limit * len(sizes))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(pack_documents(docs, PATH).collect(), texts) < 0.01


def test_odd_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, " \n", 9), (4, "word " * 30_000, 9), (5, "a b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    check(pack_documents(docs, PATH).collect(), {r[0]: r[1] for r in rows})
    twice = spark.createDataFrame([(None, "a b", 1)] * 3 + [(5, "x", 1)] * 2, "doc_id long, text string, sequence_id int")
    got = pack_documents(twice, PATH, with_ids=True).collect()
    assert len(got) == 5 and len({(r.sequence_id, r.offset) for r in got}) == 5
    assert all(list(r.ids)[-1] == 1 for r in got)
    assert pack_documents(docs.limit(0), PATH).isEmpty()


@pytest.mark.parametrize("limits", [(100, 5, 100), (100, 50, 40), (64, 3, 20)])
def test_all_limits_hold(limits):
    rng = np.random.default_rng(5)
    tokens = rng.integers(1, limits[0] + 1, 700)
    loss = np.minimum(rng.integers(0, limits[2] + 1, 700), tokens)
    demand = np.column_stack([tokens, np.ones(700, int), loss])
    bins, places = fill_bins(demand, np.array(limits))
    for b in range(bins.max() + 1):
        assert (demand[bins == b].sum(axis=0) <= limits).all()
        assert sorted(places[bins == b]) == list(range((bins == b).sum()))
    least = max(np.ceil(demand.sum(axis=0) / limits))
    assert bins.max() + 1 <= 1.35 * least


def packed(spark, rows, schema="id long, tokens long, loss long", limits=(256, 4, 64)):
    pieces = spark.createDataFrame(rows, schema)
    got = pack(pieces, tokens="tokens", loss="loss", max_tokens=limits[0], max_segments=limits[1], max_loss=limits[2]).collect()
    sums = defaultdict(lambda: np.zeros(3, int))
    for r in got:
        fits = (r.tokens or 0) <= limits[0] and (r.loss or 0) <= limits[2]
        assert (r.sequence_id is not None) == (r.offset is not None) == fits
        if fits:
            sums[r.sequence_id] += (r.tokens or 0, 1, r.loss or 0)
    assert len(got) == len(rows) and all((s <= limits).all() for s in sums.values())
    return got


def test_instruction_examples(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(t), int(t) // 3) for i, t in enumerate(rng.integers(1, 200, 500))]
    got = packed(spark, rows)
    assert sum(r.sequence_id is None for r in got) == sum(loss > 64 for *_, loss in rows) > 0


def test_pieces_above_a_limit_and_nulls(spark):
    rows = [(1, None, 3), (2, 500, 3), (3, 100, 100), (4, 60, 60), (5, 10, None), (6, None, None), (7, 100, 50), (8, 0, 0), (8, 0, 0)]
    got = {r.id: r for r in packed(spark, rows, limits=(100, 5, 50))}
    assert {i for i, r in got.items() if r.sequence_id is None} == {2, 3, 4}
    packed(spark, [(1, 5, 0), (2, 5, 1)], limits=(10, 1, 0))
    assert packed(spark, []) == []


def test_clashing_columns(spark):
    schema = "id long, tokens long, loss long, sequence_id string, `offset` int, _piece int, _group int"
    got = packed(spark, [(i, 10, 3, "x", -1, 7, 7) for i in range(9)], schema)
    assert all(isinstance(r.sequence_id, int) and r.offset >= 0 and (r._piece, r._group) == (7, 7) for r in got)
