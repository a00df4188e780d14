"""Tokenizing and packing against plain list code."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lmtables.operators import packing, tokens
from lmtables.operators.prefix import running_total, top_rows
from lmtables.sources.corpus import scan_corpus


def plain_blocks(rows: list[list[int]], size: int) -> list[list[int]]:
    flat = [t for row in rows for t in row]
    return [flat[i : i + size] for i in range(0, len(flat) // size * size, size)]


def random_tokens(seed: int, count: int = 300, sparse: bool = False):
    rng = random.Random(seed)
    ids = rng.sample(range(2**50), count) if sparse else range(count)
    rows = []
    for doc_id in sorted(ids):
        length = rng.choice([0, 1, 3, 7, 40, 90])
        rows.append(("train" if rng.random() < 0.8 else "validation", doc_id, [rng.randrange(100) for _ in range(length)]))
    return rows


@pytest.mark.parametrize("seed,size,sparse", [(1, 16, False), (2, 7, True), (3, 64, True), (4, 1, False)])
def test_pack_whole_split(spark, seed, size, sparse):
    rows = random_tokens(seed, sparse=sparse)
    df = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, input_ids ARRAY<INT>").repartition(5)
    found = packing.pack_blocks(df, size).orderBy("split", "block_idx").collect()
    for split in ("train", "validation"):
        expected = plain_blocks([r[2] for r in rows if r[0] == split], size)
        assert [r.input_ids for r in found if r.split == split] == expected
    assert all(r.labels == r.input_ids and r.scope == 0 for r in found)


@pytest.mark.parametrize("seed,batch,procs", [(5, 10, 1), (6, 16, 4), (7, 1000, 3), (8, 7, 5)])
def test_pack_per_map_call(spark, seed, batch, procs):
    rows = random_tokens(seed)
    df = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, input_ids ARRAY<INT>").repartition(3)
    found = packing.pack_blocks(df, 16, batch_rows=batch, num_proc=procs).orderBy("split", "scope", "block_idx").collect()
    for split in ("train", "validation"):
        lists = [r[2] for r in rows if r[0] == split]
        share, rest = divmod(len(lists), procs)
        expected, begin = [], 0
        for shard in range(procs):
            end = begin + share + (shard < rest)
            for i in range(begin, end, batch):
                expected += plain_blocks(lists[i : min(i + batch, end)], 16)
            begin = end
        assert [r.input_ids for r in found if r.split == split] == expected


def test_every_list_column_is_packed_alike(spark):
    rows = [("train", 1, [1, 2, 3], [0, 1, 1]), ("train", 2, [4, 5], [1, 0])]
    df = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, input_ids ARRAY<INT>, attention_mask ARRAY<INT>")
    found = packing.pack_blocks(df, 2, columns=("input_ids", "attention_mask")).orderBy("block_idx").collect()
    assert [(r.input_ids, r.attention_mask) for r in found] == [([1, 2], [0, 1]), ([3, 4], [1, 1])]


def test_pack_corpus_equals_tokenize_then_pack(spark):
    words = "a b c d e f g h".split()
    rng = random.Random(9)
    rows = [("train", i * 1000, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, text STRING")
    vocab = tokens.build_vocab(docs, vocab_size=9)
    one = packing.pack_corpus(docs, vocab, 8).orderBy("block_idx").collect()
    two = packing.pack_blocks(tokens.tokenize(docs, vocab), 8).orderBy("block_idx").collect()
    assert [r.input_ids for r in one] == [r.input_ids for r in two]
    mapping = {r.token: r.token_id for r in vocab.collect()}
    ids = [[mapping.get(w, 3) for w in text.split()] for _, _, text in rows]
    assert [r.input_ids for r in one] == plain_blocks(ids, 8)
    assert 3 in {i for r in one for i in r.input_ids}


def test_packing_moves_ids_twice_and_no_text(spark):
    docs = spark.createDataFrame([("train", 1, "a b")], "split STRING, doc_id BIGINT, text STRING")
    vocab = spark.createDataFrame([("a", 4)], "token STRING, token_id INT")
    plan = packing.pack_corpus(docs, vocab, 2)._jdf.queryExecution().executedPlan()
    shuffles = [line for line in plan.toString().splitlines() if "Exchange " in line]
    assert not any("SinglePartition" in line for line in shuffles)
    assert packing.pack_corpus(docs, vocab, 2).count() == 1
    wide = exchanged_columns(plan)
    assert not any("text" in columns for columns in wide)
    assert sum("input_ids" in columns or "pieces" in columns or "buf" in columns for columns in wide) == 2


def exchanged_columns(plan) -> list[set[str]]:
    """Column names that each shuffle of a plan moves."""
    found, kids = [], plan.children()
    if plan.nodeName() == "AdaptiveSparkPlan":
        return exchanged_columns(plan.initialPlan())
    if plan.nodeName() == "Exchange":
        output = plan.output()
        found.append({output.apply(i).name() for i in range(output.size())})
    for i in range(kids.size()):
        found += exchanged_columns(kids.apply(i))
    return found


@pytest.mark.parametrize("limit", [0, 100])
def test_lookup_and_join_give_the_same_ids(spark, limit):
    docs = spark.createDataFrame(
        [("train", 1, "a b  c a"), ("train", 2, ""), ("train", 3, None), ("validation", 4, "zz <unk>\tb")],
        "split STRING, doc_id BIGINT, text STRING",
    ).repartition(3)
    vocab = spark.createDataFrame([("<unk>", 3), ("a", 4), ("b", 5)], "token STRING, token_id INT")
    coded = tokens.tokenize(docs, vocab, lookup_limit=limit).orderBy("doc_id").collect()
    assert [r.input_ids for r in coded] == [[4, 5, 3, 4], [], [], [3, 3, 5]]


def test_empty_and_null_texts_stay(spark):
    docs = spark.createDataFrame([("train", 1, ""), ("train", 2, None), ("train", 3, " x ")], "split STRING, doc_id BIGINT, text STRING")
    vocab = spark.createDataFrame([("x", 4)], "token STRING, token_id INT")
    coded = tokens.tokenize(docs, vocab, attention_mask=True).orderBy("doc_id").collect()
    assert [(r.input_ids, r.attention_mask) for r in coded] == [([], []), ([], []), ([4], [1])]


def test_vocab_order_and_specials(spark):
    docs = spark.createDataFrame([("b b a a c <eos> <eos> <eos>",)], "text STRING")
    rows = tokens.build_vocab(docs, vocab_size=6).orderBy("token_id").collect()
    assert [r.token for r in rows] == ["<pad>", "<bos>", "<eos>", "<unk>", "a", "b"]
    with pytest.raises(ValueError):
        tokens.build_vocab(docs, vocab_size=4)


@pytest.mark.parametrize(
    "names,expected",
    [
        ({"pad": "<pad>", "bos": "<bos>", "eos": "<eos>"}, (0, 1, 2)),
        ({"eos": "<eos>"}, (2, 0, 2)),
        ({"unk": "<unk>"}, (3, 0, 0)),
        ({}, (0, 0, 0)),
    ],
)
def test_special_id_fallbacks(spark, names, expected):
    vocab = spark.createDataFrame([(s, i) for i, s in enumerate(tokens.SPECIALS)], "token STRING, token_id INT")
    row = tokens.special_ids(vocab, names).first()
    assert (row.pad_token_id, row.bos_token_id, row.eos_token_id) == expected


def test_no_train_block_raises(spark):
    lengths = spark.createDataFrame([("train", 1, 5)], "split STRING, doc_id BIGINT, value BIGINT")
    with pytest.raises(Exception, match="No block of the training split is full"):
        packing.require_blocks(packing.pack_stats(lengths, 8)).collect()


def test_running_total_any_keys(spark):
    rng = random.Random(11)
    rows = [(rng.choice("ab"), key, rng.randrange(10)) for key in rng.sample(range(-(2**40), 2**62), 500)]
    df = spark.createDataFrame(rows, "g STRING, k BIGINT, v BIGINT").repartition(6)
    found = {(r.g, r.k): r.t for r in running_total(df, ["g"], "k", F.col("v"), "t").collect()}
    for group in "ab":
        total = 0
        for _, key, value in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            assert found[group, key] == total
            total += value


def test_running_total_checks_order_bits(spark):
    df = spark.createDataFrame([("a", 2**41, 1)], "g STRING, k BIGINT, v BIGINT")
    with pytest.raises(Exception, match="more than 40 bits"):
        running_total(df, ["g"], "k", F.col("v"), "t", order_bits=40).collect()


def test_top_rows_with_hot_group(spark):
    df = spark.range(5000).selectExpr("IF(id % 10 = 0, id % 7, -1) AS g", "id", "(id * 7919) % 5000 AS v", "CAST(3 AS INT) AS n")
    found = top_rows(df, ["g"], [F.col("v").asc()], F.col("n"), rank="r", salt_by="id")
    expected = df.selectExpr("*", "row_number() OVER (PARTITION BY g ORDER BY v) AS r").where("r <= n")
    assert sorted(map(tuple, found.select("g", "id", "r").collect())) == sorted(
        map(tuple, expected.select("g", "id", "r").collect())
    )


def test_scan_formats(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x y", "en")], "doc_id BIGINT, text STRING, lang STRING")
    rows.write.parquet(str(tmp_path / "p"))
    rows.write.json(str(tmp_path / "j"))
    schema = "doc_id BIGINT, text STRING"
    both = scan_corpus(spark, {"train": str(tmp_path / "p"), "validation": str(tmp_path / "p")})
    assert sorted(map(tuple, both.collect())) == [("train", 1, "x y"), ("validation", 1, "x y")]
    assert scan_corpus(spark, str(tmp_path / "j"), fmt="json", schema=schema).first().text == "x y"
    with pytest.raises(KeyError):
        scan_corpus(spark, {"validation": str(tmp_path / "p")})
    with pytest.raises(ValueError):
        scan_corpus(spark, "x", fmt="orcish")


def test_cutting_stays_exact_for_large_offsets(spark):
    start = 2**55 + 4
    df = spark.createDataFrame([("train", start, 3, [7, 8, 9])], "split STRING, start BIGINT, n BIGINT, input_ids ARRAY<INT>")
    rows = packing.cut_pieces(df, 5, ["split"], ["input_ids"]).orderBy("block_idx").collect()
    assert [(r.block_idx, r.input_ids) for r in rows] == [
        ((start + i) // 5, [7 + j for j in range(3) if (start + j) // 5 == (start + i) // 5])
        for i in sorted({min(j for j in range(3) if (start + j) // 5 == b) for b in {(start + j) // 5 for j in range(3)}})
    ]


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_files_pack_in_their_order(spark, tmp_path, fmt):
    words = [[f"w{f}x{i} " * (i % 4) + f"w{f}x{i}" for i in range(120)] for f in range(3)]
    for f, lines in enumerate(words):
        folder = tmp_path / "in" / f"part{2 - f}"  # folders are read by name, in another order than they were written
        if fmt == "text":
            folder.mkdir(parents=True)
            (folder / "a b.txt").write_text("\n".join(lines) + "\n")
        else:
            spark.createDataFrame([(x, 1) for x in lines], "text string, doc_id int").coalesce(1).write.option("parquet.block.size", 1024).parquet(str(folder))
    flat = " ".join(x for lines in words[::-1] for x in lines).split()
    blocks = [flat[i : i + 16] for i in range(0, len(flat) - 15, 16)]
    names = {"order": "doc_id", "ties": ["line"]}
    place = str(tmp_path / "in" / "*") if fmt == "text" else str(tmp_path / "in" / "*" / "*.parquet")
    try:
        for size in ("128m", "700", "97"):  # files are cut into one part or many
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1" if size != "128m" else "4m")
            docs = scan_corpus(spark, place, fmt=fmt, file_order=True)
            assert docs.columns == ["split", "text", "line", "doc_id"]
            assert size == "128m" or docs.rdd.getNumPartitions() > 3
            lists = docs.select("split", "doc_id", "line", F.split("text", " ").alias("input_ids"))
            got = packing.pack_blocks(lists, 16, **names).orderBy("block_idx").collect()
            assert [r.input_ids for r in got] == blocks
            scoped = packing.pack_blocks(lists, 16, batch_rows=50, **names).orderBy("scope", "block_idx").first()
            assert scoped.input_ids == blocks[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    if fmt == "text":
        assert scan_corpus(spark, place, fmt="text").where("split = 'train'").count() == 360
