"""SentencePiece, token shards, sharding and the permutation."""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.llm import queries, sharding, spm, token_shards
from terrace.llm.feistel import Permutation
from terrace.llm.spm import MARK

HARD = ["", " ", "  a", "a\n\n b", "\n", "\n\na", "é日本 x😀\n😀", " \n x ", "a  b   c    d     e\t\tf", "▁▁x ▁", "\x00\x01", "a" * 5000, "      "]


@pytest.fixture(scope="module")
def model() -> bytes:
    with open(queries.MODEL, "rb") as file:
        return file.read()


def unigram_model(squeeze: bool) -> bytes:
    """A small hand-made unigram model; nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, True
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix = "identity", True
    m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = squeeze, True

    def add(piece: str, score: float, kind: int) -> None:
        p = m.pieces.add()
        p.piece, p.score, p.type = piece, score, kind

    add("<unk>", 0, 2), add("<s>", 0, 3), add("</s>", 0, 3)
    for b in range(256):
        add(f"<0x{b:02X}>", 0, 6)
    for piece, score in {"▁": -3.1, "a": -4.2, "b": -4.7, "c": -5.3, "▁a": -3.7, "ab": -4.1, "bc": -4.6, "▁ab": -4.9, "abc": -5.2, "▁b": -5.05, "ca": -5.9}.items():
        add(piece, score, 1)
    return m.SerializeToString()


def test_ids_equal_the_reference_library(model, tricky):
    coder = spm.codec(model)
    texts = HARD + [t for _, t in tricky if t]
    found = coder.encode(texts)
    assert [ids.tolist() for ids in found] == coder.reference.encode(texts, num_threads=1)
    assert all(coder.agrees(texts, found))
    assert [coder.decode(ids) for ids in found] == coder.reference.decode([ids.tolist() for ids in found])
    whole = [e.ids for e in coder.whole.encode_batch([t for t in texts if t], add_special_tokens=False)]
    assert whole == coder.reference.encode([t for t in texts if t], num_threads=1)


@pytest.mark.parametrize("squeeze", [False, True])
def test_unigram_scores_are_rebuilt(squeeze):
    coder = spm.Codec(unigram_model(squeeze))
    texts = ["abc ab", "aabbcc", " a  b ", "cab\nbca", "xyz é", "", "ab" * 50, "a b c abc"]
    found = coder.encode(texts)
    assert [ids.tolist() for ids in found] == coder.reference.encode(texts, num_threads=1)
    assert all(coder.agrees(texts, found))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_survives(text):
    with open(queries.MODEL, "rb") as file:
        coder = spm.codec(file.read())
    (ids,) = coder.encode([text])
    assert ids.tolist() == coder.reference.encode(text)
    assert coder.decode(ids) == text.replace("▁", " ")


def test_columns_of_ids(spark, model, tricky_docs, tricky, no_docs):
    ids = tricky_docs.select("text", spm.token_ids(model, F.col("text")).alias("ids"))
    back = ids.select("text", "ids", spm.token_text(model, F.col("ids")).alias("again")).collect()
    assert len(back) == len(tricky)
    assert all((r["ids"] is None) == (r["text"] is None) and r["again"] == r["text"] for r in back)
    digest = tricky_docs.select("text", spm.digest(model, F.col("text")).alias("d")).collect()
    assert all(r["d"]["parity"] and r["d"]["round_trip"] for r in digest)
    assert no_docs.select(spm.token_ids(model, F.col("text"))).count() == 0


def test_a_full_cache_is_emptied_without_harm(model, monkeypatch):
    monkeypatch.setattr(spm, "_CACHED_WORDS", 3)
    coder = spm.Codec(model)
    for texts in (["one two three four five"], ["six seven one"], ["one two eight", "nine ten"]):
        assert [ids.tolist() for ids in coder.encode(texts)] == coder.reference.encode(texts)


def test_a_broken_backend_shows_in_ids_and_parity(model, monkeypatch):
    """The tokenizers library decides; the other one only tells."""
    from tokenizers import Tokenizer, models

    coder, texts = spm.Codec(model), ["one two", "one", ""]
    right = coder.encode(texts)
    broken = Tokenizer(models.BPE(vocab={MARK: 5, "x": 6}, merges=[], unk_token=MARK))
    coder.cache.clear()
    coder.words = coder.marked = broken
    wrong = coder.encode(texts)
    assert coder.agrees(texts, right) == [True] * 3 and coder.agrees(texts, wrong) == [False, False, True]
    monkeypatch.setattr(spm, "codec", lambda _: coder)
    assert [ok for _, ok in spm.encoded(model, texts, check=True)] == [False, False, True]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    p, all_ = Permutation(n, "key"), np.arange(n)
    assert sorted(p.forward(all_).tolist()) == all_.tolist()
    assert (p.backward(p.forward(all_)) == all_).all()
    if n > 100:
        assert (p.forward(all_) != Permutation(n, "other").forward(all_)).mean() > 0.9
        assert abs(np.corrcoef(all_, p.forward(all_))[0, 1]) < 0.2


def test_permutation_refuses_what_is_outside():
    with pytest.raises(ValueError):
        Permutation(5, "key").forward(np.array([5]))


def test_shards_are_even_gapless_and_reproducible(spark, tricky, no_docs):
    docs = spark.createDataFrame(tricky, "doc_id long, text string")
    sizes = sharding.text_sizes(docs)
    got = sharding.shuffle_rows(sizes, 7, "k").collect()
    again = sharding.shuffle_rows(sizes.repartition(5), 7, "k").collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    per = {}
    for r in got:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    expected = sorted((i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in tricky)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == expected
    assert sharding.shuffle_rows(sharding.text_sizes(no_docs), 7, "k").count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle_rows(docs.withColumnRenamed("text", "Slot"), 7, "k")


def test_shard_of_a_row_is_computed_from_its_number(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id")
    order = Permutation(500, "k")
    for r in sharding.shuffle_rows(docs, 6, "k").collect():
        assert int(order.backward(np.array([r["slot"] * 6 + r["shard"]]))[0]) == r["doc_id"]


def test_written_parquet_shards_hold_all_rows(spark, tricky):
    docs = spark.createDataFrame(tricky, "doc_id long, text string")
    path = f"{tempfile.mkdtemp()}/shards"
    sharding.write_shards(docs, path, 4, "k")
    back = spark.read.parquet(path)
    assert back.count() == len(tricky) and back.select("shard").distinct().count() == 4


@pytest.mark.parametrize("length,shard_bytes", [(16, 640), (1024, 1 << 20)])
def test_token_shards_round_trip(spark, tricky, length, shard_bytes):
    with open(queries.RANKS, "rb") as file:
        encoder = token_shards.RankFile(file.read())
    docs = spark.createDataFrame(tricky, "doc_id long, text string").withColumn("sequence", F.lit("x")).repartition(5)
    path = f"file://{tempfile.mkdtemp()}/tokens"
    how = token_shards.Settings(length=length, shard_bytes=shard_bytes)
    if length == 16:
        docs = docs.filter("length(text) < 3000")
    manifest = token_shards.write_shards(docs, path, encoder, settings=how).orderBy("slot").collect()
    n = len(manifest)
    assert [r["slot"] for r in manifest] == list(range(n)) and len({r["sequence"] for r in manifest}) == n
    # Training order is the permutation of the numbers; shards are ranges of it.
    room = 1 + max(r["sequence"] for r in manifest)
    assert [r["shard"] for r in manifest] == sorted(r["shard"] for r in manifest) and (room > n or n == 1)
    read = list(token_shards.read_slots(path, 0, n, how))
    assert [zlib.crc32(x.tobytes()) for x in read] == [r["crc32"] for r in manifest]
    resumed = list(token_shards.read_slots(path, n // 2, n, how))
    assert all((a == b).all() for a, b in zip(resumed, read[n // 2 :], strict=True))
    by_number = sorted(zip(manifest, read, strict=True), key=lambda p: p[0]["sequence"])
    stream = np.concatenate([x[: r["n_tokens"]] for r, x in by_number])
    assert all((x[r["n_tokens"] :] == encoder.end).all() for r, x in by_number)
    bpe, cuts = token_shards._encoding(encoder)[0], np.flatnonzero(stream == encoder.end)
    texts = [bpe.decode(part[part != encoder.end].tolist()) for part in np.split(stream, cuts + 1)[:-1]]
    assert sorted(texts) == sorted(r["text"] for r in docs.collect() if r["text"] is not None)


def test_slots_follow_the_permutation(spark, tmp_path):
    with open(queries.RANKS, "rb") as file:
        encoder = token_shards.RankFile(file.read())
    rows = [(i, f"text {i} " * (i % 40)) for i in range(400)]
    stored = f"{tmp_path}/docs"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(stored)
    docs = spark.read.parquet(stored)
    how = token_shards.Settings(length=32, shard_bytes=64 * 40)
    manifest = token_shards.write_shards(docs, f"file://{tmp_path}/s", encoder, settings=how, stored=True).orderBy("slot").collect()
    sizes = docs.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()
    room = -(-max(r["n"] for r in sizes) // how.length)
    order = token_shards.permutation(1 + max(r["p"] for r in sizes), room, how)
    places = order.forward(np.array([r["sequence"] for r in manifest]))
    assert (np.diff(places) > 0).all() and len(manifest) > 50
    # The document each sequence begins in, by walking the stream of every part.
    read = dict(zip([r["sequence"] for r in manifest], token_shards.read_slots(f"file://{tmp_path}/s", 0, len(manifest), how), strict=True))
    texts = docs.select(F.spark_partition_id().alias("p"), "doc_id", "text").collect()
    for part in {r["p"] for r in texts}:
        stream = [(r["doc_id"], i) for r in texts if r["p"] == part for i in [*encoder.encode(r["text"]).tolist(), encoder.end]]
        for r in manifest:
            if r["sequence"] // room == part:
                at = r["sequence"] % room * how.length
                here = stream[at : at + how.length]
                assert int(r["first_doc"]) == here[0][0] and r["n_tokens"] == len(here)
                assert read[r["sequence"]][: len(here)].tolist() == [i for _, i in here]


def test_a_shorter_rewrite_leaves_no_stale_shards(spark, tmp_path):
    with open(queries.RANKS, "rb") as file:
        encoder = token_shards.RankFile(file.read())
    how, path = token_shards.Settings(length=16, shard_bytes=320), f"file://{tmp_path}/s"
    for n in (300, 20):
        docs = spark.createDataFrame([(i, f"some text {i}") for i in range(n)], "doc_id long, text string").coalesce(1)
        count = token_shards.write_shards(docs, path, encoder, settings=how).count()
        assert len(list(token_shards.read_slots(path, 0, 10_000, how))) == count
    assert not list(token_shards.read_slots(f"file://{tmp_path}/none", 0, 5, how))


def test_token_shards_of_nothing(spark, no_docs):
    with open(queries.RANKS, "rb") as file:
        encoder = token_shards.RankFile(file.read())
    path = f"file://{tempfile.mkdtemp()}/tokens"
    assert token_shards.write_shards(no_docs, path, encoder).count() == 0
