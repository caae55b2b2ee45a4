"""Benchmark leaks against an alignment of everything with everything."""

from __future__ import annotations

import random

import pytest

from terrace.llm import decontaminate as dc
from terrace.llm import queries

SF = "/root/testdata/sf0.01"


def distance(pattern: str, text: str) -> int:
    """Least edits between the pattern and any part of the text."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for c in text:
        before, column[0] = column[0], 0
        for i in range(1, len(pattern) + 1):
            before, column[i] = column[i], min(column[i] + 1, column[i - 1] + 1, before + (pattern[i - 1] != c))
        best = min(best, column[-1])
    return best


def test_no_leak_within_budget_is_lost_or_invented():
    rng = random.Random(2)
    letters = "abcdefgh  "
    items = [(i, "".join(rng.choice(letters) for _ in range(n))) for i, n in enumerate([30, 60, 90, 130, 200, 300])]
    index = dc.Index(items)
    for _ in range(60):
        text = list(rng.choice(items)[1])
        start = rng.randrange(0, max(1, len(text) - 60))
        text = text[start : start + rng.randrange(20, 220)]
        for _ in range(rng.randrange(0, 20)):
            k, kind = rng.randrange(len(text)), rng.random()
            if kind < 0.4:
                text[k] = rng.choice("xyz")
            elif kind < 0.7:
                text.insert(k, rng.choice("xyz"))
            elif len(text) > 1:
                text.pop(k)
        doc = "".join(rng.choice(letters) for _ in range(70)) + "".join(text) + "".join(rng.choice(letters) for _ in range(70))
        got = {leak[0] for leak in index.leaks(["other", doc, None, ""])[1]}
        plain = dc.normalised(doc)
        expected = {
            index.item[k] for k in range(len(index.item))
            if distance("".join(map(chr, index.codes[k])), plain) <= index.budget[k]
        }
        assert got == expected


def test_places_and_neighbours():
    item = "the quick brown fox jumps over the lazy dog and runs away into the dark green wood"
    index = dc.Index([(7, item), (7, None), (8, ""), (9, "short")])
    half = len(item) // 2
    found = index.leaks(["x" * 30 + item.upper() + "y" * 9, item[:half], item[half:], "  ".join(item.split())])
    assert [leak[:1] + leak[2:] for leak in found[0]] == [(7, 30, 0)]
    assert found[1] == found[2] == []  # halves in neighbouring documents make no leak
    assert found[3][0][3] == 0


def test_tricky_rows_and_blocks(spark, tricky_docs, tricky, no_docs):
    base = tricky[0][1]
    bench = spark.createDataFrame(
        [(1, base[100:300], "x"), (2, None, "x"), (None, base[300:500], "x"), (3, "", "x"), (1, base[100:300], "x")],
        "item_id long, text string, leaks string",
    )
    for settings in (dc.Settings(), dc.Settings(block_chars=150)):
        blocks = dc.indexes(bench, settings=settings)
        assert len(blocks) == (1 if settings.block_chars > 1000 else 3)
        kept = dc.clean(tricky_docs, bench, settings=settings)
        assert kept.columns == tricky_docs.columns
        bad = [r["text"] for r in kept.collect() if r["text"] and base[100:300].lower() in r["text"].lower()]
        assert bad == []
        expected = sum(not (t and base[100:180].lower() in t.lower()) for _, t in tricky)
        assert kept.count() == expected
    assert dc.clean(no_docs, bench).count() == 0
    assert dc.clean(tricky_docs, bench.limit(0)).count() == len(tricky)


def test_query_finds_whole_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {r["doc_id"]: set(r["item_ids"]) for r in queries.op3_decontamination(spark, SF).collect()}
    for d in docs:
        assert {i for i, t in items.items() if t in d["text"]} <= got[d["doc_id"]]
        # Planted copies only: nothing else in these tables comes near an item.
        assert bool(got[d["doc_id"]]) == any(t in d["text"] for t in items.values())


@pytest.mark.parametrize("length", [8, 9, 20, 40, 79, 80])
def test_bound_leaves_at_least_one_gram(length):
    s = dc.Settings()
    assert length - s.q + 1 - s.budget(length) * s.q >= 1


@pytest.mark.parametrize("length", [80, 81, 90, 100, 110])
def test_quotes_at_every_offset_are_found(length):
    rng = random.Random(length)
    texts = ["".join(rng.choice("abcdefgh  ") for _ in range(n)) for n in (95, 150, 394)]
    plain = [dc.normalised(t) for t in texts]
    quotes = [(i, t[at : at + length]) for i, t in enumerate(plain) for at in range(len(t) - length + 1)]
    frame = "".join(rng.choice("xyz") for _ in range(50))
    found = dc.Index(list(enumerate(texts))).leaks([f"{frame}{q}{frame}" for _, q in quotes])
    assert [[(leak[0], leak[3]) for leak in leaks] for leaks in found] == [[(i, 0)] for i, _ in quotes]
    # The budget of eight edits holds at every offset too, and not a ninth.
    for edits, leaked in ((8, True), (9, False)):
        spoilt = [list(q[:80]) for _, q in quotes]
        for q in spoilt:
            for k in range(edits):
                q[4 + 9 * k - k // 8] = "#"
        found = dc.Index(list(enumerate(texts))).leaks([f"{frame}{''.join(q)}{frame}" for q in spoilt])
        assert [[leak[0] for leak in leaks] for leaks in found] == [[i] if leaked else [] for i, _ in quotes]
