"""The parity-sketch join against all pairs, and its two bounds by themselves."""

from __future__ import annotations

import numpy as np
import pytest
from test_dedup import groups, near_copies, shingles

from terrace.llm import parity



def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("percent", [80, 85, 60])
def test_linked_sets_share_a_piece_and_pass_the_sketch(percent):
    rng = np.random.default_rng(percent)
    met = 0
    for t in range(4000):
        n = int(rng.integers(1, 500 if t % 2 else 20))
        base = rng.integers(0, 2**64, n, np.uint64)
        lost, new = rng.integers(0, n // 6 + 2, 2)
        a, b = np.unique(base), np.unique(np.concatenate([base[lost:], rng.integers(0, 2**64, new, np.uint64)]))
        if not len(b) or not linked(a, b, percent):
            continue
        met += 1
        keys = np.intersect1d(parity.piece_keys(a, percent), parity.piece_keys(b, percent))
        # In some scheme they share as many buckets as each of them counts on.
        least = [dict(parity.slack(x, percent)) for x in (a, b)]
        low = keys & np.int64(63)
        assert any((low == k % 64).sum() >= max(least[0][k], least[1][k]) for k in least[0].keys() & least[1].keys())
        x, y = sorted((parity.sketch(a), parity.sketch(b)), key=len)
        while len(y) > len(x):
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
        differing = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert differing <= len(a) + len(b) - 2 * len(np.intersect1d(a, b))
    assert met > 1000


def test_hollow_sets_meet_in_empty_pieces():
    (scheme,) = [s for s in parity.schemes(6, 80) if s.least <= 6 <= s.most]
    # All hashes in the lowest piece: every other piece is empty, as in the partner with one more.
    a = np.arange(1, 7, dtype=np.uint64)
    b = np.concatenate([a, np.array([2**64 - 1], np.uint64)])
    assert linked(a, b, 80) and scheme.spread == 1
    assert len(np.intersect1d(parity.piece_keys(a, 80), parity.piece_keys(b, 80)))


@pytest.mark.parametrize("rounds,rows_per_piece", [(1, 3), (2, 1000)])
def test_join_loses_no_link(spark, tricky_docs, tricky, rounds, rows_per_piece):
    settings = parity.Settings(rounds=rounds, rows_per_piece=rows_per_piece)
    got = parity.link(tricky_docs, settings=settings).collect()
    assert len(got) == len(tricky)
    expected = groups(tricky, 5, 80)
    assert all(r["component_id"] == expected.get(r["doc_id"]) for r in got)
    assert {(r["doc_id"], r["n_shingles"]) for r in got if r["doc_id"] is not None} == {
        (i, len(shingles(t, 5))) for i, t in tricky if i is not None
    }
    crowd = near_copies(7) + [(1000 + i, t) for i, t in near_copies(8, 30)]
    found = parity.link(spark.createDataFrame(crowd, "doc_id long, text string"), settings=settings).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups(crowd, 5, 80)


def test_texts_of_one_id_are_one_document_and_no_rows_give_none(spark, no_docs):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, a), (2, b), (3, a), (3, b), (4, "c d e")]
    got = parity.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert parity.link(no_docs).count() == 0
