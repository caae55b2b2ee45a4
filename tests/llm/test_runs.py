"""Periodic runs against brute force over every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from terrace.llm import queries, runs
from terrace.llm.common import word_list



def brute(words: list) -> list[tuple[int, int, int]]:
    found: dict = {}
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at < len(words) - period:
            end = at
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            if end - at + period >= max(24, 3 * period):
                found.setdefault((at, end + period), period)
            at = max(end, at + 1)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def periodic_text(rng: random.Random) -> list[bytes]:
    letters, words = rng.choice([1, 2, 2, 3, 5]), []
    while len(words) < rng.randint(0, 260):
        if rng.random() < 0.5:
            words += [rng.randrange(letters) for _ in range(rng.randint(1, 20))]
        else:
            unit = [rng.randrange(letters + 1) for _ in range(rng.randint(1, 25))]
            length = rng.randint(2, 90)
            words += (unit * length)[:length]
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("batch", [7, 33, 64, runs.BATCH_WORDS])
def test_runs_match_brute_force_however_words_arrive(monkeypatch, batch):
    monkeypatch.setattr(runs, "BATCH_WORDS", batch)
    rng = random.Random(batch)
    for _ in range(250):
        words = periodic_text(rng)
        assert runs.find(words) == brute(words)


def test_long_and_fully_periodic_texts():
    assert runs.find([b"a"] * 30_000) == [(0, 30_000, 1)]
    assert runs.find([b"a", b"b"] * 12) == [(0, 24, 2)]
    assert runs.find([b"a"] * 23) == []
    unit = [str(i).encode() for i in range(5000)]
    assert runs.find(unit * 3) == [(0, 15_000, 5000)] and runs.find(unit * 2) == []


def expected_row(doc_id: int | None, text: str | None) -> dict:
    words = word_list(text)
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return {
        "doc_id": doc_id, "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": None if best[0] is None else 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept).hexdigest(),
    }


def test_query_on_tricky_rows(spark, tricky, tmp_path):
    rng = random.Random(5)
    rows = [*[(i, t if t is None or len(t) < 20_000 else t[:6000]) for i, t in tricky],
            *[(1000 + i, b" ".join(periodic_text(rng)).decode()) for i in range(60)]]
    spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [r.asDict() for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: tuple(str(v) for v in r.values())
    assert sorted(got, key=key) == sorted((expected_row(*row) for row in rows), key=key)
    assert sum(r["n_runs"] > 0 for r in got) > 20



def test_empty_table_and_general_use(spark, no_docs):
    assert no_docs.select(runs.found(F.col("text"))).count() == 0
    text = "x " + "la di da " * 20 + "y"
    row = spark.createDataFrame([(text,)], "t string").select(runs.found(F.col("t")).alias("f")).first()["f"]
    assert [tuple(r) for r in row["runs"]] == [(1, 60, 3)] and row["collapsed"] == "x la di da y"
