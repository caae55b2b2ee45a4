"""Near-duplicates, repeated windows, line chunks and components against brute force."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import common, line_chunks, linking, minhash, queries, windows
from terrace.llm.components import components
from terrace.sources.tables import materialise

SF = "/root/testdata/sf0.001"


def shingles(text: str | None, width: int) -> frozenset:
    w = [x.lower() for x in common.word_list(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - min(width, len(w)) + 1))


def groups(rows, width: int, percent: int) -> dict:
    """doc id -> smallest id reachable, by comparing everything with everything."""
    sets: dict = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t, width))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(seed: int, n: int = 60) -> list[tuple[int, str]]:
    """Texts at all similarities around the threshold, in one crowded group."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 7)):
            text[rng.randrange(150)] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_duplicates_lose_no_link(spark, tricky_docs, tricky, rounds):
    settings = minhash.Settings(shingle=3, percent=85, band_rows=5, bands=25, rounds=rounds, minima=256 if rounds else 128)
    got = minhash.link(tricky_docs, settings=settings).collect()
    assert len(got) == len(tricky)
    expected = groups(tricky, 3, 85)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == expected[row["doc_id"]]
            assert row["kept"] == (row["doc_id"] == row["component_id"])
    sizes = {(r["doc_id"], r["n_shingles"]) for r in got if r["doc_id"] is not None}
    assert sizes == {(i, len(shingles(t, 3))) for i, t in tricky if i is not None}

    crowd = near_copies(5)
    frame = spark.createDataFrame(crowd, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.link(frame, settings=settings).collect()}
    assert found == groups(crowd, 3, 85)


def test_small_buckets_are_compared_once(spark, monkeypatch):
    """Groups of three, two of them linked: no round after the first looks at their buckets again."""
    rng = random.Random(9)
    rows = []
    for group in range(12):
        base = [f"w{group}_{i}" for i in range(120)]
        for k, changed in enumerate((0, 1, 9)):
            text = list(base)
            for at in rng.sample(range(120), changed):
                text[at] = f"x{rng.randint(0, 10**6)}"
            rows.append((3 * group + k, " ".join(text)))
    visited = []

    def counting(df, name):
        stored = materialise(df, name)
        if name == "met":
            visited.append(stored.count())
        return stored

    monkeypatch.setattr(linking, "materialise", counting)
    settings = minhash.Settings(shingle=3, percent=85, band_rows=5, bands=25)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["component_id"] for r in minhash.link(frame, settings=settings).collect()} == groups(rows, 3, 85)
    assert sum(visited) == 0


def test_texts_hashed_together_fare_as_each_alone(tricky):
    texts = [t for _, t in tricky] + ["", None, "end", "\x1cno blank\x0b", "ab", "a b"]
    both = list(common.shingle_sets(texts, 3))
    for t, found in zip(texts, both, strict=True):
        assert found.tolist() == next(common.shingle_sets([t], 3)).tolist()
        assert len(found) == len(shingles(t, 3))
    raw, edges = common.raw_texts(pa.array(["cut off", *texts])[1:])
    words = common.words_of(raw, edges)
    known: dict = {}
    for k, t in enumerate(texts):
        own = common.word_list(t)
        hashes = words.hashes[words.first[k] : words.first[k + 1]].tolist()
        assert len(own) == len(hashes) and all(known.setdefault(w, h) == h for w, h in zip(own, hashes, strict=True))
    assert len(set(known.values())) == len(known)


def test_repeats_within_one_text_send_no_windows(spark, monkeypatch):
    """They are cut in their own text: nothing of them is stored or exchanged."""
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(1, " ".join([line] * 4)), (2, " ".join([line] * 4)), (3, " ".join(f"v{i}" for i in range(50)))]
    stored = {}

    def counting(df, name):
        out = materialise(df, name)
        stored[name] = stored.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(windows, "materialise", counting)
    done, name = windows.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {r["doc_id"]: r[name]["kept_text"] for r in done.collect()}
    assert kept == {1: line, 2: "", 3: rows[2][1]}
    assert stored["repeated-anchors"] == stored["windows"] == 0


def test_texts_travel_in_short_batches(spark):
    @F.pandas_udf("int")
    def rows_of_batch(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        corpus_pipeline.encoding(spark, spark.createDataFrame([(1, "a")], "doc_id long, text string"), SF)
        sent = spark.range(1500).coalesce(1).select(rows_of_batch(F.col("id").cast("string")).alias("n"))
        assert sent.agg(F.max("n")).first()[0] <= 500
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_near_duplicates_keep_one_of_each_group(spark, tricky_docs, tricky, no_docs):
    kept = minhash.keep_one(tricky_docs)
    assert kept.columns == tricky_docs.columns
    expected = groups(tricky, 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        i for i, _ in tricky if i is not None and expected[i] == i
    )
    assert minhash.keep_one(no_docs).count() == 0
    assert minhash.link(no_docs).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, a), (2, b), (3, a), (3, b), (4, "c d e")]
    got = minhash.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_equal_nibbles_are_counted(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 16, 128, np.uint64), rng.integers(0, 16, 128, np.uint64)
    b[:50] = a[:50]
    frame = spark.createDataFrame([(minhash.packed(a).tolist(), minhash.packed(b).tolist())], "a array<long>, b array<long>")
    assert frame.select(minhash.matches(F.col("a"), F.col("b"), 8)).first()[0] == int((a == b).sum())


def test_components_of_chains_stars_and_loops(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"s{i}") for i in range(50)] + [("z", "z"), ("p", "q"), ("q", "p")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert all(got[f"c{i:03}"] == "c000" for i in range(61))
    assert {got[f"s{i}"] for i in range(50)} | {got["hub"]} == {"hub"}
    assert got["q"] == "p" and "z" not in got
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_known_components_grow_by_new_links(spark, monkeypatch):
    """Only what new links join is followed, in as many tasks as it needs, however many partitions a shuffle has."""
    known = spark.createDataFrame(
        [(f"c{i}", "c0") for i in range(40)] + [(f"m{i}", "m0") for i in range(40)] + [("p", "p"), ("q", "p")], "node string, root string"
    )
    new = [("c30", "m7"), ("m1", "c0"), ("a", "m3"), ("x", "y"), ("y", "z"), ("c1", "c9"), ("w", "w")]
    frames = [spark.createDataFrame(rows, "a string, b string") for rows in (new, new[-1:])]
    stored = []

    def counting(df, name):
        out = materialise(df, name)
        stored.append((name, out.count(), len(out.inputFiles())))
        return out

    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        monkeypatch.setattr("terrace.llm.components.materialise", counting)
        grown, steps = components(frames[0], known).collect(), list(stored)
        assert components(frames[1], known).count() == 82
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    joined = ["a", *[f"{x}{i}" for x in "cm" for i in range(40)]]
    assert sorted(grown) == sorted([(n, "a") for n in joined] + [("p", "p"), ("q", "p"), ("x", "x"), ("y", "x"), ("z", "x")])
    assert max(rows for name, rows, _ in steps if name in ("edges", "hooks")) <= 2 * 4
    assert all(files == 1 for _, _, files in steps)


def brute_windows(rows, width=20) -> list[tuple[int, int, str]]:
    first: dict = {}
    split = [(i, common.word_list(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k : k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone, own = [False] * len(w), set()
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            earlier = key in first and (i is None or first[key] < i)
            if earlier or key in own:
                gone[k : k + width] = [True] * width
            own.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_windows_match_brute_force(spark, tricky_docs, tricky, no_docs):
    done, name = windows.without_repeats(tricky_docs)
    assert name not in tricky_docs.columns and done.columns == [*tricky_docs.columns, name]
    got = sorted(
        (r[name]["n_words"], sum(s["to_word"] - s["from_word"] for s in r[name]["spans"]), hashlib.sha256(r[name]["kept_text"].encode()).hexdigest())
        for r in done.collect()
    )
    assert got == sorted(brute_windows(tricky))
    assert windows.without_repeats(no_docs)[0].count() == 0


def test_windows_query_on_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {i: found for (i, _), found in zip(rows, brute_windows(rows))}
    for r in queries.op6_substrings(spark, SF).collect():
        assert expected[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_sha256"])


def brute_chunks(rows) -> list[str | None]:
    split = []
    for i, t in rows:
        if t is None:
            split.append((i, None))
            continue
        lines, chunks, held = t.split("\n"), [], []
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        for k, line in enumerate(lines):
            held.append(line)
            if (h[k] + (31 * h[k - 1] if k else 0)) % line_chunks.DIVISOR == 0 or k == len(lines) - 1:
                chunks.append(held)
                held = []
        split.append((i, ["\n".join(c) if len(c) >= 2 and "\n".join(c).split() else ("\n".join(c),) for c in chunks]))
    first: dict = {}
    for i, chunks in split:
        for c in chunks or []:
            if isinstance(c, str) and i is not None:
                first[c] = min(first.get(c, i), i)
    out = []
    for i, chunks in split:
        if chunks is None:
            out.append(None)
            continue
        kept, own = [], set()
        for c in chunks:
            gone = isinstance(c, str) and ((c in first and (i is None or first[c] < i)) or c in own)
            own.add(c)
            if not gone:
                kept.append(c if isinstance(c, str) else c[0])
        out.append("\n".join(kept))
    return out


def test_chunks_match_brute_force(spark, tricky_docs, tricky, no_docs):
    cut, added = line_chunks.without_repeats(tricky_docs)
    assert cut.columns == [*tricky_docs.columns, *added.values()] and not set(added.values()) & set(tricky_docs.columns)
    got = sorted((r["text"] is None, r["text"] or "") for r in cut.collect())
    assert got == sorted((t is None, t or "") for t in brute_chunks(tricky))
    assert sum(r[added["n_removed"]] for r in cut.collect()) > 10
    assert line_chunks.without_repeats(no_docs)[0].count() == 0


def test_chunks_stay_in_built_in_expressions(spark, tricky_docs):
    plan = line_chunks.without_repeats(tricky_docs)[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_joined(rows) -> list[str | None]:
    """Chunks of any length; a run of neighbouring repeated ones goes if it has two lines or more."""
    split = []
    for i, t in rows:
        chunks, held = [], []
        lines = [] if t is None else t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        for k, line in enumerate(lines):
            held.append(line)
            if (h[k] + (31 * h[k - 1] if k else 0)) % line_chunks.DIVISOR == 0 or k == len(lines) - 1:
                chunks.append(held)
                held = []
        split.append((i, None if t is None else chunks))
    first: dict = {}
    for i, chunks in split:
        for c in chunks or []:
            if i is not None:
                first[tuple(c)] = min(first.get(tuple(c), i), i)
    out = []
    for i, chunks in split:
        own, repeats = set(), []
        for c in map(tuple, chunks or []):
            repeats.append(bool("".join(c).split()) and (c in own or (c in first and (i is None or first[c] < i))))
            own.add(c)
        near = [False, *repeats, False]
        gone = [r and (len(c) > 1 or near[k] or near[k + 2]) for k, (c, r) in enumerate(zip(chunks or [], repeats, strict=True))]
        kept = ["\n".join(c) for c, out_ in zip(chunks or [], gone, strict=True) if not out_]
        out.append(None if chunks is None else "\n".join(kept))
    return out


def test_joined_chunks_match_brute_force(spark, tricky_docs, tricky, no_docs):
    cut = line_chunks.without_repeats(tricky_docs, joined=True)[0]
    got = sorted((r["text"] is None, r["text"] or "") for r in cut.collect())
    assert got == sorted((t is None, t or "") for t in brute_joined(tricky))
    assert line_chunks.without_repeats(no_docs, joined=True)[0].count() == 0
    plan = cut._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [3, 10])
def test_copies_of_several_lines_go_whole(spark, n):
    rng = random.Random(n)
    texts = ["\n".join(f"line {rng.random()}" for _ in range(n)) for _ in range(20)]
    rows = [*enumerate(texts), *enumerate(texts, 100), *[(200 + i, f"one line {i}") for i in (1, 1, 2)]]
    got = line_chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), joined=True)[0].collect()
    left = {r["doc_id"]: r["text"] for r in got}
    assert left == {i: "" if 100 <= i < 200 else t for i, t in rows}  # single lines alone stay
