"""Quality rules, quality classifier and toxicity."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import forest, gam, queries, textstats, toxicity

SF = "/root/testdata/sf0.01"


def brute_counts(text: str | None) -> tuple[int, ...]:
    import re

    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = Counter(windows)
    covered = {k for i, w in enumerate(windows) if times[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_counts_match_brute_force(tricky):
    rng = random.Random(0)
    texts = [t for _, t in tricky] + [
        " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n", "|#", "\x0b", "\x85", "\xa0"]) for _ in range(200)
    ]
    for text in texts:
        assert textstats.counts(text)[:5] == brute_counts(text), text


def test_many_distinct_words_use_the_exact_wide_path():
    ids = np.concatenate([np.arange(9000), np.arange(5)])
    assert textstats.repeated_words(ids) == 10
    assert textstats.repeated_words(np.arange(9000)) == 0


def test_rules_on_tricky_rows(spark, tricky_docs, tricky, no_docs):
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(100, 115)] + [(100, 0, 0), (None, 1, 0), (101, None, 0)], "doc_id long, quality int, toxic int"
    )
    got = forest.judge(tricky_docs, labels).collect()
    assert len(got) == len(tricky)
    for row in got:
        assert row["base_failed"] == (row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"])
        assert not (row["base_failed"] and row["kept"])
    kept = forest.keep_good(tricky_docs, labels)
    assert kept.columns == tricky_docs.columns
    assert sorted(r["doc_id"] or -1 for r in got if r["kept"]) == sorted(r["doc_id"] or -1 for r in kept.collect())
    assert forest.keep_good(no_docs, labels.limit(0)).count() == 0
    only_base = forest.judge(tricky_docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in only_base)


def test_rules_keep_good_and_reject_bad(spark):
    got = queries.op9_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    passed = got[~got.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.98
    assert passed[passed.quality == 0].kept.mean() < 0.1


@pytest.mark.parametrize("name,target", [("op10_quality", "quality"), ("op1_toxicity", "toxic")])
def test_held_out_rows_are_predicted(spark, name, target):
    got = queries.QUERIES[name](spark, SF)
    assert got.count() == 1000
    held = got.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert held.score.between(0, 1).all()
    assert (held.predicted == held[target]).mean() > 0.9


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.train(x, y)
    assert (0, 1) in model.pairs
    assert ((textstats.logistic(model.log_odds(x)) > 0.5) == y).mean() > 0.95
    assert ((textstats.logistic(gam.train(x, y, gam.Settings(pairs=0)).log_odds(x)) > 0.5) == y).mean() < 0.7


def test_models_without_labels_or_rows(spark, tricky_docs, tricky, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (gam, toxicity):
        model = module.fit(tricky_docs, none)
        scores = tricky_docs.select(module.score(model, F.col("text")).alias("s")).collect()
        assert len(scores) == len(tricky) and {r["s"] for r in scores} == {0.5}
        assert no_docs.select(module.score(module.fit(no_docs, none), F.col("text"))).count() == 0


def test_repeated_and_null_labels(spark, tricky_docs):
    labels = spark.createDataFrame(
        [(100 + i, i % 2, i % 2) for i in range(20)] * 3 + [(None, 1, 1), (101, None, None), (999, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for module in (gam, toxicity):
        scores = tricky_docs.select(module.score(module.fit(tricky_docs, labels), F.col("text")).alias("s")).collect()
        assert all(0 <= r["s"] <= 1 for r in scores)


def test_swapped_identity_terms_do_not_move_the_score():
    """In training, one group is only ever named in toxic texts, another only in neutral ones."""
    rng = random.Random(1)
    filler = ["river", "table", "window", "paper", "garden", "stone"]
    texts, y = [], []
    for i in range(600):
        toxic = i % 2
        named = ["muslim"] if toxic and rng.random() < 0.6 else ["christian"] if not toxic and rng.random() < 0.6 else []
        insult = ["idiot"] if toxic and rng.random() < 0.8 else []
        texts.append(set(rng.sample(filler, 3) + named + insult))
        y.append(float(toxic))
    vocabulary = sorted(set().union(*texts))
    seen = [np.array(sorted(vocabulary.index(w) for w in t)) for t in texts]

    def gap(strength: float) -> tuple[float, float]:
        model = toxicity.train(seen, np.array(y), vocabulary, toxicity.Settings(counterfactual=strength, inserted=0.0))
        one, other = model.log_odds("the muslim in the garden"), model.log_odds("the christian in the garden")
        return abs(one - other), textstats.logistic(np.array([model.log_odds("an idiot in the garden")]))[0]

    plain, fair = gap(0.0), gap(5.0)
    assert plain[0] > 4 and fair[0] < 0.25 * plain[0]
    assert fair[1] > 0.5


def test_toxicity_scores_do_not_depend_on_word_order():
    model = toxicity.WordModel(0.1, {w.encode(): 0.1 * i for i, w in enumerate("abcdefgh")})
    assert model.log_odds("a b c d e f g h") == model.log_odds("h G f e D c b a")


def test_sentences_decide_what_a_swap_takes_away():
    wanted = {b"muslim", b"woman"}
    assert toxicity.lone_words("A muslim woman. The woman left!", wanted) == {b"muslim"}
    assert toxicity.lone_words(None, wanted) == set() and toxicity.lone_words("nobody. here", wanted) == set()
    kin = toxicity._kin({"muslim": 0, "jewish": 1, "hindu": 2}, toxicity.Settings())
    lost, gained, _ = toxicity._swaps([np.array([0, 1])], [np.array([0])], kin)
    # Jewish is there already and stays; muslim goes with its one sentence.
    assert sorted(zip(lost.tolist(), gained.tolist(), strict=True)) == [(-1, 2), (0, -1), (0, -1), (0, 2)]


def test_the_penalty_is_at_work_on_the_given_tables(spark):
    """Weights with and without it differ, swaps move the score less, and accuracy stays."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fair, plain = (toxicity.fit(docs, labels, settings=toxicity.Settings(counterfactual=c)) for c in (1.0, 0.0))
    assert fair.pairs == plain.pairs > 1000
    assert fair.weights != plain.weights and fair.gap < 0.5 * plain.gap
    print(fair.pairs, plain.gap, fair.gap)
    met = docs.join(labels, "doc_id").select("toxic", toxicity.score(fair, F.col("text")).alias("s")).toPandas()
    assert ((met.s >= 0.5) == (met.toxic == 1)).mean() > 0.95


def brute_train(seen, y, size, steps, rate, ridge):
    """The same regression without penalty, row by row."""
    w, b = [0.0] * size, 0.0
    m, v = [0.0] * (size + 1), [0.0] * (size + 1)
    share = sum(y) / len(y)
    for step in range(1, steps + 1):
        grad = [ridge * x for x in w] + [0.0]
        for ids, label in zip(seen, y, strict=True):
            p = 1 / (1 + np.exp(-(b + sum(w[i] for i in ids))))
            e = (0.5 / share if label else 0.5 / (1 - share)) * (p - label) / len(y)
            for i in ids:
                grad[i] += e
            grad[-1] += e
        for i, g in enumerate(grad):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            move = rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
            if i < size:
                w[i] -= move
            else:
                b -= move
    return w, b


def test_word_weights_match_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(6)]
    seen = [np.array(sorted(rng.sample(range(6), rng.randint(0, 4))), np.int64) for _ in range(40)]
    y = [float(0 in s.tolist() or rng.random() < 0.2) for s in seen]
    settings = toxicity.Settings(steps=25)
    model = toxicity.train(seen, np.array(y), vocabulary, settings)
    w, b = brute_train([s.tolist() for s in seen], y, 6, 25, settings.rate, settings.ridge)
    assert np.allclose([model.weights[x.encode()] for x in vocabulary], w) and np.isclose(model.start, b)


def test_path_lengths_match_a_walk():
    """Forest scores against a walk down every tree, row by row."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    grown = forest.grow(x, np.arange(60) < 50, forest.Settings(trees=12, tree_rows=32, depth=6))
    expected = []
    for r in x:
        total = 0.0
        for t in range(len(grown.feature)):
            node = 0
            while grown.left[t, node] != node:
                node = (grown.left if r[grown.feature[t, node]] < grown.cut[t, node] else grown.right)[t, node]
            total += grown.length[t, node]
        expected.append(2 ** -(total / len(grown.feature) / grown.normal))
    assert np.allclose(grown.scores(x), expected)


def test_table_sums_match_lookups():
    """Additive scores against a lookup per feature and pair, row by row."""
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(300, 3))
    model = gam.train(x, ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float))
    expected = []
    for r in x[:50]:
        total = model.start + sum(table[np.searchsorted(edges, r[f], side="right")] for f, (edges, table) in enumerate(zip(model.edges, model.tables)))
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[np.searchsorted(model.pair_edges[a], r[a], side="right"), np.searchsorted(model.pair_edges[b], r[b], side="right")]
        expected.append(total)
    assert np.allclose(model.log_odds(x[:50]), expected)


def test_a_bounded_sample_is_the_smallest_hashes(spark):
    from terrace.llm.common import bounded

    rows = spark.range(20_000).withColumn("x", F.col("id") % 3)
    for most in (100, 15_000, 30_000):
        whole = rows.orderBy(F.xxhash64("id"), "id").limit(most)
        assert sorted(bounded(rows, most, [F.col("id")], ["id"]).collect()) == sorted(whole.collect())


def test_forest_on_an_empty_table(spark, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert forest.judge(no_docs, labels).count() == 0 and forest.keep_good(no_docs, labels).count() == 0
