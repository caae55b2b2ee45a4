"""Components of the links between text classes that share buckets.

Classes (texts with equal shingle sets) that share a bucket may be linked. A bucket of a few classes
may be compared whole (``linked_in_small``). A larger one is not expanded into pairs: in each round every class is verified against the likeliest of one pick per
bucket, and what links is joined into components. Then, in buckets that still hold several
components, classes outside the largest one are compared with the others, in pieces of bounded
size spread over tasks, and only pairs that the caller's test cannot refute leave the join. Two
classes of one component need no comparison: a link between them would change nothing. Links are
decided on full sets, made anew from the texts of the classes in question.

Buckets travel as (key, class) alone; what classes are compared by is joined to the few that are
compared. Rounds go on while they find links worth another one; the last step finds the rest, however
many rounds there were. Fixed cases: no buckets give no links; a class in no shared bucket has no root; rows
under one id are told apart by their class; columns of the caller's tables other than those named
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import shingle_sets, small
from terrace.llm.components import components
from terrace.operators.joins import balanced_join
from terrace.sources.tables import few, materialise


@dataclass(frozen=True)
class Comparison:
    """When two sets of ``width``-word shingles link, and how classes are compared before that is known.

    ``by`` names the columns of the classes that ``likely`` (whether a link is possible) and ``unlike``
    (the smaller the likelier) look at, under the two prefixes they are given. Pairs that ``likely``
    refutes are never verified, so it has to hold for all links.
    """

    width: int
    percent: int
    by: tuple[str, ...]
    likely: Callable[[str, str], Column]
    unlike: Callable[[str, str], Column]
    rounds: int = 6
    rows_per_piece: int = 1000


# Rounds end when one finds fewer new links than this share of all that rounds found so far.
_WORTH_A_ROUND = 0.1


def digest(hashes: np.ndarray) -> bytes:
    """The class of a set."""
    return blake2b(hashes.tobytes(), digest_size=16).digest()


@F.pandas_udf(T.LongType())
def _shared(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield pd.Series([
            len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
            for a, b in zip(left, right, strict=True)
        ], dtype="int64")


_SET = T.StructType([T.StructField("cls", T.BinaryType()), T.StructField("set", T.BinaryType())])


def verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, how: Comparison) -> DataFrame:
    """The pairs (a, b) of classes whose full sets link, made from one text of each class."""
    width, ends = how.width, 2 * pairs.count()

    @F.pandas_udf(_SET)
    def full(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in small(batches, 100):
            found = [s.tobytes() for s in shingle_sets(texts, width)]
            yield pd.DataFrame({"cls": [blake2b(s, digest_size=16).digest() for s in found], "set": found})

    named = materialise(few(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct(), ends), "named")
    # Stored, so that Spark knows the size of the ids beforehand and moves them, not the texts, while they are few.
    ids = materialise(few(named.join(classes, "cls").select(F.col("rep").alias("id")).distinct(), ends), "wanted-ids")
    # Stored too: Spark would else make sets of all texts first and look the ids up afterwards.
    texts = materialise(rows.join(ids, "id", "left_semi"), "texts")
    # Rows with one id may hold several texts, or the same one twice.
    sets = materialise(
        texts.select(full("text").alias("f")).select("f.*").join(named, "cls", "left_semi").dropDuplicates(["cls"]),
        "sets",
    )
    met = pairs
    for end in ("a", "b"):
        met = met.join(sets.select(F.col("cls").alias(end), F.col("set").alias(f"{end}_set"), (F.octet_length("set") / 8).cast("long").alias(f"{end}_n")), end)
    counted = met.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("both"), _shared("a_set", "b_set").alias("shared"))
    return materialise(
        counted.filter(F.col("shared") * 100 >= how.percent * (F.col("both") - F.col("shared"))).select("a", "b"), "links"
    )


def _near(pairs: DataFrame, classes: DataFrame, how: Comparison) -> DataFrame:
    """(a, b, unlike) of the pairs (a, b) that the test does not refute."""
    met = pairs
    for end, side in (("a", "x"), ("b", "y")):
        met = met.join(classes.select(F.col("cls").alias(end), F.struct(*how.by).alias(side)), end)
    return met.filter(how.likely("x", "y")).select("a", "b", how.unlike("x", "y").alias("unlike"))


def _likeliest(near: DataFrame) -> DataFrame:
    """For every class ``a`` the most similar of its possible partners."""
    best = near.groupBy("a").agg(F.min(F.struct("unlike", "b")).alias("best"))
    return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def _crossing(mixed: DataFrame, classes: DataFrame, how: Comparison) -> DataFrame:
    """Possible pairs of different components within a bucket, the largest one against the rest.

    A bucket's rows are cut into pieces of about ``rows_per_piece``; every class outside the
    largest component visits each piece, so no task holds more than a piece and its visitors.
    """
    sizes = mixed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.ceil(F.sum("n") / how.rows_per_piece).cast("int").alias("cuts")
    )
    marked = materialise(
        balanced_join(mixed, materialise(largest, "largest"), "key", "inner", keys_from=mixed).select(
            "key", "cls", "comp", "cuts", (F.col("comp") == F.col("main")).alias("in_main")
        ).join(classes.select("cls", *how.by), "cls"), "crossing",
    )
    x = marked.filter("NOT in_main").withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).alias("x")
    y = marked.withColumn("cut", F.pmod(F.xxhash64("cls"), "cuts").cast("int")).alias("y")
    met = x.join(
        y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cut") == F.col("y.cut")) & (F.col("x.comp") != F.col("y.comp"))
        & (F.col("y.in_main") | (F.col("x.cls") < F.col("y.cls"))) & how.likely("x", "y"),
    )
    return met.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


# Buckets of up to so many classes are compared whole: at most 3.5 pairs for each place in one.
SMALL_BUCKET = 8


def linked_in_small(
    rows: DataFrame, classes: DataFrame, members: DataFrame, roots: DataFrame, how: Comparison
) -> DataFrame:
    """``roots`` grown by the links within buckets of up to ``SMALL_BUCKET`` classes.

    Nothing of such a bucket is left for ``linked``: its pairs are compared once, not in every round.
    The likeliest pair of every class is verified first, then those whose classes are still apart.
    """
    together = members.groupBy("key").agg(F.sort_array(F.collect_list("cls")).alias("all"))
    pairs = together.select("all", F.posexplode("all").alias("i", "a")).select(
        "a", F.explode(F.slice("all", F.col("i") + 2, SMALL_BUCKET)).alias("b")
    ).distinct()
    near = materialise(_near(pairs, classes, how), "near")
    turned = near.select(F.col("b").alias("a"), F.col("a").alias("b"), "unlike")
    likeliest = materialise(few(_likeliest(near.union(turned)), 2 * near.count()), "pairs")
    roots = components(verified(likeliest, rows, classes, how), roots)
    apart = near.select("a", "b").join(likeliest, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        apart = apart.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    apart = apart.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    return components(verified(materialise(apart, "pairs"), rows, classes, how), roots)


def linked(
    rows: DataFrame, classes: DataFrame, members: DataFrame, roots: DataFrame, how: Comparison
) -> DataFrame:
    """(node, root) of the classes that link: root is the smallest class reachable.

    ``rows`` (id, text), ``classes`` (cls, rep: an id whose text it is, n_shingles, what they are compared by),
    ``members`` (key, cls), ``roots`` (node, root) known beforehand.
    """
    found, picking, round_ = 0, how.rounds > 0, 0
    while True:
        at = members.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
            "key", "cls", F.coalesce("root", "cls").alias("comp")
        )
        mixed = at.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"),
            F.min_by(F.struct("cls", "comp"), F.xxhash64("cls", "key", F.lit(round_))).alias("pick"),
        ).filter("lo <> hi").select("key", "pick")
        mixed = materialise(mixed, "mixed")
        if mixed.isEmpty():
            return roots
        met = materialise(balanced_join(at, mixed, "key", "inner", keys_from=members), "met")
        members = met.select("key", "cls")
        if picking:
            apart = met.filter(F.col("comp") != F.col("pick.comp"))
            picks = apart.select(F.col("cls").alias("a"), F.col("pick.cls").alias("b")).distinct()
            pairs = few(_likeliest(_near(picks, classes, how)), met.count())
        else:
            pairs = _crossing(met.select("key", "cls", "comp"), classes, how)
        new = verified(materialise(pairs, "pairs"), rows, classes, how)
        more = new.count()
        if more:
            roots = components(new, roots)
        if not picking:
            return roots
        found, round_ = found + more, round_ + 1
        # Whatever picks leave apart is compared in full.
        picking = round_ < how.rounds and more > _WORTH_A_ROUND * found


def own_links(named: DataFrame) -> DataFrame:
    """(a, b): classes of texts under one id are one document. ``named`` (id, cls)."""
    texts_of = named.groupBy("id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).filter("a <> z")
    return materialise(named.join(texts_of.select("id", "a"), "id").select("a", F.col("cls").alias("b")).distinct(), "own-links")


def with_component(signed: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``signed`` (id, cls, ...) with ``component``: the smallest id reachable, null for a null id."""
    labelled = classes.select("cls", "rep").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("root")
    )
    lowest = labelled.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = materialise(labelled.join(lowest, "root").select("cls", "component"), "components")
    return signed.join(of_class, "cls", "left").withColumn(
        "component", F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    )
