"""Line de-duplication by content-defined chunks of lines, in built-in expressions only.

A hash rolls over the hashes of two neighbouring lines; a chunk ends where it falls on a
multiple of ``DIVISOR``. Boundaries follow the content, so lines inserted into a passage
move them only nearby. A chunk of several lines that also stands in a document with a
smaller id, or earlier in the same document, is removed.

Equality is decided on bytes: chunks are grouped by hash and text. Copies of a chunk meet
within each task before anything is shuffled, so a passage in a third of all documents
arrives as one row per task. Where two different texts share a hash, none of them is
removed. A text is never sent to another text for comparison.

Fixed cases: null texts stay null and empty ones empty, with no lines removed; a chunk
without a word is left alone; null ids count as greater than all others and never take
text from each other; rows with one id are one document in several parts: no part loses a
chunk to another, only to an earlier place in itself; rows equal in id and text fare
alike. Other columns pass through ``without_repeats`` untouched.

With ``joined`` single-line chunks are judged too, and neighbouring chunks that repeat are
judged together: a run of them goes if it has two lines or more. A copy of several lines then
goes whole, as equal texts have equal boundaries. Every removed line stays at an earlier place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import fresh, only, quoted
from terrace.sources.tables import materialise

DIVISOR = 3
MIN_LINES = 2

_HEX_DIGITS = 7
_BLANK = r"^[\x20\x09-\x0D]*$"


def _line_hash(line: Column) -> Column:
    return F.conv(F.left(F.md5(line), F.lit(_HEX_DIGITS)), 16, 10).cast("long")


def _with_chunks(rows: DataFrame) -> DataFrame:
    """Adds ``chunks``: the text's lines cut at content-defined places, in order."""
    hashed = rows.withColumn("lines", F.split("text", "\n", -1)).withColumn(
        "hashes", F.transform("lines", _line_hash)
    )

    def ends(i: Column) -> Column:
        """Whether a chunk ends with line ``i``, counted from 1."""
        before = F.coalesce(F.get("hashes", i - 2), F.lit(0))
        rolled = F.get("hashes", i - 1) + before * 31
        return (rolled % DIVISOR == 0) | (i == F.size("lines"))

    cut = hashed.withColumn("ends", F.filter(F.sequence(F.lit(1), F.size("lines")), ends))

    def chunk(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("ends", k - 1), F.lit(0))
        return F.struct(
            k.alias("no"), (end - start).alias("n_lines"),
            F.array_join(F.slice("lines", start + 1, end - start), "\n").alias("text"),
        )

    return cut.withColumn("chunks", F.transform("ends", chunk)).drop("hashes", "ends")


def _with_places(rows: DataFrame, least: int) -> DataFrame:
    """Adds ``places``: the chunks of ``least`` lines or more as (hash, no, repeat of an earlier one in this text)."""
    sized = F.filter("chunks", lambda c: (c["n_lines"] >= least) & ~c["text"].rlike(_BLANK))
    by_hash = rows.withColumn(
        "sorted", F.sort_array(
            F.transform(sized, lambda c: F.struct(F.xxhash64(c["text"]).alias("hash"), c["no"].alias("no")))
        )
    )

    def place(x: Column, j: Column) -> Column:
        last = F.get("sorted", j - 1)
        same = (last["hash"] == x["hash"]) & (
            F.get("chunks", last["no"])["text"] == F.get("chunks", x["no"])["text"]
        )
        # get() of -1 is null.
        return F.struct(x["hash"].alias("hash"), x["no"].alias("no"), F.coalesce(same, F.lit(False)).alias("repeat"))

    return by_hash.withColumn("places", F.transform("sorted", place)).drop("sorted")


def _chunked(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    rows = only(docs, id=id_col, text=text_col).filter("text IS NOT NULL")
    return _with_places(_with_chunks(rows), least)


def _exploded(chunked: DataFrame) -> DataFrame:
    # A plain explode() makes Spark test the array for emptiness first, far below, where the
    # whole nest of array expressions would be written out and evaluated once more per element.
    rows = chunked.select("id", F.xxhash64("text").alias("text_hash"), "chunks", F.explode_outer("places").alias("place"))
    return rows.filter("place IS NOT NULL")


def repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LINES
) -> DataFrame:
    """(hash, first): chunk texts found under several ids, and the smallest of these ids."""
    found = _exploded(_chunked(docs, id_col, text_col, least)).select(
        "id", F.col("place.hash").alias("hash"), F.get("chunks", F.col("place.no"))["text"].alias("chunk")
    )
    # Grouping by the text itself is the comparison of bytes.
    texts = found.groupBy("hash", "chunk").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("unnamed")
    )
    return (
        texts.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("last").alias("last"),
             F.max("unnamed").alias("unnamed"))
        .filter((F.col("texts") == 1) & ((F.col("first") < F.col("last")) | F.col("unnamed")))
        .filter(F.col("first").isNotNull())
        .select("hash", "first")
    )


def removals(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LINES
) -> DataFrame:
    """(id, text_hash, removed): numbers of the chunks that repeat, for texts that hold any."""
    # Stored, so that the join below sees its true size and may split a hot hash.
    repeated = materialise(repeated_chunks(docs, id_col, text_col, least), "repeated-chunks")
    places = _exploded(_chunked(docs, id_col, text_col, least))
    known = places.select("id", "text_hash", "place.hash", "place.no", "place.repeat")
    elsewhere = known.join(repeated, "hash", "left").filter(
        F.col("repeat") | F.coalesce(F.col("id") > F.col("first"), F.col("first").isNotNull() & F.col("id").isNull())
    )
    return elsewhere.groupBy("id", "text_hash").agg(F.collect_set("no").alias("removed"))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", joined: bool = False
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns with the repeated chunks cut out of the text.

    Also returns the names of three added columns: lines before, lines removed, chunks removed.
    """
    gone = removals(docs, id_col, text_col, 1 if joined else MIN_LINES)
    names = {stem: fresh(docs, stem) for stem in ("n_lines", "n_removed", "n_chunks_removed")}
    # The pieces carry the operator's own names; the row itself rides along in one struct.
    rows = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("row"), quoted(id_col).alias("id"), quoted(text_col).alias("text")
    )
    met = rows.alias("d").join(
        gone.alias("g"),
        F.col("d.id").eqNullSafe(F.col("g.id")) & (F.xxhash64("d.text") == F.col("g.text_hash")), "left",
    ).select("row", "d.text", "removed")
    cut = _with_chunks(met)
    if joined:
        # A chunk of one line goes only beside another that goes.
        run = F.filter("removed", lambda no: (
            (F.get("chunks", no)["n_lines"] >= MIN_LINES) | F.array_contains("removed", no - 1) | F.array_contains("removed", no + 1)
        ))
        cut = cut.withColumn("removed", F.when(F.size(run) > 0, run))
    # Chunks and removal marks sorted together: a chunk goes when its mark follows it.
    marked = cut.withColumn("all", F.when(F.col("removed").isNotNull(), F.sort_array(F.concat(
        F.transform("chunks", lambda c: F.struct(c["no"].alias("no"), F.lit(0).alias("mark"), c["n_lines"].alias("n_lines"), c["text"].alias("text"))),
        F.transform("removed", lambda no: F.struct(no.alias("no"), F.lit(1).alias("mark"), F.lit(0).alias("n_lines"), F.lit("").alias("text"))),
    ))))

    def stays(x: Column, j: Column) -> Column:
        follower = F.get("all", j + 1)
        return (x["mark"] == 0) & ~F.coalesce((follower["no"] == x["no"]) & (follower["mark"] == 1), F.lit(False))

    kept = marked.withColumn("kept", F.filter("all", stays))
    n_lines = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size("lines"))
    lines_kept = F.aggregate("kept", F.lit(0), lambda total, c: total + c["n_lines"])
    lost = F.col("removed").isNotNull()
    new_text = F.when(lost, F.array_join(F.transform("kept", lambda c: c["text"]), "\n")).otherwise(F.col("text"))
    out = kept.select(
        *[(new_text.alias(c) if c == text_col else F.col("row").getField(c).alias(c)) for c in docs.columns],
        n_lines.cast("long").alias(names["n_lines"]),
        F.when(lost, F.size("lines") - lines_kept).otherwise(0).cast("long").alias(names["n_removed"]),
        F.when(lost, F.size("removed")).otherwise(0).cast("long").alias(names["n_chunks_removed"]),
    )
    return out, names


# ``without_repeats`` in SQL for a table documents(doc_id, text) with unique ids.
ORACLE_SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, {_HEX_DIGITS}) AS BIGINT) AS h FROM lines
), rolled AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {DIVISOR} = 0 AS ends FROM hashed
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
  FROM rolled
), chunks AS (
  SELECT doc_id, no, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY doc_id, no
), ranked AS (
  SELECT *, n >= {MIN_LINES} AND regexp_matches(chunk, '[^\x20\x09-\x0D]')
    AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) > 1 AS gone
  FROM chunks
), kept AS (
  SELECT doc_id, sum(n) AS n_lines, coalesce(sum(n) FILTER (gone), 0) AS n_removed,
    count(*) FILTER (gone) AS n_chunks_removed,
    coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text
  FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, CAST(CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE k.n_lines END AS BIGINT) AS n_lines,
  CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(k.n_chunks_removed, 0) AS BIGINT) AS n_chunks_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE sha256(k.text) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
