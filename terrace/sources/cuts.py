"""Cuts large CSV files with quoted line breaks between records, so that many tasks can read them.

Such a file cannot be split blindly: whether a line break ends a record depends on all quotes
before it. Every task scans one byte range and tells two things: whether the range holds an odd
number of quotes, and where its first record would begin if the range started outside of quotes
and if it started inside. A running parity over the ranges then says which of the two holds. The
stretches between these places are copied, each behind the file's header, to files of their own
in the shared work folder, and Spark's CSV reader parses those.

A quote within a quoted field is written twice, which leaves the parity as it is. A file with an
odd number of quotes has a stray one; it is copied whole and parsed as one piece. So is a compressed
file: its bytes are not the text that the CSV reader unpacks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.session import work_folder
from terrace.sources import storage
from terrace.sources.tables import materialise

# Names that the CSV reader takes for compressed files.
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"

_SCANNED = "uri string, bytes long, no long, odd int, outside long, inside long"


def _range_worker(job: str, range_bytes: int):
    """Tasks over byte ranges. An inner function, so that executors need not have this package installed."""
    chunk_bytes = 8 << 20

    def opened(uri):
        from urllib.parse import quote

        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe=":/@"))
        return store, path

    def first_break(data, parity, wanted):
        """Place of the first line break in ``data`` with ``wanted`` parity of quotes before it, or -1."""
        import numpy as np

        raw = np.frombuffer(data, np.uint8)
        breaks = np.flatnonzero(raw == 10)
        before = (np.cumsum(raw == 34)[breaks] + parity) % 2
        found = np.flatnonzero(before == wanted)
        return int(breaks[found[0]]) if len(found) else -1

    def scan(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for uri, size, no in zip(batch["uri"], batch["bytes"], batch["no"], strict=True):
                store, path = opened(uri)
                at, end, parity, starts = no * range_bytes, min(size, (no + 1) * range_bytes), 0, [-1, -1]
                with store.open_input_file(path) as file:
                    file.seek(at)
                    while at < end:
                        data = file.read(min(chunk_bytes, end - at))
                        for state in (0, 1):
                            if starts[state] < 0:
                                place = first_break(data, parity, state)
                                starts[state] = at + place + 1 if place >= 0 else -1
                        parity = (parity + data.count(b'"')) % 2
                        at += len(data)
                rows.append((uri, size, no, parity, *starts))
            yield pd.DataFrame(rows, columns=["uri", "bytes", "no", "odd", "outside", "inside"])

    def copy(batches):
        for batch in batches:
            for uri, start, stop, target in zip(batch["uri"], batch["start"], batch["stop"], batch["target"], strict=True):
                store, path = opened(uri)
                out_store, out_path = opened(target)
                folder, _, name = out_path.rpartition("/")
                out_store.create_dir(folder, recursive=True)
                partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
                with store.open_input_file(path) as file, out_store.open_output_stream(partial, compression=None) as out:
                    if start:
                        # The header: everything up to the first line break outside of quotes.
                        parity, place = 0, -1
                        while place < 0 and (data := file.read(chunk_bytes)):
                            place = first_break(data, parity, 0)
                            out.write(data if place < 0 else data[: place + 1])
                            parity = (parity + data.count(b'"')) % 2
                    file.seek(start)
                    while start < stop:
                        data = file.read(min(chunk_bytes, stop - start))
                        out.write(data)
                        start += len(data)
                out_store.move(partial, out_path)
            yield batch[["target"]]

    return {"scan": scan, "copy": copy}[job]


def cut_between_records(spark: SparkSession, files: DataFrame, range_bytes: int, scratch: str = "") -> str:
    """Folder, below ``scratch`` in the work folder, with the pieces of the files (uri, bytes), in name order as the files and their records are."""
    folder = storage.qualified(spark, "/".join(filter(None, (work_folder(spark), scratch, f"cuts-{uuid.uuid4().hex[:8]}"))))
    packed = F.col("uri").rlike(PACKED)
    last = F.when(packed, F.lit(0)).otherwise(F.greatest(F.ceil(F.col("bytes") / range_bytes) - 1, F.lit(0)))
    ranges = files.select("uri", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("no"))
    scanned = materialise(ranges.repartition("uri", "no").mapInPandas(_range_worker("scan", range_bytes), _SCANNED), "ranges")
    # One row per range: a file of a terabyte has a few thousand.
    by_file = Window.partitionBy("uri").orderBy("no")
    odd_before = F.coalesce(F.sum("odd").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    stray = F.sum("odd").over(Window.partitionBy("uri")) % 2 == 1
    begun = F.when(odd_before == 1, F.col("inside")).otherwise(F.col("outside"))
    start = F.when(F.col("no") == 0, F.lit(0)).when(~stray & (begun >= 0) & (begun < F.col("bytes")), begun)
    starts = scanned.select("uri", "bytes", "no", start.alias("start")).filter("start IS NOT NULL")
    pieces = starts.withColumn("stop", F.coalesce(F.lead("start").over(by_file), F.col("bytes"))).filter("start < stop OR no = 0")
    name = F.concat(F.lit(f"{folder}/"), F.regexp_extract("uri", r"ingestion_date=[^/]+/(.+)$", 1), F.format_string("/part-%08d.csv", "no"), F.regexp_extract("uri", PACKED, 0))
    targets = pieces.select("uri", "start", "stop", name.alias("target"))
    targets.repartition("uri", "start").mapInPandas(_range_worker("copy", range_bytes), "target string").write.format("noop").mode("overwrite").save()
    return folder
