"""Token ids written in doc_id order as patched frame-of-reference segments, and read back.

The files are a Parquet table in shared storage whose column `data` holds one segment a row (see pfor), so that Spark's
own commit protocol covers lost and repeated tasks and any Hadoop file system can hold them. Shards are ranges of doc_id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.llm import pfor
from quillstone.llm.bpe_ids import Encoder, with_end
from quillstone.llm.session import arrow_map

#: A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 18
_FILE = "shard int, segment int, first long, n_docs int, n_ids long, data binary"


def write(documents: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Writes every whole text's ids and end_id, by ascending doc_id, below `path`.

    documents: doc_id, text; other columns don't matter. A null or empty text is the end_id alone. Null doc_ids come first;
    rows of equal doc_id go by a hash of their text. No rows give no segments. `first` counts the shard's ids before a segment.
    """

    def run(batches):
        shard = TaskContext.get().partitionId()
        encoder = Encoder.of(vocabulary)
        first, number = 0, 0
        docs, counts, ids = [], [], []

        def segment():
            whole, sizes = np.concatenate(ids), np.concatenate(counts)
            cells = (shard, number, first, len(sizes), len(whole), pfor.encode(whole, docs, sizes))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], ["shard", "segment", "first", "n_docs", "n_ids", "data"])

        held = 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            found, offsets = with_end(*encoder(batch.column("text")), end_id)
            i = 0
            while i < len(names):
                j = min(len(names), int(np.searchsorted(offsets, offsets[i] + SEGMENT_IDS - held)))
                docs += names[i:j]
                counts.append(np.diff(offsets[i : j + 1]))
                ids.append(found[offsets[i] : offsets[j]])
                held += len(ids[-1])
                i = j
                if held >= SEGMENT_IDS:
                    yield segment()
                    first, number, held, docs, counts, ids = first + held, number + 1, 0, [], [], []
        if docs:
            yield segment()
        encoder.forget()

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*key).sortWithinPartitions(*key)
    arrow_map(ordered, run, _FILE).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files below `path`, in no order."""
    files = spark.read.schema(_FILE).parquet(path)
    # One row per shard, as many as there were range partitions: so few that they are sent to the files, not the files to them.
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = pfor.Segment(row["data"])
                ids = segment.ids().astype("<u4")
                ends = np.cumsum(segment.counts)
                starts = ends - segment.counts
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(segment.doc_ids, pa.int64()), pa.array(starts + row["first"] + row["before"], pa.int64()), pa.array(segment.counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(files.join(F.broadcast(before), "shard").select("first", "before", "data"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
