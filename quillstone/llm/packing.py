"""Best-fit packing of documents into sequences of fixed capacity by minimum bin slack.

Each bin takes the longest piece left and then, by a bitset subset-sum over the lengths that are left, the combination that
fills the bin best. Pieces of one length are alike, so the plan works on a histogram of at most `capacity` lengths: a
combination is used as often as its lengths last, which is what filling bin after bin does. So the driver holds counts and
patterns, both bounded by the capacity; pieces get their places by their rank within their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.bpe_ids import Encoder, with_end
from quillstone.llm.session import arrow_map, cut


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill `room` best; longer ones first where sums are equal."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, pieces per bin), ...]) until no piece is left."""
    left = {k: v for k, v in counts.items() if v}
    out = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        chosen = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((times, sorted(chosen.items(), reverse=True)))
    return out


def pieces(documents: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and part: the pieces of every whole text's ids and end_id.

    Only documents longer than the capacity are cut, into pieces of the capacity; the first may be shorter.
    """

    def run(batches):
        part, encoder = TaskContext.get().partitionId(), Encoder.of(vocabulary)
        for batch in batches:
            ids, offsets = with_end(*encoder(batch.column("text")), end_id)
            size = np.diff(offsets)
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            end = size[doc] - (n[doc] - 1 - piece) * capacity
            start = np.where(piece, end - capacity, 0)
            data, first = memoryview(ids.view(np.uint8)), offsets[doc]
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((first + start).tolist(), (first + end).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(end - start), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part, np.int32))], ["doc_id", "piece", "start", "length", "ids_crc32", "part"])
        encoder.forget()

    return arrow_map(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int")


def pack(documents: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece's place in a sequence of at most `capacity` ids.

    documents: doc_id, text; other columns don't matter. A null or empty text is the end_id alone, so each row, repeated ones
    and those with a null doc_id too, has a piece. No rows give no rows. Pieces of equal length are interchangeable: which of
    them goes where follows the input's partitions, then doc_id and piece.
    """
    cut_up = cut(pieces(documents, vocabulary, end_id, capacity))
    per_part = cut_up.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    of_length: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    bins = 0
    for times, chosen in plan(counts, capacity):
        offset = 0
        for length, n in chosen:
            of_length.setdefault(length, []).append((used.get(length, 0), n, bins, offset))
            used[length] = used.get(length, 0) + times * n
            offset += n * length
        bins += times
    places = {k: np.array(v, np.int64).T for k, v in of_length.items()}

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                first, n, bin_, at = places[int(k)]
                i = np.searchsorted(first, rank[own], "right") - 1
                nth = rank[own] - first[i]
                sequence[own] = bin_[i] + nth // n[i]
                offset[own] = at[i] + nth % n[i] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    before = per_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = cut_up.withColumn("within", within).join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("within") - 1).alias("rank"))
    return arrow_map(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
