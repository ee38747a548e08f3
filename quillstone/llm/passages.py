"""Substring dedup by sliding sentence spans.

A sentence ends with a word that ends in . ! or ? (closing quotes and brackets may follow), or before a line break, and is cut
further after the word of least hash of each WINDOW words in it. So sentences have at most WINDOW words, and whether one ends
with a word is told by fewer than WINDOW words on either side. A span is the shortest run of consecutive sentences from one on
that has SENTENCES sentences and WORDS words. Each span's hash meets its equals over all documents; sentences covered by any
span that isn't the first of its kind are removed.

Any 51 words that two texts share hold a span, wherever they begin and end: cuts fall alike after the words 7 to 43 of them
(from 0), one of the words 7 to 14 is cut after, and the span from there on ends with one of the next 20 to 27 words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.session import arrow_map, cut, delete, free_prefix, table
from quillstone.llm.words import Words, mix, raw

SENTENCES, WORDS, WINDOW = 3, 20, 8
#: Bits for a span's number of sentences, which is at most the greater of SENTENCES and WORDS, as each has a word.
_SPAN_BITS = 20
_STOP, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSE[list(b"\"')]}")] = True


class Sentences:
    """first: index of each sentence's first word, and the number of words; of: each text's first sentence, and their number."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = raw(column)
        self.words = w = Words(self.data, self.offsets)
        self.hashes = w.hashes()
        n = len(self.hashes)
        last = self.data[w.ends - 1] if n else np.zeros(0, np.uint8)
        prior = np.where(w.ends - 2 >= w.starts, self.data[np.maximum(w.ends - 2, 0)], 0) if n else last
        ends = _STOP[last] | (_CLOSE[last] & _STOP[prior])
        if n:
            breaks = np.zeros(len(self.data) + 1, np.int64)
            np.cumsum(self.data == 10, out=breaks[1:])
            ends[:-1] |= breaks[w.starts[1:]] > breaks[w.ends[:-1]]
            ends[-1] = True
            ends[w.first[1:][w.first[1:] > 0] - 1] = True
            if n >= WINDOW:
                closed = np.concatenate([[0], np.cumsum(ends)])
                within = np.flatnonzero(closed[WINDOW - 1 : n] == closed[: n - WINDOW + 1])
                least = np.lib.stride_tricks.sliding_window_view(self.hashes, WINDOW).argmin(axis=1)
                ends[within + least[within]] = True
        self.first = np.concatenate([[0], np.flatnonzero(ends) + 1])
        self.of = np.searchsorted(self.first, w.first)

    def spans(self) -> tuple[np.ndarray, ...]:
        """text, place of the first sentence, sentences, two hashes of every span, in order."""
        n = len(self.first) - 1
        text = np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))
        start = np.arange(n)
        end = np.maximum(np.searchsorted(self.first, self.first[:-1] + WORDS), start + SENTENCES)
        fits = end <= self.of[1:][text] if n else np.zeros(0, bool)
        text, start, end = text[fits], start[fits], end[fits]
        # A span's hash: a polynomial over its words' hashes.
        total = []
        for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)):
            up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(self.hashes), salt)]))
            down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(self.hashes), np.uint64(pow(int(salt), -1, 1 << 64)))]))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.hashes ^ salt) * up[:-1])]).astype(np.uint64)
            a, b = self.first[start], self.first[end]
            total.append(mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))
        return text, start - self.of[:-1][text], end - start, total[0].view(np.int64), (total[1] >> np.uint64(33)).astype(np.int32)


def _again(text: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which spans repeat an earlier one of their own text."""
    order = np.lexsort((np.arange(len(text)), h2, h1, text))
    same = (text[order][1:] == text[order][:-1]) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    out = np.zeros(len(text), bool)
    out[order[1:][same]] = True
    return out


def _spans(documents: DataFrame) -> DataFrame:
    """key, text_hash, span (place and length), h1, h2 of each document's distinct spans."""

    def run(batches):
        for batch in batches:
            text, place, size, h1, h2 = Sentences(batch.column("text")).spans()
            new = ~_again(text, h1, h2)
            text = pa.array(text[new])
            span = place[new] << _SPAN_BITS | size[new]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(text), batch.column("text_hash").take(text), pa.array(span), pa.array(h1[new]), pa.array(h2[new])], ["key", "text_hash", "span", "h1", "h2"])

    return arrow_map(documents.select(*_identity(documents), "text"), run, "key long, text_hash long, span long, h1 long, h2 int")


def _identity(documents: DataFrame):
    return [F.coalesce(documents["doc_id"], F.lit((1 << 63) - 1)).alias("key"), F.xxhash64(documents["text"]).alias("text_hash")]


def _repeats(documents: DataFrame) -> DataFrame:
    """key, text_hash, spans: the spans of a document that an earlier document has."""
    spark = documents.sparkSession
    found, path = table(_spans(documents), "spans")
    content = ["h1", "h2"]
    repeated = found.groupBy(*content).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(*content)
    met, met_path = table(found.join(repeated, content), "repeated-spans")
    first = met.groupBy(*content).agg(F.min(F.struct("key", "text_hash")).alias("first"))
    later = met.join(first, content).where((F.col("key") != F.col("first.key")) | (F.col("text_hash") != F.col("first.text_hash")))
    out = cut(later.groupBy("key", "text_hash").agg(F.collect_set("span").alias("spans")))
    delete(spark, path)
    delete(spark, met_path)
    return out


def dedup_passages(documents: DataFrame) -> DataFrame:
    """documents with text without its repeated passages, and __n_sentences, __n_removed, __removed_words (more underscores where documents has such names: free_prefix()).

    The first of equal spans is the one of smallest doc_id (null last) and, of one doc_id, smallest hash of the text, in it the earliest. documents: doc_id, text and any
    others, which stay as they are. Null stays null; texts of fewer than SENTENCES sentences or WORDS words have no spans and
    stay. Rows that share a doc_id, or have none, are documents of their own if their texts differ; rows equal in both count as one document and keep the same sentences. White space after a removed sentence goes
    with it. A text may lose all its sentences. Very long texts are hashed whole. No rows give no rows.
    """
    prefix = free_prefix(documents.columns)
    key_, hash_, spans_, *report = (f"{prefix}{x}" for x in ("key", "text_hash", "spans", "n_sentences", "n_removed", "removed_words"))
    repeats = _repeats(documents.select("doc_id", "text")).select(F.col("key").alias(key_), F.col("text_hash").alias(hash_), F.col("spans").alias(spans_))
    key, text_hash = _identity(documents)
    rows = documents.select("*", key.alias(key_), text_hash.alias(hash_)).join(repeats, [key_, hash_], "left").drop(key_, hash_)
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            s = Sentences(column)
            n = len(s.first) - 1
            step = np.zeros(n + 1, np.int64)
            text, place, size, h1, h2 = s.spans()
            again = np.flatnonzero(_again(text, h1, h2))
            begin = s.of[:-1][text[again]] + place[again]
            np.add.at(step, begin, 1)
            np.add.at(step, begin + size[again], -1)
            for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for span in spans or ():
                    begin, length = s.of[i] + (span >> _SPAN_BITS), span & ((1 << _SPAN_BITS) - 1)
                    step[begin] += 1
                    step[begin + length] -= 1
            gone = np.cumsum(step[:-1]) > 0
            words = np.diff(s.first)
            texts, removed, lost = column.to_pylist(), [], []
            for i in range(len(texts)):
                a, b = s.of[i], s.of[i + 1]
                own = gone[a:b]
                removed.append(int(own.sum()))
                lost.append(int(words[a:b][own].sum()))
                if own.any():
                    texts[i] = _without(s, i, own)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(s.of)), pa.array(removed, pa.int64()), pa.array(lost, pa.int64())], [*batch.schema.names[:-1], *report])

    schema = rows.drop(spans_).schema
    for name in report:
        schema = schema.add(name, "long")
    return arrow_map(rows, run, schema)


def _without(s: Sentences, i: int, gone: np.ndarray) -> str:
    a = s.of[i]
    starts = s.words.starts[s.first[a : a + len(gone)]]
    edges = [*starts.tolist(), int(s.offsets[i + 1])]
    parts = [s.data[s.offsets[i] : edges[0]]] + [s.data[edges[k] : edges[k + 1]] for k in np.flatnonzero(~gone)]
    return np.concatenate(parts).tobytes().decode()
