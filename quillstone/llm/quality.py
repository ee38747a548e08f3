"""Quality rules: fixed base rules and gradient-boosted trees over statistics of whole documents.

The trees are fitted to labelled documents, at most SAMPLE of them, those of smallest hash of their id. The probability of
good quality never rises with the share of symbols, of repeated lines or of repeated words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm import boosting
from quillstone.llm.session import arrow_map
from quillstone.llm.words import SPACE, Words, raw, shingles

#: Labelled documents to fit at most; words of a window; the least probability of good quality that is kept.
SAMPLE, WINDOW, LEAST = 8000, 8, 0.5
#: Base rules: the fewest words, and the most percent of words in repeated windows.
FEWEST_WORDS, MOST_REPEATED = 20, 30


def _class(characters: str | bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode() if isinstance(characters, str) else characters)] = True
    return out


_SYMBOL = _class("#*$%&|<>")
_UPPER, _LOWER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class("0123456789")
_MARK, _SHOUT = _class(".,;:"), _class("!?")
_INSIDE = (np.arange(256) & 0xC0) == 0x80  # bytes that go on a code point

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words", "word_length", "symbols", "upper", "digits", "marks", "shouts", "dup_lines", "repeats", "line_words", "distinct")
MONOTONE = np.array([{"symbols": -1, "dup_lines": -1, "repeats": -1}.get(f, 0) for f in FEATURES])


def measure(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts, COUNTS) as integers and (texts, FEATURES) as floats, of whole texts; null: no words."""
    data, offsets = raw(column)
    words = Words(data, offsets)
    hashes = words.hashes()

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    n = len(offsets) - 1
    n_words = np.diff(words.first)
    chars = per_text(~SPACE[data] & ~_INSIDE[data])
    symbols, upper, lower, digits, marks, shouts = (per_text(c[data]) for c in (_SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _SHOUT))
    dup_lines, lines, repeats, distinct = (np.zeros(n, np.int64) for _ in range(4))
    for i in range(n):
        found = [x for x in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
        lines[i], dup_lines[i] = len(found), len(found) - len(set(found))
        own = hashes[words.first[i] : words.first[i + 1]]
        distinct[i] = len(np.unique(own))
        if len(own) > WINDOW:
            _, which, times = np.unique(shingles(own, WINDOW), return_inverse=True, return_counts=True)
            if len(times) < len(which):
                step = np.zeros(len(own) + 1, np.int64)
                again = np.flatnonzero(times[which] > 1)
                np.add.at(step, again, 1)
                np.add.at(step, again + WINDOW, -1)
                repeats[i] = np.count_nonzero(np.cumsum(step[:-1]))
    some = np.maximum(n_words, 1)
    counts = np.stack([n_words, chars, symbols, dup_lines, repeats], axis=1)
    features = np.stack([np.log1p(n_words), chars / some, symbols / some, upper / np.maximum(upper + lower, 1), digits / np.maximum(chars, 1), marks / some, shouts / some, dup_lines / np.maximum(lines, 1), repeats / some, n_words / np.maximum(lines, 1), distinct / some], axis=1)
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < FEWEST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Trees | None:
    """Trees fitted to labelled documents; None if no document has a label, as where either table is empty.

    Labels without id or quality don't count; of repeated ones the worse does. Rows of one doc_id count once, and rows without
    one don't; null and empty texts have no words.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most `sample` rows of two numbers
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for batch in batches:
            _, x = measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("__quality").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    one = arrow_map(rows, run, "doc_id long, y int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("row"))  # at most `sample` rows
    got = sorted((r.doc_id, list(r.row.x), r.row.y) for r in one.collect())
    if not got:
        return None
    return boosting.fit(np.array([g[1] for g in got]), np.array([g[2] > 0 for g in got]), MONOTONE)


def verdict(trees: boosting.Trees | None, counts: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base failed, probability of good quality, kept). Without trees the base rules alone decide."""
    failed = base_failed(counts)
    score = trees.score(features) if trees else np.ones(len(counts))
    return failed, score, ~failed & (score >= LEAST)


def judge(documents: DataFrame, trees: boosting.Trees | None) -> DataFrame:
    """doc_id, COUNTS, base_failed, score, kept for every row of documents.

    documents: doc_id, text; other columns don't matter. A null or empty text has no words and fails the base rules. Repeated
    rows give repeated rows, a null doc_id is kept, no rows give no rows; very long texts are measured whole.
    """

    def run(batches):
        for batch in batches:
            counts, x = measure(batch.column("text"))
            failed, score, kept = verdict(trees, counts, x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts.T), pa.array(failed), pa.array(score), pa.array(kept)], ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    columns = ", ".join(f"{c} long" for c in COUNTS)
    return arrow_map(documents.select("doc_id", "text"), run, f"doc_id long, {columns}, base_failed boolean, score double, kept boolean")


def keep_good(documents: DataFrame, trees: boosting.Trees | None) -> DataFrame:
    """The rows of documents that judge() keeps, with all their columns, whatever their names; repeated rows and those without a doc_id are judged by their text like others. No rows give no rows."""
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdict(trees, *measure(batch.column(at)))[2]))

    return arrow_map(documents, run, documents.schema)
