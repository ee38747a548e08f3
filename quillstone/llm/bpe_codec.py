"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quillstone.llm.session import arrow_map

#: Texts longer than this are cut at safe places before encoding.
LONG = 1 << 16
#: White space runs longer than this are encoded as single pieces: the library's regex backtracks over them.
LONG_SPACE = 1 << 10
# A piece never goes on over white space after something else, so a cut before it is safe; ASCII on both sides, on which
# all regex engines agree.
_SAFE = re.compile(r"[0-9A-Za-z.,;:!?](?=[ \n])")
_SPACES = re.compile(rf"\s{{{LONG_SPACE},}}")
_open: dict[tuple[str, str], Codec] = {}


class Codec:
    """ids of texts and bytes of ids; one per process, rank file and pattern."""

    def __init__(self, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, rank_path: str, pattern: str) -> Codec:
        key = (rank_path, pattern)
        if key not in _open:
            _open[key] = cls(rank_path, pattern)
        return _open[key]

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_SPACE:
            return self.library.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for run in _SPACES.finditer(text):
            if any("\x1c" <= c <= "\x1f" for c in set(run[0])):  # white space to Python only
                continue
            # `\s+(?!\S)` takes the run but for its last character, if something follows.
            end = run.end() if run.end() == len(text) else run.end() - 1
            for piece in self._cut(text[at : run.start()]):
                ids += self.library.encode_ordinary(piece)
            ids += self.library._encode_single_piece(text[run.start() : end])
            at = end
        for piece in self._cut(text[at:]):
            ids += self.library.encode_ordinary(piece)
        return ids

    def _cut(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > LONG:
            m = _SAFE.search(text, at + LONG)
            if not m:
                break
            yield text[at : m.end()]
            at = m.end()
        yield text[at:]

    def decode(self, ids: list[int]) -> bytes:
        return self.library.decode_bytes(ids)


def encode_decode(documents: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>, decoded binary of every whole text.

    documents: doc_id, text; other columns don't matter. Null and empty texts have no ids. Repeated rows give repeated rows,
    a null doc_id is kept, no rows give no rows. Very long texts are cut at places where pieces always end.
    """

    def run(batches):
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.binary())], ["doc_id", "ids", "decoded"])

    return arrow_map(documents.select("doc_id", "text"), run, "doc_id long, ids array<int>, decoded binary")


def digest(documents: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encode_decode makes, digested before it leaves Python."""

    def run(batches):
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text or "")
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(documents.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
