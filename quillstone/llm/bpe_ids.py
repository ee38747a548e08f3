"""Token ids by the tokenizers library, each distinct unit of a slice of text encoded once.

A byte-level pre-tokeniser starts a new piece at white space that follows anything else, and at a mark that follows a letter
or digit; what it does from there on doesn't depend on what is before. So a text's ids are the ids of its units, cut there,
one after another. Units are views of the texts' bytes; Arrow finds the distinct ones, a bounded cache knows the frequent ones,
and the library encodes the rest. Texts that hold the string of an added token go to the library whole, and with another
pre-tokeniser all texts do.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from quillstone.llm.words import SPACE, raw

#: Units in each of the cache's two generations, and the longest unit kept: some 90 MB until forget().
CACHE_UNITS, CACHE_CHARS = 250_000, 32
#: Bytes whose units are encoded at once; a longer text is encoded in several parts.
SLICE = 4 << 20
#: Units that the library gets as one text.
_JOINED = 64
_PLAIN, _MARK, _SEEN = (np.zeros(256, bool) for _ in range(3))
_PLAIN[[*b"0123456789", *range(65, 91), *range(97, 123)]] = True
_SEEN[33:127] = True
_MARK[33:127] = ~_PLAIN[33:127]
#: A unit that is one piece, of letters up to U+017F; and one that is encoded between line feeds as it is alone.
_WORD, _JOINS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+"), re.compile(r" ?\S+")


def _shown() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {b: chr(b if b in seen else next(hidden)) for b in range(256)}


_SHOWN = _shown()
_open: dict[str, Encoder] = {}


class Encoder:
    """Encodes columns of texts; one per process and vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        first = said.get("pre_tokenizer") or {}
        self.cuts = said.get("normalizer") is None and said.get("post_processor") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        self.added = [t["content"].encode() for t in said.get("added_tokens", ()) if t["content"]]
        feed = self.library.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if self.cuts and len(feed) == 1 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _open:
            _open[path] = cls(path)
        return _open[path]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none) one after another, and the texts' offsets in them."""
        data, offsets = raw(column)
        bounds = self._bounds(data, offsets)
        ids, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        i = 0
        while i < len(bounds) - 1:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE, "right")) - 1)
            for out, x in zip((ids, sizes), self._encode(data, bounds[i : j + 1]), strict=True):
                out.append(x)
            i = j
        before = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(ids), before[np.searchsorted(bounds, offsets)]

    def forget(self) -> None:
        """Empties the cache. Workers live on after their partition, and others may come beside them."""
        self.young, self.old = {}, {}

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units begin, and the end of the last."""
        n = len(data)
        cut = np.zeros(n + 1, bool)
        if self.cuts and n:
            here, prior = data[1:], data[:-1]
            space = SPACE[here]
            cut[1:n] = (space & _SEEN[prior]) | (_MARK[here] & _PLAIN[prior])
            # After a character of several bytes: of two from U+00C0 on, of three but for the first bytes of white space, of four.
            at = np.flatnonzero(space & (prior >= 0x80)) + 1
            at = at[at >= 3]
            second, third = data[at - 2], data[at - 3]
            cut[at] = np.where(second >= 0xC0, second >= 0xC3, (third < 0xC0) | (third == 0xE0) | (third >= 0xE4))
            for token in self.added:
                text, k = data.tobytes(), -1
                while (k := text.find(token, k + 1)) >= 0:
                    whole = np.searchsorted(offsets, k, "right") - 1
                    cut[offsets[whole] : offsets[whole + 1]] = False
        cut[offsets] = True
        return np.flatnonzero(cut)

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units that stand one after another, and the number of each one's ids."""
        base = data[bounds[0] : bounds[-1]]
        units = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(base)]).dictionary_encode()
        distinct = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.young.get, distinct))
        missing = [i for i, x in enumerate(known) if x is None]
        unknown = []
        for i in missing:
            known[i] = self.old.get(distinct[i])
            if known[i] is None:
                unknown.append(i)
        for i, x in zip(unknown, self._library([distinct[i] for i in unknown]), strict=True):
            known[i] = x
        if len(self.young) + len(missing) > CACHE_UNITS:
            self.old, self.young = self.young, {}
        self.young.update((distinct[i], known[i]) for i in missing[:CACHE_UNITS] if len(distinct[i]) <= CACHE_CHARS)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        flat, start = np.frombuffer(b"".join(known), self.dtype), np.cumsum(sizes) - sizes
        which = units.indices.to_numpy()
        n = sizes[which]
        shift = start[which] - (np.cumsum(n) - n)
        return flat[np.repeat(shift, n) + np.arange(int(n.sum()))], n

    def _library(self, units: list[str]) -> list[bytes]:
        """Each unit's ids. A unit that is one piece goes to the library's model, other short ones to the library many at a time, parted by line feeds, whose id no other text has."""
        out: list[bytes | None] = [None] * len(units)
        width = self.dtype.itemsize
        if self.feed is not None:
            tokenize, pieces, ends, ids = self.library.model.tokenize, [], [], []
            for i, u in enumerate(units):
                if len(u) <= CACHE_CHARS and _WORD.fullmatch(u):
                    pieces.append(i)
                    ids += [t.id for t in tokenize(u.encode().decode("latin-1").translate(_SHOWN))]
                    ends.append(len(ids) * width)
            data = np.array(ids, self.dtype).tobytes()
            for i, a, b in zip(pieces, [0, *ends], ends, strict=False):
                out[i] = data[a:b]
            together = [i for i, u in enumerate(units) if out[i] is None and len(u) <= CACHE_CHARS and _JOINS.fullmatch(u)]
            groups = [together[k : k + _JOINED] for k in range(0, len(together), _JOINED)]
            for some, e in zip(groups, self.library.encode_batch_fast(["\n".join(units[i] for i in g) for g in groups], add_special_tokens=False), strict=True):
                x = np.array(e.ids, self.dtype)
                feeds = np.flatnonzero(x == self.feed)
                if len(feeds) == len(some) - 1:
                    for i, part in zip(some, np.split(x[x != self.feed], feeds - np.arange(len(feeds))), strict=True):
                        out[i] = part.tobytes()
        rest = [i for i, x in enumerate(out) if x is None]
        for k in range(0, len(rest), 1024):
            some = rest[k : k + 1024]
            for i, e in zip(some, self.library.encode_batch_fast([units[i] for i in some], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, self.dtype).tobytes()
        return out


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids as 32-bit numbers with end_id after each text, and the texts' offsets in them."""
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    own = np.ones(len(ids) + len(ends), bool)
    own[ends] = False
    out = np.full(len(own), end_id, "<u4")
    out[own] = ids
    return out, np.concatenate([[0], ends + 1])
