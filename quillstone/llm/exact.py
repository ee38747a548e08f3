"""Exact duplicates by Patricia tries.

Each task inserts its own normalised texts into a compressed radix trie, so that a text leaves a task once however often it
occurs there. The texts that are left go to partitions by length and content hash, sorted. There they are inserted, behind
their length and hash, into another trie; whatever lies left of the insertion path can't change any more and is spilled:
its subtrees leave the trie for the output. Equality is decided on all bytes; the hash only deals texts out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.session import arrow_map, cut, table

SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of labels in a task's first trie before its largest subtree is spilled.
HELD_BYTES = 48 << 20


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, {}, value


class Trie:
    """A compressed radix trie of byte strings; terminal nodes hold values."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def insert(self, key: bytes) -> Node:
        """The terminal node of key; its value is None if it is new."""
        node, at, n = self.root, 0, len(key)
        while at < n:
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held += n - at
                return child
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key[at : at + len(label)])
            upper = Node(label[:same])
            child.label = label[same:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            node, at = upper, at + same
        return node

    @staticmethod
    def values(node: Node) -> Iterator:
        stack = [node]
        while stack:
            node = stack.pop()
            if node.value is not None:
                yield node.value
            stack += [node.children[k] for k in sorted(node.children, reverse=True)]

    def spill_before(self, key: bytes) -> Iterator:
        """Values of all subtrees left of key's path, which are dropped. Keys must come in ascending order."""
        node, at = self.root, 0
        while at < len(key):
            for k in [k for k in node.children if k < key[at]]:
                yield from self.values(node.children.pop(k))
            child = node.children.get(key[at])
            if child is None:
                break
            if not key.startswith(child.label, at):
                if child.label < key[at : at + len(child.label)]:
                    yield from self.values(node.children.pop(key[at]))
                break
            node, at = child, at + len(child.label)

    def spill_largest(self) -> Iterator:
        """Values of the root's largest subtree, which is dropped."""
        sizes = {}
        for k, child in self.root.children.items():
            stack, total = [child], 0
            while stack:
                node = stack.pop()
                total += len(node.label)
                stack += node.children.values()
            sizes[k] = total
        if sizes:
            k = max(sizes, key=sizes.get)
            self.held -= sizes[k]
            yield from self.values(self.root.children.pop(k))
        if self.root.value is not None:
            yield self.root.value
            self.root.value = None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _order(row: tuple) -> tuple:
    """What stays is the least: most code points, then smallest doc_id, null last."""
    chars, doc = row
    return (-chars, doc is None, doc or 0)


_LOCAL = "doc_id long, text_sha256 string, owner long, text binary, hash binary, best_chars long, best_id long, members long"


def _local(batches):
    """Rows of documents with their owner, and one row per distinct text of this task with the text."""
    part, serial = TaskContext.get().partitionId(), 0
    trie = Trie()
    columns = [x.strip().split(" ") for x in _LOCAL.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def rows(found: list[tuple]):
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*found, strict=True), columns, strict=True)], [n for n, _ in columns])

    def owners(values):
        found, size = [], 0
        for v in values:
            found.append((None, None, v["owner"], v["text"], v["hash"], *v["best"], v["members"]))
            size += len(v["text"])
            if size > 4 << 20:
                yield rows(found)
                found, size = [], 0
        if found:
            yield rows(found)

    for batch in batches:
        out = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            plain = text.encode().translate(None, SPACES)
            node = trie.insert(plain)
            if node.value is None:
                node.value = {"owner": part << 33 | serial, "text": plain, "hash": xxhash.xxh3_128_digest(plain), "sha": hashlib.sha256(plain).hexdigest(), "best": (len(text), doc), "members": 0}
                serial += 1
            v = node.value
            v["members"] += 1
            v["best"] = min(v["best"], (len(text), doc), key=_order)
            out.append((doc, v["sha"], v["owner"], None, None, None, None, None))
        if out:
            yield rows(out)
        while trie.held > HELD_BYTES:
            yield from owners(list(trie.spill_largest()))
    yield from owners(Trie.values(trie.root))


def _merge(batches):
    """owner, class, best and members of each row, rows sorted by length and hash; a class is a terminal of the trie."""
    part, serial = TaskContext.get().partitionId(), 0
    trie, out = Trie(), []
    names = ["owner", "class", "best_chars", "best_id", "members"]

    def give():
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)], names)
        out = []
        return batch

    def put(values):
        nonlocal serial
        for v in values:
            best = min(v["best"], key=_order)
            out.extend((o, part << 33 | serial, *best, v["members"]) for o in v["owners"])
            serial += 1

    last = None
    for batch in batches:
        for owner, text, hash_, chars, doc, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head = struct.pack(">Q", len(text)) + hash_
            if head != last:
                put(trie.spill_before(head))
                last = head
            node = trie.insert(head + text)
            if node.value is None:
                node.value = {"owners": [], "best": [], "members": 0}
            node.value["owners"].append(owner)
            node.value["best"] = [min([*node.value["best"], (chars, doc)], key=_order)]
            node.value["members"] += members
        if len(out) > 1 << 12:
            yield give()
    put(Trie.values(trie.root))
    yield give()


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal when the same after deleting \\x20 and \\x09-\\x0D. Of equal texts the row with the most code points stays,
    then the one of smallest doc_id (null last). documents: doc_id, text; other columns don't matter. Null counts as empty, and
    empty texts are equal. Rows that repeat a doc_id count as members each; those with the staying doc_id are all marked kept.
    Very long texts are compared whole. No rows give no rows.

    A text goes to another machine at most once per task, so copies, however many, don't meet in one partition.
    """
    local, _ = table(arrow_map(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _local, _LOCAL), "owners")
    texts = local.where("text is not null").select("owner", "text", "hash", "best_chars", "best_id", "members", F.length("text").alias("size"))
    dealt = texts.repartition("size", "hash").sortWithinPartitions("size", "hash").select("owner", "text", "hash", "best_chars", "best_id", "members")
    merged = cut(arrow_map(dealt, _merge, "owner long, class long, best_chars long, best_id long, members long"))
    rows = local.where("text is null").select("doc_id", "text_sha256", "owner")
    out = rows.join(merged.select("owner", F.col("best_id").alias("keep_id"), F.col("members").alias("group_size")), "owner")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
