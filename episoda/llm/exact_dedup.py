"""Exact duplicates by Patricia-trie owners.

Every task first enters its own texts into a compressed radix trie over bytes, so copies within the task meet before anything is shuffled;
one row per distinct text and task goes on, by length and content hash, to the tries that own it. Terminal nodes hold the smallest id.
A trie above its memory budget spills its largest subtree (all texts under one edge of the root) to a local file that lives as long as
the task and is worked off by itself afterwards. Group results come back by the representative of each (task, text), a key that no group
makes hot.

Equality: texts are compared after each run of [\\x20\\x09-\\x0D] became one space, byte by byte; the hash only deals them out.

Defined results: null counts as empty; ids that repeat are rows of their own with the same keep_id; a null id is never chosen over another;
of rows that tie for the smallest id one is kept; a text of any length is entered whole (a trie holds one text at least, whatever its budget);
an empty table gives no rows; further columns of any name are kept by `drop_duplicates` and ignored otherwise.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episoda.llm import common

_SPACE = b" \t\n\x0b\x0c\r"
TRIE_BYTES = 64 << 20
_NODE_BYTES = 200


def normalise(text: bytes) -> bytes:
    core = b" ".join(text.split())
    if not core:
        return b" " if text else b""
    return (b" " if text[0] in _SPACE else b"") + core + (b" " if text[-1] in _SPACE else b"")


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.owner, self.children = label, owner, {}


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """Full byte strings in a compressed radix trie; find(text) is the text's terminal owner, made by `fresh` when it is new.

    `budget` bounds the bytes held. Beyond it the largest subtree below the first branching is written to a temporary file, and later texts
    under its prefix follow it there; `owners` works the files off one by one, each in a trie of its own that branches further down.
    """

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.held = Node(b""), budget, 0
        self.files: dict[bytes, object] = {}

    def find(self, text: bytes, fresh):
        node, rest = self.root, text
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                leaf = Node(rest, fresh())
                node.children[rest[0]] = leaf
                self.held += len(rest) + _NODE_BYTES
                return leaf.owner
            k = _common(child.label, rest)
            if k < len(child.label):
                split = Node(child.label[:k])
                child.label = child.label[k:]
                split.children[child.label[0]] = child
                node.children[rest[0]] = child = split
                self.held += _NODE_BYTES
            node, rest = child, rest[k:]
        if node.owner is None:
            node.owner = fresh()
        return node.owner

    @property
    def full(self) -> bool:
        return self.held > self.budget

    def terminals(self, node: Node | None = None, head: bytes = b"") -> Iterator[tuple[bytes, object]]:
        stack = [(node or self.root, head)]
        while stack:
            x, at = stack.pop()
            at += x.label
            if x.owner is not None:
                yield at, x.owner
            stack += [(c, at) for c in x.children.values()]

    def _weight(self, node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            x = stack.pop()
            total += len(x.label) + _NODE_BYTES
            stack += x.children.values()
        return total

    def spill(self) -> None:
        node, head = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            (node,) = node.children.values()
            head += node.label
        if not node.children:
            return  # a single text cannot be divided
        weights = {first: self._weight(c) for first, c in node.children.items()}
        first = max(weights, key=weights.get)
        child = node.children.pop(first)
        out = self.files[head + child.label[:1]] = tempfile.TemporaryFile()
        for pair in self.terminals(child, head):
            pickle.dump(pair, out, -1)
        self.held -= weights[first]

    def add(self, text: bytes, owner: list, merge) -> None:
        """Enter an owner, merged into the one that is there."""
        for prefix, out in self.files.items():
            if text.startswith(prefix):
                pickle.dump((text, owner), out, -1)
                return
        there = self.find(text, lambda: owner)
        if there is not owner:
            merge(there, owner)
        if self.full:
            self.spill()

    def owners(self, merge) -> Iterator[object]:
        """All owners, those of spilled subtrees last, one subtree at a time."""
        for _, owner in self.terminals():
            yield owner
        self.root = Node(b"")
        for f in self.files.values():
            sub = Trie(self.budget)
            f.seek(0)
            while True:
                try:
                    text, owner = pickle.load(f)
                except EOFError:
                    break
                sub.add(text, owner, merge)
            f.close()
            yield from sub.owners(merge)


_LOCAL = "rep long, doc_ids array<long>, n long, length long, hash long, text_sha256 string, body binary"


def _local(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of the task; a full trie is handed on and begun again."""
    common.forget_tables()
    base, serial = TaskContext.get().partitionId() << 36, 0
    trie = Trie(budget)

    def flush() -> Iterator[pa.RecordBatch]:
        held, rows = 0, []
        for body, (rep, ids) in trie.terminals():
            rows.append((rep, ids, len(ids), len(body), xxhash.xxh64_intdigest(body) - (1 << 63), hashlib.sha256(body).hexdigest(), body))
            held += len(body)
            if held > 4 << 20:
                yield batch_of(rows)
                held, rows = 0, []
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in _LOCAL.split(", ")])

    for batch in common.slices(batches, "text"):
        for doc, raw in zip(batch.column("doc_id").to_pylist(), common.raw_texts(batch), strict=True):
            owner = trie.find(normalise(raw), lambda: (base + serial, []))
            if not owner[1]:
                serial += 1
            owner[1].append(doc)
        if trie.full:
            yield from flush()
            trie = Trie(budget)
    yield from flush()


def _merge(there: list, more: list) -> None:
    """Owners are [smallest id, its representative, rows, representatives]; a null id comes after all others."""
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    if order(more) < order(there):
        there[:2] = more[:2]
    there[2] += more[2]
    there[3].extend(more[3])


_OWNED = "rep long, keep_id long, keep_rep long, group_size long"


def _own(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    trie = Trie(budget)
    for batch in common.slices(batches, "body"):
        for body, first, n, rep in zip(*(batch.column(c).to_pylist() for c in ("body", "first_id", "n", "rep")), strict=True):
            trie.add(body, [first, rep, n, [rep]], _merge)
    out: list[list] = [[] for _ in range(4)]
    for keep, keep_rep, n, own in trie.owners(_merge):
        for rep in own:
            for column, v in zip(out, (rep, keep, keep_rep, n), strict=True):
                column.append(v)
        if len(out[0]) >= 8192:
            yield _batch(out)
            out = [[] for _ in range(4)]
    if out[0]:
        yield _batch(out)


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in _OWNED.split(", ")])


def duplicate_groups(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text) for every row of docs(doc_id, text); one row of a group is kept."""
    local = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(partial(_local, budget=trie_bytes), _LOCAL)
    local = common.materialise(local, "texts")
    sent = local.select("length", "hash", F.array_min("doc_ids").alias("first_id"), "n", "rep", "body").repartition("length", "hash")
    owned = common.materialise(sent.mapInArrow(partial(_own, budget=trie_bytes), _OWNED), "text-owners")
    back = local.select("rep", "doc_ids", "text_sha256").join(owned, "rep")
    at = F.when(F.col("keep_id").isNull(), 0).otherwise(F.expr("array_position(doc_ids, keep_id)").cast("int") - 1)
    kept = (F.col("rep") == F.col("keep_rep")) & (F.col("pos") == F.col("at"))
    return back.select("rep", "keep_rep", "keep_id", "group_size", "text_sha256", at.alias("at"), F.posexplode("doc_ids").alias("pos", "doc_id")).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The rows of docs that stay, with all their columns. Of rows that repeat id and text one stays."""
    groups = common.materialise(duplicate_groups(docs, trie_bytes).where("doc_id <=> keep_id").groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")), "kept-texts")
    stay = groups.where("kept").select("doc_id", "text_sha256", "n")
    sha = common.free_name(docs, "sha")
    tagged = docs.withColumn(sha, F.sha2(F.encode(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\t-\\r]+", " "), "UTF-8"), 256))
    same = lambda df: (tagged[sha] == df["text_sha256"]) & tagged["doc_id"].eqNullSafe(df["doc_id"])
    if not stay.where("n > 1").head(1):
        return tagged.join(stay, same(stay), "left_semi").drop(sha)
    once, often = stay.where("n = 1"), stay.where("n > 1")
    repeated = tagged.join(often, same(often), "left_semi").dropDuplicates(["doc_id", sha])
    return tagged.join(once, same(once), "left_semi").unionByName(repeated).drop(sha)
