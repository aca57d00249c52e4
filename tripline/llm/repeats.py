"""Finding what repeats across all documents, without sending every position through a shuffle.

An operator chooses anchors: places in a text that depend on nearby text only, so that equal passages have equal
anchors. The steps are the same for all:

0. Copies of a whole text are found by their hashes. They hold nothing that their first one does not.
1. Every task names the anchors of its texts and sends, to the bucket of each name, four bytes of it. Within a block
   of texts a name is sent once, however many documents share it, so a very common passage costs each block one entry.
2. The buckets answer with the names that different texts share or one repeats. The answers go to the documents.
3. Documents with such names send the candidates around them to buckets again; those compare the candidates
   themselves and answer which come second. Copies inside a block are settled there, and one of them is sent.
4. The answers meet the texts once more.

A document is known by its order (its doc_id; NULL comes last) and the hash of its text, a text by its hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import Flat, flattened, pieces
from tripline.llm.store import stored

# Bytes of text whose names a task gathers before it sends them, and bytes of text for each bucket.
BLOCK_BYTES = 24 << 20
BUCKET_BYTES = 64 << 20

# Texts that share a name from which on it is crowded, and how many such names there may be: beyond that the number of
# texts grows instead. Crowded names are only grouped otherwise; what is found is the same.
CROWD = 100_000
CROWDED_NAMES = 1_000_000

LAST = 2**63 - 1

_ENTRIES = "bucket int, hashes binary, counts binary, names binary, seen binary, large binary"
_ANSWERS = "hash long, names binary"
_U8, _I32, _U32, _I64, _U64 = np.dtype("u1"), np.dtype("<i4"), np.dtype("<u4"), np.dtype("<i8"), np.dtype("<u8")

#: The anchors of some texts: 64-bit names, and the text of each, in rising order of texts.
Anchors = Callable[[Flat], tuple[np.ndarray, np.ndarray]]


def known_rows(docs: DataFrame) -> DataFrame:
    """``ord``, ``hash`` and ``text`` of the rows that have a text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.xxhash64("text").alias("hash"),
        F.col("text"),
    ).where("text IS NOT NULL AND text <> ''")


def text_classes(rows: DataFrame) -> DataFrame:
    """The distinct texts: ``hash``, ``other`` hash, ``size`` in bytes, the ``first`` order that has it and ``n`` rows."""
    return stored(_hashed(rows).groupBy("hash", "other", "size").agg(
        F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")
    ), "texts")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.select("ord", "hash", F.xxhash64(F.lit(1), "text").alias("other"), F.octet_length("text").alias("size"))


def copies(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``ord`` and ``hash`` of documents whose whole text a smaller order has."""
    same = _hashed(rows).join(classes, ["hash", "other", "size"])
    return same.where(F.col("ord") > F.col("first")).select("ord", "hash")


def bucket_count(classes: DataFrame) -> int:
    """Buckets for these texts: in proportion to their bytes."""
    return 1 + int(classes.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0) // BUCKET_BYTES


def repeated_names(rows: DataFrame, classes: DataFrame, anchors: Anchors, buckets: int) -> DataFrame:
    """For each document with names that occur twice or more, in it or in another text: ``ord``, ``hash``, ``names``.

    Of copies only the first is told. ``names`` is an array of binaries, each some 64-bit codes (see ``codes_of``).
    A row without order and hash has the codes that are crowded.
    """
    entries = rows.mapInArrow(_naming(anchors, buckets), _ENTRIES)
    crowd = max(CROWD, buckets * BUCKET_BYTES // (16 * CROWDED_NAMES))
    answers = entries.groupBy("bucket").applyInArrow(_repeated(crowd), _ANSWERS)
    told = answers.groupBy("hash").agg(F.collect_list("names").alias("names"))
    told = told.join(classes.select("hash", F.col("first").alias("ord")), "hash", "left")
    return stored(told.where("hash IS NULL OR ord IS NOT NULL"), "names", release=True)


def crowded(names: DataFrame) -> np.ndarray:
    """Codes that more texts share than the candidates of one bucket should be of: ``CROWDED_NAMES`` at most."""
    lists = names.where("hash IS NULL").select(F.explode("names").alias("names")).collect()
    return np.unique(np.frombuffer(b"".join(row.names for row in lists), _U64))


def codes_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """What of a name is compared: its bucket and 32 bits that do not follow from the bucket."""
    return (names % np.uint64(buckets)) << np.uint64(32) | names >> np.uint64(32)


def joined_codes(lists: pa.Array) -> list[np.ndarray]:
    """The codes of each document."""
    return [np.frombuffer(b"".join(parts), _U64) for parts in lists.to_pylist()]


@dataclass
class Block:
    """The names gathered from some texts."""

    hashes: list[np.ndarray]
    names: list[np.ndarray]
    texts: list[np.ndarray]
    known: set[int]
    size: int = 0
    rows: int = 0

    @classmethod
    def empty(cls) -> Block:
        return cls([], [], [], set())

    def unseen(self, piece: pa.RecordBatch) -> pa.RecordBatch:
        """The texts that the block does not have yet."""
        new = []
        for value in piece.column("hash").to_pylist():
            new.append(value not in self.known)
            self.known.add(value)
        return piece if all(new) else pa.RecordBatch.from_arrays(
            [pa.concat_arrays([column]) for column in piece.filter(pa.array(new)).columns], piece.schema.names
        )

    def add(self, piece: pa.RecordBatch, flat: Flat, names: np.ndarray, texts: np.ndarray) -> None:
        self.hashes.append(piece.column("hash").to_numpy())
        self.names.append(names)
        self.texts.append(texts + self.rows)
        self.rows += piece.num_rows
        self.size += len(flat.data)


def binary_rows(arrays: dict[str, np.ndarray], cuts: np.ndarray) -> dict[str, pa.Array]:
    """Columns of binaries: each array cut at the same places."""
    out = {}
    for name, data in arrays.items():
        offsets = (cuts * data.itemsize).astype(np.int32)
        out[name] = pa.BinaryArray.from_buffers(
            pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        )
    return out


def _naming(anchors: Anchors, buckets: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block.empty()
        for batch in batches:
            for piece in pieces(batch):
                piece = block.unseen(piece)
                flat = flattened(piece.column("text"))
                block.add(piece, flat, *anchors(flat))
                if block.size >= BLOCK_BYTES:
                    yield from _sent(block, buckets)
                    block = Block.empty()
        if block.rows:
            yield from _sent(block, buckets)

    return name


def _sent(block: Block, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries for each bucket; and, in buckets below zero, answers for names that this block alone shows to repeat."""
    hashes = np.concatenate(block.hashes)
    codes, texts = codes_of(np.concatenate(block.names), buckets), np.concatenate(block.texts)
    if not len(codes):
        return
    order = np.argsort(codes, kind="stable")
    codes, texts = codes[order], texts[order]
    first = np.ones(len(codes), dtype=bool)
    first[1:] = codes[1:] != codes[:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(codes)))
    again = np.repeat(sizes > 1, sizes)
    if again.any():
        who, common = texts[again], codes[again]
        order = np.argsort(who, kind="stable")
        who, common = who[order], common[order]
        new = np.ones(len(who), dtype=bool)
        new[1:] = (who[1:] != who[:-1]) | (common[1:] != common[:-1])
        who, common = who[new], common[new]
        who, at = np.unique(who, return_index=True)
        columns = binary_rows({"names": common}, np.append(at, len(common)))
        columns |= binary_rows({"hashes": hashes[who]}, np.arange(len(who) + 1))
        columns["bucket"] = pa.array((-1 - (hashes[who].view(np.uint64) % np.uint64(buckets)).astype(np.int64)).astype(_I32))
        empty = pa.array([b""] * len(who), pa.binary())
        yield _batch(columns | {"counts": empty, "seen": empty, "large": empty}, _ENTRY_COLUMNS)
    # One entry a name, in the order of buckets and then of texts.
    codes, texts = codes[starts], texts[starts]
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((texts, bucket))
    codes, texts, bucket, sizes = codes[order], texts[order], bucket[order], sizes[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (texts[1:] != texts[:-1]) | (bucket[1:] != bucket[:-1])
    runs = np.flatnonzero(new)
    counts = np.diff(np.append(runs, len(codes)))
    some, cut = np.unique(bucket, return_index=True)
    cuts = np.append(cut, len(codes))
    run_cuts = np.searchsorted(runs, cuts)
    who = texts[runs]
    columns = binary_rows({"names": (codes & np.uint64(0xFFFFFFFF)).astype(_U32), "seen": np.minimum(sizes, 255).astype(_U8)}, cuts)
    columns |= binary_rows({"hashes": hashes[who], "counts": counts.astype(_I32)}, run_cuts)
    large = np.flatnonzero(sizes >= 255)  # a byte does not hold these; they follow by themselves
    columns |= binary_rows({"large": sizes[large].astype(_I32)}, np.searchsorted(large, cuts))
    yield _batch(columns | {"bucket": pa.array(some.astype(_I32))}, _ENTRY_COLUMNS)


_ENTRY_COLUMNS = ["bucket", "hashes", "counts", "names", "seen", "large"]


def _batch(columns: dict[str, pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[name] for name in names], names)


def joined(table: pa.Table, column: str, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _repeated(crowd: int):
    """Of one bucket: the names with two entries, told to each text that has one."""
    return lambda table: _answered(table, crowd)


def _answered(table: pa.Table, crowd: int) -> pa.Table:
    if not table.num_rows:
        return pa.table({"hash": pa.array([], pa.int64()), "names": pa.array([], pa.binary())})
    hashes = joined(table, "hashes", _I64)
    bucket = table.column("bucket")[0].as_py()
    if bucket < 0:
        lists = table.column("names").to_pylist()
        return _told(np.repeat(hashes, [len(x) // 8 for x in lists]), np.frombuffer(b"".join(lists), _U64))
    counts, names = joined(table, "counts", _I32), joined(table, "names", _U32)
    seen = joined(table, "seen", _U8)
    document = np.repeat(np.arange(len(hashes)), counts)
    order = np.argsort(names, kind="stable")
    first = np.flatnonzero(np.append(True, names[order][1:] != names[order][:-1]))
    sizes = np.diff(np.append(first, len(order)))
    # Shared by texts of different hashes, or known to repeat in some block.
    text = hashes[document[order]]
    shared = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
    shared |= np.maximum.reduceat(seen[order], first) > 1
    twice = np.zeros(len(names), dtype=bool)
    twice[order] = np.repeat(shared, sizes)
    twice &= seen < 2  # the others have been answered already
    kept = np.flatnonzero(twice)
    codes = np.uint64(bucket) << np.uint64(32) | names[kept].astype(np.uint64)
    out = _told(hashes[document[kept]], codes)
    texts = np.add.reduceat(seen[order], first, dtype=np.int64)
    large = np.flatnonzero(seen == 255)
    np.add.at(texts, np.searchsorted(names[order[first]], names[large]), joined(table, "large", _I32) - 255)
    many = names[order[first[texts >= crowd]]]
    if not len(many):
        return out
    codes = (np.uint64(bucket) << np.uint64(32) | many.astype(np.uint64)).astype(_U64)
    return pa.concat_tables([out, pa.table({"hash": pa.array([None], pa.int64()), "names": [codes.tobytes()]})])


def _told(hashes: np.ndarray, codes: np.ndarray) -> pa.Table:
    """Each text's codes, once, however many blocks have sent them for copies of it."""
    order = np.lexsort((codes, hashes))
    hashes, codes = hashes[order], codes[order]
    other = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    new = other | np.append(True, codes[1:] != codes[:-1])[: len(codes)]
    hashes, codes, other = hashes[new], codes[new], other[new]
    runs = np.flatnonzero(other)
    return pa.table({"hash": hashes[runs]} | binary_rows({"names": codes.astype(_U64)}, np.append(runs, len(codes))))
