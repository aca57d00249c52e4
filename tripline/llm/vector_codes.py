"""Vector code compression: product codebooks learned by Lloyd's rounds whose members stay where they are.

Every part of every vector is a member of one entry of its position's codebook, and lives in the task that owns
(position, entry, salt). Owners sum their resident members, so a round shuffles one row of sums per task and entry, and
of the members only those whose nearest entry has changed. The members are RDD blocks, for a DataFrame does not keep a
partitioning through Python: what stays and what arrives are put side by side, without a shuffle, by a union of two
RDDs of one partitioner. Salts deal every entry out over all tasks of its position, so an entry, or one vector, may hold
any share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import mixed
from tripline.llm.store import dropped, stored

# Members that one task owns, about.
MEMBERS = 500_000
# Members compared with a codebook at a time.
_PIECE = 8192

_BLOCK = "cell long, position int, rows binary, entries binary, parts binary"
_NAMED = "position int, rows binary, entries binary, errors binary"


@dataclass(frozen=True)
class Codes:
    """``rows``: ``vec_id``, ``label``, ``code`` and ``error``; ``books``: the final entries by position."""

    rows: DataFrame
    books: list[np.ndarray]

    @property
    def sha256(self) -> str:
        """Of all entries' components in decimal, by position, entry and place."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def integers(vectors: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``parts``: floor(scale * component) as longs.

    Rows whose vector is NULL, has no components, or holds a NULL, NaN or infinite component are left out.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    return vectors.where(x.isNotNull() & (F.size(x) > 0) & ~bad).select("vec_id", "label", whole.alias("parts"))


def compressed(vectors: DataFrame, positions: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Codes:
    """Cut every vector into ``positions`` equal parts and name each by its codebook's nearest entry.

    A codebook starts as that part of the ``entries`` smallest vec_ids; equal vec_ids go by their components, NULL comes
    last, and fewer rows make a smaller codebook. Each of ``rounds`` assigns every part to the nearest entry (squared
    Euclidean distance, the lower index of equal ones) and then replaces each entry by floor(sum / count) of its parts;
    entries without parts stay. At last parts are assigned once more: ``code`` has the indexes in two hexadecimal digits
    each, ``error`` the squared distances. Repeated rows are rows of their own. Rows without a usable vector are left out
    (``integers``); if no row is left there are no codes and the codebooks are empty. Vectors of different lengths, of a
    length that ``positions`` does not divide, or whose squared distances may not fit 64 bits, raise. Other columns are
    not read; ``label`` is carried along and may be NULL. No text is read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hexadecimal digits name 256 entries at most")
    spark = vectors.sparkSession
    base = stored(integers(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "parts")
    size = F.size("parts")
    n, least, most, low, high = base.agg(
        F.count(F.lit(1)), F.min(size), F.max(size), F.min(F.array_min("parts")), F.max(F.array_max("parts"))
    ).first()
    if not n:
        rows = base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(rows, [])
    if least != most or least % positions:
        raise ValueError(f"vectors of {least} to {most} components cannot be cut into {positions} equal parts each")
    width, far = least // positions, max(-low, high)
    largest = 4 * least * max(far, 1) ** 2  # no squared distance, and no term of one, is beyond
    if largest >= 1 << 62 or far >= 1 << 31:
        raise ValueError(f"squared distances of components up to {far} do not fit 64 bits")
    kind = np.float64 if largest < 1 << 52 else np.int64  # both exact
    first = base.sort(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).select("parts").collect()
    whole = np.array([row.parts for row in first], np.int64)
    books = [np.ascontiguousarray(whole[:, k * width : (k + 1) * width]) for k in range(positions)]

    # Each position has as many salts as tasks; a task owns one salt of every entry.
    salts = max(-(-n // MEMBERS), -(-spark.sparkContext.defaultParallelism // positions))
    tasks = positions * salts
    cut = base.select("row", "parts").mapInArrow(_cut(books, salts, kind), _BLOCK)
    members = cut.rdd.map(lambda row: (row[0], (row[1], *map(bytes, row[2:])))).partitionBy(tasks, _owner)
    held = []
    for k in range(rounds):
        books = _updated(members, books, min(tasks, 64))
        for old in held[:-1]:
            old.unpersist()
        if k < rounds - 1:
            dealt = members.mapPartitions(_reassigned(books, salts, kind), preservesPartitioning=True)
            dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(dealt)
            staying, leaving = dealt.filter(lambda block: not block[1][-1]), dealt.filter(lambda block: block[1][-1])
            members = staying.union(leaving.partitionBy(tasks, _owner))
    named = spark.createDataFrame(members.mapPartitions(_assigned(books, kind)), _NAMED)
    named = named.mapInArrow(_unpacked, "row long, position int, entry int, error long")
    codes = named.groupBy("row").agg(
        F.sum("error").alias("error"),
        *(F.max(F.when(F.col("position") == k, F.col("entry"))).alias(f"entry{k}") for k in range(positions)),
    )
    code = F.concat(*(F.lower(F.lpad(F.hex(f"entry{k}"), 2, "0")) for k in range(positions)))
    rows = base.select("row", "vec_id", "label").join(codes, "row").select("vec_id", "label", code.alias("code"), "error")
    rows = stored(rows, "codes")
    dropped(base)
    for old in held:
        old.unpersist()
    return Codes(rows, books)


def digest(codes: Codes) -> DataFrame:
    """The rows with the error summed over equal labels, NULL ones together, and the codebooks' checksum."""
    by_label = codes.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = codes.rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codes.sha256).alias("codebooks_sha256"))


def _updated(members: RDD, books: list[np.ndarray], tasks: int) -> list[np.ndarray]:
    """New entries from the sums of all owners: one row an entry comes to the driver."""
    width = books[0].shape[1]
    out = [book.copy() for book in books]
    for (position, entry), sums in members.mapPartitions(_sums(width)).reduceByKey(np.add, tasks).collect():
        out[position][entry] = sums[1:] // sums[0]
    return out


# In tasks


def _owner(cell: int) -> int:
    return cell


def _nearest(parts: np.ndarray, book: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower index of equal ones, and the squared distance."""
    book = book.astype(kind)
    squares, turned = (book * book).sum(axis=1), np.ascontiguousarray(book.T)
    entries, errors = np.empty(len(parts), np.uint8), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), _PIECE):
        some = parts[at : at + _PIECE].astype(kind)
        far = squares - 2 * (some @ turned)
        best = far.argmin(axis=1)
        entries[at : at + _PIECE] = best
        errors[at : at + _PIECE] = far[np.arange(len(best)), best] + (some * some).sum(axis=1)
    return entries, errors


def _cells(position: int, rows: np.ndarray, entries: np.ndarray, salts: int) -> np.ndarray:
    salt = (mixed(rows.astype(np.uint64)) % np.uint64(salts)).astype(np.int64)
    return position * salts + (salt + entries) % salts


def _packed(cells: np.ndarray, position: int, rows: np.ndarray, entries: np.ndarray, parts: np.ndarray) -> Iterator[tuple]:
    """The members of each cell as bytes."""
    order = np.argsort(cells, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1):
        if len(own):
            yield int(cells[own[0]]), position, rows[own].tobytes(), entries[own].tobytes(), parts[own].tobytes()


def _cut(books: list[np.ndarray], salts: int, kind):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        for batch in batches:
            rows = batch.column("row").to_numpy()
            whole = batch.column("parts").flatten().to_numpy().reshape(len(rows), -1).astype(np.int32)
            found = []
            for position, book in enumerate(books):
                parts = np.ascontiguousarray(whole[:, position * width : (position + 1) * width])
                entries, _ = _nearest(parts, book, kind)
                found.extend(_packed(_cells(position, rows, entries, salts), position, rows, entries, parts))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array(column, kind_) for column, kind_ in zip(zip(*found), kinds)]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["cell", "position", "rows", "entries", "parts"])

    return cut


def _together(blocks: Iterator[tuple], width: int) -> Iterator[tuple]:
    """What a task owns of a cell as arrays: cell, position, rows, entries, parts."""
    by_cell: dict[int, list] = {}
    for cell, block in blocks:
        by_cell.setdefault(cell, []).append(block)
    for cell in sorted(by_cell):
        own = by_cell.pop(cell)
        rows = np.frombuffer(b"".join(block[1] for block in own), np.int64)
        entries = np.frombuffer(b"".join(block[2] for block in own), np.uint8)
        parts = np.frombuffer(b"".join(block[3] for block in own), np.int32).reshape(len(rows), width)
        yield cell, own[0][0], rows, entries, parts


def _sums(width: int):
    def sums(blocks: Iterator[tuple]) -> Iterator[tuple]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for _, position, rows, entries, parts in _together(blocks, width):
            order = np.argsort(entries, kind="stable")
            present, first = np.unique(entries[order], return_index=True)
            counts = np.diff(np.append(first, len(order)))
            added = np.add.reduceat(parts[order], first, axis=0, dtype=np.int64)
            for entry, count, total in zip(present.tolist(), counts.tolist(), added):
                row = np.append(count, total)
                totals[position, entry] = totals[position, entry] + row if (position, entry) in totals else row
        yield from totals.items()

    return sums


def _reassigned(books: list[np.ndarray], salts: int, kind):
    """Members by their nearest entry: what stays, and what another task owns from now on (the last field)."""

    def reassigned(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for cell, position, rows, _, parts in _together(blocks, books[0].shape[1]):
            entries, _ = _nearest(parts, books[position], kind)
            for other, *block in _packed(_cells(position, rows, entries, salts), position, rows, entries, parts):
                yield other, (*block, other != cell)

    return reassigned


def _assigned(books: list[np.ndarray], kind):
    def assigned(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for _, position, rows, _, parts in _together(blocks, books[0].shape[1]):
            entries, errors = _nearest(parts, books[position], kind)
            yield position, rows.tobytes(), entries.tobytes(), errors.tobytes()

    return assigned


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for position, rows, entries, errors in zip(*(column.to_pylist() for column in batch.columns)):
            rows = np.frombuffer(rows, np.int64)
            entries = np.frombuffer(entries, np.uint8).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.full(len(rows), position, np.int32)), pa.array(entries), pa.array(np.frombuffer(errors, np.int64))],
                ["row", "position", "entry", "error"],
            )
