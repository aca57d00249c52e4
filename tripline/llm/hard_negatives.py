"""Hard negatives: for an anchor and a positive, rows of other labels that score nearly as high as the positive.

Candidates are stored as Parquet blocks along a Hilbert curve through all dimensions, each block with the smallest and
largest component of every dimension as its zone map. Interval arithmetic over a zone map bounds the scores an anchor can
have in a block, so an anchor reads only blocks whose bounds meet one of its windows of scores. Anchors are tested in
tiles against packed zone maps, and what is chosen joins the blocks by their number; scores are matrix products of the
anchors of a tile and the rows of a block, of which the first few of each window leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripline.llm.store import dropped, stored, stored_in
from tripline.llm.vector_codes import integers
from tripline.plans.tables import build_session

# Rows of a block, anchors of a tile, blocks whose zone maps are packed together.
BLOCK, TILE, ZONES = 512, 256, 4096
# Blocks in which a tile looks for its first positives: those around its anchors on the curve.
_STRETCH = 128
_BITS = 4

_FAR = (1 << 62) - 1
_ANCHOR = "struct<row: long, vec_id: long, label: long, parts: binary, lo: array<long>, hi: array<long>>"
_BLOCKS = "block long, n int, lows binary, highs binary, kinds binary, rows binary, ids binary, given binary, labels binary, anchors binary, parts binary"
_ANCHORS = "tile long, row long, vec_id long, label long, parts binary, lo array<long>, hi array<long>"
_CHUNKS = "first long, blocks binary, lows binary, highs binary, kinds binary, cuts binary"
_FOUND = "row long, place int, score long, vec_id long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
) -> DataFrame:
    """The hardest negatives of every anchor and positive, by integer inner products.

    A component counts as floor(scale * component). ``is_anchor`` is a condition on ``vec_id``. An anchor's positives are
    the first ``positives`` other rows of its label, higher scores first and smaller vec_ids among equal ones. For each,
    the first ``negatives`` rows of other labels whose score is from ``least`` to ``most`` percent of the positive's:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``. Fewer are
    all; a positive without one has no row, and so has every positive of a score below zero when least < most.

    Rows whose label is NULL, and rows without a usable vector (``vector_codes.integers``), take no part. Repeated rows
    are rows of their own, also as an anchor's positives; a NULL vec_id is no anchor unless the condition says so, and
    comes last among equal scores. An empty table, or one without anchors, gives no rows. Vectors of different lengths,
    or whose scores may not fit 64 bits, raise. Other columns are not read; no text is.
    """
    spark = vectors.sparkSession
    own = build_session(spark)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    base = integers(vectors, scale).where("label IS NOT NULL")
    base = base.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        "parts",
    )
    base = stored(base, "vectors")
    size = F.size("parts")
    n, least_size, most_size, low, high = base.agg(
        F.count(F.lit(1)), F.min(size), F.max(size), F.min(F.array_min("parts")), F.max(F.array_max("parts"))
    ).first()
    far = max(-low, high) if n else 0
    if n and least_size != most_size:
        raise ValueError(f"vectors have {least_size} to {most_size} components")
    if n and (far >= 1 << 31 or max(100, abs(least), abs(most)) * most_size * far**2 >= _FAR):
        raise ValueError(f"scores of components up to {far} do not fit 64 bits")
    kind = np.float64 if n and most_size * far**2 < 1 << 52 else np.int64  # both exact

    blocks = stored_in(own, _stored_blocks(base, n, low or 0, high or 0))
    zones, count = _packed_zones(blocks)
    anchors = stored(
        blocks.select("rows", "ids", "given", "labels", "anchors", "parts", F.spark_partition_id().alias("part"))
        .mapInArrow(_tiles(positives, kind), _ANCHORS),
        "anchors",
    )
    best = _search(anchors, blocks, zones, count, True, positives, kind)
    score = F.col("score")
    lo = F.expr(f"CASE WHEN score > 0 THEN ({least} * score + 99) DIV 100 ELSE ({least} * score) DIV 100 END")
    hi = F.expr(f"CASE WHEN score >= 0 THEN ({most} * score) DIV 100 ELSE -((99 - {most} * score) DIV 100) END")
    best = stored(best.select("row", "place", score.alias("positive_score"), F.col("vec_id").alias("positive_id"),
                              "rank", lo.alias("lo"), hi.alias("hi")), "positives")
    windows = best.where("lo <= hi").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "lo", "hi"))).alias("w"))
    asking = anchors.drop("lo", "hi").join(windows, "row").select(
        "tile", "row", "vec_id", "label", "parts", F.col("w.rank").alias("ranks"), F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi")
    )
    asking = stored(asking, "windows")
    hard = _search(asking.drop("ranks"), blocks, zones, count, False, negatives, kind)
    # A window's place among those of its anchor names the positive.
    named = asking.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("ranks").alias("place", "of"))
    found = (
        hard.select("row", "place", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), score.alias("negative_score"))
        .join(named, ["row", "place"])
        .join(best.select("row", F.col("rank").alias("of"), "positive_id", "positive_score"), ["row", "of"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
    found = stored(found, "negatives")
    dropped(base, blocks, zones, anchors, best, asking)
    return stored_in(spark, found)


def _stored_blocks(base: DataFrame, n: int, low: int, high: int) -> DataFrame:
    """The candidates in the order of the curve, a row for each block."""
    keyed = base.mapInArrow(_placed(low, high), "row long, vec_id long, label long, anchor boolean, parts array<long>, key binary")
    parallelism = base.sparkSession.sparkContext.defaultParallelism
    files = max(1, min(-(-n // BLOCK), max(parallelism, n // (BLOCK * _STRETCH))))
    ordered = keyed.repartitionByRange(files, "key", "row").sortWithinPartitions("key", "row").drop("key")
    return stored(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_packed, _BLOCKS), "blocks")


def _packed_zones(blocks: DataFrame) -> tuple[DataFrame, int]:
    """The zone maps of many blocks in one row each, numbered by ``chunk``, and how many rows that makes."""
    zones = blocks.select("block", "n", "lows", "highs", "kinds")
    chunks = stored(zones.coalesce(max(1, zones.rdd.getNumPartitions() // 8)).mapInArrow(_chunked, _CHUNKS), "zones")
    number = F.row_number().over(W.orderBy("first")) - 1  # orders one row for ZONES * BLOCK vectors
    numbered = stored(chunks.join(chunks.select("first", number.alias("chunk")), "first"), "zones")
    dropped(chunks)
    return numbered, max(1, numbered.count())


def _search(
    anchors: DataFrame, blocks: DataFrame, chunks: DataFrame, count: int, same: bool, first: int, kind
) -> DataFrame:
    """The ``first`` rows in each window of each anchor: ``row``, ``place`` of the window, ``score``, ``vec_id``, ``rank``.

    ``same`` looks among rows of the anchor's label, else among those of others.
    """
    spark = anchors.sparkSession
    fields = F.struct("row", "vec_id", "label", "parts", "lo", "hi")
    tiles = anchors.groupBy("tile").agg(F.collect_list(fields).alias("anchors"))  # TILE anchors at most
    # Every tile meets every chunk once. Where chunks are few, tiles are dealt over copies of them.
    groups = max(1, 3 * spark.sparkContext.defaultParallelism // count)
    asked = tiles.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn(
        "dealt", F.pmod(F.xxhash64("tile"), F.lit(groups))
    )
    offered = chunks.withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    chosen = asked.join(offered, ["chunk", "dealt"]).select("anchors", "blocks", "lows", "highs", "kinds", "cuts")
    pairs = chosen.mapInArrow(_chosen(same, kind), f"block long, anchors array<{_ANCHOR}>")
    read = pairs.join(blocks.select("block", "rows", "ids", "given", "labels", "parts"), "block").drop("block")
    found = read.mapInArrow(_scored(same, first, kind), _FOUND)
    order = W.partitionBy("row", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)


# In tasks


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through all columns of ``cells`` (numbers of ``bits`` bits), as bytes in order.

    The transposed form of the curve's index: undo the excess turns of each bit from the highest down, then make Gray
    codes of the columns, and take a bit of every column in turn.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint8)
    for k in range(bits - 1, 0, -1):
        below = np.uint8((1 << k) - 1)
        for column in x:
            turned = (column >> np.uint8(k)) & np.uint8(1) != 0
            swap = np.where(turned, 0, (x[0] ^ column) & below).astype(np.uint8)
            x[0] ^= np.where(turned, below, swap).astype(np.uint8)
            column ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.uint8)
    for k in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint8(k)) & np.uint8(1) != 0, np.uint8((1 << k) - 1), np.uint8(0))
    x ^= turn
    taken = [(x >> np.uint8(k)) & np.uint8(1) for k in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(taken).T, axis=1)


def _placed(low: int, high: int):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = _matrix(batch.column("parts"))
            bits = max(1, min(_BITS, 512 // max(1, parts.shape[1])))
            cells = (((parts - low) << bits) // (high - low + 1)).astype(np.uint8)
            keys = [key.tobytes() for key in hilbert_keys(cells, bits)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])

    return placed


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's rows as they come. A block's number holds the task's."""
    held, number = [], 0

    def block(table: pa.Table) -> pa.RecordBatch:
        nonlocal number
        parts = _matrix(table.column("parts").combine_chunks()).astype(np.int32)
        ids = table.column("vec_id").combine_chunks()
        labels = table.column("label").to_numpy()
        columns = {
            "block": pa.array([(table.column("part")[0].as_py() << 32) + number]),
            "n": pa.array([len(parts)], pa.int32()),
            "lows": parts.min(axis=0),
            "highs": parts.max(axis=0),
            "kinds": np.unique(labels),
            "rows": table.column("row").to_numpy(),
            "ids": ids.fill_null(0).to_numpy(),
            "given": ids.is_valid().to_numpy(zero_copy_only=False),
            "labels": labels,
            "anchors": table.column("anchor").to_numpy(),
            "parts": parts,
        }
        number += 1
        return pa.RecordBatch.from_pydict(
            {name: pa.array([x.tobytes()], pa.binary()) if isinstance(x, np.ndarray) else x for name, x in columns.items()}
        )

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= BLOCK:
            table = pa.Table.from_batches(held)
            whole = table.num_rows // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                yield block(table.slice(at, BLOCK))
            held = table.slice(whole).to_batches()
    if sum(x.num_rows for x in held):
        yield block(pa.Table.from_batches(held))


class _Block:
    """A block's rows as arrays."""

    def __init__(self, row: dict, kind):
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.given = np.frombuffer(row["given"], np.bool_)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.raw = np.frombuffer(row["parts"], np.int32).reshape(len(self.rows), -1)
        self.parts = self.raw.astype(kind)


def _tiles(positives: int, kind):
    """Anchors in tiles, each with the window of scores its positives lie in: from the last of the first few that its
    part of the curve holds."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks, number, part = [], [], 0, 0

        def tiled() -> Iterator[pa.RecordBatch]:
            """TILE anchors at most in each; one block may have more."""
            nonlocal number
            if any(map(np.any, marks)):
                anchors = found()
                for at in range(0, anchors.num_rows, TILE):
                    some = anchors.slice(at, TILE)
                    yield some.add_column(0, "tile", pa.array(np.full(some.num_rows, (part << 32) + number)))
                    number += 1

        def found() -> pa.RecordBatch:
            rows, ids, given, labels = (np.concatenate([getattr(b, x) for b in held]) for x in ("rows", "ids", "given", "labels"))
            raw = np.concatenate([b.raw for b in held])
            at = np.flatnonzero(np.concatenate(marks))
            least = np.full(len(at), -_FAR)
            for label in np.unique(labels[at]):
                own, mine = np.flatnonzero(labels == label), np.flatnonzero(labels[at] == label)
                if len(own) > positives:  # others than the anchor
                    scores = raw[at[mine]].astype(kind) @ raw[own].astype(kind).T
                    scores[np.searchsorted(own, at[mine])[:, None] == np.arange(len(own))] = -_FAR
                    least[mine] = np.partition(scores, -positives, axis=1)[:, -positives].astype(np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(rows[at]),
                    "vec_id": pa.array(ids[at], mask=~given[at]),
                    "label": pa.array(labels[at]),
                    "parts": pa.array([x.tobytes() for x in raw[at]], pa.binary()),
                    "lo": pa.array([[x] for x in least.tolist()], pa.list_(pa.int64())),
                    "hi": pa.array([[_FAR]] * len(at), pa.list_(pa.int64())),
                }
            )

        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                mark = np.frombuffer(row["anchors"], np.bool_)
                if held and (len(held) >= _STRETCH or sum(map(np.sum, marks)) + mark.sum() > TILE):
                    yield from tiled()
                    held, marks = [], []
                held.append(_Block(row, np.int32))
                marks.append(mark)
        yield from tiled()

    return tiles


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps of many blocks packed into one row."""
    held: list[dict] = []

    def chunk() -> pa.RecordBatch:
        kinds = [np.frombuffer(row["kinds"], np.int64) for row in held]
        blocks = np.array([row["block"] for row in held], np.int64)
        packed = [
            blocks.tobytes(),
            b"".join(row["lows"] for row in held),
            b"".join(row["highs"] for row in held),
            np.concatenate(kinds).tobytes(),
            np.cumsum([0, *map(len, kinds)])[:-1].astype(np.int64).tobytes(),
        ]
        columns = [pa.array([int(blocks[0])]), *(pa.array([x], pa.binary()) for x in packed)]
        return pa.RecordBatch.from_arrays(columns, ["first", "blocks", "lows", "highs", "kinds", "cuts"])

    for batch in batches:
        held.extend(batch.to_pylist())
        while len(held) >= ZONES:
            rest, held = held[ZONES:], held[:ZONES]
            yield chunk()
            held = rest
    if held:
        yield chunk()


def _chosen(same: bool, kind):
    """The blocks whose bounds meet a window of an anchor, each with the anchors that must read it."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                anchors = row.column("anchors").flatten()
                read = {name: row.column(name)[0].as_py() for name in ("blocks", "lows", "highs", "kinds", "cuts")}
                blocks, kinds, cuts = (np.frombuffer(read[name], np.int64) for name in ("blocks", "kinds", "cuts"))
                lows, highs = (np.frombuffer(read[name], np.int32).reshape(len(blocks), -1).astype(kind) for name in ("lows", "highs"))
                parts, labels, lo, hi = _arrays(anchors, kind)
                up, down = np.maximum(parts, 0), np.minimum(parts, 0)
                most, least = up @ highs.T + down @ lows.T, up @ lows.T + down @ highs.T
                meets = np.zeros(most.shape, dtype=bool)
                for a, b in zip(lo.T, hi.T):
                    meets |= (most >= a[:, None]) & (least <= b[:, None])
                alone = np.diff(np.append(cuts, len(kinds))) == 1
                for label in np.unique(labels):
                    held = np.logical_or.reduceat(kinds == label, cuts)
                    meets[labels == label] &= held if same else ~(held & alone)
                at, which = np.nonzero(meets.T)
                if len(at):
                    needed, counts = np.unique(at, return_counts=True)
                    ends = pa.array(np.cumsum([0, *counts]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(ends, anchors.take(pa.array(which)))
                    yield pa.RecordBatch.from_arrays([pa.array(blocks[needed]), lists], ["block", "anchors"])

    return chosen


def _arrays(anchors: pa.StructArray, kind) -> tuple[np.ndarray, ...]:
    """Vectors, labels and windows; an anchor with fewer windows has empty ones."""
    labels = anchors.field("label").to_numpy()
    parts = np.frombuffer(b"".join(anchors.field("parts").to_pylist()), np.int32).reshape(len(labels), -1).astype(kind)
    los, his = anchors.field("lo").to_pylist(), anchors.field("hi").to_pylist()
    most = max(map(len, los))
    lo = np.array([x + [1] * (most - len(x)) for x in los], np.int64).reshape(len(los), most)
    hi = np.array([x + [0] * (most - len(x)) for x in his], np.int64).reshape(len(los), most)
    return parts, labels, lo, hi


def _scored(same: bool, first: int, kind):
    """The first rows of a block in each window."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                anchors = row.column("anchors").flatten()
                block = _Block({name: row.column(name)[0].as_py() for name in ("rows", "ids", "given", "labels", "parts")}, kind)
                parts, labels, lo, hi = _arrays(anchors, kind)
                rows = anchors.field("row").to_numpy()
                scores = (parts @ block.parts.T).astype(np.int64)
                able = (labels[:, None] == block.labels) == same
                if same:
                    able &= rows[:, None] != block.rows
                for place, (a, b) in enumerate(zip(lo.T, hi.T)):
                    which, at = np.nonzero(able & (scores >= a[:, None]) & (scores <= b[:, None]))
                    if len(which):
                        found.append((rows[which], np.full(len(which), place), scores[which, at], block.ids[at], ~block.given[at]))
            if found:
                rows, places, scores, ids, missing = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((ids, missing, -scores, places, rows))
                rows, places = rows[order], places[order]
                new = np.flatnonzero((np.diff(rows, prepend=rows[0] - 1) != 0) | (np.diff(places, prepend=-1) != 0))
                nth = np.arange(len(rows)) - np.repeat(new, np.diff(np.append(new, len(rows))))
                keep = order[nth < first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[nth < first]),
                        pa.array(places[nth < first].astype(np.int32)),
                        pa.array(scores[keep]),
                        pa.array(ids[keep], mask=missing[keep]),
                    ],
                    ["row", "place", "score", "vec_id"],
                )

    return scored
