"""Near duplicates by MinHash: a multi-index Hamming join over b-bit signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.components import components
from tripline.llm.flat import SPACED, Words, combined, flattened, mixed, pieces, words_of
from tripline.llm.store import stored, stored_in
from tripline.plans.tables import build_session


@dataclass(frozen=True)
class Signature:
    """How documents are sketched and searched.

    Each of ``symbols`` hash functions gives a symbol of 16 bits. Two sets of similarity J differ in about
    (1 - J) * ``symbols`` symbols; all pairs that differ in at most ``distance`` of them are found: among
    ``symbols / 4`` chunks of four symbols one has at most ``errors`` of the differences, so the two agree in that
    chunk with some ``errors`` symbols left out. At J = 0.75 the defaults miss about one pair in 100,000, and far fewer
    above. A chunk is 64 bits, one number of the stored signature.
    """

    symbols: int = 64
    distance: int = 31
    seed: int = 20_231
    chunk = 4

    @property
    def chunks(self) -> int:
        return self.symbols // self.chunk

    @property
    def errors(self) -> int:
        return self.distance // self.chunks

    @property
    def variants(self) -> list[list[int]]:
        """The symbols that each search key keeps."""
        kept = self.chunk - self.errors
        if self.symbols % self.chunk or not 0 < kept <= 3:
            raise ValueError("a search key has one to three symbols, and chunks are whole")
        return [
            [at + k for k in keep]
            for at in range(0, self.symbols, self.chunk)
            for keep in combinations(range(self.chunk), kept)
        ]


def near_duplicates(
    docs: DataFrame, words: int = 5, similar: int = 75, signature: Signature = Signature()
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 * common shingles >= ``similar`` * all shingles of both; ``component_id`` is the
    smallest doc_id that links reach. A shingle is a run of ``words`` lower-cased words; a text of fewer is one
    shingle, a text without words (or NULL) has none and is linked with nothing. Documents of equal sets are one class
    with one search row, so groups of copies cost nothing. Rows without doc_id are linked with nothing, and have no
    component. Rows that share a doc_id are one document, linked by any of its texts. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sketched = stored(rows.mapInArrow(_sketcher(words, signature), _SKETCH), "sketches")
    known = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature")),
        "classes",
    )
    keys = ["f1", "f2", "n_shingles"]
    own = stored(known.select("doc_id", *keys).join(classes.select(*keys, "rep"), keys).select("doc_id", "rep").distinct(), "own")
    # A doc_id with texts of several classes links these.
    several = own.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last")
    shared = own.join(several.select("doc_id", "b"), "doc_id").select(F.col("rep").alias("a"), "b")
    found = components(_links(rows, classes, words, similar, signature).union(shared))
    # Links are between classes; each document then takes the component of its class.
    reached = own.join(found, own["rep"] == found["node"], "left")
    reached = reached.groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return (
        sketched.select("doc_id", "n_shingles")
        .join(reached, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


# Members of one key, and shingles of the members of one neighbourhood, that are compared with as many others at a time.
BLOCK = 64
BLOCK_SHINGLES = 1 << 15

_SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, signature array<long>"


def _links(rows: DataFrame, classes: DataFrame, words: int, similar: int, signature: Signature) -> DataFrame:
    """Links that connect the classes whose sets are similar, by their smallest doc_ids."""
    keys = classes.select("rep", "signature").mapInArrow(_enumerated(signature), "key long, rep long")
    shared = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    members = stored(keys.join(shared, "key"), "members")
    sets = stored(
        rows.join(
            members.select(F.col("rep").alias("doc_id")).distinct().join(
                classes.select(F.col("rep").alias("doc_id"), "f1"), "doc_id"
            ),
            "doc_id",
        ).mapInArrow(_shingled(words), "rep long, f1 long, f2 long, shingles array<long>")
        .groupBy("rep", "f1", "f2").agg(F.first("shingles").alias("shingles"))
        .select("rep", "shingles"),
        "sets",
    )

    sketch = classes.select("rep", "signature")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of pairs of classes those whose sets are similar."""
        near = (
            pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")
            .where(f"{_distance(signature)} <= {signature.distance}").select("a", "b").distinct()
        )
        both = near.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        common = both.select("a", "b", F.expr("size(array_intersect(x, y)) AS n"), F.expr("size(x) + size(y) AS total"))
        return stored(common.where(f"100L * n >= {similar}L * (total - n)").select("a", "b"), "confirmed")

    # One pair for each class first, with the smallest class it shares a key with; that connects most groups whole.
    first = members.where("rep <> lo").groupBy("rep").agg(F.min("lo").alias("b")).withColumnRenamed("rep", "a")
    links = confirmed(first)
    # Members whose keys have one smallest class are a neighbourhood; inside it sets are compared block by block.
    left = _apart(members, links)
    hubs = members.groupBy("rep").agg(F.min("lo").alias("hub"))
    near = left.select("rep", "c").distinct().join(hubs, "rep").join(sets, "rep")
    links = links.union(_compared(near, similar))
    # What remains are pairs of different neighbourhoods: those that agree in a chunk and are near by signature.
    left = _blocks(left.join(hubs, "rep").join(sketch, "rep"))
    one, other = (left.select(*(F.col(name).alias(f"{side}_{name}") for name in left.columns)) for side in "xy")
    meeting = one.join(other, F.expr(f"x_key = y_key AND {_PARTS} AND NOT (x_low = x_high AND y_low = y_high AND x_low = y_low)"))
    columns = [f"{side}_{name}" for side in "xy" for name in ("rep", "c", "hub", "x")]
    pairs = meeting.select("x_key", *columns).mapInArrow(_meeting(signature), "a long, b long").distinct()
    return links.union(confirmed(pairs))


_PARTS = (
    "(x_kind < y_kind OR x_kind = y_kind AND x_part <= y_part)"
    " AND NOT (x_least = x_most AND y_least = y_most AND x_least = y_least)"
)


def _compared(near: DataFrame, similar: int) -> DataFrame:
    """Links between different components ``c`` of one ``hub``, from the sets themselves.

    Blocks of about ``BLOCK_SHINGLES`` meet as rows of a join; their pairs are counted inside the task that has both,
    and only links come out. Blocks inside one component do not meet. This runs in a session of its own in which a
    batch of rows for Python is a few blocks.
    """
    spark = near.sparkSession
    sizes = near.withColumn("n", F.size("shingles")).groupBy("hub", "c").agg(F.sum("n").alias("n"))
    ends = sizes.groupBy("hub").agg(
        F.min("c").alias("least"), F.max("c").alias("most"),
        F.sum(F.when(F.col("n") < BLOCK_SHINGLES, F.col("n"))).alias("rest"),
    ).where("least < most").select("hub", "rest")
    large = F.col("n") >= BLOCK_SHINGLES
    parts = F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK_SHINGLES)
    blocks = (
        near.join(sizes, ["hub", "c"]).join(ends, "hub")
        .withColumn("kind", F.when(large, F.col("c")).otherwise(F.lit(-(2**63))))
        .withColumn("part", F.pmod(F.xxhash64("rep"), parts))
        .groupBy("hub", "kind", "part")
        .agg(F.min("c").alias("least"), F.max("c").alias("most"), F.collect_list(F.struct("rep", "c", "shingles")).alias("m"))
        .select("hub", "kind", "part", "least", "most", "m.rep", "m.c",
                F.transform("m", lambda row: F.size(row.shingles)).alias("n"), F.flatten("m.shingles").alias("s"))
    )
    blocks = stored(blocks, "blocks", release=True)
    own = build_session(spark)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    rows = stored_in(own, blocks)
    one, other = (rows.select(*(F.col(name).alias(f"{side}_{name}") for name in rows.columns)) for side in "xy")
    meeting = one.join(other, F.expr(f"x_hub = y_hub AND {_PARTS}"))
    columns = [f"{side}_{name}" for side in "xy" for name in ("rep", "c", "n", "s")]
    found = stored(meeting.select(*columns).mapInArrow(_linked(similar), "a long, b long"), "compared")
    return stored_in(spark, found)


def _blocks(left: DataFrame) -> DataFrame:
    """The members of each key in blocks of about ``BLOCK``, a large component's apart from the others'.

    So pairs inside a large component need not be made, and all others are made a block against a block. ``low`` and
    ``high`` are the smallest and largest neighbourhood of a block.
    """
    sizes = left.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.groupBy("key").agg(F.sum(F.when(F.col("n") < BLOCK, F.col("n"))).alias("rest"))
    large = F.col("n") >= BLOCK
    parts = F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK)
    return (
        left.join(sizes, ["key", "c"]).join(small, "key")
        .withColumn("kind", F.when(large, F.col("c")).otherwise(F.lit(-(2**63))))
        .withColumn("part", F.pmod(F.xxhash64("rep"), parts))
        .groupBy("key", "kind", "part")
        .agg(
            F.min("c").alias("least"), F.max("c").alias("most"), F.min("hub").alias("low"), F.max("hub").alias("high"),
            F.collect_list(F.struct("rep", "c", "hub", F.col("signature").alias("x"))).alias("m"),
        )
        .select("key", "kind", "part", "least", "most", "low", "high", "m.rep", "m.c", "m.hub", F.flatten("m.x").alias("x"))
    )


def _apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the keys that more than one component shares: ``rep``, ``key``, component ``c``."""
    known = components(links).withColumnsRenamed({"node": "rep", "component": "c"})
    labelled = members.select("key", "rep").join(known, "rep", "left")
    labelled = stored(labelled.select("rep", "key", F.coalesce("c", "rep").alias("c")), "labelled")
    ends = labelled.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("most"))
    return stored(labelled.join(ends.where("least < most").select("key"), "key").select("rep", "key", "c"), "apart")


def _errors(chunk: int) -> str:
    """In SQL, the number of symbols in which a chunk of signatures x and y differs: each symbol folded to one bit."""
    differing = f"(x[{chunk}] ^ y[{chunk}])"
    return " + ".join(
        f"if((shiftrightunsigned({differing}, {shift}) & 65535) = 0, 0, 1)" for shift in (0, 16, 32, 48)
    )


def _distance(signature: Signature) -> str:
    return " + ".join(_errors(k) for k in range(signature.chunks))


# In tasks


def _sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in rising order, and where each text's begin."""
    names, at = words.shingles(n)
    text = words.text[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole = words.names[words.offsets[short]].copy()
        for k in range(1, n):
            longer = words.counts[short] > k
            whole[longer] = combined(whole[longer], words.names[words.offsets[short][longer] + k])
        names, text = np.concatenate([names, whole]), np.concatenate([text, short])
    order = np.argsort(names)
    if len(words.flat) < 1 << 16:
        order = order[np.argsort(text[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(text[order], kind="stable")]
    names, text = names[order], text[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    names, text = names[new], text[new]
    return names, np.searchsorted(text, np.arange(len(words.flat) + 1))


def _prints(names: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each set."""
    full = np.diff(offsets) > 0
    out = np.zeros((2, len(full)), np.uint64)
    if full.any():
        for k, salt in enumerate((0x517CC1B727220A95, 0x2545F4914F6CDD1D)):
            out[k, full] = np.add.reduceat(mixed(names ^ np.uint64(salt)), offsets[:-1][full])
    return out[0].view(np.int64), out[1].view(np.int64)


def _lists(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of lists, one for each run of numbers."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(data))


def _sketcher(n: int, signature: Signature):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(signature.seed)
        factors = random.integers(0, 2**63, (2, signature.symbols), np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for piece in pieces(batch):
                names, offsets = _sets(words_of(flattened(piece.column("text")).lowered, SPACED), n)
                full = np.flatnonzero(np.diff(offsets) > 0)
                sign = np.zeros((piece.num_rows, signature.symbols), "<u2")
                for k in range(signature.symbols if len(full) else 0):
                    least = np.minimum.reduceat((names ^ factors[0, k]) * factors[1, k], offsets[:-1][full])
                    sign[full, k] = mixed(least) >> np.uint64(48)
                f1, f2 = _prints(names, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.array(f1),
                        pa.array(f2),
                        _lists(sign.ravel().view("<i8"), np.arange(piece.num_rows + 1) * signature.chunks),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "signature"],
                )

    return sketch


def _enumerated(signature: Signature):
    variants = signature.variants

    def enumerate_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = batch.column("signature").flatten().to_numpy().view("<u2").reshape(batch.num_rows, -1)
            signs = signs.astype(np.int64)
            keys = np.empty((len(signs), len(variants)), np.int64)
            for k, kept in enumerate(variants):
                keys[:, k] = k
                for symbol in kept:
                    keys[:, k] = keys[:, k] << 16 | signs[:, symbol]
            reps = np.repeat(batch.column("rep").to_numpy(), len(variants))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(reps)], ["key", "rep"])

    return enumerate_keys


def _shingled(n: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                names, offsets = _sets(words_of(flattened(piece.column("text")).lowered, SPACED), n)
                f1, f2 = _prints(names, offsets)
                out = pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(f1), pa.array(f2), _lists(names.view(np.int64), offsets)],
                    ["rep", "f1", "f2", "shingles"],
                )
                yield out.filter(pa.array(f1 == piece.column("f1").to_numpy()))

    return shingle


def _meeting(signature: Signature):
    variants = len(signature.variants) // signature.chunks
    bits = np.int64(16 * len(signature.variants[0]))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = {name: batch.column(name) for name in batch.schema.names}
            for k in range(batch.num_rows):
                (a, c, h, x), (b, d, g, y) = (
                    [columns[f"{side}_{name}"][k].values.to_numpy() for name in ("rep", "c", "hub", "x")] for side in "xy"
                )
                i, j = np.nonzero((c[:, None] != d[None, :]) & (h[:, None] != g[None, :]))
                x = x.view("<u2").reshape(len(a), signature.chunks, -1)[i]
                y = y.view("<u2").reshape(len(b), signature.chunks, -1)[j]
                errors = (x != y).sum(axis=2)
                # A pair comes out at the first chunk in which it agrees, and if its signatures are near.
                here = (columns["x_key"][k].as_py() >> int(bits)) // variants
                keep = ((errors <= signature.errors).argmax(axis=1) == here) & (errors.sum(axis=1) <= signature.distance)
                a, b = a[i[keep]], b[j[keep]]
                found.append((np.maximum(a, b), np.minimum(a, b)))
            if found:
                a, b = (np.concatenate(side) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return meet


def _linked(similar: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (a, c, n, x), (b, d, m, y) = (
                    [batch.column(f"{side}_{name}")[k].values.to_numpy() for name in ("rep", "c", "n", "s")] for side in "xy"
                )
                shared = np.intersect1d(x, y)
                has = []
                for sizes, values in ((n, x), (m, y)):
                    row = np.repeat(np.arange(len(sizes)), sizes)
                    place = np.minimum(np.searchsorted(shared, values), max(0, len(shared) - 1))
                    inside = shared[place] == values if len(shared) else np.zeros(len(values), dtype=bool)
                    table = np.zeros((len(sizes), len(shared)), np.float32)
                    table[row[inside], place[inside]] = 1
                    has.append(table)
                common = (has[0] @ has[1].T).astype(np.int64)
                union = n[:, None].astype(np.int64) + m[None, :] - common
                i, j = np.nonzero((c[:, None] != d[None, :]) & (100 * common >= similar * union))
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.maximum(a[i], b[j])), pa.array(np.minimum(a[i], b[j]))], ["a", "b"]
                    )

    return link
