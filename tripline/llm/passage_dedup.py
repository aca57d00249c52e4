"""Deduplication of passages of words by recompression.

In rounds, runs of one symbol and then pairs of symbols become one symbol. What becomes a pair is decided by the two
symbols alone (a bit of the first's name says left, of the second's right), and a name is a fingerprint of the parts,
the same on every machine: so equal passages are rewritten equally, but for a margin, and the rounds need no shuffle.
Each symbol keeps the range of words that it depends on. A window that holds that range has the symbol wherever it
stands; symbols found twice or more reveal the windows that may repeat, and fingerprints of the words verify them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import SPACED, Flat, Words, combined, flattened, mixed, pieces, words_of
from tripline.llm.repeats import (
    BLOCK_BYTES,
    LAST,
    binary_rows,
    bucket_count,
    codes_of,
    copies,
    joined,
    joined_codes,
    known_rows,
    repeated_names,
    text_classes,
)
from tripline.llm.store import stored

# What each round rewrites. A round of pairs leaves three quarters of the symbols.
ROUNDS = ("pairs", "pairs", "runs", "pairs", "pairs", "pairs", "pairs")

_U16, _I32, _I64, _U64 = np.dtype("<u2"), np.dtype("<i4"), np.dtype("<i8"), np.dtype("<u8")
_FAR = np.int64(1) << 40


def without_repeated_passages(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words that stay, one blank between).

    A word goes if a window of ``window`` words that covers it has a word sequence that also starts earlier: in a
    document of smaller doc_id, or in the same one. All is judged on the texts as given. Words are what stands between
    blanks; NULL and blank texts have none. A NULL doc_id is larger than any other; rows of equal doc_id count as one
    document, in which windows at equal places are not earlier. An empty table gives no rows; other columns are not
    read.
    """
    rows = known_rows(docs)
    classes = text_classes(rows)
    buckets = bucket_count(classes)
    names = repeated_names(rows, classes, lambda flat: _anchors(flat, window), buckets)
    entries = rows.join(names, ["ord", "hash"]).mapInArrow(_windows(window, buckets), _ENTRIES)
    found = entries.groupBy("bucket").applyInArrow(_second, "ord long, hash long, starts binary")
    found = found.union(copies(rows, classes).withColumn("starts", F.lit(None).cast("binary")))
    found = found.groupBy("ord", "hash").agg(
        F.collect_list("starts").alias("starts"), F.max(F.col("starts").isNull()).alias("copy")
    )
    found = stored(found, "found", release=True)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.xxhash64("text").alias("hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return texts.join(found, ["ord", "hash"], "left").mapInArrow(
        _removed(window), "doc_id long, n_words long, n_removed long, kept string"
    )


def digest(kept: DataFrame) -> DataFrame:
    """The same with the fingerprint of the words that stay."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


_ENTRIES = "bucket int, orders binary, hashes binary, counts binary, prints binary, checks binary, starts binary"
_ENTRY_COLUMNS = ["bucket", "orders", "hashes", "counts", "prints", "checks", "starts"]


# In tasks


@dataclass
class Level:
    """The symbols after a round, the text of each, and the first and last word that each depends on."""

    names: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether the symbol before, and the one after, is in the same text."""
        same = self.text[1:] == self.text[:-1]
        return np.append(False, same), np.append(same, False)


def _recompressed(words: Words) -> Iterator[Level]:
    """The levels from the words up."""
    at = np.arange(len(words))
    level = Level(words.names, words.text, at, at)
    for k, what in enumerate(ROUNDS):
        level = (_runs if what == "runs" else _pairs)(level, np.uint64(k + 1))
        yield level


def _pairs(level: Level, salt: np.uint64) -> Level:
    """A left symbol and the right symbol after it become one; which is which says the name."""
    names, low, high = level.names, level.low, level.high
    right = (mixed(names ^ salt) >> np.uint64(63)).astype(bool)
    before, after = level.beside()
    paired = np.zeros(len(names), dtype=bool)  # with the next one
    paired[:-1] = ~right[:-1] & right[1:] & after[:-1]
    second = np.append(False, paired[:-1])
    # One that stays alone has looked at the neighbour it might have joined; where a text ends, nothing is known.
    new_low, new_high = low.copy(), high.copy()
    alone = ~paired & ~second
    lefts = np.flatnonzero(alone & ~right)
    new_high[lefts] = np.where(after[lefts], high[np.minimum(lefts + 1, len(names) - 1)], _FAR)
    rights = np.flatnonzero(alone & right)
    new_low[rights] = np.where(before[rights], low[np.maximum(rights - 1, 0)], -_FAR)
    firsts = np.flatnonzero(paired)
    new_high[firsts] = high[firsts + 1]
    out = names.copy()
    out[firsts] = combined(names[firsts], names[firsts + 1])
    kept = ~second
    return Level(out[kept], level.text[kept], new_low[kept], new_high[kept])


def _runs(level: Level, salt: np.uint64) -> Level:
    """Equal symbols in a row become one, named by symbol and number. All have looked at both neighbours."""
    names = level.names
    before, _ = level.beside()
    heads = np.flatnonzero(~(before & np.append(False, names[1:] == names[:-1])))
    if not len(heads):
        return level
    sizes = np.diff(np.append(heads, len(names)))
    tails = heads + sizes - 1
    text = level.text[heads]
    out = names[heads].copy()
    many = sizes > 1
    out[many] = combined(out[many], sizes[many].astype(np.uint64) + (salt << np.uint64(40)))
    low, high = np.full(len(heads), -_FAR), np.full(len(heads), _FAR)
    same = np.flatnonzero(text[1:] == text[:-1])
    low[same + 1] = level.low[tails[same]]
    high[same] = level.high[heads[same + 1]]
    return Level(out, text, low, high)


def _covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some range."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _revealing(words: Words, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols that reveal windows: their names, the first and last window of each, and the windows that now have one.

    From the highest level down: a window without a symbol of the levels above gets all it has on this one. What is
    left (runs and periods that no round settles inside the window) is revealed by the window's own fingerprint.
    """
    n = len(words)
    ends = np.repeat(words.offsets[1:], words.counts)
    open_ = np.arange(n) + window <= ends
    for level in reversed(list(_recompressed(words))):
        inside = (level.high - level.low < window) & (level.low >= 0) & (level.high < _FAR)
        low, high, names = level.low[inside], level.high[inside], level.names[inside]
        text = level.text[inside]
        first = np.maximum(high - window + 1, words.offsets[text])
        last = np.minimum(low, words.offsets[text + 1] - window)
        before = np.append(0, np.cumsum(open_))
        wanted = np.flatnonzero(last >= first)
        wanted = wanted[before[last[wanted] + 1] > before[first[wanted]]]
        if len(wanted):
            first, last = first[wanted], last[wanted]
            new = open_ & _covered(first, last, n)
            yield names[wanted], first, last, new
            open_ &= ~new
    rest = np.flatnonzero(open_)
    if len(rest):
        yield mixed(_fingerprints(words, window)[0][rest]), rest, rest, open_


def _fingerprints(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names for the window at each word; meaningless where a text ends before."""
    out = []
    for names in (words.names, mixed(words.names ^ np.uint64(0xA0761D6478BD642F))):
        done, result, doubled = 0, None, names
        width = 1
        while done < window:
            if window & width:
                part = _ahead(doubled, done)
                result = part if result is None else combined(result, part)
                done += width
            doubled, width = combined(doubled, _ahead(doubled, width)), width * 2
        out.append(result)
    return out[0], out[1]


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def _anchors(flat: Flat, window: int) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(flat, SPACED)
    found = [(names, first) for names, first, _, _ in _revealing(words, window)] if len(words) else []
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    names, texts = np.concatenate([x[0] for x in found]), words.text[np.concatenate([x[1] for x in found])]
    order = np.argsort(texts, kind="stable")
    return names[order], texts[order]


def _listed(codes: np.ndarray, texts: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Which codes their text's list has; texts need not be in order."""
    order = np.argsort(texts, kind="stable")
    cuts = np.searchsorted(texts[order], np.arange(len(lists) + 1))
    kept = np.zeros(len(codes), dtype=bool)
    for k, wanted in enumerate(lists):
        own = order[cuts[k] : cuts[k + 1]]
        kept[own] = np.isin(codes[own], wanted)
    return kept


def _windows(window: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[dict[str, np.ndarray]] = []
        size = rows = 0
        for batch in batches:
            for piece in pieces(batch):
                flat = flattened(piece.column("text"))
                words = words_of(flat, SPACED)
                size += len(flat.data)
                if not len(words):
                    continue
                lists = joined_codes(piece.column("names"))
                likely = np.zeros(len(words), dtype=bool)
                for names, first, last, new in _revealing(words, window):
                    known = _listed(codes_of(names, buckets), words.text[first], lists)
                    likely |= new & ~_covered(first[~known], last[~known], len(words))
                at = np.flatnonzero(likely)
                prints, checks = _fingerprints(words, window)
                gathered.append(
                    {
                        "prints": prints[at],
                        "checks": (checks[at] >> np.uint64(48)).astype(_U16),
                        "starts": (at - words.offsets[words.text[at]]).astype(_I32),
                        "texts": words.text[at] + rows,
                        "orders": piece.column("ord").to_numpy(),
                        "hashes": piece.column("hash").to_numpy(),
                    }
                )
                rows += piece.num_rows
                if size >= BLOCK_BYTES:
                    yield from _sent(gathered, buckets)
                    gathered, size, rows = [], 0, 0
        if gathered:
            yield from _sent(gathered, buckets)

    return send


def _sent(gathered: list[dict[str, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries for each bucket: of equal windows the earliest. The others are decided here, in buckets below zero."""
    parts = {key: np.concatenate([part[key] for part in gathered]) for key in gathered[0]}
    prints, checks, starts, texts = parts["prints"], parts["checks"], parts["starts"], parts["texts"]
    orders = parts["orders"]
    if not len(prints):
        return
    order = np.lexsort((starts, orders[texts], checks, prints))
    same = (prints[order][1:] == prints[order][:-1]) & (checks[order][1:] == checks[order][:-1])
    lead = np.where(np.append(False, same), 0, np.arange(len(order)))
    lead = order[np.maximum.accumulate(lead)]
    late = (orders[texts[order]] > orders[texts[lead]]) | (starts[order] > starts[lead])
    decided = np.sort(order[late])
    if len(decided):
        # Pieces are in order, so texts rise here.
        cuts = np.flatnonzero(np.append(True, texts[decided][1:] != texts[decided][:-1]))
        who = texts[decided][cuts]
        columns = binary_rows({"starts": starts[decided]}, np.append(cuts, len(decided)))
        columns |= binary_rows({"orders": orders[who], "hashes": parts["hashes"][who]}, np.arange(len(who) + 1))
        bucket = -1 - (parts["hashes"][who].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        empty = pa.array([b""] * len(who), pa.binary())
        columns |= {"bucket": pa.array(bucket.astype(_I32)), "counts": empty, "prints": empty, "checks": empty}
        yield pa.RecordBatch.from_arrays([columns[name] for name in _ENTRY_COLUMNS], _ENTRY_COLUMNS)
    out = np.sort(order[~late])
    # Each bucket of names is two here: a symbol reveals several windows.
    bucket = (mixed(prints[out]) % np.uint64(2 * buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    out, bucket = out[order], bucket[order]
    own = texts[out]
    runs = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])))
    counts = np.diff(np.append(runs, len(out)))
    some, cut = np.unique(bucket, return_index=True)
    cuts = np.append(cut, len(out))
    who = own[runs]
    # Starts as steps from the one before, which compress well; a text's first in a bucket is whole.
    steps = np.diff(starts[out], prepend=np.int32(0)).astype(_I32)
    steps[runs] = starts[out][runs]
    columns = binary_rows({"prints": prints[out], "checks": checks[out], "starts": steps}, cuts)
    columns |= binary_rows(
        {"orders": orders[who], "hashes": parts["hashes"][who], "counts": counts.astype(_I32)},
        np.searchsorted(runs, cuts),
    )
    columns["bucket"] = pa.array(some.astype(_I32))
    yield pa.RecordBatch.from_arrays([columns[name] for name in _ENTRY_COLUMNS], _ENTRY_COLUMNS)


def _second(table: pa.Table) -> pa.Table:
    """Of one bucket: the windows of which an equal one is earlier."""
    empty = {"ord": pa.array([], pa.int64()), "hash": pa.array([], pa.int64()), "starts": pa.array([], pa.binary())}
    if not table.num_rows:
        return pa.table(empty)
    orders, hashes = joined(table, "orders", _I64), joined(table, "hashes", _I64)
    if table.column("bucket")[0].as_py() < 0:
        return pa.table({"ord": orders, "hash": hashes, "starts": table.column("starts")})
    counts = joined(table, "counts", _I32)
    document = np.repeat(np.arange(len(orders)), counts)
    prints, checks = joined(table, "prints", _U64), joined(table, "checks", _U16)
    starts = np.cumsum(joined(table, "starts", _I32), dtype=np.int64)
    # From the running sum of steps to starts: less what the sum was before each text.
    heads = np.cumsum(counts) - counts
    starts = (starts - np.repeat(np.append(0, starts)[heads], counts)).astype(_I32)
    order = np.lexsort((checks, prints))
    first = np.flatnonzero(
        np.append(True, (prints[order][1:] != prints[order][:-1]) | (checks[order][1:] != checks[order][:-1]))
    )
    sizes = np.diff(np.append(first, len(order)))
    several = np.repeat(sizes > 1, sizes)
    order = order[several]
    if not len(order):
        return pa.table(empty)
    group = np.repeat(np.arange(len(sizes)), sizes)[several]
    by = np.lexsort((starts[order], orders[document[order]], group))
    order, group = order[by], group[by]
    lead = np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(order)), 0)
    lead = order[np.maximum.accumulate(lead)]
    late = (orders[document[order]] > orders[document[lead]]) | (starts[order] > starts[lead])
    late = np.sort(order[late])
    if not len(late):
        return pa.table(empty)
    who = document[late]
    cuts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
    return pa.table(
        {"ord": orders[who[cuts]], "hash": hashes[who[cuts]]}
        | binary_rows({"starts": starts[late]}, np.append(cuts, len(late)))
    )


def _removed(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat = flattened(piece.column("text"))
                words = words_of(flat, SPACED)
                edges = np.zeros(len(words) + 1, np.int32)
                for k, copy in enumerate(piece.column("copy").to_pylist()):
                    if copy and words.counts[k] >= window:
                        edges[words.offsets[k]] += 1
                        edges[words.offsets[k + 1]] -= 1
                for k, lists in enumerate(piece.column("starts").to_pylist()):
                    if lists:
                        starts = np.frombuffer(b"".join(lists), _I32) + words.offsets[k]
                        np.add.at(edges, starts, 1)
                        np.add.at(edges, starts + window, -1)
                gone = np.cumsum(edges[:-1]) > 0
                removed = np.diff(np.append(0, np.cumsum(gone))[words.offsets])
                # Words that stay, each with a blank after it.
                stay = np.flatnonzero(~gone)
                lengths = words.ends[stay] - words.starts[stay] + 1
                ends = np.cumsum(lengths)
                data = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
                if len(stay):
                    source = np.repeat(words.starts[stay] - (ends - lengths), lengths) + np.arange(len(data))
                    blank = np.zeros(len(data), dtype=bool)
                    blank[ends - 1] = True
                    data[~blank] = flat.data[source[~blank]]
                cuts = np.append(0, ends)[np.searchsorted(stay, words.offsets)]
                kept = [data[a : max(a, b - 1)].tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(removed.astype(np.int64)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return remove
