"""Benchmark passages in documents: a prefix-filtered set join with exact verification.

The set of an item's window is its shingles. A document contains the window only if it has all of them, so the prefix
that a partner must share is a single shingle, the rarest in the documents. Candidates are the places of that shingle;
its place in the window gives where the window would begin, and the ends of the text bound that. What is left is
compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import ALPHANUMERIC, Words, combined, flattened, mixed, pieces, words_of
from tripline.llm.store import stored

# Words of benchmark items that are looked for in one pass over the documents; more items take more passes. This
# bounds what is sent to all tasks, to about 50 bytes a word.
BLOCK_WORDS = 1_000_000


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``firsts``, ``lasts``.

    A window is ``window`` words in a row of an item, or all words of a shorter one. ``n_hit`` counts the document's
    words inside any occurrence of a window; ``firsts`` and ``lasts`` are the first and last words of the runs of
    such words, from 0. ``items`` are the item_ids with an occurring window, as strings in order. Words are lower-cased
    runs of a-z, 0-9 and all beyond ASCII. NULL, empty and wordless texts, of documents or items, have no words and
    no windows. Words of an item without item_id are hit, but it is not listed; items that share an item_id are one.
    Rows are judged one by one, whatever their doc_id. An empty table of documents gives no rows, an empty table of
    items no hits; other columns are not read.
    """
    named = stored(items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(_named, _ITEMS), "items")
    total = named.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = out.select("*", F.lit(b"").alias("hits"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        part = named.where(F.pmod(F.xxhash64("names"), F.lit(blocks)) == block)
        index = _index(docs, [(row.item, row.names) for row in part.distinct().collect()], window)
        match = _matched(index)
        if block + 1 < blocks:
            out = stored(out.mapInArrow(match, "doc_id long, text string, hits binary, items array<string>"), "matched")
        else:
            return out.mapInArrow(lambda batches: _counted(match(batches)), _COUNTED)
    return out.mapInArrow(_counted, _COUNTED)


_COUNTED = (
    "doc_id long, n_words long, n_hit long, n_items long, items array<string>, firsts array<long>, lasts array<long>"
)
_ITEMS = "item string, names binary, n long"


@dataclass
class Index:
    """The windows of some items.

    ``names`` are the words of all items end to end. A distinct window is ``size`` words from ``start``. ``tokens``
    are the prefix tokens in rising order; entry k of ``windows`` and ``offsets`` says which window token k stands
    for and how far inside it. ``owner`` has the items of each window, from ``owned[w]`` on.
    """

    names: np.ndarray
    start: np.ndarray
    size: np.ndarray
    tokens: np.ndarray
    windows: np.ndarray
    offsets: np.ndarray
    owner: np.ndarray
    owned: np.ndarray
    items: list[str | None]


def _index(docs: DataFrame, items: list[tuple[str | None, bytes]], window: int) -> Index:
    lists = [np.frombuffer(names, np.uint64) for _, names in items]
    names = np.concatenate(lists) if lists else np.empty(0, np.uint64)
    begins = np.cumsum([0, *map(len, lists)])
    start, size, owner = [], [], []
    for k, own in enumerate(lists):
        n = max(1, len(own) - window + 1)
        start.append(begins[k] + np.arange(n))
        size.append(np.full(n, min(window, len(own))))
        owner.append(np.full(n, k))
    start, size, owner = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (start, size, owner))
    # Equal windows are one, with the items of all.
    prints = mixed(size.astype(np.uint64))
    for step in range(window):
        inside = size > step
        prints[inside] = combined(prints[inside], names[start[inside] + step])
    _, first, which = np.unique(prints, return_index=True, return_inverse=True)
    start, size = start[first], size[first]
    order = np.argsort(which, kind="stable")
    owned = np.searchsorted(which[order], np.arange(len(start) + 1))
    owner = owner[order]
    # The shingles of each window, and how often documents have them.
    pairs = _tokens(names)
    singles = mixed(names)
    token = np.full((len(start), max(1, window - 1)), 0, np.uint64)
    known = np.zeros(token.shape, dtype=bool)
    for step in range(token.shape[1]):
        inside = size > step + 1
        token[inside, step], known[inside, step] = pairs[start[inside] + step], True
    lone = size == 1
    token[lone, 0], known[lone, 0] = singles[start[lone]], True
    wanted = np.unique(token[known])
    counts = np.zeros(len(wanted), np.int64)
    if len(wanted):
        counted = docs.select("text").mapInArrow(_counting(wanted), "token int, n long")
        for row in counted.groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[row.token] = row.n
    rarity = np.where(known, counts[np.searchsorted(wanted, token).clip(max=max(0, len(wanted) - 1))], 2**62) if len(wanted) else known
    offset = rarity.argmin(axis=1)
    rarest = token[np.arange(len(start)), offset]
    order = np.argsort(rarest, kind="stable")
    return Index(names, start, size, rarest[order], order, offset[order], owner, owned, [item for item, _ in items])


def digest(found: DataFrame) -> DataFrame:
    """The counts, and the fingerprint of the items."""
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# In tasks


def _tokens(names: np.ndarray) -> np.ndarray:
    """The shingle of two words at each word but the last."""
    return combined(names[:-1], names[1:])


def _words(texts: pa.Array) -> Words:
    return words_of(flattened(texts).lowered, ALPHANUMERIC)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            words = _words(piece.column("text"))
            cuts = words.offsets
            names = [words.names[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            out = pa.RecordBatch.from_arrays(
                [piece.column("item"), pa.array(names, pa.binary()), pa.array(words.counts.astype(np.int64))],
                ["item", "names", "n"],
            )
            yield out.filter(pa.array(words.counts > 0))


class _Lookup:
    """Finds the places of sorted numbers; a bitmap turns most others away."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        bits = max(16, int(len(numbers)).bit_length() + 5)
        self.shift = np.uint64(64 - bits)
        self.likely = np.zeros(1 << bits, dtype=bool)
        self.likely[numbers >> self.shift] = True

    def found(self, values: np.ndarray) -> np.ndarray:
        """Positions of values that are among the numbers."""
        at = np.flatnonzero(self.likely[values >> self.shift])
        place = np.minimum(np.searchsorted(self.numbers, values[at]), len(self.numbers) - 1)
        return at[self.numbers[place] == values[at]]


def _places(words: Words, lookup: _Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Wanted shingles: the word each begins at, and the shingle. Pairs do not cross texts."""
    if len(words) == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    singles = mixed(words.names)
    ones = lookup.found(singles)
    pairs = _tokens(words.names)
    twos = lookup.found(pairs)
    twos = twos[words.text[twos] == words.text[twos + 1]]
    return np.concatenate([ones, twos]), np.concatenate([singles[ones], pairs[twos]])


def _counting(wanted: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(wanted)
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for piece in pieces(batch):
                _, found = _places(_words(piece.column("text")), lookup)
                counts += np.bincount(np.searchsorted(wanted, found), minlength=len(wanted))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["token", "n"])

    return count


def _matched(index: Index):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(np.unique(index.tokens)) if len(index.tokens) else None
        for batch in batches:
            for piece in pieces(batch):
                if lookup is None:
                    yield piece
                    continue
                words = _words(piece.column("text"))
                place, token = _places(words, lookup)
                # Every window that has the token as its prefix.
                low, high = np.searchsorted(index.tokens, token), np.searchsorted(index.tokens, token, side="right")
                n = high - low
                entry = np.repeat(low - np.append(0, np.cumsum(n))[:-1], n) + np.arange(int(n.sum()))
                window, text = index.windows[entry], np.repeat(words.text[place] if len(place) else place, n)
                at = np.repeat(place, n) - index.offsets[entry]
                inside = (at >= words.offsets[text]) & (at + index.size[window] <= words.offsets[text + 1])
                at, window, text = at[inside], window[inside], text[inside]
                for step in range(int(index.size.max())):
                    longer = index.size[window] > step
                    same = np.ones(len(at), dtype=bool)
                    same[longer] = words.names[at[longer] + step] == index.names[index.start[window[longer]] + step]
                    at, window, text = at[same], window[same], text[same]
                order = np.argsort(text, kind="stable")
                at, window, text = at[order], window[order], text[order]
                cuts = np.searchsorted(text, np.arange(piece.num_rows + 1))
                hits, items = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                for k in np.unique(text):
                    own = slice(cuts[k], cuts[k + 1])
                    run = np.stack([at[own] - words.offsets[k], index.size[window[own]]], axis=1).astype(np.int64)
                    hits[k] = hits[k] + run.tobytes()
                    owners = {o for w in np.unique(window[own]) for o in index.owner[index.owned[w] : index.owned[w + 1]]}
                    items[k] = sorted({*items[k], *(index.items[o] for o in owners if index.items[o] is not None)})
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("text"), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "text", "hits", "items"],
                )

    return match


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            words = _words(piece.column("text"))
            n_hit, firsts, lasts = [], [], []
            for k, hits in enumerate(piece.column("hits").to_pylist()):
                runs = np.frombuffer(hits, np.int64).reshape(-1, 2)
                edges = np.zeros(int(words.counts[k]) + 1, np.int64)
                np.add.at(edges, runs[:, 0], 1)
                np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
                hit = np.cumsum(edges) > 0
                n_hit.append(int(hit.sum()))
                firsts.append(np.flatnonzero(hit & ~np.append(False, hit[:-1])))
                lasts.append(np.flatnonzero(hit & ~np.append(hit[1:], False)))
            items = piece.column("items")
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in items.to_pylist()], pa.int64()),
                    items,
                    pa.array(firsts, pa.list_(pa.int64())),
                    pa.array(lasts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items", "firsts", "lasts"],
            )
