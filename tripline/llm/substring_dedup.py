"""Exact substring deduplication over bytes: suffixes around shared anchors, sorted deep and shallow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import Flat, flattened, mixed, pieces, range_names
from tripline.llm.repeats import (
    BLOCK_BYTES,
    LAST,
    binary_rows,
    bucket_count,
    codes_of,
    copies,
    crowded,
    joined,
    joined_codes,
    known_rows,
    repeated_names,
    text_classes,
)
from tripline.llm.store import stored

# Suffixes a task sorts at a time.
SORTED_AT_ONCE = 1 << 19
# Bytes to which suffixes are sorted symbol by symbol; groups still equal then go to blind tries.
SHALLOW = 24
GRAM = 20

_U8, _I32, _I64 = np.dtype("u1"), np.dtype("<i4"), np.dtype("<i8")
_NONE = np.uint32(0xFFFFFFFF)


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay).

    A byte goes if a string of ``length`` bytes that covers it also starts in a document of smaller doc_id; all is
    judged on the texts as given. Texts are UTF-8 bytes, NULL and empty ones have none. A NULL doc_id is larger than
    any other; rows of equal doc_id are one document to this rule, so copies of a row do not remove each other. An
    empty table gives no rows; other columns are not read.

    Of every ``length`` bytes some gram of 20 has the smallest hash; it is the anchor of that string, wherever it
    stands. Only strings at anchors found twice or more become suffixes to sort. They meet in buckets by anchor; those
    of an anchor that very many texts share, by their own bytes.
    """
    if not SHALLOW + 8 <= length < 4096:
        raise ValueError(f"strings have {SHALLOW + 8} to 4095 bytes")
    rows = known_rows(docs)
    classes = text_classes(rows)
    buckets = bucket_count(classes)
    names = repeated_names(rows, classes, lambda flat: _anchors(flat, length)[:2], buckets)
    contexts = rows.join(names, ["ord", "hash"]).mapInArrow(_cut_out(length, buckets, crowded(names)), _CONTEXTS)
    found = contexts.groupBy("bucket").applyInArrow(_second(length), "ord long, hash long, runs binary")
    found = found.union(copies(rows, classes).withColumn("runs", F.lit(None).cast("binary")))
    found = found.groupBy("ord", "hash").agg(
        F.collect_list("runs").alias("runs"), F.max(F.col("runs").isNull()).alias("copy")
    )
    found = stored(found, "found", release=True)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.xxhash64("text").alias("hash"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return texts.join(found, ["ord", "hash"], "left").mapInArrow(
        _removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


_CONTEXTS = (
    "bucket int, orders binary, hashes binary, counts binary, codes binary, starts binary, lengths binary, bytes binary"
)
_CONTEXT_COLUMNS = ["bucket", "orders", "hashes", "counts", "codes", "starts", "lengths", "bytes"]


# In tasks


def _running(values: np.ndarray, n: int, best, fill) -> np.ndarray:
    """At each place the best of the n values from there on."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        ahead = np.full(len(out), fill, out.dtype)
        ahead[: len(out) - step] = out[step:]
        out = best(out, ahead)
        width += step
    return out


def _selected(flat: Flat, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors, their 32-bit weights, and the names of all grams."""
    n = len(flat.data)
    room = length - GRAM + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    eights = flat.eights
    m = n - GRAM + 1
    names = eights[:m] * np.uint64(0x9E3779B97F4A7C15)
    names += eights[8 : m + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    names ^= names >> np.uint64(32)
    names += eights[GRAM - 8 : m + GRAM - 8] * np.uint64(0x165667B19E3779F9)
    names = mixed(names)
    weights = (names >> np.uint64(32)).astype(np.uint32)
    np.minimum(weights, _NONE - np.uint32(1), out=weights)
    # A gram or a string that runs out of its text does not count.
    whole = np.zeros(n + 1, np.int32)
    long = flat.lengths >= length
    np.add.at(whole, flat.offsets[:-1][long], 1)
    np.add.at(whole, flat.offsets[1:][long] - length + 1, -1)
    strings = np.cumsum(whole)[:m] > 0
    least = _running(weights, room, np.minimum, _NONE)
    least[~strings] = 0
    # The largest of the minima of the strings that a gram is in is its own weight just if it is some string's minimum.
    seen = _running(least[::-1], room, np.maximum, np.uint32(0))[::-1]
    at = np.flatnonzero(seen == weights)
    return at, weights[at], names


def _anchors(flat: Flat, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of anchors, the text of each, positions; each name once a text."""
    at, _, names = _selected(flat, length)
    texts, named = flat.text_of(at), names[at]
    order = np.lexsort((named, texts))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (named[order][1:] != named[order][:-1]) | (texts[order][1:] != texts[order][:-1])
    kept = np.sort(order[new])
    return named[kept], texts[kept], at[kept]


def _served(flat: Flat, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each anchor's name, and the first and last string start whose leftmost smallest gram it is."""
    at, weights, names = _selected(flat, length)
    reach = length - GRAM
    first, last = at - reach, at.copy()
    for sign in (-1, 1):
        todo = np.arange(len(at))
        step = 0
        while len(todo):
            step += 1
            other = todo + sign * step
            inside = (other >= 0) & (other < len(at))
            todo, other = todo[inside], other[inside]
            near = np.abs(at[other] - at[todo]) <= reach
            todo, other = todo[near], other[near]
            beats = weights[other] <= weights[todo] if sign < 0 else weights[other] < weights[todo]
            if sign < 0:
                first[todo[beats]] = at[other[beats]] + 1
            else:
                last[todo[beats]] = np.minimum(last[todo[beats]], at[other[beats]] - reach - 1)
            todo = todo[~beats]
    text = flat.text_of(at)
    first = np.maximum(first, flat.offsets[text])
    last = np.minimum(last, flat.offsets[text + 1] - length)
    return names[at], first, last


def _gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of some ranges, laid end to end."""
    if not len(starts):
        return np.empty(0, np.uint8)
    ends = np.cumsum(lengths)
    steps = np.ones(int(ends[-1]), np.int64)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return data[np.cumsum(steps)]


def _cut_out(length: int, buckets: int, crowd: np.ndarray):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[dict[str, np.ndarray]] = []
        size = rows = 0
        for batch in batches:
            for piece in pieces(batch):
                flat = flattened(piece.column("text"))
                names, first, last = _served(flat, length)
                codes = codes_of(names, buckets)
                texts = flat.text_of(first)
                kept = _listed(codes, texts, joined_codes(piece.column("names")))
                kept &= last >= first
                codes, first, last, texts = codes[kept], first[kept], last[kept], texts[kept]
                # Each bucket of names is several here: contexts are longer than names.
                bucket = (codes >> np.uint64(29)).astype(np.int64)
                many = np.isin(codes, crowd)
                if many.any():
                    n = last[many] - first[many] + 1
                    alone = np.repeat(first[many] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    own = range_names(flat, alone, alone + length)
                    codes = np.concatenate([codes[~many], own])
                    bucket = np.concatenate([bucket[~many], 8 * buckets + (own >> np.uint64(32)).astype(np.int64) % (8 * buckets)])
                    texts = np.concatenate([texts[~many], np.repeat(texts[many], n)])
                    first, last = np.concatenate([first[~many], alone]), np.concatenate([last[~many], alone])
                    order = np.argsort(first, kind="stable")
                    codes, bucket, texts, first, last = (x[order] for x in (codes, bucket, texts, first, last))
                lengths = last - first + length
                gathered.append(
                    {
                        "codes": codes,
                        "buckets": bucket,
                        "starts": (first - flat.offsets[texts]).astype(_I32),
                        "lengths": lengths.astype(_I32),
                        "texts": texts + rows,
                        "names": range_names(flat, first, first + lengths),
                        "bytes": _gathered(flat.data, first, lengths),
                        "orders": piece.column("ord").to_numpy(),
                        "hashes": piece.column("hash").to_numpy(),
                    }
                )
                size += len(flat.data)
                rows += piece.num_rows
                if size >= BLOCK_BYTES:
                    yield from _sent(gathered, length, buckets)
                    gathered, size, rows = [], 0, 0
        if rows:
            yield from _sent(gathered, length, buckets)

    return cut


def _listed(codes: np.ndarray, texts: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Which codes their text's list has."""
    kept = np.zeros(len(codes), dtype=bool)
    cuts = np.searchsorted(texts, np.arange(len(lists) + 1))
    for k, wanted in enumerate(lists):
        own = slice(cuts[k], cuts[k + 1])
        kept[own] = np.isin(codes[own], wanted)
    return kept


def _sent(gathered: list[dict[str, np.ndarray]], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Contexts for each bucket. Of equal ones that of the smallest document goes out; the others are decided here."""
    parts = {key: np.concatenate([part[key] for part in gathered]) for key in gathered[0]}
    codes, names, texts, orders = parts["codes"], parts["names"], parts["texts"], parts["orders"]
    if not len(codes):
        return
    lengths = parts["lengths"].astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    order = np.lexsort((orders[texts], names, codes))
    same = (codes[order][1:] == codes[order][:-1]) & (names[order][1:] == names[order][:-1])
    leader = np.arange(len(order))
    leader[1:][same] = 0
    leader = order[np.maximum.accumulate(leader)]  # in the order of ``order``
    follows = np.zeros(len(order), dtype=bool)
    follows[order] = np.append(False, same)
    lead = np.empty(len(order), np.int64)
    lead[order] = leader
    # Equal fingerprints are taken as equal only where the bytes are.
    data = np.append(parts["bytes"], np.zeros(8, np.uint8))
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    follower = np.flatnonzero(follows)
    equal = lengths[follower] == lengths[lead[follower]]
    for step in range(0, int(lengths.max()), 8):
        inside = np.minimum(step, lengths[follower] - 8)
        there = np.minimum(step, lengths[lead[follower]] - 8)
        equal &= eights[begins[follower] + inside] == eights[begins[lead[follower]] + there]
    follows[follower[~equal]] = False
    decided = np.flatnonzero(follows & (orders[texts] > orders[texts[lead]]))
    if len(decided):
        runs = np.stack([parts["starts"][decided], lengths[decided] - length + 1], axis=1).astype(_I32)
        cuts = np.flatnonzero(np.append(True, texts[decided][1:] != texts[decided][:-1]))
        who = texts[decided][cuts]
        columns = binary_rows({"starts": runs}, np.append(cuts, len(decided)) * 2)
        columns |= binary_rows({"orders": orders[who], "hashes": parts["hashes"][who]}, np.arange(len(who) + 1))
        bucket = -1 - (parts["hashes"][who].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        empty = pa.array([b""] * len(who), pa.binary())
        columns |= {"bucket": pa.array(bucket.astype(_I32)), "counts": empty, "codes": empty, "lengths": empty, "bytes": empty}
        yield pa.RecordBatch.from_arrays([columns[name] for name in _CONTEXT_COLUMNS], _CONTEXT_COLUMNS)
    sent = np.ones(len(codes), dtype=bool)
    sent[decided] = False
    out = np.flatnonzero(sent)
    bucket = parts["buckets"][out]
    order = np.lexsort((texts[out], bucket))
    out, bucket = out[order], bucket[order]
    own = texts[out]
    runs = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (bucket[1:] != bucket[:-1])))
    counts = np.diff(np.append(runs, len(out)))
    some, cut = np.unique(bucket, return_index=True)
    cuts = np.append(cut, len(out))
    for k in range(len(some)):  # one at a time: the bytes of all may be more than a batch should hold
        a, b = cuts[k], cuts[k + 1]
        here = slice(*np.searchsorted(runs, [a, b]))
        who = own[runs[here]]
        some_of = out[a:b]
        columns = {
            "bucket": pa.array(some[k : k + 1].astype(_I32)),
            "orders": _one(orders[who]),
            "hashes": _one(parts["hashes"][who]),
            "counts": _one(counts[here].astype(_I32)),
            "codes": _one((codes[some_of] & np.uint64(0xFFFFFFFF)).astype("<u4")),
            "starts": _one(parts["starts"][some_of]),
            "lengths": _one(lengths[some_of].astype(_I32)),
            "bytes": _one(_gathered(parts["bytes"], begins[some_of], lengths[some_of])),
        }
        yield pa.RecordBatch.from_arrays([columns[name] for name in _CONTEXT_COLUMNS], _CONTEXT_COLUMNS)


def _one(data: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(data).tobytes()], pa.binary())


def _second(length: int):
    def second(table: pa.Table) -> pa.Table:
        empty = pa.table({"ord": pa.array([], pa.int64()), "hash": pa.array([], pa.int64()), "runs": pa.array([], pa.binary())})
        if not table.num_rows:
            return empty
        orders, hashes = joined(table, "orders", _I64), joined(table, "hashes", _I64)
        if table.column("bucket")[0].as_py() < 0:
            return pa.table({"ord": orders, "hash": hashes, "runs": table.column("starts")})
        document = np.repeat(np.arange(len(orders)), joined(table, "counts", _I32))
        codes, starts = joined(table, "codes", np.dtype("<u4")), joined(table, "starts", _I32)
        lengths = joined(table, "lengths", _I32).astype(np.int64)
        flat = Flat(joined(table, "bytes", _U8), np.zeros(1, np.int64))
        data = flat.padded
        begins = np.cumsum(lengths) - lengths
        # Equal contexts are one, of the smallest document; in those of others all strings come second.
        names = range_names(flat, begins, begins + lengths)
        own = orders[document]
        order = np.lexsort((own, names, codes))
        same = (codes[order][1:] == codes[order][:-1]) & (names[order][1:] == names[order][:-1])
        same &= lengths[order][1:] == lengths[order][:-1]
        head = np.append(True, ~same)
        lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        follows = order[(own[order] > own[lead])]
        found = [(follows, np.zeros(len(follows), np.int64), lengths[follows] - length + 1)]
        leads, which = order[head], np.cumsum(head) - 1
        # What is true of the first holds for the others of its document too.
        others = order[~head & (own[order] == own[lead])]
        group = np.empty(len(order), np.int64)
        group[order] = which
        several = np.zeros(len(leads), dtype=bool)
        several[1:] |= codes[leads][1:] == codes[leads][:-1]
        several[:-1] |= codes[leads][1:] == codes[leads][:-1]
        order = np.sort(np.concatenate([leads[several], others[several[group[others]]]]))
        order = order[np.argsort(codes[order], kind="stable")]
        strings = np.cumsum(lengths[order] - length + 1)
        at = 0
        while at < len(order):
            # As many contexts as a task sorts at a time, with all of their last anchor.
            to = int(np.searchsorted(strings, (strings[at - 1] if at else 0) + SORTED_AT_ONCE, side="right"))
            to = max(to, at + 1)
            to = int(np.searchsorted(codes[order], codes[order[to - 1]], side="right"))
            part = order[at:to]
            found.append(_later(data, begins[part], lengths[part], codes[part], orders[document[part]], length, part))
            at = to
        context, first, count = (np.concatenate(x) for x in zip(*found))
        if not len(context):
            return empty
        order = np.argsort(context, kind="stable")
        context, first, count = context[order], first[order], count[order]
        who = document[context]
        cuts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        runs = np.stack([starts[context] + first, count], axis=1).astype(_I32)
        return pa.table(
            {"ord": orders[who[cuts]], "hash": hashes[who[cuts]]}
            | binary_rows({"runs": runs}, np.append(cuts, len(context)) * 2)
        )

    return second


def _later(data, begins, lengths, codes, orders, length: int, ids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings that a smaller document has: context, first string, number of strings."""
    n = lengths - length + 1
    context = np.repeat(np.arange(len(begins)), n)
    inner = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
    position = begins[context] + inner
    group = np.cumsum(np.append(False, codes[1:] != codes[:-1]))[context]
    order, leaf = sorted_suffixes(data, position, group, length)
    own = orders[context[order]]
    first = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1])) if len(leaf) else np.empty(0, np.int64)
    least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(own)))) if len(first) else own
    late = np.sort(order[own > least])
    if not len(late):
        return ids[:0], late, late
    breaks = np.append(True, (late[1:] != late[:-1] + 1) | (context[late[1:]] != context[late[:-1]]))
    heads = np.flatnonzero(breaks)
    return ids[context[late[heads]]], inner[late[heads]], np.diff(np.append(heads, len(late)))


def sorted_suffixes(data: np.ndarray, position: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that agree with another one of their group for ``length`` bytes.

    Returns them in the order of group and bytes, with a number for each set of equal ones. Multikey quicksort, eight
    bytes a symbol, goes to the shallow depth and leaves out what is alone by then. The rest goes to blind tries.
    """
    eights = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    alive, rank = np.arange(len(position)), group
    for depth in range(0, SHALLOW, 8):
        symbol = eights[position[alive] + depth].astype(np.uint64)
        order = _partitioned(symbol, rank)
        alive, symbol, rank = alive[order], symbol[order], rank[order]
        new = np.ones(len(alive), dtype=bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (rank[1:] != rank[:-1])
        alone = new & np.append(new[1:], True)
        rank = np.cumsum(new)[~alone]
        alive = alive[~alone]
    return _blind_tries(eights, position, alive, rank, length)


def _partitioned(symbol: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order of each rank's symbols, by three-way partitions around pivots; ranks stand together and stay so.

    A round takes a pivot for every open group and deals its members out to those below, equal and above. Equal ones are
    done at this depth, the others are groups of the next round. Pivots are medians of three, at places that change with
    the round, so no order of the input is a bad one for long.
    """
    order, values = np.arange(len(symbol), dtype=_I32), symbol.copy()
    todo, group, turn = order.copy(), np.asarray(rank), 1
    while len(todo):
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(heads, len(todo)))
        which, own = np.repeat(np.arange(len(heads), dtype=_I32), sizes), values[todo]
        a, b, c = (own[heads + (heads * 7 + turn * step) % sizes] for step in (0, 40_503, 69_069))
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[which]
        side = (own >= pivot).astype(np.uint8)
        side += own > pivot
        del pivot
        # Of each group those below come first, then the equal ones, then those above.
        place, before = np.empty(len(todo), _I32), heads.astype(_I32)
        for kind in range(3):
            here = side == kind
            counted = np.cumsum(here, dtype=_I32)
            offset = before - 1 - counted[heads] + here[heads]
            place[here] = counted[here] + offset[which[here]]
            before = before + np.add.reduceat(here, heads, dtype=_I32)
        dealt = np.empty(len(todo), _I32)
        dealt[place] = np.arange(len(todo), dtype=_I32)
        del place
        order[todo], values[todo] = order[todo][dealt], own[dealt]
        side = side[dealt]
        new = np.append(True, (side[1:] != side[:-1]) | (which[1:] != which[:-1]))
        open_ = (side != 1) & ~(new & np.append(new[1:], True))
        todo, group, turn = todo[open_], 3 * which[open_] + side[open_], turn + 1
    return order


def _blind_tries(eights, position, alive, rank, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order groups that agree up to the shallow depth, each by a trie that knows only where its branches part.

    All tries grow together. A suffix is compared with one leaf of its group, its first member: equal, it joins that
    leaf; else it hangs at the branch where it parts, under the byte it has there. Suffixes of one branch and byte are
    a group of the next round, and agree up to that byte; so there are no more rounds than bytes below the shallow
    depth. Branches to smaller suffixes come before the leaf, the nearest to the root first; larger ones after it.
    """
    open_ = np.ones(len(alive), dtype=bool)
    while open_.any():
        todo = np.flatnonzero(open_)
        first = np.append(True, rank[todo][1:] != rank[todo][:-1])
        leader = alive[todo[np.maximum.accumulate(np.where(first, np.arange(len(todo)), 0))]]
        mine_at, their_at = position[alive[todo]], position[leader]
        key = np.full(len(alive), 1 << 20, np.int64)  # the leaf itself
        same = np.flatnonzero(~first)
        for step in [*range(SHALLOW, length - 8, 8), length - 8]:
            mine = eights[mine_at[same] + step].astype(np.uint64)
            theirs = eights[their_at[same] + step].astype(np.uint64)
            differ = mine != theirs
            if differ.any():
                mine, theirs = mine[differ], theirs[differ]
                high, shift = mine ^ theirs, np.zeros(len(mine), np.uint64)
                for width in (32, 16, 8):
                    clear = high >> np.uint64(64 - width) == 0
                    high[clear] <<= np.uint64(width)
                    shift[clear] += np.uint64(width)
                byte = (mine >> (np.uint64(56) - shift) & np.uint64(255)).astype(np.int64)
                part = step + (shift >> np.uint64(3)).astype(np.int64)
                smaller = mine < theirs
                near = np.where(smaller, part, 4095 - part)
                key[todo[same[differ]]] = np.where(smaller, 0, 2 << 20) + (near << 8) + byte
            same = same[~differ]
        parted = key != 1 << 20
        path = rank.astype(np.int64) << 24 | key
        order = np.argsort(path, kind="stable")
        alive, path, parted = alive[order], path[order], parted[order]
        new = np.append(True, path[1:] != path[:-1])
        open_ = parted & ~(new & np.append(new[1:], True))
        rank = np.cumsum(new)
    if not len(alive):
        return alive, rank
    new = np.append(True, rank[1:] != rank[:-1])
    alone = new & np.append(new[1:], True)
    return alive[~alone], rank[~alone]


def _removed(length: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = []
                rows = zip(piece.column("text"), piece.column("runs").to_pylist(), piece.column("copy").to_pylist())
                for text, lists, copy in rows:
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    gone = np.zeros(len(data) + 1, np.int32)
                    if copy and len(data) >= length:
                        gone[0] = 1
                    if lists:
                        runs = np.frombuffer(b"".join(lists), _I32).reshape(-1, 2)
                        np.add.at(gone, runs[:, 0], 1)
                        np.add.at(gone, runs[:, 0] + runs[:, 1] + length - 1, -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    spans = int((gone & ~np.append(False, gone[:-1])).sum())
                    out.append((len(data), int(gone.sum()), spans, data[~gone].tobytes() if spans else data.tobytes()))
                sizes, removed, spans, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return remove


def digest(kept: DataFrame) -> DataFrame:
    """The same with the fingerprint of the bytes that stay."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")

