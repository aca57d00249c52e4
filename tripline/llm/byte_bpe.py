"""Byte-level BPE by tree reduction: halves are encoded on their own and joined; decoding concatenates up the same tree.

Two facts make a join exact while it looks only at what lies beside the cut.

* *Tokens.* Merging lowest ranks first gives a row of tokens if and only if each two neighbours, merged on their own,
  stay as they are: the first merge to cross a border between tokens would also be made among those two alone. So where
  two encoded halves meet, a window of the tokens beside the cut is encoded anew and grown until its outer tokens get on
  with the neighbours outside; those then stay.
* *Matches.* The pattern looks at no more than ``LOOK_AHEAD`` characters behind a match and at none before it. So of the
  left half every match that ends so far before the cut stays, matching goes on behind it, and as soon as a match ends
  where one of the right half begins, the rest of the right half stays.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import pieces

# Characters of a leaf of the tree over a text.
LEAF = 1 << 15
# Characters behind a match that may decide it: 're and 'll are told from ' by two.
LOOK_AHEAD = 2
# Parts of words that a worker remembers, and twice as many words; it forgets all when there are more.
REMEMBERED = 300_000


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ``ids`` of every text (array of int).

    ``ranks`` is a file on every machine with a token in base64 and its rank on each line; ``pattern`` splits a text
    into the matches that are encoded separately. A match that is a token is that token. No special tokens are added or
    recognised. A NULL or empty text has no ids; bytes that are not UTF-8 count as U+FFFD. Very long texts are encoded
    whole, leaf by leaf; a task holds one text and its ids at a time. Rows are encoded one by one, whatever their
    doc_id (NULL and repeated ones too), so ties do not arise; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_encoder(ranks, pattern), "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, ranks: str) -> DataFrame:
    """``doc_id``, ``ids`` and the bytes (``decoded``) that the ids stand for; those of NULL ids are empty.

    An id that is not in the file raises. Other columns are not read; an empty table gives no rows.
    """
    return tokens.select("doc_id", "ids").mapInArrow(_decoder(ranks), "doc_id long, ids array<int>, decoded binary")


def digest(tokens: DataFrame) -> DataFrame:
    """Per document the number of ids, and checksums of the ids, in decimal with spaces between, and of the bytes."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# In tasks


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        lines = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in lines}


_KNOWN: dict[tuple, object] = {}


def _known(kind, *arguments):
    """One per worker and file, for all its tasks."""
    key = (kind.__name__, *arguments)
    if key not in _KNOWN:
        _KNOWN[key] = kind(*arguments)
    return _KNOWN[key]


def _lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.int32), *lists])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _encoder(ranks: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _known(Texts, ranks, pattern)
        for batch in batches:
            for piece in pieces(batch):
                ids = [texts.ids((raw or b"").decode(errors="replace")) for raw in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return encode


def _decoder(ranks: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _known(Vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                lists = some.column("ids").fill_null([])
                ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
                found = [vocabulary.bytes_of(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("ids"), pa.array(found, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    return decode


class Vocabulary:
    def __init__(self, ranks: str):
        self.tokens = {rank: token for token, rank in read_ranks(ranks).items()}

    def bytes_of(self, ids: list[int]) -> bytes:
        """Halves decoded on their own, and concatenated."""
        if len(ids) <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.bytes_of(ids[:half]) + self.bytes_of(ids[half:])


class Pieces:
    """Tokens of bytes, by merges alone."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.windows: dict[tuple[int, int], tuple[int, ...] | None] = {}

    def encode(self, data: bytes) -> tuple[int, ...]:
        """The halves' tokens, joined."""
        half = len(data) >> 1
        if not half:
            return (self.ranks[data],)
        parts, left, right = self.parts, data[:half], data[half:]
        a = parts.get(left)
        if a is None:
            a = self._part(left)
        b = parts.get(right)
        if b is None:
            b = self._part(right)
        if self.windows.get((a[-1], b[0]), 0) is None:
            return a + b
        return self.join(a, b)

    def _part(self, data: bytes) -> tuple[int, ...]:
        found = self.encode(data)
        if len(data) <= 32:
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            self.parts[data] = found
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The tokens of both together, by encoding a growing window beside the cut."""
        window = self._window(left[-1], right[0])
        if window is None:
            return left + right
        i = j = 1
        while True:
            grow_left = i < len(left) and self._window(left[-i - 1], window[0]) is not None
            grow_right = j < len(right) and self._window(window[-1], right[j]) is not None
            if not grow_left and not grow_right:
                return left[: len(left) - i] + window + right[j:]
            i = min(2 * i, len(left)) if grow_left else i
            j = min(2 * j, len(right)) if grow_right else j
            window = self.merged(b"".join(map(self.tokens.__getitem__, left[len(left) - i :] + right[:j])))

    def _window(self, a: int, b: int) -> tuple[int, ...] | None:
        """Two neighbours merged on their own; None if they stay as they are."""
        found = self.windows.get((a, b), 0)
        if found == 0:
            if len(self.windows) >= REMEMBERED:
                self.windows.clear()
            found = self.merged(self.tokens[a] + self.tokens[b])
            found = self.windows[a, b] = None if found == (a, b) else found
        return found

    def merged(self, data: bytes) -> tuple[int, ...]:
        """A window's tokens: of all neighbours, those of the lowest rank are merged first, and of these the leftmost."""
        ranks = self.ranks
        if len(data) > 64:
            return self._merged_long(data)
        parts = [data[k : k + 1] for k in range(len(data))]
        found = [ranks.get(data[k : k + 2]) for k in range(len(data) - 1)]
        while True:
            least = min((rank for rank in found if rank is not None), default=None)
            if least is None:
                return tuple(map(ranks.__getitem__, parts))
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merged_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap. A part is data[a : ends[a]]; what is in the heap for parts that are gone is passed over."""
        ranks, n = self.ranks, len(data)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[data[a : a + 2]], a, a + 2) for a in range(n - 1) if data[a : a + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, a, end = heapq.heappop(heap)
            middle = ends[a]
            if not a < middle < end or ends[middle] != end:
                continue
            ends[a], ends[middle] = end, 0
            if end < n:
                before[end] = a
                rank = ranks.get(data[a : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, a, ends[end]))
            left = before[a]
            if left >= 0:
                rank = ranks.get(data[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        out, a = [], 0
        while a < n:
            out.append(ranks[data[a : ends[a]]])
            a = ends[a]
        return tuple(out)


class _Words(dict):
    """Tokens by word; words of up to 64 characters are remembered."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        whole = self.pieces.ranks.get(data)
        found = self.pieces.encode(data) if whole is None else (whole,)
        if len(word) <= 64:
            if len(self) >= 2 * REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Texts:
    """Tokens of texts: a tree over leaves of ``LEAF`` characters."""

    def __init__(self, ranks: str, pattern: str):
        import regex

        self.pieces = Pieces(read_ranks(ranks))
        self.words = _Words(self.pieces)
        self.pattern = regex.compile(pattern)
        self.unknown = None

    def ids(self, text: str) -> np.ndarray:
        shown = self._shown(text)
        if len(text) <= LEAF and shown is text:
            return np.array(list(chain.from_iterable(map(self.words.__getitem__, self.pattern.findall(text)))), np.int32)
        _, tokens = self._node(text, shown, 0, len(text))
        return np.array(list(chain.from_iterable(tokens)), np.int32)

    def _node(self, text: str, shown: str, lo: int, hi: int) -> tuple[list[int], list[tuple[int, ...]]]:
        """Where the matches of a part of the text begin, and their tokens."""
        if hi - lo <= LEAF:
            found = self.pattern.findall(shown, lo, hi)
            starts = list(accumulate(map(len, found), initial=lo))[:-1]
            if shown is not text:
                found = [text[a:b] for a, b in zip(starts, [*starts[1:], hi])]
            return starts, list(map(self.words.__getitem__, found))
        cut = (lo + hi) // 2
        left, right = self._node(text, shown, lo, cut), self._node(text, shown, cut, hi)
        return self._joined(text, shown, cut, hi, *left, *right)

    def _joined(self, text, shown, cut, hi, starts, tokens, right_starts, right_tokens):
        """Both halves' matches, by matching a growing window beside the cut."""
        first = max(0, bisect_right(starts, cut - LOOK_AHEAD) - 1)
        at = begin = starts[first]
        crossing = first if first == len(starts) - 1 else None
        new_starts, new_tokens = [], []
        size = 64
        while True:
            end = min(hi, cut + size)
            for match in self.pattern.finditer(shown, at, end):
                a, b = match.span()
                if b > end - LOOK_AHEAD and end < hi:
                    break
                own = tokens[crossing] if crossing is not None and a == begin and b > cut else None
                new_starts.append(a)
                new_tokens.append(self._crossing(text, a, b, cut, own, right_starts, right_tokens, hi))
                at = b
                k = bisect_left(right_starts, b)
                if b >= cut and (k == len(right_starts) or right_starts[k] == b):
                    if k < len(right_starts) or b == hi:
                        return starts[:first] + new_starts + right_starts[k:], tokens[:first] + new_tokens + right_tokens[k:]
            if end == hi:
                return starts[:first] + new_starts, tokens[:first] + new_tokens
            size *= 2

    def _crossing(self, text, a, b, cut, own, right_starts, right_tokens, hi) -> tuple[int, ...]:
        """The tokens of a match beside the cut; a long one is joined from what the halves have of it."""
        longest = self.pieces.longest
        if own is None or b - a <= 2 * longest or cut - a <= longest:
            return self.words[text[a:b]]
        k = bisect_left(right_starts, b) - 1
        ends_there = k >= 0 and (right_starts[k + 1] if k + 1 < len(right_starts) else hi) == b
        if ends_there and b - right_starts[k] > longest:
            middle, last = text[cut : right_starts[k]], right_tokens[k]
        else:
            middle, last = text[cut:b], ()
        for part in (self.pieces.encode(middle.encode()) if middle else (), last):
            own = self.pieces.join(own, part) if part else own
        return own

    def _shown(self, text: str) -> str:
        """The text as the pattern is to see it.

        The library of the rank files knows the letters of one version of Unicode, the matcher here those of another;
        what only one of them takes for a letter or digit is shown as a character that is neither, one for one.
        """
        if self.unknown is None:
            self.unknown = _letters_unknown()
            self.far = re.compile(f"[{min(self.unknown)}-\U0010ffff]") if self.unknown else re.compile(r"(?!)")
        if text.isascii() or not self.far.search(text) or self.unknown.isdisjoint(text):
            return text
        return text.translate(dict.fromkeys(map(ord, self.unknown), "\u0378"))


def _letters_unknown() -> frozenset[str]:
    """Letters and digits to the matcher here, but not to tiktoken."""
    if "unknown" not in _KNOWN:
        import regex
        import tiktoken

        free = "".join(chr(c) for c in chain(range(0x80, 0xD800), range(0xE000, 0x110000)) if unicodedata.category(chr(c)) == "Cn")
        letters = regex.findall(r"[\p{L}\p{N}]", free)
        seen = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        known = set(seen.decode(seen.encode_ordinary("".join(letters))))
        _KNOWN["unknown"] = frozenset(letters) - known
    return _KNOWN["unknown"]
