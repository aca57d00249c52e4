"""Quality rules, lines first: clean a text line by line, then judge it by what it lost."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import SPACED, Flat, Words, flattened, pieces, range_names, words_of


@dataclass(frozen=True)
class Rules:
    """What a line, and then a document, may be.

    A line fails as punctuation if none of its words ends a sentence, unless over half of the code points in its words
    are Thai or Lao, which are written without sentence marks; or if it has more than ``marks`` of the
    characters ``#*$%&|<>!`` per 100 words; as navigation if it has at least two separators (words made of ``|``,
    ``>``, or one of the characters »·•) and ``separators`` per 100 words or more; as boilerplate if it holds one of
    ``phrases``, in any case of ASCII letters. A document is rejected if the failed lines have more than ``loss`` of
    every 100 code points in its words.
    """

    marks: int = 50
    separators: int = 20
    loss: int = 50
    phrases: tuple[str, ...] = (
        "all rights reserved",
        "terms of use",
        "terms of service",
        "privacy policy",
        "cookie policy",
        "use of cookies",
        "uses cookies",
        "enable javascript",
        "click here",
        "sign up for",
        "subscribe to our",
        "back to top",
        "skip to content",
        "share this",
        "powered by",
    )


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document, with the text that is left.

    ``n_words`` (what stands between blanks), ``word_chars`` (code points in them), ``n_symbols`` (``#*$%&|<>``),
    ``n_dup_lines`` (lines with a word, equal to an earlier one), ``n_repeat_words`` (words in windows of three that
    the text has twice or more), ``base_failed`` (under 50 words, or more than half of them repeat), ``lost_chars``
    (code points in words of failed lines), ``n_failed_lines``, ``kept`` and ``cleaned`` (the lines that pass, and
    those without words, as they stood). Lines end at \\n. A NULL text is empty: it has no words, fails the base and
    its cleaned text is empty. Rows are judged one by one, whatever their doc_id; an empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_judged(rules), _OUT)


_LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OUT = (
    f"doc_id long, {', '.join(f'{name} long' for name in _LONGS)}, base_failed boolean, lost_chars long, "
    "n_failed_lines long, kept boolean, cleaned string"
)


# In tasks


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters.encode())] = True
    return out


_SYMBOLS, _MARKS, _BARS = _table("#*$%&|<>"), _table("#*$%&|<>!"), _table("|>")
# What ends a sentence, and what may stand between that and the end of the word.
SENTENCE_ENDS = [".", "!", "?"]
# Beyond ASCII: CJK with its wide and half-wide forms, danda, Urdu and Arabic, Armenian, Greek, Ethiopic, Burmese,
# Khmer, Tibetan and Mongolian.
WIDE_SENTENCE_ENDS = [*"…。！？．｡", *"।॥", *"۔؟", "։", "\u037e", *"።፧፨", "။", *"។៕", *"།༎", *"᠃᠉"]
_CLOSERS = ['"', "'", ")", "]", "”", "’", "»"]
_DOTS = ["»", "·", "•"]


def _ends_with(words: Words, ends: np.ndarray, characters: list[str]) -> np.ndarray:
    """The bytes of the character, one of those given, that each word ends with before ``ends``; else 0."""
    out = np.zeros(len(ends), np.int64)
    data = words.flat.data
    for character in characters:
        code = np.frombuffer(character.encode(), np.uint8)
        same = ends - words.starts >= len(code)
        for k, byte in enumerate(code[::-1]):
            same &= data[np.maximum(ends - 1 - k, 0)] == byte
        out[same] = len(code)
    return out


def _sentence_ends(words: Words) -> np.ndarray:
    """Which words end a sentence."""
    out = np.zeros(len(words), dtype=bool)
    todo, ends = np.arange(len(words)), words.ends.copy()
    while len(todo):
        some = Words(words.flat, words.starts[todo], ends[todo])
        out[todo] = _ends_with(some, ends[todo], SENTENCE_ENDS) > 0
        wide = np.flatnonzero((some.ends > some.starts) & (words.flat.data[np.maximum(some.ends - 1, 0)] >= 0x80))
        out[todo[wide]] = _ends_with(Words(words.flat, some.starts[wide], some.ends[wide]), some.ends[wide], WIDE_SENTENCE_ENDS) > 0
        closing = _ends_with(some, ends[todo], _CLOSERS)
        closing[out[todo]] = 0
        ends[todo] -= closing
        todo = todo[closing > 0]
    return out


def _unmarked(flat: Flat) -> np.ndarray:
    """Which bytes begin a Thai or Lao character: U+0E00 to U+0EFF."""
    out = flat.data == 0xE0
    out[:-1] &= (flat.data[1:] >= 0xB8) & (flat.data[1:] <= 0xBB)
    return out


def _separators(words: Words) -> np.ndarray:
    """Which words are nothing but a separator."""
    bars = np.append(0, np.cumsum(_BARS[words.flat.data]))
    out = bars[words.ends] - bars[words.starts] == words.ends - words.starts
    one = _ends_with(words, words.ends, _DOTS)
    return out | (one > 0) & (one == words.ends - words.starts)


def _repeated(names: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which names their text has twice or more, and which of those are not the first."""
    order = np.lexsort((names, texts))
    same = (names[order][1:] == names[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    again, later = np.zeros(len(names), dtype=bool), np.zeros(len(names), dtype=bool)
    later[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, later


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values, dtype=np.int64))[cuts])


def _lines(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Where lines begin and end; a text without bytes has none here."""
    breaks = np.flatnonzero(flat.data == 0x0A)
    full = flat.lengths > 0
    starts = np.sort(np.concatenate([flat.offsets[:-1][full], breaks + 1]))
    ends = np.sort(np.concatenate([flat.offsets[1:][full], breaks]))
    return starts, ends


def _judged(rules: Rules):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield _piece(piece, rules)

    return judge


def _piece(piece: pa.RecordBatch, rules: Rules) -> pa.RecordBatch:
    flat = flattened(piece.column("text"))
    words = words_of(flat, SPACED)
    points = np.append(0, np.cumsum((flat.data & 0xC0) != 0x80))
    chars = points[words.ends] - points[words.starts]
    n_words = words.counts.astype(np.int64)
    word_chars = _sums(chars, words.offsets)
    n_symbols = _sums(_SYMBOLS[flat.data], flat.offsets)
    windows, at = words.shingles(3)
    again, _ = _repeated(windows, words.text[at])
    edges = np.zeros(len(words) + 3, np.int32)
    np.add.at(edges, at[again], 1)
    np.add.at(edges, at[again] + 3, -1)
    n_repeat = _sums(np.cumsum(edges)[: len(words)] > 0, words.offsets)

    starts, ends = _lines(flat)
    text = np.searchsorted(flat.offsets, starts, side="right") - 1
    # A line that begins at the end of its text is empty, and belongs to the text before.
    text = np.where((starts == ends) & (starts > 0), np.searchsorted(flat.offsets, np.maximum(starts, 1) - 1, side="right") - 1, text)
    first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    n = last - first
    some = np.flatnonzero(n > 0)
    starts_, ends_, text_, n_ = starts[some], ends[some], text[some], n[some]
    cuts = np.append(first[some], len(words))
    _, later = _repeated(range_names(flat, starts_, ends_), text_)
    n_dup = np.bincount(text_[later], minlength=len(flat))

    marks = np.append(0, np.cumsum(_MARKS[flat.data]))
    marks = marks[ends_] - marks[starts_]
    separators = _sums(_separators(words), cuts)
    failed = _sums(_sentence_ends(words), cuts) == 0
    unmarked = np.append(0, np.cumsum(_unmarked(flat)))
    failed &= 2 * (unmarked[ends_] - unmarked[starts_]) <= _sums(chars, cuts)
    failed |= 100 * marks > rules.marks * n_
    failed |= (separators >= 2) & (100 * separators >= rules.separators * n_)
    lowered = flat.lowered.data.tobytes()
    for phrase in rules.phrases:
        code = phrase.encode()
        place = lowered.find(code)
        while place >= 0:
            line = int(np.searchsorted(starts_, place, side="right")) - 1
            if line >= 0 and place + len(code) <= ends_[line]:
                failed[line] = True
            place = lowered.find(code, place + 1)
    lost = np.bincount(text_, weights=_sums(chars, cuts) * failed, minlength=len(flat)).astype(np.int64)
    n_failed = np.bincount(text_[failed], minlength=len(flat))
    base_failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~base_failed & (100 * lost <= rules.loss * word_chars)

    # The lines that stay, each with its \\n.
    gone = np.zeros(len(flat.data) + 1, np.int32)
    upto = np.where(ends_[failed] < flat.offsets[text_[failed] + 1], ends_[failed] + 1, ends_[failed])
    np.add.at(gone, starts_[failed], 1)
    np.add.at(gone, upto, -1)
    stay = np.cumsum(gone[:-1]) == 0
    data = flat.data[stay].tobytes()
    offsets = np.append(0, np.cumsum(stay))[flat.offsets]
    cleaned = [data[a:b] for a, b in zip(offsets, offsets[1:])]
    columns = [n_words, word_chars, n_symbols, n_dup.astype(np.int64), n_repeat]
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc_id"),
            *map(pa.array, columns),
            pa.array(base_failed),
            pa.array(lost),
            pa.array(n_failed.astype(np.int64)),
            pa.array(kept),
            pa.array(cleaned, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", *_LONGS, "base_failed", "lost_chars", "n_failed_lines", "kept", "cleaned"],
    )
