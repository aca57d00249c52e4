"""Language identification by hierarchical discrimination: the family first, then one-versus-one machines inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import Flat, flattened, mixed, pieces
from tripline.llm.sampling import by_label, remainder

# Families of closely related languages. A language not named here is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"],
    "baltic": ["lt", "lv"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tk"],
    "indic": ["hi", "bn", "ur", "pa", "gu", "mr", "ne", "si"],
    "dravidian": ["ta", "te", "kn", "ml"],
    "semitic": ["ar", "he", "am", "mt"],
    "sinitic": ["zh", "yue"],
}

# Runs of one to three bytes of lower-cased text, in which all ASCII but letters counts as blank.
_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Machines:
    """Linear separators: column k of ``weights`` and ``bias[k]`` are positive for the first side of ``pairs[k]``.

    ``bins`` is the number of bins that runs of bytes are hashed to.
    """

    bins: int
    families: list[str]
    members: list[list[str]]
    pairs: list[tuple[int, int, int]]
    weights: np.ndarray
    bias: np.ndarray


def identify(docs: DataFrame, machines: Machines, min_share: float = 0.0) -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score``, ``accepted``.

    ``lang_pred`` is the language that wins most of its one-versus-one decisions inside the family that wins most of
    its own (ties: larger margins); ``und`` if the text is NULL or has no letter, or nothing was learned. ``score`` is
    0 for ``und``, else the product of how clearly family and language won, each from 0.5 at the border to 1.
    ``accepted`` is false for ``und`` and for scores under ``min_share``. Only the text is read; rows are judged one by
    one, whatever their doc_id; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.lower("text").alias("text"),
    )
    named = rows.mapInArrow(_identified(machines), "doc_id long, lang_pred string, score double")
    return named.withColumn("accepted", (F.col("lang_pred") != "und") & (F.col("score") >= min_share))


def learn(docs: DataFrame, sample: int = 1200, bins: int = 8192) -> Machines:
    """Machines from about ``sample`` rows in all, evenly by ``lang``; the rest of the table is not looked at.

    Rows without lang, or without a letter, teach nothing. Languages are as many as ``lang`` has values. Runs of bytes
    are hashed to ``bins`` bins, a power of two. The rows are kept sparse: what the driver holds grows with the sample
    and the length of its texts, of which each bin that they have counts once, not with the bins.
    """
    if bins < 2 or bins & (bins - 1):
        raise ValueError(f"bins must be a power of two, not {bins}")
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.lower("text").alias("text"))
    rows = rows.where(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")
    n = max(1, docs.select("lang").where("lang IS NOT NULL").distinct().count())
    chosen = by_label(rows, "lang", max(40, sample // n)).select("lang", "text")
    # The sample's histograms, sparse, are what comes to the driver: some kilobytes a row.
    found = chosen.mapInArrow(_histograms(bins), "lang string, bins binary, shares binary").collect()
    langs = sorted({row.lang for row in found})
    x = _Sparse([(np.frombuffer(row.bins, np.int32), np.frombuffer(row.shares, np.float32)) for row in found], bins)
    y = np.array([langs.index(row.lang) for row in found], np.int64)
    return _machines(x, y, langs)


class _Sparse:
    """Rows of a matrix, each as the columns and values that are not zero."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.rows, self.width = rows, width

    def __len__(self) -> int:
        return len(self.rows)

    def deviations(self) -> np.ndarray:
        """The standard deviation of each column."""
        columns = np.concatenate([at for at, _ in self.rows])
        values = np.concatenate([own for _, own in self.rows]).astype(np.float64)
        mean, square = (np.bincount(columns, x, minlength=self.width) / len(self) for x in (values, values * values))
        return np.sqrt(np.maximum(square - mean * mean, 0))

    def scaled(self, by: np.ndarray) -> _Sparse:
        return _Sparse([(at, own * by[at]) for at, own in self.rows], self.width)


def _machines(x: _Sparse, y: np.ndarray, langs: list[str]) -> Machines:
    family = {lang: name for name, members in FAMILIES.items() for lang in members}
    of = [family.get(lang, lang) for lang in langs]
    families = sorted(set(of))
    members = [[lang for lang, own in zip(langs, of) if own == name] for name in families]
    if not len(x):
        return Machines(x.width, [], [], [], np.zeros((x.width, 0)), np.zeros(0))
    factor = (1 / (x.deviations() + 1e-4)).astype(np.float32)
    factor /= np.float32(max(1e-6, float(np.median([np.sqrt(own @ own) for _, own in x.scaled(factor).rows]))))
    z = x.scaled(factor)
    group = np.array([families.index(of[k]) for k in y], np.int64)
    pairs, weights, bias = [], [], []
    jobs = [(-1, a, b, group) for a, b in combinations(range(len(families)), 2)]
    for k, own in enumerate(members):
        inside = np.array([own.index(langs[v]) if langs[v] in own else -1 for v in y], np.int64)
        jobs += [(k, a, b, inside) for a, b in combinations(range(len(own)), 2)]
    for where, a, b, label in jobs:
        some = np.flatnonzero((label == a) | (label == b))
        w, c = _separator([z.rows[k] for k in some], np.where(label[some] == a, 1.0, -1.0), x.width)
        pairs.append((where, a, b))
        weights.append(w * factor)
        bias.append(c)
    out = np.array(weights, np.float64).T if weights else np.zeros((x.width, 0))
    return Machines(x.width, families, members, pairs, np.ascontiguousarray(out), np.array(bias, np.float64))


def _separator(rows: list, y: np.ndarray, width: int, cost: float = 10.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """A linear support vector machine by dual coordinate descent; both sides weigh the same."""
    random = np.random.default_rng(7)
    w, c = np.zeros(width), 0.0
    norms = np.array([float(own @ own) for _, own in rows]) + 1.0
    limit = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    alpha = np.zeros(len(y))
    for _ in range(rounds):
        for k in random.permutation(len(y)):
            at, own = rows[k]
            slope = y[k] * (float(own @ w[at]) + c) - 1
            new = min(max(alpha[k] - slope / norms[k], 0.0), limit[k])
            if new != alpha[k]:
                step = (new - alpha[k]) * y[k]
                w[at] += step * own  # a row has each column once
                c += step
                alpha[k] = new
    return w, c


def held_out(docs: DataFrame, divisor: int = 4, left: int = 2) -> DataFrame:
    """``doc_id`` and whether the row is kept from learning."""
    return docs.withColumn("held_out", remainder(F.col("doc_id"), divisor) == left)


# In tasks


def _counted(flat: Flat, bins: int) -> np.ndarray:
    """The share of each bin in each text's runs of one, two and three bytes; zeros for an empty text."""
    n = len(flat)
    data = _PLAIN[flat.data].astype(np.uint64)
    base, shift = np.repeat(np.arange(n) * bins, flat.lengths), np.uint64(65 - bins.bit_length())
    counts = np.zeros(n * bins, np.float32)
    gram = np.zeros(len(data), np.uint64)
    for size in (1, 2, 3):
        shifted = np.zeros(len(data), np.uint64)
        if len(data) >= size:
            shifted[: len(data) - size + 1] = data[size - 1 :]
        gram = gram << np.uint64(8) | shifted
        places = base + (mixed(gram + np.uint64(size << 32)) >> shift).astype(np.int64)
        inside = np.ones(len(data), dtype=bool)
        for back in range(1, size):  # runs that would leave their text
            inside[flat.offsets[1:][flat.lengths >= back] - back] = False
        counts += np.bincount(places[inside], minlength=n * bins)
    counts = counts.reshape(n, bins)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def _histograms(bins: int):
    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, size=1 << 20):
                for part in range(0, piece.num_rows, 512):
                    some = piece.slice(part, 512)
                    shares = _counted(flattened(some.column("text")), bins)
                    found = [np.flatnonzero(row) for row in shares]
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("lang"),
                            pa.array([k.astype(np.int32).tobytes() for k in found], pa.binary()),
                            pa.array([row[k].astype(np.float32).tobytes() for row, k in zip(shares, found)], pa.binary()),
                        ],
                        ["lang", "bins", "shares"],
                    )

    return histograms


def _identified(machines: Machines):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, size=1 << 20):
                for part in range(0, piece.num_rows, 512):
                    some = piece.slice(part, 512)
                    langs, scores = _decided(_counted(flattened(some.column("text")), machines.bins), machines)
                    letters = some.column("letters").to_numpy(zero_copy_only=False)
                    langs = [lang if known else "und" for lang, known in zip(langs, letters)]
                    yield pa.RecordBatch.from_arrays(
                        [some.column("doc_id"), pa.array(langs, pa.string()), pa.array(np.where([x != "und" for x in langs], scores, 0.0))],
                        ["doc_id", "lang_pred", "score"],
                    )

    return name


def _decided(shares: np.ndarray, machines: Machines) -> tuple[list[str], np.ndarray]:
    """The language of each text, and how clear it is."""
    if not machines.families:
        return ["und"] * len(shares), np.zeros(len(shares))
    margins = shares.astype(np.float64) @ machines.weights + machines.bias
    family, clear = _winner(margins, machines, -1, len(machines.families))
    langs = np.empty(len(shares), object)
    for k, members in enumerate(machines.members):
        own = np.flatnonzero(family == k)
        best, sure = _winner(margins[own], machines, k, len(members))
        langs[own] = np.array(members, object)[best]
        clear[own] *= sure
    return langs.tolist(), clear.round(6)


def _winner(margins: np.ndarray, machines: Machines, where: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Who wins most of the decisions between n, and how clearly it wins the closest of them."""
    votes, least = np.zeros((len(margins), n)), np.full((len(margins), n), np.inf)
    for k, (place, a, b) in enumerate(machines.pairs):
        if place == where:
            sure = margins[:, k]
            votes[:, a] += sure > 0
            votes[:, b] += sure <= 0
            votes[:, a] += 1e-3 * np.tanh(sure)
            votes[:, b] -= 1e-3 * np.tanh(sure)
            least[:, a] = np.minimum(least[:, a], sure)
            least[:, b] = np.minimum(least[:, b], -sure)
    best = votes.argmax(axis=1)
    closest = np.maximum(least[np.arange(len(margins)), best], 0)
    return best, 1 / (1 + np.exp(-3 * np.minimum(closest, 50)))
