"""Toxicity by a factorization machine over hashed terms.

Besides a weight, each term has a short vector; the product of the vectors of two terms is the weight of having both.
So the machine learns pairs, such as an insult with the mention of a group, that terms alone do not tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.flat import ALPHANUMERIC, flattened, pieces, words_of
from tripline.llm.sampling import by_label, remainder, with_draw

# Bins that terms are hashed to, and the length of a term's vector.
BINS_BITS = 20
FACTORS = 6


@dataclass
class Machine:
    """``bins`` in rising order are the terms; a text's score is logistic in their weights and pairs."""

    bins: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts; text ``rows[k]`` has term ``terms[k]``, each once."""
        total = np.full(n, self.bias)
        np.add.at(total, rows, self.weights[terms])
        sums = np.zeros((n, self.factors.shape[1]))
        np.add.at(sums, rows, self.factors[terms])
        squares = np.zeros(n)
        np.add.at(squares, rows, (self.factors[terms] ** 2).sum(axis=1))
        total += 0.5 * ((sums**2).sum(axis=1) - squares)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` from 0 to 1, ``predicted`` (1 from 0.5 on).

    A term counts once a text, whatever its length. NULL and empty texts have no terms and get the score of that.
    Only the text is read; rows are judged one by one, whatever their doc_id; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(_scored(machine), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learn(
    docs: DataFrame, labels: DataFrame, toxic: int = 2500, clean: int = 5000, left: int = 0, least: int = 3, by_chance: int = 200
) -> Machine:
    """A machine from about ``toxic`` and ``clean`` rows of labelled documents; others are not looked at.

    Terms that fewer than ``least`` texts of the sample have are left out, as nothing can be learned of them.
    ``by_chance`` is how many of all terms may be kept without a cause: fewer make the penalty on weights stricter.

    Labels of documents whose crc32 of doc_id, modulo 5, is ``left`` are not used. Labels that are not 0 or 1, or that
    contradict each other, teach nothing. Without labels of both kinds all scores are the share of toxic ones.
    """
    known = labels.where("doc_id IS NOT NULL").where(remainder(F.col("doc_id"), 5) != left)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("a"), F.max("toxic").alias("toxic"))
    known = known.where("a = toxic AND toxic IN (0, 1)").drop("a")
    texts = with_draw(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).join(known, "doc_id")
    # The sample's terms are what comes to the driver: four bytes for each distinct one of a row.
    texts = by_label(texts, "toxic", {1: toxic, 0: clean})
    found = texts.select("toxic", "text").mapInArrow(_termed, "toxic int, bins binary").collect()
    lists, toxic_ones = [np.frombuffer(row.bins, np.int32) for row in found], np.array([row.toxic for row in found], np.float64)
    return _fitted(lists, toxic_ones, least, by_chance)


def _fitted(lists: list[np.ndarray], y: np.ndarray, least: int = 3, by_chance: int = 200, block: int = 256) -> Machine:
    """A machine over all terms that ``least`` texts have.

    First weights alone, then weights and factors are fitted together, both with a penalty: a term's weight or vector
    leaves zero only if its slope is more than chance makes it, so that of all terms about ``by_chance`` at most do
    without a cause. A term's slope in its factors depends on its partners, not on its own difference between the
    classes. What is not zero then is fitted again without the penalty.
    """
    share = float(y.mean()) if len(y) else 0.0
    none = Machine(np.empty(0, np.int64), float(np.log((share + 1e-4) / (1 - share + 1e-4))), np.empty(0), np.empty((0, FACTORS)))
    if not 0 < share < 1:
        return none
    bins = np.flatnonzero(np.bincount(np.concatenate(lists), minlength=1 << BINS_BITS) >= least)
    if not len(bins):
        return none
    chance = np.sqrt(2 * np.log(max(1.0, len(bins) / by_chance)))
    rows = _blocks(lists, y, bins, block)
    params = np.zeros((len(bins), 1 + FACTORS))
    bias, params = _descended(rows, none.bias, params, 60, 0.02, chance, factors=False)
    # Vectors begin along the weights: the slope of any other term then is its tie with what is known to tell.
    random = np.random.default_rng(11)
    mixture = np.column_stack([np.ones(len(bins)), random.normal(0, 1, (len(bins), FACTORS - 1))])
    params[:, 1:] = 0.3 * params[:, :1] * mixture + random.normal(0, 0.02, (len(bins), FACTORS))
    bias, params = _descended(rows, bias, params, 80, 0.02, chance)
    some = (params != 0).any(axis=1)
    if not some.any():
        return none
    bins, params = bins[some], params[some]
    bias, params = _descended(_blocks(lists, y, bins, block), bias, params, 150, 0.1, 0.0)
    return Machine(bins, bias, params[:, 0].copy(), params[:, 1:].copy())


#: Of some texts: labels, the places of their terms in rising order, and the text and term of each entry.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _blocks(lists: list[np.ndarray], y: np.ndarray, bins: np.ndarray, block: int) -> list[Rows]:
    """The texts, short ones first, as sparse rows over the bins."""
    place = np.full(1 << BINS_BITS, -1, np.int32)
    place[bins] = np.arange(len(bins))
    order = np.argsort([len(x) for x in lists], kind="stable")
    out = []
    for at in range(0, len(order), block):
        ids = order[at : at + block]
        own = [place[lists[k]] for k in ids]
        own = [x[x >= 0] for x in own]
        terms, inverse = np.unique(np.concatenate(own), return_inverse=True)
        out.append((y[ids], terms, np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in own]), inverse.astype(np.int32)))
    return out


def _descended(
    rows: list[Rows], bias: float, params: np.ndarray, rounds: int, rate: float, chance: float, factors: bool = True
) -> tuple[float, np.ndarray]:
    """Adam over all texts, a block at a time; a penalty of ``chance`` standard errors of a slope is taken after each step.

    Column 0 of ``params`` has the weights, which are penalized one by one, the others a term's vector, as a whole.
    """
    n = sum(len(y) for y, *_ in rows)
    share = sum(float(y.sum()) for y, *_ in rows) / n
    error_variance = share * (1 - share)
    mean, square, biases = np.zeros_like(params), np.zeros_like(params), np.zeros(2)
    for step in range(1, rounds + 1):
        slope, noise, slope_bias = 1e-5 * params, np.zeros((len(params), 2)), 0.0
        for y, terms, row, term in rows:
            x = np.zeros((len(y), len(terms)), np.float32)
            x[row, term] = 1
            w, v = params[terms, 0].astype(np.float32), params[terms, 1:].astype(np.float32)
            sums = x @ v
            total = bias + x @ w + 0.5 * ((sums**2).sum(axis=1) - x @ (v**2).sum(axis=1))
            error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - y
            energy = (sums**2).sum(axis=1)
            back = x.T @ np.column_stack([error, error[:, None] * sums, np.ones(len(y)), energy]).astype(np.float32)
            slope[terms, 0] += back[:, 0] / n
            slope[terms, 1:] += (back[:, 1:-2] - v * back[:, :1]) / n
            noise[terms] += back[:, -2:]
            slope_bias += float(error.sum()) / n
        if not factors:
            slope[:, 1:] = 0
        first, second = 1 - 0.9**step, 1 - 0.99**step
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope**2 - square)
        biases += [0.1 * (slope_bias - biases[0]), 0.01 * (slope_bias**2 - biases[1])]
        bias -= rate * (biases[0] / first) / (np.sqrt(biases[1] / second) + 1e-8)
        if not chance:
            params = params - rate * (mean / first) / (np.sqrt(square / second) + 1e-8)
            continue
        limit = rate * chance * np.sqrt(noise * error_variance) / n
        size = np.sqrt(square[:, 0] / second) + 1e-8
        w = params[:, 0] - rate * (mean[:, 0] / first) / size
        w = np.sign(w) * np.maximum(np.abs(w) - limit[:, 0] / size, 0)
        size = np.sqrt(square[:, 1:].mean(axis=1) / second) + 1e-8
        v = params[:, 1:] - rate * (mean[:, 1:] / first) / size[:, None]
        if factors:
            v *= np.maximum(1 - limit[:, 1] / size / (np.sqrt((v**2).sum(axis=1)) + 1e-12), 0)[:, None]
        params = np.column_stack([w, v])
    return float(bias), params


# In tasks


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text and the bin of each word."""
    words = words_of(flattened(texts).lowered, ALPHANUMERIC)
    return words.text, (words.names >> np.uint64(64 - BINS_BITS)).astype(np.int64)


def _termed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            text, bins = _terms(piece.column("text"))
            both = np.unique(text << BINS_BITS | bins)
            text, bins = both >> BINS_BITS, both & ((1 << BINS_BITS) - 1)
            cuts = np.searchsorted(text, np.arange(piece.num_rows + 1))
            lists = [bins[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(lists, pa.binary())], ["toxic", "bins"])


def _scored(machine: Machine):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BINS_BITS, -1, np.int32)
        place[machine.bins] = np.arange(len(machine.bins))
        for batch in batches:
            for piece in pieces(batch):
                text, bins = _terms(piece.column("text"))
                terms = place[bins]
                own = terms >= 0
                both = np.unique(text[own] * max(1, len(machine.bins)) + terms[own])
                scores = machine.scores(both // max(1, len(machine.bins)), both % max(1, len(machine.bins)), piece.num_rows)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return score
