"""Token ids of documents in ORC files, in the order of doc_id.

ORC stores the integers of a stripe run-length encoded, with row indexes (smallest and largest doc_id of every 10,000
rows) and a Bloom filter on doc_id. Readers take stripes side by side, and skip those that cannot hold a doc_id.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripline.llm.flat import Flat, Words, flattened, pieces

# Bytes of text that one file is made of.
FILE_BYTES = 64 << 20
# Files whose sums, some 30 bytes each, are sent to all readers; with more, ids are shuffled to the sums instead.
BROADCAST_FILES = 2_000_000
# Word encodings a task remembers; it forgets all when there are more.
REMEMBERED = 600_000
# Bytes of text whose distinct words are looked up together.
PIECE = 4 << 20

_SCHEMA = "part int, row long, doc_id long, start long, n_tokens int, ids array<int>"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = 2, bloom: float = 0.01) -> None:
    """Encode every text, append ``end`` to each, and write the ids as ORC files in ascending order of doc_id.

    ``vocabulary`` is a file of the tokenizers library that is on every machine; special tokens are not added. A NULL
    text is empty. A NULL doc_id comes after all others; rows of equal doc_id are ordered by their text. Other columns
    are not read. Each file is one range of doc_ids (``part``, in order); ``row`` counts the rows of a file, and
    ``start`` the ids before a document in its file. An empty table gives an empty folder of files.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ranged = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    encoded = ranged.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    (
        encoded.mapInArrow(_encoder(vocabulary, end), _SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom)
        .option("compression", "zstd").orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``.

    The ids before a file are summed from the counts alone.
    """
    stored = spark.read.schema(_SCHEMA).orc(path)
    sizes = stored.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("size"))
    sizes = sizes.withColumn("thousand", F.floor(F.col("part") / 1000))
    # Running sums inside each thousand of files, and over the thousands: neither orders all files in one task.
    earlier = W.orderBy("thousand").rowsBetween(W.unboundedPreceding, -1)
    thousands = sizes.groupBy("thousand").agg(F.sum("size").alias("own"))
    thousands = thousands.select("thousand", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("passed"))
    inside = W.partitionBy("thousand").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(thousands, "thousand")
    before = before.select("part", (F.col("passed") + F.col("inside")).alias("before"))
    if len(stored.inputFiles()) <= BROADCAST_FILES:
        before = F.broadcast(before)
    return stored.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids"
    )


def digest(tokens: DataFrame) -> DataFrame:
    """The same with the checksum of the ids as little-endian unsigned 32-bit integers."""
    return tokens.mapInArrow(_checked, "doc_id long, start long, n_tokens long, ids_crc32 long")


# In tasks


def _encoder(vocabulary: str, end: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        if vocabulary not in _REMEMBERED:  # by each worker, for all its tasks
            _REMEMBERED.clear()
            _REMEMBERED[vocabulary] = _Remembered(Tokenizer.from_file(vocabulary))
        known = _REMEMBERED[vocabulary]
        row = start = 0
        for batch in batches:
            for piece in pieces(batch, size=PIECE):
                ids, counts = known.encoded(flattened(piece.column("text")), end)
                n = len(counts)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("part"),
                        pa.array(np.arange(row, row + n)),
                        piece.column("doc_id"),
                        pa.array(start + ends - counts),
                        pa.array(counts.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)),
                    ],
                    ["part", "row", "doc_id", "start", "n_tokens", "ids"],
                )
                row, start = row + n, start + int(counts.sum())

    return encode


_REMEMBERED: dict[str, _Remembered] = {}


class _Remembered:
    """Encodes texts word by word, each distinct word once; words are told apart by 64-bit fingerprints.

    The vocabulary's tokenizer drops white space, lower-cases, and never joins letters with the punctuation beside
    them. So the ids of a text are those of its pieces in a row, if it is cut at blanks and between ASCII letters and
    other ASCII characters; never at an apostrophe (it starts endings like 's) and never beside characters beyond ASCII
    (they may compose). Texts that hold one of the special tokens' strings, and all texts of a tokenizer whose file does
    not say so (``_cuts_at_words``), are encoded whole.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self._forget()
        self.special = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
        size = tokenizer.get_vocab_size()
        self.ends = np.array([(tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)])
        self.by_word = _cuts_at_words(tokenizer)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, flat: Flat, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and their number by text."""
        lowered = flat.lowered.data.tobytes()
        whole = np.zeros(len(flat), dtype=bool) if self.by_word else np.ones(len(flat), dtype=bool)
        for string in self.special:
            at = lowered.find(string)
            while at >= 0:
                whole[flat.text_of(np.array([at]))] = True
                at = lowered.find(string, at + 1)
        if not whole.any():
            return self._pieced(flat.lowered, end)
        data = flat.data.tobytes()
        texts = [data[a:b].decode() for a, b in zip(flat.offsets, flat.offsets[1:])]
        rest = np.flatnonzero(~whole)
        lists: list = [None] * len(texts)
        ids, counts = self._pieced(flattened(pa.array([texts[k] for k in rest], pa.string())).lowered, end)
        cut = np.cumsum(counts)
        for k, a, b in zip(rest, np.append(0, cut), cut):
            lists[k] = ids[a:b]
        direct = np.flatnonzero(whole)
        for k, own in zip(direct, self._ids([texts[k] for k in direct])):
            lists[k] = np.array([*own, end], np.int32)
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)

    def _pieced(self, flat: Flat, end: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(flat.data):
            return np.full(len(flat), end, np.int32), np.ones(len(flat), np.int64)
        kind = _KIND[flat.data]
        inside = kind != 0
        cut = (kind[1:] + kind[:-1] == 3) & inside[1:] & inside[:-1]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut
        last[:-1] &= ~inside[1:] | cut
        full = flat.lengths > 0
        first[flat.offsets[:-1][full]] = inside[flat.offsets[:-1][full]]
        last[flat.offsets[1:][full] - 1] = inside[flat.offsets[1:][full] - 1]
        words = Words(flat, np.flatnonzero(first), np.flatnonzero(last) + 1)
        coded = pa.array(words.names).dictionary_encode()
        names, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        if len(self.names) > REMEMBERED:
            self._forget()
        place = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        new = np.flatnonzero(self.names[place] != names)
        if len(new):
            example = np.empty(len(names), np.int64)
            example[which] = np.arange(len(which))
            data, some = flat.data.tobytes(), example[new]
            self._learn(names[new], [data[a:b].decode() for a, b in zip(words.starts[some], words.ends[some])])
            place = np.searchsorted(self.names, names)
        begins, sizes = self.begins[place], self.sizes[place]
        # The end id stands after the last piece of each text.
        n = sizes[which]
        before = np.append(0, np.cumsum(n))
        counts = np.diff(before[words.offsets]) + 1
        out = np.empty(int(counts.sum()), np.int32)
        tails = np.cumsum(counts) - 1
        own = np.ones(len(out), dtype=bool)
        own[tails] = False
        out[tails] = end
        out[own] = self.pool[np.repeat(begins[which] - before[:-1], n) + np.arange(int(n.sum()))]
        return out, counts

    def _forget(self) -> None:
        self.names, self.pool = np.array([2**64 - 1], np.uint64), np.empty(0, np.int32)
        self.begins, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _learn(self, names: np.ndarray, words: list[str]) -> None:
        """Words of letters alone are one unit each to the tokenizer: many are encoded as one text."""
        plain = np.array([word.isalpha() for word in words], dtype=bool)
        sizes = np.zeros(len(words), np.int64)
        pools, order = [], []
        alone = [np.flatnonzero(~plain)]
        whole = np.flatnonzero(plain)
        for k in range(0, len(whole), 5000):
            some = whole[k : k + 5000]
            ids = np.array(self._ids([" ".join([words[w] for w in some])])[0], np.int32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                sizes[some] = np.diff(np.append(0, ends))
                pools.append(ids)
                order.append(some)
            else:
                alone.append(some)
        alone = np.concatenate(alone)
        lists = self._ids([words[w] for w in alone])
        sizes[alone] = [len(x) for x in lists]
        pools.append(np.fromiter(chain.from_iterable(lists), np.int32))
        order = np.concatenate([*order, alone])
        begins = np.empty(len(words), np.int64)
        begins[order] = len(self.pool) + np.append(0, np.cumsum(sizes[order]))[:-1]
        self.pool = np.concatenate([self.pool, *pools])
        every = np.concatenate([self.names, names])
        by = np.argsort(every, kind="stable")
        self.names = every[by]
        self.begins = np.concatenate([self.begins, begins])[by]
        self.sizes = np.concatenate([self.sizes, sizes])[by]


# How a vocabulary file says that white space goes, case is lowered, and letters, digits and other
# characters are split from each other but for the endings 's, 't and the like.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_at_words(tokenizer) -> bool:
    """Whether a text's ids are those of its words in a row, by what the tokenizer's file says of its steps.

    Then no match of the split holds a blank, or an ASCII letter beside another ASCII character that is no apostrophe;
    nothing before the split looks beyond a character and those it composes with; and merges stay inside a match.
    """
    steps = json.loads(tokenizer.to_str())
    normalizer, split, model = steps["normalizer"] or {}, steps["pre_tokenizer"] or {}, steps["model"]
    first = (split.get("pretokenizers") or [{}])[0]
    return (
        normalizer.get("type") == "Sequence"
        and normalizer.get("normalizers") == _NORMALIZER
        and split.get("type") == "Sequence"
        and first == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
        and [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in split["pretokenizers"][1:]] == [("ByteLevel", False, False)]
        and model["type"] == "BPE"
        and model["end_of_word_suffix"] == "</w>"
        and not model["dropout"]
        and all(token["special"] and not token["normalized"] for token in steps["added_tokens"])
    )


# 0: blank, 1: an ASCII letter, 2: other ASCII but the apostrophe, 4: what is never cut at
_KIND = np.full(256, 4, np.uint8)
_KIND[:128] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x27] = 4


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        ids = np.ascontiguousarray(lists.values.to_numpy(), "<u4")
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )
