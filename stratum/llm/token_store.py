"""Token ids in blocks of separately compressed documents with a shared dictionary.

Documents are encoded, the end id is appended, and the ids are serialised as
little-endian unsigned integers of 16 bits (32 for a vocabulary over 65,536).  A
zstandard dictionary is trained on the serialised ids of a bounded sample: about
``SAMPLE_DOCS`` documents, of which arrays over ``SAMPLE_BYTES`` give one slice each.
Every document is then compressed by itself with that dictionary.

A store is a folder of two Parquet tables.  ``dictionary`` has one row: its bytes,
their SHA-256 and the id width.  ``blocks`` has up to ``BLOCK_DOCS`` documents or
``BLOCK_BYTES`` per row, in ascending order of the document ids: the dictionary's
hash, part and number of the block, first and last id, the ids of its documents,
their token counts, the offset of each document in the payload, and the payload.
A reader refuses a block whose dictionary hash is not the store's; one document
is read by cutting its bytes out of its block's payload.

Documents are range-partitioned by id before they are encoded: Spark samples the
ids for the ranges, and would encode everything once more for that otherwise.
Only one token total per partition goes to the driver.

Encoding works word by word: white space separates words for this tokenizer, so
each distinct word is encoded once per worker and remembered, up to about
``CACHE_WORDS`` (of more, those of the latest texts); texts with control characters are encoded whole.  Texts stay in
Arrow until their words are numbered; Python sees each distinct word of a slice of
texts once, not its occurrences.

Results: null and empty texts have the end id alone.  Null ids come first.  Rows
with one id follow each other in the order of their texts' hashes.  An empty table
gives an empty store and no rows.  Only id and text are read.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratum.llm.common import text_of, within_share

# Spark runs a task per core already; threads of the library would only contend.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

DICTIONARY_BYTES = 112_640
SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 1 << 16
BLOCK_DOCS = 1_024
BLOCK_BYTES = 1 << 21
LEVEL = 3
CACHE_WORDS = 1_200_000
_WORD_ENCODERS: dict[tuple[str, int], "WordEncoder"] = {}
_ODD = "[\\x00-\\x08\\x0e-\\x1f]"
#: Words of letters encoded as one text.
JOINED = 50
SLICE_ROWS = 2_048
SLICE_BYTES = 8 << 20


class WordEncoder:
    """Encodes texts with a tokenizers file that splits at white space.

    Ids of the words met so far lie in one array; a batch's words are numbered
    by Arrow (white space is the same for Arrow and Python), looked up once
    each, and their ids gathered for all occurrences at a time.
    """

    def __init__(self, file: str, width: int):
        self.tokenizer = Tokenizer.from_file(file)
        self.dtype = np.dtype(f"<u{width}")
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = token.endswith("</w>")
        self.latest: list[str] = []
        self._forget()

    def _forget(self, but: Sequence[str] = ()) -> None:
        """Start anew with the words ``but``; word 0 is the empty one."""
        kept = self._gather(np.fromiter(map(self.known.__getitem__, but), np.int64, len(but))) if len(but) else None
        self.known, self.used, self.count = {"": 0}, 0, 1
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, self.dtype), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        if kept is not None:
            first = self._enter(*kept)
            self.known.update(zip(but, range(first, first + len(but)), strict=True))
            self.known[""] = 0

    def _enter(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Store the ids of new words, one after the other; returns the number of the first."""
        first = self.count
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[first:first + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:first + len(sizes)] = sizes
        self.used += len(ids)
        self.count = first + len(sizes)
        return first

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered words, and how many each has."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(total)], sizes

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), self.dtype, int(sizes.sum())), sizes

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, many to a text: each ends with the one token that closes a word."""
        spans = [words[k:k + JOINED] for k in range(0, len(words), JOINED)]
        ids, sizes = self._encode([" ".join(x) for x in spans])
        closing = np.flatnonzero(self.closes[ids])
        per_text = np.diff(np.searchsorted(closing, np.concatenate([[0], np.cumsum(sizes)])))
        if self.closes[ids[np.cumsum(sizes) - 1]].all() and per_text.tolist() == list(map(len, spans)):
            return ids, np.diff(closing, prepend=-1)
        return self._encode(words)

    def _learn(self, words: list[str]) -> None:
        """Encode unknown words; letters and closing marks are tokens apart, so a word's core is shared.

        Not where normalising makes a combining mark of a letter, as the marks after it join that.
        """
        known, nfc = self.known, unicodedata.normalize
        cores = [w.rstrip(",.;:!?") for w in words]
        letters = [c.isalpha() if c.isascii() else nfc("NFC", c).lower().isalpha() for c in cores]
        tails = [w[len(c):] if x else "" for w, c, x in zip(words, cores, letters, strict=True)]
        cores = [(c.lower() if c.isascii() else c) if x else w for w, c, x in zip(words, cores, letters, strict=True)]
        fresh = {c for c, x in zip(cores, letters, strict=True) if x}.difference(known)
        other = {c for c, x in zip(cores, letters, strict=True) if not x}.union(tails).difference(known, fresh)
        for new, encode in ((list(fresh), self._encode_letters), (list(other), self._encode)):
            for k in range(0, len(new), 10_000):
                some = new[k:k + 10_000]
                first = self._enter(*encode(some))
                known.update(zip(some, range(first, first + len(some)), strict=True))
        known.update((w, known[c]) for w, c, t in zip(words, cores, tails, strict=True) if not t)
        joined = [(w, known[c], known[t]) for w, c, t in zip(words, cores, tails, strict=True) if t]
        if joined:
            names, *pairs = zip(*joined, strict=True)
            ids, sizes = self._gather(np.array(pairs).T.ravel())
            first = self._enter(ids, sizes.reshape(-1, 2).sum(axis=1))
            known.update(zip(names, range(first, first + len(names)), strict=True))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        if self.count > CACHE_WORDS:
            self._forget(self.latest if len(self.latest) < CACHE_WORDS // 2 else ())
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        split = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        words = split.flatten().dictionary_encode()
        self.latest = names = words.dictionary.to_pylist()
        numbers = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(numbers < 0).tolist()
        if new:
            self._learn(unknown := [names[k] for k in new])
            numbers[new] = np.fromiter(map(self.known.__getitem__, unknown), np.int64, len(unknown))
        ids, sizes = self._gather(numbers[words.indices.to_numpy()])
        cuts = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        whole = np.flatnonzero(odd)
        if len(whole):
            ids, sizes = self._encode(texts.take(pa.array(whole)).to_pylist())
            for k, x in zip(whole.tolist(), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                out[k] = x
        return out


def word_encoder(file: str, width: int) -> WordEncoder:
    if (file, width) not in _WORD_ENCODERS:
        _WORD_ENCODERS[file, width] = WordEncoder(file, width)
    return _WORD_ENCODERS[file, width]


def _serial(file: str, end_id: int, width: int):
    """Function from texts (Arrow) to serialised ids with the end id."""
    end = np.array([end_id], f"<u{width}").tobytes()
    return lambda texts: [x.tobytes() + end for x in word_encoder(file, width)(texts)]


def _slices_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from and to, of about ``SLICE_BYTES`` of text and at most ``SLICE_ROWS`` each."""
    sizes = pc.binary_length(texts).to_numpy()
    lo = held = 0
    for k, n in enumerate(sizes.tolist()):
        if k > lo and (held + n > SLICE_BYTES or k - lo >= SLICE_ROWS):
            yield lo, k
            lo, held = k, 0
        held += n
    if len(sizes):
        yield lo, len(sizes)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; with too few of them, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _slices(file: str, end_id: int, width: int):
    @F.pandas_udf("binary")
    def sample(texts: pd.Series) -> pd.Series:
        rows = _serial(file, end_id, width)(pa.array(texts, pa.string()))
        starts = [width * (zlib.crc32(x) % ((len(x) - SAMPLE_BYTES) // width)) if len(x) > SAMPLE_BYTES + width else 0 for x in rows]
        return pd.Series([x[a:a + SAMPLE_BYTES] for x, a in zip(rows, starts, strict=True)], dtype=object)

    return sample


def write(docs: DataFrame, path: str, file: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Write the documents' ids as a store at ``path``."""
    spark = docs.sparkSession
    width = 2 if max(Tokenizer.from_file(file).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    docs = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text).alias("text"))
    rows = docs.count()
    share = within_share(F.xxhash64("id", F.lit(9)), min(1.0, SAMPLE_DOCS / max(rows, 1)))
    samples = [bytes(r["x"]) for r in docs.filter(share).select(_slices(file, end_id, width)("text").alias("x")).collect()]
    dictionary = train_dictionary(samples)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), width)], "hash string, bytes binary, width int").coalesce(1).write.parquet(
        f"{path}/dictionary")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        serial = _serial(file, end_id, width)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        schema = pa.schema([("hash", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64()),
                            ("first_id", pa.int64()), ("last_id", pa.int64()), ("ids", pa.list_(pa.int64())),
                            ("counts", pa.list_(pa.int64())), ("offsets", pa.binary()), ("payload", pa.binary())])

        def emit():
            nonlocal number, before
            ids, counts, frames = zip(*held, strict=True)
            offsets = np.cumsum([0, *map(len, frames)]).astype("<u8")
            row = (digest, part, number, before, ids[0], ids[-1], list(ids), list(counts), offsets.tobytes(), b"".join(frames))
            number, before = number + 1, before + sum(counts)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in _slices_of(texts):
                for i, x in zip(ids[lo:hi].to_pylist(), serial(texts[lo:hi]), strict=True):
                    held.append((i, len(x) // width, press.compress(x)))
                    size += len(held[-1][2])
                    if len(held) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                        yield emit()
                        held, size = [], 0
        if held:
            yield emit()

    ordered = docs.withColumn("th", F.xxhash64("text")).repartitionByRange("id", "th").sortWithinPartitions("id", "th")
    ordered.select("id", "text").mapInArrow(block, _BLOCK).write.parquet(f"{path}/blocks")


_BLOCK = ("hash string, part int, number int, before long, first_id long, last_id long, ids array<long>, "
          "counts array<long>, offsets binary, payload binary")


def _load(spark: SparkSession, path: str) -> tuple[DataFrame, str, bytes, int]:
    d = spark.read.parquet(f"{path}/dictionary").first()
    return spark.read.parquet(f"{path}/blocks"), d["hash"], bytes(d["bytes"]), d["width"]


def _reader(digest: str, dictionary: bytes, width: int):
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def one(block, k: int) -> np.ndarray:
        if block.hash != digest:
            raise ValueError("the block was written with another dictionary")
        a, b = np.frombuffer(block.offsets, "<u8", 2, 8 * k).tolist()
        return np.frombuffer(press.decompress(block.payload[a:b]), f"<u{width}")

    return one


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every stored document, from the files."""
    blocks, *stored = _load(spark, path)
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("t")).collect()
    starts, start = {}, 0
    for part, t in sorted((r["part"], r["t"]) for r in totals):
        starts[part], start = start, start + t

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = _reader(*stored)
        for batch in batches:
            for b in batch.itertuples():
                sums = [zlib.crc32(one(b, k).astype("<u4").tobytes()) for k in range(len(b.counts))]
                counts = np.asarray(b.counts, np.int64)
                ids = pd.array([None if i is None or i != i else int(i) for i in b.ids], dtype="Int64")
                yield pd.DataFrame({"doc_id": ids, "start": starts[b.part] + b.before + np.cumsum(counts) - counts,
                                    "n_tokens": counts, "ids_crc32": np.array(sums, np.int64)})

    return blocks.mapInPandas(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``(doc_id, ids)`` of some documents; only their own bytes are decompressed."""
    blocks, *stored = _load(spark, path)
    wanted = {int(i) for i in doc_ids}
    near = F.lit(False)
    for i in wanted:
        near = near | F.lit(i).between(F.coalesce("first_id", F.lit(-(1 << 63))), F.col("last_id"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = _reader(*stored)
        for batch in batches:
            rows = [(int(i), one(b, k).tolist()) for b in batch.itertuples() for k, i in enumerate(b.ids) if i in wanted]
            yield pd.DataFrame(rows, columns=["doc_id", "ids"])

    return blocks.filter(near).mapInPandas(pick, "doc_id long, ids array<long>")
