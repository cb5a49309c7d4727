"""SentencePiece (BPE) encoding by backtracking, and decoding.

A sequence of pieces is the merge-order encoding of its text exactly when each
piece merges to itself and each two neighbours stay apart when their joint text
is merged anew.  So no merge loop over the whole text is needed: take the
longest match at a position (found in the Aho-Corasick automaton of the
pieces), keep it if the pair with the previous piece is compatible, else try
the next shorter piece that starts there, else step back.
A bitfield marks positions from which no continuation exists; each position is
left at most once.

Pieces never hold a word mark after another character, so no merge crosses the
start of a space-separated word.  Words are therefore encoded one by one and
remembered per Python worker, up to ``CACHE_WORDS``; this changes speed only.

Results: null and empty texts encode to the begin and end ids alone and decode
to the empty text.  Texts of any length are taken whole.  Rows are passed
through one by one, repeated rows and null ids included; the added columns
replace columns of the same name; an empty table gives an empty table.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from stratum.llm.common import text_of

MARK = "▁"
CACHE_WORDS = 600_000
_CODECS: dict[str, "PieceCodec"] = {}


def _one_byte(err):
    """SentencePiece writes one replacement character per undecodable byte."""
    return "�", err.start + 1


codecs.register_error("one_byte", _one_byte)


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model with byte fallback.

    Only models that leave texts as they are (identity normalisation, one space
    put in front) and fall back to bytes are supported; others are refused.
    """

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(size)]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.ids = {p: i for i, p in enumerate(names) if plain[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(names[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        probe = "  ﬁ A\tb  \n"
        if len(self.byte_ids) != 256 or sp.decode(sp.encode(probe)) != probe:
            raise ValueError("need a BPE model with byte fallback and identity normalisation")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that span words are not supported")
        # what each id adds to the text: control ids nothing, byte ids their byte
        self.out = [b"" if sp.is_control(i) else bytes([int(names[i][1:-1], 16)]) if sp.is_byte(i)
                    else b" \xe2\x81\x87 " if sp.is_unknown(i) else names[i].replace(MARK, " ").encode()
                    for i in range(size)]
        self.control = {i for i in range(size) if sp.is_control(i)}
        self.spaced = {i for i in range(size) if plain[i] and names[i].startswith(MARK)}
        self.apart: dict[tuple[str, str], bool] = {}
        self.traces: dict[tuple[str, bool], list[tuple[float, str]]] = {}
        self.words: dict[str, bytes] = {}
        whole = [p for p in self.ids if self.merge(p) == [p]]  # pieces that merging can't reach never appear
        self.longest = max(map(len, whole))
        self.starts = ahocorasick.Automaton()
        for p in whole:
            self.starts.add_word(p, p)
        self.starts.make_automaton()
        self.choices = {p[:k]: () for p in whole for k in range(1, len(p) + 1)}
        for node in sorted(self.choices, key=len):
            self.choices[node] = (node,) * (node in self.starts) + self.choices.get(node[:-1], ())
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.wire = {p: np.array([i], "<u4").tobytes() for p, i in self.ids.items()}

    def merge(self, text: str) -> list[str]:
        """Merge adjacent symbols, best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (score.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[best] + parts[best + 1] not in score:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def trace(self, piece: str, right: bool) -> list[tuple[float, str]]:
        """The states of a piece while it merges: best score next, symbol at the edge."""
        key = (piece, right)
        if key not in self.traces:
            parts, states, score = list(piece), [], self.score
            while len(parts) > 1:
                best = max(range(len(parts) - 1), key=lambda i: (score.get(parts[i] + parts[i + 1], -np.inf), -i))
                states.append((score[parts[best] + parts[best + 1]], parts[-1 if right else 0]))
                parts[best:best + 2] = [parts[best] + parts[best + 1]]
            self.traces[key] = [*states, (-np.inf, piece)]
        return self.traces[key]

    def compatible(self, left: str, right: str) -> bool:
        """Whether re-merging the two side by side leaves the border in place."""
        key = (left, right)
        ok = self.apart.get(key)
        if ok is None:
            if len(self.apart) > 2 * CACHE_WORDS:
                self.apart.clear()
            ok = self.apart[key] = self._stay_apart(self.trace(left, True), self.trace(right, False))
        return ok

    def _stay_apart(self, lefts: list, rights: list) -> bool:
        i = j = 0
        while True:
            (a, x), (b, y) = lefts[i], rights[j]
            across = self.score.get(x + y)
            if across is not None and across > a and across >= b:  # of equals the leftmost merges first
                return False
            if a == b == -np.inf:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def starting(self, text: str, pos: int) -> tuple[str, ...]:
        """The pieces that start at ``pos``, longest first, and the bare character."""
        ahead = text[pos:pos + self.longest]
        found = self.choices.get(ahead[:self.starts.longest_prefix(ahead)], ())
        return found if found and len(found[-1]) == 1 else (*found, ahead[0])

    def pieces(self, text: str) -> list[str]:
        """The merge-order pieces of a marked text, by backtracking."""
        n, pos, failed = len(text), 0, 0
        taken: list[str] = []
        open_at = [iter(self.starting(text, 0))] if text else []
        while pos < n:
            for piece in open_at[-1]:
                end = pos + len(piece)
                if not (failed and failed >> end & 1) and (not taken or self.compatible(taken[-1], piece)):
                    taken.append(piece)
                    pos = end
                    if pos < n:
                        open_at.append(iter(self.starting(text, pos)))
                    break
            else:
                failed |= 1 << pos
                open_at.pop()
                pos -= len(taken.pop())
        return taken

    def word_ids(self, word: str) -> bytes:
        return b"".join([self.wire.get(p) or self._bytes(p) for p in self.pieces(word)])

    def _bytes(self, char: str) -> bytes:
        return np.array([self.byte_ids[b] for b in char.encode()], "<u4").tobytes()

    def _word(self, w: str) -> bytes:
        ids = self.words.get(w)
        if ids is None:
            ids = self.word_ids(MARK + w.replace(" ", MARK))
            if len(w) <= 64:
                self.words[w] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids with begin and end as little-endian unsigned 32-bit integers."""
        ends = [np.array([i], "<u4").tobytes() for i in (self.bos, self.eos)]
        if not text:
            return ends[0] + ends[1]
        # a word starts at the first mark of each run of marks
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            words = _join_runs(words)
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        found = [known.get(w) for w in words]
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    w = words[k]
                    core = w.rstrip(",.;:!?")
                    if core.strip() and core != w and core[-1] + w[len(core)] not in self.inside:
                        # no piece spans this border, so no merge crosses it
                        ids = self._word(core) + self.word_ids(w[len(core):])
                    else:
                        ids = self._word(w)
                    found[k] = ids
        return b"".join([ends[0], *found, ends[1]])

    def decode(self, ids: bytes) -> str:
        row = np.frombuffer(ids, "<u4").tolist()
        first = next((i for i in row if i not in self.control), None)
        out = b"".join([self.out[i] for i in row])
        return (out[1:] if first in self.spaced else out).decode("utf-8", "one_byte")


def _join_runs(words: list[str]) -> list[str]:
    """Put the empty strings of runs of spaces in front of the word they end at."""
    out, run = [], 0
    for k, w in enumerate(words):
        if w or k == len(words) - 1:
            out.append(" " * run + w)
            run = 0
        else:
            run += 1
    return out


def codec(model_file: str) -> PieceCodec:
    """The model's codec, built once per Python worker."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


_ROUND = StructType([StructField("ids", BinaryType()), StructField("decoded", StringType())])


def encode_and_decode(df: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` to ``df``.

    ``model_file`` must exist at that path on every machine.
    """

    @F.pandas_udf(_ROUND)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model_file)
        for texts in batches:
            ids = [c.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [c.decode(x) for x in ids]})

    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("ids", "decoded", "__piece")]
    return df.withColumn("__piece", both(text_of(text))).select(*kept, "__piece.ids", "__piece.decoded")


def decode(df: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` for a binary column of ids; null ids decode to the empty text."""

    @F.pandas_udf(StringType())
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(model_file)
        for rows in batches:
            yield pd.Series([c.decode(x or b"") for x in rows], dtype=object)

    return df.withColumn("decoded", back(F.col(ids)))


def digests(df: DataFrame) -> DataFrame:
    """Per-document digest columns of ``encode_and_decode`` output."""
    return df.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                     F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
