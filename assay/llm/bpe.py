"""Byte-level BPE, encoding and decoding, by a pair occurrence index per batch of a partition.

The vocabulary file (path is a parameter) is read where it is used; nothing of it is stored
here.  A text is cut at special tokens, the rest into pieces by the byte-level pattern, and
pieces into bytes.  All pieces not seen before in the partition are laid out in one array of
token ids with links to the left and right neighbour.  The index maps each mergeable pair to
all its positions.  Ranks that occur are taken in ascending order: every occurrence of the
pair is merged, left to right, and only the lists of the pairs beside it change.  A merge
makes a token that was learned later than the pair, so each rank is taken once.

Memory per task: the index of one batch of pieces (``BATCH_PIECES``), and a table of encoded
pieces that starts anew, between rounds of texts, beyond ``CACHE_PIECES``.

Defined results: a null text is empty; an empty text has no tokens; rows are encoded each on
its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BATCH_PIECES = 60_000       # pieces of one index
CACHE_PIECES = 400_000      # pieces (and characters) after which the table starts anew
CACHE_CHARS = 1 << 24
TEXT_ROWS = 1024            # texts per round
SHIFT, MASK = 20, (1 << 20) - 1     # two token ids in one number


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte, as character -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, to_byte = spec["model"], byte_alphabet()
        ids = model["vocab"]
        self.token_bytes = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()}
        self.byte_id = [0] * 256
        for c, b in to_byte.items():
            self.byte_id[b] = ids[c]
        self.ranks: dict[int, int] = {}     # pair, as one number, to rank
        self.merged: list[int] = []         # rank to the new token
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[left] << SHIFT | ids[right]] = rank
            self.merged.append(ids[left + right])
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.fromiter(self.ranks.values(), np.int64, len(keys))[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        marks = sorted(self.special, key=len, reverse=True)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.pieces = regex.compile(PATTERN)

    def _add(self, index: dict[int, list[np.ndarray]], active: list, keys: np.ndarray, at: np.ndarray) -> None:
        """Puts the positions of mergeable pairs into the index; pairs that are new there become active."""
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = np.flatnonzero(self.pair_keys[place] == keys)
        if not len(known):
            return
        known = known[np.argsort(place[known], kind="stable")]
        place, at = place[known], at[known]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        starts, ends = first.tolist(), [*first[1:].tolist(), len(place)]
        some = place[first]
        for key, rank, x, y in zip(self.pair_keys[some].tolist(), self.pair_ranks[some].tolist(), starts, ends, strict=True):
            if key in index:
                index[key].append(at[x:y])
            else:
                index[key] = [at[x:y]]
                heapq.heappush(active, (rank, key))

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of each piece, all merged together through one pair occurrence index."""
        raw = [p.encode("utf-8") for p in pieces]
        ends = np.cumsum([len(r) for r in raw])
        flat = np.array(self.byte_id, np.int64)[np.frombuffer(b"".join(raw), np.uint8)]
        if len(self.pair_keys) and len(flat) > 1:
            flat = self._merge(flat, ends - 1)
        alive = flat >= 0
        ids = flat[alive].tolist()
        stops = np.cumsum(alive)[ends - 1].tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *stops], stops)]

    def _merge(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Applies the active ranks in ascending order; a token merged into its left neighbour becomes -1.

        ``left`` and ``right`` link each token to its neighbours in the piece.  The
        index maps a pair to all its positions; a position that an earlier merge has
        used is found out when its pair's turn comes.
        """
        n = len(ids)
        left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
        right[last] = -1
        left[last[:-1] + 1] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[tuple[int, int]] = []
        at = np.flatnonzero(right >= 0)
        self._add(index, active, ids[at] << SHIFT | ids[at + 1], at)
        while active:
            rank, key = heapq.heappop(active)
            a, b, new = key >> SHIFT, key & MASK, self.merged[rank]
            at = np.unique(np.concatenate(index.pop(key)))
            beside = right[at]
            here = (ids[at] == a) & (beside >= 0) & (ids[beside] == b)
            at, beside = at[here], beside[here]
            if a == b and len(at) > 1:  # in a run of one token every second place is taken, from the left
                start = np.r_[True, at[1:] != beside[:-1]]
                nth = np.arange(len(at))
                odd = (nth - np.maximum.accumulate(np.where(start, nth, 0))) % 2 == 1
                at, beside = at[~odd], beside[~odd]
            ids[at], ids[beside] = new, -1
            after, before = right[beside], left[at]
            right[at] = after
            more = after >= 0
            left[after[more]] = at[more]
            less = before[before >= 0]
            self._add(index, active, np.concatenate([new << SHIFT | ids[after[more]], ids[less] << SHIFT | new]),
                      np.concatenate([at[more], less]))
        return ids

    def split(self, text: str) -> list[str]:
        """Pieces of a text; special tokens are pieces of their own."""
        if self.splitter is None or not any(m in text for m in self.special):
            return self.pieces.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.splitter.split(text)):
            out.extend([part] if i % 2 else self.pieces.findall(part))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts of one partition, with the table of pieces already encoded."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._clear()

    def _clear(self) -> None:
        """Numbers of the pieces met (given out as they come), and the tokens of each number."""
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.tokens: list[tuple[int, ...]] = []
        self.size = 0
        for text, i in self.vocab.special.items():
            self.number[text]
            self.tokens.append((i,))

    def encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.tokens) > CACHE_PIECES or self.size > CACHE_CHARS:
            self._clear()
        numbers = [list(map(self.number.__getitem__, self.vocab.split(t))) for t in texts]
        fresh = list(islice(self.number, len(self.tokens), None))
        self.size += sum(map(len, fresh))
        for i in range(0, len(fresh), BATCH_PIECES):
            self.tokens += self.vocab.encode_pieces(fresh[i:i + BATCH_PIECES])
        return [list(chain.from_iterable(map(self.tokens.__getitem__, x))) for x in numbers]


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder, name = Encoder(vocab), [str(i) for i in range(max(vocab.token_bytes) + 1)]
        for batch in batches:
            for start in range(0, batch.num_rows, TEXT_ROWS):
                part = batch.slice(start, TEXT_ROWS)
                tokens = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([hashlib.sha256(",".join([name[i] for i in t]).encode()).hexdigest() for t in tokens]),
                    pa.array([hashlib.sha256(vocab.decode(t).encode()).hexdigest() for t in tokens])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``token_ids`` (array<int>) added; a column of that name is replaced."""
    @F.pandas_udf("array<int>")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary(path))
        for part in parts:
            texts = [t or "" for t in part]
            yield pd.Series([x for i in range(0, len(texts), TEXT_ROWS)
                             for x in encoder.encode(texts[i:i + TEXT_ROWS])], dtype=object)

    return docs.withColumn("token_ids", tokens("text"))


def decode_tokens(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``decoded`` (string) added, from ``token_ids``; null ids give null."""
    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path)
        for part in parts:
            yield pd.Series([None if x is None else vocab.decode([int(i) for i in x]) for x in part], dtype=object)

    return tokens.withColumn("decoded", texts("token_ids"))
