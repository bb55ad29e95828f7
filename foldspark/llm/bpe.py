"""Byte-pair encoding and decoding with a contiguous array of ranks per word.

A word is a list of part boundaries beside the list of ranks of adjacent parts.
The smallest rank is searched, the boundary behind it deleted, and the ranks of
the two neighbours refreshed, until no pair has a rank. Words are short, so
scanning the array beats any other structure; a word longer than ``SCAN`` bytes
takes a heap of pairs with links instead, which merges in the same order.

Decoding gathers the tokens' bytes; malformed UTF-8 becomes replacement characters.

Defined cases: a null text is empty and has no ids; repeated rows and null ids
are rows like any other; an empty table gives no rows; other columns of the input
are not read.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldspark.llm.shared import in_groups, whole
from foldspark.llm.tokens import BYTE_LEVEL_SPLIT, PieceEncoder, spelled_bytes

SCAN = 256
_NO_RANK = 1 << 60


class RankMerger:
    """Ids of byte words by merge ranks.

    ``ranks`` holds the rank of each pair of ids and the id of the pair's merge.
    """

    def __init__(self, of_byte: list[int], ranks: dict[tuple[int, int], tuple[int, int]]):
        self.of_byte, self.ranks = of_byte, ranks
        self.merged = {rank: new for rank, new in ranks.values()}
        self.rank = {pair: rank for pair, (rank, _) in ranks.items()}

    def ids(self, word: bytes) -> list[int]:
        """The ids of one word."""
        parts = [self.of_byte[b] for b in word]
        if len(parts) < 2:
            return parts
        return self._scan(parts) if len(parts) <= SCAN else self._queue(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        rank, merged = self.rank.get, self.merged
        near = [rank(pair, _NO_RANK) for pair in zip(parts, parts[1:])]
        while near:
            least = min(near)
            if least == _NO_RANK:
                break
            at = near.index(least)
            parts[at] = merged[least]
            del parts[at + 1], near[at]
            if at:
                near[at - 1] = rank((parts[at - 1], parts[at]), _NO_RANK)
            if at < len(near):
                near[at] = rank((parts[at], parts[at + 1]), _NO_RANK)
        return parts

    def _queue(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or rank((parts[i], parts[j])) != r:
                continue
            parts[i] = self.merged[r]
            gone[j] = 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := rank((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (x, i))
            k = before[i]
            if k >= 0 and (x := rank((parts[k], parts[i]))) is not None:
                heapq.heappush(heap, (x, k))
        return [p for i, p in enumerate(parts) if not gone[i]]


class Vocabulary:
    """A byte-level vocabulary file: splitting, merging, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        of_letter = {spelled: b for b, spelled in enumerate(spelled_bytes())}
        self.vocab: dict[str, int] = model["vocab"]
        ranks = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            ranks[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.merger = RankMerger([self.vocab[s] for s in spelled_bytes()], ranks)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in self.vocab.items():
            self.bytes[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self._split = regex.compile(BYTE_LEVEL_SPLIT)
        self._parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def encode(self, text: str) -> list[int]:
        """Ids of a text, special tokens included."""
        if self._parts is None:
            return self._plain(text)
        out: list[int] = []
        for part in self._parts.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        for word in self._split.findall(text):
            out += self.merger.ids(word.encode())
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of runs of ids (``offsets`` as by ``PieceEncoder``)."""
        if not hasattr(self, "_lengths"):
            self._lengths = np.array([len(b) for b in self.bytes], np.int64)
            self._table = pa.array(self.bytes, pa.large_binary())
        taken = self._table.take(pa.array(ids))
        data = taken.buffers()[2]
        data = data.to_pybytes() if data is not None else b""
        ends = np.concatenate([[0], np.cumsum(self._lengths[ids])])[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


_made: dict[str, tuple[Vocabulary, PieceEncoder]] = {}


def _of(path: str) -> tuple[Vocabulary, PieceEncoder]:
    if path not in _made:
        vocabulary = Vocabulary(path)
        _made[path] = (
            vocabulary,
            PieceEncoder(lambda pieces: [array("I", vocabulary.encode(p)).tobytes() for p in pieces], entries=400_000),
        )
    return _made[path]


def encode_and_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int), decoded (the text that the ids give)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, encoder = _of(vocabulary)
        for batch in batches:
            for rows in in_groups(batch, "text"):
                ids, offsets = encoder(rows.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), lists, pa.array(words.decode(ids, offsets), pa.string())], names=schema.names
                )

    return docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).mapInArrow(run, schema)
