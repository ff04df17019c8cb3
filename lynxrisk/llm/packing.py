"""Packing documents into sequences: bounded-space online best fit.

Each task reads its rows as a stream, turns a text into token ids and places the pieces at once. It keeps a
fixed number of open sequences, counted by their free space, with one bit of an integer for each free space in
use. A piece goes to the open sequence that it fills best (the lowest set bit at or above its length). Without one, it opens a
sequence; if that makes too many, the fullest closes. So nothing is shuffled, a task's memory is one Arrow batch and
the open sequences, and a lost task is run again with the same result from the same rows.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lynxrisk.llm.common import bound_batches, groups_of

# Fixed value: how a byte-level BPE of this kind parts a text before merging (a rank file doesn't say).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The added token of the vocabulary; the tokenizer file has its id, a rank file hasn't.
ADDED = {"<|endoftext|>": 50256}

OPEN = 64
#: A run of white space as long as this goes to the tokenizer file: the pattern's search for its end fails on about a million.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")


class BestFit:
    """Open sequences by free space. ``place`` says where a piece goes: (sequence number, offset)."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.by_free: dict[int, list[int]] = {}
        self.free_bits = 0
        self.open = 0
        self.sequences = 0

    def _take(self, free: int) -> int:
        at = self.by_free[free]
        number = at.pop()
        if not at:
            self.free_bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.sequences
            self.sequences += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.free_bits |= 1 << left
            self.open += 1
            if self.open > self.most_open:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
        return number, self.capacity - free


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and a shorter one first where it doesn't come out even."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def encoder(path: str, added: bool = False) -> Callable[[list[str]], Iterator[np.ndarray]]:
    """Token ids of texts by a vocabulary file: a tokenizer (.json), or byte-level BPE ranks (.tiktoken).

    Of one vocabulary both give the same ids; ranks need a third of the time. Special tokens in a text are ordinary text, or
    with ``added`` have their id, as the tokenizer file gives by itself. Texts with a very long run of white space are encoded by the tokenizer of the same name beside the ranks.
    """
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        by_rank = tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens=ADDED if added else {})
        by_file: list[Callable[[list[str]], Iterator[np.ndarray]]] = []

        def ids(text: str) -> np.ndarray:
            if len(text) >= LONG_SPACE and _LONG_SPACE.search(text):
                if not by_file:
                    by_file.append(encoder(path.removesuffix(".tiktoken") + ".json", added))
                return next(iter(by_file[0]([text])))
            found = by_rank.encode(text, allowed_special="all") if added else by_rank.encode_ordinary(text)
            return np.array(found, dtype="<u4")

        return lambda texts: map(ids, texts)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added
    return lambda texts: (np.array(e.ids, dtype="<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    most_open: int = OPEN,
    end_id: int = 0,
    added: bool = False,
) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids, sequence_id, offset.

    A document is the ids of its text and ``end_id``; a null or empty text is ``end_id`` alone. Only documents of more than
    ``capacity`` tokens are cut. ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers. Sequences are numbered
    by task, and have no gaps from offset 0. Repeated rows and a null doc_id are packed like any other; other columns are not read.
    The vocabulary file (see ``encoder``, also for ``added``) is read on the executors.
    """
    bound_batches(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, added)
        fit = BestFit(capacity, most_open)
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            row = 0
            for texts in groups_of(batch.column("text")):
                out: list[tuple] = []
                for ids in encode([t or "" for t in texts]):
                    tokens = np.append(ids, np.uint32(end_id))
                    for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                        sequence, offset = fit.place(length)
                        out.append((row, piece, start, length, tokens[start : start + length].tobytes(), first + sequence, offset))
                    row += 1
                rows, *columns = zip(*out, strict=True)
                doc_ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                arrays = [doc_ids, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(packed, schema)
