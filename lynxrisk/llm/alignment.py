"""Alignment of two tokenizers' tokens over the same text, and how often their ids meet in the corpus.

Both tokenizers' tokens of a text are lists of byte offsets where tokens end. The shorter list drives a galloping search into the longer one: steps double
until they pass an end, then the step is halved. Ends that both lists have cut the tokens into groups. The rank of
an end in the other list, less the rank of the end before, is the range of tokens there that a token overlaps: its links. Many texts are
aligned at once, one behind the other, since a text's end is an end in both lists.

For 100 TB:

* Texts are encoded once, in a task's stream of bounded groups. What is kept of a text is one row: counts, the hash of its groups, and its
  different id pairs with their numbers.
* Counts of id pairs are added up in each task before the shuffle. They are sent to the rows if they are few (they are counted first), otherwise
  joined by shuffle. The highest count of each id has at most as many rows as the vocabulary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.llm.common import groups_of, settle, small_join
from lynxrisk.llm.packing import encoder

#: Elements of the shorter list that gallop together.
BLOCK = 4096
#: Texts longer than this many characters are given to the pieces' tokenizer in parts.
LONG_TEXT = 50_000
#: Links counted in a task before it hands on what it has.
COUNTED_LINKS = 4_000_000

_ROW = "doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each token of a byte-level vocabulary: a tokenizer file (.json) or ranks (.tiktoken)."""
    if path.endswith(".tiktoken"):
        import base64

        with open(path, "rb") as file:
            ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
        return [ranks.get(i, b"") for i in range(max(ranks) + 1)]
    from tokenizers import Tokenizer

    letters = byte_letters()
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
    return tokens


class Pieces:
    """A sentencepiece model: ids of texts, and the bytes of each piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        #: no piece goes on over a blank, so a text may be cut before one
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG_TEXT or not self.cuts:
            return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)
        parts, start = [], 0
        while start < len(text):
            end = start + LONG_TEXT
            while 0 < (end := text.find(" ", end)) and text[end - 1] == " ":
                end += 1  # inside a run of blanks, which may be one piece
            end = end if 0 < end < len(text) - 1 else len(text)
            parts.append(text[start:end])  # the model adds the blank that is left out here
            start = end + 1
        return np.concatenate([np.array(p, dtype=np.int64) for p in self.model.encode(parts, num_threads=1)])


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short``, how many of the ascending ``long`` are below it.

    Blocks of elements search together, from where the block before ended: steps of 1, 2, 4, ... up to the first value that is not below, then by halves in the last step.
    """
    ranks = np.empty(len(short), dtype=np.int64)
    at = 0
    for start in range(0, len(short), BLOCK):
        wanted = short[start : start + BLOCK]
        low = np.full(len(wanted), at, dtype=np.int64)  # all before are below
        high = np.full(len(wanted), len(long), dtype=np.int64)
        going, step = np.arange(len(wanted)), 1
        while len(going):
            probe = low[going] + step - 1
            inside = probe < len(long)
            going, probe = going[inside], probe[inside]
            below = long[probe] < wanted[going]
            high[going[~below]] = probe[~below]
            going = going[below]
            low[going] = probe[below] + 1
            step *= 2
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            below = long[middle] < wanted[open_]
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        ranks[start : start + BLOCK] = low
        at = int(low[-1])
    return ranks


@dataclass
class Alignment:
    """Common ends as indices into both lists, and the links as indices of tokens."""

    common_a: np.ndarray
    common_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a: np.ndarray, b: np.ndarray) -> Alignment:
    """Align tokens by their ends (ascending, none empty, the last ones equal)."""
    if len(a) > len(b):
        other = align(b, a)
        return Alignment(other.common_b, other.common_a, other.link_b, other.link_a)
    rank = gallop(a, b)
    common = b[rank] == a if len(a) else np.zeros(0, dtype=bool)  # no end lies behind the last of the other list
    first = np.concatenate([[0], (rank + common)[:-1]]).astype(np.int64) if len(a) else rank
    many = rank - first + 1
    link_a = np.repeat(np.arange(len(a)), many)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return Alignment(np.flatnonzero(common), rank[common], link_a, link_b)


class Groups:
    """Writes groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size_a: int, size_b: int):
        names = [str(i).encode() for i in range(max(size_a, size_b))]
        self.names = np.array([n + s for s in (b",", b"|", b";") for n in names], dtype=object)
        self.step = len(names)

    def write(self, a: np.ndarray, b: np.ndarray, common_a: np.ndarray, common_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of the text in order, and for each token of ``a`` ends (common ones) where its group's parts end."""
        sign_a, sign_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        sign_a[common_a], sign_b[common_b] = 1, 2
        size_a, size_b = np.diff(common_a, prepend=-1), np.diff(common_b, prepend=-1)
        before_b = np.concatenate([[0], np.cumsum(size_b)[:-1]])
        parts = np.empty(len(a) + len(b), dtype=object)
        parts[np.arange(len(a)) + np.repeat(before_b, size_a)] = self.names[a + sign_a * self.step]
        parts[np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)] = self.names[b + sign_b * self.step]
        return parts, common_a + 1 + common_b + 1


@lru_cache(maxsize=2)
def _tools(a_path: str, b_path: str):
    tokens_a, pieces = byte_tokens(a_path), Pieces(b_path)
    sizes = [np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (tokens_a, pieces.tokens)]
    tables = [np.array(tokens, dtype=object) for tokens in (tokens_a, pieces.tokens)]
    return encoder(a_path), pieces, tables, sizes, Groups(len(tokens_a), len(pieces.tokens))


def aligned_rows(texts: list[str | None], a_path: str, b_path: str) -> Iterator[tuple]:
    """For each text: n_a, n_b, n_groups, n_links, groups_sha256, its different id pairs (a * ids of B + b), and how often each is linked."""
    encode_a, pieces, (bytes_a, bytes_b), (size_a, size_b), groups = _tools(a_path, b_path)
    asked = [i for i, t in enumerate(texts) if t]
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, ids in zip(asked, encode_a([" " + texts[i] for i in asked]), strict=True):
        a, b = ids.astype(np.int64), pieces.encode(texts[i])
        whole = (" " + texts[i]).encode("utf-8", "replace")
        if b"".join(bytes_a[a].tolist()) == whole and b"".join(bytes_b[b].tolist()) == whole:
            found[i] = a, b
    if found:
        all_a, all_b = (np.concatenate([f[k] for f in found.values()]) for k in (0, 1))
        al = align(np.cumsum(size_a[all_a]), np.cumsum(size_b[all_b]))
        parts, group_ends = groups.write(all_a, all_b, al.common_a, al.common_b)
        keys = all_a[al.link_a] * len(bytes_b) + all_b[al.link_b]
    at_a = at_b = at_group = at_link = 0
    for i in range(len(texts)):
        if i not in found:
            yield 0, 0, 0, 0, "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
            continue
        n_a, n_b = len(found[i][0]), len(found[i][1])
        end_group = int(np.searchsorted(al.common_a, at_a + n_a))
        end_link = int(np.searchsorted(al.link_a, at_a + n_a))
        text = b"".join(parts[at_a + at_b : at_a + at_b + n_a + n_b].tolist())[:-1]
        pairs, times = np.unique(keys[at_link:end_link], return_counts=True)
        yield n_a, n_b, end_group - at_group, end_link - at_link, hashlib.sha256(text).hexdigest(), pairs, times.astype(np.int32)
        at_a, at_b, at_group, at_link = at_a + n_a, at_b + n_b, end_group, end_link


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of documents: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = _ROW.format(docs.schema["doc_id"].dataType.simpleString())
    types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in groups_of(batch.column("text")):
                columns = zip(*aligned_rows(group, a_path, b_path), strict=True)
                arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(group)), *arrays], names=names)
                at += len(group)

    return source.mapInArrow(rows, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count): links of the corpus by id pair, added up in each task first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            pairs, of = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            sums = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(sums, of, np.concatenate([t for _, t in parts]))
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sums)], names=["pair", "count"])

        parts, size = [], 0
        for batch in batches:
            pairs = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            parts.append((pairs, batch.column("times").flatten().to_numpy(zero_copy_only=False)))
            size += len(pairs)
            if size >= COUNTED_LINKS:
                yield handed(parts)
                parts, size = [], 0
        if size:
            yield handed(parts)

    partial = rows.select("pairs", "times").mapInArrow(counted, "pair long, count long")
    return partial.groupBy("pair").agg(F.sum("count").alias("count"))


def cross_align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path`` is a byte-level vocabulary (see ``packing.encoder``) and encodes a blank and the text; ``b_path`` a sentencepiece model, which adds the blank
    itself. Special tokens in a text are plain text. A text that is null or empty, or that a tokenizer changes, has no tokens: zeros and an empty hash.
    Links are all pairs of an A and a B token that overlap; a pair of ids counts all its links in the corpus. ``n_best`` are the text's links whose pair has
    the highest count of its B id, ``count_sum`` is the sum of the counts over its links. Very long texts are taken whole; repeated rows count each; a null doc_id
    is kept. Other columns aren't read. An empty table gives an empty result.
    """
    rows = settle(aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()))
    counts = settle(pair_counts(rows))
    b_size = _vocabulary_size(b_path)
    best = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("count").alias("most"))  # at most as many rows as B has ids
    rated = counts.join(F.broadcast(best), F.col("pair") % b_size == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    known = settle(rated)
    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("own"), F.col("l.times").alias("times"))
    joined = small_join(linked, known, F.col("own") == F.col("pair"))
    times = F.col("times").cast("long")
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    result = rows.drop("pairs", "times").join(sums, "row", "left")
    return result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def _vocabulary_size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
