"""SimHash near-duplicates by pivot distance tables.

Fingerprints of 64 bits link if at most 3 bits differ. The search rests on Hamming distances to
fixed reference fingerprints (pivots). The bits are cut into six segments; a fingerprint's table
has its distance to each pivot in each segment. For two fingerprints the triangle inequality gives,
in every segment, a lower bound of their distance there: the maximum difference of the coordinates.
The sum of the segments' bounds is a lower bound of the whole distance.

* Linked fingerprints differ in at most 3 of the 6 segments, so in some 3 segments all coordinates
  are equal. Rows with equal coordinates in 3 segments meet by one shuffle per choice of segments;
  no pair is lost, and the number of rows sent is 20 for each different fingerprint at any size.
  (Whole-word pivot distances alone cannot part random fingerprints: they are all near 32.)
* Within such a bucket, pairs whose bound exceeds 3 are discarded, and survivors are verified.
* A bucket gives a spanning forest of its links, not all pairs. It is read as a stream of sorted rows.
  Buckets above ``bucket_rows`` are not paired: they go to the next level, where the bits that the
  bucket leaves open are cut into six finer segments. At the last level a bucket leaves at most 9 bits
  open, so it has at most 512 rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.llm.common import bound_batches, groups_of, partitions, settle, small_join
from lynxrisk.llm.components import components

BITS, SEGMENTS, LINKED = 64, 6, 3
CHOICES = list(itertools.combinations(range(SEGMENTS), SEGMENTS - LINKED))
PIVOTS = np.random.default_rng(20).integers(0, 2**64, size=16, dtype=np.uint64)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_text(text: str | None, n: int = 3) -> int:
    """SimHash of a text: words parted by ASCII white space, A-Z lower-cased, n-word shingles with repeats."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column as a signed long; null and empty texts give 0."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint_text(t) for group in groups_of(texts) for t in group]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return of(text.cast("string"))


def _masks(open_bits: int) -> list[int]:
    """Cut the open bits of a mask into six segments, nearly equal in size."""
    bits = [b for b in range(BITS) if open_bits >> b & 1]
    return [sum(1 << b for b in part) for part in np.array_split(np.array(bits, dtype=object), SEGMENTS)]


def _closed(choice: tuple[int, ...], masks: list[int]) -> int:
    return sum(masks[i] for i in choice)


def level_masks(path: tuple[int, ...]) -> list[int]:
    """Segments at the level that the choices of earlier levels lead to."""
    open_bits = 2**BITS - 1
    for step in path:
        open_bits &= ~_closed(CHOICES[step], _masks(open_bits))
    return _masks(open_bits)


def pivot_table(fingerprints: np.ndarray, masks: list[int]) -> np.ndarray:
    """Hamming distance to each pivot in each segment: fingerprints x segments x pivots."""
    apart = fingerprints[:, None] ^ PIVOTS[None, :]
    return np.stack([np.bitwise_count(apart & np.uint64(m)) for m in masks], axis=1)


def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lower bound of the distance: in each segment the maximum coordinate difference, summed."""
    return np.abs(a.astype(np.int8) - b.astype(np.int8)).max(axis=2).sum(axis=1)


def spread(fingerprints: DataFrame, path: str) -> DataFrame:
    """(path, key, fp) for each choice of three segments: rows with equal coordinates there share a key."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in batch.groupby(path, sort=False) if path else [("", batch)]:
                steps = tuple(int(x) for x in str(key).split("/")[1:])
                prefix = part["key"].to_numpy() if path else None
                masks = level_masks(steps)
                for start in range(0, len(part), 4096):
                    fp = part["fp"].to_numpy()[start : start + 4096]
                    table = pivot_table(fp.view(np.uint64), masks)
                    for number, choice in enumerate(CHOICES):
                        same = np.ascontiguousarray(table[:, choice, :]).reshape(len(fp), -1)
                        keys = [xxhash.xxh64_intdigest(row.tobytes(), 0 if prefix is None else int(prefix[start + i]) & (2**64 - 1)) for i, row in enumerate(same)]
                        yield pd.DataFrame({"path": f"{key}/{number}", "key": np.array(keys, dtype=np.uint64).view(np.int64), "fp": fp})

    return fingerprints.mapInPandas(rows, "path string, key long, fp long")


def _forest(fp: np.ndarray, bucket: np.ndarray, masks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links in each bucket; rows are sorted by bucket."""
    table = pivot_table(fp, masks)
    root = np.arange(len(fp))
    links: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left, lag = np.arange(len(fp)), 1
    while True:
        left = left[left + lag < len(fp)]
        left = left[bucket[left] == bucket[left + lag]]
        if not len(left):
            break
        for part in np.array_split(left, len(left) // 65_536 + 1):
            near = part[root[part] != root[part + lag]]
            near = near[bound(table[near], table[near + lag]) <= LINKED]
            near = near[np.bitwise_count(fp[near] ^ fp[near + lag]) <= LINKED]
            for i in near.tolist():
                a, b = find(i), find(i + lag)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((i, i + lag))
        lag += 1
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def _match(rows: DataFrame, bucket_rows: int, last: bool) -> DataFrame:
    """Links (src, dst) of the buckets of one level; buckets that are too large come back as rows (src, null)."""
    sorted_rows = rows.repartition(partitions(rows.sparkSession), "path", "key").sortWithinPartitions("path", "key", "fp")

    def done(path: str, fp: np.ndarray, key: np.ndarray) -> pd.DataFrame:
        masks = level_masks(tuple(int(x) for x in path.split("/")[1:-1]))
        a, b = _forest(fp.view(np.uint64), key, masks)
        return pd.DataFrame({"path": path, "key": np.int64(0), "src": a.view(np.int64), "dst": b.view(np.int64), "large": False})

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()  # rows of the bucket that the next batch may go on with
        large: tuple | None = None  # the bucket that has outgrown bucket_rows
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held = pd.concat([held, batch]) if len(held) else batch
                if not len(held):
                    continue
            elif not len(held):
                break
            path, key, fp = held["path"].to_numpy(), held["key"].to_numpy(), held["fp"].to_numpy()
            new = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], new])
            sizes = np.diff(np.concatenate([starts, [len(fp)]]))
            grown = (sizes > bucket_rows) & (not last)
            if large == (path[0], key[0]):
                grown[0] = True
            whole = np.ones(len(starts), dtype=bool)
            if batch is not None and not grown[-1]:
                whole[-1] = False
            of = np.repeat(np.arange(len(starts)), sizes)
            over = grown[of]
            if over.any():
                yield pd.DataFrame({"path": path[over], "key": key[over], "src": fp[over], "dst": np.int64(0), "large": True})
            take = (whole & ~grown & (sizes > 1))[of]
            for p in pd.unique(path[take]):
                mine = take & (path == p)
                yield done(p, fp[mine], of[mine])
            large = (path[-1], key[-1]) if grown[-1] else None
            held = held[~whole[of]]

    return sorted_rows.mapInPandas(matched, "path string, key long, src long, dst long, large boolean")


def fingerprint_links(fingerprints: DataFrame, bucket_rows: int = 2048) -> DataFrame:
    """Links (src, dst) whose connected components are those of all pairs with at most 3 differing bits.

    ``fingerprints``: different values in a column fp, written before (they are read at each level).
    """
    found, rows = [], spread(fingerprints.select("fp"), "")
    for level in range(3):
        out = settle(_match(rows, bucket_rows, last=level == 2))
        found.append(out.filter("NOT large").select("src", "dst"))
        large = out.filter("large")
        if level == 2 or large.isEmpty():
            break
        rows = spread(large.select("path", "key", F.col("src").alias("fp")), "path")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links.distinct()


def component_names(own: DataFrame, bucket_rows: int = 2048) -> DataFrame:
    """(fp, root, component_id) for each different fingerprint of a written table (doc_id, fp); a root stands for a component."""
    classes = settle(own.groupBy("fp").agg(F.min("doc_id").alias("first")), rows=own.count())
    roots = components(fingerprint_links(classes, bucket_rows))  # only fingerprints that have a link
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, bucket_rows: int = 2048) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 3 or fewer differing bits; component_id is the smallest doc_id of all
    documents that links lead to, its own included. Null and empty texts have fingerprint zero and are linked
    like any other. A null doc_id is kept, and is never the smallest unless a component has no other.
    Repeated rows come back as often as they are there. Other columns of the input are not read.
    """
    bound_batches(docs.sparkSession)
    own = settle(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")))
    return own.join(component_names(own, bucket_rows), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, bucket_rows: int = 2048) -> DataFrame:
    """The documents without near copies: of each component one row stays, with all its columns as they are.

    It is the row with the smallest doc_id (null last); of several such rows, the least by a hash of the text, and of rows
    equal in both any one. Which rows stay is found on ids and hashes alone; texts are not shuffled while the list of kept rows is
    small enough to be sent to them.
    """
    bound_batches(docs.sparkSession)
    own = settle(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    named = own.join(component_names(own.select("doc_id", "fp"), bucket_rows), "fp")
    kept = settle(named.groupBy("root").agg(F.min(order).alias("least")).select("least.kept_id", "least.kept_hash"), rows=own.count())
    here = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("row.text") == F.col("kept_hash"))
    rows = small_join(docs.select(F.struct("*").alias("row")), kept, here, "left_semi")
    same = own.doc_id.eqNullSafe(kept.kept_id) & (own.text_hash == kept.kept_hash)
    if own.join(kept, same, "left_semi").count() > kept.count():  # the input has equal rows
        rows = rows.groupBy(F.col("row.doc_id"), F.xxhash64("row.text")).agg(F.first("row").alias("row"))
    return rows.select("row.*")
