"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint has 8 positional bytes. Two fingerprints at most ``d``
bits apart differ in at most ``d`` bytes, so they share at least ``8 - d`` of
them: the guaranteed minimum. The index posts each distinct fingerprint under
positional bytes, each pair met in a posting list is tallied (how many
positional bytes are equal), pairs below the minimum are left out, and the rest
are verified by their bit distance.

A list for one byte at one position holds 1/256 of all fingerprints, so pairs
would grow with the square of the input. The index therefore posts under three
bytes at a time: of all 56 triples of positions, 20 suffice for every set of
four equal positions to hold one. A list is then 2^-24 of all fingerprints (or
2^-32 with ``key_bytes=4``).

A list longer than ``LIST_MAX`` (a large group of near copies) isn't compared
pair by pair. Its members are posted under every value within ``d // 2`` bits
instead: two fingerprints at most ``d`` apart share such a midpoint. A midpoint
has at most 2,081 such members, so that path is linear in the group. It finds
the same links.

Within a list only a spanning set of its links is kept, as components need no
more. Equal fingerprints (exact copies, empty texts) are one index entry.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise
from sparkwright.llm.components import connected_components

SEED = 42
LIST_MAX = 2100
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if n == 0:
        return 0
    data = b" ".join(words)
    if n <= shingle:
        starts, ends = [0], [len(data)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        stop = np.cumsum(lengths + 1) - 1
        starts = (stop - lengths)[:n - shingle + 1].tolist()
        ends = stop[shingle - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        h = np.array([digest(data[a:b], SEED) for a, b in
                      zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK])], np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            rest = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.int64())],
                                             names=[*b.schema.names[:-1], "fp"])
    return run


def position_sets(max_bits: int, key_bytes: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``8 - max_bits`` equal positions
    hold one of them. With 3 bytes and at most 4 bits: two positions of one of
    three parts and one of the same or the next part (20 sets)."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be from 0 to 7")
    size = min(key_bytes, 8 - max_bits)
    every = list(itertools.combinations(range(8), size))
    if size != 3 or max_bits > 4:
        return every
    part = [0, 0, 0, 1, 1, 1, 2, 2]

    def chosen(s):
        n = [sum(part[p] == k for p in s) for k in range(3)]
        return 3 in n or any(n[k] == 2 and n[(k + 1) % 3] == 1 for k in range(3))

    return [s for s in every if chosen(s)]


def _postings(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    def byte(p: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long"))

    def key(k: int, positions: tuple[int, ...]) -> Column:
        out = F.lit(k).cast("long")
        for p in positions:
            out = F.shiftleft(out, 8).bitwiseOR(byte(p))
        return out

    keys = F.array(*[key(k, s) for k, s in enumerate(sets)])
    return fps.select(F.explode(keys).alias("key"), "fp")


def _links_in_lists(max_bits: int, all_linked: bool, list_max: int = LIST_MAX):
    """Over postings sorted by key: (a, b) star links of each list, and (a,
    null) for each member of a list that is too long to compare."""
    least = 8 - max_bits

    def links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(key)
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        if all_linked:
            label = first
        else:
            ends = np.r_[np.flatnonzero(new)[1:], n]
            end = np.repeat(ends, np.diff(np.r_[np.flatnonzero(new), n]))
            left, right = [], []
            i = np.arange(n)
            d = 1
            while True:
                i = i[i + d < end[i]]
                if not len(i):
                    break
                x = fp[i] ^ fp[i + d]
                tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                near = (tally >= least) & (np.bitwise_count(x) <= max_bits)
                left.append(i[near])
                right.append(i[near] + d)
                d += 1
            label = np.arange(n)
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                while True:
                    low = np.minimum(label[a], label[b])
                    if (label[a] == low).all() and (label[b] == low).all():
                        break
                    np.minimum.at(label, a, low)
                    np.minimum.at(label, b, low)
        linked = np.flatnonzero(label != np.arange(n))
        return fp[label[linked]], fp[linked]

    def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        a = pa.array(a.view(np.int64))
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, long_key = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            k = batch.column("key").to_numpy()
            f = batch.column("fp").to_numpy().view(np.uint64)
            if long_key is not None:
                more = int(np.searchsorted(k, long_key, side="right"))
                if more:
                    yield out(f[:more], None)
                k, f = k[more:], f[more:]
                if not len(k):
                    continue
                long_key = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            begin = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
            size = np.diff(np.r_[begin, len(key)])
            too_long = size > list_max
            if not all_linked and too_long.any():
                heavy = np.repeat(too_long, size)
                yield out(fp[heavy], None)
                if too_long[-1]:
                    long_key = key[-1]
                key, fp = key[~heavy], fp[~heavy]
                if not len(key):
                    continue
                begin = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
            cut = len(key) if long_key is not None else begin[-1]
            if cut:
                yield out(*links(key[:cut], fp[:cut]))
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield out(*links(key, fp))
    return run


def _midpoints(radius: int):
    masks = np.array([sum(1 << p for p in s) for r in range(radius + 1)
                      for s in itertools.combinations(range(64), r)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fp), 32):
                some = fp[at:at + 32]
                mids = (some[:, None] ^ masks[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mids.view(np.int64)),
                     pa.array(np.repeat(some, len(masks)).view(np.int64))], names=["key", "fp"])
    return run


def fingerprint_links(fps: DataFrame, max_bits: int, key_bytes: int = 3,
                      list_max: int = LIST_MAX) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: pairs with the same connected
    components as all pairs at most ``max_bits`` bits apart. Each member of a
    connected part of a list is paired with the part's smallest only.

    Odd limits above 3 are refused: lists that are too long to compare are joined
    through common midpoints, which an odd distance doesn't have at its half."""
    if max_bits > 3 and max_bits % 2:
        raise ValueError("max_bits must be at most 3 or even")
    sets = position_sets(max_bits, key_bytes)
    found = materialise(
        _postings(fps, sets).repartition("key").sortWithinPartitions("key")
        .mapInArrow(_links_in_lists(max_bits, False, list_max), "a long, b long"), "list-links")
    direct = found.filter("b is not null")
    heavy = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    # An odd distance has no common midpoint at half of it: such groups are compared instead.
    even = max_bits % 2 == 0
    mids = (heavy.mapInArrow(_midpoints((max_bits + 1) // 2), "key long, fp long")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(_links_in_lists(max_bits, even), "a long, b long")
            .filter("b is not null"))
    return direct.unionByName(mids).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                    key_bytes: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root, component_id.

    Documents link if their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest doc_id reachable (null only if all ids
    there are null), ``root`` the smallest fingerprint reachable. Null and empty texts have fingerprint 0 and link like any
    other. Repeated rows are separate rows of one component. Columns besides
    doc_id and text are not read.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    prints = materialise(rows.mapInArrow(
        _fingerprints(shingle), f"doc_id {id_type}, text_hash long, fp long"), "fingerprints")
    fps = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("_least")), "distinct-fps")
    roots = connected_components(fingerprint_links(fps.select("fp"), max_bits, key_bytes))
    named = materialise(
        fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp")), "fp-roots")
    least = materialise(named.groupBy("root").agg(F.min("_least").alias("component_id")),
                        "components")
    lookup = materialise(named.join(least, "root").select("fp", "root", "component_id"),
                         "fp-components")
    return prints.join(lookup, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with
    the smallest doc_id (nulls last), of equal ids the smallest text hash, and
    one of repeated rows. All columns are kept."""
    found = near_duplicates(docs, shingle, max_bits)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("_rows"))
    first = rows.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "text_hash", "_rows")).alias("f"))
    keep = materialise(first.select(F.col("f.doc_id").alias("_kid"),
                                    F.col("f.text_hash").alias("_khash"), "f._rows"),
                       "kept-documents")
    names = docs.columns
    keyed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                        F.xxhash64("text").alias("_hash"), F.col("doc_id").alias("_id"))
    # The narrow side is hashed, so texts aren't sorted for the join; only rows that repeat
    # are grouped.
    kept = keyed.join(keep.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_kid"))
                      & (F.col("_hash") == F.col("_khash")))
    one = kept.filter("_rows = 1").unionByName(
        kept.filter("_rows > 1").dropDuplicates(["_kid", "_khash"]))
    return one.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
