"""Exact embedding near-duplicates as a metric range join.

For unit vectors cosine >= c means Euclidean distance <= r = sqrt(2 - 2c). A
bounded set of pivots divides the vectors: a vector's cell is that of its
nearest pivot. If x (cell i) and y (cell j) are within r, the triangle
inequality puts x within r of the plane between the two pivots, so x is copied
to cell j only if (d(x, j)^2 - d(x, i)^2) / (2 d(i, j)) <= r. It also puts x
within r of the ball of j's vectors, so d(x, j) <= r + the ball's radius. Cells
have pivots of their own, by which the same rule divides them again: of cell j, x goes to
those inner cells whose ball is within r, and whose plane towards the inner
pivot nearest to x.
There is one inner pivot per ``PER_PIVOT`` vectors, as far as ``PIVOT_BYTES``
holds them. Small inner cells share a block of about ``BLOCK`` vectors, large
ones are dealt into several, and blocks are numbered; a pair meets in one of its two vectors' blocks and nowhere else:
the lower-numbered one if both numbers are even or both odd, else the higher.
Blocks join independently: a task holds one block and streams the copies sent
to it.

Single-precision products pick candidates with a margin above their rounding
error; each candidate is then decided in double precision. A block reports the
number of links of each vector and a spanning set of its links, never its
pairs, so a large group of near copies adds rows in proportion to its size.
Equal vectors are one entry that counts as many; ids find their entry by two
64-bit hashes of the vector.

The join is exact whatever the data. How many copies a vector has depends on
the data: where vectors have no clusters (random directions in many
dimensions) all cells are neighbours and the work grows with the square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise
from sparkwright.llm.components import connected_components

THRESHOLD = 0.9
#: Most outer pivots.
PIVOTS = 256
#: Most bytes of all pivots, in doubles: what the driver and each task hold.
PIVOT_BYTES = 16 << 20
#: Vectors of a block, and of an inner cell, about.
BLOCK, PER_PIVOT = 4096, 256
#: Above the rounding error of a single-precision product of unit vectors.
MARGIN = 1e-4
#: Above the rounding error in comparing squared distances, with that of a distance between pivots.
SLACK = 2e-7
#: Above the rounding error of a distance.
BALL_SLACK = 1e-6


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dim doubles padded with zeros, lengths)."""
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(-1, dim), lengths
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out, lengths


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest part first, so that squares can't overflow or vanish.
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between unit vectors."""
    return np.maximum(2 - 2 * (x @ y.T), 0)


class _Cells:
    """Pivots in two levels; the inner cells are numbered through."""

    def __init__(self, sample: np.ndarray, pivots: int):
        self.outer = sample[:pivots]
        nearest = _squares(sample, self.outer).argmin(axis=1)
        # A pivot equal to an earlier one has no sample of its own, only itself.
        self.inner = [sample[nearest == j] if (nearest == j).any() else self.outer[j:j + 1]
                      for j in range(len(self.outer))]
        self.offset = np.cumsum([0] + [len(i) for i in self.inner])
        self.gap = np.sqrt(_squares(self.outer, self.outer))

    def home(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The inner cell of each vector, its squared distance to that cell's
        pivot, and its squared distances to the outer pivots."""
        d2 = _squares(u, self.outer)
        outer, out, own = d2.argmin(axis=1), np.empty(len(u), np.int64), np.empty(len(u))
        for j in np.unique(outer):
            who = np.flatnonzero(outer == j)
            e2 = _squares(u[who], self.inner[j])
            out[who] = self.offset[j] + e2.argmin(axis=1)
            own[who] = e2.min(axis=1)
        return out, own, d2

    def measure(self, u: np.ndarray) -> pa.RecordBatch:
        """(cell, size, reach, outer_reach): how many of ``u`` live in each inner
        cell, and the largest distances to its pivot and to its outer pivot."""
        cell, own, d2 = self.home(u)
        found, at, size = np.unique(cell, return_inverse=True, return_counts=True)
        reach, outer = np.zeros(len(found)), np.zeros(len(found))
        np.maximum.at(reach, at, np.sqrt(own))
        np.maximum.at(outer, at, np.sqrt(d2.min(axis=1)))
        return pa.RecordBatch.from_arrays([pa.array(a) for a in (found, size, reach, outer)],
                                          names=["cell", "size", "reach", "outer_reach"])

    def settle(self, rows, block: int) -> None:
        """Take the measures of all vectors, (cell, size, reach, outer_reach) per
        inner cell: the blocks of inner cell c are the ``count[c]`` from ``base[c]``."""
        size = np.zeros(self.offset[-1], np.int64)
        self.reach, self.outer_reach = np.full(len(size), -np.inf), np.full(len(self.outer), -np.inf)
        for cell, n, reach, outer_reach in rows:
            j = np.searchsorted(self.offset, cell, "right") - 1
            size[cell], self.reach[cell] = n, reach
            self.outer_reach[j] = max(self.outer_reach[j], outer_reach)
        # A large cell has blocks of its own; neighbouring small ones fill a block together.
        self.count = np.maximum(1, -(-size // block))
        self.base = np.zeros(len(size), np.int64)
        at, held, alone = 0, 0, False
        for cell, (n, many) in enumerate(zip(size.tolist(), self.count.tolist())):
            if held and (alone or many > 1 or held + n > block):
                at, held = at + 1, 0
            self.base[cell], held, alone = at, held + n, many > 1
            at += many - 1
        self.blocks = at + 1

    def near(self, u: np.ndarray, d2: np.ndarray, radius: float):
        """Per outer cell (rows, inner cells): where a neighbour within ``radius`` may live."""
        outer = d2.argmin(axis=1)
        own = d2[np.arange(len(u)), outer]
        may = ((d2 - own[:, None]) <= 2 * self.gap[outer] * radius + SLACK) & (
            np.sqrt(d2) <= self.outer_reach + radius + BALL_SLACK)
        for j, pivots in enumerate(self.inner):
            who = np.flatnonzero(may[:, j])
            reach = self.reach[self.offset[j]:self.offset[j + 1]] + radius + BALL_SLACK
            step = max(1, (1 << 20) // len(pivots))
            for at in range(0, len(who), step):
                rows = who[at:at + step]
                e2 = _squares(u[rows], pivots)
                best = e2.argmin(axis=1)
                gap = np.sqrt(_squares(pivots[best], pivots))
                r, c = np.nonzero((e2 - e2[np.arange(len(rows)), best][:, None]
                                   <= 2 * gap * radius + SLACK) & (np.sqrt(e2) <= reach))
                yield rows[r], self.offset[j] + c


def _place(cells: _Cells, radius: float, dim: int):
    """Rows (block, copy, entry, n, vector): the home row of each vector and
    its copies in the other blocks where it may meet a neighbour."""
    base, count = cells.base, cells.count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            u = _unit(_matrix(b.column("vector"), dim)[0])
            cell, _, d2 = cells.home(u)
            home = base[cell] + b.column("entry").to_numpy() % count[cell]

            def emit(take: np.ndarray, block: np.ndarray, copy: bool):
                for at in range(0, len(take), 8192):
                    t = pa.array(take[at:at + 8192])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block[at:at + 8192].astype(np.int32)),
                         pa.array(np.full(len(t), copy)), b.column("entry").take(t),
                         b.column("n").take(t), b.column("vector").take(t)],
                        names=["block", "copy", "entry", "n", "vector"])

            yield from emit(np.arange(len(u)), home, False)
            last = np.full(len(u), -1)
            for rows, c in cells.near(u, d2, radius):
                # Every block of each cell, once: a row's blocks come in ascending order.
                many = count[c]
                take = np.repeat(rows, many)
                within = np.arange(len(take)) - np.repeat(np.cumsum(many) - many, many)
                block = np.repeat(base[c], many) + within
                again = block == last[take]
                again[1:] |= (take[1:] == take[:-1]) & (block[1:] == block[:-1])
                np.maximum.at(last, take, block)
                take, block = take[~again], block[~again]
                at = home[take]
                sent = np.where((at + block) % 2 == 0, at > block, at < block)
                yield from emit(take[sent], block[sent], True)
    return run


def _join_blocks(threshold: float, dim: int):
    """Over rows sorted by (block, copy): (entry, links, near) where links is
    how many vectors an entry gained here and near a link of the spanning set."""

    def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * b).sum(axis=1) >= threshold

    def pairs(ha, ua, la, ub, lb, same: bool):
        """Linked (i, j) between a home block and other rows."""
        out_i, out_j = [], []
        f = ub.astype(np.float32)
        for at in range(0, len(ub), 2048):
            g = ha @ f[at:at + 2048].T
            i, j = np.nonzero(g >= np.float32(threshold - MARGIN))
            j = j + at
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            ok = la[i] == lb[j]
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 100_000):
                e = slice(s, s + 100_000)
                good = exact(ua[i[e]], ub[j[e]])
                out_i.append(i[e][good])
                out_j.append(j[e][good])
        return (np.concatenate(out_i) if out_i else np.empty(0, np.int64),
                np.concatenate(out_j) if out_j else np.empty(0, np.int64))

    def star(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        label = np.arange(n)
        while len(i):
            low = np.minimum(label[i], label[j])
            if (label[i] == low).all() and (label[j] == low).all():
                break
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        return label

    def report(entries: np.ndarray, gained: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
        keep = (gained > 0) | (near != entries)
        return pa.RecordBatch.from_arrays(
            [pa.array(entries[keep]), pa.array(gained[keep]), pa.array(near[keep])],
            names=["entry", "links", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, home, ready = None, [], None

        def close_home():
            e, n, u, ln = (np.concatenate([h[k] for h in home]) for k in range(4))
            f = u.astype(np.float32)
            i, j = pairs(f, u, ln, u, ln, True)
            gained = np.bincount(i, n[j], len(e)) + np.bincount(j, n[i], len(e))
            near = e[star(len(e), i, j)]
            return (e, n, u, ln, f), report(e, gained.astype(np.int64), near)

        for b in batches:
            if not b.num_rows:
                continue
            blk = b.column("block").to_numpy()
            copy = np.asarray(b.column("copy"))
            entry, n = b.column("entry").to_numpy(), b.column("n").to_numpy()
            x, ln = _matrix(b.column("vector"), dim)
            u = _unit(x)
            cuts = np.r_[0, np.flatnonzero((blk[1:] != blk[:-1]) | (copy[1:] != copy[:-1])) + 1,
                         len(blk)]
            for s, t in zip(cuts[:-1], cuts[1:]):
                if blk[s] != block:
                    if home and ready is None:
                        yield close_home()[1]
                    block, home, ready = blk[s], [], None
                part = (entry[s:t], n[s:t], u[s:t], ln[s:t])
                if not copy[s]:
                    home.append(part)
                    continue
                if not home:
                    continue  # a block without vectors of its own
                if ready is None:
                    ready, rows = close_home()
                    yield rows
                e, hn, hu, hl, hf = ready
                i, j = pairs(hf, hu, hl, part[2], part[3], False)
                if len(i):
                    every = np.concatenate([e, part[0]])
                    gained = np.concatenate([np.bincount(i, part[1][j], len(e)),
                                             np.bincount(j, hn[i], len(part[0]))])
                    near = every[star(len(every), i, j + len(e))]
                    yield report(every, gained.astype(np.int64), near)
        if home and ready is None:
            yield close_home()[1]
    return run


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS,
                    block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors`` has vec_id and embedding. Vectors that are null, empty or zero
    or hold null or non-finite parts link with nothing; vectors of different
    length never link. ``n_links`` counts other rows linked directly, equal
    vectors included; ``component_id`` is the smallest vec_id reachable (null if
    only null ids are); ``kept`` is vec_id = component_id, so of repeated rows
    with the smallest id all are kept. An empty table gives no rows. Other
    columns are ignored. ``pivots`` bounds the outer pivots.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    doubles = F.col("embedding").cast("array<double>")
    usable = (F.coalesce(F.size(doubles), F.lit(0)) > 0) & ~F.exists(
        doubles, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(
        doubles, lambda v: v != 0)
    rows = vectors.select("vec_id", doubles.alias("vector"),
                          F.coalesce(usable, F.lit(False)).alias("_ok"))
    # Adding zero makes -0.0 and 0.0 one value; equal vectors are one entry.
    same = F.transform("vector", lambda v: v + F.lit(0.0))
    rows = rows.withColumns({"h1": F.when(F.col("_ok"), F.xxhash64(same)),
                             "h2": F.when(F.col("_ok"), F.xxhash64(F.lit("second"), same))})
    entries = materialise(
        rows.filter("_ok").groupBy("h1", "h2", same.alias("vector"))
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
        .withColumn("entry", F.monotonically_increasing_id()), "vectors")
    stats = entries.agg(F.count("*"), F.max(F.size("vector"))).first()
    ids = rows.select("vec_id", "h1", "h2")
    if stats[0] == 0:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                          F.col("vec_id").alias("component_id"),
                          F.col("vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))
    total, dim = stats
    per_pivot = max(1, block * PER_PIVOT // BLOCK)
    k = max(1, min(math.ceil(total / per_pivot), PIVOT_BYTES // (8 * dim)))
    # The sample is in hash order, so it is the same in every run.
    sample = pa.array([r.vector for r in entries.orderBy("h1", "h2").limit(k).select("vector")
                       .collect()], pa.list_(pa.float64()))
    cells = _Cells(_unit(_matrix(sample, dim)[0]), pivots)
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield cells.measure(_unit(_matrix(b.column("vector"), dim)[0]))

    # One row per inner cell: PIVOT_BYTES bounds them.
    cells.settle((tuple(r) for r in entries.select("vector").mapInArrow(
        measures, "cell long, size long, reach double, outer_reach double")
        .groupBy("cell").agg(F.sum("size"), F.max("reach"), F.max("outer_reach")).collect()), block)
    placed = entries.select("entry", "n", "vector").mapInArrow(
        _place(cells, radius, dim),
        "block int, copy boolean, entry long, n long, vector array<double>")
    found = materialise(
        placed.repartition(cells.blocks, "block").sortWithinPartitions("block", "copy")
        .mapInArrow(_join_blocks(threshold, dim), "entry long, links long, near long"),
        "vector-links")
    links = found.groupBy("entry").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("entry").alias("a"), F.col("near").alias("b")))
    named = materialise(
        entries.select("entry", "h1", "h2", "n", "least").join(links, "entry", "left")
        .join(roots.withColumnRenamed("node", "entry"), "entry", "left")
        .select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                "least", F.coalesce("root", "entry").alias("root")), "vector-roots")
    least = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")),
                        "vector-components")
    lookup = materialise(named.join(least, "root").select("h1", "h2", "n_links", "component_id"),
                         "vector-lookup")
    linked = (ids.filter("h1 is not null").join(lookup, ["h1", "h2"])
              .select("vec_id", "n_links", "component_id"))
    alone = ids.filter("h1 is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT r, vec_id, e, list_cosine_similarity(e, e) AS ok FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.r, b.r AS s FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
c AS (
  WITH RECURSIVE reach(r, s) AS (
    SELECT r, s FROM p UNION SELECT reach.r, p.s FROM reach JOIN p ON reach.s = p.r)
  SELECT reach.r, min(v.vec_id) AS m FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
n AS (SELECT r, count(*) AS n FROM p GROUP BY r)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links,
       coalesce(least(c.m, v.vec_id), v.vec_id) AS component_id,
       v.vec_id IS NOT DISTINCT FROM coalesce(least(c.m, v.vec_id), v.vec_id) AS kept
FROM v LEFT JOIN n ON n.r = v.r LEFT JOIN c ON c.r = v.r
"""
