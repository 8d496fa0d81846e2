"""Vector code compression: product codebooks by exact integer k-means over
metric trees of the anchors hierarchy.

Vectors become integers and are cut into parts. A task gathers its vectors into
blocks of bounded size and builds one metric tree per block and part: about
sqrt(n) anchors, each next one the point farthest from its anchor, take over the
points nearer to them; anchors are split the same way below and merged in pairs
with the smallest covering ball above (middle-out). Every ball caches the count
and the sum of its points. The trees are written once to the scratch folder and
read again by every round.

In a round a ball inherits its parent's list of candidate entries and drops
those that another candidate beats everywhere in the ball. A ball with one
candidate left is wholly owned: its cached sum and count go to that entry and no
point is looked at. Only points of undecided leaves are compared one by one. All
sums and distances are integers, so results don't depend on blocks, tasks or
retries. One row per task, part, entry and place meets in a shuffle; the
codebooks (parts x entries x width integers) go through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise

N_PARTS, N_ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers of a block at most; rows of a leaf ball that isn't split.
BLOCK_VALUES, LEAF = 1 << 18, 12
#: Largest integer component: squared distances of a part then fit in 64 bits for widths up to 8.
LIMIT = 1 << 29

_TREE = ("ids ARRAY<STRUCT<vec_id: {id}, label: {label}>>, parts ARRAY<STRUCT<points: BINARY,"
         " place: BINARY, first: BINARY, stop: BINARY, left: BINARY, right: BINARY, sums: BINARY,"
         " radius: BINARY>>")
_KINDS = {"points": np.int32, "place": np.int32, "first": np.int32, "stop": np.int32,
          "left": np.int32, "right": np.int32, "sums": np.int64, "radius": np.float64}


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q): q = floor(scale * x) per component.

    Rows whose embedding is null or holds a null or non-finite component are
    left out. A component of 2^29 or more in size fails the job: its squared
    distances have no place in 64 bits.
    """
    usable = F.col("embedding").isNotNull() & ~F.coalesce(F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    whole = F.transform("embedding", lambda x: F.floor(F.when(
        F.abs(x.cast("double")) * scale < LIMIT, x.cast("double") * scale).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is 2^29 or more")).cast("double"))).cast("int"))
    return vectors.filter(usable).select("vec_id", "label", whole.alias("q"))


# ---------------------------------------------------------------------------
# Trees (inside tasks, one block at a time)
# ---------------------------------------------------------------------------


def _anchors(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Cut ``rows`` (numbers into ``points``) into about sqrt(n) groups, each
    around an anchor point; fewer if all remaining points equal their anchors."""
    x = points[rows]
    k = max(2, int(len(rows) ** 0.5))
    owner = np.zeros(len(rows), np.int64)
    dist = ((x - x[0]) ** 2).sum(1)
    for new in range(1, k):
        far = int(dist.argmax())
        if dist[far] == 0:
            break
        d = ((x - x[far]) ** 2).sum(1)
        mine = d < dist
        owner[mine], dist[mine] = new, d[mine]
    return [rows[owner == a] for a in np.unique(owner)]


class _Tree:
    """Balls in the order of their making: children before their parent."""

    def __init__(self, points: np.ndarray):
        self.points, self.members = points, []
        self.left, self.right, self.sums, self.centre, self.radius = [], [], [], [], []

    def ball(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        x = self.points[rows]
        total = x.sum(0)
        centre = total / len(rows)
        self.members.append(rows)
        self.left.append(left)
        self.right.append(right)
        self.sums.append(total)
        self.centre.append(centre)
        # A relative surplus covers the rounding of the centre and of the root.
        self.radius.append(float(np.sqrt(((x - centre) ** 2).sum(1).max()) * (1 + 1e-9)))
        return len(self.members) - 1

    def grow(self, rows: np.ndarray) -> int:
        """The ball of ``rows``, split down to leaves, merged up from anchors."""
        if len(rows) <= LEAF:
            return self.ball(rows)
        groups = _anchors(self.points, rows)
        if len(groups) == 1:  # all points are equal
            return self.ball(rows)
        tops = [self.grow(g) for g in groups]
        centre = np.array([self.centre[t] for t in tops])
        reach = np.array([self.radius[t] for t in tops])
        span = np.sqrt(((centre[:, None] - centre) ** 2).sum(2)) + reach[:, None] + reach
        np.fill_diagonal(span, np.inf)
        for _ in range(len(tops) - 1):
            a, b = divmod(int(span.argmin()), len(tops))
            tops[a] = self.ball(np.concatenate([self.members[tops[a]], self.members[tops[b]]]),
                                tops[a], tops[b])
            centre[a], reach[a] = self.centre[tops[a]], self.radius[tops[a]]
            span[b], span[:, b] = np.inf, np.inf
            gone = np.isinf(span[a])
            near = np.sqrt(((centre - centre[a]) ** 2).sum(1)) + reach + reach[a]
            span[a] = span[:, a] = np.where(gone, np.inf, near)
            root = tops[a]
        return root

    def packed(self) -> dict[str, bytes]:
        """Arrays root first; each ball's points are one run of ``points``."""
        top = len(self.members) - 1
        order = self.members[top]
        count = np.array([len(m) for m in self.members])
        first = np.zeros(len(count), np.int64)
        for i in range(top, -1, -1):  # a merged ball's members are its left's, then its right's
            if self.left[i] >= 0:
                first[self.left[i]] = first[i]
                first[self.right[i]] = first[i] + count[self.left[i]]
        number = np.array([-1 if c < 0 else top - c for c in (*self.left, *self.right)])
        arrays = {"points": self.points[order], "place": order, "first": first[::-1],
                  "stop": (first + count)[::-1], "left": number[:top + 1][::-1],
                  "right": number[top + 1:][::-1], "sums": np.array(self.sums)[::-1],
                  "radius": np.array(self.radius)[::-1]}
        return {k: np.ascontiguousarray(v, _KINDS[k]).tobytes() for k, v in arrays.items()}


def build_tree(points: np.ndarray) -> dict[str, bytes]:
    """The packed tree of n >= 1 points (integers, one row each)."""
    tree = _Tree(points.astype(np.int64))
    tree.grow(np.arange(len(points)))
    return tree.packed()


def _unpacked(part: dict[str, bytes]) -> dict[str, np.ndarray]:
    t = {k: np.frombuffer(part[k], kind) for k, kind in _KINDS.items()}
    n = len(t["place"])
    return t | {"points": t["points"].reshape(n, -1).astype(np.int64),
                "sums": t["sums"].reshape(len(t["first"]), -1)}


def owners(tree: dict[str, np.ndarray], entries: np.ndarray):
    """Pass the candidate lists down the tree. Returns (balls, owner of each)
    wholly owned, and (points, owner of each) of undecided leaves."""
    k = len(entries)
    size = (tree["stop"] - tree["first"])[:, None]
    centre = tree["sums"] / size
    # An entry equal to an earlier one never wins.
    first_equal = (entries[:, None] == entries[None]).all(2).argmax(1)
    gap = np.sqrt(((entries[:, None] - entries[None]).astype(float) ** 2).sum(2))
    norm = (entries.astype(float) ** 2).sum(1)
    balls, lists = np.zeros(1, np.int64), (first_equal == np.arange(k))[None]
    owned, owned_by, points, points_by = [], [], [], []
    while len(balls):
        c = centre[balls]
        d = ((c[:, None] - entries[None]) ** 2).sum(2)
        d = np.where(lists, d, np.inf)
        best = d.argmin(1)
        least = d[np.arange(len(balls)), best]
        # |x-e|^2 - |x-b|^2 is linear in x; its least value in the ball, less a rounding margin.
        margin = 1e-9 * ((c ** 2).sum(1)[:, None] + norm + norm[best][:, None])
        beaten = d - least[:, None] - 2 * tree["radius"][balls][:, None] * gap[best] > margin
        lists = lists & ~beaten
        single = lists.sum(1) == 1
        owned.append(balls[single])
        owned_by.append(best[single])
        leaf = ~single & (tree["left"][balls] < 0)
        for b, allowed in zip(balls[leaf], lists[leaf]):
            place = np.arange(tree["first"][b], tree["stop"][b])
            allowed = np.flatnonzero(allowed)
            diff = tree["points"][place][:, None] - entries[allowed][None]
            points.append(place)
            points_by.append(allowed[(diff ** 2).sum(2).argmin(1)])
        inner = ~single & ~leaf
        lists = np.repeat(lists[inner], 2, 0)
        balls = np.stack([tree["left"][balls[inner]], tree["right"][balls[inner]]], 1).ravel()
    none = np.zeros(0, np.int64)
    return (np.concatenate([none, *owned]), np.concatenate([none, *owned_by]),
            np.concatenate([none, *points]), np.concatenate([none, *points_by]))


def _grow_blocks(n_parts: int, width: int, schema: pa.Schema):
    rows = max(64, BLOCK_VALUES // max(1, n_parts * width))

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        ids = pa.StructArray.from_arrays(
            [whole["vec_id"].combine_chunks(), whole["label"].combine_chunks()],
            fields=list(schema.field("ids").type.value_type))
        q = whole["q"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        q = q.reshape(len(whole), n_parts, width)
        trees = [build_tree(q[:, p]) for p in range(n_parts)]
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), ids),
            pa.array([trees], schema.field("parts").type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                take = batch.slice(0, rows - n)
                batch = batch.slice(len(take))
                held.append(take)
                n += len(take)
                if n == rows:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)
    return run


def _add_up(books: np.ndarray):
    """Per task one row (slot, value) for each count and sum of each entry that
    has points; slot = (part * entries + entry) * (width + 1) + place, count first."""
    n_parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, k, width + 1), np.int64)
        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                for p, part in enumerate(parts):
                    t = _unpacked(part)
                    balls, by, points, points_by = owners(t, books[p])
                    np.add.at(total[p, :, 0], by, (t["stop"] - t["first"])[balls])
                    np.add.at(total[p, :, 1:], by, t["sums"][balls])
                    np.add.at(total[p, :, 0], points_by, 1)
                    np.add.at(total[p, :, 1:], points_by, t["points"][points])
        flat = total.ravel()
        used = np.flatnonzero(np.repeat(total[:, :, :1] > 0, width + 1, 2).ravel())
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["slot", "value"])
    return run


def _encode(books: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for row, parts in enumerate(batch.column("parts").to_pylist()):
                here = ids.slice(row, 1).flatten()
                codes = np.zeros((len(here), len(parts)), np.uint8)
                error = np.zeros(len(here), np.int64)
                for p, part in enumerate(parts):
                    t = _unpacked(part)
                    balls, by, points, points_by = owners(t, books[p])
                    entry = np.zeros(len(here), np.int64)
                    for b, e in zip(balls, by):
                        entry[t["first"][b]:t["stop"][b]] = e
                    entry[points] = points_by
                    codes[t["place"], p] = entry
                    error[t["place"]] += ((t["points"] - books[p][entry]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([
                    here.field("vec_id"), here.field("label"),
                    pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
                    schema=schema)
    return run


# ---------------------------------------------------------------------------
# Jobs
# ---------------------------------------------------------------------------


def fit_codes(vectors: DataFrame, n_parts: int = N_PARTS, n_entries: int = N_ENTRIES,
              rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): one row (vec_id, label, code, error) per usable
    vector, and the integer codebooks, shape (parts, entries, width).

    Columns vec_id, embedding and label are read, others not. A codebook starts
    as the parts of the ``n_entries`` (256 at most) first vectors by vec_id
    (nulls last, ties by the integer vector); with fewer vectors it has fewer
    entries. Distance ties go to the lower entry, and an entry without points
    stays. Repeated rows and ids are vectors of their own. All usable vectors
    must have the first one's length, a multiple of ``n_parts``; else the job
    fails. Without usable vectors there are no rows and empty codebooks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = vectors.sparkSession
    if not 1 <= n_entries <= 256:
        raise ValueError("n_entries must be 1 to 256: an entry is two hex digits")
    whole = integer_vectors(vectors, scale)
    start = whole.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(n_entries).collect()
    dim = len(start[0].q) if start else 0
    if dim % n_parts or (start and dim == 0):
        raise ValueError(f"vectors of {dim} components have no {n_parts} equal parts")
    width = dim // n_parts
    same = F.when(F.size("q") == dim, F.col("q")).otherwise(
        F.raise_error(F.lit(f"a vector has not {dim} components")))
    kinds = dict(whole.dtypes)
    tree_schema = _TREE.format(id=kinds["vec_id"], label=kinds["label"])
    empty = spark.createDataFrame([], tree_schema)
    trees = materialise(whole.withColumn("q", same).mapInArrow(
        _grow_blocks(n_parts, width, to_arrow_schema(empty.schema)), tree_schema), "vector-trees")

    books = np.array([r.q for r in start], np.int64).reshape(len(start), n_parts, width)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    for _ in range(rounds if start else 0):
        # parts x entries x (width + 1) rows: the parameters bound this result.
        got = (trees.select("parts").mapInArrow(_add_up(books), "slot BIGINT, value BIGINT")
               .groupBy("slot").agg(F.sum("value").alias("value")).collect())
        total = np.zeros((n_parts, len(start), width + 1), np.int64)
        total.ravel()[[r.slot for r in got]] = [r.value for r in got]
        count = total[:, :, :1]
        books = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)
    out = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code STRING, error BIGINT"
    codes = trees.mapInArrow(
        _encode(books, to_arrow_schema(spark.createDataFrame([], out).schema)), out)
    return codes, books


def books_sha256(books: np.ndarray) -> str:
    """Lower-case hex digest of all components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, **params) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 per usable vector;
    ``label_error`` is the error summed over equal labels, nulls together."""
    codes, books = fit_codes(vectors, **params)
    codes = materialise(codes, "vector-codes")
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error",
                    F.lit(books_sha256(books)).alias("codebooks_sha256")))


def _oracle() -> str:
    """The rounds written out, every part of every vector against every entry."""
    ctes = [f"""q AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""p AS MATERIALIZED (
  SELECT rid, vec_id, label, part,
         v[part * len(v) // {N_PARTS} + 1 : (part + 1) * len(v) // {N_PARTS}] AS x
  FROM q, (SELECT unnest(range({N_PARTS})) AS part))""",
            f"""c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST) - 1 AS entry, x AS c
  FROM p QUALIFY entry < {N_ENTRIES})"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, label, part, x, min(struct_pack(d, entry)) AS best FROM (
    SELECT p.*, c{i}.entry, CAST(list_sum(list_transform(
             list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM p JOIN c{i} USING (part))
  GROUP BY ALL)""")
        if i < ROUNDS:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(any_value(n.c), any_value(c{i}.c)) AS c
  FROM c{i} LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY place) AS c FROM (
      SELECT part, best.entry AS entry, place, CAST(sum(x[place]) AS BIGINT) AS s, count(*) AS k
      FROM a{i}, (SELECT unnest(range(1, CAST((SELECT max(len(x)) FROM p) AS BIGINT) + 1)) AS place)
      GROUP BY ALL)
    GROUP BY ALL) n USING (part, entry)
  GROUP BY ALL)""")
    last = ROUNDS
    return ("WITH " + ",\n".join(ctes) + f""",
s AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS sha FROM c{last}),
e AS (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(label) AS label,
         string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM a{last} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha AS codebooks_sha256
FROM e, s
""")


ORACLE_SQL = _oracle()
