"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors are projected on many random directions. Near vectors are near on
every one of them, so a pair is judged by the number of projections on which
each lies in a window around the other; only pairs with at least the calibrated
count are verified by their cosine in double precision.

To find pairs without comparing all, each projection is ordered and cut into
intervals, and a table sorts the vectors by their intervals on several
projections at once: what is together in a cell of a table collides on all of
them and is counted on the others. The number of projections in a table rises
with the logarithm of the number of vectors, so that a cell holds few unrelated
vectors, and there are as many tables as the recall needs for a pair exactly at
the threshold; nearer pairs are found with more certainty. A cell with many
vectors is dealt to tasks as pairs of blocks.

Cells write no pairs: each vector gets its number of links, a link being
counted in the first table where its two vectors meet, and a forest with the
components of the cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import ship_package, stored
from entityloom.llm.components import components, join_trees

RECALL = 0.995
BLOCK_VECTORS = 2048
_COUNTED = 32
# Cells are looked at together until they hold that many bytes of vectors; cells of more vectors than _SMALL
# are multiplied as matrices, the pairs of smaller ones are listed in slices.
_CHUNK_BYTES = 4 * 1024 * 1024
_SLICE_PAIRS = 100_000
_SMALL = 96
# An interval in standard deviations of the difference of a pair at the threshold; with it the shares of
# near and unrelated pairs of unit vectors that fall into one interval.
_INTERVAL = 6.3
_SAME_NEAR = 1 - math.sqrt(2 / math.pi) / _INTERVAL
_SAME_FAR = 0.45
_WINDOW = 2.0


class Projections:
    """All random directions for vectors of one dimension; the same on every task."""

    def __init__(self, dimension: int, threshold: float, vectors: int, recall: float = RECALL):
        self.together = max(6, math.ceil(math.log(max(vectors, 2)) / -math.log(_SAME_FAR)))
        self.tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - _SAME_NEAR**self.together)))
        deviation = math.sqrt(max(2 - 2 * threshold, 1e-12) / dimension)
        rng = np.random.default_rng([20240611, dimension])
        unit = lambda n: (lambda a: a / np.linalg.norm(a, axis=0))(rng.normal(size=(dimension, n)))
        self._interval = _INTERVAL * deviation
        self.window = _WINDOW * deviation
        self._counted = unit(_COUNTED)
        self._directions = unit(self.tables * self.together)
        self._offsets = rng.uniform(0, self._interval, self.tables * self.together)
        self._odd = rng.integers(0, 1 << 62, self.together, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # the count that a pair at the threshold misses once in ten thousand
        p, self.least_count, below = math.erf(_WINDOW / math.sqrt(2)), 0, 0.0
        while below + (now := math.comb(_COUNTED, self.least_count) * p**self.least_count * (1 - p) ** (_COUNTED - self.least_count)) <= 1e-4:
            below += now
            self.least_count += 1

    def cells(self, unit_vectors: np.ndarray) -> np.ndarray:
        """For each vector and table the number of its cell, hashed to a long."""
        steps = np.floor((unit_vectors @ self._directions + self._offsets) / self._interval).astype(np.int64).view(np.uint64)
        steps = steps.reshape(len(unit_vectors), self.tables, self.together)
        with np.errstate(over="ignore"):
            mixed = (steps * self._odd).sum(axis=2, dtype=np.uint64)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        return mixed.view(np.int64)

    def counted(self, unit_vectors: np.ndarray) -> np.ndarray:
        return (unit_vectors @ self._counted).astype(np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _pairs_listed(units: np.ndarray, projected: np.ndarray, stop: np.ndarray, p: Projections, threshold: float):
    """Slices of the linked pairs of rows; a row's partners are the rows behind it, up to its ``stop``."""
    partners = stop - np.arange(len(units)) - 1
    upto = np.cumsum(partners)
    allowed = _COUNTED - p.least_count
    half = _COUNTED // 2
    begin = 0
    while begin < len(units):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + _SLICE_PAIRS, "right")))
        rows = np.arange(begin, end)
        a = np.repeat(rows, partners[begin:end])
        b = a + 1 + np.arange(len(a)) - np.repeat(upto[begin:end] - partners[begin:end] - (upto[begin - 1] if begin else 0), partners[begin:end])
        begin = end
        missed = (np.abs(projected[a, :half] - projected[b, :half]) > p.window).sum(axis=1)
        left = missed <= allowed  # who missed too often in the first half cannot pass
        a, b, missed = a[left], b[left], missed[left]
        missed += (np.abs(projected[a, half:] - projected[b, half:]) > p.window).sum(axis=1)
        a, b = a[missed <= allowed], b[missed <= allowed]
        step = max(1, 4_000_000 // units.shape[1])
        for at in range(0, len(a), step):
            x, y = a[at : at + step], b[at : at + step]
            near = np.einsum("ij,ij->i", units[x], units[y]) >= threshold
            yield x[near], y[near]


def _pairs_multiplied(units: np.ndarray, projected: np.ndarray, p: Projections, threshold: float):
    """Slices of the linked pairs of rows of one large cell."""
    n = len(units)
    step = max(1, 500_000 // (n * _COUNTED))
    for at in range(0, n, step):
        rows = np.arange(at, min(at + step, n))
        missed = (np.abs(projected[rows, None, :] - projected[None, at + 1 :, :]) > p.window).sum(axis=2)
        passed = (missed <= _COUNTED - p.least_count) & (np.arange(at + 1, n)[None, :] > rows[:, None])
        if passed.any():
            a, b = np.nonzero(passed & (units[rows] @ units[at + 1 :].T >= threshold))
            yield rows[a], at + 1 + b


def _links(vectors: np.ndarray, table: np.ndarray, borders: np.ndarray, weight: np.ndarray, part: np.ndarray, two: np.ndarray, p: Projections, threshold: float):
    """Per row the number of links first met in its table, and the root of its tree.

    Rows are vectors of cells, one cell between two ``borders`` and each of one
    ``table``. Where ``two`` says that a cell is divided, ``part`` tells its two
    blocks apart and only pairs of different blocks count.
    """
    units = _unit(vectors)
    projected = p.counted(units)
    n = len(units)
    links, root = np.zeros(n, np.int64), np.arange(n)
    cells, known = np.zeros((n, p.tables), np.int64), np.zeros(n, bool)  # filled for rows with links
    large = np.flatnonzero(np.diff(borders) > _SMALL)
    stop = np.repeat(borders[1:], np.diff(borders))
    for cell in large:
        own = np.arange(borders[cell], borders[cell + 1])
        stop[own] = own + 1  # not listed

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from _pairs_listed(units, projected, stop, p, threshold)
        for lo, hi in zip(borders[large], borders[large + 1]):
            for a, b in _pairs_multiplied(units[lo:hi], projected[lo:hi], p, threshold):
                yield a + lo, b + lo

    for a, b in found():
        apart = ~two[a] | (part[a] != part[b])
        a, b = a[apart], b[apart]
        if not len(a):
            continue
        root = join_trees(root, a, b)
        asked = np.unique(np.concatenate((a, b)))
        asked = asked[~known[asked]]
        known[asked] = True
        for at in range(0, len(asked), 512):
            cells[asked[at : at + 512]] = p.cells(units[asked[at : at + 512]])
        new = np.ones(len(a), bool)
        for at in range(0, len(a), 65_536):
            now = slice(at, at + 65_536)
            met = (cells[a[now]] == cells[b[now]]) & (np.arange(p.tables)[None, :] < table[a[now], None])
            new[now] = ~met.any(axis=1)
        np.add.at(links, a[new], weight[b[new]])
        np.add.at(links, b[new], weight[a[new]])
    return links, root


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """Per row: the id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows with a cosine of at least ``threshold``,
    ``component_id`` is the smallest id reachable over links, and ``kept``
    tells whether it is the own one. Vectors that are missing, empty or zero,
    or have missing or non-finite components, have no links; vectors of
    different length have none with each other. Equal vectors are compared
    once. Repeated rows stay; rows with one id and different vectors are
    different; a missing id is never the smallest where there is another. An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    id_type = vectors.schema[id_col].dataType.simpleString()
    # single precision travels as it came
    width = np.dtype("<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    rows = rows.withColumn("v", F.when(fit, F.transform("v", lambda x: x + F.lit(0.0))))  # one zero, not two
    distinct = rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"))
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()))  # stored, so that a node keeps its number
    n = nodes.count()

    def pack(batches: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
        made: dict[int, Projections] = {}
        for batch in batches:
            node, weight, v = batch.column("node"), batch.column("weight"), batch.column("v")
            sizes = np.diff(np.asarray(v.offsets))
            flat = np.asarray(v.values)
            begins = np.asarray(v.offsets)[:-1]
            for dimension in np.unique(sizes):
                p = made.setdefault(int(dimension), Projections(int(dimension), threshold, n, recall))
                of_size = np.flatnonzero(sizes == dimension)
                for at in range(0, len(of_size), 512):
                    own = of_size[at : at + 512]
                    values = flat[begins[own][:, None] + np.arange(dimension)]
                    cells = p.cells(_unit(values))
                    take = np.repeat(own, p.tables)
                    columns = {
                        "dimension": pa.array(np.full(len(take), dimension), pa.int32()),
                        "t": pa.array(np.tile(np.arange(p.tables), len(own)), pa.int32()),
                        "cell": pa.array(cells.ravel(), pa.int64()),
                    }
                    if full:
                        raw = [x.tobytes() for x in values.astype(width)]
                        columns |= {"node": node.take(pa.array(take)), "weight": weight.take(pa.array(take)), "packed": pa.array(raw, pa.binary()).take(pa.array(np.repeat(np.arange(len(own)), p.tables)))}
                    yield pa.RecordBatch.from_pydict(columns)

    key = "dimension int, t int, cell bigint"
    keyed = nodes.select("node", "weight", "v")
    counts = keyed.mapInArrow(lambda x: pack(x, False), key).groupBy("dimension", "t", "cell").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(counts.filter("n > 1"))  # what is alone in its cell is not moved
    held = keyed.mapInArrow(lambda x: pack(x, True), f"{key}, node bigint, weight bigint, packed binary")
    blocks = F.ceil(F.col("n") / BLOCK_VECTORS).cast("int")
    dealt = held.join(shared, ["dimension", "t", "cell"]).withColumn("blocks", blocks)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("dimension", "t", "cell", "node", "weight", "packed", "part", "blocks", other)
    pairs = pairs.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    group = ["dimension", "t", "cell", "low", "high"]
    spread = pairs.select(*group, "node", "weight", "packed", "part").repartition(*[F.col(c) for c in group])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole cells of a sorted partition, many at once."""
        made: dict[int, Projections] = {}
        held: list[tuple[np.ndarray, ...]] = []  # keys, node, weight, part, vectors of one dimension

        def finish(whole: bool) -> Iterator[pa.RecordBatch]:
            keys, node, weight, part, values = (np.concatenate(x) for x in zip(*held))
            borders = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1), [True])))
            held.clear()
            if not whole:  # more of the last cell may follow
                rest = borders[-2]
                held.append((keys[rest:], node[rest:], weight[rest:], part[rest:], values[rest:]))
                borders = borders[:-1]
            n_rows = borders[-1]
            if not n_rows:
                return
            dimension = int(keys[0, 0])
            p = made.setdefault(dimension, Projections(dimension, threshold, n, recall))
            keys, node, weight, part = keys[:n_rows], node[:n_rows], weight[:n_rows], part[:n_rows]
            links, root = _links(values[:n_rows], keys[:, 1], borders, weight, part, keys[:, 3] != keys[:, 4], p, threshold)
            involved = np.flatnonzero((links > 0) | (root != np.arange(n_rows)))
            if len(involved):
                yield pa.RecordBatch.from_pydict({"a": pa.array(node[involved]), "b": pa.array(node[root[involved]]), "links": pa.array(links[involved])})

        size = due = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in group], axis=1)
            node, weight, part = (np.asarray(batch.column(c)).astype(np.int64) for c in ("node", "weight", "part"))
            packed = batch.column("packed").cast(pa.large_binary())
            offsets = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
            values = np.frombuffer(packed.buffers()[2], width, (offsets[-1] - offsets[0]) // width.itemsize, offsets[0])
            starts = (offsets - offsets[0]) // width.itemsize
            turns = np.flatnonzero(np.concatenate(([True], keys[1:, 0] != keys[:-1, 0], [True])))
            for a, b in zip(turns[:-1], turns[1:]):
                if held and held[-1][0][0, 0] != keys[a, 0]:
                    yield from finish(True)
                    size = due = 0
                cut = values[starts[a] : starts[b]].reshape(b - a, -1).copy()
                held.append((keys[a:b], node[a:b], weight[a:b], part[a:b], cut))
                size += cut.nbytes
                if size >= max(_CHUNK_BYTES, due):
                    yield from finish(False)
                    # a cell that goes on is put together again only once it has doubled
                    size = held[0][4].nbytes
                    due = 2 * size
        if held:
            yield from finish(True)

    met = stored(spread.sortWithinPartitions(*group).mapInArrow(meet, "a bigint, b bigint, links bigint"))
    links = met.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(met.select("a", "b"))
    known = (
        nodes.join(links, "node", "left").join(roots, "node", "left").select(
            "v", "least", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")
        )
    )
    known = stored(known)
    smallest = stored(known.groupBy("root").agg(F.min("least").alias("component")))
    facts = stored(known.join(smallest, "root").select("v", (F.col("weight") - 1 + F.col("links")).alias("n_links"), "component"))
    # both sides come straight from storage, so adaptive execution can split a vector with many copies
    result = rows.filter("v IS NOT NULL").join(facts, "v").select("id", "n_links", F.coalesce("component", "id").alias("component_id"))
    apart = rows.filter("v IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return result.union(apart).select(
        F.col("id").cast(id_type).alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
