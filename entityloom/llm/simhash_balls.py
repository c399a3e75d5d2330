"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``radius`` bits (an even number) exactly if
some value lies within half the radius of both. So every distinct fingerprint
emits all its variants within half the radius, equal variants meet, and what
meets is linked. All that share a variant are within the radius of each other,
so a star of them holds the whole group: no pairs are written, and no link
between different fingerprints is lost.

Variants travel packed. They are shuffled by a hash of the variant that is
linear over the bits, so that the fingerprint alone tells which of its variants
go to a bucket: one row carries the fingerprints of a batch for a bucket, and
the bucket makes their variants there again, in slices of bounded memory. While
there are fewer buckets than variants every fingerprint goes to all of them (8
bytes each); their number rises with the count of fingerprints so that none
holds more than ``BUCKET_FINGERPRINTS`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import kept_with_text, map_batches, ship_package, stored, text_bytes
from entityloom.llm.components import components, join_trees

BITS = 64
MIN_BUCKET_BITS = 8
BUCKET_FINGERPRINTS = 16_000_000
_SLICE_VARIANTS = 3_000_000
_BLOCK_SHINGLES = 100_000


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles: a bit is 1 if over half of the XXH64 hashes have it.

    A-Z are lower-cased, words are cut at ASCII white space, repeated shingles
    count again. Fewer words than a shingle are one shingle; no words give 0.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK_SHINGLES):
        pairs = zip(begins[at : at + _BLOCK_SHINGLES], stops[at : at + _BLOCK_SHINGLES])
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", shingle: int = 4, out: str = "fp") -> DataFrame:
    """The ``keep`` columns and the fingerprint of each whole text as a long."""
    rows = kept_with_text(docs, keep, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["kept", "fp"])

    kept = rows.schema["kept"].dataType.simpleString()
    return map_batches(rows, run, f"kept {kept}, fp bigint").select(*[F.col("kept")[c].alias(c) for c in keep], F.col("fp").alias(out))


def _ball(half: int) -> np.ndarray:
    """The masks of at most ``half`` bits."""
    masks = [sum(1 << b for b in bits) for size in range(half + 1) for bits in combinations(range(BITS), size)]
    return np.array(masks, np.uint64)


def _linear_hash(values: np.ndarray, bits: int) -> np.ndarray:
    """A bucket number that is linear: the hash of an exclusive-or is the exclusive-or of the hashes."""
    rows = np.random.default_rng(20240607).integers(0, 1 << 63, bits, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(values.shape, np.int64)
    for k, row in enumerate(rows):
        out |= (np.bitwise_count(values & row).astype(np.int64) & 1) << k
    return out


def _meet(prints: np.ndarray, bucket: int, bits: int, masks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of the fingerprints whose variants meet in the bucket, as members and the roots of a forest."""
    of_mask = _linear_hash(masks, bits)
    order = np.argsort(of_mask, kind="stable")
    by_hash, of_mask = masks[order], of_mask[order]
    wanted = _linear_hash(prints, bits) ^ bucket
    order = np.argsort(wanted, kind="stable")
    prints, wanted = prints[order], wanted[order]
    low, high = np.searchsorted(of_mask, wanted, "left"), np.searchsorted(of_mask, wanted, "right")
    total = int((high - low).sum())
    slices = max(1, -(-total // _SLICE_VARIANTS))
    borders = np.flatnonzero(np.concatenate(([True], wanted[1:] != wanted[:-1], [True]))) if len(wanted) else np.zeros(1, int)
    root = np.arange(len(prints))
    for now in range(slices):
        values, owners = [], []
        for a, b in zip(borders[:-1], borders[1:]):
            for mask in by_hash[low[a] : high[a]]:
                v = prints[a:b] ^ mask
                own = np.arange(a, b)
                if slices > 1:
                    mine = ((v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(slices) == now
                    v, own = v[mine], own[mine]
                values.append(v)
                owners.append(own)
        if not values:
            continue
        v, own = np.concatenate(values), np.concatenate(owners)
        ordered = np.sort(v)
        met = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(met):
            continue
        met = met[np.concatenate(([True], met[1:] != met[:-1]))]
        at = np.minimum(np.searchsorted(met, v), len(met) - 1)
        hit = met[at] == v
        v, own = v[hit], own[hit]
        order = np.argsort(v, kind="stable")
        v, own = v[order], own[order]
        first = np.concatenate(([True], v[1:] != v[:-1]))
        centre = own[np.flatnonzero(first)[np.cumsum(first) - 1]]
        links = np.unique(np.stack((np.minimum(centre, own), np.maximum(centre, own))), axis=1)
        a, b = links
        near = (a != b) & (np.bitwise_count(prints[a] ^ prints[b]) <= radius)
        root = join_trees(root, a[near], b[near])
    member = np.flatnonzero(root != np.arange(len(root)))
    return prints[member], prints[root[member]]


def ball_links(prints: DataFrame, radius: int = 4, column: str = "fp") -> DataFrame:
    """Links ``a, b`` among the distinct longs of ``column`` whose components are those of all pairs within ``radius``.

    Missing values link with nothing; an empty table gives no links.
    """
    if radius % 2 or not 0 <= radius <= 6:
        raise ValueError("the radius must be 0, 2, 4 or 6")
    spark = prints.sparkSession
    ship_package(spark)
    distinct = stored(prints.select(F.col(column).alias("fp")).filter("fp IS NOT NULL").distinct())
    variants = sum(comb(BITS, k) for k in range(radius // 2 + 1))
    bits, n = MIN_BUCKET_BITS, distinct.count()
    # a bucket gets all fingerprints, or their share of variants once buckets outnumber these
    while n * min(1.0, variants / (1 << bits)) > BUCKET_FINGERPRINTS:
        bits += 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = np.unique(_linear_hash(_ball(radius // 2), bits))
        step = max(64, min(65_536, 8_000_000 // len(shifts)))
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                if len(shifts) == 1 << bits:  # every bucket gets the part
                    buckets, blobs = np.arange(1 << bits), [part.tobytes()] * (1 << bits)
                else:
                    to = (_linear_hash(part, bits)[:, None] ^ shifts[None, :]).ravel()
                    order = np.argsort(to, kind="stable")
                    buckets, begins = np.unique(to[order], return_index=True)
                    sent = np.repeat(part, len(shifts))[order]
                    blobs = [x.tobytes() for x in np.split(sent, begins[1:])]
                for i in range(0, len(buckets), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(buckets[i : i + 64], pa.int64()), pa.array(blobs[i : i + 64], pa.binary())], ["bucket", "prints"]
                    )

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        own = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("prints")]))
        a, b = _meet(own, key[0].as_py(), bits, _ball(radius // 2), radius)
        return pa.table({"a": pa.array(a.view(np.int64), pa.int64()), "b": pa.array(b.view(np.int64), pa.int64())})

    packed = distinct.mapInArrow(pack, "bucket bigint, prints binary")
    return packed.groupBy("bucket").applyInArrow(meet, "a bigint, b bigint")


def near_groups(fingerprinted: DataFrame, radius: int = 4, id_col: str = "doc_id", fp_col: str = "fp") -> DataFrame:
    """All columns of the rows and ``component_id``, the smallest id reachable over links.

    Rows with equal fingerprints are linked. A missing id is reachable but
    never the smallest, unless a component has no other; a row without a
    fingerprint is a component of its own. Repeated rows stay repeated.
    """
    columns = [c for c in fingerprinted.columns if c != "component_id"]
    packed = F.struct(*columns).alias("row")  # so that no column of the rows clashes with those below
    rows = stored(fingerprinted.select(packed, F.col(id_col).alias("id"), F.col(fp_col).alias("fp")))
    roots = components(ball_links(rows, radius))
    smallest = rows.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least"))
    linked = smallest.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = stored(linked)
    # both sides of the joins come straight from storage, so adaptive execution can split a large component
    of_root = stored(linked.groupBy("root").agg(F.min("least").alias("component")))
    of_print = stored(linked.join(of_root, "root").select(F.col("fp").alias("print"), "component"))
    joined = rows.join(of_print, F.col("fp") == F.col("print"), "left")
    own = F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component"))
    return joined.select(*[F.col("row")[c].alias(c) for c in columns], own.alias("component_id"))
