"""Ranked lexical search by hashed sketches of maxima.

**Index.** A document's score is a sum over the words of a query of a weight
times an impact, and the impact grows with the word's occurrences in the
document. ``sketch_index`` folds the words of each document into ``WIDTH`` hashed
coordinates and keeps the largest number of occurrences at each, stored as the
coordinates in use. Which queries will come does not matter for it.

**Bounds.** For a batch of queries, the occurrences of a word are at most those
of its coordinate, so looking up the words' coordinates and adding weight times
impact gives an upper bound of the score. All documents of a slice and all
queries are looked up together in numpy.

**Rescoring.** The documents with the highest bounds of each query are scored
exactly from their texts; the score of the last of the best ``k`` is a threshold.
Every document whose bound reaches it is then scored as well, none below it can
be among the best. So the result is exact, and sketches only decide how many
texts are read for it.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entityloom.llm.common import map_slices, stored, text_bytes, text_or_empty
from entityloom.operators.ordering import number_rows

WIDTH = 1 << 14
# More occurrences than this are kept as "any number".
_MOST = (1 << 16) - 1
# Queries of a batch; their words, and nothing that grows with the documents, go to every task.
BATCH_QUERIES = 512
# Documents of the first round, for each query.
FIRST_ROUND = 32
# Cells of the table of occurrences (words of the queries by documents) in a worker.
_CELLS = 1 << 22
# Rows of candidates up to which they are broadcast (16 MB), beyond they are joined by an exchange.
_BROADCAST_ROWS = 100_000
# The numbers of the impact formula
SCALE, TF_FACTOR, LENGTH_FACTOR, BASE, SLOPE = 1_000_000_000, 1000, 8, 25, 75
_WORD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A to Z in lower case."""
    return text.lower().translate(_WORD).split()


def term_weight(documents: int, holding: int) -> int:
    """The weight of a word by the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(n_terms, documents: int, terms: int):
    """The part of the impact that grows with the length of the document."""
    return BASE + SLOPE * n_terms * documents // terms


def impact(tf, norm):
    """The impact of ``tf`` occurrences; grows with ``tf`` and stays below ``SCALE // TF_FACTOR``."""
    return SCALE * tf // (TF_FACTOR * tf + LENGTH_FACTOR * norm)


def _coordinate(term: bytes, width: int) -> int:
    return crc32(term) % width


class _Coordinates(dict):
    def __init__(self, width: int):
        super().__init__()
        self._width = width

    def __missing__(self, term: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[term] = found = _coordinate(term, self._width)
        return found


def row_key(id_col: str, text_col: str):
    """Names a row; rows alike in both share it, and a chance collision only has one text more scored."""
    return F.xxhash64(F.col(id_col), text_or_empty(text_col))


def sketch_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", watched: tuple[bytes, ...] = (), width: int = WIDTH) -> DataFrame:
    """``key, n, at, most, holds``: the sketch of every row.

    ``n`` is the number of words, ``at`` and ``most`` are the coordinates in use
    and the largest number of occurrences there, as 16-bit numbers. ``holds`` has
    the places of those words of ``watched`` that the text holds.
    """
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(watched)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, numbers = _Coordinates(width), shared.value
        cells = np.zeros(width, np.int64)
        for batch in batches:
            ns, ats, mosts, holds = [], [], [], []
            for text in text_bytes(batch.column("text")):
                terms = terms_of(text)
                tf = Counter(terms)
                at = np.fromiter(map(places.__getitem__, tf), np.int64, len(tf))
                np.maximum.at(cells, at, np.fromiter(tf.values(), np.int64, len(tf)))
                used = np.unique(at)
                ns.append(len(terms))
                ats.append(used.astype(np.uint16).tobytes())
                mosts.append(np.minimum(cells[used], _MOST).astype(np.uint16).tobytes())
                cells[used] = 0
                holds.append([numbers[t] for t in numbers.keys() & tf.keys()])
            columns = [batch.column("key"), pa.array(ns, pa.int64()), pa.array(ats, pa.binary()), pa.array(mosts, pa.binary()), pa.array(holds, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "at", "most", "holds"])

    rows = docs.select(row_key(id_col, text_col).alias("key"), text_or_empty(text_col).alias("text"))
    return map_slices(rows, run, "key bigint, n bigint, at binary, most binary, holds array<int>")


class _Batch:
    """The queries of a batch as numbers: for each its words (with repeats counted) and their weights."""

    def __init__(self, queries: list[tuple[int, list[int], list[int]]], terms: list[bytes], documents: int, n_terms: int, width: int):
        self.queries, self.terms, self.documents, self.n_terms = queries, terms, documents, n_terms
        self.places = {t: i for i, t in enumerate(terms)}
        self.coordinate = np.array([_coordinate(t, width) for t in terms], np.int64)
        self.row_of = np.full(width, -1, np.int64)
        used = np.unique(self.coordinate)
        self.row_of[used] = np.arange(len(used))
        self.rows = len(used)


def _bounds(shared, ns: np.ndarray, ats: list[bytes], mosts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For each query its number and the upper bounds of the documents."""
    b: _Batch = shared.value
    sizes = np.array([len(a) // 2 for a in ats], np.int64)
    at = np.frombuffer(b"".join(ats), np.uint16).astype(np.int64)
    most = np.frombuffer(b"".join(mosts), np.uint16).astype(np.int64)
    norm = np.repeat(length_norm(ns, b.documents, b.n_terms), sizes)
    doc = np.repeat(np.arange(len(ns)), sizes)
    row = b.row_of[at]
    asked = row >= 0
    row, doc, most, norm = row[asked], doc[asked], most[asked], norm[asked]
    table = np.zeros((b.rows, len(ns)), np.int64)
    table[row, doc] = np.where(most == _MOST, SCALE // TF_FACTOR, impact(most, norm))
    for number, words, weights in b.queries:
        yield number, np.array(weights, np.int64) @ table[b.row_of[b.coordinate[words]]]


def _candidates(index: DataFrame, shared, floors: dict[int, int], first: int | None) -> DataFrame:
    """``key, q, bound`` of documents whose bound reaches the query's floor; with ``first`` only a task's highest ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        step = max(16, _CELLS // max(shared.value.rows, 1))

        def out(keys: np.ndarray, numbers: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(numbers, pa.int64()), pa.array(bounds, pa.int64())], ["key", "q", "bound"])

        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                keys = np.asarray(batch.column("key"))
                found = []
                for number, bounds in _bounds(shared, np.asarray(batch.column("n")), batch.column("at").to_pylist(), batch.column("most").to_pylist()):
                    mine = np.flatnonzero(bounds >= floors.get(number, 1))
                    if first is None:
                        found.append((keys[mine], np.full(len(mine), number), bounds[mine]))
                    elif len(mine):
                        old_keys, old_bounds = highest.get(number, (keys[:0], bounds[:0]))
                        all_keys, all_bounds = np.concatenate([old_keys, keys[mine]]), np.concatenate([old_bounds, bounds[mine]])
                        best = np.argsort(-all_bounds, kind="stable")[:first]
                        highest[number] = all_keys[best], all_bounds[best]
                if found:
                    yield out(*[np.concatenate(c) for c in zip(*found)])
        for number, (keys, bounds) in highest.items():
            yield out(keys, np.full(len(keys), number), bounds)

    found = map_slices(index.select("key", "n", "at", "most"), run, "key bigint, q bigint, bound bigint")
    if first is None:
        return found
    order = Window.partitionBy("q").orderBy(F.col("bound").desc(), "key")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= first).drop("place")


def _best(docs: DataFrame, candidates: DataFrame, shared, id_col: str, text_col: str, k: int) -> DataFrame:
    """``q, id, score``: exact scores of candidates, of each task the best ``k`` of each query."""
    asked = stored(candidates.groupBy("key").agg(F.collect_set("q").alias("asked")))
    small = asked.count() <= _BROADCAST_ROWS
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), text_or_empty(text_col).alias("text"))
    rows = rows.join(F.broadcast(asked) if small else asked, "key").select("id", "text", "asked")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: _Batch = shared.value
        queries = {number: (words, weights) for number, words, weights in b.queries}
        best: dict[int, list] = {}
        kind = None
        for batch in batches:
            kind = batch.column("id").type
            for one, text, numbers in zip(batch.column("id").to_pylist(), text_bytes(batch.column("text")), batch.column("asked").to_pylist()):
                terms = terms_of(text)
                tf, norm = Counter(terms), length_norm(len(terms), b.documents, b.n_terms)
                impacts = {b.places[t]: impact(tf[t], norm) for t in b.places.keys() & tf.keys()}
                for number in numbers:
                    words, weights = queries[number]
                    score = sum(w * impacts.get(i, 0) for i, w in zip(words, weights))
                    if score > 0:
                        best.setdefault(number, []).append((-score, one is None, 0 if one is None else one))
                        if len(best[number]) >= 4 * k + 64:
                            best[number] = heapq.nsmallest(k, best[number])
        found = [(number, None if none else one, -score) for number, all_ in best.items() for score, none, one in heapq.nsmallest(k, all_)]
        if found:
            numbers, ids, scores = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], ["q", "id", "score"])

    found = map_slices(rows, run, f"q bigint, id {id_type}, score bigint")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _query_batches(queries: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``q, item, text`` with a number for every row, and their number."""
    rows = queries.select(F.col(id_col).alias("item"), text_or_empty(text_col).alias("text"))
    numbered = stored(number_rows(rows, [F.col("item").asc_nulls_last(), "text"], "q"))
    return numbered, numbered.count()


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    batch_queries: int = BATCH_QUERIES,
    first_round: int = FIRST_ROUND,
    width: int = WIDTH,
) -> DataFrame:
    """The ``k`` rows of ``docs`` with the highest score above 0 for every row of ``queries``.

    Returns ``q`` (the number of the query's row), the item's id, ``rank`` from 1,
    the document's id and ``score``; equal scores are ordered by the document's
    id, rows without an id last. Repeated rows are ranked each for itself, as are
    repeated queries. Missing and empty texts have no words: such documents are
    never found and do not count, such queries find nothing. Queries are
    answered in batches of ``batch_queries``, one pass over the texts and two over
    the sketches each; the words of a batch are all that goes to the driver.
    """
    if not 0 < width <= 1 << 16:
        raise ValueError("coordinates are stored as 16-bit numbers")
    spark = docs.sparkSession
    numbered, total = _query_batches(queries, item_id, item_text)
    answers = []
    for start in range(0, total, batch_queries):
        texts = numbered.filter(F.col("q").between(start, start + batch_queries - 1)).select("q", "text").collect()  # a batch
        words = {r["q"]: Counter(terms_of(r["text"].encode())) for r in texts}
        terms = sorted({t for w in words.values() for t in w})
        if terms:
            answers.append(_answer(spark, docs, words, terms, k, doc_id, doc_text, first_round, width))
    id_type, item_type = docs.schema[doc_id].dataType.simpleString(), queries.schema[item_id].dataType.simpleString()
    if not answers:
        return spark.createDataFrame([], f"q bigint, `{item_id}` {item_type}, rank int, `{doc_id}` {id_type}, score bigint")
    found = answers[0]
    for a in answers[1:]:
        found = found.union(a)
    return numbered.select("q", F.col("item").alias(item_id)).join(found.withColumnRenamed("id", doc_id), "q").select(
        "q", item_id, F.col("rank").cast("int").alias("rank"), doc_id, "score"
    )


def _answer(spark: SparkSession, docs: DataFrame, words: dict[int, Counter], terms: list[bytes], k: int, doc_id: str, doc_text: str, first_round: int, width: int) -> DataFrame:
    """``q, id, score, rank`` of one batch of queries."""
    index = stored(sketch_index(docs, doc_id, doc_text, tuple(terms), width))
    documents, n_terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = [0] * len(terms)
    for r in index.select(F.explode("holds").alias("t")).groupBy("t").count().toLocalIterator():  # one row for each word of the batch
        holding[r["t"]] = r["count"]
    place = {t: i for i, t in enumerate(terms)}
    of_term = [term_weight(documents, h) for h in holding]
    asked = []
    for number, tf in words.items():
        # words that no document holds, or all, add nothing
        useful = [t for t in tf if holding[place[t]] and of_term[place[t]]]
        if useful:
            asked.append((number, [place[t] for t in useful], [tf[t] * of_term[place[t]] for t in useful]))
    shared = spark.sparkContext.broadcast(_Batch(asked, terms, documents, max(n_terms, 1), width))
    firsts = _best(docs, _candidates(index, shared, {}, first_round), shared, doc_id, doc_text, k)
    # the score of the k-th is a floor for all that follow; with fewer, every score above 0 counts
    floors = {r["q"]: r["score"] for r in firsts.filter(F.col("rank") == k).select("q", "score").toLocalIterator()}
    return stored(_best(docs, _candidates(index, shared, floors, None), shared, doc_id, doc_text, k))
