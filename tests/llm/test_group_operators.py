"""Near-duplicates, fingerprints, line runs and mixing against plain versions."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from entityloom.llm import embedding_dedup, fingerprints, line_dedup, mixing, simhash_balls
from entityloom.llm.common import stored
from entityloom.llm.components import _large_star, _small_star, _smallest, components
from tests.llm.conftest import LONG, TEXTS


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# -- components -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(-50, 400), r.randrange(-50, 400)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5060)] + [(7, 7)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    rows = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert len({x.node for x in rows}) == len(rows)
    assert {x.node: x.root for x in rows} == {n: u.find(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_is_split_by_adaptive_execution(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        low, high = F.col("id") + 1, F.lit(10**9)
        for hub in (F.lit(0), high):
            edges = stored(spark.range(0, 100_000, 1, 8).select(F.greatest(low, hub).alias("a"), F.least(low, hub).alias("b")))
            star = (_large_star if hub is not high else _small_star)(edges, _smallest(edges))
            star.collect()
            assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()
        chain = spark.range(0, 2000).selectExpr("id + 1 AS a", "id AS b")
        assert components(chain.union(spark.range(1, 50_000).selectExpr("1000", "id + 5000"))).agg(F.max("root"), F.count("*")).first() == (0, 52_000)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_spent_rounds_are_deleted(spark):
    folder = spark.sparkContext.getCheckpointDir() or stored(spark.range(1)).inputFiles()[0].rsplit("/", 2)[0]
    stages = lambda: {x for x in os.listdir(folder.removeprefix("file:")) if x.startswith("stage-")}
    edges = stored(spark.range(0, 60).selectExpr("id + 1 AS a", "id AS b"))
    before = stages()
    out = components(edges)
    assert len(stages() - before) == 1 and before <= stages() and out.count() == 61


# -- ball hashing ---------------------------------------------------------------------------------------------------


def _print_of(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_the_letter():
    for text in [t for t in TEXTS if t != LONG]:
        assert simhash_balls.fingerprint((text or "").encode()) == _print_of(text)


@pytest.mark.parametrize(("radius", "bits"), [(4, 8), (2, 8), (4, 13), (0, 8)])
def test_all_links_within_the_radius(spark, monkeypatch, radius, bits):
    monkeypatch.setattr(simhash_balls, "MIN_BUCKET_BITS", bits)
    monkeypatch.setattr(simhash_balls, "_SLICE_VARIANTS", 3000)
    r = random.Random(radius)
    centres = [r.getrandbits(64) for _ in range(12)]
    values = [0, (1 << 64) - 1]
    for c in centres:
        for _ in range(15):
            v = c
            for b in r.sample(range(64), r.randrange(0, 8)):
                v ^= 1 << b
            values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    ids = list(range(len(values)))
    u = Union()
    for i in ids:
        for j in ids[:i]:
            if (values[i] ^ values[j]).bit_count() <= radius:
                u.join(i, j)
    df = spark.createDataFrame([*zip(ids, signed, ["z"] * len(ids)), (900, None, "z")], "doc_id long, fp long, node string")
    rows = simhash_balls.near_groups(df, radius).collect()
    assert {x.doc_id: x.component_id for x in rows} == {**{i: u.find(i) for i in ids}, 900: 900}


def test_groups_of_odd_rows(odd_docs, no_docs):
    rows = simhash_balls.near_groups(simhash_balls.with_fingerprints(odd_docs, tuple(odd_docs.columns), out="__f"), fp_col="__f").collect()
    assert len(rows) == odd_docs.count()
    by_print = defaultdict(list)
    for r in rows:
        assert r["__f"] % (1 << 64) == _print_of(r.text)
        by_print[r["__f"]].append(r)
    for group in by_print.values():
        assert len({r.component_id for r in group}) == 1
    blank = {r.component_id for r in rows if not (r.text or "").split()}
    assert blank == {1}  # documents 1 to 3 and one without id
    assert simhash_balls.near_groups(simhash_balls.with_fingerprints(no_docs)).count() == 0
    with pytest.raises(ValueError):
        simhash_balls.ball_links(simhash_balls.with_fingerprints(no_docs), radius=3)


# -- native fingerprints --------------------------------------------------------------------------------------------


def _native(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    votes = [0] * 64
    for i, w in enumerate(words):
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        if i + 1 < len(words):
            h = xxhash.xxh64_intdigest(words[i + 1].encode(), seed=h)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


@pytest.mark.parametrize("bucket_rows", [3, 256])
def test_edited_fingerprints(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", bucket_rows)
    docs = {7 * i * i - 40: t for i, t in enumerate(TEXTS)}
    ids = sorted(docs, reverse=True)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, bucket string").repartition(4)
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    assert len(rows) == len(ids)
    for k, i in enumerate(ids):
        text, after = docs[i] or "", docs[ids[(k + 1) % len(ids)]] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint % (1 << 64), r.edited_fingerprint % (1 << 64)) == (_native(text), _native(edited))
        assert r.near_edited == 1 - (_native(text) ^ _native(edited)).bit_count() / 64
        assert r.near_next == 1 - (_native(text) ^ _native(after)).bit_count() / 64


def test_edited_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints.edited_fingerprints(odd_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.select("doc_id").collect())
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    single = fingerprints.edited_fingerprints(odd_docs.filter("doc_id = 13")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_block_tables_find_all_within_the_radius(spark):
    r = random.Random(4)
    centres = [r.getrandbits(64) for _ in range(10)]
    values = [c ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 6))) for c in centres for _ in range(20)] * 2
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in [*signed, None]], "fingerprint long")
    for radius in (0, 3, 5):
        got = {x.fingerprint: x.n_near for x in fingerprints.count_near(df, df, radius).collect()}
        assert got == {s: sum((v ^ w).bit_count() <= radius for w in values) for s, v in zip(signed, values)}


# -- embeddings -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("block", "chunk", "small"), [(40, 3000, 8), (2048, 1 << 22, 4), (2048, 1 << 22, 96), (2048, 1, 1 << 20)])
def test_vectors_against_all_pairs(spark, monkeypatch, block, chunk, small):
    monkeypatch.setattr(embedding_dedup, "BLOCK_VECTORS", block)
    monkeypatch.setattr(embedding_dedup, "_CHUNK_BYTES", chunk)
    monkeypatch.setattr(embedding_dedup, "_SMALL", small)
    monkeypatch.setattr(embedding_dedup, "_SLICE_PAIRS", 500)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    near = [c + rng.normal(scale=0.18, size=24) for c in centres for _ in range(30)]
    vectors = [v.tolist() for v in [*near, *rng.normal(size=(60, 24))]]
    vectors += [vectors[0]] * 3 + [[2 * x for x in vectors[1]], [x * 1e200 for x in vectors[2]]]
    ids = list(range(100, 100 + len(vectors)))
    odd = [(1, None), (2, []), (3, [0.0] * 24), (4, [1.0, None]), (5, [float("nan")] * 24), (6, [float("inf")] + [1.0] * 23), (7, vectors[0][:20]), (7, vectors[0][:20]), (None, vectors[0])]
    df = spark.createDataFrame([*zip(ids, vectors), *odd], "vec_id long, embedding array<double>").withColumn("node", F.lit("x"))
    rows = embedding_dedup.near_vectors(df).collect()
    assert len(rows) == len(ids) + len(odd)
    known = [*zip(ids, vectors), (10_000, vectors[0])]
    u = np.array([np.array(v) / max(map(abs, v)) for _, v in known])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = u @ u.T >= 0.95
    union = Union()
    for a, b in zip(*np.nonzero(links)):
        union.join(known[a][0], known[b][0])
    got = {r.vec_id: r for r in rows}
    found = sum(got[i].n_links for i in ids)
    wanted = sum(int(links[k].sum()) - 1 for k in range(len(ids)))
    assert wanted > 1000 and found >= 0.99 * wanted  # only what is at the threshold may be missed
    for k, i in enumerate(ids):
        assert got[i].n_links <= links[k].sum() - 1
        assert got[i].component_id == union.find(i) and got[i].kept == (union.find(i) == i)
    for i in range(1, 7):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[7].n_links, got[7].component_id) == (1, 7)
    assert got[None].component_id == union.find(100) and not got[None].kept
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


# -- lines ----------------------------------------------------------------------------------------------------------


def _runs(docs, min_words):
    """Deleted lines by looking at every run of every length."""
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    gone = {i: set() for i, _ in order}
    for n in range(1, 1 + max(len((t or "").split("\n")) for _, t in order)):
        seen = set()
        for i, text in order:
            lines = (text or "").split("\n")
            for p in range(len(lines) - n + 1):
                run = tuple(lines[p : p + n])
                words = sum(len(re.findall(r"[^ \t\n\x0b\f\r]+", x)) for x in run)
                if run in seen and words >= min_words:
                    gone[i] |= set(range(p, p + n))
                seen.add(run)
    return {i: ("\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in gone[i]), len(gone[i])) for i, t in order}


@pytest.mark.parametrize("min_words", [1, 3, 6])
def test_line_runs_against_all_windows(spark, min_words):
    r = random.Random(min_words)
    pool = ["alpha beta gamma delta", "short", "", "two words", "one two three", "é ü ö"]
    docs = [(i, "\n".join(r.choice(pool) if r.random() < 0.7 else f"own line {i} {j}" for j in range(r.randrange(0, 14)))) for i in range(40)]
    docs += [(50, None), (51, docs[3][1]), (52, docs[3][1] + "\ntail of it"), (None, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("g", F.lit(1)).repartition(3)
    rows = line_dedup.without_repeated_lines(df, min_words=min_words).collect()
    assert {x.doc_id: ((x.dedup.text or ""), x.dedup.n_removed) for x in rows} == _runs(docs, min_words)


def test_maximal_runs_of_short_lines(spark):
    docs = [(i, f"own {i} start of it\nalpha\nbeta\ngamma\nown {i} end of it") for i in range(3)]
    docs += [(10, "a\n\n\nb\n\n\nc x\n" * 3 + "q"), (11, "z\n\nb\n\n\nc x\n\nd"), (12, "one two three\n\n\nk"), (13, "one two three\n\n\nl")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {x.doc_id: (x.dedup.text, x.dedup.n_removed) for x in line_dedup.without_repeated_lines(df).collect()}
    assert rows == _runs(docs, 3)
    assert rows[1] == ("own 1 start of it\nown 1 end of it", 3) and rows[0][1] == 0 and rows[13] == ("l", 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_lines_meet_their_class_by_broadcast(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "_HOT", 5)
    monkeypatch.setattr(line_dedup, "_HOT_SHARE", 1 << 60)
    r = random.Random(seed)
    docs = [(i, "\n".join(r.choice(["", "a", "b c", "", f"u{i}{j}"]) for j in range(r.randrange(1, 24)))) for i in range(30)]
    rows = line_dedup.without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: ((x.dedup.text or ""), x.dedup.n_removed) for x in rows} == _runs(docs, 3)


def test_line_runs_of_odd_rows(odd_docs, no_docs):
    rows = line_dedup.without_repeated_lines(odd_docs, out="dedup").collect()
    assert len(rows) == odd_docs.count()
    assert len({r.dedup for r in rows if r.doc_id == 0}) == 1  # rows alike in all columns are one document
    assert [r.dedup.n_removed for r in rows if r.doc_id == 5] == [2]
    assert [r.dedup.text for r in rows if r.doc_id == 7] == [TEXTS[7]] and [r.text for r in rows if r.doc_id == 2] == [None]
    assert line_dedup.without_repeated_lines(no_docs).count() == 0


# -- mixing ---------------------------------------------------------------------------------------------------------


def _mix_docs(spark):
    r = random.Random(9)
    rows = [(i, " ".join(["w"] * r.randrange(0, 60)), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    return spark.createDataFrame([*rows, (5000, "none of it", None), (5001, "", "empty"), (5002, None, "empty")], "doc_id long, text string, source string")


def _taken(docs, plan):
    rows = mixing.with_copies(docs, plan).collect()
    words = defaultdict(int)
    for r in rows:
        words[r.source] += r.mix.copies * len((r.text or "").split())
    return rows, words


def test_repetition_limit(spark):
    docs = _mix_docs(spark)
    plan = mixing.mixing_plan(docs, max_repeats=2.0).cache()
    rows, words = _taken(docs, plan)
    assert len(rows) == docs.count() and {r.mix.copies for r in rows} == {1, 2}
    longest = 60
    for p in plan.collect():
        assert p.words <= p.target <= 2 * p.words + 1 or p.words == 0
        assert p.target - longest < words[p.source] <= p.target or p.words == 0
    assert abs(sum(p.weight for p in plan.collect()) - 1) < 1e-9
    hot = next(p for p in plan.collect() if p.source == "hot")
    assert hot.target == hot.words  # no document is lost
    assert mixing.mixed(docs, plan).count() == sum(r.mix.copies for r in rows)
    placed = mixing.mixed(docs, plan, places=True)
    assert placed.columns == [*docs.columns, "mix_epoch", "mix_place"] and placed.filter("mix_epoch > 1").count() == 0


def test_budget_and_entropy(spark):
    docs = _mix_docs(spark)
    total = sum(len((r.text or "").split()) for r in docs.collect())
    plan = mixing.mixing_plan(docs, max_repeats=None, target_entropy=1.9, budget=total // 2).cache()
    parts = [p for p in plan.collect() if p.weight > 0]
    entropy = -sum(p.weight * np.log(p.weight) for p in parts)
    assert 1.9 <= entropy < 1.9001
    _, words = _taken(docs, plan)
    assert all(p.target - 60 < words[p.source] <= p.target for p in parts)
    natural = mixing.mixing_plan(docs, max_repeats=None, target_entropy=0.1).collect()
    assert all(abs(p.exponent - 1) < 1e-9 for p in natural)
    flat = mixing.mixing_plan(docs, max_repeats=None, target_entropy=99.0).collect()
    assert all(p.exponent == 0 for p in flat)


def test_mix_of_odd_rows(odd_docs, no_docs):
    plan = mixing.mixing_plan(odd_docs)
    rows = mixing.with_copies(odd_docs, plan).collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) == set(rows[0].asDict())
    assert len({r.mix.copies for r in rows if r.doc_id == 0}) == 1
    assert mixing.mixed(no_docs, mixing.mixing_plan(no_docs)).count() == 0
