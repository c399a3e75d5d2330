"""Tokens, licenses, quality and archives against plain versions."""

import hashlib
import io
import random
import re
import zlib
from urllib.parse import unquote

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from entityloom.llm import bpe, licenses, quality, token_counts, warc
from tests.llm.conftest import TEXTS

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def counter():
    with open(MODEL, "rb") as f:
        return token_counts.Counter(f.read(), chunk=200, overlap=16)


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(RANKS)
    return bpe.Encoder(ranks, bpe.compile_ranks(ranks), public_tokenizers.PATTERN), bpe.Decoder(ranks)


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


# -- token counts ---------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "the", "\n", "é", "😀", "▁", "<s>", "ing ", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxx"]), max_size=400).map("".join))
def test_spliced_chunks_count_as_the_whole(counter, text):
    assert counter.count_huge(text) == len(counter._model.encode(text))


def test_overlap_is_widened_until_a_boundary_is_found(counter):
    for text in ["a" * 3000, "ab " + "x" * 900 + " tail " * 50, " " * 2000, "x" * 1000 + " y" + "z" * 2000]:
        assert counter.count_all([text, "short"]) == [len(counter._model.encode(text)), len(counter._model.encode("short"))]


def test_counts_of_odd_rows(odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = token_counts.count_tokens(odd_docs, MODEL, limit=100).collect()
    texts = [r.text or "" for r in odd_docs.select("text").collect()]
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(
        (len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 100) for t in texts
    )
    assert token_counts.count_tokens(no_docs, MODEL).count() == 0


# -- BPE ------------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=300))
def test_encoding_is_that_of_the_library(encoder, plain, text):
    ids = encoder[0].encode(text)
    assert list(ids) == plain.encode_ordinary(text)
    assert encoder[1].decode(list(ids)) == text


def test_long_pieces_and_forgotten_states(plain):
    ranks = bpe.read_ranks(RANKS)
    small = bpe.Transducer(ranks, bpe.compile_ranks(ranks), max_states=50)
    r = random.Random(5)
    pieces = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (1, 10, 4096, 4097, 20_000)] + ["a" * 9000]
    for piece in pieces:
        assert small.encode(piece.encode()) == plain.encode_ordinary(piece)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.integers(1, 7))
def test_stream_decoder_takes_any_cut(text, step):
    data, stream = text.encode(), bpe.Utf8Stream()
    assert "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.end() == text


def test_stream_decoder_marks_what_is_no_text():
    for data in (b"\xff", b"\xe6\xbc", b"a\xf0\x9f\x98", b"\x80\x80b"):
        stream = bpe.Utf8Stream()
        out = "".join(stream.feed(data[i : i + 1]) for i in range(len(data))) + stream.end()
        assert "�" in out


def test_round_trip_of_odd_rows(spark, odd_docs, no_docs, plain):
    codec = bpe.Codec(spark, RANKS, public_tokenizers.PATTERN)
    rows = codec.decode(codec.encode(odd_docs, keep=("doc_id", "text"), out="tokens"), "tokens", "again").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.tokens == plain.encode_ordinary(r.text or "") and r.again == (r.text or "")
    assert codec.decode(codec.encode(no_docs)).count() == 0
    once = codec.round_trip(odd_docs, keep=("doc_id", "text")).collect()
    assert sorted((str(r.text), r.ids, r.decoded) for r in once) == sorted((str(r.text), r.tokens, r.again) for r in rows)


# -- licenses -------------------------------------------------------------------------------------------------------


def _base(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())
    phrases = {tuple(p.encode().split()): label for p, label in licenses.BASE.items()}
    places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


LICENSED = [
    "MIT License, mit-license! MIT\nLICENSE mitlicense é mit license", "under the Apache License, Version 2.0", "GNU General Public License v3",
    "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy", "nothing here", "summit license",
]


def test_base_phrases_as_a_plain_search(spark, odd_docs, no_docs):
    texts = [*TEXTS, *LICENSED]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.license_summary(licenses.scan_licenses(docs)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _base(t or "")
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count() and licenses.scan_licenses(no_docs).count() == 0


def test_contained_detections_are_suppressed():
    rules = licenses.default_rules()
    assert len(rules) > 200 and len({r.name for r in rules}) == len(rules)
    scanner = licenses.Scanner(rules)
    kept = lambda t: sorted({d[2] for d in scanner.scan(t.encode())[1] if d[6] or d[5]})
    assert kept("Licensed under the Mozilla Public License 2.0") == ["mpl-2.0"]
    assert kept("See the Eclipse Public License") == ["epl"]
    assert kept("Apache License, Version 2.0") == ["apache", "apache-2.0"]  # the base label stays
    assert kept("SPDX-License-Identifier: MIT") == ["mit"]


def _samples(pattern):
    """All texts of a rule's pattern, repeats taken as few and as many times as they may."""

    def texts(parts):
        out = [""]
        for kind, value in parts:
            kind = str(kind)
            if kind == "LITERAL":
                more = [chr(value)]
            elif kind == "ANY":
                more = ["x"]
            elif kind == "IN":
                more = [chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])]
            elif kind == "BRANCH":
                more = [t for part in value[1] for t in texts(part)]
            elif kind == "SUBPATTERN":
                more = texts(value[3])
            else:
                assert kind in ("MAX_REPEAT", "MIN_REPEAT"), kind
                more = [t * n for n in {value[0], min(int(value[1]), 120)} for t in texts(value[2])]
            out = [a + b for a in out for b in dict.fromkeys(more)]
        return out

    return texts(re._parser.parse(pattern))


def test_every_rule_is_found_through_its_keyword():
    rules = licenses.default_rules()
    scanner = licenses.Scanner(rules)
    for rule in rules:
        samples = _samples(rule.pattern)
        assert all(rule.keyword in s for s in samples), rule
        for s in {samples[0], samples[-1], min(samples, key=len), max(samples, key=len)}:
            assert rule.name in {d[3] for d in scanner.scan(s.encode())[1]}, (rule, s)
    plain = "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004\n0. You just DO WHAT THE FUCK YOU WANT TO."
    assert "wtfpl" in {d[2] for d in scanner.scan(plain.encode())[1] if d[6]}


def test_suppression_against_all_pairs():
    scanner = licenses.Scanner(licenses.default_rules())
    r = random.Random(2)
    for _ in range(200):
        found = sorted({(a, a + r.randrange(1, 9), r.randrange(len(scanner._rules))) for a in (r.randrange(30) for _ in range(12))})
        rank = lambda f: scanner._rules[f[2]].rank

        def beaten(f, found=found):
            return any(
                g != f and g[0] <= f[0] and f[1] <= g[1] and (rank(g) < rank(f) or rank(g) == rank(f) and (g[:2] != f[:2] or g[2] < f[2])) for g in found
            )

        assert scanner._resolve(found) == [scanner._rules[f[2]].base or not beaten(f) for f in found]


# -- quality --------------------------------------------------------------------------------------------------------


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    x, bags, labels = rng.normal(size=(7, 5)), np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])
    w = {"encode": rng.normal(size=(5, 4)), "encode_bias": rng.normal(size=4), "view": rng.normal(size=(4, 3)), "gate": rng.normal(size=(4, 3)),
         "attend": rng.normal(size=3), "out": rng.normal(size=4), "out_bias": rng.normal(size=1)}

    def loss():
        z = quality._forward(x, bags, w)[0]
        return float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))

    for name, gradient in quality._gradients(x, bags, labels, w).items():
        for i in np.ndindex(w[name].shape):
            was = w[name][i]
            w[name][i] = was + 1e-5
            above = loss()
            w[name][i] = was - 1e-5
            below = loss()
            w[name][i] = was
            assert abs((above - below) / 2e-5 - gradient[i]) < 1e-6


def test_passages_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for t in TEXTS]
    together, bags = quality.passages(texts)
    for i, t in enumerate(texts):
        alone, own = quality.passages([t])
        assert own[-1] == bags[i + 1] - bags[i] == max(1, -(-len(re.findall(rb"[^ \t-\r]+", t)) // quality.PASSAGE_WORDS))
        assert np.allclose(alone, together[bags[i] : bags[i + 1]], atol=1e-5)


def test_long_texts_are_read_in_stretches(monkeypatch):
    text = " ".join(f"word{i}" for i in range(640)).encode()
    whole = quality.passages([b"a", text, b"b"])
    assert len(whole[0]) == 12
    monkeypatch.setattr(quality, "STRETCH", 1000)
    cut, bags = quality.passages([b"a", text, b"b"])
    assert bags[0] == 0 and bags[1] == 1 and bags[3] - bags[2] == 1 and 10 <= bags[2] - bags[1] < 25
    assert all(len(x) <= 1000 for x in quality._stretches(text)) and b"".join(quality._stretches(text)) == text
    assert len(quality.passages([b"x" * 5000])[0]) == 5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit_quality(docs, labels)
    scored = quality.score_quality(docs, model).select("*", quality.held_out().alias("held_out"))
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500
    assert all((r.doc_id is not None) and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted == 1 for r in rows if r.quality == 1]) > 0.98


def test_copies_of_one_document_leave_all_labels(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "train", lambda bags, labels: taken.append((len(bags), sorted(labels))))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:10]
    labels = spark.createDataFrame([(i, int(i == ids[-1])) for i in ids], "doc_id long, quality int")
    rows = [(ids[0], "the same text")] * 300 + [(i, f"text {i}") for i in ids]
    many = [(ids[0], f"text {k} of one id") for k in range(300)] + [(i, f"text {i}") for i in ids]
    for r in (rows, many):
        quality.fit_quality(spark.createDataFrame(r, "doc_id long, text string").coalesce(1), labels, max_labelled=10)
    assert taken == [(11, [0.0] * 10 + [1.0]), (40, [0.0] * 39 + [1.0])]


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(odd_docs, none)
    rows = quality.score_quality(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and {r.score for r in rows} == {0.5}
    one_class = spark.createDataFrame([(1, 1), (4, 1), (None, 0), (5, None)], "doc_id long, quality int")
    constant = quality.fit_quality(odd_docs, one_class)
    assert 0.5 < constant.constant < 1
    both = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    learned = quality.fit_quality(odd_docs, both)
    rows = quality.score_quality(odd_docs, learned, tuple(odd_docs.columns), out="__s", predicted="__p").collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["__s"] <= 1 and r["__p"] == (r["__s"] >= 0.7) for r in rows)
    assert quality.score_quality(no_docs, learned).count() == 0


# -- WARC -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [64, 1000, 50_000, 10**7])
def test_ranges_of_any_size_find_each_record_once(size):
    r = random.Random(3)
    payloads = [bytes(r.randrange(256) for _ in range(r.choice([0, 1, 50, 3000]))) if r.random() < 0.6 else b"ab\x1f\x8b\x08" * r.choice([0, 10, 30_000]) for _ in range(40)]
    digests = [hashlib.sha256(p).hexdigest() for p in payloads]
    data = b"".join(warc.record_bytes(str(i), "http://x/é y\r\nz", p, d, i % 5 == 4, "3") for i, (p, d) in enumerate(zip(payloads, digests)))
    data = data[:0] + b"\x1f\x8b\x08 no member \x1f\x8b" + data
    found = [warc.parse_record(*x) for s in range(0, len(data), size) for x in warc.records_of_range(io.BytesIO(data), s, min(s + size, len(data)), len(data))]
    assert [f["record_id"] for f in found] == [str(i) for i in range(40)]
    assert [(f["payload_digest"], f["payload_bytes"]) for f in found] == [(d, len(p)) for d, p in zip(digests, payloads)]
    assert all((f["payload"] is None) == (f["record_type"] == "revisit") for f in found)


def test_archive_of_odd_pages(spark, tmp_path):
    body = "<p>" + "same page " * 30
    pages = [(5, "http://a/ü", body), (2, None, body), (9, "http://b", body), (1, "u", ""), (3, "u", None), (4, "u", "short"), (6, "u", "short"),
             (2, None, body), (None, "n", body), (None, "m", "x" * 200), (7, "u", "y" * 99), (8, "u", "y" * 99), (10, "u", LONG_PAGE)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.write_archive(warc.mark_revisits(df.repartition(3)), f"file://{tmp_path}/w", file_bytes=400)
    assert manifest.agg({"records": "sum"}).first()[0] == len(pages) and manifest.count() > 3
    rows = warc.read_archive(manifest, range_bytes=100).collect()
    got = sorted((r.record_id or "", r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        again = html == body and i != 2
        want.append(("" if i is None else str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", "2" if again else None))
    assert got == sorted(want)
    listed = warc.read_archive(warc.archive_files(spark, f"file://{tmp_path}/w"), with_payload=False)
    assert listed.count() == len(pages)
    empty = warc.write_archive(warc.mark_revisits(df.limit(0)), f"file://{tmp_path}/e")
    assert empty.count() == 0 and warc.read_archive(empty).count() == 0


def test_archive_of_very_long_urls(spark, tmp_path):
    edge = warc._HEADER_BYTES
    urls = ["u" * (edge - 600 + 7 * i) for i in range(100)] + ["http://a/" + "é" * 50_000, "漢" * 400_000, "v" * 3_000_000]
    same = "<p>" + "same page " * 30
    pages = [(i, u, same if i % 2 else f"page {i}") for i, u in enumerate(urls)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.write_archive(warc.mark_revisits(df.repartition(2)), f"file://{tmp_path}/w")
    rows = warc.read_archive(manifest, range_bytes=5_000).collect()
    assert len(rows) == manifest.agg({"records": "sum"}).first()[0] == len(pages)
    assert {int(r.record_id): unquote(r.target_uri) for r in rows} == dict(enumerate(urls))
    assert {int(r.record_id): r.payload_bytes for r in rows} == {i: len(h) for i, _, h in pages}


def _gzip(data):
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def test_foreign_truncated_and_odd_records(spark, tmp_path):
    head = lambda kind, n, more="": f"WARC/1.0\r\nwarc-type: {kind}\r\nContent-Length: {n}\r\n{more}\r\n".encode()
    bodies = {"warcinfo": b"software: x\r\n\r\nmore", "metadata": b"a: b\r\n\r\nc", "resource": b"\xff\xfe\x00raw", "request": b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"}
    data = b"".join(_gzip(head(k, len(b)) + b + b"\r\n\r\n") for k, b in bodies.items())
    data += _gzip(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://\xe9/\r\nContent-Length: none\r\n\r\nabc")
    whole = _gzip(head("resource", 200_000) + random.Random(1).randbytes(200_000) + b"\r\n\r\n")
    short = _gzip(head("resource", 400) + random.Random(2).randbytes(400) + b"\r\n\r\n")
    for name, last in {"long": whole, "short": short}.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data + last[: len(last) - 100])
    for range_bytes in (1 << 24, 150):
        rows = warc.read_archive(warc.archive_files(spark, f"file://{tmp_path}"), range_bytes=range_bytes).collect()
        assert len(rows) == 12 and sum(r.truncated for r in rows) == 2
        got = {r.record_type: bytes(r.payload) for r in rows if not r.truncated and r.target_uri is None}
        assert got == bodies
        assert {bytes(r.payload) for r in rows if r.target_uri == "http://é/"} == {b"abc"}
        assert all(r.payload_digest == hashlib.sha256(bytes(r.payload)).hexdigest() for r in rows)


def test_a_reading_task_for_each_range(spark, tmp_path):
    df = spark.range(60).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 400) AS html")
    manifest = warc.write_archive(warc.mark_revisits(df.coalesce(1)), f"file://{tmp_path}/w")
    size = manifest.first()["bytes"]
    rows = warc.read_archive(manifest, range_bytes=size // 7 + 1)
    assert rows.count() == 60 and rows.rdd.getNumPartitions() == 7


LONG_PAGE = "<html>" + "".join(chr(33 + (i * i) % 90) for i in range(300_000))
