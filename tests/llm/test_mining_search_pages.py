"""Collocations, page differencing and ranked search against plain versions."""

import math
import random
import re
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entityloom.llm import collocations, page_text, ranked_search
from tests.llm.conftest import CLASHES


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _plain_collocations(docs, least, top, longest=3):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    for (lang, p), a in found.items():
        inside = any(q[0] == lang and len(q[1]) > len(p) and 100 * b >= 50 * a and any(q[1][i : i + len(p)] == p for i in range(len(q[1]))) for q, b in found.items())
        if not inside:
            score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    seen = Counter()
    ranked = []
    for row in out:
        seen[row[0]] += 1
        if seen[row[0]] <= top:
            ranked.append((row[0], seen[row[0]], *row[1:]))
    return sorted(ranked)


@pytest.mark.parametrize("small", [False, True])
def test_collocations_against_counting_all(spark, monkeypatch, small, no_docs):
    if small:  # rows that overlap, a crowded bitmap, and tasks that hand on early
        for name, value in {"ROW_PLACES": 4, "MAX_BITS": 1 << 15, "BITS_PER_GROUP": 1, "HELD_WORDS": 3, "HELD_PHRASES": 3, "HELD_GROUPS": 3, "HELD_OCCURRENCES": 5}.items():
            monkeypatch.setattr(collocations, name, value)
    r = random.Random(4)
    pool = ["New", "york", "city", "a", "b", "ünï", "漢字", "x\x0cy", "c."]
    docs = [(r.choice(["en", "de", None, ""]), "".join(r.choice(pool) + r.choice([" ", "  ", "\t", ", ", "\n"]) for _ in range(r.randrange(0, 60)))) for _ in range(60)]
    docs += [("en", None), ("en", ""), (None, None), ("en", "a " * 200)] + [docs[0]] * 3
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "lang string, text string, f int, phrase string").repartition(3)
    rows = collocations.collocations(df, min_count=4, top=15).collect()
    assert sorted((x.lang, x["rank"], x.phrase, x.a, x.l, x.r, x.n, x.score) for x in rows) == _plain_collocations(docs, 4, 15)
    if not small:
        assert collocations.collocations(no_docs).count() == 0


def test_two_phrases_with_one_hash_stay_apart():
    import numpy as np
    import pyarrow as pa

    held = collocations._Phrases()

    def texts_at(*texts):
        return pa.array(texts, pa.large_string()).take

    def told(others):
        return [(t, n) for texts, counts in others for t, n in zip(texts.to_pylist(), counts.tolist())]

    key = np.array([7, 7, 7, 9], np.uint64)
    others = held.add(key, np.array([1, 2, 1, 3], np.uint64), lambda i: texts_at("a b", "c d", "a b", "e f")(pa.array(i)))
    assert told(others) == [("c d", 1)]
    others = held.add(key[:2], np.array([2, 2], np.uint64), lambda i: texts_at("c d", "c d")(pa.array(i)))
    assert told(others) == [("c d", 2)]
    held.add(np.array([8], np.uint64), np.array([5], np.uint64), lambda i: texts_at("g h")(pa.array(i)))
    texts, counts = held.all()
    assert list(zip(texts.to_pylist(), counts.tolist())) == [("a b", 2), ("e f", 1), ("g h", 1)]


def test_phrases_of_all_lengths_and_languages_are_bounded_together(monkeypatch):
    r = random.Random(5)
    rows = [(lang, " ".join(f"w{r.randrange(60)}" for _ in range(40))) for lang in ("a", "b", "c", "d") for _ in range(30)]
    most, alive, add = [], weakref.WeakSet(), collocations._Phrases.add

    def noted(self, *args):
        others = add(self, *args)
        alive.add(self)
        most.append(sum(len(p.keys) for p in alive))
        return others

    monkeypatch.setattr(collocations._Phrases, "add", noted)
    monkeypatch.setattr(collocations, "HELD_PHRASES", 1500)

    class Value:
        value = collocations._Bitmap(np.full(8, 255, np.uint8))

    class Made(Exception):
        pass

    found = []

    def grab(df, function, *args):
        found.append(function)
        raise Made

    # the pass over the texts as a task runs it, each row a batch
    monkeypatch.setattr(collocations, "_texts", lambda *args: None)
    monkeypatch.setattr(collocations, "map_slices", grab)
    with pytest.raises(Made):
        collocations._exact(None, "lang", "text", [Value, Value, Value])
    batches = (pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([text])], ["lang", "text"]) for lang, text in rows)
    counts = Counter()
    for out in found[0](batches):
        for lang, phrase, size, n in zip(*(out.column(i).to_pylist() for i in range(4))):
            counts[lang, phrase, size] += n
    plain = Counter((lang, " ".join(w[i : i + k]), k) for lang, text in rows for w in [text.split()] for k in (2, 3) for i in range(len(w) - k + 1))
    assert counts == plain
    # a batch may go beyond the bound by its own phrases
    assert max(most) <= 1500 + 39 + 38


def test_words_of_many_texts_are_those_of_each():
    texts = ["", "  ", "A b,c\x0cd", "É\u00a0x\u2003y \x1cq", "a.b\t.", "\n", "z"]
    plain = [re.findall(r"[^\x20\x09]+", re.sub(r"[.,;:!?\x0A-\x0D]", " . ", _lower(t))) for t in texts]
    said = collocations.words_of([t.encode() for t in texts]).to_pylist()
    assert [w for w in said if w != "."] == [w for words in plain for w in words if w != "."]
    pieces = " ".join(said).split(".")
    assert [p.strip(" ") for p in pieces if p.strip(" ")] == ["a b", "c", "d", "É\u00a0x\u2003y \x1cq", "a", "b", "z"]


# -- pages ----------------------------------------------------------------------------------------------------------


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 20])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(page_text, "_TABLE_BITS", bits)
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(5) for _ in range(r.randrange(0, 14))] for _ in range(2))
        at = page_text.common_lines(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at) and at == sorted(set(at)) and len(at) == _lcs(a, b)


def test_lines_of_odd_markup():
    text = lambda h: " ".join(page_text.main_lines(page_text.page_lines(h)))
    assert text("<head><title>t</title><body><header>h</header><main><h1>A&amp;B</h1><p>one\n two<br>three<p>four &lt;i&gt;</main><footer>f") == "A&B one two three four <i>"
    assert text("<article><p>x<b>y</b>z<script>if (a</b) {'</p>'}</script></p><aside>no</aside><div class='Comments-list'><p>no</div><form>no</form>w</article>out") == "xyz w"
    assert text("<div class=\"cookie-notice\"><p>no</div><p>yes <a href='x'>link</a></p><div hidden>no</div>") == "yes link"
    assert text("") == "" and text("no markup at < all &nbsp; &#233;") == "no markup at < all é" and text("<p") == "<p" and text("<!-- a --><style>b") == ""
    assert text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"


def test_shared_lines_go_where_no_element_marks_content(spark, monkeypatch):
    monkeypatch.setattr(page_text, "_WINDOW", 2)
    frame = lambda i, body: f"<div>Site name</div><div>Home</div><p>{body}</p><p>own words of {i}</p><div>All rights</div>"
    pages = [(i, f"http://{'a' if i < 6 else 'b'}.org/x/{i}?q", frame(i, f"text {i}")) for i in range(12)]
    pages += [(20, "https://a.org/x/2", frame(2, "text 2")), (21, "http://c.org/", frame(21, "alone")), (22, None, None), (23, "http://a.org/x/1", "")]
    pages += [(24, f"http://a.org/y", "<article><p>Site name</p><p>quoted</p></article>"), pages[0]]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, text string").repartition(3)
    rows = page_text.main_text(df, keep=("page_id", "url"), out="main").collect()
    got = {r.page_id: r.main for r in rows}
    assert len(rows) == len(pages)
    assert all(got[i] == f"text {i} own words of {i}" for i in range(12)) and got[20] == got[2]
    assert got[21] == "Site name Home alone own words of 21 All rights" and got[22] == got[23] == "" and got[24] == "Site name quoted"
    assert page_text.main_text(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        page_text.main_text(df, keep=("text",))


# -- search ---------------------------------------------------------------------------------------------------------


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))


def _plain_search(docs, items, k):
    bags = [(i, Counter(_terms(t))) for i, t in docs]
    n, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    out = []
    for q, text in items:
        scores = []
        for i, b in bags:
            score = 0
            for t in _terms(text):
                if b[t]:
                    df = sum(t in c for _, c in bags)
                    m = 25 + (75 * sum(b.values()) * n) // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("width, first, batch", [(1 << 14, 32, 512), (4, 1, 3)])
def test_search_against_scoring_all(spark, odd_docs, no_docs, width, first, batch):
    # four coordinates: bounds of little use, the same answer
    r = random.Random(8)
    words = ["Alpha", "beta", "naïve", "漢字", "x1", "_", "w3", "w4", "words", "one"]
    more = [(100 + i, " ".join(r.choice(words) for _ in range(r.randrange(1, 12)))) for i in range(40)]
    docs = odd_docs.select("doc_id", "text", *CLASHES).unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    items = [(1, "alpha BETA beta"), (2, "w3 w4 one"), (3, None), (4, "-- !"), (5, "unknownword"), (None, "naïve 漢字"), (1, "alpha BETA beta")]
    queries = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int")
    rows = ranked_search.search(docs, queries, k=5, first_round=first, batch_queries=batch, width=width).collect()
    plain = [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]
    assert Counter((x.item_id, x["rank"], x.doc_id, x.score) for x in rows) == _plain_search(plain, items, 5)
    if first == 32:
        assert ranked_search.search(no_docs, queries).count() == 0 == ranked_search.search(docs, queries.limit(0)).count()
