"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, and only the bag
has a label. Every passage is encoded from its bytes and words (which kinds of
characters follow each other, how words repeat, which words occur, hashed) by
a learned layer; gated attention weighs the passages, and the weighted sum of
their encodings is scored by a logistic output. Features of all texts of an
Arrow batch are computed at once on its bytes.

The fit takes at most ``max_labelled`` labelled documents, those whose ids have
the smallest hashes, and of a longer one ``fit_passages`` passages spread
evenly. Scoring reads every passage of every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import kept_with_text, map_batches, text_bytes, text_or_empty

PASSAGE_WORDS = 64
MAX_LABELLED = 4000
FIT_PASSAGES = 48
# Bytes of text whose features are computed at once.
STRETCH = 1 << 20

# Kinds of bytes: space, line end, a-z, A-Z, digit, full stop, comma, ! and ?, table marks, other ASCII marks, not ASCII, control.
_KINDS = 12


def _kinds() -> np.ndarray:
    kind = np.full(256, 11, np.int64)
    kind[33:127] = 9
    kind[128:] = 10
    kind[ord("a") : ord("z") + 1] = 2
    kind[ord("A") : ord("Z") + 1] = 3
    kind[ord("0") : ord("9") + 1] = 4
    for characters, k in ((b" \t", 0), (b"\n\r", 1), (b".", 5), (b",;:", 6), (b"!?", 7), (b"|<>{}[]()", 8)):
        kind[list(characters)] = k
    return kind


_KIND = _kinds()
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_WORD_BUCKETS = 64
N_FEATURES = _KINDS * _KINDS + _WORD_BUCKETS + 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _stretches(text: bytes) -> list[bytes]:
    """A text in stretches of about ``STRETCH`` bytes, cut before white space (or, in a longer word, anywhere)."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        cut = max(text.rfind(b" ", at + 1, at + STRETCH), text.rfind(b"\n", at + 1, at + STRETCH))
        cut = cut if cut > 0 else at + STRETCH
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def passages(texts: list[bytes], words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and for every text the number of its first one (one more at the end).

    A text without words has one passage without them. Very long texts are
    read in stretches, each of which begins a passage.
    """
    parts = [_stretches(t) for t in texts]
    flat = [x for p in parts for x in p]
    found, counts, at = [], [], 0
    while at < len(flat):
        upto, held = at + 1, len(flat[at])
        while upto < len(flat) and held + len(flat[upto]) <= STRETCH:
            held += len(flat[upto])
            upto += 1
        features, bags = _passages(flat[at:upto], words)
        found.append(features)
        counts.append(np.diff(bags))
        at = upto
    per_part = np.concatenate(counts)
    ends = np.cumsum([len(p) for p in parts])
    bags = np.concatenate(([0], np.cumsum(per_part)[ends - 1]))
    return np.concatenate(found), bags


def _passages(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    # a line end after every text keeps words of neighbours apart
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths)))
    space = _SPACES[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], ~space[:-1])))
    first_word = np.searchsorted(starts, begins)
    per_text = np.diff(first_word)
    bags = np.concatenate(([0], np.cumsum(np.maximum(1, -(-per_text // words)))))
    n = int(bags[-1])
    # the passage of every word, then of every byte (spaces go with the word before them)
    text_of_word = np.repeat(np.arange(len(texts)), per_text)
    passage_of_word = bags[:-1][text_of_word] + (np.arange(len(starts)) - first_word[:-1][text_of_word]) // words
    word_of_byte = np.cumsum(np.bincount(starts, minlength=len(data))) - 1
    own = np.repeat(first_word[:-1], lengths)
    passage_of_byte = np.repeat(bags[:-1], lengths)
    inside = word_of_byte >= own
    passage_of_byte[inside] = passage_of_word[word_of_byte[inside]]
    size = np.maximum(1, np.bincount(passage_of_byte, minlength=n)).astype(np.float64)
    kind = _KIND[data]
    pair = passage_of_byte[1:] * _KINDS**2 + kind[:-1] * _KINDS + kind[1:]
    together = np.ones(len(pair), bool)
    together[begins[1:-1] - 1] = False  # the last byte of a text and the first of the next
    pairs = np.bincount(pair[together], minlength=n * _KINDS**2)
    features = np.zeros((n, N_FEATURES))
    features[:, : _KINDS**2] = np.log1p(pairs[: n * _KINDS**2].reshape(n, -1) * (100.0 / size)[:, None])
    if len(starts):
        powers = np.full(len(data) + 1, _ODD)
        powers[0] = 1
        inverse = np.full(len(data) + 1, _ODD_INVERSE)
        inverse[0] = 1
        with np.errstate(over="ignore"):
            powers, inverse = np.cumprod(powers), np.cumprod(inverse)
            sums = np.concatenate(([np.uint64(0)], np.cumsum(data.astype(np.uint64) * powers[:-1])))
            hashes = (sums[ends] - sums[starts]) * inverse[starts] * np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(32)
        count = np.maximum(1, np.bincount(passage_of_word, minlength=n)).astype(np.float64)
        buckets = np.bincount(passage_of_word * _WORD_BUCKETS + (hashes % np.uint64(_WORD_BUCKETS)).astype(np.int64), minlength=n * _WORD_BUCKETS)
        at = _KINDS**2
        features[:, at : at + _WORD_BUCKETS] = np.sqrt(buckets.reshape(n, -1) / count[:, None])
        at += _WORD_BUCKETS
        same_passage = passage_of_word[1:] == passage_of_word[:-1]
        again = same_passage & (hashes[1:] == hashes[:-1])
        features[:, at] = np.bincount(passage_of_word[1:], weights=again, minlength=n) / count
        order = np.lexsort((hashes, passage_of_word))
        p, h = passage_of_word[order], hashes[order]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (h[1:] != h[:-1])))
        features[:, at + 1] = np.bincount(p, weights=new, minlength=n) / count
        features[:, at + 2] = np.log1p(np.bincount(passage_of_word, weights=ends - starts, minlength=n) / count)
        features[:, at + 3] = np.log1p(np.bincount(passage_of_word, minlength=n))
        features[:, at + 4] = np.bincount(passage_of_word, weights=kind[starts] == 3, minlength=n) / count
        features[:, at + 5] = np.bincount(passage_of_word, weights=kind[ends - 1] >= 7, minlength=n) / count
    return features.astype(np.float32), bags


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the output; ``constant`` where there was nothing to learn."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, features: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of every bag, and the attention of every passage."""
        if self.constant is not None:
            return np.full(len(bags) - 1, self.constant), np.ones(len(features))
        logits, _, attention, _, _, _ = _forward((features - self.mean) / self.scale, bags, self.weights)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30))), attention


def _forward(x: np.ndarray, bags: np.ndarray, w: dict[str, np.ndarray]):
    encoded = np.tanh(x @ w["encode"] + w["encode_bias"])
    view, gate = np.tanh(encoded @ w["view"]), 1 / (1 + np.exp(-(encoded @ w["gate"])))
    weight = (view * gate) @ w["attend"]
    starts, owner = bags[:-1], np.repeat(np.arange(len(bags) - 1), np.diff(bags))
    weight = np.exp(weight - np.maximum.reduceat(weight, starts)[owner])
    attention = weight / np.add.reduceat(weight, starts)[owner]
    pooled = np.add.reduceat(encoded * attention[:, None], starts, axis=0)
    return pooled @ w["out"] + w["out_bias"][0], encoded, attention, pooled, view, gate


def _gradients(x, bags, labels, w):
    logits, encoded, attention, pooled, view, gate = _forward(x, bags, w)
    owner = np.repeat(np.arange(len(bags) - 1), np.diff(bags))
    error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
    d_pooled = error[:, None] * w["out"]
    d_encoded = attention[:, None] * d_pooled[owner]
    d_attention = np.einsum("ij,ij->i", encoded, d_pooled[owner])
    inner = np.add.reduceat(attention * d_attention, bags[:-1])
    d_weight = attention * (d_attention - inner[owner])
    gated = view * gate
    d_gated = d_weight[:, None] * w["attend"]
    d_view, d_gate = d_gated * gate * (1 - view**2), d_gated * view * gate * (1 - gate)
    d_encoded += d_view @ w["view"].T + d_gate @ w["gate"].T
    d_sum = d_encoded * (1 - encoded**2)
    return {
        "encode": x.T @ d_sum, "encode_bias": d_sum.sum(0), "view": encoded.T @ d_view, "gate": encoded.T @ d_gate,
        "attend": gated.T @ d_weight, "out": pooled.T @ error, "out_bias": np.array([error.sum()]),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 15, width: int = 24, depth: int = 12, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit by Adam over batches of bags; ``bags`` holds the passages of each document."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(0), np.ones(0), {}, float(share))
    rng = np.random.default_rng(seed)
    together = np.concatenate(bags)
    mean, scale = together.mean(0), together.std(0) + 0.05
    n = together.shape[1]
    w = {
        "encode": rng.normal(0, n**-0.5, (n, width)), "encode_bias": np.zeros(width), "view": rng.normal(0, width**-0.5, (width, depth)),
        "gate": rng.normal(0, width**-0.5, (width, depth)), "attend": rng.normal(0, depth**-0.5, depth),
        "out": rng.normal(0, width**-0.5, width), "out_bias": np.array([np.log(share / (1 - share))]),
    }
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            x = (np.concatenate([bags[i] for i in chosen]) - mean) / scale
            places = np.concatenate(([0], np.cumsum([len(bags[i]) for i in chosen])))
            step += 1
            for k, g in _gradients(x, places, labels[chosen], w).items():
                g = g + decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean.astype(np.float32), scale.astype(np.float32), w)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no label may be learned from: crc32 of the id as text leaves 2 modulo 4. A missing id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_labelled: int = MAX_LABELLED, fit_passages: int = FIT_PASSAGES,
) -> Model:
    """Learn from the labelled rows that are not held out.

    The driver gets the passages of at most ``max_labelled`` documents, at
    most ``fit_passages`` of each. Rows of ``labels`` without id or label are
    left out. Without any label, or with one class only, the model is that
    class's smoothed share.

    Rows alike in id and text are one example. Different texts with one id are
    examples of their own up to ``4 * max_labelled`` in all: the first text of
    every chosen label, then the second ones, and so on, by the texts' hashes.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull())
        .filter(~held_out("id"))
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(max_labelled)
    )
    # at most max_labelled rows of two numbers
    met = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "id")
    hashed = met.withColumn("copy", F.sha2(F.col("text").cast("binary"), 256))
    turn = F.row_number().over(Window.partitionBy("id", "label").orderBy("copy")).alias("turn")
    examples = hashed.select("id", "label", "copy").distinct().select("*", turn)
    taken = examples.orderBy("turn", F.xxhash64("id"), "id", "label").limit(4 * max_labelled).drop("turn")
    rows = hashed.join(F.broadcast(taken), ["id", "label", "copy"]).dropDuplicates(["id", "label", "copy"]).select("id", "text", "label")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, bags = passages(text_bytes(batch.column("text")))
        packed = []
        for a, b in zip(bags[:-1], bags[1:]):
            spread = np.unique(np.linspace(a, b - 1, min(fit_passages, b - a)).round().astype(np.int64))
            packed.append(features[spread].astype(np.float16).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(packed, pa.binary())], ["id", "label", "features"])

    id_type = rows.schema["id"].dataType.simpleString()
    sample = map_batches(rows, run, f"id {id_type}, label double, features binary").toArrow()
    order = sorted(range(sample.num_rows), key=lambda i: (sample["id"][i].as_py(), sample["features"][i].as_py(), sample["label"][i].as_py()))
    bags = [np.frombuffer(sample["features"][i].as_py(), np.float16).reshape(-1, N_FEATURES).astype(np.float64) for i in order]
    targets = np.array([float(sample["label"][i].as_py() >= 0.5) for i in order])
    return train(bags, targets)


def score_quality(
    docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", out: str = "score", threshold: float = 0.7,
    predicted: str = "predicted",
) -> DataFrame:
    """The ``keep`` columns, the score of every whole text (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    A missing or empty text is scored like any other, as one passage without
    words. Every row gives one row; an empty table gives an empty result. The
    model, a few thousand numbers, is sent along with the tasks.
    """
    rows = kept_with_text(docs, keep, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, _ = model.score(*passages(text_bytes(batch.column(1))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["kept", "score"])

    kept = rows.schema["kept"].dataType.simpleString()
    scored = map_batches(rows, run, f"kept {kept}, score double")
    return scored.select(
        *[F.col("kept")[c].alias(c) for c in keep], F.col("score").alias(out), (F.col("score") >= threshold).cast("int").alias(predicted)
    )
