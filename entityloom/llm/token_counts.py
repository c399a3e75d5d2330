"""Token counts with a SentencePiece model; huge texts in overlapping chunks.

A text of more than ``chunk`` characters is encoded in chunks that overlap.
Two neighbours are spliced at a boundary where both encodings begin a piece and
that is proven stable: the character before it is no space, the one after it
is one, and no piece of the vocabulary has a word separator behind another
symbol, so no merge can cross the place whatever stands around it. If an
overlap holds no such boundary, it is widened, twice as long each time, and in
the end the chunks are joined: a text without any space is encoded whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import map_batches, per_worker, text_or_empty

CHUNK = 16_384
OVERLAP = 512
_SPACE = "▁"


class Counter:
    """Counts the pieces of texts; ``model`` is the serialised SentencePiece model."""

    def __init__(self, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._chunk, self._overlap = chunk, min(overlap, max(1, chunk // 2))
        # splicing is proven only for vocabularies whose separators lead their pieces
        self._splits = not any(
            _SPACE in self._model.id_to_piece(i).lstrip(_SPACE) for i in range(self._model.vocab_size())
        ) and self._keeps_characters()

    def _keeps_characters(self) -> bool:
        """Whether offsets speak of the text itself: no character is folded or dropped."""
        probe = "a  b ﬁｆ é① "
        ends = [end for _, end in self._offsets(probe)]
        return bool(ends) and ends[-1] == len(probe) and "".join(self._model.encode(probe, out_type=str)).count(_SPACE) == 1 + probe.count(" ")

    def _offsets(self, text: str) -> list[tuple[int, int]]:
        return self._model.encode([text], return_type="offset_mapping", num_threads=1)[0]["offsets"]

    def count_all(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if len(t) <= self._chunk]
        counts = iter([len(x) for x in self._model.encode(short, num_threads=1)] if short else [])
        return [next(counts) if len(t) <= self._chunk else self.count_huge(t) for t in texts]

    def _begins(self, text: str, start: int, end: int) -> list[int]:
        """Where pieces of the chunk begin, as places of the whole text."""
        return [start + b for b, _ in self._offsets(text[start:end])]

    def count_huge(self, text: str) -> int:
        if not self._splits:
            return len(self._model.encode(text))
        total, cut, start, end = 0, 0, 0, self._chunk
        begins = self._begins(text, start, end)
        while end < len(text):
            overlap, spliced = self._overlap, False
            while not spliced and end - overlap > cut:
                right_start, right_end = end - overlap, min(len(text), end - overlap + max(self._chunk, 2 * overlap))
                right = self._begins(text, right_start, right_end)
                splice = self._common(text, set(begins), set(right), right_start, end)
                if splice is not None:
                    total += sum(cut <= b < splice for b in begins)
                    cut, start, end, begins, spliced = splice, right_start, right_end, right, True
                overlap *= 2
            if not spliced:  # no boundary in all of the chunk: it and the next become one
                end = min(len(text), end + (end - start))
                begins = self._begins(text, start, end)
        return total + sum(b >= cut for b in begins)

    @staticmethod
    def _common(text: str, left: set[int], right: set[int], low: int, high: int) -> int | None:
        """The last stable boundary of both encodings strictly inside the overlap."""
        for place in range(high - 1, low + 1, -1):
            if text[place] == " " and text[place - 1] not in (" ", _SPACE) and place in left and place in right:
                return place
        return None


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Per row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    A missing or empty text has 0 bytes and 0 tokens. Every row gives one row,
    repeated and missing ids included; other columns are not read. An empty
    table gives an empty result. The model file is read by the driver and sent
    along with the tasks, so only the driver needs it (half a megabyte).
    """
    with open(model_path, "rb") as f:
        content = f.read()
    model = docs.sparkSession.sparkContext.broadcast(content)
    key = f"pieces {hashlib.sha256(content).hexdigest()} {chunk} {overlap}"
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        counts = per_worker(key, lambda: Counter(model.value, chunk, overlap)).count_all(texts)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
            ["id", "n_bytes", "n_tokens"],
        )

    counted = map_batches(rows, run, f"id {id_type.simpleString()}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
