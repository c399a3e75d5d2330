"""Byte-level BPE as a lazily determinised transducer, and its streaming inverse.

**Compilation.** A token sequence is the BPE encoding of its bytes exactly if
every two neighbours are compatible, that is if no merge across their border
comes before the merges that built them up. So the encoder is a
nondeterministic transducer over bytes: walk the trie of the vocabulary, and
where a token ends and is compatible with the token before it, write it and
start again at the root. ``compile_ranks`` finds the last merge of every token
once; compatibility of a pair follows from the two chains of merges at the
border and is remembered when asked for.

**Determinisation.** The deterministic state after some bytes is the set of all
walks still alive; its output is the last token of what was read so far, and
the tokens before it follow from the outputs of earlier states. What all walks
agree on is emitted; a walk lives no longer than the longest token, so the
lookahead is bounded. States and transitions are made when a text first needs
them, and dropped when they exceed ``MAX_STATES``.

**Decoding.** Token bytes are joined and an incremental UTF-8 state machine
turns any cut of the stream into text, holding back at most three bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from itertools import accumulate, islice
from operator import getitem
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import kept_with_text, map_batches, per_worker

MAX_STATES = 300_000
# Short pieces whose tokens are remembered, at most twice as many: when full, what was not asked for since the last time goes.
MEMO_PIECES = 200_000
MEMO_LENGTH = 48
_NEVER = 1 << 60
_LOW = (1 << 32) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _merge(piece: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """Plain merging, lowest rank first, with merges under ``below`` only; used on single tokens."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], _NEVER))
        if ranks.get(parts[best] + parts[best + 1], _NEVER) >= below:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


def merging_parts(ranks: dict[bytes, int]) -> tuple[set[bytes], set[bytes]]:
    """The tokens that some merge takes as its left part, and as its right part."""
    lefts, rights = set(), set()
    for token in ranks:
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                lefts.add(token[:cut])
                rights.add(token[cut:])
    return lefts, rights


def compile_ranks(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes]]:
    """The last merge of each token that merging can reach."""
    last = {}
    for token, rank in ranks.items():
        if len(token) > 1 and len(parts := _merge(token, ranks, rank)) == 2:
            last[token] = (parts[0], parts[1])
    return last


class _State(dict):
    """A state of the transducer: from a byte to the next state, which is made when first asked for."""

    __slots__ = ("_owner", "walks", "written")

    def __init__(self, owner: Transducer, walks: tuple[int, ...], written: int):
        super().__init__()
        self._owner, self.walks, self.written = owner, walks, written

    def __missing__(self, byte: int) -> _State:
        state = self[byte] = self._owner.after(self.walks, byte)
        return state


class Transducer:
    """Encodes pieces of text. Made from the ranks and ``compile_ranks`` of them.

    A walk is a token being read: its trie node, and the token written before
    it. A state is the set of walks alive after some bytes; one of them stands
    at the root, and the token before it is the last token of the encoding of
    what was read so far, which is the output of the state.
    """

    #: Bytes of a long piece after which what all walks agree on is emitted.
    BLOCK = 4096

    def __init__(self, ranks: dict[bytes, int], last: dict[bytes, tuple[bytes, bytes]], max_states: int = MAX_STATES):
        self._ranks, self._last, self._max_states = ranks, last, max_states
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._child: dict[int, int] = {}
        self._token, self._depth = [-1], [0]
        parents: set[int] = set()
        for token, rank in ranks.items():
            if len(token) == 1 or token in last:
                node = 0
                for byte in token:
                    parents.add(node)
                    node = self._child.setdefault(node << 8 | byte, len(self._token))
                    if node == len(self._token):
                        self._token.append(-1)
                        self._depth.append(0)
                self._token[node] = rank
        for key, node in self._child.items():
            self._depth[node] = self._depth[key >> 8] + 1
        self._parent = bytearray(len(self._token))
        for node in parents:
            self._parent[node] = 1
        self._merging = merging_parts(ranks)
        self._chains: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        self._compatible: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        # a walk is packed into one number: its node, and the token before it plus 1
        self._root = _State(self, (0,), -1)
        self._states: dict[tuple[int, ...], _State] = {self._root.walks: self._root}

    def _chain(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The symbols at one border of a token that can merge across it, outermost first, each with the merge that ends it."""
        chain = self._chains.get((token, side))
        if chain is None:
            chain, until, symbol, merging = [], _NEVER, self._bytes[token], self._merging[1 - side]
            while True:
                if symbol in merging:
                    chain.append((symbol, until))
                if symbol not in self._last:
                    break
                until, symbol = self._ranks[symbol], self._last[symbol][side]
            self._chains[(token, side)] = chain
        return chain

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' bytes gives the two tokens."""
        key = left << 32 | right
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) > 4 * self._max_states:
                self._compatible.clear()
            known = self._compatible[key] = self._borders_hold(left, right)
        return known

    def _borders_hold(self, left: int, right: int) -> bool:
        # the right border of the left token against the left border of the right one
        a, b = self._chain(left, 1), self._chain(right, 0)
        if not a or not b:
            return True
        rank_of = self._ranks.get
        for x, x_until in a:
            for y, y_until in b:
                rank = rank_of(x + y)
                # at equal rank the leftmost pair merges first
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
        return True

    def after(self, walks: tuple[int, ...], byte: int) -> _State:
        """The state after one more byte."""
        alive, written = [], -1
        child, tokens, parent, known = self._child, self._token, self._parent, self._compatible
        for walk in walks:
            node = child.get(walk >> 32 << 8 | byte)
            if node is None:
                continue
            before = walk & _LOW
            if parent[node]:
                alive.append(node << 32 | before)
            token = tokens[node]
            # exactly one walk ends in a token that may follow the one before it
            if written < 0 <= token:
                if before == 0:
                    written = token
                else:
                    fits = known.get(before - 1 << 32 | token)
                    if fits or fits is None and self.compatible(before - 1, token):
                        written = token
        if written < 0:
            raise ValueError("the ranks are no order of merges over all bytes")
        alive.append(written + 1)
        target = tuple(alive)
        state = self._states.get(target)
        if state is None:
            state = self._states[target] = _State(self, target, written)
        return state

    def encode(self, piece: bytes) -> list[int]:
        whole = self._ranks.get(piece)
        if whole is not None:  # a whole token stands for itself
            return [whole]
        if len(self._states) > self._max_states:
            self._forget()
        if len(piece) <= self.BLOCK:
            return self._back(list(accumulate(piece, getitem, initial=self._root)), len(piece))
        out: list[int] = []
        path = [self._root]  # the states from the end of what is emitted on
        for at in range(0, len(piece), self.BLOCK):
            path += islice(accumulate(piece[at : at + self.BLOCK], getitem, initial=path[-1]), 1, None)
            here, shared = len(path) - 1, None
            for walk in path[-1].walks:
                places, place = set(), here - self._depth[walk >> 32]
                while place > 0:
                    places.add(place)
                    place -= self._length[path[place].written]
                shared = places if shared is None else shared & places
            agreed = max(shared, default=0)
            out += self._back(path, agreed)
            del path[:agreed]
            if len(self._states) > self._max_states:
                # go on from the same walks among new states
                walks, written = path[-1].walks, path[-1].written
                self._forget()
                path[-1] = self._states.setdefault(walks, _State(self, walks, written))
        return out + self._back(path, len(path) - 1)

    def _back(self, path: list[_State], place: int) -> list[int]:
        """The tokens up to a place, followed back from the last one."""
        tokens, length = [], self._length
        while place > 0:
            token = path[place].written
            tokens.append(token)
            place -= length[token]
        tokens.reverse()
        return tokens


class _Memo(dict):
    """The ids of pieces as packed 32-bit numbers; a new piece is encoded when first asked for."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self._transducer, self._before = transducer, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self._before.get(piece)
        if packed is None:
            packed = array("i", self._transducer.encode(piece.encode())).tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self._before = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Encodes whole texts: ``pattern`` cuts them into pieces, the transducer encodes each."""

    def __init__(self, ranks: dict[bytes, int], last: dict[bytes, tuple[bytes, bytes]], pattern: str):
        import regex

        self._pieces = regex.compile(pattern)
        self._transducer = Transducer(ranks, last)
        self._packed = _Memo(self._transducer).__getitem__

    def packed(self, text: str) -> bytes:
        return b"".join(map(self._packed, self._pieces.findall(text)))

    def encode(self, text: str) -> array:
        out = array("i")
        out.frombytes(self.packed(text))
        return out


class Utf8Stream:
    """An incremental UTF-8 state machine: bytes in any cuts, text out.

    Its state is the unfinished character at the end (at most three bytes).
    Bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self) -> None:
        self._held = b""

    def feed(self, data: bytes) -> str:
        data = self._held + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # a lead byte: how many bytes it asks for
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2
                keep = back if need > back else 0
                break
            if byte < 0x80:
                break
        whole, self._held = (data[:-keep], data[-keep:]) if keep else (data, b"")
        return whole.decode("utf-8", "replace")

    def end(self) -> str:
        rest, self._held = self._held, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    """Decodes ids in blocks; unknown ids raise ``KeyError``."""

    BLOCK = 8192

    def __init__(self, ranks: dict[bytes, int]):
        self._bytes = {rank: token for token, rank in ranks.items()}

    def decode(self, ids: list[int]) -> str:
        stream, out, of = Utf8Stream(), [], self._bytes.__getitem__
        for start in range(0, len(ids), self.BLOCK):
            out.append(stream.feed(b"".join(map(of, ids[start : start + self.BLOCK]))))
        out.append(stream.end())
        return "".join(out)


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(x) // 4 for x in packed]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()))


class Codec:
    """The two operators over one vocabulary.

    The driver reads and compiles the file; the result, as large as the
    vocabulary, is sent along with the tasks.
    """

    def __init__(self, spark, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self._compiled = spark.sparkContext.broadcast((ranks, compile_ranks(ranks), pattern))
        self._ranks = spark.sparkContext.broadcast(ranks)
        self._key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    def encode(self, docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "ids") -> DataFrame:
        """The ``keep`` columns and ``ids array<int>`` of each whole text.

        A missing or empty text has no ids. Every row gives one row, repeated
        and missing ids included; an empty table gives an empty result. A kept
        column named like ``out`` is an error.
        """
        shared, key = self._compiled, self._key
        rows = kept_with_text(docs, keep, text_col)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            encoder = per_worker(f"encoder {key}", lambda: Encoder(*shared.value))
            texts = [encoder.packed(text.as_py() or "") for text in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), _id_lists(texts)], ["kept", "ids"])

        kept = rows.schema["kept"].dataType.simpleString()
        return map_batches(rows, run, f"kept {kept}, ids array<int>").select(
            *[F.col("kept")[c].alias(c) for c in keep], F.col("ids").alias(out)
        )

    def round_trip(self, docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """``encode`` and ``decode`` of its ids in one pass: the ``keep`` columns, ``ids`` and ``decoded``.

        One Python worker does both, where the two after each other take two.
        """
        shared, key = self._compiled, self._key
        rows = kept_with_text(docs, keep, text_col)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            encoder = per_worker(f"encoder {key}", lambda: Encoder(*shared.value))
            decoder = per_worker(f"decoder {key}", lambda: Decoder(shared.value[0]))
            packed, decoded = [], []
            for text in batch.column(1):
                packed.append(encoder.packed(text.as_py() or ""))
                decoded.append(decoder.decode(np.frombuffer(packed[-1], np.int32).tolist()))
            return pa.RecordBatch.from_arrays([batch.column(0), _id_lists(packed), pa.array(decoded, pa.string())], ["kept", "ids", "decoded"])

        kept = rows.schema["kept"].dataType.simpleString()
        return map_batches(rows, run, f"kept {kept}, ids array<int>, decoded string").select(
            *[F.col("kept")[c].alias(c) for c in keep], "ids", "decoded"
        )

    def decode(self, rows: DataFrame, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
        """All columns and ``decoded``, the text of the ids; missing ids give an empty text."""
        shared, key = self._ranks, self._key
        packed = rows.select(F.struct(*rows.columns).alias("kept"), F.col(ids_col).alias("ids"))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            decoder = per_worker(f"decoder {key}", lambda: Decoder(shared.value))
            texts = [decoder.decode(np.asarray(x.values).tolist() if x.is_valid else []) for x in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["kept", "decoded"])

        kept = packed.schema["kept"].dataType.simpleString()
        return map_batches(packed, run, f"kept {kept}, decoded string").select(
            *[F.col("kept")[c].alias(c) for c in rows.columns], F.col("decoded").alias(out)
        )
