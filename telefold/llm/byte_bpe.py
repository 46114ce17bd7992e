"""Byte-level BPE by a transducer, and streaming decoding by a UTF-8 state machine.

A sequence of tokens is what the merges make of its bytes if and only if they make each token of its own bytes and each
two neighbours of theirs: until a merge crosses a token's edge, the tokens on both sides merge in the same order in the
pair as in the whole. So each prefix of a piece has one encoding, and its last token follows from the bytes alone.

The transducer reads bytes. Non-deterministically it would guess where tokens begin; its determinised state holds every
place where a token may have begun that is still being read: the node of the trie of tokens it has reached, and the
tokens up to that place which aren't certain yet. A byte moves all of them; a token that ends is taken at the place
whose last token it may follow. What all places agree on is certain and is emitted, so the output lags by what the
vocabulary's longest tokens need and not by the text. States and steps are made when first met and remembered; a full
table is emptied, and the run goes on from the state it is in.

Null and empty texts have no ids and decode to the empty text; equal rows give equal ids. A very long piece costs the
same time a byte as a short one. Other columns are kept whatever their names; a column that already has an output's name
is replaced. Map-only.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import named
from .held import held, tidy
from .vocab import Remembered

NONE = -1
STATES = 250_000  # kept at most, with about twice as many steps
PAIRS = 300_000  # answers to "may this token follow that one" kept at most
PIECES = 300_000  # ids by piece, kept up to twice as many


class Ranks:
    """A file of ranks: the bytes of each token by id, and a trie of them."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        #: a node's child by node * 256 + byte; the token that ends in a node
        self.child: dict[int, int] = {}
        self.ends, self.inner = [NONE], [False]
        for token, rank in self.ids.items():
            node = 0
            for b in token:
                step = node << 8 | b
                if step not in self.child:
                    self.child[step] = len(self.ends)
                    self.ends.append(NONE)
                    self.inner.append(False)
                    self.inner[node] = True
                node = self.child[step]
            self.ends[node] = rank

    def merged(self, raw: bytes) -> list[int]:
        """What the merges make of a few bytes: the adjacent pair of lowest rank goes first, the leftmost of equals."""
        ids, never = self.ids, len(self.tokens)
        parts = [raw[i:i + 1] for i in range(len(raw))]
        ranks = [ids.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = ids.get(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = ids.get(parts[i] + parts[i + 1], never)
        return [ids[p] for p in parts]


class Transducer:
    """From bytes to token ids. A state is the last certain token, and for each live place in order the tokens that lead
    to it beyond that one and the trie's node; the last place is the end of what has been read."""

    def __init__(self, ranks: Ranks, states: int = STATES):
        self.ranks, self.most = ranks, states
        self.pairs: dict[int, bool] = {}
        #: states by number, packed; the tokens that follow if the piece ends in one
        self.keys: list[bytes] = []
        self.tails: list[tuple[int, ...]] = []
        self.numbers: dict[bytes, int] = {}
        #: where a step leads, by state * 256 + byte; with the tokens it emits, if any
        self.to: dict[int, int | tuple[int, tuple[int, ...]]] = {}
        self._empty()

    def _empty(self) -> None:
        for table in (self.keys, self.tails, self.numbers, self.to):
            table.clear()
        self._number(self._packed(NONE, [((), 0)]), ())

    def _number(self, key: bytes, tail: tuple[int, ...]) -> int:
        number = self.numbers.setdefault(key, len(self.keys))
        if number == len(self.keys):
            self.keys.append(key)
            self.tails.append(tail)
        return number

    @staticmethod
    def _packed(certain: int, places: list[tuple[tuple[int, ...], int]]) -> bytes:
        flat = [certain]
        for lead, node in places:
            flat += (node, len(lead), *lead)
        return array("i", flat).tobytes()

    @staticmethod
    def _unpacked(key: bytes) -> tuple[int, list[tuple[tuple[int, ...], int]]]:
        flat = array("i", key).tolist()
        places, at = [], 1
        while at < len(flat):
            end = at + 2 + flat[at + 1]
            places.append((tuple(flat[at + 2:end]), flat[at]))
            at = end
        return flat[0], places

    def may_follow(self, last: int, token: int) -> bool:
        """Whether the merges keep the two apart and whole; NONE stands for the beginning."""
        asked = (last + 1) << 32 | token
        found = self.pairs.get(asked)
        if found is None:
            tokens = self.ranks.tokens
            raw = tokens[token] if last == NONE else tokens[last] + tokens[token]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[asked] = self.ranks.merged(raw) == ([token] if last == NONE else [last, token])
        return found

    def _move(self, key: bytes, byte: int) -> tuple[bytes, tuple[int, ...], tuple[int, ...]]:
        """The next state, its tail, and what becomes certain."""
        child, ends, inner = self.ranks.child, self.ranks.ends, self.ranks.inner
        certain, places = self._unpacked(key)
        live, to_end = [], None
        for lead, node in places:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            token = ends[node]
            if token != NONE and to_end is None and self.may_follow(lead[-1] if lead else certain, token):
                to_end = (*lead, token)
            if inner[node]:
                live.append((lead, node))
        live.append((to_end, 0))
        n = 0
        if all([lead for lead, _ in live]):
            first, last = min(live)[0], max(live)[0]
            n = next((i for i, (a, b) in enumerate(zip(first, last)) if a != b), min(len(first), len(last)))
            if n:
                certain = to_end[n - 1]
                live = [(lead[n:], node) for lead, node in live]
            if all([lead for lead, _ in live]):
                certain = NONE  # every place is led to by tokens of its own
        return self._packed(certain, live), to_end[n:], to_end[:n]

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        key, tail, ids = self._move(self.keys[state], byte)
        if key not in self.numbers and len(self.keys) >= self.most:
            self._empty()  # the state it starts from has no number any more
            return self._number(key, tail), ids
        number = self._number(key, tail)
        self.to[state << 8 | byte] = (number, ids) if ids else number
        return number, ids

    def run(self, raw: bytes) -> list[int]:
        """The ids of one piece. A piece that is a token is that token."""
        whole = self.ranks.ids.get(raw)
        if whole is not None:
            return [whole]
        step, state, found = self.to.get, 0, []
        for byte in raw:
            after = step(state << 8 | byte)
            if after.__class__ is int:
                state = after
            else:
                state, ids = after or self._step(state, byte)
                found += ids
        return [*found, *self.tails[state]]


class Utf8Stream:
    """Turns bytes that arrive in parts into text; a character split between parts waits for its rest. What is no UTF-8
    becomes U+FFFD, one for each longest beginning of a character."""

    def __init__(self):
        self.held = bytearray()
        self.missing, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, part: bytes) -> str:
        out, run = [], self.held
        for b in part:
            if self.missing:
                if self.low <= b <= self.high:
                    run.append(b)
                    self.missing -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.missing:
                        out.append(run.decode())
                        run.clear()
                    continue
                out.append("�")
                run.clear()
                self.missing, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                run.append(b)
                self.missing = 1 + (b >= 0xE0) + (b >= 0xF0)
                # no overlong forms, surrogates or numbers beyond Unicode
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What is left of a character that never ended."""
        left = "�" if self.missing else ""
        self.held.clear()
        self.missing, self.low, self.high = 0, 0x80, 0xBF
        return left


class Codec:
    """Encodes texts to ids and back; remembers the ids of recent pieces."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.transducer = Transducer(ranks)
        # white space as Unicode has it; Python's own has four control characters more
        self.piece = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.known = Remembered(lambda piece: array("i", self.transducer.run(piece.encode())).tobytes(), PIECES)
        #: a token's text, None if it isn't whole characters
        self.texts = np.array([self._whole(t) for t in ranks.tokens], dtype=object)
        self.tokens = ranks.tokens

    @staticmethod
    def _whole(token: bytes) -> str | None:
        try:
            return token.decode()
        except UnicodeDecodeError:
            return None

    def encode(self, text: str | None) -> bytes:
        """The text's ids, four bytes each."""
        return b"".join(map(self.known.__getitem__, self.piece.findall(text))) if text else b""

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts[ids].tolist()
        if None in texts:
            stream = Utf8Stream()
            for i, text in enumerate(texts):
                if text is None or stream.missing:
                    texts[i] = stream.feed(self.tokens[ids[i]])
            texts.append(stream.end())
        return "".join(texts)


@held
def _codec(path: str, pattern: str) -> Codec:
    return Codec(Ranks(path), pattern)


ROWS = 200  # rows worked on at a time, so that results don't pile up


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _listed(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)], dtype=np.int32)
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids array<int>``: the ids of each match of ``pattern``, by the ranks in the file at ``path``."""

    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for texts in _slices(batches):
            yield _listed([codec.encode(t.as_py()) for t in texts])

    return docs.withColumn(ids, F.arrow_udf(run, "array<int>")(named(text)))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``decoded string``: the text of ``ids``; bytes that are no UTF-8 become U+FFFD, null ids the empty text."""

    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for many in _slices(batches):
            texts = [codec.decode(row.values.to_numpy()) if row.is_valid and len(row.values) else "" for row in many]
            yield pa.array(texts, pa.string())

    return encoded.withColumn(text, F.arrow_udf(run, "string")(named(ids)))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "coded") -> DataFrame:
    """Adds ``coded struct<ids array<int>, decoded string>``: both of the above in one pass, ids sent to Spark once."""

    @tidy
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path, pattern)
        for texts in _slices(batches):
            found = [codec.encode(t.as_py()) for t in texts]
            back = pa.array([codec.decode(np.frombuffer(ids, np.int32)) for ids in found], pa.string())
            yield pa.StructArray.from_arrays([_listed(found), back], ["ids", "decoded"])

    return docs.withColumn(out, F.arrow_udf(run, "struct<ids:array<int>,decoded:string>")(named(text)))
