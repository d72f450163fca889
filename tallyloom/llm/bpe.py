"""Byte-level BPE by a lazily determinised finite-state transducer.

A token sequence is what the merges give for a text exactly when each token
encodes to itself and each two neighbours, run through the merges together,
stay two tokens: a first merge across a border would already happen between
those two alone. So the merges compile to a non-deterministic transducer whose
configurations are (tokens not yet sure, last token, place in the vocabulary's
prefix tree). Sets of configurations are determinised as texts ask for them;
tokens that all configurations share are emitted. A configuration lives no
longer than the longest token, which bounds the lookahead.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm.common import fields, per_document

_NEVER = 1 << 60

ENCODED = fields(n_tokens="long", ids_sha256="string", decoded_sha256="string", valid_utf8="boolean")
ENCODED_IDS = fields(n_tokens="long", ids_sha256="string", decoded_sha256="string", valid_utf8="boolean", token_ids="list_int")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a Base64 token and its rank on each line."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merges(piece: bytes, ranks: dict[bytes, int]) -> Iterator[tuple[int, list[bytes]]]:
    """The merges themselves: join the neighbours of lowest rank, leftmost first. Gives each rank with the parts before it."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        yield rank, parts
        if rank == _NEVER:
            return
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]
    yield _NEVER, parts


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    return list(merges(piece, ranks))[-1][1]


class Transducer:
    """Encodes pieces; transitions are built when first needed and dropped together when there are too many."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_transitions: int = 400_000, most_pieces: int = 300_000):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.token = {rank: body for body, rank in ranks.items()}
        self.most_transitions, self.most_pieces = most_transitions, most_pieces
        self.child: dict[int, int] = {}
        self.accepts: list[int] = [-1]
        self.inner: list[bool] = [False]
        for body, rank in ranks.items():
            node = 0
            for byte in body:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.accepts)
                    self.accepts.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.accepts[node] = rank
        if any(bytes([k]) not in ranks for k in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.sides: dict[int, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]], bool] | None] = {}
        self.pieces: dict[str, bytes] = {}
        self.reset()

    def reset(self) -> None:
        start = (((), -1, 0),)
        self.states, self.number, self.last = [start], {start: 0}, [()]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def sides_of(self, token: int):
        """Left and right outer parts of a token while it is merged, each with the rank that takes it up, and whether
        those ranks rise; None for a token that the merges never give."""
        if token not in self.sides:
            steps = list(merges(self.token[token], self.ranks))
            left, right = [], []
            for (rank, parts), (_, later) in zip(steps, [*steps[1:], (0, [b""])]):
                if parts[0] != later[0]:
                    left.append((parts[0], rank))
                if parts[-1] != later[-1]:
                    right.append((parts[-1], rank))
            ranks = [rank for rank, _ in steps]
            self.sides[token] = (left, right, ranks == sorted(ranks)) if steps[-1][1] == [self.token[token]] else None
        return self.sides[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the two tokens stay two when merged together.

        Where each token's merges rise in rank, only the parts on either side
        of the border count: they would join if their rank came before that of
        the merge that takes one of them up.
        """
        a, b = self.sides_of(left), self.sides_of(right)
        if not (a[2] and b[2]):
            return merge(self.token[left] + self.token[right], self.ranks) == [self.token[left], self.token[right]]
        outer, inner, i, j, rank_of = a[1], b[0], 0, 0, self.ranks.get
        while True:
            x, taken_left = outer[i]
            y, taken_right = inner[j]
            rank = rank_of(x + y, _NEVER)
            if rank < taken_left and rank <= taken_right and rank < _NEVER:
                return False
            if taken_left <= taken_right:
                if taken_left == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def build(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one transition: the next state and the tokens that have become sure."""
        reached, ended = [], None
        for pending, last, node in self.states[state]:
            node = self.child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            token = self.accepts[node]
            if ended is None and token >= 0 and self.sides_of(token) and (last < 0 or self.neighbours(last, token)):
                ended = ((*pending, token), token, 0)
            if self.inner[node]:
                reached.append((pending, last, node))
        reached.append(ended)
        sure = 0
        for tokens in zip(*[r[0] for r in reached]):
            if len(set(tokens)) > 1:
                break
            sure += 1
        emitted = reached[0][0][:sure]
        target = tuple((pending[sure:], last, node) for pending, last, node in reached)
        number = self.number.get(target)
        if number is None:
            number = self.number[target] = len(self.states)
            self.states.append(target)
            self.last.append(target[-1][0])
        self.moves[state << 8 | byte] = move = (number, emitted)
        return move

    def run(self, piece: bytes) -> list[int]:
        if len(self.moves) > self.most_transitions:
            self.reset()
        state, out, known = 0, [], self.moves.get
        for byte in piece:
            move = known(state << 8 | byte)
            if move is None:
                move = self.build(state, byte)
            state, emitted = move
            if emitted:
                out += emitted
        out += self.last[state]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        pieces = self.pieces
        out = []
        for piece in self.split(text):
            ids = pieces.get(piece)
            if ids is None:
                tokens = self.run(piece.encode())
                ids = struct.pack(f"<{len(tokens)}I", *tokens)
                if len(piece) < 64:
                    if len(pieces) >= self.most_pieces:
                        pieces.clear()
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)


#: States of the UTF-8 machine: bytes of the open character so far; 0 is a border between characters, -1 an error.
_TAKEN = (0, 1, 1, 1, 1, 2, 1, 1, 1, 2, 3)
_LEADS = [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 2), (0xE1, 0xEC, 3), (0xED, 0xED, 4), (0xEE, 0xEF, 3), (0xF0, 0xF0, 6), (0xF1, 0xF3, 7), (0xF4, 0xF4, 8)]
_NEXT = {1: (0x80, 0xBF, 0), 2: (0xA0, 0xBF, 5), 3: (0x80, 0xBF, 5), 4: (0x80, 0x9F, 5), 5: (0x80, 0xBF, 0), 6: (0x90, 0xBF, 9), 7: (0x80, 0xBF, 9), 8: (0x80, 0x8F, 9), 9: (0x80, 0xBF, 10), 10: (0x80, 0xBF, 0)}


def utf8_step(state: int, byte: int) -> int:
    if state == 0:
        return next((to for low, high, to in _LEADS if low <= byte <= high), -1)
    low, high, to = _NEXT.get(state, (1, 0, -1))
    return to if low <= byte <= high else -1


class StreamDecoder:
    """Turns ids into UTF-8 text in blocks; a character that is open at a block's end waits for the next one."""

    def __init__(self, token: dict[int, bytes]):
        self.token = [token.get(k, b"") for k in range(max(token) + 1)]
        self.moves: dict[tuple[int, int], int] = {}
        self.whole = np.zeros(max(token) + 1, bool)
        for rank in token:
            self.whole[rank] = self.after(0, rank) == 0

    def after(self, state: int, token: int) -> int:
        """State after a whole token."""
        if (known := self.moves.get((state, token))) is not None:
            return known
        key = (state, token)
        for byte in self.token[token]:
            state = utf8_step(state, byte)
            if state < 0:
                break
        self.moves[key] = state
        return state

    def decode(self, ids: np.ndarray, block: int = 8192) -> Iterator[tuple[bytes, bool]]:
        """Blocks of text and whether each is whole, valid UTF-8; the last block holds what is left over.

        Tokens of whole characters leave the machine where it is; it steps
        through the others.
        """
        state, open_, valid, token = 0, b"", True, self.token
        for at in range(0, len(ids), block):
            part = ids[at:at + block]
            before = -1
            for k in np.flatnonzero(~self.whole[part]).tolist() if valid else ():
                state = self.after(state if state == 0 or before == k - 1 else -1, int(part[k])) if state >= 0 else -1
                before = k
            if state and before != len(part) - 1:
                state = -1
            valid = valid and state >= 0
            body = open_ + b"".join([token[t] for t in part.tolist()])
            held = _TAKEN[state] if valid else 0
            open_ = body[len(body) - held:]
            yield body[:len(body) - held], valid
        if open_:
            yield open_, False


_loaded: dict[int, tuple[Transducer, StreamDecoder]] = {}


def _machines(broadcast) -> tuple[Transducer, StreamDecoder]:
    """One transducer per worker process; it keeps what it has built from batch to batch."""
    if broadcast.id not in _loaded:
        _loaded.clear()
        encoder = Transducer(*broadcast.value)
        _loaded[broadcast.id] = (encoder, StreamDecoder(encoder.token))
    return _loaded[broadcast.id]


class _Named:
    """A broadcast with an id that workers can compare."""

    def __init__(self, broadcast, digest: str):
        self.broadcast, self.id = broadcast, digest

    @property
    def value(self):
        return self.broadcast.value


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None, with_ids: bool = False,
    most_transitions: int = 400_000, most_pieces: int = 300_000,
) -> DataFrame:
    """``row``, ``n_tokens``, digests of the ids and of the text decoded from them, and with ``with_ids`` the ids.

    ``ranks_path`` is read on the driver and sent to the tasks: a vocabulary,
    which does not grow with the documents. Null and empty texts have no
    tokens; the same text always has the same ids; a text of any length is
    encoded whole. No shuffle. ``most_transitions`` and ``most_pieces`` bound
    what a worker keeps of the transducer (about 280 MB as they stand); they
    trade memory for time and never change the ids.
    """
    ranks = read_ranks(ranks_path)
    digest = hashlib.sha256(repr((sorted(ranks.items()), pattern, most_transitions, most_pieces)).encode()).hexdigest()
    shared = _Named(docs.sparkSession.sparkContext.broadcast((ranks, pattern, most_transitions, most_pieces)), digest)

    def step(bodies: list[bytes | None]) -> list[pa.Array]:
        encoder, decoder = _machines(shared)
        counts, ids_hash, text_hash, valid, ids_out = [], [], [], [], []
        for body in bodies:
            ids = encoder.encode(body.decode()) if body else b""
            tokens = np.frombuffer(ids, "<u4")
            whole, hashed = True, hashlib.sha256()
            for part, good in decoder.decode(tokens):
                hashed.update(part)
                whole &= good
            counts.append(len(tokens))
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            text_hash.append(hashed.hexdigest())
            valid.append(whole)
            if with_ids:
                ids_out.append(tokens.astype(np.int32))
        made = [pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(valid, pa.bool_())]
        return made + ([pa.array(ids_out, pa.list_(pa.int32()))] if with_ids else [])

    return per_document(docs, step, ENCODED_IDS if with_ids else ENCODED, text, keep)
