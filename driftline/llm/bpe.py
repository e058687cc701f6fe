"""Operator 3: byte-level BPE encoding and decoding.

The bytes of a piece are read as Latin-1 characters, so one pyahocorasick
automaton over the whole vocabulary finds every token that ends at every byte in
one scan. The encoder then walks forward with the longest token at each position
and steps back to shorter ones whenever a token cannot stand beside its
predecessor. Two tokens can stand side by side when merging their joined bytes by
rank would give exactly these two again; that is decided by undoing the merges of
both tokens from the latest one on, and memoised. A sequence whose neighbours are
all compatible is the one that the merges produce, and as a position found
impossible is never tried twice, the work is linear in the bytes. This rests on every
token being what the merges make of its own bytes, as in any trained vocabulary; for a
rank file with other tokens the codec merges pair by pair instead.

Cases: a null text is an empty one (no tokens); repeated rows each get their own
result; an empty table gives no rows; other columns are ignored unless named in
``keep``."""
from __future__ import annotations

import base64
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import map_columns

#: Entries of the per-worker memo tables; a full table is emptied, never a result.
MEMO = 300_000


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks = ranks
        self.split_text = regex.compile(pattern).findall
        top = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * top
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lens = [len(t) for t in self.tokens]
        # halves[t]: the two tokens whose merge made t; None for single bytes
        self.halves: list[tuple[int, int] | None] = [None] * top
        self.shorter: list[int] = [-1] * top     # longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton()
        reachable = set()
        self.proper = True
        for token, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
            if len(token) > 1:
                parts = self._merge(token, rank)
                if len(parts) != 2:
                    self.proper = False          # merging its own bytes does not give this token
                    continue
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            reachable.add(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
        for token in reachable:
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in reachable:
                    self.shorter[ranks[token]] = ranks[token[:n]]
                    break
        self.automaton.make_automaton()
        self._beside: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}

    def _merge(self, piece: bytes, below: int) -> list[bytes]:
        """Plain merging, pair by pair, with the ranks under ``below``."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], below)
                if r < best:
                    best, at = r, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens when their bytes are merged."""
        key = left << 24 | right
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) >= MEMO:
                self._beside.clear()
            known = self._beside[key] = self._stay(left, right)
        return known

    def _stay(self, left: int, right: int) -> bool:
        ranks, tokens, halves = self.ranks, self.tokens, self.halves
        until = len(tokens) + 1          # the pair exists until a merge of this rank
        while True:
            joint = ranks.get(tokens[left] + tokens[right])
            if joint is not None and joint < until:
                return False             # the merge across the border comes first
            if left > right:             # undo the later merge; of equals the right one
                if halves[left] is None:
                    return True
                until, left = left, halves[left][1]
            else:
                if halves[right] is None:
                    return True
                until, right = right + 1, halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not self.proper:
            return [self.ranks[p] for p in self._merge(piece, len(self.tokens))]
        n, lens, shorter, beside = len(piece), self.lens, self.shorter, self._beside
        longest = [-1] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lens[token]] = token           # a later end is a longer token
        out: list[int] = []
        dead: set[int] = set()           # positions from which no encoding goes on
        pos, token, last = 0, longest[0] if n else -1, -1
        while pos < n:
            while token >= 0:
                end = pos + lens[token]
                if end not in dead:
                    if last < 0:
                        break
                    fits = beside.get(last << 24 | token)
                    if fits is None:
                        fits = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos, last = end, token
                token = longest[pos] if pos < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary cannot encode this text")
                dead.add(pos)
                pos -= lens[last]
                token = shorter[out.pop()]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        get = self._pieces.get
        for piece in self.split_text(text or ""):
            out += get(piece) or self._new_piece(piece)
        return out

    def _new_piece(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode_piece(piece.encode("utf-8")))
        if len(piece) <= 64:
            if len(self._pieces) >= MEMO:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and rank file. The file is part of the
    installed tokenizer package, hence on every executor."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Codec(ranks, pattern)


def encode(df: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text",
           out: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """``keep`` and ``out`` array<int>, the ids of the whole text; with ``decoded``
    also the bytes that the ids decode to, in the same pass."""
    fields = [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType(), False))

    def make():
        c = codec(path, pattern)
        if not decoded:
            return lambda t: (c.encode(t),)

        def both(t):
            ids = c.encode(t)
            return ids, c.decode(ids)
        return both

    return map_columns(df, [text], fields, keep, make)


def decode(df: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "token_ids",
           out: str = "decoded") -> DataFrame:
    """``keep`` and ``out`` binary, the bytes of an array of ids (null: empty)."""
    return map_columns(df, [ids], [T.StructField(out, T.BinaryType(), False)], keep,
                       lambda: lambda v, c=codec(path, pattern): (c.decode(v or ()),))


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
