"""Byte-level BPE encoding and decoding with a public rank file, in two tiers.

A text is cut into pre-tokens by the vocabulary's pattern.  Tier one resolves the
pre-tokens that are in the vocabulary as they stand: a minimal perfect hash (hash and
displace, one slot per token, no empty slot) names the only slot a pre-token could be in,
and its bytes are compared there.  Tier two merges the bytes of every other pre-token: a
heap holds the ranks of neighbouring pairs, the parts are a linked list, and the lowest
rank (leftmost first) is merged until no pair is in the vocabulary.

The table is built once on the driver from the rank file, whose size is fixed by the
vocabulary (at most ``MAX_TOKENS`` tokens), and broadcast as arrays.  Texts are encoded in
slices of ``SLICE_CHARS`` characters, longer ones pre-token by pre-token, so that a task's
memory follows neither the batch nor the longest text (but for its own ids).

The pattern speaks of letters and numbers, and libraries follow different versions of
Unicode.  ``newer_characters`` asks tiktoken which code points it counts in these classes;
those that only the ``regex`` module counts are read as private-use characters when a text
is cut.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_TOKENS = 1_000_000
BUCKET = 4                       # tokens per bucket of the hash, on average
SLICE_CHARS = 1_000_000          # text encoded at a time
SLICE_PIECES = 200_000           # pre-tokens of a longer text held at a time
MEMO_PIECES = 500_000            # merged pre-tokens a worker remembers, about 100 MB
MEMO_RANKS = 500_000             # ranks of candidate merges a worker remembers, about 60 MB
MEMO_BYTES = 64                  # longer ones are looked up each time
PRIVATE = "\ue000"               # neither letter nor number nor white space in any version

_M1, _M2, _M3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_MASK = (1 << 64) - 1


# ------------------------------------------------------------------ the hash table

def _slots(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Slot of hash ``h`` under displacement ``d``."""
    x = h ^ ((d.astype(np.uint64) + np.uint64(1)) * np.uint64(_M1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_M2)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_M3)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


class TokenTable:
    """Tokens in the slots of a minimal perfect hash: ``find`` gives the ranks of byte
    strings (-1: not in the vocabulary), ``spelled`` the bytes of ranks."""

    def __init__(self, displacement: np.ndarray, hashes: np.ndarray, ranks: np.ndarray, ends: np.ndarray, spelling: bytes):
        self.displacement, self.hashes, self.ranks, self.ends, self.spelling = displacement, hashes, ranks, ends, spelling
        self._ready = False

    def __reduce__(self):
        return TokenTable, (self.displacement, self.hashes, self.ranks, self.ends, self.spelling)

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> "TokenTable":
        """A table of ``ranks``; every single byte has to be a token."""
        if len(ranks) > MAX_TOKENS:
            raise ValueError(f"{len(ranks)} tokens; at most {MAX_TOKENS} are broadcast")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds each of the 256 bytes as a token")
        import xxhash
        n = len(ranks)
        tokens = list(ranks)
        h = np.array([xxhash.xxh64_intdigest(t) for t in tokens], dtype=np.uint64)
        if len(np.unique(h)) < n:
            raise ValueError("two tokens share a 64-bit hash")
        buckets = -(-n // BUCKET)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        displacement = np.zeros(buckets, dtype=np.int64)
        slot = np.zeros(n, dtype=np.int64)
        free = np.ones(n, dtype=bool)
        for b in np.argsort(-sizes, kind="stable"):          # the fullest buckets first
            own = order[starts[b]:starts[b + 1]]
            if len(own) < 2:
                break
            at = 0
            while True:
                d = np.arange(at, at + 512)
                s = _slots(h[own][:, None], d[None, :], n)
                fits = free[s].all(axis=0)
                if len(own) > 1:
                    fits &= (np.diff(np.sort(s, axis=0), axis=0) > 0).all(axis=0)
                if fits.any():
                    k = int(np.argmax(fits))
                    displacement[b], slot[own] = at + k, s[:, k]
                    free[s[:, k]] = False
                    break
                at += 512
        single = np.flatnonzero(sizes == 1)                  # these name their slot outright
        left = np.flatnonzero(free)
        displacement[single] = -1 - left
        slot[order[starts[single]]] = left
        by_slot = np.argsort(slot)
        spelled = [tokens[i] for i in by_slot]
        return cls(displacement, h[by_slot], np.array([ranks[t] for t in spelled], dtype=np.int64),
                   np.cumsum([len(t) for t in spelled]), b"".join(spelled))

    def _prepare(self) -> None:
        """What a worker derives from the broadcast arrays."""
        if self._ready:
            return
        starts = [0, *self.ends[:-1].tolist()]
        self.tokens = [self.spelling[s:e] for s, e in zip(starts, self.ends.tolist())]
        self.n, self.buckets = len(self.tokens), len(self.displacement)
        self._moves = self.displacement.tolist()
        self._rank_list = self.ranks.tolist()
        self._memo: dict[bytes, int] = {}
        self.byte_rank = [self.rank(bytes([b])) for b in range(256)]
        by_rank = np.full(int(self.ranks.max()) + 1, -1)
        by_rank[self.ranks] = np.arange(self.n)
        self._slot_of_rank = by_rank
        self._flat = np.frombuffer(self.spelling, dtype=np.uint8)
        self._starts, self._lengths = np.array(starts), np.diff(np.concatenate([[0], self.ends]))
        self._ready = True

    def rank(self, token: bytes) -> int:
        """Rank of one byte string, -1 if it is no token; short ones are remembered."""
        found = self._memo.get(token)
        if found is None:
            found = self._rank(token)
            if len(token) <= MEMO_BYTES:
                if len(self._memo) >= MEMO_RANKS:
                    self._memo.clear()
                self._memo[token] = found
        return found

    def _rank(self, token: bytes) -> int:
        import xxhash
        h = xxhash.xxh64_intdigest(token)
        d = self._moves[h % self.buckets]
        if d < 0:
            s = -1 - d
        else:
            x = h ^ (((d + 1) * _M1) & _MASK)
            x = ((x ^ (x >> 31)) * _M2) & _MASK
            x = ((x ^ (x >> 29)) * _M3) & _MASK
            s = (x ^ (x >> 32)) % self.n
        return self._rank_list[s] if self.tokens[s] == token else -1

    def find(self, tokens: list[bytes]) -> list[int]:
        """Ranks of many byte strings: hashes and slots as arrays, bytes compared where the
        64-bit hash agrees."""
        import xxhash
        self._prepare()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(t) for t in tokens), dtype=np.uint64, count=len(tokens))
        d = self.displacement[(h % np.uint64(self.buckets)).astype(np.int64)]
        s = np.where(d < 0, -1 - d, _slots(h, np.maximum(d, 0), self.n))
        own, ranks = self.tokens, self._rank_list
        return [ranks[i] if near and own[i] == t else -1
                for t, i, near in zip(tokens, s.tolist(), (self.hashes[s] == h).tolist())]

    def spelled(self, ranks: np.ndarray) -> bytes:
        """The bytes of a sequence of ranks; an unknown rank is an error."""
        self._prepare()
        if len(ranks) == 0:
            return b""
        r = np.asarray(ranks, dtype=np.int64)
        if r.min() < 0 or r.max() >= len(self._slot_of_rank) or (s := self._slot_of_rank[r]).min() < 0:
            raise ValueError("an id is not in the vocabulary")
        n = self._lengths[s]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1])) - np.repeat(ends - n, n) + np.repeat(self._starts[s], n)
        return self._flat[at].tobytes()


# ------------------------------------------------------------------ tier two

def merged(piece: bytes, table: TokenTable) -> list[int]:
    """Ranks of the parts of ``piece``: pairs of neighbouring parts are merged by lowest
    rank, leftmost first, until none is a token.  n log n in the bytes."""
    table._prepare()
    n = len(piece)
    rank = table.rank
    ids = [table.byte_rank[b] for b in piece]
    end = list(range(1, n + 1))                  # a part covers [i, end[i]); its right neighbour starts there
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) >= 0]
    heapify(heap)
    while heap:
        r, i, stop = heappop(heap)
        if not alive[i]:
            continue
        j = end[i]
        if j >= n or end[j] != stop:
            continue                             # one of the two has been merged since
        alive[j] = False
        ids[i], end[i] = r, stop
        if stop < n:
            before[stop] = i
            if (q := rank(piece[i:end[stop]])) >= 0:
                heappush(heap, (q, i, end[stop]))
        if (p := before[i]) >= 0 and (q := rank(piece[p:stop])) >= 0:
            heappush(heap, (q, p, stop))
    return [ids[i] for i in range(n) if alive[i]]


# ------------------------------------------------------------------ texts

class ByteEncoder:
    """Encodes texts with a table and a pre-token pattern, in one worker."""

    def __init__(self, table: TokenTable, pattern: str, newer: list[tuple[int, int]] = ()):
        import regex
        self.table = table
        self.pattern = regex.compile(pattern)
        self.newer = {c: PRIVATE for a, b in newer for c in range(a, b + 1)}
        self.first = chr(min(self.newer)) if self.newer else None
        self.memo: dict[bytes, bytes] = {}

    def _read(self, text: str) -> str:
        """The text as the pattern is to see it, of the same length."""
        if self.first is None or text.isascii() or max(text) < self.first:
            return text
        return text.translate(self.newer)

    def _pieces(self, text: str) -> list[str]:
        seen = self._read(text)
        if seen == text:
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(seen)]

    def _ids(self, pieces: list[str]) -> dict[str, bytes]:
        """Little-endian unsigned 32-bit ids of distinct pre-tokens."""
        raw = [p.encode() for p in pieces]
        found = self.table.find(raw)
        whole = np.array(found, dtype="<i4").tobytes()
        out = {p: whole[4 * k:4 * k + 4] for k, p in enumerate(pieces) if found[k] >= 0}
        memo = self.memo
        if len(memo) > MEMO_PIECES:
            memo.clear()
        for p, b, r in zip(pieces, raw, found):
            if r < 0:
                ids = memo.get(b)
                if ids is None:
                    ids = np.array(merged(b, self.table), dtype="<u4").tobytes()
                    if len(b) <= MEMO_BYTES:
                        memo[b] = ids
                out[p] = ids
        return out

    def _joined(self, split: list[list[str]]) -> list[bytes]:
        known = self._ids(list(set(chain.from_iterable(split))))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def _long(self, text: str) -> bytes:
        matches = (text[m.start():m.end()] for m in self.pattern.finditer(self._read(text)))
        parts = []
        while pieces := list(islice(matches, SLICE_PIECES)):
            parts += self._joined([pieces])
        return b"".join(parts)

    def __call__(self, texts: list) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none)."""
        out: list[bytes] = []
        held: list[list[str]] = []
        chars = 0
        for t in texts:
            t = t or ""
            if held and (chars + len(t) > SLICE_CHARS):
                out += self._joined(held)
                held, chars = [], 0
            if len(t) > SLICE_CHARS:
                out.append(self._long(t))
            else:
                held.append(self._pieces(t))
                chars += len(t)
        return out + (self._joined(held) if held else [])


_ENCODERS: dict = {}


def _encoder(shared, pattern: str, newer: list[tuple[int, int]]) -> ByteEncoder:
    """The worker's encoder for a broadcast table (kept while the same table is in use)."""
    key = (hash(shared.value.spelling), shared.value.ranks.tobytes(), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteEncoder(shared.value, pattern, newer)
    return _ENCODERS[key]


def newer_characters() -> list[tuple[int, int]]:
    """Ranges of code points that ``regex`` counts as letters or numbers and tiktoken does
    not (its Unicode version is older)."""
    import regex
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    extra: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        asked = tiktoken.Encoding("classes", pat_str=kind, special_tokens={},
                                  mergeable_ranks={bytes([b]): b for b in range(256)})
        extra.update(set(regex.findall(kind, every)) - set(asked.decode_bytes(asked.encode_ordinary(every)).decode()))
    out: list[list[int]] = []
    for c in sorted(map(ord, extra)):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return [(a, b) for a, b in out]


def vocabulary(path: str | None = None) -> dict[bytes, int]:
    """Token -> rank of a rank file (lines of base64 and rank)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def shared_table(df: DataFrame, path: str | None = None):
    """The broadcast table of a rank file (by default the public multilingual one)."""
    return df.sparkSession.sparkContext.broadcast(TokenTable.build(vocabulary(path)))


def _slices(lengths: list[int]) -> list[tuple[int, int]]:
    """Row ranges whose texts have about ``SLICE_CHARS`` characters together."""
    out, start, size = [], 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > SLICE_CHARS:
            out.append((start, i))
            start, size = i, 0
        size += n
    return out + ([(start, len(lengths))] if len(lengths) > start else [])


def encode_texts(docs: DataFrame, table, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: the ids (array<int>) of the whole text.

    ``table`` is a broadcast ``TokenTable`` (see ``shared_table``).  A null or empty text has
    no ids (an empty array).  Repeated rows and ties play no part: each row is encoded for
    itself.  Extra columns ride along; one already called ``ids_col`` is replaced.  An empty
    table gives no rows.  Very long texts are encoded whole, in slices of pre-tokens."""
    keep = [f for f in docs.schema.fields if f.name != ids_col]
    schema = StructType([*keep, StructField(ids_col, ArrayType(IntegerType(), False), False)])
    names = [f.name for f in keep]
    newer = newer_characters()

    def encode(batches):
        own = _encoder(table, pattern, newer)
        for batch in batches:
            texts = batch.column(names.index(text_col))
            sizes = pa.compute.binary_length(texts).fill_null(0).to_pylist()
            for start, stop in _slices(sizes):
                part = batch.slice(start, stop - start)
                found = own(texts.slice(start, stop - start).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in found])])
                values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*names, ids_col])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(encode, schema)


def decode_ids(docs: DataFrame, table, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with ``bytes_col``: the bytes that the ids in ``ids_col`` spell (null ids:
    null; no ids: no bytes).  An id outside the vocabulary is an error.  Extra columns ride
    along; one already called ``bytes_col`` is replaced."""
    keep = [f for f in docs.schema.fields if f.name != bytes_col]
    schema = StructType([*keep, StructField(bytes_col, BinaryType(), True)])
    names = [f.name for f in keep]

    def decode(batches):
        for batch in batches:
            ids = batch.column(names.index(ids_col))
            sizes = pa.compute.list_value_length(ids).fill_null(0).to_pylist()
            for start, stop in _slices([4 * n for n in sizes]):
                part = batch.slice(start, stop - start)
                rows = ids.slice(start, stop - start)
                flat = rows.flatten().to_numpy(zero_copy_only=False)
                at, out = 0, []
                for n, ok in zip(sizes[start:stop], rows.is_valid().to_pylist()):
                    out.append(table.value.spelled(flat[at:at + n]) if ok else None)
                    at += n
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*names, bytes_col])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(decode, schema)
