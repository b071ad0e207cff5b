"""Byte-level BPE encoding and decoding over length-bucketed padded matrices.

Each text is cut into pieces by the vocabulary's pattern. Pieces that are new to a worker are dealt by length into padded
matrices of byte ids; in every round each row that still has a mergeable pair merges its leftmost pair of lowest rank, so
all rows lose one column and the matrix shrinks (compaction), and rows without such a pair leave it. Which pairs merge,
and into what, comes from one hash table over all splits of all tokens, probed for a whole column of pairs at once: like
the tiktoken library, two neighbours merge if their bytes joined are a token, whichever merge made it.

A matrix of pieces of n bytes takes n rounds over n columns, so pieces beyond ``LONG`` bytes, which are few, merge by a
heap over a linked list in the same order. Texts beyond ``SEGMENT`` characters are cut between two words of ASCII
letters, where the pattern always starts a piece, so that memory follows the segment and not the text.

Defined results: a null text is empty and has no ids; special tokens are ordinary text. Null ids and repeated rows are
returned as they are, an empty table gives an empty one, other columns are left out. In decoding, a null list gives null,
as does one that holds a null or an id outside the vocabulary. The vocabulary file's path is a parameter; every executor
needs it at that place.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.hashing import chunks, mix

CACHE_PIECES = 400_000
#: Longest piece, in bytes, that goes through the matrices, and most cells of one matrix.
LONG, CELLS = 256, 1 << 20
#: Characters of a text that are split at a time.
SEGMENT = 1 << 20
_NONE = np.int32(2**31 - 1)
_EMPTY = np.int64(-1)
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_WORD_GAP = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def first_plane_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts of characters below U+10000, its classes spelled out: the standard module reads these faster."""
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    spelled = {}
    for name in (r"\p{L}", r"\p{N}", r"\s", r"\S"):
        runs = regex.findall(f"[{name}]+", every)
        ends = [(ord(a), ord(b)) for run in runs for a, b in ((run[0], run[-1]),)]
        # a run of neighbours in ``every`` may reach over the surrogates, which no text holds
        spelled[name] = "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ends)
    out, depth, k = [], False, 0
    while k < len(pattern):
        name = next((n for n in spelled if pattern.startswith(n, k)), None)
        if name is None:
            depth = (depth or pattern[k] == "[") and pattern[k] != "]"
            out.append(pattern[k])
            k += 1
        else:
            out.append(spelled[name] if depth else f"[{spelled[name]}]")
            k += len(name)
    return re.compile("".join(out))


class PairTable:
    """A hash table from pairs of ids to the id that they merge into, with open addressing, filled and probed by arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        codes = self.code(left, right)
        codes, first = np.unique(codes, return_index=True)
        made = made[first]
        bits = max(4, int(4 * len(codes)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.keys, self.made = np.full(1 << bits, _EMPTY), np.full(1 << bits, _NONE, np.int32)
        slot = self._slot(codes)
        while len(codes):
            _, one = np.unique(slot, return_index=True)  # one claimant a slot
            one = one[self.keys[slot[one]] == _EMPTY]
            self.keys[slot[one]], self.made[slot[one]] = codes[one], made[one]
            rest = np.ones(len(codes), bool)
            rest[one] = False
            codes, made, slot = codes[rest], made[rest], (slot[rest] + 1) & self.mask

    @staticmethod
    def code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 24) | right.astype(np.int64)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return mix(codes.astype(np.uint64)).astype(np.int64) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, ``_NONE`` where there is none or a side is padding."""
        codes = self.code(left, right)
        slot = self._slot(codes)
        found = self.keys[slot]
        out = np.where(found == codes, self.made[slot], _NONE)
        open_ = np.flatnonzero((found != codes) & (found != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == codes[open_]
            out[open_[hit]] = self.made[slot[open_[hit]]]
            open_ = open_[~hit & (found != _EMPTY)]
        return out


class ByteBpe:
    """One vocabulary of byte strings and their ranks, which are their ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, made = np.array(splits, np.int32).reshape(-1, 3).T
        self.pairs = PairTable(left, right, made)
        self.pair_made: dict[tuple[int, int], int] | None = None
        self.pattern = regex.compile(pattern)
        self.plane_pattern = first_plane_pattern(pattern)
        size = max(self.ranks.values()) + 1
        spelled = [b""] * size
        for t, i in self.ranks.items():
            spelled[i] = t
        self.known = np.array([len(t) > 0 for t in spelled])
        self.spelling = Spelled(spelled)
        self.decimals = Spelled([b"%d " % i for i in range(size)])
        self.pieces: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        return (self.pattern if _BEYOND.search(text) else self.plane_pattern).findall(text)

    def segments(self, text: str) -> Iterator[str]:
        """The text in parts of about ``SEGMENT`` characters that no piece crosses."""
        at = 0
        while len(text) - at > SEGMENT:
            gap = _WORD_GAP.search(text, at + SEGMENT)
            if gap is None:
                break
            yield text[at : gap.start()]
            at = gap.start()
        yield text[at:]

    def merge_rows(self, pieces: list[bytes], longest: int) -> list[bytes]:
        """Ids of pieces of 2 to ``longest`` bytes, all rows of one padded matrix."""
        n_bytes = np.array([len(p) for p in pieces])
        inside = np.arange(longest) < n_bytes[:, None]
        ids = np.full((len(pieces), longest), -1, np.int32)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        made = np.full((len(pieces), longest - 1), _NONE, np.int32)
        pair = inside[:, 1:]
        made[pair] = self.pairs.get(ids[:, :-1][pair], ids[:, 1:][pair])
        row, left = np.arange(len(pieces)), n_bytes
        final, count = np.zeros(ids.shape, "<u4"), np.zeros(len(pieces), np.int64)
        while True:
            k = made.argmin(axis=1) if made.shape[1] else np.zeros(len(row), np.int64)
            best = made[np.arange(len(row)), k] if made.shape[1] else np.full(len(row), _NONE)
            over = best == _NONE
            live = ~over
            if over.any():
                final[row[over], : ids.shape[1]], count[row[over]] = ids[over], left[over]
                if not live.any():
                    break
                ids, made, row, left, k, best = ids[live], made[live], row[live], left[live], k[live], best[live]
            # every row merges one pair: one column less
            at, col = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids = np.where(col <= k[:, None], ids[:, :-1], ids[:, 1:])
            ids[at, k] = best
            made = np.where(col[:-1] < k[:, None], made[:, :-1], made[:, 1:])
            left = left - 1
            before, after = np.flatnonzero(k > 0), np.flatnonzero(k < left - 1)
            fresh = self.pairs.get(np.concatenate([ids[before, k[before] - 1], best[after]]), np.concatenate([best[before], ids[after, k[after] + 1]]))
            made[before, k[before] - 1] = fresh[: len(before)]
            made[after, k[after]] = fresh[len(before) :]
        blob, ends = final[np.arange(longest) < count[:, None]].tobytes(), (4 * np.cumsum(count)).tolist()
        return [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long piece: a heap of pairs over a linked list."""
        if self.pair_made is None:
            used = self.pairs.keys != _EMPTY
            codes = self.pairs.keys[used]
            self.pair_made = dict(zip(zip((codes >> 24).tolist(), (codes & 0xFFFFFF).tolist(), strict=True), self.pairs.made[used].tolist(), strict=True))
        get = self.pair_made.get
        cur = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(cur)
        after, prior = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m, k, a, b) for k, (a, b) in enumerate(zip(cur, cur[1:], strict=False)) if (m := get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            m, k, a, b = heapq.heappop(heap)
            j = after[k] if cur[k] == a else -1
            if j < 0 or cur[j] != b:
                continue
            cur[k], cur[j], after[k] = m, -1, after[j]
            if after[k] >= 0:
                prior[after[k]] = k
            for x, y in ((prior[k], k), (k, after[k])):
                if x >= 0 and y >= 0 and (made := get((cur[x], cur[y]))) is not None:
                    heapq.heappush(heap, (made, x, cur[x], cur[y]))
        out, k = [], 0
        while k >= 0:
            out.append(cur[k])
            k = after[k]
        return np.array(out, np.int32)

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces not seen before, in one matrix for each length bucket and ``CELLS`` cells."""
        buckets: dict[int, list[int]] = {}
        raw = [p.encode("utf-8") for p in pieces]
        for i, b in enumerate(raw):
            whole = self.ranks.get(b)
            if whole is not None:
                self.pieces[pieces[i]] = np.uint32(whole).tobytes()
            elif len(b) > LONG:
                self.pieces[pieces[i]] = self.merge_long(b).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(b) - 1).bit_length(), []).append(i)
        for bits, members in sorted(buckets.items()):
            longest = 1 << bits
            step = max(1, CELLS // longest)
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                for i, ids in zip(part, self.merge_rows([raw[i] for i in part], longest), strict=True):
                    self.pieces[pieces[i]] = ids

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        found = [list(map(self.pieces.get, self.split(t))) for t in texts]
        late = [k for k, ids in enumerate(found) if None in ids]
        if late:
            split = {k: self.split(texts[k]) for k in late}
            self.learn(list({p for ps in split.values() for p in ps if p not in self.pieces}))
            for k, ps in split.items():
                found[k] = list(map(self.pieces.__getitem__, ps))
        return [b"".join(ids) for ids in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if all(len(t) <= SEGMENT for t in texts):
            return self._encode(texts)
        return [b"".join(self._encode([s])[0] for s in self.segments(t)) for t in texts]


class Spelled:
    """Byte strings by id, joined for a whole array of ids at once."""

    def __init__(self, strings: list[bytes]):
        self.raw = np.frombuffer(b"".join(strings) or b"\0", np.uint8)
        self.size = np.array([len(x) for x in strings], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)))[:-1]

    def join(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.raw[np.arange(ends[-1]) + np.repeat(self.at[ids] - (ends - size), size)].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _encoder(path: str, pattern: str, digests: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            for lo, hi in chunks(text):
                ids = [np.frombuffer(x, "<u4") for x in bpe.encode(text.slice(lo, hi - lo).to_pylist())]
                n = pa.array([len(x) for x in ids], pa.int64())
                back = [bpe.spelling.join(x) for x in ids]
                if digests:
                    named = {"ids_sha256": [hashlib.sha256(bpe.decimals.join(x)[:-1]).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in back]}
                    cols = [pa.array(v, pa.string()) for v in named.values()]
                else:
                    offs = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                    flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
                    named = {"ids": None, "decoded": None}
                    cols = [pa.ListArray.from_arrays(pa.array(offs), pa.array(flat)), pa.array([x.decode("utf-8") for x in back], pa.string())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), n, *cols], ["key", "n_tokens", *named])

    return encode


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Ids and decoded text of every whole text, or with ``digests`` their SHA-256 alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"key {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_encoder(path, pattern, digests), ddl)
    return out.withColumnRenamed("key", id_col)


def _decoder(path: str, pattern: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)

        def one(ids: list[int | None] | None) -> bytes | None:
            if ids is None or None in ids:
                return None
            x = np.array(ids, np.int64)
            sound = (x >= 0) & (x < len(bpe.known))
            return bpe.spelling.join(x) if sound.all() and bpe.known[x].all() else None

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(v.as_py()) for v in b.column(1)], pa.binary())], ["key", "decoded"])

    return decode


def decode_ids(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) of every list of ids; bytes, as a cut list may end within a character."""
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col), F.col(ids_col)).mapInArrow(_decoder(path, pattern), f"key {kind}, decoded binary").withColumnRenamed("key", id_col)
