"""BPE encoding and decoding by speculation: greedy longest match proposes, pair checks verify, failing words merge exactly.

A word's tokens are its BPE encoding if each token encodes to itself and every two neighbours encode together to just
those two. The checks of a whole batch are one vectorised lookup of neighbour pairs; a pair seen for the first time is
settled once by merging it. Only words with a failing pair go through the merges.

Defined results: a null text is empty and has no ids. The vocabulary file's path is a parameter; every executor needs it
at that place.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.hashing import chunks

CACHE_WORDS = 400_000
CACHE_PAIRS = 1_000_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """One vocabulary with word ends, its normaliser and splitter read from the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): k for k, (a, b) in enumerate(merges)}
        self.made = [self.vocab[a + b] for a, b in merges]
        self.none = len(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word_re = regex.compile(split["pattern"]["Regex"], regex.V0)
        self.alphabet = byte_alphabet()
        self.table = {b: self.alphabet[b] for b in range(256)}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.base = max(self.names) + 1
        # a token stands in a proposal only if its own characters merge to it
        self.sound = {t: i for t, i in self.vocab.items() if self._merge(self._symbols_of(t)) == [i]}
        self.matcher = ahocorasick.Automaton()
        for token, i in self.sound.items():
            word = token[: -len(self.end)] + "\0" if self.end and token.endswith(self.end) and len(token) > len(self.end) else token
            self.matcher.add_word(word, i * 256 + len(word))
        self.matcher.make_automaton()
        self.pair_codes, self.pair_good = np.zeros(0, np.int64), np.zeros(0, bool)
        self.words: dict[str, bytes] = {}
        spelled = [(self.names.get(i, "") + " ").encode("utf-8") for i in range(self.base)]
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_len = np.array([len(x) for x in spelled], np.int64)
        self.spelled_at = np.concatenate(([0], np.cumsum(self.spelled_len)))[:-1]
        self.recent: set[str] = set()
        self.failed = 0

    def _symbols_of(self, token: str) -> list[int]:
        body, tail = (token[: -len(self.end)], self.end) if self.end and token.endswith(self.end) and len(token) > len(self.end) else (token, "")
        chars = list(body)
        chars[-1] += tail
        return [self.vocab[c] for c in chars] if all(c in self.vocab for c in chars) else []

    def _merge(self, ids: list[int]) -> list[int]:
        """The exact encoding: the lowest-ranked neighbour pair merges first, leftmost among equals."""
        rank, none = self.rank.get, self.none
        ids = list(ids)
        left = [rank(p, none) for p in zip(ids, ids[1:], strict=False)]
        while left:
            best = min(left)
            if best == none:
                break
            k = left.index(best)
            made = self.made[best]
            ids[k : k + 2] = [made]
            del left[k]
            if k:
                left[k - 1] = rank((ids[k - 1], made), none)
            if k < len(left):
                left[k] = rank((made, ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words: a heap of candidate pairs over a linked list."""
        import heapq

        n = len(ids)
        if n < 64:
            return self._merge(ids)
        nxt, prv, cur = [*range(1, n), -1], [*range(-1, n - 1)], list(ids)
        heap = [(self.rank[p], k, *p) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = nxt[k] if cur[k] == a else -1
            if j < 0 or cur[j] != b:
                continue
            cur[k], cur[j] = self.made[self.rank[a, b]], -1
            nxt[k] = nxt[j]
            if nxt[k] >= 0:
                prv[nxt[k]] = k
            for x, y in ((prv[k], k), (k, nxt[k])):
                if x >= 0 and y >= 0 and (cur[x], cur[y]) in self.rank:
                    heapq.heappush(heap, (self.rank[cur[x], cur[y]], x, cur[x], cur[y]))
        out, k = [], 0
        while k >= 0:
            out.append(cur[k])
            k = nxt[k]
        return out

    def _propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match over the sound tokens, for all words in one pass.

        Gives the ids, the word of each, and which words are not covered whole. A word's end mark is one NUL.
        """
        joined = "\0".join([*words, ""])
        found = np.fromiter((x for hit in self.matcher.iter_long(joined) for x in hit), np.int64).reshape(-1, 2)
        stop, code = found[:, 0] + 1, found[:, 1]
        ends = np.cumsum([len(w) + 1 for w in words])
        owner = np.searchsorted(ends, stop, "left")
        covered = np.bincount(owner, weights=code % 256, minlength=len(words)).astype(np.int64)
        return code // 256, owner, covered != np.diff(ends, prepend=0)

    def _pairs_fit(self, codes: np.ndarray) -> np.ndarray:
        """Whether each neighbour pair encodes to itself; unknown pairs are settled once and remembered."""
        if len(self.pair_codes) > CACHE_PAIRS:
            self.pair_codes, self.pair_good = np.zeros(0, np.int64), np.zeros(0, bool)
        new = np.setdiff1d(codes, self.pair_codes)
        if len(new):
            good = np.array([self._merge(self._symbols_of(self.names[a]) + self._symbols_of(self.names[b])) == [a, b] for a, b in zip((new // self.base).tolist(), (new % self.base).tolist(), strict=True)], bool)
            codes_all = np.concatenate([self.pair_codes, new])
            order = np.argsort(codes_all)
            self.pair_codes, self.pair_good = codes_all[order], np.concatenate([self.pair_good, good])[order]
        return self.pair_good[np.searchsorted(self.pair_codes, codes)]

    def learn(self, words: list[str]) -> None:
        """Encode words not seen before: propose all, check all neighbour pairs at once, merge those that fail."""
        mapped = [w.encode("utf-8").decode("latin-1").translate(self.table) for w in words]
        flat, owner, bad = self._propose(mapped)
        inner = owner[1:] == owner[:-1]
        if inner.any():
            fits = self._pairs_fit((flat[:-1] * self.base + flat[1:])[inner])
            bad[owner[1:][inner][~fits]] = True
        blob, at = flat.astype("<u4").tobytes(), (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        for k, w in enumerate(words):
            self.words[w] = blob[at[k] : at[k + 1]]
        self.failed += int(bad.sum())
        for k in np.flatnonzero(bad).tolist():
            chars = list(mapped[k])
            chars[-1] += self.end
            ids = self._merge_long([self.vocab[c] for c in chars if c in self.vocab])
            self.words[words[k]] = np.asarray(ids, "<u4").tobytes()

    @staticmethod
    def normalize(text: str) -> str:
        """NFC, white space as one blank, lower case character by character."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # str.lower alone would look at the neighbours of this letter
                return "σ".join(x.lower() for x in text.split("Σ"))
        return text.lower()

    def split(self, text: str) -> list[str]:
        """Words of a text, special tokens among them as they are."""
        if self.special_re is None or not any(s in text for s in self.special):
            return self.word_re.findall(self.normalize(text))
        out: list[str] = []
        for part in self.special_re.split(text):
            out += [part] if part in self.special else self.word_re.findall(self.normalize(part))
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHE_WORDS:
            self.words = {w: self.words[w] for w in self.recent if w in self.words}
        if not all(s in self.words for s in self.special):
            self.words |= {s: np.asarray([i], "<u4").tobytes() for s, i in self.special.items()}
        split = [self.split(t) for t in texts]
        self.recent = {w for ws in split for w in ws}
        fresh = [w for w in self.recent if w not in self.words]
        if fresh:
            self.learn(fresh)
        return [b"".join(map(self.words.__getitem__, ws)) for ws in split]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: without a decoder in the file, the tokens' names with a blank between."""
        i = np.frombuffer(ids, "<u4")
        size = self.spelled_len[i]
        ends = np.cumsum(size)
        if not len(i):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.spelled_at[i] - (ends - size), size)
        return self.spelling[at].tobytes()[:-1]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def _encoder(path: str, digests: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            for lo, hi in chunks(text):
                ids = bpe.encode_all(text.slice(lo, hi - lo).to_pylist())
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                back = (bpe.decode(x) for x in ids)
                if digests:
                    cols = [pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in back])]
                    names = ["ids_sha256", "decoded_sha256"]
                else:
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    offs = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
                    cols, names = [pa.ListArray.from_arrays(pa.array(offs), pa.array(flat)), pa.array([x.decode("utf-8") for x in back], pa.string())], ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), n, *cols], ["key", "n_tokens", *names])

    return encode


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Ids and decoded text of every whole text, or with ``digests`` their SHA-256 alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"key {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_encoder(path, digests), ddl)
    return out.withColumnRenamed("key", id_col)
