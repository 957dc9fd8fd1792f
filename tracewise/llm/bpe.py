"""Byte-level BPE encoding and decoding (operator 2).

Vocabulary files are read, never trained.  A text is cut at the added special
tokens, then into words by the vocabulary's pattern; each distinct word of a
partition is encoded once.

Encoding works on all new words of a block together.  A *pair occurrence
index* maps every adjacent token pair that has a rank to all its positions in
the block.  Ranks that are active (have positions) come from a heap in
ascending order; one step merges every position of the pair with numpy and
adds the new neighbour pairs to the lists of their ranks.  Stale positions
are dropped when their rank's turn comes.  Within a word this is the usual
lowest-rank-first, left-to-right rule.

Defined results: a null text is empty; an empty text has no ids and decodes to
the empty text; rows are independent, so repeated rows give equal results; an
empty table gives an empty table.  Texts of any length are processed whole, in
blocks of words."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.common import appended, small_batches, text_chunks, with_columns

# fixed value: the word pattern of byte-level BPE vocabularies
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SHIFT = 20
WORDS_AT_ONCE = 200_000
CACHE_WORDS = 400_000


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks and token bytes of a byte-level BPE file; bounded by the file, so
    it is sent to the executors once."""

    def __init__(self, path: str, extra_tokens: tuple[str, ...] = ()):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        for t in extra_tokens:
            self.special[t] = size
            size += 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([(vocab[a] << _SHIFT) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.left, self.right = keys >> _SHIFT, keys & ((1 << _SHIFT) - 1)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)

        self._encoder = None

    def __getstate__(self):
        return self.__dict__ | {"_encoder": None}

    def encoder(self) -> Encoder:
        """One encoder per worker process: later partitions find its words."""
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is none."""
        key = (a << _SHIFT) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], -1)


class _PairIndex:
    """rank -> lists of positions, with a heap of the active ranks."""

    def __init__(self):
        self.lists: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        has = ranks >= 0
        ranks, positions = ranks[has], positions[has]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts), strict=True):
            if r in self.lists:
                self.lists[r].append(part)
            else:
                self.lists[r] = [part]
                heapq.heappush(self.heap, r)

    def pop(self) -> tuple[int, np.ndarray]:
        r = heapq.heappop(self.heap)
        return r, np.unique(np.concatenate(self.lists.pop(r)))


def encode_words(vocab: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Token ids of each (non-empty) word."""
    if not words:
        return []
    flat = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(sizes) - 1
    n = len(flat)
    tok = vocab.byte_id[flat]
    nxt = np.arange(1, n + 1)
    nxt[last] = -1
    prv = np.arange(-1, n - 1)
    prv[last[:-1] + 1] = -1
    alive = np.ones(n, bool)
    index = _PairIndex()
    at = np.flatnonzero(nxt >= 0)
    index.add(vocab.ranks(tok[at], tok[at + 1]), at)
    while index.heap:
        r, pos = index.pop()
        a, b, new = vocab.left[r], vocab.right[r], vocab.merged[r]
        pos = pos[alive[pos] & (tok[pos] == a) & (nxt[pos] >= 0)]
        pos = pos[tok[nxt[pos]] == b]
        if not len(pos):
            continue
        if a == b and len(pos) > 1:  # runs such as aaaa: every other position, from the left
            chained = np.concatenate([[False], nxt[pos[:-1]] == pos[1:]])
            k = np.arange(len(pos))
            begin = np.maximum.accumulate(np.where(chained, 0, k))
            pos = pos[(k - begin) % 2 == 0]
        gone = nxt[pos]
        after = nxt[gone]
        tok[pos] = new
        alive[gone] = False
        nxt[pos] = after
        has_after = after >= 0
        prv[after[has_after]] = pos[has_after]
        left = prv[pos]
        left = left[left >= 0]
        right = pos[has_after]
        both = np.concatenate([left, right])
        if len(both):
            index.add(vocab.ranks(tok[both], tok[nxt[both]]), both)
    kept = np.flatnonzero(alive)
    ids = tok[kept].astype("<u4")
    return np.split(ids, np.searchsorted(kept, last[:-1], "right"))


class Encoder:
    """Encodes texts, keeping the ids of words already seen (as packed bytes)."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.word = regex.compile(WORD_PATTERN)
        self.cache: dict[str, bytes] = {}
        marks = sorted(vocab.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None

    def _pieces(self, text: str) -> Iterator[list[str] | bytes]:
        """Lists of words, and the packed id of each special token between them."""
        parts = self.special.split(text) if self.special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield np.array([self.vocab.special[part]], "<u4").tobytes()
            elif len(part) < 4 * WORDS_AT_ONCE:
                if part:
                    yield self.word.findall(part)
            else:
                words = (m.group() for m in self.word.finditer(part))
                while block := list(islice(words, WORDS_AT_ONCE)):
                    yield block

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.cache]
        for w, ids in zip(new, encode_words(self.vocab, [w.encode() for w in new]), strict=True):
            self.cache[w] = ids.tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        for i, j in text_chunks(texts):
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            if j - i == 1:
                out = []
                for p in self._pieces(texts[i]):
                    if isinstance(p, list):
                        self._learn(set(p))
                        p = b"".join(map(self.cache.__getitem__, p))
                    out.append(p)
                yield b"".join(out)
                continue
            pieces = [list(self._pieces(t)) for t in texts[i:j]]
            self._learn({w for t in pieces for p in t if isinstance(p, list) for w in p})
            get = self.cache.__getitem__
            for t in pieces:
                yield b"".join(b"".join(map(get, p)) if isinstance(p, list) else p for p in t)


def decode_ids(vocab: Vocabulary, packed: bytes) -> str:
    """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
    ids = np.frombuffer(packed, "<u4")
    get = vocab.token_bytes.__getitem__
    return b"".join(b"".join(map(get, ids[i:i + 1_000_000].tolist()))
                    for i in range(0, len(ids), 1_000_000)).decode("utf-8", "replace")


def encode(df: DataFrame, vocab: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Append ``ids_col``: the ids of the whole text as little-endian unsigned
    32-bit integers (binary)."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        enc = shared.value.encoder()
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            yield appended(batch, {ids_col: pa.array(list(enc.encode(texts)), pa.binary())})

    return with_columns(df, run, f"`{ids_col}` binary")


def decode(df: DataFrame, vocab: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Append ``text_col``: the text of the packed ids."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        for batch in small_batches(batches):
            texts = [decode_ids(shared.value, p or b"") for p in batch.column(ids_col).to_pylist()]
            yield appended(batch, {text_col: pa.array(texts, pa.string())})

    return with_columns(df, run, f"`{text_col}` string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
