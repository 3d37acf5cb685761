"""BPE encoding and decoding over a contiguous rank array.

The vocabulary file's pre-tokenizer gives words; each word's merge runs over one
array of part boundaries and the ranks of adjacent pairs: the minimum is found by
a scan, its boundary deleted, and the two neighbouring ranks refreshed. Words
longer than SHORT_WORD use the same rule with a heap, as repeated scans would
take a time that grows with the square of the word. Encodings of whitespace
pieces are kept in a bounded memory per worker, since most pieces repeat.

Spark splits and streams the documents; no shuffle is needed, and a lost task
is simply run again.

The file's rules that are followed: NFC, white space dropped, lower case,
the split pattern, byte-level symbols with `</w>` on a word's last one, special
tokens found in the text first. Decoding joins the ids' token strings with one
blank, as the file names no decoder.

Defined cases: a null text is empty, with no ids and an empty decoded text; ids
out of the vocabulary raise an error; an empty table gives no rows; other columns
are ignored; repeated rows are encoded each, and rows without a doc_id too; a very long
text is encoded as a whole, word by word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT_WORD = 64
#: Pieces whose encodings a worker keeps, alone or beside the ids and texts that it gives out.
MEMORY, MEMORY_BESIDE = 300_000, 100_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            names[b] = chr(b)
        else:
            names[b] = chr(extra)
            extra += 1
    return names


class WordBpe:
    """Encoder and decoder of one vocabulary file (a JSON with word ends and no decoder)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max(*vocab.values(), *self.special.values()) + 1)
        for name, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = name
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.end] for s in symbols]
        #: (left, right) as one integer to (rank, joined).
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[left] << 32 | vocab[right]] = (rank, vocab[left + right])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.find_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.pieces: dict[str, tuple[bytes, str]] = {}
        self.memory = MEMORY

    def word(self, data: bytes) -> list[int]:
        ids = [*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]]
        return self._scan(ids) if len(ids) <= SHORT_WORD else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        none, merge = (1 << 60, -1), self.merge
        ranks = [merge.get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none or best[1] < 0:
                break
            at = ranks.index(best)
            ids[at] = best[1]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merge.get(ids[at - 1] << 32 | ids[at], none)
            if at < len(ranks):
                ranks[at] = merge.get(ids[at] << 32 | ids[at + 1], none)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        n, merge = len(ids), self.merge
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(found[0], k, ids[k], ids[k + 1], found[1]) for k in range(n - 1) if (found := merge.get(ids[k] << 32 | ids[k + 1]))]
        heapq.heapify(heap)
        while heap:
            _, k, left, right, joined = heapq.heappop(heap)
            j = after[k]
            if not live[k] or j >= n or ids[k] != left or ids[j] != right:
                continue
            ids[k], live[j], after[k] = joined, False, after[j]
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (found := merge.get(ids[x] << 32 | ids[y])):
                    heapq.heappush(heap, (found[0], x, ids[x], ids[y], found[1]))
        return [i for i, x in zip(ids, live, strict=True) if x]

    def _piece(self, piece: str) -> tuple[bytes, str]:
        text = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        ids = [i for w in self.split.findall(text) for i in self.word(w.encode())]
        found = np.array(ids, "<u4").tobytes(), " ".join(map(self.tokens.__getitem__, ids))
        if len(piece) <= SHORT_WORD:
            if len(self.pieces) >= self.memory:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _parts(self, text: str) -> list[tuple[bytes, str]]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python alone
            pieces = [p for p in regex.split(r"[\s--[\x1c-\x1f]]+", text, flags=regex.V1) if p]
        else:
            pieces = text.split()
        known = self.pieces.get
        return [known(p) or self._piece(p) for p in pieces]

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian unsigned 32-bit integers, and what decode() gives for them."""
        if "<|" in text and self.find_special.search(text):
            parts, at = [], 0
            for m in self.find_special.finditer(text):
                parts += self._parts(text[at : m.start()])
                parts.append((np.array([self.special[m[0]]], "<u4").tobytes(), m[0]))
                at = m.end()
            parts += self._parts(text[at:])
        else:
            parts = self._parts(text)
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    def decode(self, ids: np.ndarray) -> str:
        return " ".join([self.tokens[i] for i in ids])


_LOADED: dict[tuple[str, int], WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """One encoder a worker process and file."""
    key = (path, os.getpid())
    if key not in _LOADED:
        _LOADED[key] = WordBpe(path)
    return _LOADED[key]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int), decoded text of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        bpe.memory = MEMORY_BESIDE
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                ids = pa.array([np.frombuffer(x[0], "<u4").astype(np.int32) for x in found], pa.list_(pa.int32()))
                yield pa.record_batch([part.column(0), ids, pa.array([x[1] for x in found], pa.string())], names=["doc_id", "ids", "decoded"])
        bpe.pieces.clear()  # a worker that goes on with other work keeps the vocabulary alone

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def fingerprints(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 without moving ids or texts out of the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        bpe.memory = MEMORY
        for batch in batches:
            count, ids, text = [], [], []
            for t in batch.column(1):
                raw, decoded = bpe.encode(t.as_py() or "")
                count.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                text.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe_codec(docs: DataFrame) -> DataFrame:
    return fingerprints(docs, default_vocabulary())
