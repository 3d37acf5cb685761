"""Token ids as length-delimited binary records, with a separate offset index.

A record file (`*.rec`) holds one record a document, in ascending doc_id:

    length of the payload   unsigned 64-bit
    masked crc32 of it      unsigned 32-bit
    payload                 doc_id (signed 64-bit), ids (unsigned 16- or 32-bit)
    masked crc32 of it      unsigned 32-bit

all little-endian. A mask turns a checksum by 15 bits and adds a constant, as a
checksum over data that holds checksums is weak. The index file (`*.idx`) has one
entry a record: byte offset, length of the payload (unsigned 64-bit), doc_id
(signed 64-bit) and ids (unsigned 64-bit), so that readers can seek in any order.

Writing: documents are range-partitioned by doc_id, and each task writes its range
as one file under a name of its own attempt. Only files named by tasks that
succeeded are in the manifest, so lost or repeated tasks leave nothing behind that
is read. Files are opened by URI with pyarrow, so shared stores work as folders do.

Ids come from the tokenizers library; each new word is encoded once and kept in a
bounded memory.

Defined cases: a null text is empty and has the end id alone; rows without a doc_id
are left out; rows that repeat a doc_id are written each, in order of their text's
checksum; a very long text is one record; an empty table gives no files; other columns
are ignored; a damaged record raises ValueError.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path

MASK = 0xA282EAD8
HEAD, FOOT, DOC, ENTRY = 12, 4, 8, 32
#: The alphabet of bytes: those that print stand for themselves, others for the characters from 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PRINTED]
BYTES = "".join(chr(b if b in PRINTED else 256 + OTHERS.index(b)) for b in range(256))
#: The first character after the Latin letters, which all versions of Unicode know as letters.
LATIN = "\u0250"
#: Words that a worker keeps.
MEMORY = 1_000_000
#: Bytes of records that one read takes on.
READ_BYTES = 4 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, masked(size).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def unframed(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the record at a place in data, and the place after it."""
    size = data[at : at + 8]
    if len(size) < 8 or masked(size) != int.from_bytes(data[at + 8 : at + HEAD], "little"):
        raise ValueError(f"damaged record length at byte {at}")
    end = at + HEAD + int.from_bytes(size, "little")
    payload = data[at + HEAD : end]
    if masked(payload) != int.from_bytes(data[end : end + FOOT], "little"):
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + FOOT


class Encoder:
    """tokenizers' ids of whole texts, with a bounded memory of words.

    A blank or line feed between other than white space starts a part of its own in the split pattern, so a text
    without other white space is its words' ids in order. A new word of Latin letters is one part, which the library's
    model gets as it is, in the alphabet of bytes; other new words are encoded many at a time, with line feeds
    between them, and parted at the line feeds' id. Any other text is encoded as it is.
    """

    #: White space other than blanks and line feeds, and the bytes without which a text has none.
    odd, hints = re.compile(r"[^\S \n]"), bytes([9, 11, 12, 13, *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3])
    marks = frozenset(".,;:!?")
    pairs, edge = ("  ", " \n", "\n ", "\n\n"), (" ", "\n")

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.model, self.kind = Tokenizer.from_file(path), f"<u{width}"
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        feed = self._ids("a\nb")
        self.feed = int(feed[1]) if len(feed) == 3 else None
        self.feed_raw = feed[1:2].tobytes()
        split = self.model.pre_tokenizer
        byte_level = isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        #: The model itself, where parts of letters reach it unchanged.
        self.part = self.model.model.tokenize if byte_level and isinstance(self.model.model, BPE) and self.model.normalizer is None else None
        self.kinds = [struct.Struct(f"<{n}{'H' if width == 2 else 'I'}").pack for n in range(64)]
        #: Ids of words after a blank, and of a line feed with the word after it.
        self.known: dict[str, bytes] = {}
        self.mark_ids: dict[str, bytes] = {}

    def _plain(self, t: str) -> bool:
        if self.feed is None or any(s in t for s in self.special) or any(x in t for x in self.pairs) or t[:1] in self.edge or t[-1:] in self.edge:
            return False
        raw = t.encode("utf-8", "surrogatepass")
        return len(raw.translate(None, self.hints)) == len(raw) or not self.odd.search(t)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _encode_letters(self, words: list[str]) -> None:
        """Words of Latin letters, each a part with the blank before it or after its line feed."""
        if not words:
            return
        part, known, kinds = self.part, self.known, self.kinds
        lines = [w[0] == "\n" for w in words]
        raw = "\n".join([w[1:] if line else " " + w for w, line in zip(words, lines, strict=True)])
        # Line feeds are of the alphabet too.
        for w, line, x in zip(words, lines, charmap_decode(raw.encode(), "strict", BYTES)[0].split(BYTES[10]), strict=True):
            ids = [y.id for y in part(x)]
            out = kinds[len(ids)](*ids) if len(ids) < 64 else np.array(ids, self.kind).tobytes()
            known[w] = self.feed_raw + out if line else out

    def _encode_words(self, words: list[str]) -> None:
        """Words of one kind; the known ids get those of their line feed too."""
        if not words:
            return
        lead, start = (self.feed_raw, 1) if words[0][0] == "\n" else (b"", 0)
        pad = "" if start else " "
        for lo in range(0, len(words), 4096):
            part = words[lo : lo + 4096]
            ids = self._ids("\n".join([pad + w[start:] for w in part]))
            cut = np.flatnonzero(ids == self.feed)
            if len(cut) == len(part) - 1:
                raw, ends = ids.tobytes(), (np.append(cut, len(ids)) * ids.itemsize).tolist()
                starts = [0, *[x + ids.itemsize for x in ends[:-1]]]
                self.known.update(zip(part, [lead + raw[x:y] for x, y in zip(starts, ends, strict=True)], strict=True))
            else:
                self.known.update((w, lead + self._ids(pad + w[start:]).tobytes()) for w in part)

    def _learn(self, new: set[str]) -> None:
        # Letters and a mark after them are parts of their own: only the letters are encoded.
        marked = [w for w in new if w[-1] in self.marks and w[w[0] == "\n" : -1].isalpha()]
        new.difference_update(marked)
        new.update({w[:-1] for w in marked}.difference(self.known))
        if self.part is not None:
            letters = [w for w in new if w[w[:1] == "\n" :].isalpha() and (w.isascii() or max(w) < LATIN)]
            self._encode_letters(letters)
            new.difference_update(letters)
        self._encode_words([w for w in new if w[0] != "\n"])
        self._encode_words([w for w in new if w[0] == "\n"])
        for w in marked:
            mark = w[-1]
            if mark not in self.mark_ids:
                self.mark_ids[mark] = self._ids(mark).tobytes()
            self.known[w] = self.known[w[:-1]] + self.mark_ids[mark]

    def encode(self, texts: list[str]) -> list[bytes]:
        docs = [("\n" + t).replace("\n", " \n")[1:].split(" ") if self._plain(t) else None for t in texts]
        words = set().union(*[d for d in docs if d])
        if len(self.known) > MEMORY:  # the words of these texts stay, so frequent ones do
            self.known = {w: self.known[w] for w in words if w in self.known}
        self.known["\n"] = self.feed_raw
        self._learn(words.difference(self.known))
        get, skip = self.known.__getitem__, len(self.feed_raw)
        return [self._ids(t).tobytes() if d is None else b"".join(map(get, d))[skip:] for t, d in zip(texts, docs, strict=True)]


_LOADED: dict[tuple[str, int, int], Encoder] = {}


def loaded(path: str, width: int) -> Encoder:
    key = (path, width, os.getpid())
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, width)
    return _LOADED[key]


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str, width: int = 2) -> DataFrame:
    """Writes docs (doc_id, text) to record files under `folder`; returns the manifest: file, n_records, n_ids, first_id, last_id.

    `width`: bytes of an id, 2 where the vocabulary has at most 65,536.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    ordered = rows.withColumn("tie", F.crc32(F.col("text").cast("binary"))).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = loaded(tokenizer, width), np.array([end_id], f"<u{width}").tobytes()
        where = store = out = index = None
        at = n = ids = 0
        low = high = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                if part.num_rows and out is None:
                    where = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
                    store, plain = fs.FileSystem.from_uri(where)
                    store.create_dir(os.path.dirname(plain), recursive=True)
                    out, index = store.open_output_stream(f"{plain}.rec", buffer_size=1 << 20), store.open_output_stream(f"{plain}.idx", buffer_size=1 << 20)
                for doc, raw in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    payload = doc.to_bytes(8, "little", signed=True) + raw + end
                    record = framed(payload)
                    count = len(raw) // width + 1
                    out.write(record)
                    index.write(b"".join((at.to_bytes(8, "little"), len(payload).to_bytes(8, "little"), doc.to_bytes(8, "little", signed=True), count.to_bytes(8, "little"))))
                    low, high = doc if low is None else low, doc
                    at, n, ids = at + len(record), n + 1, ids + count
        if out is not None:
            out.close()
            index.close()
            yield pa.record_batch([pa.array([x], t) for x, t in ((where, pa.string()), (n, pa.int64()), (ids, pa.int64()), (low, pa.int64()), (high, pa.int64()))], names=["file", "n_records", "n_ids", "first_id", "last_id"])

    manifest = ordered.select("doc_id", "text").mapInArrow(run, "file string, n_records long, n_ids long, first_id long, last_id long")
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


def read_index(manifest: DataFrame, width: int = 2) -> DataFrame:
    """file, entry, offset, length, doc_id, n_ids, start of each record; `start`: ids of all records before it in file order."""
    # One row a file: starts of the files are summed on the driver.
    total, starts = 0, []
    for r in sorted(manifest.collect(), key=lambda r: os.path.basename(r.file)):
        starts.append((r.file, total))
        total += r.n_ids
    files = manifest.sparkSession.createDataFrame(starts, "file string, before long").repartition(max(1, len(starts)), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, plain = fs.FileSystem.from_uri(file)
                with store.open_input_stream(f"{plain}.idx") as f:
                    done = 0
                    while raw := f.read(ENTRY * 65536):
                        x = np.frombuffer(raw, "<i8").reshape(-1, 4)
                        start = before + np.cumsum(x[:, 3]) - x[:, 3]
                        before, entry = int(start[-1] + x[-1, 3]), done + np.arange(len(x))
                        done += len(x)
                        yield pa.record_batch([pa.array([file] * len(x)), *(pa.array(np.ascontiguousarray(c)) for c in (entry, x[:, 0], x[:, 1], x[:, 2], x[:, 3], start))], names=["file", "entry", "offset", "length", "doc_id", "n_ids", "start"])

    return files.mapInArrow(run, "file string, entry long, offset long, length long, doc_id long, n_ids long, start long")


def read_records(entries: DataFrame, width: int = 2, ids: bool = True) -> DataFrame:
    """The records of index entries, read in the order given: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    Entries that follow each other in a file are read at once; shuffled ones are sought one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file, f = None, None
        for batch in batches:
            file, offset, length, doc, start = (batch.column(k).to_pylist() for k in range(5))
            k = 0
            while k < len(file):
                if file[k] != open_file:
                    if f is not None:
                        f.close()
                    store, plain = fs.FileSystem.from_uri(file[k])
                    f, open_file = store.open_input_file(f"{plain}.rec"), file[k]
                m, stop = k, offset[k] + HEAD + length[k] + FOOT
                while m + 1 < len(file) and file[m + 1] == open_file and offset[m + 1] == stop and stop - offset[k] < READ_BYTES:
                    m += 1
                    stop = offset[m] + HEAD + length[m] + FOOT
                f.seek(offset[k])
                data, at, rows = f.read(stop - offset[k]), 0, []
                for j in range(k, m + 1):
                    payload, at = unframed(data, at)
                    if int.from_bytes(payload[:DOC], "little", signed=True) != doc[j]:
                        raise ValueError(f"{open_file}: the index names document {doc[j]}, the record another")
                    x = np.frombuffer(payload, f"<u{width}", offset=DOC)
                    rows.append((doc[j], start[j], len(x), zlib.crc32(x.astype("<u4").tobytes()), x.astype(np.int32) if ids else None))
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids]
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
                yield pa.record_batch([pa.array([r[c] for r in rows], kinds[c]) for c in range(len(names))], names=names)
                k = m + 1
        if f is not None:
            f.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return entries.select("file", "offset", "length", "doc_id", "start").mapInArrow(run, schema)


def shuffled(entries: DataFrame, seed: int) -> DataFrame:
    """Index entries in a random order that the seed fixes: readers then seek through the files."""
    key = F.xxhash64("file", "entry", F.lit(seed))
    return entries.repartitionByRange(key).sortWithinPartitions(key)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_records(docs: DataFrame) -> DataFrame:
    manifest = write_records(docs, default_tokenizer(), 2, new_path(docs.sparkSession, "records"))
    return read_records(read_index(manifest), ids=False)
