"""Token files: documents as token ids in independent zstandard frames with a trailing seek table.

A file holds documents in ascending doc_id order::

    frame*            zstandard frames; content: ids as little-endian uint32, whole documents back to back
    directory         one more zstandard frame: a row for each document (see DIRECTORY)
    seek table        a skippable frame: (compressed size, content size, checksum) of each frame, then a footer

The seek table is the published seekable zstandard layout, so any reader of it can jump to a frame.  A reader takes
the footer, the table and the directory, and then decompresses only the frames that hold the documents asked for.  A
document longer than FRAME_IDS ids has frames of its own and runs over as many as it needs.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import Words, scratch_path, slices, stage, text_array

# Fixed values of the seekable zstandard layout.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
FOOTER = struct.Struct("<IBI")

DIRECTORY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("at", "<u4"), ("n_ids", "<u8")])
FRAME_IDS = 1 << 16
CACHED_WORDS = 1_000_000
SLICE = 6 << 20

#: A word's end marks; behind an ASCII letter or digit they are always a piece of their own.  Fixed value.
_MARKED = re.compile(rb"(.*[a-z0-9])([!\"#$%&()*+,\-./:;=?@\[\]\\^_`{}~]+)", re.DOTALL)


class WordIds:
    """Ids of the words met so far by this process, back to back in one array; forgotten beyond CACHED_WORDS."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        # tokens that the vocabulary splits off as they are written, before it folds case
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._require_words()
        self.forget()

    def _require_words(self) -> None:
        """Texts are encoded word by word: refuse a vocabulary that does not fold case, or that sees white space."""
        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        words = ["Apple", "(pie)", "don't", "x1", "É", "日本", "--"]
        apart = [i for w in words for i in ids(w)]
        if any(ids(sep.join(words)) != apart for sep in (" ", "  ", "\n", "\t \r\n")) or ids(" \n ") or any(ids(w) != ids(w.lower()) for w in words) \
                or any(len(m.split()) != 1 or m.split()[0] != m for m in self.marks):
            raise ValueError("the vocabulary's ids of a text are not those of its lower-case words in turn")

    def forget(self) -> None:
        """Words are known by 128 bits of their hash, in sorted arrays: a tenth of what a dictionary of them takes."""
        self.low, self.high, self.place = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.ends, self.count = np.zeros(1 << 20, np.uint32), np.zeros(1 << 18, np.int64), 0

    def _find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(places of the words, -1 where they are not known; their hashes)."""
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
        if not len(self.low):
            return np.full(len(words), -1), hashes
        at = np.minimum(np.searchsorted(self.low, hashes[:, 0]), len(self.low) - 1)
        return np.where((self.low[at] == hashes[:, 0]) & (self.high[at] == hashes[:, 1]), self.place[at], -1), hashes

    def _add(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray, of: dict[bytes, int]) -> None:
        """Words with the ids of all of them back to back and where each one's end; ``of`` gets their places."""
        n, at = len(words), self.ends[self.count]
        while self.count + n + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at:at + len(ids)] = ids
        self.ends[self.count + 1:self.count + n + 1] = at + ends
        of.update(zip(words, range(self.count, self.count + n)))
        self.count += n

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each of some different words; new ones are encoded."""
        at, hashes = self._find(words)
        new = np.flatnonzero(at < 0)
        if len(new):
            if self.count + 2 * len(new) > CACHED_WORDS:
                self.forget()
                new = np.arange(len(words))
            of = self._learn([words[k] for k in new.tolist()])
            at[new] = [of[words[k]] for k in new.tolist()]
            low, high, place = (np.concatenate(x) for x in ((self.low, hashes[new, 0]), (self.high, hashes[new, 1]), (self.place, at[new])))
            order = np.argsort(low, kind="stable")
            self.low, self.high, self.place = low[order], high[order], place[order]
        return at

    def _learn(self, new: list[bytes]) -> dict[bytes, int]:
        """Places of new words.  Plain ones are encoded many in one text, each being one piece of it; a marked word is
        its two pieces."""
        pairs = {w: m.groups() for w in new if (m := _MARKED.fullmatch(w))}
        pieces = list(dict.fromkeys([*(w for w in new if w not in pairs), *(x for two in pairs.values() for x in two)]))
        of = {w: p for w, p in zip(pieces, self._find(pieces)[0].tolist()) if p >= 0}
        plain, other = [], []
        for w in pieces:
            if w not in of:
                (plain if _one_piece(w.decode()) else other).append(w)
        for i in range(0, len(plain), 2_000):
            part = plain[i:i + 2_000]
            e = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False)
            ends = np.searchsorted(np.array(e.word_ids), np.arange(len(part)), "right")
            self._add(part, np.array(e.ids, np.uint32), ends, of)
        for w in other:
            ids = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32)
            self._add([w], ids, np.array([len(ids)]), of)
        marked = list(pairs)
        at = np.array([of[x] for w in marked for x in pairs[w]], np.int64)
        take, sizes = _ranges(self.ends[at], self.ends[at + 1])
        self._add(marked, self.flat[take], np.cumsum(sizes)[1::2], of)
        return of


def _one_piece(word: str) -> bool:
    """Letters only, in the form that the vocabulary compares."""
    return word.isascii() and word.isalpha() or word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every index of the ranges in turn, and the ranges' sizes."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    return np.repeat(starts - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0), sizes


_known: dict[str, WordIds] = {}


def encode_texts(texts: pa.Array, tokenizer_path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of the texts, ``end_id`` after each.

    The vocabulary folds case, drops white space and never merges across it, so a text's ids are those of its words in
    turn; each different word is encoded once.  Words that hold a token which the vocabulary splits off unfolded are
    encoded in their own case.
    """
    known = _known.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
    _known[tokenizer_path] = known
    data = texts.buffers()[2] if len(texts) else None
    marked = data is not None and any(m.lower() in data.to_pybytes().lower() for m in known.marks)
    words = Words(texts, lower=not marked)
    # a word with one of the vocabulary's marks keeps its case: only as it is written it is the mark
    vocab = [w if any(m.lower() in w.lower() for m in known.marks) else w.lower() for w in words.vocab] if marked else words.vocab
    number = {w: k for k, w in enumerate(dict.fromkeys(vocab))} if marked else {}
    at = known.places(list(number))[[number[w] for w in vocab]] if marked else known.places(vocab)
    # one more "word" at the end of each text, one place for the end id
    starts, ends = np.append(known.ends[at], 0), np.append(known.ends[at + 1], 1)
    codes = np.insert(words.codes, words.bounds[1:], len(vocab))
    take, sizes = _ranges(starts[codes], ends[codes])
    ids = known.flat[take]
    bounds = np.concatenate([[0], np.cumsum(sizes)])[words.bounds + np.arange(len(texts) + 1)]
    ids[bounds[1:] - 1] = end_id
    return ids, bounds


# --- one file ----------------------------------------------------------------------------------------------------
class FileWriter:
    """Writes one token file to a binary stream."""

    def __init__(self, out, level: int = 3):
        self.out, self.pack = out, zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.parts: list[bytes] = []
        self.held = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > FRAME_IDS:
            self._flush()
        self.rows.append((doc_id or 0, doc_id is not None, len(self.entries), self.held, len(ids)))
        self.n_ids += len(ids)
        for i in range(0, max(len(ids), 1), FRAME_IDS):
            part = ids[i:i + FRAME_IDS]
            self.parts.append(part.astype("<u4").tobytes())
            self.held += len(part)
            if self.held >= FRAME_IDS:
                self._flush()

    def _flush(self) -> None:
        self._frame(b"".join(self.parts))
        self.parts, self.held = [], 0

    def _frame(self, content: bytes) -> None:
        packed = self.pack.compress(content)
        self.out.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._flush()
        self._frame(np.array(self.rows, DIRECTORY).tobytes())
        table = np.array(self.entries, ENTRY).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER.size) + table
                       + FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC))


class FileReader:
    """Random access to one token file through a seekable binary stream."""

    def __init__(self, stream):
        self.stream, self.unpack = stream, zstandard.ZstdDecompressor()
        size = stream.seek(0, 2) or stream.tell()
        stream.seek(size - FOOTER.size)
        frames, _, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a token file: no seek table at its end")
        stream.seek(size - FOOTER.size - frames * ENTRY.itemsize)
        self.entries = np.frombuffer(stream.read(frames * ENTRY.itemsize), ENTRY)
        self.at = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.frames_read = 0
        self.directory = np.frombuffer(self.frame(frames - 1), DIRECTORY)

    def frame(self, k: int) -> bytes:
        self.stream.seek(int(self.at[k]))
        content = self.unpack.decompress(self.stream.read(int(self.entries["packed"][k])), int(self.entries["size"][k]))
        if len(content) != self.entries["size"][k] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.entries["checksum"][k]:
            raise ValueError(f"frame {k} is damaged")
        self.frames_read += 1
        return content

    def documents(self, rows: np.ndarray | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids as bytes) of the directory rows asked for, all by default; a frame is read once in a run."""
        held, content = -1, b""
        for row in self.directory if rows is None else rows:
            k, at, left, parts = int(row["frame"]), int(row["at"]) * 4, int(row["n_ids"]) * 4, []
            while left:
                if held != k:
                    held, content = k, self.frame(k)
                parts.append(content[at:at + left])
                left -= len(parts[-1])
                k, at = k + 1, 0
            yield (int(row["doc_id"]) if row["known"] else None), b"".join(parts)

    def read(self, doc_ids: Sequence[int]) -> dict[int, np.ndarray]:
        rows = self.directory[np.isin(self.directory["doc_id"], list(doc_ids)) & (self.directory["known"] == 1)]
        return {d: np.frombuffer(b, "<u4") for d, b in self.documents(rows)}


# --- on Spark ----------------------------------------------------------------------------------------------------
def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file:///") else uri)


def _writer(root: str, tokenizer_path: str, end_id: int, level: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, folder = _open(root)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/part-{part:06d}.tokens"
        own = f"{name}.{uuid.uuid4().hex}.tmp"  # a repeated or speculative attempt never touches a finished file
        n = 0
        with system.open_output_stream(own) as out:
            file = FileWriter(out, level)
            for batch in slices(batches, "text", SLICE):
                ids, bounds = encode_texts(text_array(batch, "text"), tokenizer_path, end_id)
                for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                    file.add(doc_id, ids[bounds[i]:bounds[i + 1]])
                    n += 1
            file.close()
        if not n:
            system.delete_file(own)
            return
        try:
            system.move(own, name)
        except OSError:  # a store that doesn't replace: another attempt wrote the same bytes
            system.delete_file(own)
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [n], "n_ids": [file.n_ids]})
    return write


def write_tokens(docs: DataFrame, root: str, tokenizer_path: str, end_id: int = 2, level: int = 3) -> DataFrame:
    """Encode whole texts and write them under ``root`` in ascending doc_id order; returns the manifest.

    The documents are range-partitioned by doc_id before they are encoded, one file each; a null text is empty, a null
    doc_id comes first, rows that repeat a doc_id are all written, next to each other.  Columns other than doc_id and
    text are ignored.  An empty table gives an empty manifest and no files.  Manifest: part, file, n_docs, n_ids.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.mapInArrow(_writer(root, tokenizer_path, end_id, level), "part long, file string, n_docs long, n_ids long"), "manifest")


def _reader(root: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(root)
        for batch in batches:
            for name, at in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                with system.open_input_file(name) as stream:
                    rows = []
                    for doc_id, content in FileReader(stream).documents():
                        rows.append((doc_id, at, len(content) // 4, zlib.crc32(content)))
                        at += len(content) // 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return read


def read_digests(manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files that the manifest names."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row for each file
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = files.repartition(max(manifest.count(), 1), F.col("part"))
    return spread.select("file", "before").mapInArrow(_reader(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read every document's digest back from them."""
    root = scratch_path(docs.sparkSession, "tokens")
    return read_digests(write_tokens(docs, root, tokenizer_path, end_id), root)
