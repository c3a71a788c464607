"""Token-id files: each document compressed on its own, with a dictionary shared by all.

A file holds, in ascending doc_id order, one zstandard frame per document (its ids as
little-endian integers of the stated width) and after them an index of doc_id, offset and
id count, so that one short document can be read alone. The header names the dictionary by
its SHA-256; a reader refuses any other.

    header  8 bytes magic, 1 byte id width, 32 bytes dictionary hash
    frames  one per document
    index   per document: doc_id int64, 1 byte doc_id is null, offset uint64, ids uint64
    footer  index offset uint64, documents uint64, 8 bytes magic

Files are written by tasks through the file system that the shared folder's URI names,
under a new name per attempt; the list of files is what the successful attempts return, so
repeated or lost attempts do no harm.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.sources.workspace import new_path, stage

MAGIC = b"TILLTOK1"
END_ID = 2
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 2000  # about so many documents train the dictionary
SAMPLE_IDS = 4096  # ids of a sampled document that go into training
LEVEL = 3
CACHED_WORDS = 1_000_000  # of these and the generation before, each worker keeps the ids
_INDEX = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("offset", "<u8"), ("n", "<u8")])
_HEAD, _FOOT = len(MAGIC) + 1 + 32, 16 + len(MAGIC)


class WordEncoder:
    """Ids of whole texts from a lower-casing tokenizer that drops white space.

    No token and no rule of such a tokenizer spans white space, so the words between are
    encoded once each and put together; the result is that of encoding the whole text. A
    run of letters and the signs after it are encoded apart too. It is for tokenizers of the
    kind of word_bpe_49k: lower case, NFC, runs of letters, byte-level merges.
    """

    _LETTERS_SIGNS = re.compile(rb"([a-z]+)([!-&(-/:-@\[-`{-~]+)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        # for words that are one run of letters, only lowering and the merges are left
        bare, letters = Tokenizer(self._tokenizer.model), Tokenizer(self._tokenizer.model)
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        letters.normalizer = normalizers.Lowercase()
        letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self._bare, self._letters = bare, letters
        (self._sign,) = bare.encode("!", add_special_tokens=False).ids
        self._words: dict[bytes, bytes] = {b"": b""}
        self._older: dict[bytes, bytes] = {}

    def _ask_together(self, tokenizer, words: list[bytes]) -> None:
        """Words of letters as one text, with a sign between them that has an id of its own."""
        whole = tokenizer.encode_batch_fast([b" ! ".join(words).decode()], add_special_tokens=False)[0]
        ids = np.array(whole.ids)
        cut = np.flatnonzero(ids == self._sign) * self.width
        raw = ids.astype(f"<u{self.width}").tobytes()
        begin, end = [0, *(cut + self.width).tolist()], [*cut.tolist(), len(raw)]
        self._words.update(zip(words, map(raw.__getitem__, map(slice, begin, end))))

    def _ask(self, words: list[bytes]) -> None:
        plain, lettered, other = [], [], []
        for w in words:
            if w.isascii():
                (plain if w.isalpha() and w.islower() else other).append(w)
            else:
                t = w.decode("utf-8", "surrogatepass")
                simple = t.isalpha() and t.lower().isalpha() and unicodedata.is_normalized("NFC", t)
                (lettered if simple else other).append(w)
        if plain:
            self._ask_together(self._bare, plain)
        if lettered:
            self._ask_together(self._letters, lettered)
        if other:
            texts = [w.decode("utf-8", "surrogatepass") for w in other]
            found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            kind = f"<u{self.width}"
            self._words.update((w, np.array(e.ids, kind).tobytes()) for w, e in zip(other, found))

    def _learn(self, words: set[bytes]) -> None:
        if len(self._words) > CACHED_WORDS:
            self._words, self._older = {b"": b""}, self._words
        missing, split = [], []
        for w in words:
            if w in self._older:
                self._words[w] = self._older[w]
            elif m := self._LETTERS_SIGNS.fullmatch(w):
                split.append((w, *m.groups()))
            else:
                missing.append(w)
        parts = {p for _, *s in split for p in s}.difference(self._words).difference(missing)
        unknown = parts.difference(self._older)
        self._words.update((p, self._older[p]) for p in parts - unknown)
        missing += unknown
        if missing:
            self._ask(missing)
        self._words.update((w, self._words[a] + self._words[b]) for w, a, b in split)

    def encode(self, texts: Sequence[str | None], end_id: int = END_ID) -> list[bytes]:
        """The ids of each text and the end id, as bytes."""
        split, end = [], end_id.to_bytes(self.width, "little")
        for text in texts:
            raw = (text or "").encode("utf-8", "surrogatepass")
            # signs of a special token might come about by lowering
            split.append((raw if b"<|" in raw else raw.lower()).split())
        found = [list(map(self._words.get, words)) for words in split]
        gaps = [(f, w, i) for f, w in zip(found, split) if None in f for i, x in enumerate(f) if x is None]
        if gaps:
            self._learn({w[i] for _, w, i in gaps})
            for f, w, i in gaps:
                f[i] = self._words[w[i]]
        return [b"".join(f) + end for f in found]


def _groups(texts: Sequence[str | None], most: int = 128, chars: int = 4 << 20) -> Iterator[slice]:
    """Slices of at most ``most`` texts that are bounded in size, but for a text alone."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > first and (i - first == most or size + n > chars):
            yield slice(first, i)
            first, size = i, 0
        size += n
    if len(texts) > first:
        yield slice(first, len(texts))


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()


def _as_dictionary(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A zstandard dictionary of a bounded sample: about SAMPLE_DOCS documents by hash, of
    each at most SAMPLE_IDS ids. Too few samples give their plain bytes as dictionary."""
    n = docs.count()
    few = F.pmod(F.xxhash64("doc_id", F.lit("dictionary")), F.lit(1 << 20)) < F.lit(
        int((1 << 20) * min(1.0, SAMPLE_DOCS / max(n, 1)))
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(tokenizer)
        for b in batches:
            texts = b.column(0).to_pylist()
            ids = [x[: SAMPLE_IDS * e.width] for cut in _groups(texts) for x in e.encode(texts[cut])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    sampled = docs.where(few).select("text").mapInArrow(encode, "ids binary")
    samples = [bytes(r.ids) for r in sampled.limit(2 * SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sorted(samples))[:DICTIONARY_BYTES]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if ":" not in uri.split("/")[0]:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class TokenFile:
    """Reads one file; any document alone through the index."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = _open(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        head = self._file.read_at(_HEAD, 0)
        foot = self._file.read_at(_FOOT, size - _FOOT)
        if head[: len(MAGIC)] != MAGIC or foot[16:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        if head[len(MAGIC) + 1 :] != dictionary_hash(dictionary):
            raise ValueError(f"{uri} was written with another dictionary")
        self.width = head[len(MAGIC)]
        at, n = struct.unpack("<QQ", foot[:16])
        self.index = np.frombuffer(self._file.read_at(n * _INDEX.itemsize, at), _INDEX)
        self._ends = np.append(self.index["offset"][1:], np.uint64(at))
        self._unzip = zstandard.ZstdDecompressor(dict_data=_as_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, i: int) -> np.ndarray:
        """Ids of the ``i``-th document of the file."""
        begin = int(self.index["offset"][i])
        frame = self._file.read_at(int(self._ends[i]) - begin, begin)
        raw = self._unzip.decompress(frame, max_output_size=int(self.index["n"][i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents of that id."""
        ids = np.where(self.index["no_id"] == 1, np.iinfo(np.int64).min, self.index["doc_id"])
        return list(range(np.searchsorted(ids, doc_id), np.searchsorted(ids, doc_id, "right")))

    def close(self) -> None:
        self._file.close()


def write(docs: DataFrame, folder: str, tokenizer: str, dictionary: bytes, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs``; returns one row per file: uri, first_id, docs, ids.

    Documents are range-partitioned by doc_id (null first), so files are in order and of
    about even size. Rows that repeat a doc_id are ordered by their text.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(tokenizer)
        zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=_as_dictionary(dictionary))
        uri = f"{folder}/{uuid.uuid4().hex}.tok"
        out, at, total, index = None, _HEAD, 0, []
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                system, path = _open(uri)
                system.create_dir(os.path.dirname(path), recursive=True)
                out = system.open_output_stream(path)
                out.write(MAGIC + bytes([e.width]) + dictionary_hash(dictionary))
            part = np.zeros(b.num_rows, _INDEX)
            part["doc_id"] = b.column(0).fill_null(0).to_numpy()
            part["no_id"] = b.column(0).is_null().to_numpy(zero_copy_only=False)
            texts = b.column(1).to_pylist()
            for cut in _groups(texts):
                raw = e.encode(texts[cut], end_id)
                frames = [zip_.compress(r) for r in raw]
                sizes = np.array([len(f) for f in frames])
                part["n"][cut] = [len(r) // e.width for r in raw]
                part["offset"][cut] = at + np.cumsum(sizes) - sizes
                out.write(b"".join(frames))
                at += int(sizes.sum())
            total += int(part["n"].sum())
            index.append(part)
        if out is not None:
            index = np.concatenate(index)
            out.write(index.tobytes())
            out.write(struct.pack("<QQ", at, len(index)) + MAGIC)
            out.close()
            first = None if index["no_id"][0] else int(index["doc_id"][0])
            columns = [
                pa.array([uri]),
                pa.array([first], pa.int64()),
                pa.array([len(index)], pa.int64()),
                pa.array([total], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["uri", "first_id", "docs", "ids"])

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    saved = ordered.mapInArrow(save, "uri string, first_id long, docs long, ids long")
    return stage(saved, "token-files")


def read_back(files: DataFrame, dictionary: bytes) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    start counts the ids of all documents before, over all files in order.
    """
    before = W.orderBy(F.asc_nulls_first("first_id"), "uri").rowsBetween(W.unboundedPreceding, -1)
    based = files.select("uri", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = TokenFile(uri, dictionary)
                counts = f.index["n"].astype(np.int64)
                starts = base + np.cumsum(counts) - counts
                for lo in range(0, len(f), 10_000):
                    hi = min(len(f), lo + 10_000)
                    crcs = [zlib.crc32(f.ids(i).astype("<u4").tobytes()) for i in range(lo, hi)]
                    cut = slice(lo, hi)
                    columns = [
                        pa.array(f.index["doc_id"][cut], mask=f.index["no_id"][cut] == 1),
                        pa.array(starts[cut]),
                        pa.array(counts[cut]),
                        pa.array(crcs, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                f.close()

    spread = based.repartition(max(1, files.count()), "uri")
    return spread.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write token files of whole texts (null: empty) to the shared folder and read them back.

    Every row gives one document, repeated rows too; documents without doc_id come first.
    Extra columns are ignored; an empty table gives no files and no rows.
    """
    dictionary = train_dictionary(docs, tokenizer)
    files = write(docs, new_path(docs.sparkSession, "tokens"), tokenizer, dictionary)
    return read_back(files, dictionary)
