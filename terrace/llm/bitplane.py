"""Token ids in a bit-plane shuffled binary format (operator 10).

Texts are range-partitioned and sorted by key, then encoded, and each
partition streams into one file:

    magic, then blocks of BLOCK ids: the block is transposed into 8 * width
    bit planes or ``width`` byte planes and each plane is compressed with
    zstandard; then the index (zstandard): per block its offset and plane
    lengths, per document its key and id count; then the index's place.

A file is written under a name of its own attempt and moved into place, so
a task that runs again after a lost executor replaces equal bytes.  The
manifest (a row per file: order, id count) gives global starts; its window
has a row per file.  Reading decodes a file block by block.

Encoding goes by words: the tokenizer never joins across ASCII white space
and never joins a letter with a following full stop or comma, so each
distinct word of a batch is looked up in a bounded cache and only missing
words are encoded: plain Latin words by the vocabulary's merges alone, others
many to a call, set apart by a special token.

Defined cases: null text is empty and gets the end id alone; a null key
comes first; rows with equal keys are ordered by a hash of their text, then
the text; a repeated row is written again; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import prepare, stored, table
from terrace.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1 << 16
MAGIC = b"TRBPLN01"
LEVEL = 3
CACHE_WORDS = 500_000
SEPARATOR = "<|startoftext|>"

# Lower-case Latin letters without combining marks.
SIMPLE = re.compile("[a-zß-öø-ÿ]+")


def _byte_chars() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if
    printable, else the next of the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(other)}


BYTE_CHARS = _byte_chars()


# ------------------------------------------------------------------ planes
def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first; ``kind`` is ``bit`` or ``byte``."""
    width = ids.dtype.itemsize
    by = ids.astype(ids.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width)
    if kind == "byte":
        return [by[:, i].tobytes() for i in range(width)]
    bits = np.unpackbits(by, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(8 * width)]


def from_planes(planes: list[bytes], n: int, width: int, kind: str) -> np.ndarray:
    dtype = np.dtype(f"<u{width}")
    if kind == "byte":
        by = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in planes], axis=1)
        by = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(by).view(dtype).reshape(-1)


# -------------------------------------------------------------------- file
class PlaneWriter:
    """Streams documents' ids into one file; holds one block and the index."""

    def __init__(self, sink, width: int, kind: str = "byte", block: int = BLOCK):
        import zstandard
        self.sink, self.width, self.kind, self.block = sink, width, kind, block
        self.zip = zstandard.ZstdCompressor(level=LEVEL).compress
        self.sink.write(MAGIC)
        self.at, self.pending, self.held = len(MAGIC), [], 0
        self.blocks: list[tuple[int, int, list[int]]] = []
        self.keys: list[int | None] = []
        self.counts: list[int] = []

    def add(self, key, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            whole = np.concatenate(self.pending)
            cut = len(whole) // self.block * self.block
            for i in range(0, cut, self.block):
                self._flush(whole[i:i + self.block])
            self.pending, self.held = [whole[cut:]], len(whole) - cut

    def _flush(self, ids: np.ndarray) -> None:
        packed = [self.zip(p) for p in to_planes(ids, self.kind)]
        self.blocks.append((self.at, len(ids), [len(p) for p in packed]))
        for p in packed:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> int:
        if self.held:
            self._flush(np.concatenate(self.pending))
        index = self.zip(json.dumps({"width": self.width, "kind": self.kind, "blocks": self.blocks,
                                     "keys": self.keys, "counts": self.counts}).encode())
        self.sink.write(index)
        self.sink.write(struct.pack("<QQ", self.at, len(index)) + MAGIC)
        return sum(self.counts)


class PlaneReader:
    """Reads a file's documents in order, or one block by its index entry."""

    def __init__(self, source):
        import zstandard
        self.source = source
        self.unzip = zstandard.ZstdDecompressor().decompress
        size = source.size()
        at, n, magic = struct.unpack("<QQ8s", source.read_at(24, size - 24))
        if magic != MAGIC:
            raise ValueError("not a bit-plane file")
        self.index = json.loads(self.unzip(source.read_at(n, at)))

    def block(self, i: int) -> np.ndarray:
        at, n, lengths = self.index["blocks"][i]
        data, planes = self.source.read_at(sum(lengths), at), []
        for length in lengths:
            planes.append(self.unzip(data[:length]))
            data = data[length:]
        return from_planes(planes, n, self.index["width"], self.index["kind"])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        held, i = np.empty(0, np.dtype(f"<u{self.index['width']}")), 0
        for key, n in zip(self.index["keys"], self.index["counts"]):
            if len(held) < n:
                parts, have = [held], len(held)
                while have < n:
                    parts.append(self.block(i))
                    have, i = have + len(parts[-1]), i + 1
                held = np.concatenate(parts)
            yield key, held[:n]
            held = held[n:]


# ---------------------------------------------------------------- encoding
class WordEncoder:
    """Whole texts to little-endian id bytes through a bounded cache of words."""

    def __init__(self, path: str, width: int, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(f"<u{width}")
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _learn(self, words: list[str], into: dict[str, bytes], chunk: int = 200) -> None:
        plain, merge = [], self.tokenizer.model.tokenize
        for w in words:
            if SIMPLE.fullmatch(w):                       # one pre-token, which no normalisation changes
                ids = [t.id for t in merge(w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_CHARS))]
                into[w] = np.array(ids, self.dtype).tobytes()
            elif "<|" in w:
                into[w] = self._ids(w).tobytes()
            else:
                plain.append(w)
        for i in range(0, len(plain), chunk):
            some = plain[i:i + chunk]
            ids = self._ids(f" {SEPARATOR} ".join(some))
            cuts = np.flatnonzero(ids == self.separator)
            if len(cuts) != len(some) - 1:
                raise AssertionError("a word holds the separator")
            for w, part in zip(some, np.split(ids, cuts)):
                into[w] = (part[1:] if len(part) and part[0] == self.separator else part).tobytes()

    def encode(self, texts: pa.Array) -> pa.Array:
        """Id bytes of every text (nulls are empty), without an end id."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")
        texts = pc.if_else(special, texts, pc.ascii_lower(texts))
        texts = pc.replace_substring_regex(texts, r"([A-Za-z])([.,])", r"\1 \2")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        missing = [w for w in words if w not in self.cache]
        if len(self.cache) + len(missing) > self.cache_words:
            self.cache = {}
            missing = words
        self._learn(missing, self.cache)
        pieces = pa.array([self.cache[w] for w in words], pa.binary())
        per_doc = pa.ListArray.from_arrays(lists.offsets, pieces.take(coded.indices))
        return pc.binary_join(per_doc, pa.scalar(b"", pa.binary()))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text, range-partitioned and sorted by key; equal keys by a hash of their text.

    Texts move, not ids: finding the ranges reads the input again, and
    encoding is the dearer of the two.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    return (keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
            .select("doc_id", "text"))


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """doc_id, ids (little-endian bytes, the end id last) of every row, where it lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(path, width), pa.scalar(end_id.to_bytes(width, "little"), pa.binary())
        for b in batches:
            if b.num_rows:
                ids = pc.binary_join_element_wise(encoder.encode(b.column(1)), end, pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return src.mapInArrow(run, "doc_id bigint, ids binary")


# ----------------------------------------------------------- write and read
def write_files(ids: DataFrame, folder: str, width: int = 2, kind: str = "byte",
                block: int = BLOCK) -> DataFrame:
    """Write ``ids``, a file per partition in its order; returns the stored manifest (part, path, n_ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        part = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        name = f"{base}/part-{part:06d}.bpl"
        temp = f"{name}.{TaskContext.get().taskAttemptId()}"
        writer = sink = None
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1)):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(temp, compression=None)
                    writer = PlaneWriter(sink, width, kind, block)
                writer.add(key, np.frombuffer(raw.as_buffer(), np.dtype(f"<u{width}")))
        if writer is not None:
            n = writer.close()
            sink.close()
            if store.get_file_info(name).type != fs.FileType.NotFound:      # an attempt that died after its move
                store.delete_file(name)
            store.move(temp, name)
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "n_ids": [n]},
                                             pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64())]))

    return stored(ids.mapInArrow(run, "part int, path string, n_ids bigint"), "manifest")


def read_files(manifest: DataFrame, folder: str, rows: int = 2000) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, decoded from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    out: list[tuple] = []
                    for key, ids in PlaneReader(source).documents():
                        out.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(out) >= rows:
                            yield _rows(out)
                            out = []
                    if out:
                        yield _rows(out)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row per file
    starts = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    # a task per file: by its number, in as many ranges as there are files (hashes would collide, and a
    # count left to the planner is coalesced to one task)
    files = starts.select("part", "path", "start").repartitionByRange(max(1, manifest.count()), "part").select(
        "path", "start")
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = [pa.array(c, pa.int64()) for c in zip(*out)]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])


def op10_bitplanes(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    docs = table(prepare(spark), sf_dir, "documents")
    folder = scratch_path(spark, "token_planes")
    manifest = write_files(encoded(in_order(docs), str(tokenizer)), folder)
    return read_files(manifest, folder)
