"""Token-ID files of independent zstandard frames with a seek table.

A shard holds documents in ascending order.  Each document is one zstandard frame of
little-endian unsigned 32-bit ids (with zstandard's own content checksum).  After the
frames comes the seek table, one entry per document, and a fixed-size end:

    frames | entries: doc_id i64 (null: the least), offset u64, n_bytes u64, n_ids u64, crc32 of the frame u32
           | table crc32 u32, n_entries u64, magic "VLTOKSK1"

Reading a document takes the end, the table and one frame.  Spark deals the documents
out by range of doc_id, so shards are in order and of even size; a task streams its
documents into one file under a name of its own attempt and renames it when done, and
the manifest only lists what successful attempts report, so a lost executor or a
second attempt leaves at most a file that nobody names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltloom.core.scratch import materialise, shared_dir
from voltloom.llm.base import query, table

MAGIC = b"VLTOKSK1"
ENTRY = struct.Struct("<qQQQI")
END = struct.Struct("<IQ8s")
NULL_ID = -(2**63)
END_ID = 1
END_BYTES = struct.pack("<I", END_ID)
CACHE_CHUNKS = 800_000
CACHE_PARTS = 1_200_000
TOKENIZER = "word_bpe_49k.json"
# Fixed value: the split of the tokenizers that chunk by chunk encoding holds for.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:#$%&*]*)")


def filesystem(uri: str):
    """(file system, path) for a folder all executors share; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if re.match(r"[A-Za-z][A-Za-z0-9+.\-]*:", uri) else (fs.LocalFileSystem(), uri)


class ChunkEncoder:
    """Ids of a text, chunk by chunk between white space.

    A tokenizer that splits at white space, drops it, ignores case and never joins
    letters with other signs gives a text the ids of its chunks, and a chunk of Latin
    letters with closing signs the ids of both parts.  The tokenizer file is asked
    whether it is of that kind; for any other, whole texts are encoded.  Ids of chunks
    and parts are remembered up to a bound and forgotten all at once.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        spec = json.loads(self.tokenizer.to_str())
        steps = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, *after = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_chunk = (steps == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed"
                         and split.get("pattern", {}).get("Regex") == WORD_SPLIT and [a.get("type") for a in after] == ["ByteLevel"]
                         and not after[0].get("add_prefix_space") and not spec["post_processor"])
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _coded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        cut = [(m[1].lower(), m[2]) if (m := _PLAIN.fullmatch(c)) else (c,) for c in new]
        missing = {p for parts in cut for p in parts if p not in self.parts}
        plain = [p for p in missing if p.isascii() and p.islower() and p.isalpha()]  # one piece as it stands: straight to the model
        self.parts.update((p, np.array([t.id for t in self.tokenizer.model.tokenize(p)], "<u4").tobytes()) for p in plain)
        rest = list(missing.difference(plain))
        self.parts.update(zip(rest, self._coded(rest), strict=True))
        self.chunks.update((c, b"".join(map(self.parts.__getitem__, parts))) for c, parts in zip(new, cut, strict=True))

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of the text and the end id."""
        if not self.by_chunk:
            return self._coded([text])[0] + END_BYTES
        chunks = _CHUNK.findall(text)
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        if new := list(set(chunks).difference(self.chunks)):
            self._learn(new)
        return b"".join(map(self.chunks.__getitem__, chunks)) + END_BYTES


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(tokenizer_path: str) -> ChunkEncoder:
    """The worker process's encoder, so that later tasks find its memory filled."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = ChunkEncoder(tokenizer_path)
    return _ENCODERS[tokenizer_path]


class ShardWriter:
    def __init__(self, sink):
        self.sink, self.at, self.table, self.n_ids = sink, 0, [], 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.sink.write(frame)
        self.table.append(ENTRY.pack(NULL_ID if doc_id is None else doc_id, self.at, len(frame), len(ids) // 4, zlib.crc32(frame)))
        self.at += len(frame)
        self.n_ids += len(ids) // 4

    def finish(self) -> None:
        entries = b"".join(self.table)
        self.sink.write(entries)
        self.sink.write(END.pack(zlib.crc32(entries), len(self.table), MAGIC))


class ShardReader:
    """Random access to one shard, a seekable binary file."""

    def __init__(self, source, size: int):
        source.seek(size - END.size)
        crc, n, magic = END.unpack(source.read(END.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        source.seek(size - END.size - n * ENTRY.size)
        entries = source.read(n * ENTRY.size)
        if zlib.crc32(entries) != crc:
            raise ValueError("seek table is damaged")
        self.source, self.entries = source, list(ENTRY.iter_unpack(entries))

    def ids(self, k: int) -> np.ndarray:
        _, offset, size, n, crc = self.entries[k]
        self.source.seek(offset)
        frame = self.source.read(size)
        if zlib.crc32(frame) != crc:
            raise ValueError(f"frame {k} is damaged")
        out = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "<u4")
        if len(out) != n:
            raise ValueError(f"frame {k} has another length")
        return out

    def find(self, doc_id: int | None) -> Iterator[np.ndarray]:
        want = NULL_ID if doc_id is None else doc_id
        yield from (self.ids(k) for k, e in enumerate(self.entries) if e[0] == want)


def _writer(folder: str, tokenizer_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        coder, name, out, sink, first, last = encoder(tokenizer_path), uuid.uuid4().hex, None, None, None, None
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, b.column("text"), strict=True):
                if out is None:
                    sink = store.open_output_stream(f"{base}/.{name}")
                    out, first = ShardWriter(sink), doc_id
                out.add(doc_id, coder.encode(text.as_py() or ""))
            last = ids[-1] if ids else last
        if out is not None:
            out.finish()
            sink.close()
            store.move(f"{base}/.{name}", f"{base}/{name}.tok")
            yield pa.record_batch({"file": pa.array([f"{name}.tok"]), "first_id": pa.array([first], pa.int64()), "last_id": pa.array([last], pa.int64()),
                                   "n_docs": pa.array([len(out.table)], pa.int64()), "n_ids": pa.array([out.n_ids], pa.int64())})

    return write


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards; the manifest ``file, shard, first_id, last_id, n_docs, n_ids, start``.

    Documents are in ascending doc_id order, null first, rows of one doc_id by a hash
    of the text.  Null texts are empty: they hold the end id only.  ``start`` counts the
    ids of all shards before.  The manifest has one row per shard.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    parts = keyed.repartitionByRange(F.asc_nulls_first("doc_id"), "_h").sortWithinPartitions(F.asc_nulls_first("doc_id"), "_h")
    files = materialise(parts.select("doc_id", "text").mapInArrow(_writer(folder, tokenizer_path), "file string, first_id bigint, last_id bigint, n_docs bigint, n_ids bigint"))
    order = Window.orderBy(F.asc_nulls_first("first_id"), F.asc_nulls_first("last_id"), "file")
    return files.select("*", (F.row_number().over(order) - 1).alias("shard"),
                        (F.coalesce(F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("start"))


def _digester(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for b in batches:
            for file, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{file}") as source:
                    shard, rows = ShardReader(source, source.size()), []
                    for k, (doc_id, _, _, n, _) in enumerate(shard.entries):
                        rows.append((None if doc_id == NULL_ID else doc_id, start, n, zlib.crc32(shard.ids(k).tobytes())))
                        start += n
                cols = list(zip(*rows, strict=True))
                yield pa.record_batch({k: pa.array(c, pa.int64()) for k, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), cols, strict=True)})

    return digest


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files, a task per few shards."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given as a number, else so small a table becomes one task
    spread = manifest.select("file", "start").repartition(tasks, "file")
    return spread.mapInArrow(_digester(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(manifest: DataFrame, folder: str, doc_ids: list[int]) -> dict[int, list[np.ndarray]]:
    """The ids of a few documents: only shards whose range covers them are opened, only their frames unpacked."""
    want = F.array(*[F.lit(int(i)).cast("long") for i in doc_ids])
    near = manifest.where(F.exists(want, lambda i: (i >= F.coalesce("first_id", F.lit(NULL_ID))) & (i <= F.coalesce("last_id", F.lit(NULL_ID))))).select("file").collect()
    store, base = filesystem(folder)
    out: dict[int, list[np.ndarray]] = {i: [] for i in doc_ids}
    for (file,) in near:
        with store.open_input_file(f"{base}/{file}") as source:
            shard = ShardReader(source, source.size())
            for i in doc_ids:
                out[i] += shard.find(i)
    return out


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def encode_and_read(docs: DataFrame, spark: SparkSession) -> DataFrame:
    folder = shared_dir(spark)
    manifest = materialise(write_shards(docs, folder, tokenizer_file()), spark)
    return read_digests(manifest, folder)


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    return encode_and_read(table(spark, sf_dir, "documents").select("doc_id", "text"), spark)
