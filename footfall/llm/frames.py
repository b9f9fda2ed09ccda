"""Token ids in files of independent Zstandard frames with a seek table.

A file is a run of frames, a frame with the index of documents, and the seek table of the public
Zstandard seekable format in a skippable frame: compressed size, size and checksum (low 32 bits of
XXH64) of every frame before it, then their number, a flag byte and a magic number. Any Zstandard
tool can decompress such a file; a reader that wants some documents reads the table from the end,
then the index, then only the frames that hold them.

A frame holds whole documents as little-endian unsigned 32-bit ids. The index is an Arrow stream
with doc_id, frame, and n_tokens.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import text as T
from footfall.session import scratch_path

# --- fixed values: the seekable format --------------------------------------
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
# --- end of fixed values ----------------------------------------------------
#: A frame is closed once its documents reach this size; one document is never cut.
FRAME_BYTES = 1 << 20
#: Pieces whose ids a Python worker remembers, and the longest one it remembers.
CACHE_ENTRIES = 600_000
CACHE_CHARS = 48
END_ID = 2


class WordEncoder:
    """A tokenizer that drops white space, applied to each different piece of a word once.

    Its normaliser and its split pattern never join characters across ASCII white space, nor a
    letter or digit with punctuation behind it, so the ids of a text are those of its words, less
    punctuation at their ends, and of that punctuation, in order. Capitals A to Z may be small ones.
    """

    def __init__(self, model: str) -> None:
        self.tokenizer = Tokenizer.from_str(model)
        size = self.tokenizer.get_vocab_size()
        names = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.closes = np.array([name.endswith("</w>") for name in names])
        #: ids of pieces met lately, and of pieces met before those
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins."""
        special = b"<|" in T.raw(column)[0].tobytes()
        found = pieces(T.words(column, T.WHITE, lower=not special))
        _, first, which = np.unique(found.hashes(), return_index=True, return_inverse=True)
        coded = self.lookup(found.strings(first).to_pylist())
        sizes = np.array([len(x) >> 2 for x in coded], np.int64)
        table = np.frombuffer(b"".join(coded), "<u4")
        begin = np.cumsum(sizes) - sizes
        mine = sizes[which]
        at = np.cumsum(mine) - mine
        ids = table[np.repeat(begin[which] - at, mine) + np.arange(mine.sum())]
        return ids, np.append(at, len(ids))[found.first]

    def lookup(self, texts: list[str]) -> list[bytes]:
        known, older = self.known, self.older
        out = [known.get(x) or older.get(x) for x in texts]
        plain, other = [], []
        for k, ids in enumerate(out):
            if ids is None:
                x = texts[k]
                (plain if x.isalpha() and (x.isascii() or max(x) < "\u0100") else other).append(k)
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            for k, ids in zip(part, self.letters([texts[k] for k in part]), strict=True):
                out[k] = ids
        for at in range(0, len(other), 4096):
            part = other[at : at + 4096]
            coded = self.tokenizer.encode_batch_fast(
                [texts[k] for k in part], add_special_tokens=False
            )
            for k, found in zip(part, coded, strict=True):
                out[k] = np.array(found.ids, "<u4").tobytes()
        for k in plain + other:
            if len(texts[k]) <= CACHE_CHARS:
                known[texts[k]] = out[k]
        if 2 * len(known) >= CACHE_ENTRIES:
            self.older, self.known = known, {}
        return out

    def letters(self, texts: list[str]) -> list[bytes]:
        """Ids of words of Latin letters, encoded together: each is closed by one token."""
        step = 256
        joined = [" ".join(texts[k : k + step]) for k in range(0, len(texts), step)]
        coded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, "<u4") for x in coded])
        ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
        if len(ends) != len(texts):
            raise ValueError("the tokenizer splits words of letters")
        raw, begin = ids.tobytes(), 0
        out = []
        for end in ends.tolist():
            out.append(raw[begin:end])
            begin = end
        return out


_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?")] = True
_ASCII_ALNUM = ~T.NOT_ALNUM
_ASCII_ALNUM[ord("A") : ord("Z") + 1] = True
_ASCII_ALNUM[128:] = False


def pieces(found: T.Words) -> T.Words:
    """Words cut before the punctuation at their end, where a Latin letter or a digit is before it."""
    if not len(found):
        return found
    data, last = found.data, found.ends - 1
    solid = np.where(_PUNCTUATION[data], -1, np.arange(len(data)))
    core = np.maximum.accumulate(solid)[last]  # last byte that is no punctuation
    inside = (core >= found.starts) & (core < last)
    byte, before = data[np.maximum(core, 0)], data[np.maximum(core - 1, 0)]
    letter = (before == 0xC3) & (byte >= 0x80) & (byte != 0x97) & (byte != 0xB7)
    cut = inside & (_ASCII_ALNUM[byte] | (letter & (core > found.starts)))
    many = 1 + cut
    at = np.cumsum(many) - many
    starts = np.repeat(found.starts, many)
    ends = np.repeat(found.ends, many)
    ends[at[cut]] = core[cut] + 1
    starts[at[cut] + 1] = core[cut] + 1
    return T.Words(data, found.offsets, starts, ends, np.append(at, len(starts))[found.first])


class FrameWriter:
    """Writes one file; documents come in order."""

    def __init__(self, out) -> None:
        self.out, self.table = out, bytearray()
        self.packer = zstandard.ZstdCompressor(level=3)
        self.ids, self.where, self.sizes = [], [], []
        self.held, self.frames = bytearray(), 0

    def add(self, doc_id: object, tokens: bytes) -> None:
        self.ids.append(doc_id)
        self.where.append(self.frames)
        self.sizes.append(len(tokens) // 4)
        self.held += tokens
        if len(self.held) >= FRAME_BYTES:
            self.frame(bytes(self.held))
            self.held.clear()

    def frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.table += ENTRY.pack(len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
        self.frames += 1

    def close(self, kind: pa.DataType) -> None:
        if self.held:
            self.frame(bytes(self.held))
        index = pa.table(
            {
                "doc_id": pa.array(self.ids, kind),
                "frame": pa.array(self.where, pa.int32()),
                "n_tokens": pa.array(self.sizes, pa.int64()),
            }
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        self.frame(sink.getvalue().to_pybytes())
        foot = FOOTER.pack(self.frames, CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(self.table) + len(foot)))
        self.out.write(bytes(self.table) + foot)


class FrameReader:
    """Reads chosen documents of a file."""

    def __init__(self, path: str) -> None:
        store, inner = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        n, flag, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table")
        raw = self.file.read_at(n * ENTRY.size, size - FOOTER.size - n * ENTRY.size)
        self.entries = [ENTRY.unpack_from(raw, k * ENTRY.size) for k in range(n)]
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries])])
        self.index = pa.ipc.open_stream(self.frame(n - 1)).read_all()

    def frame(self, k: int) -> bytes:
        packed, size, checksum = self.entries[k]
        data = zstandard.ZstdDecompressor().decompress(
            self.file.read_at(packed, int(self.offsets[k])), max_output_size=size
        )
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return data

    def documents(self, wanted: set | None = None) -> Iterator[tuple[int, object, bytes]]:
        """Position, doc_id and ids of all or the wanted documents, in order of the file."""
        loaded, data, at = -1, b"", 0
        columns = (self.index.column(c).to_pylist() for c in ("doc_id", "frame", "n_tokens"))
        begun = -1
        for nth, (doc, frame, n) in enumerate(zip(*columns, strict=True)):
            if frame != begun:
                begun, at = frame, 0
            if wanted is None or doc in wanted:
                if n and frame != loaded:
                    loaded, data = frame, self.frame(frame)
                yield nth, doc, data[at : at + 4 * n] if n else b""
            at += 4 * n


def write_files(
    documents: DataFrame,
    tokenizer_path: str,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
) -> list[tuple[str, int, int, int]]:
    """Encode all texts and write them in ascending doc_id order; path, documents, ids of each file,
    and ids before it.

    Documents are dealt by range of (doc_id, hash of the text) and sorted within each range, so a
    file is a range. A file is written under another name and renamed when whole; a task that runs
    again writes the same bytes. What comes back is one entry a file.

    A null text is empty and has the end id alone; null ids come first; repeated rows are all
    written. No documents: no files, or files without documents.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    last = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)
        path, draft = f"{inner}/ids-{part:06d}.zst", f"{inner}/.draft-{uuid.uuid4()}"
        mine, docs, total, kind = word_encoder(model.value), 0, 0, pa.int64()
        with store.open_output_stream(draft) as out:
            writer = FrameWriter(out)
            for batch in batches:
                kind = batch.column("doc_id").type
                for rows in T.chunks(batch, "text", 2 * T.CHUNK_BYTES):
                    ids, at = mine.encode(rows.column("text"))
                    raw, at = ids.tobytes(), (at * 4).tolist()
                    for k, doc in enumerate(rows.column("doc_id").to_pylist()):
                        writer.add(doc, raw[at[k] : at[k + 1]] + last)
                    total += len(ids) + rows.num_rows
                    docs += rows.num_rows
            writer.close(kind)
        store.move(draft, path)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([f"{folder}/ids-{part:06d}.zst"]),
                pa.array([docs], pa.int64()),
                pa.array([total], pa.int64()),
            ],
            names=["part", "path", "docs", "ids"],
        )

    chosen = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("_tie", F.xxhash64("text"))
    files = (
        chosen.repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .drop("_tie")
        .mapInArrow(work, "part INT, path STRING, docs BIGINT, ids BIGINT")
        .collect()
    )
    out, before = [], 0
    for row in sorted(files, key=lambda r: r.part):
        out.append((row.path, row.docs, row.ids, before))
        before += row.ids
    return out


_word_encoders: dict[str, WordEncoder] = {}


def word_encoder(model: str) -> WordEncoder:
    """The encoder of a tokenizer, made once in each process."""
    if model not in _word_encoders:
        _word_encoders.clear()
        _word_encoders[model] = WordEncoder(model)
    return _word_encoders[model]


def read_files(
    spark: SparkSession, files: list[tuple[str, int, int, int]], doc_id: str = "BIGINT"
) -> DataFrame:
    """doc_id, start, n_tokens and the ids (as bytes) of all documents, a task for each file."""
    sent = spark.sparkContext.broadcast([(path, before) for path, _, _, before in files])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                path, start = sent.value[k]
                reader, rows, held = FrameReader(path), [], 0
                kind = reader.index.schema.field("doc_id").type
                for _, doc, data in reader.documents():
                    n = len(data) // 4
                    rows.append((doc, start, n, data))
                    start, held = start + n, held + len(data)
                    if held >= 4 * FRAME_BYTES or len(rows) >= 10_000:
                        yield _packed(rows, kind)
                        rows, held = [], 0
                yield _packed(rows, kind)

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(
        work, f"doc_id {doc_id}, start BIGINT, n_tokens BIGINT, ids BINARY"
    )


def _packed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
        names=["doc_id", "start", "n_tokens", "ids"],
    )


def encoded_and_read(
    documents: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents to files in the shared folder and read them back."""
    spark = documents.sparkSession
    files = write_files(
        documents, tokenizer_path, scratch_path(spark, "token_ids"), doc_id, text
    )
    return read_files(spark, files, documents.schema[doc_id].dataType.simpleString())
