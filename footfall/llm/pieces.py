"""SentencePiece BPE encoding by backtracking, and decoding.

Merging pairs step by step gives one result for a text; a row of tokens is that result exactly if
each token gives itself when merged alone and each two adjacent ones give themselves when their
joined text is merged again (van Antwerpen and Neubeck, 2024). So the longest token at a position is
taken, checked against the token before it, and replaced by the next shorter one where the check
fails. Where no token fits, the position is marked in a bit field as failed and the token before it
is taken back. All matches at all positions come from one pass of an Aho-Corasick automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T

#: How pieces show a space. It is one symbol with the space here, as it is when encoding.
SHOWN_SPACE = "▁"
#: Parts of text whose ids a Python worker remembers, and the longest one it remembers.
CACHE_ENTRIES = 600_000
CACHE_CHARS = 48


class PieceEncoder:
    """Encoder and decoder for a BPE model with byte fallback and an identity normaliser."""

    def __init__(self, model: bytes, alone: list[bool] | None = None) -> None:
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = lib.get_piece_size()
        self.texts = [lib.id_to_piece(i).replace(SHOWN_SPACE, " ") for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        self.byte_ids = {int(self.texts[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        for probe in ("a  b ", " ﬁéé　x", "\t\n"):
            if lib.decode(lib.encode(probe)) != probe:
                raise ValueError("the model changes texts before it encodes them")
        self.rank = {
            self.texts[i]: (-lib.get_score(i), i)
            for i in range(n)
            if not (special[i] or lib.is_byte(i) or lib.is_unused(i))
        }
        self.fits: dict[tuple[int, int], bool] = {}
        #: whether a token gives itself when its text is merged; others never occur in a result
        self.alone = alone or [
            p in self.rank and self.merge(p) == [i] for i, p in enumerate(self.texts)
        ]
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(self.texts):
            if self.alone[i]:
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        # spaces begin pieces and nothing else, and no piece has a line break: merges stay between
        inner = any(re.search("[^ ] ", p) for p in self.rank)
        line = any("\n" in p for p in self.rank)
        self.parts = re.compile(
            r"(?s).+" if inner else r" *[^ ]+| +" if line else r" *[^ \n]+| +|\n"
        )
        out = [
            b""
            if special[i]
            else bytes([int(p[3:5], 16)])
            if lib.is_byte(i)
            else p.encode()
            for i, p in enumerate(self.texts)
        ]
        out[lib.unk_id()] = " ⁇ ".encode()
        ends = np.cumsum([len(x) for x in out])
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self.byte_ends = ends
        self.byte_starts = ends - np.array([len(x) for x in out])
        self.silent = np.array([lib.is_control(i) for i in range(n)])
        self.spaced = np.array([p in self.rank and p[0] == " " for p in self.texts])
        #: ids of parts met lately, and of parts met before those
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def text_of(self, token: int) -> str:
        return self.texts[token] if token >= 0 else chr(-token - 1)

    def merge(self, text: str) -> list[int]:
        """Merge the best adjacent pair, the first of equal ones, until none is left."""
        now = list(text)
        while True:
            best = min(
                (
                    (self.rank[pair][0], k)
                    for k in range(len(now) - 1)
                    if (pair := now[k] + now[k + 1]) in self.rank
                ),
                default=None,
            )
            if best is None:
                return [self.rank[p][1] if p in self.rank else -ord(p) - 1 for p in now]
            k = best[1]
            now[k : k + 2] = [now[k] + now[k + 1]]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their joined text is merged again."""
        known = self.fits.get((left, right))
        if known is None:
            known = self.merge(self.text_of(left) + self.text_of(right)) == [left, right]
            if len(self.fits) >= CACHE_ENTRIES:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def backtrack(self, text: str) -> list[int]:
        """Tokens of a part; a character without a token is -1 minus its code point."""
        whole = self.rank.get(text)
        if whole and self.alone[whole[1]]:
            return [whole[1]]
        n = len(text)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(text):
            matches[end - found[0] + 1].append(found)
        for k, mine in enumerate(matches):
            if not mine or mine[0][0] > 1:
                mine.insert(0, (1, -ord(text[k]) - 1))
        failed = bytearray(n // 8 + 1)
        tokens: list[int] = []
        taken: list[int] = []  # which match, counted from the shortest
        at, pick = 0, len(matches[0]) - 1 if n else 0
        while at < n:
            size, token = matches[at][pick]
            end = at + size
            if not failed[end >> 3] >> (end & 7) & 1 and (
                not tokens or self.adjacent(tokens[-1], token)
            ):
                tokens.append(token)
                taken.append(pick)
                at = end
                pick = len(matches[at]) - 1 if at < n else 0
                continue
            pick -= 1
            while pick < 0:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(self.text_of(tokens.pop()))
                pick = taken.pop() - 1
        return tokens

    def encode_part(self, part: str) -> bytes:
        ids: list[int] = []
        for token in self.backtrack(part):
            if token >= 0:
                ids.append(token)
            else:
                ids += [self.byte_ids[b] for b in chr(-token - 1).encode()]
        return np.array(ids, "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        out = []
        for part in self.parts.findall(" " + text.replace(SHOWN_SPACE, " ")):
            known = self.cache.get(part)
            if known is None:
                known = self.older.get(part) or self.encode_part(part)
                if len(part) <= CACHE_CHARS:
                    if 2 * len(self.cache) >= CACHE_ENTRIES:
                        self.older, self.cache = self.cache, {}
                    self.cache[part] = known
            out.append(known)
        return b"".join(out)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of rows of ids, which lie one after the other; row k is ids[offsets[k]:offsets[k+1]]."""
        pieces = self.byte_ends[ids] - self.byte_starts[ids]
        ends = np.concatenate([[0], np.cumsum(pieces)])
        source = np.repeat(self.byte_starts[ids] - ends[:-1], pieces) + np.arange(ends[-1])
        data = self.bytes[source]
        starts, stops = ends[offsets[:-1]].copy(), ends[offsets[1:]]
        # the space that encoding puts before a text
        loud = np.cumsum(np.concatenate([[0], ~self.silent[ids]]))
        filled = np.flatnonzero(loud[offsets[1:]] > loud[offsets[:-1]])
        leader = np.searchsorted(loud, loud[offsets[filled]] + 1) - 1
        starts[filled[self.spaced[ids[leader]]]] += 1
        try:
            return T.spans(data, starts, stops).cast(pa.binary()).cast(pa.utf8())
        except pa.ArrowInvalid:  # byte tokens that are no characters
            raw = data.tobytes()
            return pa.array([_lenient(raw[s:e]) for s, e in zip(starts, stops, strict=True)])


def _lenient(raw: bytes) -> str:
    """UTF-8 with a replacement character for each byte that is part of no character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1 :]
    return "".join(out)


_encoders: dict[bytes, PieceEncoder] = {}


def encoder(model: bytes, alone: list[bool] | None = None) -> PieceEncoder:
    """The encoder of a model, made once in each process."""
    if model not in _encoders:
        _encoders.clear()
        _encoders[model] = PieceEncoder(model, alone)
    return _encoders[model]


def encode_documents(
    documents: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of documents: doc_id, ids ARRAY<INT> of its whole text, decoded STRING.

    The model file is read on the driver and sent to the tasks (its size is that of a vocabulary).
    Rows map to rows: no shuffle. A null or empty text has no ids and decodes to the empty text.
    Repeated rows and null ids are kept as they are; no documents give no rows.
    """
    spark = documents.sparkSession
    with open(model_path, "rb") as file:
        model = file.read()
    sent = spark.sparkContext.broadcast((model, encoder(model).alone))
    kind = documents.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = encoder(*sent.value)
        for batch in batches:
            for rows in T.chunks(batch, "text"):
                coded = [mine.encode(x or "") for x in rows.column("text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])])
                ids = np.frombuffer(b"".join(coded), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())
                        ),
                        mine.decode(ids, offsets),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )

    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    ).mapInArrow(work, f"doc_id {kind}, ids ARRAY<INT>, decoded STRING")
