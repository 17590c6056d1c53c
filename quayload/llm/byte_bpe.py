"""Byte-level BPE with the tokenizers library, over Arrow batches.

A text is cut by the pattern; each different piece of a batch is written in the
byte alphabet (one character per byte) and encoded once. Ids, and the offsets of
every token in characters of the text, are then put together with numpy.
Decoding goes back from token strings through the reversed byte table, so that
characters split between tokens come out whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayload.llm.common import documents, give_back_memory, in_batches, only

#: Text handled at once by a task.
BATCH_BYTES = 1 << 20
#: Pieces a worker remembers between batches, in each of two generations, and the longest of them.
MEMORY, LONGEST = 60_000, 64


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it has one, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


ALPHABET = byte_alphabet()
#: For str.translate of Latin-1 text, and the way back.
TO_ALPHABET = dict(enumerate(ALPHABET))
FROM_ALPHABET = {ord(c): b for b, c in enumerate(ALPHABET)}


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each token was merged from: what its bytes become under lower ranks."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda pair: pair[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A model of the tokenizers library with these ranks, without a pre-tokenizer: pieces come cut."""
    written = {token: token.decode("latin-1").translate(TO_ALPHABET) for token in ranks}
    model = {
        "type": "BPE",
        "vocab": {written[token]: rank for token, rank in ranks.items()},
        "merges": [[written[a], written[b]] for a, b in merges_of(ranks)],
        "ignore_merges": False,
    }
    return json.dumps({"version": "1.0", "added_tokens": [], "model": model})


class ByteBpe:
    """Encoder and decoder of a worker."""

    def __init__(self, model: str, pattern: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model)
        self.tokenize = self.model.model.tokenize
        self.find = regex.compile(pattern).findall
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(map(FROM_ALPHABET.__getitem__, map(ord, token)))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, little-endian 32-bit; different pieces are encoded once.

        A piece met again is carried into the next generation; the others are
        forgotten with their own.
        """
        memory, older = self.memory, self.older
        new = []
        for piece in set(pieces).difference(memory):
            known = older.get(piece)
            if known is None:
                new.append(piece)
            else:
                memory[piece] = known
        for piece in new:
            # the model itself: the pieces need no normalising, cutting or special tokens
            ids = [token.id for token in self.tokenize(piece.encode().decode("latin-1").translate(TO_ALPHABET))]
            memory[piece] = struct.pack(f"<{len(ids)}I", *ids)
        out = list(map(memory.__getitem__, pieces))
        if len(memory) > MEMORY:
            self.older = {piece: ids for piece, ids in memory.items() if len(piece) <= LONGEST}
            self.memory = {}
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_pieces(self.find(text))), "<u4").tolist()

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of the ids; bytes that are no whole character become the replacement character."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each token in characters of ``text``; a split character belongs to all its tokens."""
        starts, ends = self.spans(self.encode(text), text)
        return list(zip(starts.tolist(), ends.tolist(), strict=True))

    def spans(self, ids: list[int], text: str) -> tuple[np.ndarray, np.ndarray]:
        """``offsets`` of the tokens that ``text`` has been encoded to, as arrays."""
        size = np.array([len(self.bytes_of[i]) for i in ids], np.int64)
        ends = np.cumsum(size)
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return character[ends - size].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


class Model:
    """The ranks file as a model that every executor can open."""

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            self.json = tokenizer_json(read_ranks(file.read()))
        self.shared = spark.sparkContext.broadcast(self.json)
        self.pattern = pattern

    def codec(self):
        shared, pattern = self.shared, self.pattern
        held: list[ByteBpe] = []

        def get() -> ByteBpe:
            if not held:
                held.append(ByteBpe(shared.value, pattern))
            return held[0]

        get.forget = held.clear
        return get


def _with_codec(get, make):
    """``make`` over batches; the codec goes with the task that needed it."""

    def run(batches):
        yield from in_batches(make, BATCH_BYTES)(batches)
        get.forget()
        give_back_memory()

    return run


def encode_documents(docs: DataFrame, model: Model, with_ids: bool = True, with_offsets: bool = False) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_tokens, [ids,] [starts, ends,] ids_sha256, decoded_sha256.

    ``starts`` and ``ends`` are of each token, in characters of the text; a
    split character belongs to all its tokens.
    A null or empty text has no tokens. ``ids_sha256`` is of the ids as
    little-endian unsigned 32-bit integers and ``decoded_sha256`` of the bytes
    decoded from them. Texts are never cut. A null doc_id stays null, repeated
    rows are encoded each, other columns are ignored. An empty table gives an
    empty result.
    """
    get = model.codec()
    kind = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "ends")] if with_offsets else []
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def make(table: pa.Table) -> Iterator[pa.Table]:
        codec = get()
        texts = pc.fill_null(table["text"].cast(pa.large_string()), "").to_pylist()
        pieces = [codec.find(text) for text in texts]
        flat = codec.encode_pieces([piece for found in pieces for piece in found])
        counts, hashes, decoded, all_ids, at = [], [], [], [], 0
        all_starts, all_ends = [], []
        for text, found in zip(texts, pieces, strict=True):
            packed = b"".join(flat[at : at + len(found)])
            ids = np.frombuffer(packed, "<u4")
            at += len(found)
            counts.append(len(ids))
            hashes.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(codec.decode_bytes(ids.tolist())).hexdigest())
            if with_ids:
                all_ids.append(ids.astype(np.int32))
            if with_offsets:
                starts, ends = codec.spans(ids.tolist(), text)
                all_starts.append(starts)
                all_ends.append(ends)
        out = {"doc_id": table["doc_id"], "n_tokens": pa.array(counts, pa.int64())}
        lists = ({"ids": all_ids} if with_ids else {}) | ({"starts": all_starts, "ends": all_ends} if with_offsets else {})
        for name, parts in lists.items():
            bounds = np.cumsum([0, *counts]).astype(np.int32)
            out[name] = pa.ListArray.from_arrays(bounds, np.concatenate(parts) if parts else np.array([], np.int32))
        out["ids_sha256"] = pa.array(hashes, pa.string())
        out["decoded_sha256"] = pa.array(decoded, pa.string())
        yield pa.table(out)

    return only(docs, "doc_id", "text").mapInArrow(_with_codec(get, make), T.StructType(fields))


def decode_documents(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``text`` of rows with ``ids``; null ids give an empty text."""
    get = model.codec()
    schema = T.StructType([T.StructField("doc_id", encoded.schema["doc_id"].dataType), T.StructField("text", T.StringType())])

    def make(table: pa.Table) -> Iterator[pa.Table]:
        codec = get()
        texts = [codec.decode(ids or ()) for ids in table["ids"].to_pylist()]
        yield pa.table({"doc_id": table["doc_id"], "text": pa.array(texts, pa.string())})

    return only(encoded, "doc_id", "ids").mapInArrow(_with_codec(get, make), schema)


def production_model(spark: SparkSession) -> Model:
    import public_tokenizers

    return Model(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), production_model(spark), with_ids=False)
