"""Operator 8: byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The tokenizer is built from a rank file: bytes become the printable characters of the byte table, merges follow from
the ranks. A text is split by the pattern; each piece is encoded by the library and remembered, so that a repeated
piece costs one look-up. Texts with characters outside a plain Latin range go to the library whole, with its own
splitter. Decoding looks every id up in the byte table and joins the bytes; characters that several tokens share come
together again since only the joined bytes are read as UTF-8 (`decode` replaces what is broken at a cut).

Defined results: a null or empty text has no ids, its decoded bytes are empty. Extra columns are ignored by
`encode_digests`, kept by `encode` and `decode`; rows are never dropped, repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of

#: Fixed: how the vocabulary's splitter cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on which all splitters agree; a text with any other goes to the library whole.
PLAIN = r"[^\t\n\r\x20-\x7e -ɏ]"


#: Characters of a piece that is remembered at most: longer ones hardly come again.
LONGEST = 64


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A tokenizer of the tokenizers library that merges by these ranks; special strings are ordinary text."""
    shown = byte_characters()
    show = lambda token: "".join(shown[b] for b in token)
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1:
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
                if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                    break
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            if len(parts) == 2:
                merges.append([show(parts[0]), show(parts[1])])
    model = {"type": "BPE", "vocab": {show(t): r for t, r in ranks.items()}, "merges": merges, "ignore_merges": True}
    split = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": True}
    return json.dumps({"version": "1.0", "added_tokens": [], "pre_tokenizer": split, "model": model})


def ids_apart(library, pieces: list[str]) -> list[np.ndarray]:
    """The ids of each piece, encoded alone, with one call of the library."""
    if not pieces:
        return []
    got = library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
    ends = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(1, len(pieces)))
    return np.split(np.array(got.ids, "<u4"), ends)


class ByteBpe:
    """Encodes and decodes; remembers pieces of LONGEST characters at most, and at most `most` of them."""

    def __init__(self, ranks: dict[bytes, int], spec: str | None = None, most: int = 500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec or tokenizer_json(ranks))
        self.table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.pieces = regex.compile(PATTERN).findall
        self.odd = regex.compile(PLAIN).search
        self.known: dict[str, bytes] = {}
        self.most = most

    def _learned(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of all these pieces."""
        new = list({p for p in pieces if p not in self.known})
        found = dict(zip(new, (ids.tobytes() for ids in ids_apart(self.library, new)), strict=True))
        found |= {p: self.known[p] for p in pieces if p in self.known}
        if len(self.known) + len(new) > self.most:
            self.known.clear()
        self.known |= {p: found[p] for p in new[: self.most] if len(p) <= LONGEST}
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.odd(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = self.pieces(text)
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            return b"".join(map(self._learned(pieces).__getitem__, pieces))

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, text: str, ids: bytes) -> list[tuple[int, int, int, int]]:
        """Of each token: first and end byte, and first and end character that it touches."""
        ends = np.cumsum([len(self.table[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return [(int(a), int(b), int(character[a]), int(character[b - 1]) + 1) for a, b in zip(starts, ends, strict=True)]


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", ids: str = "ids", offsets: str | None = None) -> DataFrame:
    """docs with a column of ids (array<bigint>) and, if named, one of offsets; a null text has an empty array."""
    spec = tokenizer_json(ranks)
    state: list[ByteBpe] = []

    def run(column: pa.Array) -> pa.Array:
        bpe = state[0] if state else state.append(ByteBpe(ranks, spec)) or state[0]
        return pa.array([np.frombuffer(bpe.encode(x), "<u4").astype(np.int64) for x in column.to_pylist()], pa.list_(pa.int64()))

    def places(column: pa.Array) -> pa.Array:
        bpe = state[0] if state else state.append(ByteBpe(ranks, spec)) or state[0]
        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("byte_from", "byte_to", "char_from", "char_to")]))
        found = ([dict(zip(("byte_from", "byte_to", "char_from", "char_to"), o, strict=True)) for o in bpe.offsets(x or "", bpe.encode(x))] for x in column.to_pylist())
        return pa.array(list(found), kind)

    kind = "array<struct<byte_from: bigint, byte_to: bigint, char_from: bigint, char_to: bigint>>"
    out = docs.withColumn(ids, F.arrow_udf(run, "array<bigint>")(F.col(text)))
    return out.withColumn(offsets, F.arrow_udf(places, kind)(F.col(text))) if offsets else out


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", text: str = "decoded") -> DataFrame:
    """encoded with the text of its ids; null ids give an empty text, bytes cut inside a character U+FFFD."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token

    def run(column: pa.Array) -> pa.Array:
        return pa.array([b"".join(map(table.__getitem__, x or ())).decode("utf-8", "replace") for x in column.to_pylist()], pa.string())

    return encoded.withColumn(text, F.arrow_udf(run, "string")(F.col(ids)))


def encode_digests(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: the ids' digest and that of their decoded bytes."""
    spec = tokenizer_json(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(ranks, spec)
        for batch in rows_of(batches):
            ids = [bpe.encode(x) for x in batch.column(1).to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(bpe.decode_bytes(x)).hexdigest() for x in ids], pa.string()),
            })

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
