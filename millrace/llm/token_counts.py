"""Operator 10: token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string that can be a pre-token is encoded alone; those that give exactly one
token are proven whole. Counting splits a text into pre-tokens as the tokenizer does; pre-tokens that are proven whole
count one without merging, the library merges the rest, each distinct one once while it is remembered. Texts with
characters on which splitters or case rules may differ, or with something like a special string, go to the library. So do
all texts if the tokenizer's normaliser or splitter isn't the one whose rules are known here.

Defined results: a null or empty text has 0 tokens and 0 bytes; rows are never dropped; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import LONGEST, PLAIN, byte_characters, ids_apart
from .common import rows_of


#: Fixed: the normaliser and the splitters whose rules `TokenCounter` follows; the pattern is read from the tokenizer.
NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTERS = [{"type": "Split", "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


def proven_whole(spec: str) -> list[str]:
    """The pre-tokens that the tokenizer encodes as one token: a vocabulary string with the word's end, encoded alone."""
    from tokenizers import Tokenizer

    tokenizer, model = Tokenizer.from_str(spec), json.loads(spec)["model"]
    end = model.get("end_of_word_suffix") or ""
    byte = {c: i for i, c in enumerate(byte_characters())}
    words = []
    for token in model["vocab"]:
        if token.endswith(end) and all(c in byte for c in token.removesuffix(end)):
            try:
                words.append(bytes(byte[c] for c in token.removesuffix(end)).decode())
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token
    words = [w for w in words if w]
    encoded = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return [w for w, e in zip(words, encoded, strict=True) if len(e.ids) == 1]


class TokenCounter:
    """Counts tokens as the library does; the merged rest is remembered, at most `most` pre-tokens of LONGEST characters."""

    def __init__(self, spec: str, whole: list[str], most: int = 500_000):
        from tokenizers import Tokenizer

        self.library, read = Tokenizer.from_str(spec), json.loads(spec)
        steps = [dict(x) for x in (read.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        pattern = (steps[0].pop("pattern", None) or {}).get("Regex") if steps else None
        self.follows = read.get("normalizer") == NORMALISER and steps == SPLITTERS and pattern is not None
        self.pieces = regex.compile(pattern or "").findall
        self.odd = regex.compile(PLAIN).search
        self.whole, self.most = dict.fromkeys(whole, 1), most
        self.known = dict(self.whole)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.follows or "<|" in text or self.odd(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        low = (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()
        if self.odd(low):  # lower case may leave the plain range
            return len(self.library.encode(text, add_special_tokens=False).ids)
        pieces = self.pieces(low)
        try:
            return sum(map(self.known.__getitem__, pieces))
        except KeyError:
            return self._merged(pieces)

    def _merged(self, pieces: list[str]) -> int:
        """The sum over pieces of which some aren't known: these are merged, and remembered."""
        new = list({p for p in pieces if p not in self.known})
        found = dict(zip(new, map(len, ids_apart(self.library, new)), strict=True))
        n = sum(found[p] if p in found else self.known[p] for p in pieces)
        if len(self.known) + len(new) > self.most + len(self.whole):
            self.known = dict(self.whole)
        self.known |= {p: found[p] for p in new[: self.most] if len(p) <= LONGEST}
        return n


def token_counts(docs: DataFrame, spec: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, by the tokenizer whose JSON is `spec`."""
    whole = proven_whole(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(spec, whole)
        for batch in rows_of(batches):
            n = [counter.count(x) for x in batch.column(2).to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_bytes": batch.column(1),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([x > limit for x in n], pa.bool_()),
            })

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
