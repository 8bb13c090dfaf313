"""Byte-level BPE encoding and decoding with a given vocabulary.

Every piece of text is a doubly linked list of symbols. A heap holds the possible merges by rank and
then position; an entry whose pair has changed since it was pushed is skipped. Decoding concatenates
the bytes of the vocabulary strings.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces whose ids are remembered, per Python worker and generation; there are two generations.
REMEMBERED = 150_000
REMEMBERED_CHARS = 64

# How byte-level vocabularies cut text into pieces. \s is spelled out, since libraries disagree on it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{LN}]+|[{S}]+(?![^{S}])|[{S}]+"
# The same for texts of ASCII and the letters of Latin-1 and Latin Extended, where plain sets do.
LATIN = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_ANY_PIECE = regex.compile(PIECES.replace("{LN}", r"\p{L}\p{N}").replace("{L}", r"\p{L}").replace("{N}", r"\p{N}").replace("{S}", SPACE))
_LATIN_PIECE = re.compile(PIECES.replace("{LN}", LATIN + "0-9").replace("{L}", f"[{LATIN}]").replace("{N}", "[0-9]").replace("{S}", SPACE))
_LATIN_TEXT = re.compile(rf"[\x00-\x7f\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]*")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Merges, ids and added tokens of a tokenizer file."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        ids = spec["model"]["vocab"]
        characters = byte_characters()
        to_byte = {c: b for b, c in enumerate(characters)}
        self.first = [ids[c] for c in characters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {**ids, **self.added}
        self.bytes = [b""] * (max(strings.values()) + 1)
        for string, number in strings.items():
            known = all(c in to_byte for c in string)
            self.bytes[number] = bytes(to_byte[c] for c in string) if known else string.encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Symbols of one piece after all merges."""
        symbols = [self.first[b] for b in piece]
        n, merges = len(symbols), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for at in range(n - 1):
            found = merges.get((symbols[at], symbols[at + 1]))
            if found:
                heap.append((found[0], at))
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            found = merges.get((symbols[at], symbols[right])) if right >= 0 and symbols[at] >= 0 else None
            if not found or found[0] != rank:
                continue  # stale
            symbols[at], symbols[right] = found[1], -1
            nxt = after[at] = after[right]
            if nxt >= 0:
                before[nxt] = at
                found = merges.get((symbols[at], symbols[nxt]))
                if found:
                    heapq.heappush(heap, (found[0], at))
            prev = before[at]
            if prev >= 0:
                found = merges.get((symbols[prev], symbols[at]))
                if found:
                    heapq.heappush(heap, (found[0], prev))
        return [s for s in symbols if s >= 0]

    def piece(self, text: str) -> bytes:
        """Packed ids of a piece, remembered unless it is long."""
        packed = self.old.get(text)
        if packed is None:
            packed = np.array(self.merge(text.encode()), dtype="<u4").tobytes()
            if len(text) > REMEMBERED_CHARS:
                return packed
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[text] = packed
        return packed

    def plain(self, text: str) -> list[bytes]:
        """Packed ids of the pieces of text without added tokens."""
        pattern = _LATIN_PIECE if _LATIN_TEXT.fullmatch(text) else _ANY_PIECE
        get, make = self.young.get, self.piece
        out = []
        for piece in pattern.findall(text):
            packed = get(piece)
            if packed is None:
                packed = make(piece)
                get = self.young.get
            out.append(packed)
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; added tokens in a text get their own id."""
        out, start = [], 0
        if self.cut is not None:
            for found in self.cut.finditer(text):
                out += self.plain(text[start : found.start()])
                out.append(self.added[found[0]].to_bytes(4, "little"))
                start = found.end()
        return b"".join(out + self.plain(text[start:] if start else text))

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(content: str) -> Vocabulary:
    return Vocabulary(content)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """``(id, ids)`` or ``(id, ids, decoded)``, a row per row of ``docs``: packed ids and the text decoded from them.

    ``vocabulary`` is a tokenizer file in JSON, read by the driver; tasks get it by broadcast (it is a
    vocabulary, of a few MB whatever the corpus). ``ids`` is BINARY, four little-endian bytes per id.
    A NULL text counts as empty: no ids, empty decoded text. Rows with a NULL or repeated id are kept, and
    other columns ignored. An empty table gives no rows.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [id_col, "ids", *(["decoded"] if decode else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(shared.value)
        for batch in batches:
            packed = [own.encode(t.as_py() or "") for t in batch.column(1)]
            columns = [batch.column(0), pa.array(packed, pa.binary())]
            if decode:
                columns.append(pa.array([own.decode(p) for p in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, ids binary" + (", decoded string" if decode else ""))


def token_count(ids: str = "ids"):
    """Number of packed ids."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
