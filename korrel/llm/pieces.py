"""SentencePiece encoding and decoding of merge-type (BPE) models, exactly, by backtracking.

The library's merge loop is not run on texts. An Aho-Corasick automaton over the vocabulary lists, for each start, the
pieces that match there, longest first. The encoder takes the longest one that is compatible with the piece before it and
goes on; where none is, it marks the position as failed in a bit field, takes the piece before it back and tries that
piece's next shorter match. Two adjacent pieces are compatible if merging their joined text anew gives the same two pieces.
A sequence whose neighbours are all compatible is the one that the merge loop makes: merges are picked by (score, then
leftmost), so on the text of two neighbours they run in the same order alone as inside the whole, and the first merge
across a boundary would be a merge across it in the pair too.

Cases: a null text encodes as the empty text, which has no ids and decodes to the empty text. Characters that the vocabulary
lacks become byte pieces. Texts have no length limit; identical rows get identical results; an empty table gives an empty one.
Other columns stay as they are, but those named like a result, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, small_batches

SPACE = "▁"
#: Units (a run of spaces and the word after it) of one generation that a worker remembers, and the longest one that it does.
CACHE_UNITS, CACHE_CHARS = 300_000, 48


class PieceCodec:
    """Encoder and decoder of one merge-type model."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.ids = {names[i]: i for i in range(n) if not special[i] and not sp.is_byte(i)}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(names[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.surface = [
            b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(names[i][3:-1], 16)]) if sp.is_byte(i) else names[i].replace(SPACE, " ").encode()
            for i in range(n)
        ]
        self.known = set("".join(self.ids))
        # Two characters that are neighbours in no piece are never merged: what lies on both sides is encoded by itself.
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.words = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) == 1 or self.merge(piece) == [piece]:
                self.words.add_word(piece, piece)
        self.words.make_automaton()
        # No piece holds a space after another character, nor a character that the vocabulary lacks: no merge crosses either.
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            self.unit = re.compile(r"(?s).+")
        else:
            alone = "".join(c for c in "\n\t" if c not in self.known)
            self.unit = re.compile(rf"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (rf"|[{alone}]" if alone else ""))
        self._pairs: dict[tuple[str, str], bool] = {}
        self._units: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}  # the generation before: what is asked for again moves on

    def merge(self, text: str) -> list[str]:
        """The library's merge loop on a short text: the best-scored pair first, of equals the leftmost."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            known = self._pairs[key] = self.merge(left + right) == [left, right]
        return known

    def _known_run(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all in the vocabulary."""
        size = len(text)
        at: list[list[str]] = [[] for _ in range(size)]
        for end, piece in self.words.iter(text):
            at[end - len(piece) + 1].append(piece)  # ends ascend, so each list goes from short to long
        open_ = bytearray(b"\x01") * (size + 1)
        out: list[str] = []
        tried: list[int] = []
        pos, k = 0, len(at[0]) - 1
        while pos < size:
            here, found = at[pos], False
            while k >= 0:
                piece = here[k]
                if open_[pos + len(piece)] and (not out or self.compatible(out[-1], piece)):
                    found = True
                    break
                k -= 1
            if found:
                out.append(piece)
                tried.append(k)
                pos += len(piece)
                k = len(at[pos]) - 1 if pos < size else -1
            else:
                open_[pos] = 0
                if not out:
                    raise ValueError(f"no valid encoding of {text[:60]!r}")
                pos -= len(out.pop())
                k = tried.pop() - 1
        return out

    def _part(self, text: str) -> bytes:
        """int32 ids of a text without a border that no merge crosses."""
        if len(text) == 1 and text not in self.known:
            ids = [self.bytes[b] for b in text.encode()] if self.bytes else [self.unknown]
        else:
            ids = [self.ids[p] for p in self._known_run(text)]
        return np.array(ids, "<i4").tobytes()

    def encode_unit(self, text: str) -> bytes:
        """int32 ids of a text in which spaces are already U+2581."""
        joined = self.joined
        cuts = [i for i in range(1, len(text)) if text[i - 1 : i + 1] not in joined]
        if not cuts:
            return self._part(text)
        return b"".join(self._remembered(text[i:j], self._part) for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True))

    def _remembered(self, text: str, encode: Callable[[str], bytes]) -> bytes:
        ids = self._units.get(text)
        if ids is None:
            ids = self._older.get(text)
            if ids is None:
                ids = encode(text)
            if len(text) <= CACHE_CHARS:
                if len(self._units) >= CACHE_UNITS:
                    self._older, self._units = self._units, {}
                self._units[text] = ids
        return ids

    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        out = []
        for unit in self.unit.findall(SPACE + text.replace(" ", SPACE)):
            ids = self._units.get(unit)
            out.append(self._remembered(unit, self.encode_unit) if ids is None else ids)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text or ""), "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_CODECS: dict[int, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    """One codec for a worker's life."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceCodec(model)
    return _CODECS[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the ids of each whole text and the text that those ids decode to; columns of these names are replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # the model file: its size does not depend on the data
    schema = T.StructType([f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False), T.StructField(decoded_col, T.StringType(), False)])
    at = docs.columns.index(text_col)
    stay = [i for i, f in enumerate(docs.columns) if f not in (ids_col, decoded_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for big in batches:
            for k in range(0, big.num_rows, 256):
                batch = big.slice(k, 256)
                coded = [codec.encode_bytes(t or "") for t in batch.column(at).to_pylist()]
                decoded = [codec.decode(np.frombuffer(c, "<i4").tolist()) for c in coded]
                offsets = np.zeros(len(coded) + 1, np.int32)
                np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in stay] + [ids, pa.array(decoded, pa.string())], names=[f.name for f in schema.fields])

    return docs.mapInArrow(released(run), schema)


def digests(coded: DataFrame, *also: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """doc_id, the columns ``also``, n_tokens, ids_sha256 and decoded_sha256 of coded documents."""
    return coded.select(
        "doc_id",
        *also,
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col), 256).alias("decoded_sha256"),
    )
