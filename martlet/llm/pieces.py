"""SentencePiece encoding and decoding by a table of the prefixes' last pieces.

A merge (BPE) model gives every prefix of a text exactly one last piece: the piece that ends there, after a prefix whose own last piece
stays apart from it. An automaton of all pieces names the candidates that end at each character; a candidate is taken if it and the
last piece of the prefix before it are a compatible pair, that is, merging the characters of both leaves just the two.
Ids are recovered backwards from the whole text's last piece. Work and memory are linear in the text; nothing is merged but
pairs of pieces (at most twice the longest piece), whose verdicts are kept.

No piece of the usual vocabularies goes on past a character followed by the blank mark, so such places cut a text into units with encodings of their own;
each worker keeps the encodings of recent units, a bounded number. A vocabulary with a piece across such a place is encoded as one unit. Characters
without a piece become their bytes' pieces. Normalisation (blank mark, dummy prefix) and ``decode`` are the library's.

Defined cases: a null text is empty and has only the begin and end ids; rows are encoded each for itself, in any number and order; null and repeated keys
are kept; no rows give no rows; other columns are not read, and output names give way to the key's name.
"""

from __future__ import annotations

import functools
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import free_names, slices

#: The character that stands for a blank in pieces.
BLANK = "▁"
#: Units (of each of two generations) and pair verdicts a worker keeps, and the longest unit it keeps.
KEPT_UNITS, KEPT_PAIRS, KEPT_LENGTH = 1 << 18, 1 << 20, 64
#: Characters encoded and decoded at once (up to the next cut), and bytes of ids and text sent on at once.
PART, FLUSH = 1 << 19, 1 << 22


class PrefixEncoder:
    """Encodes and decodes with one model of type BPE with byte pieces."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.library.vocab_size()
        self.pieces: dict[int, str] = {}
        self.bytes: dict[int, int] = {}
        for i in range(self.size):
            if self.library.is_byte(i):
                self.bytes[int(self.library.id_to_piece(i)[3:5], 16)] = i
            elif self.library.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not (self.library.is_control(i) or self.library.is_unknown(i)):
                self.pieces[i] = self.library.id_to_piece(i)
        if len(self.bytes) != 256:
            raise ValueError("only models with byte pieces are supported")
        self.scores = {p: self.library.get_score(i) for i, p in self.pieces.items()}
        self.automaton = ahocorasick.Automaton()
        self.verdicts: list[dict] = []
        self.n_verdicts = 0
        for i, p in self.pieces.items():
            self.verdicts.append({})
            self.automaton.add_word(p, (i, len(p), self.verdicts[-1]))
        self.automaton.make_automaton()
        across = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.pieces.values())
        self.unit = re.compile("(?s).+") if across else re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.cut = re.compile("(?s).*" if across else f"(?s).*?[^{BLANK}](?={BLANK})")
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.anchor = next(i for i, p in self.pieces.items() if BLANK not in p)
        self.first, self.last = ([i] if i >= 0 else [] for i in (self.library.bos_id(), self.library.eos_id()))

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, before: int | str, piece: int, verdicts: dict) -> bool:
        """Whether ``piece`` stays as it is after ``before``: a piece, a character without one, or the start ("")."""
        if self.n_verdicts >= KEPT_PAIRS:
            for each in self.verdicts:
                each.clear()
            self.n_verdicts = 0
        one, two = before if isinstance(before, str) else self.pieces[before], self.pieces[piece]
        found = verdicts[before] = self.merged(one + two) == ([one, two] if one else [two])
        self.n_verdicts += 1
        return found

    def last_pieces(self, unit: str) -> tuple[list[int | str], list[int]]:
        """Last piece of each prefix of ``unit``, or its last character where that has no piece, and its length; at 0 the start ("")."""
        last, length, settled = ["", *unit], [1] * (len(unit) + 1), -1
        for end, (piece, size, verdicts) in self.automaton.iter(unit):
            if end == settled:
                continue
            before = last[end + 1 - size]
            fits = verdicts.get(before)
            if self._apart(before, piece, verdicts) if fits is None else fits:
                settled = end
                last[end + 1], length[end + 1] = piece, size
        return last, length

    def unit_ids(self, unit: str) -> bytes:
        """Ids of one unit, as little-endian 32-bit integers."""
        last, length = self.last_pieces(unit)
        ids, at = [], len(unit)
        while at:
            piece = last[at]
            if isinstance(piece, str):
                ids.extend(self.bytes[b] for b in reversed(piece.encode()))
            else:
                ids.append(piece)
            at -= length[at]
        ids.reverse()
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _missed(self, unit: str) -> bytes:
        """Ids of a unit that the younger generation does not hold."""
        found = self.older.get(unit) or self.unit_ids(unit)
        if len(unit) <= KEPT_LENGTH:
            if len(self.units) >= KEPT_UNITS:
                self.older = dict(self.units)
                self.units.clear()
            self.units[unit] = found
        return found

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids of a text without begin and end, about ``PART`` characters at a time."""
        body, at, known = self.library.normalize(text), 0, self.units.get
        while at < len(body):
            border = self.cut.match(body, at + PART)
            end = border.end() if border else len(body)
            yield b"".join([known(u) or self._missed(u) for u in self.unit.findall(body, at, end)])
            at = end

    def encode(self, text: str) -> list[int]:
        """All ids, begin and end included."""
        ids = b"".join(self.parts(text))
        return [*self.first, *struct.unpack(f"<{len(ids) // 4}I", ids), *self.last]

    def decode(self, parts: list[bytes]) -> str:
        """The text of the ids; parts after the first follow an ordinary piece, so that only the text's own start counts as one."""
        out = []
        for k, part in enumerate(parts or [b""]):
            ids = list(struct.unpack(f"<{len(part) // 4}I", part))
            if k:
                out.append(self.library.decode([self.anchor, *ids])[len(self.pieces[self.anchor]):])
            else:
                out.append(self.library.decode([*self.first, *ids]))
        return "".join(out)

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """Ids with begin and end, as little-endian 32-bit integers, and the text they decode to."""
        parts = list(self.parts(text))
        ends = [struct.pack(f"<{len(e)}I", *e) for e in (self.first, self.last)]
        return b"".join([ends[0], *parts, ends[1]]), self.decode(parts)


@functools.lru_cache(maxsize=2)
def _encoder(model: bytes) -> PrefixEncoder:
    return PrefixEncoder(model)


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``ids`` (begin and end included, little-endian 32-bit integers) and ``decoded`` text."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # a vocabulary file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in slices(batches):
            at, ids, decoded, size = 0, [], [], 0
            for row, value in enumerate(batch.column(1)):
                one, two = encoder.round_trip(value.as_py() or "")
                ids.append(one)
                decoded.append(two)
                size += len(one) + len(two)
                if size >= FLUSH or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary()),
                                                      pa.array(decoded, pa.string())], names=["key", "ids", "decoded"])
                    at, ids, decoded, size = row + 1, [], [], 0

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids binary, decoded string")
    return out.toDF(key, *free_names([key], "ids", "decoded"))


def encoding_report(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 and decoded_sha256."""
    found = encode_documents(docs, model_path, key, text)
    _, ids, decoded = found.columns
    return found.select(F.col(key), (F.length(ids) / 4).cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))
