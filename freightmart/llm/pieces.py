"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is read here and rebuilt as a tokenizer: its normaliser, the metaspace marker, unigram scores or
BPE merges in the order of the scores, and byte fallback. Parity with the sentencepiece library is checked row by row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import pick, steps
from .parts import ENCODE_BYTES, PartEncoder

#: The marker that stands for a space, and the fixed numbers of the model format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields: whole numbers, or the bytes of anything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, raw[at:at + size]
        at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True

    @staticmethod
    def parse(raw: bytes) -> PieceModel:
        model = PieceModel()
        for number, value in fields(raw):
            if number == 1:
                own = dict(fields(value))
                model.pieces.append(own[1].decode("utf-8"))
                model.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                model.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(fields(value))
                model.algorithm, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif number == 3:
                own = dict(fields(value))
                model.charsmap, model.dummy_prefix, model.squeeze = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1))
        return model

    def tokenizer(self):
        """The model as a tokenizer, without the dummy prefix: callers put the space in front themselves."""
        from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers

        unknown = self.kinds.index(UNKNOWN)
        if self.algorithm == UNIGRAM:
            # control and byte pieces never match text: their entries get names that no text has
            names = [p if kind in (NORMAL, USER_DEFINED) else f"\uffff{p}" for p, kind in zip(self.pieces, self.kinds, strict=True)]
            model = models.Unigram(list(zip(names, self.scores, strict=True)), unknown, False)
        elif self.algorithm == BPE:
            ids = {p: i for i, p in enumerate(self.pieces)}
            merging = {p: i for p, i in ids.items() if self.kinds[i] in (NORMAL, USER_DEFINED)}
            merges = [(-self.scores[i], ids[p[:cut]], ids[p[cut:]], p[:cut], p[cut:]) for p, i in merging.items()
                      for cut in range(1, len(p)) if p[:cut] in merging and p[cut:] in merging]
            model = models.BPE(ids, [m[3:] for m in sorted(merges)], unk_token=self.pieces[unknown], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"neither a unigram nor a BPE model: type {self.algorithm}")
        out = Tokenizer(model)
        before = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            before += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex(" $"), "")]
        out.normalizer = normalizers.Sequence([*before, normalizers.Replace(" ", MARK)])
        users = [AddedToken(p, normalized=True) for p, kind in zip(self.pieces, self.kinds, strict=True) if kind == USER_DEFINED]
        if users:
            out.add_tokens(users)
        return out

    def surfaces(self) -> list[bytes]:
        """What each id stands for: marks are spaces, byte pieces their byte, control pieces nothing."""
        out = []
        for piece, kind in zip(self.pieces, self.kinds, strict=True):
            out.append(b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else
                       bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode("utf-8"))
        return out


class PieceCodec:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = PieceModel.parse(file.read())
        crossing = any(MARK in piece.lstrip(MARK) for piece in self.model.pieces)
        plain = not crossing and not self.model.charsmap and not self.model.squeeze
        users = [p.replace(MARK, " ") for p, k in zip(self.model.pieces, self.model.kinds, strict=True) if k == USER_DEFINED]
        # texts can be cut before single spaces if no piece reaches over one and normalising is only marking
        in_bytes = None
        if self.model.algorithm == UNIGRAM and self.model.byte_fallback:
            in_bytes = [self.model.pieces.index(f"<0x{b:02X}>") for b in range(256)]
        surfaces = self.model.surfaces()
        self.size = np.array([len(s) for s in surfaces], np.int64)
        # merges that stay within parts are those of the parts alone; unknown pieces stand for any text: none counts as long as it
        sizes = np.where(np.array(self.model.kinds) == UNKNOWN, 0, self.size) if plain and self.model.algorithm == BPE else None
        self.parts = PartEncoder(self.model.tokenizer(), "  " if plain else "(?s).", users, self.model.kinds.index(UNKNOWN), in_bytes, sizes)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(surfaces), np.uint8)

    def encode(self, texts: pa.Array) -> list[bytes]:
        if self.model.squeeze:
            texts = pc.utf8_trim(texts, " ")
        if self.model.dummy_prefix:
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" "), texts, ""))
        return self.parts.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, the dummy prefix goes."""
        size = self.size[ids]
        begins = np.cumsum(size) - size
        raw = self.bytes[np.arange(size.sum()) + np.repeat(self.first[ids] - begins, size)].tobytes()
        if self.model.dummy_prefix and raw[:1] == b" " and len(ids):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def model_file() -> str:
    """Where the executors' own installation has the model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_encode(docs: DataFrame, path: Callable[[], str] = model_file) -> DataFrame:
    """doc_id and ids (array of int) of every document; null and empty texts have none. Rows stay rows, repeated or not."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1, ENCODE_BYTES):
            ids = codec(path()).encode(batch.column(1).fill_null(""))
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "ids"])

    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(made, "doc_id bigint, ids array<int>")


def piece_decode(encoded: DataFrame, path: Callable[[], str] = model_file) -> DataFrame:
    """doc_id and text of ids; null or empty ids give an empty text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path()).decode(np.array([] if x is None else x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(made, "doc_id bigint, text string")


def piece_check(docs: DataFrame, path: Callable[[], str] = model_file) -> DataFrame:
    """Every whole text encoded, decoded and compared: doc_id, n_ids, ids_crc32, round_trip, parity.

    ids_crc32 is over the ids as little-endian unsigned 32-bit numbers; round_trip tells whether decoding gave the text
    back (with a normaliser that changes texts it need not), parity whether the sentencepiece library gives the same
    ids. Null and empty texts have no ids and pass both. Repeated rows are rows of their own; an empty table gives no
    rows; other columns are not looked at.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        other, own = sentencepiece.SentencePieceProcessor(model_file=path()), codec(path())
        for batch in steps(batches, 1, ENCODE_BYTES):
            column = batch.column(1).fill_null("")
            texts, encoded, rows = column.to_pylist(), own.encode(column), []
            for text, raw in zip(texts, encoded, strict=True):
                ids = np.frombuffer(raw, "<u4")
                same = np.array_equal(ids, np.array(other.encode(text, num_threads=1), "<u4"))
                rows.append((len(ids), zlib.crc32(raw), own.decode(ids) == text, same))
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_ids", "ids_crc32", "round_trip", "parity"])

    return pick(docs, doc_id="doc_id bigint", text="text string").mapInArrow(
        made, "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean, parity boolean")
