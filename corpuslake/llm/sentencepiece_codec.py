"""SentencePiece models run by the tokenizers library.

The model's protobuf is read, and its normaliser, white space marker, pieces (unigram scores, or merges in the order of the
scores) and byte fallback are rebuilt. Ids and texts equal the original's, which ``parity`` and ``encode_documents`` verify
for each text; only where segmentations of a unigram model have the same score may another one be chosen.
"""

from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corpuslake.llm.common import whole_text

MARK = "▁"  # stands for a blank
#: Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes):
    """(number, value) of each field of a protobuf message; values are ints, or bytes of what is longer or fixed."""

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value

    at = 0
    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"no sentencepiece model: wire type {kind}")
        n = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + n]
        at += n


@dataclass(frozen=True)
class PieceModel:
    """What a model file holds, as far as encoding and decoding need it."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @staticmethod
    def read(data: bytes) -> PieceModel:
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        model = PieceModel(
            pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), bool(trainer.get(24, 0)), normalizer.get(2, b""),
            bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)),
        )
        if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape:
            raise ValueError("only unigram and BPE models with the marker before words are supported")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first."""
        ids = {p: k for k, (p, _, _) in enumerate(self.pieces)}
        found = []
        for piece, score, kind in self.pieces:
            if kind in (NORMAL, USER_DEFINED):
                for k in range(1, len(piece)):
                    left, right = piece[:k], piece[k:]
                    if left in ids and right in ids:
                        found.append((-score, ids[left], ids[right], left, right))
        return [(m[3], m[4]) for m in sorted(found)]


def build(model: PieceModel, cached_words: int = 200_000):
    """The tokenizer, without special tokens: control pieces in a text are ordinary text, as in the original."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    ids = {p: k for k, (p, _, _) in enumerate(model.pieces)}
    unknown = next(k for k, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == UNIGRAM:
        lowest = min((s for _, s, kind in model.pieces if kind == NORMAL), default=0.0)
        # Pieces that no text may match get a text that can't occur, so that ids stay. Byte pieces need theirs, so
        # a text with a literal such as <0x41> is the one case in which a unigram model's ids may differ.
        vocabulary = [
            (p, s) if kind in (NORMAL, USER_DEFINED, BYTE, UNKNOWN) else (f"\0{p}", lowest)
            for p, s, kind in model.pieces
        ]
        core = models.Unigram(vocabulary, unknown, model.byte_fallback)
    else:
        core = models.BPE(
            ids, model.merges(), cache_capacity=cached_words, unk_token=model.pieces[unknown][0], fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    # No piece goes on from another character to a marker, so words can be encoded on their own.
    if not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return out


@cache
def _tokenizer(data: bytes, threads: int):
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    return build(PieceModel.read(data))


@cache
def _original(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


class PieceTable:
    """The bytes of each id, to put texts together from ids."""

    def __init__(self, model: PieceModel):
        octets = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in model.pieces
        ]
        self._length = np.array([len(o) for o in octets], np.int64)
        self._start = np.concatenate([[0], np.cumsum(self._length)])
        self._octets = np.frombuffer(b"".join(octets), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(the bytes of all ids, where each id's end)."""
        if len(ids) and int(ids.min()) < 0:
            raise IndexError("an id is below 0")
        ids = ids.astype(np.int64)
        length = self._length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ids) else 0
        at = np.arange(total) + np.repeat(self._start[ids] - (ends - length), length)
        return self._octets[at].tobytes(), ends


class WordEncoder:
    """Ids of texts, each distinct word encoded once; one for all tasks of a process.

    No piece crosses from a word to the marker of the next one, so a text whose words stand between single blanks is the sequence of
    its words. Words that are not known yet are encoded together, in a few long texts that the library's threads share. At most
    ``most`` words and ``most_ids`` ids are kept, then it starts anew. Other texts are encoded as they are.
    """

    def __init__(self, model: PieceModel, tok, most: int = 600_000, most_ids: int = 1 << 22):
        self._tok, self._most, self._most_ids = tok, most, most_ids
        self._apart = tok.pre_tokenizer is not None and model.dummy_prefix and not model.charsmap and model.byte_fallback
        self._begins = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self._clear()

    def _clear(self) -> None:
        self._codes: dict[str, int] = {}
        self._ids = np.empty(0, np.int32)
        self._start, self._length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        ids, lengths = [], []
        parts = [words[k : k + 2048] for k in range(0, len(words), 2048)]
        for part, found in zip(parts, self._whole([" ".join(p) for p in parts]), strict=True):
            starts = np.flatnonzero(self._begins[found])
            if len(starts) != len(part):
                raise ValueError("the model's words can't be told apart")
            ids.append(found)
            lengths.append(np.diff(np.append(starts, len(found))))
        length = np.concatenate(lengths)
        start = len(self._ids) + np.cumsum(length) - length
        self._codes.update(zip(words, range(len(self._codes), len(self._codes) + len(words)), strict=True))
        self._ids = np.concatenate([self._ids, *ids])
        self._start, self._length = np.concatenate([self._start, start]), np.concatenate([self._length, length])

    def _simple(self, text: str) -> bool:
        return self._apart and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " "

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        simple = [k for k, t in enumerate(texts) if t and self._simple(t)]
        other = [k for k, t in enumerate(texts) if t and not self._simple(t)]
        for k, found in zip(other, self._whole([texts[k] for k in other]), strict=True):
            out[k] = found
        split = [texts[k].split(" ") for k in simple]
        words = list(chain.from_iterable(split))
        if not words:
            return out
        if len(self._codes) > self._most or len(self._ids) > self._most_ids:
            self._clear()
        missing = list(dict.fromkeys(w for w in words if w not in self._codes))
        if missing:
            self._learn(missing)
        codes = np.fromiter(map(self._codes.__getitem__, words), np.int64, len(words))
        length = self._length[codes]
        ends = np.cumsum(length)
        flat = self._ids[np.arange(ends[-1]) + np.repeat(self._start[codes] - (ends - length), length)]
        stops = ends[np.cumsum([len(x) for x in split]) - 1]
        for k, part in zip(simple, np.split(flat, stops[:-1]), strict=True):
            out[k] = part
        return out


@cache
def _tables(data: bytes, threads: int) -> tuple[WordEncoder, PieceTable, bool]:
    model = PieceModel.read(data)
    return WordEncoder(model, _tokenizer(data, threads)), PieceTable(model), model.dummy_prefix


def decoded_texts(data: bytes, threads: int, rows: list[np.ndarray]) -> list[str]:
    """The bytes of each row's pieces put together; the library decodes what is no UTF-8."""
    _, table, prefix = _tables(data, threads)
    octets, ends = table.join(np.concatenate(rows) if rows else np.empty(0, np.int32))
    stops = np.concatenate([[0], ends])[np.cumsum([len(r) for r in rows], dtype=np.int64)].tolist() if rows else []
    out, at = [], 0
    for ids, stop in zip(rows, stops, strict=True):
        try:
            text = octets[at:stop].decode()
            out.append(text[1:] if prefix and text[:1] == " " else text)
        except UnicodeDecodeError:
            out.append(_tokenizer(data, threads).decode(ids.tolist(), skip_special_tokens=False))
        at = stop
    return out


def _slices(texts: pd.Series, most_chars: int = 1 << 20):
    """Texts in batches of about so many characters, so that few results are held at once."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > most_chars:
            yield texts[start : k + 1].tolist()
            start, size = k + 1, 0
    if start < len(texts):
        yield texts[start:].tolist()


@dataclass(frozen=True)
class Codec:
    """``model``: bytes of the model file, read once on the driver. ``threads``: of a task, at most the cores it has."""

    model: bytes
    threads: int = 1

    @staticmethod
    def load(path: str, threads: int = 1) -> Codec:
        with open(path, "rb") as f:
            return Codec(f.read(), threads)

    def encode(self, text: Column) -> Column:
        """Ids as array<int>; null text stays null, an empty one has none."""
        codec = self

        @pandas_udf("array<int>")
        def encoded(texts: pd.Series) -> pd.Series:
            words, out = _tables(codec.model, codec.threads)[0], []
            for some in _slices(texts.fillna("")):
                out += words.encode(some)
            return pd.Series(out).where(texts.notna().to_numpy(), None)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """Text of an array of ids; null stays null. An id that the model doesn't have fails the task."""
        codec = self

        @pandas_udf("string")
        def decoded(rows: pd.Series) -> pd.Series:
            given = [np.asarray(r, np.int64) for r in rows if r is not None]
            texts = iter(decoded_texts(codec.model, codec.threads, given))
            return pd.Series([None if r is None else next(texts) for r in rows], dtype=object)

        return decoded(ids)

    def digest(self, text: Column, verified: Column) -> Column:
        """struct<n_tokens long, ids_crc32 long, decoded string, parity boolean>: ids as unsigned little-endian 32-bit numbers, their
        text again, and where ``verified`` is true whether the original library gives the same ids and text (else null)."""
        codec = self

        @pandas_udf("n_tokens long, ids_crc32 long, decoded string, parity boolean")
        def digested(texts: pd.Series, verified: pd.Series) -> pd.DataFrame:
            words, rows, at = _tables(codec.model, codec.threads)[0], [], 0
            for some in _slices(texts):
                ids = words.encode(some)
                again = decoded_texts(codec.model, codec.threads, ids)
                for i, t, a in zip(ids, some, again, strict=True):
                    same = _agrees(codec.model, t, i, a) if verified.iat[at] else None
                    rows.append((len(i), zlib.crc32(i.astype("<u4").tobytes()), a, same))
                    at += 1
            return pd.DataFrame(rows, columns=["n_tokens", "ids_crc32", "decoded", "parity"])

        return digested(whole_text(text), verified)


def _agrees(data: bytes, text: str, ids: np.ndarray, again: str) -> bool:
    original = _original(data)
    return original.encode(text) == ids.tolist() and original.decode(ids.tolist()) == again


def parity(path: str, texts: list[str]) -> list[str]:
    """The texts whose ids or decoded text differ from the original library's."""
    with open(path, "rb") as f:
        data = f.read()
    tok, bad = _tokenizer(data, 1), []
    for t in texts:
        ids = _tables(data, 1)[0].encode([t])[0]
        whole = tok.encode(t, add_special_tokens=False).ids if t else []
        same = whole == ids.tolist() and tok.decode(whole, skip_special_tokens=False) == decoded_texts(data, 1, [ids])[0]
        if not same or not _agrees(data, t, ids, decoded_texts(data, 1, [ids])[0]):
            bad.append(t)
    return bad


def encode_documents(docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text", verify: int = 1) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded, same, parity`` per row: ``same`` if the decoded text is the text itself.

    Each text is also encoded and decoded by the original library; ``parity`` tells whether ids and text are the same. With a ``verify``
    over 1, only one text in so many is, chosen by its hash, and ``parity`` is null for the others. Null text is an empty one. Repeated rows and null ids stay. Other columns
    aren't read. An empty table gives an empty one.
    """
    body = whole_text(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    chosen = F.pmod(F.xxhash64("body"), F.lit(verify)) == 0
    rows = rows.select("doc_id", "body", codec.digest(F.col("body"), chosen).alias("d"))
    return rows.select(
        "doc_id", "d.n_tokens", "d.ids_crc32", "d.decoded", (F.col("d.decoded") == F.col("body")).alias("same"), "d.parity"
    )
