import pathlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpuslake.llm import sentencepiece_codec as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(9)
    out = ["", " ", "  a", "a  b ", "a\n\nb", "日本語 🙂", "▁x ▁▁ y", "\t", "<s> </s> <unk> <0x41>", "x" * 3000, "été 123 4567", "a    b", "\0"]
    return out + ["".join(rng.choice("ab \n é1▁日🙂") for _ in range(rng.randrange(80))) for _ in range(400)]


def test_bpe_parity():
    assert sp.parity(PATH, texts()) == []


def message(fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3 & 127 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"") + bytes([value])
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            size, n = b"", len(value)
            while n > 127:
                size, n = size + bytes([n & 127 | 128]), n >> 7
            out += bytes([number << 3 | 2]) + size + bytes([n]) + value
    return out


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A small unigram model with byte fallback, written by hand."""
    rng = random.Random(3)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    made = {"▁", *"abcdeé"}
    while len(made) < 90:
        made.add("▁" * rng.randrange(2) + "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 5))))
    pieces += [(p, -rng.uniform(2, 12), 1) for p in sorted(made)]
    body = b"".join(message([(1, message([(1, p.encode()), (2, s), (3, k)]))]) for p, s, k in pieces)
    body += message([(2, message([(3, 1), (35, 1)])), (3, message([(1, b"identity"), (3, 1), (4, 1), (5, 1)]))])
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(body)
    return str(path)


def test_unigram_parity(unigram):
    rng = random.Random(4)
    made = ["".join(rng.choice("abcdeé  x日") for _ in range(rng.randrange(60))) for _ in range(300)]
    other = sp.parity(unigram, [t for t in [" a", "a ", "abc  de", *made] if t.strip()])
    # Where segmentations have the same score, the libraries may choose different ones.
    original, tok = sentencepiece.SentencePieceProcessor(model_file=unigram), sp.build(sp.PieceModel.read(pathlib.Path(unigram).read_bytes()))
    for t in other:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert sum(map(original.get_score, ids)) == pytest.approx(sum(map(original.get_score, original.encode(t))), abs=1e-4)
        assert tok.decode(ids, skip_special_tokens=False) == original.decode(ids)
    assert len(other) < 6


def test_columns(spark):
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(k, t, "x") for k, t in enumerate(texts())] + [(None, None, "x"), (3, "a", "y"), (3, "a", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    codec = sp.Codec.load(PATH, threads=2)
    both = df.select("text", codec.encode(F.col("text")).alias("ids")).select("text", "ids", codec.decode(F.col("ids")).alias("again"))
    for r in both.collect():
        assert r.ids == (None if r.text is None else original.encode(r.text))
        assert r.again == (None if r.text is None else original.decode(r.ids))
    for r in sp.encode_documents(df, codec).collect():
        if r.doc_id is not None and r.doc_id != 3:
            ids = original.encode(rows[r.doc_id][1])
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            assert r.same == (original.decode(ids) == rows[r.doc_id][1])
    verified = [r.parity for r in sp.encode_documents(df, codec, verify=2).collect()]
    assert set(verified) == {None, True} and verified.count(True) > 100
    assert sp.encode_documents(df.limit(0), codec).collect() == []


def test_every_text_is_verified(spark):
    rows = [(k, t) for k, t in enumerate(texts())] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.parity for r in sp.encode_documents(docs, sp.Codec.load(PATH)).collect()] == [True] * len(rows)


def test_words_are_kept_within_bounds():
    model = sp.PieceModel.read(pathlib.Path(PATH).read_bytes())
    words = sp.WordEncoder(model, sp.build(model), most=40, most_ids=300)
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for some in np.array_split(np.array(texts(), dtype=object), 30):
        assert [i.tolist() for i in words.encode(list(some))] == original.encode(list(some))
        assert len(words._codes) < 400


def test_ids_that_are_no_text(spark):
    """Bytes that make up no character, and pieces that no text has, decode as in the library."""
    data = pathlib.Path(PATH).read_bytes()
    tok = sp.build(sp.PieceModel.read(data))
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.choice([*range(3, 259), 259, 261, 262, 29871, 4000]) for _ in range(rng.randrange(12))]
        assert sp.decoded_texts(data, 1, [np.array(ids, np.int64)]) == [tok.decode(ids, skip_special_tokens=False)]
    with pytest.raises(IndexError):
        sp.decoded_texts(data, 1, [np.array([-1])])
    with pytest.raises(IndexError):
        sp.decoded_texts(data, 1, [np.array([32000])])


def test_other_files_are_refused():
    with pytest.raises((ValueError, IndexError)):
        sp.PieceModel.read(b"\x0f\x0f\x0f")
