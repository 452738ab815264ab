import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuslake.llm import packing
from corpuslake.stages import Stages

PATH = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(4)
    words = ["Anble", "the", "été", "x" * 40, "don't", "1234", "a-b", "<|endoftext|>", "日本", "e.", " ", "\x1c"]
    gaps = [" ", " ", " ", "\n", "  ", "\n\n", " \n", "\t", "\r\n", "　"]
    out = ["", None, " ", "\n", "a", " a", "a ", "a\tb  c", "a\n", "<|endoftext|>", "x" * 5000]
    for n in (3, 5, 20, 400, 900, 3000):
        for plain in (True, False):
            out.append("".join(rng.choice(words[:10]) + rng.choice(gaps[:4] if plain else gaps) for _ in range(n)))
            out.append(out[-1].strip())
    return out


def test_ids_equal_the_tokenizer(monkeypatch):
    plain = Tokenizer.from_file(PATH)
    texts = [t or "" for t in odd_texts()]
    encoder = packing.WordEncoder(PATH, most=50)
    for _ in range(2):
        for t, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "_BATCH_CHARS", 50)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids


def check(rows, texts, window):
    tok = Tokenizer.from_file(PATH)
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(range(len(texts)))
    for k, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(docs[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
        short += at < window
    assert short <= window.bit_length() and sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("window", [16, 64, 1024])
def test_pieces_cover_every_document_once(spark, window):
    texts = odd_texts() * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    check(packing.pack(df, Stages(spark), PATH, window).collect(), texts, window)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b", 1), (3, None, 2), (3, None, 2)], "doc_id long, text string, offset int")
    rows = packing.pack(df, Stages(spark), PATH).collect()
    tokens = collections.Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens == {None: 3, 3: 2}
    assert packing.pack(df.limit(0), Stages(spark), PATH).collect() == []


def test_plan_fills_windows():
    rng = np.random.default_rng(1)
    counts = rng.poisson(200, 1025)
    counts[0] = 0
    p = packing.plan(counts, 1024)
    packed = p.stream_full + (p.stream_ends[-1] - p.stream_full if len(p.stream_ends) else 0)
    assert packed < 0.05 * (counts * np.arange(1025)).sum()
