"""Wavelet matrices against plain arrays, shards against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from meterflow.llm import token_index
from meterflow.llm.token_index import WaveletMatrix

from .samples import awkward, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n, top", [(0, 4), (1, 2), (511, 7), (512, 50_000), (5000, 3), (3000, 60_000)])
def test_matrix_answers_like_an_array(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    m = WaveletMatrix.build(ids, 16)
    assert np.array_equal(m.decode(), ids) and np.array_equal(m.access(np.arange(n)), ids)
    for token in {*ids[:20].tolist(), top, 70_000}:
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where)
        assert np.array_equal(m.select(token, np.arange(len(where))), where)
        for end in (0, n // 3, n):
            assert m.rank(token, end) == (ids[:end] == token).sum()
        with pytest.raises(IndexError):
            m.select(token, [len(where)])


def odd_texts(seed=3):
    rng = random.Random(seed)
    bits = ["a", "Ab", "word", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", "​", "'s", "don't", "12", "3.5", "<|endoftext|>", "é", "中文", "🙂", "#", "...", "\0"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(600)] + [" ", "", "x " * 3000, " " * 5000]


def test_pieces_encode_like_the_whole(monkeypatch):
    monkeypatch.setattr(token_index, "CACHE_WORDS", 0)
    whole = Tokenizer.from_file(PATH)
    encoder = token_index.Encoder(PATH, token_index.cut_by_spaces(PATH))
    assert encoder.by_word
    texts = odd_texts()
    for room in (400_000, 0):
        token_index.CACHE_WORDS = room
        for _ in range(2):  # the second time words are known
            ids, counts = encoder.encode(pa.array(texts, pa.string()))
            for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                assert got.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
                assert "".join(token_index.pieces(text)) == text
        encoder = token_index.Encoder(PATH, token_index.cut_by_spaces(PATH))


def plain(rows):
    """(doc_id, start, n_tokens, crc) by a loop; rows with the same id keep together."""
    encode = Tokenizer.from_file(PATH)
    out = []
    for i, t in rows:
        ids = encode.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    return out


@pytest.mark.parametrize("shard_tokens", [1 << 21, 500])
def test_shards_hold_every_document(spark, tmp_path, shard_tokens):
    rows = awkward() + [(100 + k, t, "en", "a") for k, t in enumerate(odd_texts())]
    df = frame(spark, rows, part=1, start="x", planes=2.0, doc_start=3)
    path = str(tmp_path / "shards")
    got = token_index.op_index(df, PATH, path, shard_tokens=shard_tokens).collect()
    got.sort(key=lambda r: r["start"])
    want = plain([r[:2] for r in rows])
    assert [(r["doc_id"] is None, r["doc_id"] or 0) for r in got] == sorted((i is None, i or 0) for i, *_ in want)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i is None, i or 0, n, c) for i, n, c, _ in want)
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])])[:-1].tolist()
    # One file per shard, and the look-ups from the files agree with the decoded sequence.
    files = len(list((tmp_path / "shards").glob("part-*.parquet")))
    assert files == spark.read.parquet(path).count() and (files > 8 if shard_tokens == 500 else files >= 1)
    docs = sorted(token_index.documents_in(spark, path).collect(), key=lambda r: r["start"])
    flat = np.concatenate([np.frombuffer(r["tokens"], "<u4") for r in docs])
    common = int(np.bincount(flat).argmax())
    counted = {r["token"]: r["n"] for r in token_index.token_counts(spark, path, [common, 2, 50_256, 99_999]).collect()}
    assert counted == {t: int((flat == t).sum()) for t in (common, 2, 50_256, 99_999)}
    assert sorted(r["position"] for r in token_index.occurrences(spark, path, common).collect()) == np.flatnonzero(flat == common).tolist()
    asked = [0, 5, 5, len(flat) - 1, len(flat), -1, *range(1000, 1050)]
    found = {r["position"]: r["token"] for r in token_index.tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "position long")).collect()}
    assert found == {p: int(flat[p]) for p in asked if 0 <= p < len(flat)}


def test_reruns_and_empty_tables(spark, tmp_path):
    df = frame(spark, awkward())
    a, b = (sorted(map(str, token_index.op_index(df.repartition(n), PATH).collect())) for n in (2, 5))
    assert a == b
    assert token_index.op_index(frame(spark, []), PATH).collect() == []
    text_ids = df.selectExpr("concat('k', doc_id) AS doc_id", "text")
    assert token_index.op_index(text_ids, PATH).count() == df.count()
