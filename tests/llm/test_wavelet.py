import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import queries, wavelet

PATH = public_tokenizers.path(queries.TOKENIZER)


def expected(rows):
    """Plain encoding, document by document."""
    t, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [queries.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shown(df):
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()]
    return sorted(got, key=lambda r: r[1])


def test_matrix_answers_like_a_list():
    rng = np.random.default_rng(3)
    for n, high in ((0, 9), (1, 2), (63, 5), (64, 200), (5000, 60), (1000, 70_000)):
        x = rng.integers(0, high, n)
        data = wavelet.write_shard(x, [n], [1], 0, max(1, int(high).bit_length()))
        m = wavelet.read_shard(data)[0]
        assert (m.tokens() == x).all()
        assert (m.access(np.arange(n)) == x).all()
        for token in {0, 1, high - 1, high + 1, *x[:20].tolist()}:
            at = np.flatnonzero(x == token)
            assert m.count(token) == len(at) and (m.occurrences(token) == at).all()
            assert m.count(token, n // 4, n // 2) == ((at >= n // 4) & (at < n // 2)).sum()
            assert [m.select(token, k) for k in range(len(at) + 1)] == [*at, -1]
    with pytest.raises(IndexError):
        m.access([n])
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix.build(np.array([8]), 3)


def test_lookups_read_the_blocks_they_need(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK", 4)
    x = np.random.default_rng(4).integers(0, 200, 20_000)
    data, asked = wavelet.write_shard(x, [20_000], [1], 0, 8), []

    def read(at, size):
        asked.append(size)
        return data[at:at + size]

    m = wavelet.open_shard(read)[0]
    head = sum(asked)
    assert (m.access([17, 19_999]) == x[[17, 19_999]]).all() and m.select(int(x[0]), 0) == 0
    assert sum(asked) - head < 0.05 * len(data) and head < len(data) / 2
    assert m.count(7) == (x == 7).sum() and (m.occurrences(7) == np.flatnonzero(x == 7)).all() and (m.tokens() == x).all()


def test_encoder_equals_whole_texts():
    texts = ["it's 'twas !'s a.'s x'll. don't, can't' ''b 3rd a1b2 e\u0301. .e\u0301 a…!b !é.é x.\u0301y I'LL 'RE", "a\x00b\x7fc~d_e", "a\x1cb \x0bc\x0cd\re\nf", "x<|ENDOFTEXT|>y <|endoftext|", "Z" * 5000, "It's  the\tend. Now then", "<|endoftext|> a <|startoftext|>b", "é ́x ÅÅ", "1,234.5 -- ...",
             "ΑΣ ΣΑΣ", "", "  ", "日本語 テキスト", "\x1ca\x85b"]
    t, e = Tokenizer.from_file(PATH), wavelet.Encoder(PATH, keep=5)
    for _ in range(3):  # with a cold, a warm and a turned-over memory
        ids, sizes = e.encode(pa.array([*texts, None]))
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes))]
        assert got == [*(t.encode(x, add_special_tokens=False).ids for x in texts), [], []]
    e.marker = None  # a tokenizer without a special token to put between chunks
    e._forget()
    assert (e.encode(pa.array(texts))[0] == ids).all()


def test_odd_documents_and_small_shards(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    for size in (1 << 21, 40):
        df = wavelet.token_shards(odd_documents, PATH, queries.END_ID, queries.VOCABULARY, size)
        assert shown(df) == expected(rows)
    assert shown(wavelet.token_shards(no_documents, PATH, queries.END_ID, queries.VOCABULARY)) == []


def test_other_orders_and_places(spark, rows):
    data = [(i, f"alpha b{i % 3} " * (i % 5)) for i in range(40)]
    docs = rows(data, "doc_id long, text string")
    folder, before = wavelet.encode_documents(docs, PATH, queries.END_ID, queries.VOCABULARY, 30, order=[-F.col("doc_id") % 7, F.col("doc_id")])
    back = sorted(wavelet.read_documents(spark, folder, before).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted(range(40), key=lambda i: (-(i % 7), i))
    places = sorted(r.place for r in wavelet.token_places(spark, folder, before, [queries.END_ID]).collect())
    assert places == [r.start + r.n_tokens - 1 for r in back]
    assert wavelet.token_places(spark, folder, before, [queries.VOCABULARY - 1]).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(queries.op1_wavelet(spark, sf)) == expected(rows)
