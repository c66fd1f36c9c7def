import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from gridloom.llm.bpe import WordBpe, encode_decode
from gridloom.llm.tokens import UnigramCounter, load_vocabulary, token_counts

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "It's we'll they'd I'm", "ÀÉÎ naïve Straße İ ǅ ª ² ¼ 12345", "x<|endoftext|>y <|startoftext|><|endoftext|>", "日本語 テスト 한국어 Σίσυφος ΟΔΟΣ", "é ä", "\x1c\x1d a\x85b\xa0c", "🙂🙃 👍🏽", "aaaaaaaaaaaaaaaaaaaaaaaaa", "!!!???...", "it'S 'RE", " x　y"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def mine():
    return WordBpe(open(BPE, encoding="utf-8").read())


def expected(library, text):
    e = library.encode(text or "", add_special_tokens=False)
    return " ".join(map(str, e.ids)), library.decode(e.ids, skip_special_tokens=False)


def test_bpe_on_odd_texts(library, mine):
    texts = [t or "" for t in ODD]
    assert list(mine.encode_all(texts)) == [expected(library, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdehilnorst'AE é1.,! \n"), max_size=60), max_size=4))
def test_bpe_property(texts):
    library, mine = Tokenizer.from_file(BPE) if not hasattr(test_bpe_property, "t") else test_bpe_property.t, None
    if not hasattr(test_bpe_property, "t"):
        test_bpe_property.t = library
        test_bpe_property.m = WordBpe(open(BPE, encoding="utf-8").read())
    mine = test_bpe_property.m
    assert list(mine.encode_all(texts)) == [expected(library, t) for t in texts]


def test_bpe_query_equals_library(spark, tiny, library):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.union(odd).withColumn("n_tokens", F.lit("clash"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(both, BPE).collect()}
    for r in both.collect():
        ids, text = expected(library, r.text)
        assert got[r.doc_id] == (len(ids.split()), sha(ids), sha(text))
    assert encode_decode(both.limit(0), BPE).count() == 0


@pytest.fixture(scope="module")
def unigram():
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return Tokenizer(Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], unk_id=0, byte_fallback=True))


def whole(unigram, text):
    return len(unigram.encode("▁" + text.replace(" ", "▁")).ids) if text else 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abdehinorst  é日\n\tß.1"), max_size=80))
def test_token_counts_property(text):
    f = test_token_counts_property
    if not hasattr(f, "c"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        f.t = Tokenizer(Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], unk_id=0, byte_fallback=True))
        f.c = UnigramCounter(load_vocabulary(PIECES))
    assert f.c.count(text) == whole(f.t, text)


def test_token_counts_equal_library(spark, tiny, unigram):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    both = docs.union(odd).withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: r.n_tokens for r in token_counts(both, load_vocabulary(PIECES)).collect()}
    assert got == {r.doc_id: whole(unigram, r.text) for r in both.collect()}
    assert token_counts(both.limit(0), load_vocabulary(PIECES)).count() == 0


def very_long():
    words = ["the", "naïve", "Straße", "1234", "unbelievably", "x" * 50, "日本", "a,b;", "\n"]
    return " ".join(words[(i * i) % 9] + str(i % 997) for i in range(120_000))


def test_very_long_texts(spark, library, unigram):
    rows = [(1, very_long()), (2, "z" * 30_000), (2, "z" * 30_000), (None, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keep", F.col("doc_id"))
    got = sorted((r.doc_id or 0, r.keep or 0, r.n_tokens) for r in token_counts(docs, load_vocabulary(PIECES), keep=("keep",)).collect())
    assert got == sorted((i or 0, i or 0, whole(unigram, t)) for i, t in rows)
    want = []
    for i, t in rows:
        ids, back = expected(library, t)
        want.append((i or 0, len(ids.split()), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(docs, BPE).collect()) == sorted(want)
