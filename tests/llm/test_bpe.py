import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import bpe
from tributary.llm.queries import QUERIES
from helpers import docs_frame, odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def lexicon_of(words, vocab):
    words = sorted({w.encode() for w in words})
    return bpe.Lexicon(bpe.compile_lexicon(words, [vocab.merge(w.decode()) for w in words])), words


TEXTS = ["", "  ", "Hello <|endoftext|> wor<|startoftext|>ld <|endoftext|", "aaaa" * 700, "ΑΣ ΣΑΣ ς", "İstanbul", "it's we'll 'S x'LL 'd've",
         "a²½Ⅷ ١٢", "\x1c\x1d a\x85b᠎!\x1c!", "é é ẛ̣ a ́b", "日本語テスト カナ", "_a_b--c!!", "​﻿a",
         "a\x00b", "x" * 60 + "y", "🙂🙂 ok🙂", "ÀÉÎ ÕÜ　ß"]


def test_encoding_and_decoding_agree_with_the_library(library):
    vocab = bpe.read_vocabulary(PATH)
    vocab.prepare()
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice("abcé 'sT1.-\n Σ") for _ in range(rng.randrange(60))) for _ in range(400)]
    some = {w for t in texts[::2] for w in vocab.words(t) if w not in vocab.special}
    for lexicon in (None, lexicon_of(some, vocab)[0]):
        enc = bpe.Encoder(bpe.read_vocabulary(PATH), lexicon)
        for t, ids in zip(texts, enc.encode(texts), strict=True):
            want = library.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, repr(t)
            assert enc.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_automaton_numbers_its_words_and_shares_suffixes():
    rng = random.Random(2)
    words = sorted({("".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) + rng.choice(["", "ing", "ation"])).encode()
                    for _ in range(600)})
    lex = bpe.Lexicon(bpe.compile_lexicon(words, [[i, i + 1] for i in range(len(words))]))
    names = [w.decode() for w in words]
    assert (lex.numbers(names) == np.arange(len(words))).all()
    some = np.array([0, 7, len(words) - 1])
    assert [np.frombuffer(b, "<u4").tolist() for b in lex.bytes_of(some)] == [[i, i + 1] for i in some]
    others = [w + "z" for w in names] + ["", "ingx"] + [w[:-1] for w in names if w[:-1] not in set(names)]
    assert (lex.numbers(others) == -1).all()
    assert len(lex.final) < len({w[:i] for w in words for i in range(len(w) + 1)}) / 2      # states against a plain tree
    empty = bpe.Lexicon(bpe.compile_lexicon([], []))
    assert (empty.numbers(["a", ""]) == -1).all()


def test_memo_generations_keep_results(library):
    enc = bpe.Encoder(bpe.read_vocabulary(PATH), None)
    kept, bpe.MEMO_PIECES = bpe.MEMO_PIECES, 20
    try:
        texts = [f"word{i} again the {i % 7} <|endoftext|>x {i}<|" for i in range(60)]
        for t in texts + texts[::-1]:
            assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    finally:
        bpe.MEMO_PIECES = kept


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_odd_rows(spark, library):
    df = docs_frame(spark, odd_rows(), extra=True)
    want = sorted(((i, *digests(library, t)) for i, t, *_ in odd_rows()), key=str)
    assert sorted((tuple(r) for r in bpe.encode_digests(df, PATH).collect()), key=str) == want
    assert bpe.encode_digests(df.limit(0), PATH).count() == 0
    r = bpe.encode_documents(df.where("doc_id = 8"), PATH).first()
    assert r["ids"] == library.encode(odd_rows()[9][1], add_special_tokens=False).ids


def test_whole_query(spark, library):
    sf = "/root/testdata/sf0.001"
    want = {r["doc_id"]: digests(library, r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op6_bpe_encode"](spark, sf).collect()} == want
