import random

import numpy as np
import pytest

from credit_spark.llm import bpe, token_count, vocabulary
from credit_spark.llm.queries import tokenizer_path

from .helpers import awkward, empty

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ALPHABET = "aaabcde  \n\t'sStT123!?.,éÉßΣσςİ한국어日本語🙂́\u0085\x1c​"


def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(name))
    t.no_truncation()
    t.no_padding()
    return t


def samples():
    rng = random.Random(5)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    return out + ["", "aaaa" * 50, "a" * 5001, "ab" * 3000, "x<|endoftext|>y <|startoftext|><|endoftext|",
                  "<|endoftext|>" * 3, "Ᲊ Ꟛ 𐵐 ﬁ Å"]


@pytest.mark.parametrize("name", FILES)
def test_encode_and_decode_equal_the_library(name):
    lib, codec = library(name), bpe.Codec(vocabulary.load(vocabulary.read_file(tokenizer_path(name))))
    texts = samples()
    want = lib.encode_batch(texts, add_special_tokens=False)
    got = codec.encode_batch(texts)
    assert [w.ids for w in want] == [np.frombuffer(g, "<u4").tolist() for g in got]
    assert [lib.decode(w.ids, skip_special_tokens=False) for w in want] == codec.decode_batch(got)


@pytest.mark.parametrize("name", FILES)
def test_counts_equal_the_library(name):
    lib, counter = library(name), token_count.Counter(vocabulary.load(vocabulary.read_file(tokenizer_path(name))))
    texts = samples()
    assert [len(w.ids) for w in lib.encode_batch(texts, add_special_tokens=False)] == [counter.text(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_letters_of_all_scripts(name):
    lib, codec = library(name), bpe.Codec(vocabulary.load(vocabulary.read_file(tokenizer_path(name))))
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(1, 0x20000, 3) if not 0xD800 <= c < 0xE000]
    want = lib.encode_batch(texts, add_special_tokens=False)
    assert [w.ids for w in want] == [np.frombuffer(g, "<u4").tolist() for g in codec.encode_batch(texts)]


def test_awkward_tables(spark):
    path = tokenizer_path(FILES[0])
    lib = library(FILES[0])
    docs = awkward(spark)
    out = bpe.encode_decode(docs, path).collect()
    assert len(out) == docs.count()
    by_id = {r.doc_id: r for r in out}
    for r in docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(by_id[r.doc_id].ids, "<u4").tolist() == ids
        assert by_id[r.doc_id].decoded == lib.decode(ids, skip_special_tokens=False)
    assert by_id[3].ids == b"" and by_id[3].decoded == ""
    counts = {r.doc_id: r for r in token_count.count_tokens(docs, tokenizer_path(FILES[1])).collect()}
    byte_lib = library(FILES[1])
    for r in docs.collect():
        assert counts[r.doc_id].n_tokens == len(byte_lib.encode(r.text or "", add_special_tokens=False).ids)
        assert counts[r.doc_id].n_bytes == len((r.text or "").encode())
    assert bpe.encode_decode(empty(spark), path).count() == 0
    assert token_count.count_tokens(empty(spark), path).count() == 0
