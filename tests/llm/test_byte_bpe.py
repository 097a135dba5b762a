import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
import tiktoken

from rigwatch.llm import byte_bpe
from rigwatch.llm.registry import QUERIES
from tests.llm.odd import empty_docs, odd_docs, saved

NAME = "op12_piece_model"


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer(ranks):
    words, ids = byte_bpe._tables(ranks)
    patterns = [byte_bpe.library_pattern(public.PATTERN, ranks, below) for below in (0x10000, 0x110000)]
    return byte_bpe.Tokenizer(byte_bpe.serialise(ranks), ids, words, *patterns)


def ids_of(tool, texts):
    return [np.frombuffer(data, "<i4").tolist() for data in tool.encode(texts)]


def test_model_file_is_read_back(ranks):
    model = sentencepiece.SentencePieceProcessor(model_proto=byte_bpe.serialise(ranks))
    assert model.get_piece_size() == len(ranks) + 1 and model.unk_id() == 0
    mapped = byte_bpe.byte_characters()
    assert len(set(mapped)) == 256
    for word, rank in list(ranks.items())[::97]:
        place = model.piece_to_id("".join(mapped[b] for b in word))
        assert model.get_score(place) == -rank


def test_every_character_equals_the_library(ranks):
    tool, lib, rng = tokenizer(ranks), library(ranks), random.Random(1)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(c) + rng.choice(["", "a", " ", "1", "!"]) for c in codes[i:i + 2000]) for i in range(0, len(codes), 2000)]
    assert ids_of(tool, texts) == [lib.encode_ordinary(t) for t in texts]


def test_random_texts_equal_the_library(ranks, monkeypatch):
    tool, lib, rng = tokenizer(ranks), library(ranks), random.Random(2)
    texts = ["".join(rng.choice("abcdefgh  \n\t.,!?'stremdvlé漢🙂01՘\x85\x1f") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["a" * 100_000, " " * 5000 + "x", "don't I'll we'D", "", "9" * 999, "\U000107bb𐞻 a"]
    assert ids_of(tool, texts) == [lib.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 4000)  # memory that forgets all the time
    for i in range(0, len(texts), 100):
        assert ids_of(tool, texts[i:i + 100]) == [lib.encode_ordinary(t) for t in texts[i:i + 100]]


def test_ranks_need_not_be_gapless(ranks):
    apart = {word: 3 * rank + 7 for word, rank in ranks.items()}
    assert ids_of(tokenizer(apart), ["Hello there, wörld  !"]) == [library(apart).encode_ordinary("Hello there, wörld  !")]


def check(spark, folder, ranks):
    lib, want = library(ranks), []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = lib.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = QUERIES[NAME](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_query_equals_the_library(spark, ranks):
    check(spark, "/root/testdata/sf0.01", ranks)


def test_odd_rows(spark, out, ranks):
    check(spark, saved(odd_docs(spark), out), ranks)
    assert QUERIES[NAME](spark, saved(empty_docs(spark), out + "/none")).count() == 0


def test_columns_stay_beside_the_ids(spark, ranks):
    encode, decode = byte_bpe.encoder(ranks, public.PATTERN), byte_bpe.decoder(ranks)
    rows = odd_docs(spark).withColumn("ids", encode("text")).withColumn("back", decode("ids"))
    assert all((r.text or "").encode() == bytes(r.back) and r.size2 == r.n_chars for r in rows.collect())
    assert spark.sql("SELECT cast(null AS array<int>) i").select(decode("i").alias("b")).first().b == b""
