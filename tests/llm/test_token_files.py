import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rigwatch.llm import QUERIES, token_files
from rigwatch.llm.queries import vocabulary
from tests.llm.odd import empty_docs, odd_docs, saved

SF = "/root/testdata/sf0.01"


def brute(docs):
    tk = Tokenizer.from_file(vocabulary())
    tk.encode_special_tokens = True
    order = sorted(docs, key=lambda d: (d.doc_id is not None, d.doc_id or 0, zlib.crc32((d.text or "").encode())))
    at, out = 0, []
    for d in order:
        ids = np.array([*tk.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def rows(df):
    return sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()], key=str)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", SF])
def test_op2_on_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert rows(QUERIES["op2_plane_blocks"](spark, folder)) == brute(docs)


def test_op2_on_odd_rows(spark, out):
    assert rows(QUERIES["op2_plane_blocks"](spark, saved(odd_docs(spark), out))) == brute(odd_docs(spark).collect())
    assert QUERIES["op2_plane_blocks"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_small_blocks_round_trip(spark, out, bits):
    docs = odd_docs(spark).where("doc_id is null or doc_id != 5")
    token_files.write_ids(docs, out + "/ids", vocabulary(), bits=bits, block_ids=64, part_bytes=2000)
    blocks = token_files.read_blocks(spark, out + "/ids")
    assert rows(token_files.documents_of(blocks)) == brute(docs.collect())
    assert all(len(b.planes) == (32 if bits else 4) and b.n_ids <= 64 for b in blocks.collect())


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    for bits in (False, True):
        assert (token_files.from_planes(token_files.to_planes(ids, bits), n) == ids).all()


def test_joined_checksums():
    rng = random.Random(1)
    for a, b in [(0, 0), (0, 5), (5, 0), (7, 9), (1000, 4096), (3, 100_000)]:
        x, y = rng.randbytes(a), rng.randbytes(b)
        assert token_files.joined_crc(zlib.crc32(x), zlib.crc32(y), b) == zlib.crc32(x + y)


def differing(encoder, texts):
    return [t for t, g in zip(texts, encoder.encode(texts)) if g != encoder._whole(t)]


def test_folded_and_cut_words_equal_the_library(monkeypatch):
    """Capitals, marks at the ends of words and what composes with them; words that leave the memory and come back."""
    rng = random.Random(3)
    pool = [*"aAzZ0HTS9.,;:!?'\"-éÉßİΣσςﬁªº²ẖ<漢ɐǅŉ🙂\u0300\u0331\u0338\u0307\u1dc4\xa0\u2028", " ", " ", "\n", "\t", "...", "'s", "'LL"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    encoder = token_files.Encoder(vocabulary())
    assert encoder.folds and encoder.marks == token_files.MARKS
    assert differing(encoder, texts) == []
    monkeypatch.setattr(token_files, "CACHE_WORDS", 500)
    for i in range(0, 2000, 100):
        assert differing(encoder, texts[i:i + 100] + texts[:50]) == []
        assert len(encoder.recent) <= 500


def test_a_word_is_looked_up_once_for_all_texts():
    """The work of a slice goes with its different words, however often they occur; texts that go to the library lie between."""
    encoder, seen = token_files.Encoder(vocabulary()), []

    class Memory(dict):
        def __getitem__(self, word):
            seen.append(word)
            return super().__getitem__(word)
    encoder.recent = Memory()
    texts = ["", " the quick\tbrown fox ", "a\x1cb", "the quick " * 50, "\u2003the\u2028Quick\xa0", "   "] * 20
    assert differing(encoder, texts) == [] and len(seen) < 20


def test_words_of_latin_letters_go_to_the_model_alone():
    """The tokenizer's normalizer and regular expression see none of them, in capitals or with marks of French and German."""
    rng = random.Random(4)
    letters = [*"abcdefghijklmnopqrstuvwxyz", *"AEIOUÀÉÈÊÇÑÖÜÞßàéèêçñöüýþÿ"]
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(50)) for _ in range(400)]
    encoder, seen = token_files.Encoder(vocabulary()), []
    library = encoder.tokenizer

    class Seen:
        def encode_batch_fast(self, lines, **more):
            seen.extend(lines)
            return library.encode_batch_fast(lines, **more)
    encoder.tokenizer = Seen()
    got = encoder.encode(texts)
    encoder.tokenizer = library
    assert seen == [] and got == [encoder._whole(t) for t in texts]


def test_all_marks_and_letters_beside_them_equal_the_library():
    rng = random.Random(5)
    pool = [*"aZé5É×÷ß'µªºK-", *token_files.MARKS, "***", "$$$", ' "', "\u0338", "\u0301", "'s", "<|endoftext|>", " ", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(20_000)]
    assert differing(token_files.Encoder(vocabulary()), texts) == []


def test_memory_of_words_is_small_and_bounded(monkeypatch):
    """No Python object for a word that is kept; long words count by their bytes."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) + rng.choice(["", "."]) for _ in range(1000)) for _ in range(50)]
    encoder = token_files.Encoder(vocabulary())
    encoder.encode(texts[:1])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    encoder.encode(texts)
    held = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert held < 1_000_000 and 49_000 < len(encoder.recent) and encoder.recent.nbytes < 60 * len(encoder.recent)
    monkeypatch.setattr(token_files, "CACHE_BYTES", 100_000)
    long = [f"{i} " + "x" * 30_000 for i in range(20)] + ["y" * 50_000]
    for i in range(0, 20, 2):
        assert differing(encoder, texts[i:i + 1] + long[i:i + 2] + long[-1:]) == []
        assert encoder.recent.nbytes <= 100_000


def test_encoder_equals_the_library():
    rng = random.Random(2)
    pool = "abcXYZ019.,!'&<|> \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u2028\u3000\u200b\u180e\u0301\u0338éÉßİŉſΣσςñЖ漢字🙂가각ᄀ\u1161\u11a8\ufeff\x00½²"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "it's they'll I'D 's", "a \u0301b", "\u0338 <\u0338 x"]
    tk = Tokenizer.from_file(vocabulary())
    tk.encode_special_tokens = True
    got = token_files.Encoder(vocabulary()).encode(texts)
    bad = [t for t, g in zip(texts, got) if np.frombuffer(g, "<u4").tolist() != tk.encode(t, add_special_tokens=False).ids]
    assert bad == []
