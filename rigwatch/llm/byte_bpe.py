"""Byte-level BPE by a sentencepiece model that is serialised from a vocabulary of ranks.

Every byte is written as one printable character, so a vocabulary of byte strings becomes one of
text pieces. A piece scores its negative rank: the model then merges the pair of lowest rank first, the leftmost
of equals, as the ranks demand. Normalisation is the identity. The model is a protocol buffer of a
few fields, written here field by field; it is built once on the driver and sent with the task, about a
megabyte for 50,000 pieces. Texts are cut into pre-tokens by the vocabulary's pattern; a pre-token that is a piece
is one id, any other is encoded by the model. Decoding joins the bytes of the ids.

Defined results: a null or empty text gives no ids; a null or empty list of ids gives no bytes; ids outside the
vocabulary raise an error; texts are taken whole, a pre-token may be as long as its text. All is per row, so
repeated rows, ties, empty tables and further columns need no rule.
"""

from __future__ import annotations

import base64
import itertools
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

CACHE_BYTES = 192 << 20  # pre-tokens that a Python worker remembers, in two halves
CACHE_WORD = 64          # longer ones are not remembered
SLICE_BYTES = 1 << 20    # text worked on at a time


# The model ---------------------------------------------------------------------------------------

def byte_characters() -> list[str]:
    """One printable character per byte: the byte itself where Latin-1 prints it, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model file: the unknown piece, then the vocabulary by rank, so that a piece's id is its place plus one."""
    # Field numbers and enumeration members of the public sentencepiece_model.proto.
    pieces, trainer, normaliser = 1, 2, 3
    piece, score, kind, unknown = 1, 2, 3, 2
    model_type, bpe, vocab_size, unk_id, bos_id, eos_id, pad_id = 3, 2, 4, 40, 41, 42, 43
    name, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces = 1, 3, 4, 5

    mapped = byte_characters()

    def entry(text: str, value: float, *more: bytes) -> bytes:
        return _bytes(pieces, _bytes(piece, text.encode()) + _varint(score << 3 | 5) + struct.pack("<f", value) + b"".join(more))

    out = [entry("<unk>", 0.0, _number(kind, unknown))]
    out += [entry("".join([mapped[b] for b in word]), -float(rank)) for word, rank in sorted(ranks.items(), key=lambda x: x[1])]
    out.append(_bytes(trainer, _number(model_type, bpe) + _number(vocab_size, len(out)) + _number(unk_id, 0)
                      + _number(bos_id, -1) + _number(eos_id, -1) + _number(pad_id, -1)))
    out.append(_bytes(normaliser, _bytes(name, b"identity") + _number(add_dummy_prefix, 0)
                      + _number(remove_extra_whitespaces, 0) + _number(escape_whitespaces, 0)))
    return b"".join(out)


def library_pattern(pattern: str, ranks: dict[bytes, int], below: int) -> str:
    """The pattern for ``re``, its Unicode classes spelt out as tiktoken's own engine has them.

    Engines follow different Unicode versions. The library is asked once: with a class as its
    pattern it drops all other characters. Only code points under ``below`` are listed.
    """
    import tiktoken
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)][:below]))
    inside = False

    def members(name: str) -> str:
        tool = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        codes = np.array([c for c in map(ord, tool.decode(tool.encode_ordinary(every))) if c < below])
        runs = np.split(codes, np.flatnonzero(np.diff(codes) != 1) + 1)
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)

    def spelt(part: re.Match) -> str:
        nonlocal inside
        text = part[0]
        if text in ("[", "[^", "]"):
            inside = text != "]"
            return text
        if text == "\\S" and not inside:
            return f"[^{members('\\s')}]"
        if text == "\\s" or text.startswith("\\p{"):
            return members(text) if inside else f"[{members(text)}]"
        if text in ("\\S", "\\w", "\\W", "\\d", "\\D", "\\b", "\\B") or text.startswith("\\P"):
            raise ValueError(f"class not supported in {pattern!r}: {text}")
        return text

    return re.sub(r"\\p\{\w+\}|\\.|\[\^?|\]", spelt, pattern)


class Tokenizer:
    """Pre-tokens through the model, with a memory for those seen; one per Python worker and vocabulary."""

    def __init__(self, model: bytes, ids: np.ndarray, words: list[bytes], basic: str, full: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids = ids.astype("<i4")                     # id of the vocabulary by place
        self.whole = dict(zip(words, ids.tolist()))
        self.basic, self.full = re.compile(basic), re.compile(full)  # classes of the first plane are tables, longer ones lists
        self.mapped = dict(enumerate(byte_characters()))
        self.known: dict[str, bytes] = {}                # pre-token -> ids as little-endian 32-bit integers
        self.old: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        cut = [self._pattern(text).findall(text) for text in texts]
        fresh = list(set().union(*cut).difference(self.known))
        self.known.update(zip(fresh, self._learn(fresh)))
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        self._forget(fresh)
        return out

    def _pattern(self, text: str) -> re.Pattern:
        return self.basic if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text) else self.full

    def _learn(self, words: list[str]) -> list[bytes]:
        out: list = [self.old.get(w) for w in words]
        merge = []
        for i, word in enumerate(words):
            if out[i] is None:
                data = word.encode()
                whole = self.whole.get(data)
                if whole is None:
                    merge.append((i, data.decode("latin-1").translate(self.mapped)))
                else:
                    out[i] = whole.to_bytes(4, "little")
        if merge:
            places = self.model.encode([text for _, text in merge], out_type=int, num_threads=1)
            data = self.ids[np.fromiter(itertools.chain.from_iterable(places), "i8") - 1].tobytes()
            at = 0
            for (i, _), found in zip(merge, places):
                out[i] = data[at:at + 4 * len(found)]
                at += 4 * len(found)
        return out

    def _forget(self, fresh: list[str]) -> None:
        """Drop long pre-tokens at once, and the older half when the newer one is full."""
        for word in fresh:
            if len(word) > CACHE_WORD:
                del self.known[word]
            else:
                self.held += 200 + 4 * len(word)
        if self.held > CACHE_BYTES // 2:
            self.old, self.known, self.held = self.known, {}, 0


_workers: dict[tuple, Tokenizer] = {}


def _tables(ranks: dict[bytes, int]) -> tuple[list[bytes], np.ndarray]:
    words = sorted(ranks, key=ranks.get)
    return words, np.array([ranks[w] for w in words], "i8")


# Columns -----------------------------------------------------------------------------------------

def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows from, to: about SLICE_BYTES of text at a time, a row at least."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
        yield at, to
        at = to


def encoder(ranks: dict[bytes, int], pattern: str) -> Callable:
    """A function column -> ids (``array<int>``) of every whole text."""
    model, (words, ids) = serialise(ranks), _tables(ranks)
    basic, full = (library_pattern(pattern, ranks, below) for below in (0x10000, 0x110000))
    key = (hash(model), pattern)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _workers:
            _workers[key] = Tokenizer(model, ids, words, basic, full)
        tokenizer = _workers[key]
        for texts in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
            out = [ids for a, b in _slices(sizes) for ids in tokenizer.encode([t or "" for t in texts[a:b].to_pylist()])]
            offsets = np.concatenate([[0], np.cumsum([len(o) for o in out])]) // 4
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(out), "<i4")))
    return encode


def decoder(ranks: dict[bytes, int]) -> Callable:
    """A function column of ids (``array<int>``) -> bytes (``binary``)."""
    words = {rank: word for word, rank in ranks.items()}

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield pa.array([b"".join(map(words.__getitem__, ids.values.to_numpy().tolist())) if ids.is_valid else b""
                            for ids in lists], pa.binary())
    return decode
