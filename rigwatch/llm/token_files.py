"""Token ids in files of bit-plane shuffled, compressed blocks.

Documents are dealt into parts of near equal bytes by sampled splitters on their order and encoded
in order. The ids of a part run through blocks of a fixed number of ids. A block is transposed into
byte planes (or bit planes), every plane is compressed with zstandard, and the block's row keeps the
chunk index: its part, place, count, and the documents' pieces inside it. A block can be decoded on
its own. The container is uncompressed Parquet, so any file system that Spark writes will do.

Defined results: a null text is an empty one (the end id alone); repeated rows and equal ids are all
written, ordered by id (null first), then by checksum of the text; a document may be longer than a
block; an empty table gives no blocks; further columns are ignored.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rigwatch.llm import sharding
from rigwatch.session import materialise

END_ID = 1
BLOCK_IDS = 1 << 16
PART_BYTES = 8 << 20         # aim for the text of a part
MAX_PARTS = 1 << 16          # then parts grow
CACHE_WORDS = 1_000_000      # encoded words that a Python worker keeps
CACHE_BYTES = 48 << 20       # and the bytes of these with their ids
LEARNT_WORDS = 5_000         # words given to the library at a time
MARKS = ".,;:!?#$%&*\")"     # marks cut off a word's end before it is encoded
SLICE_CHARS = 4_000_000      # text encoded at a time
BLOCK_SCHEMA = ("part int, block int, start long, n_ids int, planes array<binary>, "
                "piece_doc array<long>, piece_number array<long>, piece_ids array<int>")


# Planes ------------------------------------------------------------------------------------------

def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of unsigned 32-bit ids, each compressed: four byte planes, or 32 bit planes."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(p, bitorder="little") for p in rows.T]
    else:
        planes = list(rows.T)
    pack = zstandard.ZstdCompressor(level=3).compress
    return [pack(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block, from four byte planes or 32 bit planes."""
    unpack = zstandard.ZstdDecompressor().decompress
    raw = [np.frombuffer(unpack(p, max_output_size=max(n, 1)), np.uint8) for p in planes]
    if len(raw) == 32:
        bits = np.stack([np.unpackbits(p, count=n, bitorder="little") for p in raw], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.stack(raw, axis=1).reshape(-1).view("<u4")


# Encoding ----------------------------------------------------------------------------------------

class Encoder:
    """Encodes with the library, once for each distinct word.

    The tokenizer named must treat white space as a separator and nothing else, as one that drops
    it does; then a text's ids are those of its stretches in turn. Texts with characters on which
    Python and the tokenizer disagree about white space, or with NUL, go to the library whole.
    ASCII is lower-cased beforehand if the tokenizer does so (but not beside combining marks, with
    which it composes first), and a stretch is cut before its last punctuation marks if the
    tokenizer does so. Words of Latin letters alone go to the library's model without its normalizer
    and regular expression, if these put such words into small letters, leave them whole, and the
    model marks the ends of words. All three are probed, and all leave the ids as they are.
    Words and their ids are kept in Arrow columns; when there are too many, the last slice's stay.
    """

    unsure = "\x00\x1c\x1d\x1e\x1f"
    combining = re.compile("[\u0300-\u036f]")
    letters = frozenset(c for c in map(chr, range(0x250)) if c.lower().isalpha())  # to every version of Unicode, in any case
    latin = "".join(c for c in map(chr, range(0xc0, 0x100)) if c.isalpha()) + string.ascii_letters  # nothing among them composes

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.recent = self._table(pa.array([], pa.large_string()), pa.array([], pa.large_binary()))
        self.nul, = self.tokenizer.encode("\x00", add_special_tokens=False).ids
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.folds = normal is not None and normal.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        self.marks = "".join(m for m in MARKS if cut is not None and all(
            [at for _, at in cut.pre_tokenize_str(letter + m + more)][:1] == [(0, 1)] for letter in "a0" for more in ("", m)))
        self.before_marks = f"[{''.join(sorted(self.letters))}]$"
        self.model = self._model()

    def _model(self):
        """The library's model between blanks alone; none if words of Latin letters don't come to it whole, as bytes of small letters."""
        from tokenizers import Tokenizer, pre_tokenizers
        given, normal, cut = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        suffix, small = getattr(given, "end_of_word_suffix", None), self.latin.lower()
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        if (not suffix or normal is None or cut is None or normal.normalize_str(self.latin) != small
                or cut.pre_tokenize_str(small) != as_bytes.pre_tokenize_str(small)):
            return None
        self.bytes = {b: m for c in small for b, m in zip(c.encode().decode("latin-1"), as_bytes.pre_tokenize_str(c)[0][0], strict=True) if b != m}
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)  # ids that end a word
        self.last[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
        model = Tokenizer(given)  # shares the vocabulary
        model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return model

    @staticmethod
    def _table(words: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        return pa.record_batch([words, ids], ["word", "ids"])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        plain = [not any(c in t for c in self.unsure) for t in texts]
        lines = pa.array([self._fold(t) for t, p in zip(texts, plain) if p], pa.large_string())
        split = pc.ascii_split_whitespace(lines)
        words = split.flatten().dictionary_encode()
        placed = self._placed(words.dictionary, words.indices)
        _, bounds, data = placed.buffers()
        ends = np.frombuffer(bounds, np.int64, len(placed) + 1) if len(placed) else np.zeros(1, np.int64)
        cuts, data = iter(ends[split.offsets.to_numpy()].tolist()), memoryview(data or b"")
        start, out = next(cuts), []
        for t, p in zip(texts, plain):
            end = next(cuts) if p else start
            out.append(bytes(data[start:end]) if p else self._whole(t))
            start = end
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _fold(self, text: str) -> str:
        """The text with ASCII alone as white space, and in lower case if the tokenizer does so."""
        if text.isascii():
            return text.lower() if self.folds else text
        text = " ".join(text.split())
        return text.encode().lower().decode() if self.folds and not self.combining.search(text) else text  # bytes: ASCII alone

    def _placed(self, words: pa.Array, indices: pa.Array) -> pa.Array:
        """Ids of the words at these indices; the words differ."""
        core = pc.utf8_rtrim(words, characters=self.marks) if self.marks else words
        cut = pc.and_(pc.not_equal(core, words), pc.match_substring_regex(core, self.before_marks))
        at, n = np.flatnonzero(cut), len(words)
        marks = [w[len(c):] for w, c in zip(words.filter(cut).to_numpy(zero_copy_only=False), core.filter(cut).to_numpy(zero_copy_only=False))]
        parts = pa.concat_arrays([pc.if_else(cut, core, words), pa.array(marks, pa.large_string())]).dictionary_encode()
        ids = self._known(parts.dictionary).take(parts.indices)
        joined = pc.binary_join_element_wise(ids.take(pa.array(at)), ids.slice(n), pa.scalar(b"", pa.large_binary()))
        place = np.arange(n)
        place[at] = n + np.arange(len(at))
        return pa.concat_arrays([ids.slice(0, n), joined]).take(pa.array(place[indices.to_numpy()]))

    def _known(self, words: pa.Array) -> pa.Array:
        """Ids of different words, from those kept or else from the library."""
        kept, place = self.recent, np.arange(len(words))
        if len(kept):
            found = pc.index_in(words, value_set=kept.column("word"))
            new = found.is_null().to_numpy(zero_copy_only=False)
            place = np.where(new, len(kept) + np.cumsum(new) - 1, found.fill_null(0).to_numpy())
            fresh = words.filter(pa.array(new))
            kept = pa.concat_batches([kept, self._table(fresh, self._learn(fresh))])
        else:
            kept = self._table(words, self._learn(words))
        ids = kept.column("ids").take(pa.array(place))
        for self.recent in (kept, self._table(words, ids), kept.slice(0, 0)):
            if len(self.recent) <= CACHE_WORDS and self.recent.nbytes <= CACHE_BYTES:
                break
        return ids

    def _learn(self, words: pa.Array) -> pa.Array:
        """Ids of words from the library: words of Latin letters through its model, others with the NUL character, one id that no other word has, between them."""
        if not self.model:
            return self._spelled(words, False)
        latin = pc.match_substring_regex(words, f"^[{self.latin}]+$")
        order = np.argsort(~latin.to_numpy(zero_copy_only=False), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return pa.concat_arrays([self._spelled(pc.utf8_lower(words.filter(latin)), True),
                                 self._spelled(words.filter(pc.invert(latin)), False)]).take(pa.array(place))

    def _as_bytes(self, line: str) -> str:
        """A character for each byte, as the library's models have them."""
        line = line.encode().decode("latin-1")
        for byte, character in self.bytes.items():
            line = line.replace(byte, character)
        return line

    def _spelled(self, words: pa.Array, latin: bool) -> pa.Array:
        """Encode words in groups, a line of text each."""
        out = [pa.array([], pa.large_binary())]
        for i in range(0, len(words), LEARNT_WORDS):
            some = words.slice(i, LEARNT_WORDS)
            groups = pa.LargeListArray.from_arrays(np.append(np.arange(0, len(some), 500), len(some)), some)
            lines = pc.binary_join(groups, pa.scalar(" " if latin else " \x00 ", some.type)).to_pylist()
            if latin:
                lines = [line if line.isascii() else self._as_bytes(line) for line in lines]
                ids = np.concatenate([np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(lines, add_special_tokens=False)])
                ends = np.flatnonzero(self.last[ids]) + 1
            else:
                found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
                ids = np.concatenate([np.array([*e.ids, self.nul], "<u4") for e in found])
                ends = np.flatnonzero(ids == self.nul)
                ends, ids = ends - np.arange(len(ends)), ids[ids != self.nul]
            if len(ends) != len(some):
                raise ValueError("words and ends of words differ in number")
            out.append(pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(some), [None, pa.py_buffer(np.append(0, ends) * 4), pa.py_buffer(ids)]))
        return pa.concat_arrays(out)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Part:
    """Ids of one part on their way into blocks."""

    def __init__(self, part: int, bits: bool, block_ids: int):
        self.part, self.bits, self.block_ids = part, bits, block_ids
        self.block = self.start = self.number = 0
        self.held: list[np.ndarray] = []
        self.pieces: list[tuple] = []
        self.n = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        while len(ids):
            head, ids = ids[:self.block_ids - self.n], ids[self.block_ids - self.n:]
            self.held.append(head)
            self.pieces.append((doc_id, self.number, len(head)))
            self.n += len(head)
            if self.n == self.block_ids:
                yield self.flush()
        self.number += 1

    def flush(self) -> tuple:
        docs, numbers, counts = map(list, zip(*self.pieces))
        row = (self.part, self.block, self.start, self.n, to_planes(np.concatenate(self.held), self.bits), docs, numbers, counts)
        self.block, self.start, self.n, self.held, self.pieces = self.block + 1, self.start + self.n, 0, [], []
        return row


def _encode_parts(path: str, end_id: int, bits: bool, block_ids: int):
    kinds = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()),
                       ("planes", pa.list_(pa.binary())), ("piece_doc", pa.list_(pa.int64())),
                       ("piece_number", pa.list_(pa.int64())), ("piece_ids", pa.list_(pa.int32()))])

    def batch(row: tuple) -> pa.RecordBatch:
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, kinds)], schema=kinds)

    def slices(b: pa.RecordBatch) -> Iterator[tuple[list, list, list]]:
        parts, ids = b.column("part").to_pylist(), b.column("doc_id").to_pylist()
        lengths, at = np.cumsum(np.asarray(b.column("chars"))), 0
        while at < len(parts):
            done = lengths[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(lengths, done + SLICE_CHARS, side="right")))
            yield parts[at:to], ids[at:to], [t or "" for t in b.column("text").slice(at, to - at).to_pylist()]
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, state, end = _encoder(path), None, np.array([end_id], "<u4").tobytes()
        for b in batches:
            for parts, ids, texts in slices(b):
                for part, doc_id, data in zip(parts, ids, encoder.encode(texts)):
                    if state is None or state.part != part:
                        if state is not None and state.n:
                            yield batch(state.flush())
                        state = _Part(part, bits, block_ids)
                    for row in state.add(doc_id, np.frombuffer(data + end, "<u4")):
                        yield batch(row)
                pa.default_memory_pool().release_unused()  # a slice's columns, else kept beside the JVM's memory
        if state is not None and state.n:
            yield batch(state.flush())
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
              end_id: int = END_ID, bits: bool = False, block_ids: int = BLOCK_IDS, part_bytes: int = PART_BYTES) -> None:
    """Encode every whole text and write the blocks below ``path``, in ascending order of ``doc_id``."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text"), F.crc32(t).alias("crc"),
                       F.char_length(t).alias("chars"))
    slim = materialise(rows.select("doc_id", "crc", F.octet_length("text").cast("long").alias("size")), "token-sizes")
    total = slim.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = int(min(MAX_PARTS, total // part_bytes + 1))
    keys = ["doc_id", "crc"]
    bounds = sharding.splitters(slim, keys, "size", parts, total)
    dealt = (rows.withColumn("part", sharding.range_of(rows, keys, bounds)).repartitionById(parts, "part")
             .sortWithinPartitions("part", "doc_id", "crc").select("part", "doc_id", "text", "chars"))
    dealt.mapInArrow(_encode_parts(tokenizer, end_id, bits, block_ids), BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


# Reading -----------------------------------------------------------------------------------------

def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "number", "doc_id", "block", "start", "n_ids", "crc"]
    for b in batches:
        out: list[list] = [[] for _ in names]
        for part, block, start, n, planes, docs, numbers, counts in zip(*[c.to_pylist() for c in b.columns]):
            data, at = memoryview(from_planes(planes, n).astype("<u4").tobytes()), 0
            for doc, number, count in zip(docs, numbers, counts):
                crc = zlib.crc32(data[at * 4:(at + count) * 4])
                for column, v in zip(out, (part, number, doc, block, start + at, count, crc)):
                    column.append(v)
                at += count
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's, highest power in the lowest bit."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        a = (a << 1) & 0xFFFFFFFF
    return out


def joined_crc(first: int, second: int, second_bytes: int) -> int:
    """Checksum of two stretches of bytes in a row, from theirs and the length of the second."""
    power, square, n = 0x80000000, 0x00800000, second_bytes  # 1, and x to the power of one byte
    while n:
        if n & 1:
            power = _times(square, power)
        square = _times(square, square)
        n >>= 1
    return _times(power, first) ^ second


@F.pandas_udf(LongType())
def _whole_crc(pieces: pd.Series) -> pd.Series:
    out = []
    for p in pieces:
        crc = p[0]["crc"]
        for x in p[1:]:
            crc = joined_crc(crc, x["crc"], 4 * x["n_ids"])
        out.append(crc)
    return pd.Series(out, dtype="int64")


def documents_of(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the blocks."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part: at most MAX_PARTS
    offsets = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
               .select(F.col("part").alias("o_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("offset")))
    pieces = blocks.mapInArrow(_pieces, "part int, number long, doc_id long, block int, start long, n_ids long, crc long")
    whole = pieces.groupBy("part", "number").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("first"), F.sum("n_ids").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n_ids", "crc"))).alias("pieces"))  # bounded by a document's blocks
    return (whole.join(offsets, F.col("part") == F.col("o_part"))
            .select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", _whole_crc("pieces").alias("ids_crc32")))
