"""Token ids as wavelet matrices (operator 10).

``write`` encodes the texts with the tokenizers library, appends an end id to each
document, orders documents by id and stores their ids in shards.  A shard is one
*wavelet matrix*: for every bit of the ids, from the highest, a bit-plane of the
sequence so far, which is then parted by that bit, zeros first and in
order.  Each plane comes with the number of its zeros and cumulative counts of
ones per block of ``BLOCK`` bits, so that ``rank`` reads one sample and one block.
Access, counting and the lookup of occurrences need the planes only, no decoding.

File format: a Parquet folder, one file per task, one row per shard with the
columns of ``SHARD``: its place (``part``, ``seq``), its documents (ids and lengths),
``width`` bit-planes (packed, little bit order), zeros and rank samples.  Columns
are zstd-compressed; a reader that only wants documents never reads the planes.

Scale: the texts are range-partitioned by document id once (ties by a hash of the text, so
that one id with many rows splits too); each task streams its sorted rows and
closes a shard when the next document would exceed ``SHARD_TOKENS``.  A task
holds one shard, whatever the table's size; a document longer than that is a shard of
its own.  Global positions are prefix sums over the tasks' totals (one row per file)
and over the shards of each task.

Defined results: ids are the library's for ``encode(text, add_special_tokens=False)``, added
tokens in the text included; a null or empty text has only the end id; a null document id sorts
first; rows that repeat an id follow each other in the order of a hash of their text;
an empty table writes no shard and reads back empty; columns other than id and text
do not matter.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .common import BoundedCache, as_text, slices

SHARD_TOKENS = 1 << 20
#: Bits per rank sample.
BLOCK = 512
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 700_000

SHARD = ("part int, seq int, n_tokens long, width int, doc_ids array<long>, doc_lengths array<long>, "
         "planes array<binary>, zeros array<long>, samples array<binary>")

_ASCII_BLANK = re.compile(r"[\x20\x09-\x0d]+")
#: Texts of these characters are split, lower-cased and normalised alike by
#: Python and by the tokenizer: no combining marks, no case that changes length.
_PLAIN = re.compile(r"[\x20-\x7e\x09-\x0d\xa1-\xac\xae-\xff]*")
#: Fixed value: the tokenizer's own split pattern, its classes spelled out for such characters.
_PIECE = re.compile(r"[a-zªµºß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9²³¹¼½¾]|[^\x20\x09-\x0da-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


class IdEncoder:
    """Ids of texts.  The tokenizer works on pieces between its own split points, so a
    plain text's pieces are looked up one by one and only new ones reach the library's model,
    which needs no second normalising and splitting of them; anything else goes to the whole
    tokenizer in stretches between ASCII blanks, which it drops.

    With ``added`` the ids are those of the tokenizer as it is, in which an added token's
    content is one id: texts that hold one go to the library whole.  Without it, such
    contents are ordinary text."""

    def __init__(self, spec: str, limit: int = REMEMBERED, added: bool = False):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = not added
        self.contents = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        #: What all contents begin with, up to a letter; texts without it hold none.
        self.mark = re.match(r"[!-@\[-`{-~]*", os.path.commonprefix(self.contents))[0]
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        #: The byte-level form of plain characters beyond ASCII.
        self.forms = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xa1, 0x100)}
        self.known = BoundedCache(self.piece_ids, limit)

    def has_added(self, text: str) -> bool:
        return bool(self.contents) and self.mark in text and any(c in text.lower() for c in self.contents)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _PIECE.findall(text.lower())
        out: list[str] = []
        for stretch in _ASCII_BLANK.split(text):
            if _PLAIN.fullmatch(stretch):
                out += _PIECE.findall(stretch.lower())
            else:
                out.append(stretch)
        return out

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a piece, or of a stretch that is not plain."""
        if not piece.isascii():
            if not _PLAIN.fullmatch(piece):
                return array("I", self.library([piece])[0]).tobytes()
            piece = piece.translate(self.forms)
        elif not piece.isprintable():
            return array("I", self.library([piece])[0]).tobytes()
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [i for i, t in enumerate(texts) if self.has_added(t)]
        if whole:
            skip = set(whole)
            out = self.remembered(["" if i in skip else t for i, t in enumerate(texts)])
            for i, ids in zip(whole, self.library([texts[i] for i in whole])):
                out[i] = np.array(ids, dtype="<u4")
            return out
        return self.remembered(texts)

    def remembered(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pieces(t) for t in texts]
        odd = {p for t, ps in zip(texts, split) if not t.isascii() for p in ps if not _PLAIN.fullmatch(p)}
        new = [p for p in odd if p not in self.known]
        if len(self.known) + len(new) > self.known.limit:
            self.known.clear()
        for piece, ids in zip(new, self.library(new) if new else ()):
            self.known[piece] = array("I", ids).tobytes()
        return [np.frombuffer(b"".join(map(self.known.__getitem__, ps)), dtype="<u4") for ps in split]


_ENCODERS: dict = {}


def id_encoder(spec: str) -> IdEncoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = IdEncoder(spec, added=True)
    return _ENCODERS[key]


class WaveletMatrix:
    """One shard's ids: access, rank, select and decoding on packed bit-planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], samples: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.samples = n, planes, zeros, samples

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        planes, zeros, samples = [], [], []
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for level in range(width - 1, -1, -1):
            bit = (now >> level) & 1 != 0
            planes.append(np.packbits(bit, bitorder="little"))
            samples.append(sample_ranks(planes[-1]))
            now, n_zeros = parted(now, bit)
            zeros.append(n_zeros)
        return cls(len(ids), planes, zeros, samples)

    @property
    def width(self) -> int:
        return len(self.planes)

    def bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partings from the lowest plane up."""
        now = np.zeros(self.n, dtype=np.uint32)
        for level in range(self.width - 1, -1, -1):
            bit, before = self.bits(level), now
            now = np.empty_like(before)
            now[~bit] = before[:self.zeros[level]]
            now[bit] = before[self.zeros[level]:] | np.uint32(1 << (self.width - 1 - level))
        return now

    def ones_before(self, level: int, i: int) -> int:
        """Number of ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8:(i + 7) // 8]
        return int(self.samples[level][block]) + int(
            np.unpackbits(part, count=i - block * BLOCK, bitorder="little").sum())

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for level in range(self.width):
            ones = self.ones_before(level, i)
            bit = self.planes[level][i // 8] >> (i % 8) & 1
            value = value << 1 | int(bit)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def interval(self, token: int, start: int = 0, stop: int | None = None) -> tuple[int, int]:
        """Where the occurrences of ``token`` in ``[start, stop)`` end up after all partings."""
        stop = self.n if stop is None else stop
        if token >> self.width:
            return 0, 0
        for level in range(self.width):
            a, b = self.ones_before(level, start), self.ones_before(level, stop)
            if token >> (self.width - 1 - level) & 1:
                start, stop = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        a, b = self.interval(token, start, stop)
        return b - a

    def bit_place(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of that value in a plane."""
        ends = np.append(self.samples[level].astype(np.int64)[1:], -1)
        sizes = np.minimum(np.arange(1, len(ends) + 1) * BLOCK, self.n)
        ends[-1] = self.n - self.zeros[level]
        before = ends if bit else sizes - ends
        block = int(np.searchsorted(before, k, side="right"))
        done = int(before[block - 1]) if block else 0
        lo = block * BLOCK
        part = np.unpackbits(self.planes[level][lo // 8:(lo + BLOCK) // 8],
                             count=min(BLOCK, self.n - lo), bitorder="little")
        return lo + int(np.flatnonzero(part == bit)[k - done])

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``."""
        a, b = self.interval(token)
        if not 0 <= k < b - a:
            raise IndexError(f"token {token} occurs {b - a} times")
        i = a + k
        for level in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - level) & 1
            i = self.bit_place(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of ``token``, ascending."""
        a, b = self.interval(token)
        at = np.arange(a, b)
        for level in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - level) & 1
            if len(at):
                places = np.flatnonzero(self.bits(level) == bool(bit))
                at = places[at - self.zeros[level] if bit else at]
        return at


def parted(values: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, int]:
    """``values`` without a one in ``bit``, then those with one, and the number of the former."""
    rest, ones = np.flatnonzero(~bit), np.flatnonzero(bit)
    out = np.empty_like(values)
    # Places are in range; clipping spares the copy that numpy makes of ``out`` in case they are not.
    values.take(rest, out=out[:len(rest)], mode="clip")
    values.take(ones, out=out[len(rest):], mode="clip")
    return out, len(rest)


def sample_ranks(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a packed plane."""
    step = BLOCK // 8
    blocks = -(-len(plane) // step) or 1
    padded = np.zeros(blocks * step, dtype=np.uint8)
    padded[:len(plane)] = plane
    ones = np.bitwise_count(padded).reshape(blocks, step).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)


def matrix_of(row: dict) -> WaveletMatrix:
    """The matrix of one stored shard."""
    return WaveletMatrix(row["n_tokens"], [np.frombuffer(p, np.uint8) for p in row["planes"]], row["zeros"],
                         [np.frombuffer(s, np.uint32) for s in row["samples"]])


def _shard_batch(part: int, seq: int, docs: list[tuple[int | None, np.ndarray]], width: int) -> pa.RecordBatch:
    ids = np.concatenate([i for _, i in docs])
    m = WaveletMatrix.build(ids, width)
    row = {"part": [part], "seq": [seq], "n_tokens": [m.n], "width": [width],
           "doc_ids": [[d for d, _ in docs]], "doc_lengths": [[len(i) for _, i in docs]],
           "planes": [[p.tobytes() for p in m.planes]], "zeros": [m.zeros],
           "samples": [[s.tobytes() for s in m.samples]]}
    kinds = {"part": pa.int32(), "seq": pa.int32(), "n_tokens": pa.int64(), "width": pa.int32(),
             "doc_ids": pa.list_(pa.int64()), "doc_lengths": pa.list_(pa.int64()),
             "planes": pa.list_(pa.binary()), "zeros": pa.list_(pa.int64()), "samples": pa.list_(pa.binary())}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in row.items()], names=list(row))


def write(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``text_col`` and store the ids of all documents, by ``id_col``, under ``path``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    width = max(1, max(Tokenizer.from_str(spec).get_vocab().values()).bit_length(), end_id.bit_length())
    held = df.sparkSession.sparkContext.broadcast(spec)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = id_encoder(held.value), TaskContext.get().partitionId()
        seq, size, docs = 0, 0, []
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                rows = batch.slice(s, 256)
                keys = rows.column(0).to_pylist()
                for key, ids in zip(keys, encoder.encode(rows.column(1).to_pylist())):
                    ids = np.append(ids, np.uint32(end_id))
                    if docs and size + len(ids) > shard_tokens:
                        yield _shard_batch(part, seq, docs, width)
                        seq, size, docs = seq + 1, 0, []
                    docs.append((key, ids))
                    size += len(ids)
        if docs:
            yield _shard_batch(part, seq, docs, width)

    rows = df.select(F.col(id_col).cast("long").alias("id"), as_text(F.col(text_col)).alias("text"))
    tie = F.xxhash64("text")
    (rows.repartitionByRange(F.col("id"), tie).sortWithinPartitions(F.col("id"), tie)
     .mapInArrow(shards, SHARD).write.option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part, seq, shard_start``: the ids before each shard.  Totals per task come
    first, so the only window over all rows has one row per file."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("own"))
    return own.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("own")).alias("shard_start"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(pa.StructArray.from_arrays(batch.columns, names=batch.schema.names), 1):
            row = part[0].as_py()
            ids = matrix_of(row).decode().astype("<u4")
            lengths = np.array(row["doc_lengths"], dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            crcs = [zlib.crc32(ids[a:a + n]) for a, n in zip(starts, lengths)]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())],
                names=["part", "seq", "doc_id", "own_start", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and the CRC-32 of its ids as little-endian 32-bit integers."""
    shards = read_shards(spark, path)
    rows = shards.mapInArrow(_documents, "part int, seq int, doc_id long, own_start long, n_tokens long, ids_crc32 long")
    starts = shard_starts(shards.select("part", "seq", "n_tokens"))
    return (rows.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("shard_start") + F.col("own_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_counts(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``part, seq, n``: how often each shard holds ``token``, by two ranks per plane."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r.as_py() for r in pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)):
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]], pa.int32()),
                                                  "seq": pa.array([row["seq"]], pa.int32()),
                                                  "n": pa.array([matrix_of(row).count(token)], pa.int64())})

    return read_shards(spark, path).mapInArrow(counts, "part int, seq int, n long")


def token_positions(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``position``: every place of ``token`` in the whole sequence of ids."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r.as_py() for r in pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)):
                at = matrix_of(row).occurrences(token)
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]] * len(at), pa.int32()),
                                                  "seq": pa.array([row["seq"]] * len(at), pa.int32()),
                                                  "own": pa.array(at, pa.int64())})

    shards = read_shards(spark, path)
    rows = shards.mapInArrow(places, "part int, seq int, own long")
    return (rows.join(shard_starts(shards.select("part", "seq", "n_tokens")), ["part", "seq"])
            .select((F.col("shard_start") + F.col("own")).alias("position")))
