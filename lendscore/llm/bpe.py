"""Byte-level BPE encoding and decoding with tiktoken (operator 8).

``encode`` adds the token ids of a text, ``decode`` turns ids back into raw
bytes.  Both are Arrow UDFs over Spark's own partitions: no shuffle, every other
column passes through, and a lost executor only repeats its own tasks.

Texts longer than ``LONG`` characters are cut first, at *safe boundaries*:
positions that every match of the split pattern respects, so that the
pieces give the same ids as the whole text.  A boundary is safe where a
character that is not white space meets white space, or where a letter meets
a digit (in either order): no alternative of the pattern crosses such a place,
and none looks back.  Long runs of white space, which overflow the library's
regex stack, are matched here by the same rule (all but the last character of
a run before other text are one match).

Defined results: a null text encodes like an empty one, to an empty list;
null ids decode to empty bytes; repeated rows and ties need no rule,
as each row stands alone; an existing column of the output's name is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, list_array, slices, temp_name

#: Characters from which a text is cut before encoding, and the length of a cut.
LONG, CUT = 65_536, 32_768
#: Runs of white space from this length are matched here and not by the library.
BLANK_RUN = 4_096

_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
_BLANKS = regex.compile(r"\s{%d,}" % BLANK_RUN)
_ENCODERS: dict[tuple, tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    """The rank file (bounded: one line per vocabulary entry)."""
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """One encoder per worker process and rank file."""
    key = (hash(ranks), len(ranks), pattern)
    if key not in _ENCODERS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table,
                                           special_tokens={})
    return _ENCODERS[key]


def cut_safely(text: str, size: int = CUT) -> Iterator[str]:
    """Pieces of about ``size`` characters (more where no safe boundary is near)."""
    start = 0
    while len(text) - start > size:
        m = _SAFE.search(text, start + size)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text of any length."""
    if len(text) < BLANK_RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in _BLANKS.finditer(text):
        # The run's last character belongs to what follows it, if anything does.
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in cut_safely(text[start:run.start()]):
            ids += enc.encode_ordinary(piece)
        ids += enc._encode_single_piece(text[run.start():end])
        start = end
    for piece in cut_safely(text[start:]):
        ids += enc.encode_ordinary(piece)
    return ids


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           out_col: str = "token_ids") -> DataFrame:
    """``df`` with ``out_col``: the ids of ``text_col`` as ``array<int>``."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(ranks.value, pattern)
        for batch in batches:
            done = [list_array([np.array(encode_text(enc, t), dtype=np.int32)
                                for t in part.to_pylist()], np.int32, pa.int32())
                    for part in slices(batch)]
            yield pa.concat_arrays(done) if done else list_array([], np.int32, pa.int32())

    return df.withColumn(out_col, ids_of(as_text(F.col(text_col))))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids",
           out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the raw bytes that the ids stand for.

    An id outside the rank file fails the job.
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.arrow_udf(T.BinaryType())
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(ranks.value, pattern)
        for batch in batches:
            yield pa.array([enc.decode_bytes(ids) if ids else b""
                            for part in slices(batch) for ids in part.to_pylist()], type=pa.binary())

    return df.withColumn(out_col, bytes_of(F.col(ids_col)))


def checked_round_trip(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                       ids_col: str = "token_ids") -> DataFrame:
    """``df`` after decoding ``ids_col``; fails where the bytes are not the text's."""
    raw = temp_name(df, "decoded")
    out = decode(df, ranks_path, pattern, ids_col, raw)
    same = F.col(raw) == as_text(F.col(text_col)).cast("binary")
    return out.withColumn(ids_col, F.when(same, F.col(ids_col)).otherwise(
        F.raise_error(F.lit("token ids do not decode to their text")).cast(
            df.schema[ids_col].dataType))).drop(raw)
