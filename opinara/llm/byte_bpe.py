"""Byte-level BPE encoding and decoding with a local rank file.

The tokenizer is the tiktoken library's, loaded in each task from a rank file and a split pattern; a
path names the file on every executor. A text longer than ``LONG`` characters is cut first and its
pieces are encoded one after the other, so that the matches held at a time are those of one piece.
Cuts stand only where the pattern ends a match whatever follows and begins anew whatever came before:
between a character that is no white space and a blank or line feed, and between letters and digits
or marks of fixed alphabets. Ids of a cut text are therefore the ids of the whole one. A stretch
without such a place stays in one piece.

Decoding joins the raw bytes of the ids; an id's bytes need not be whole characters, so the result is
binary. Nothing is shuffled, and rows are independent.

Defined results: null text is the empty text, which has no ids and decodes to no bytes; a string of
a special token is ordinary text; rows may repeat; an empty table gives no rows; other columns pass
through unchanged, but for one named like the result, which is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

LONG = 1 << 16
BATCH_SIZE = 1 << 22

# Letters, digits and marks of alphabets whose classes are the same in every version of Unicode.
_LETTER = r"A-Za-zΑ-ΡА-я一-龥ぁ-ゖァ-ヺ가-힣"
_DIGIT = r"0-9"
_MARK = r"!-/:-@\[-`{-~、。，"
SAFE_CUT = regex.compile(
    rf"(?<=\S)(?=[ \n])|(?<=[{_LETTER}])(?=[{_DIGIT}{_MARK}])|(?<=[{_DIGIT}])(?=[{_LETTER}{_MARK}])"
)


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str, pattern: str):
    """The encoding of a rank file (base64 bytes and rank a line), without special tokens."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = LONG) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters that end at safe places."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding, text: str, size: int = LONG) -> np.ndarray:
    if len(text) <= size:
        return encoding.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([encoding.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, size)])


def _added(df: DataFrame, name: str, kind) -> StructType:
    kept = [f for f in df.schema.fields if f.name != name]
    return StructType([*kept, StructField(name, kind)])


def _parts(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of a bounded number of values in ``column``."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    sizes = pc.fill_null(length(values), 0).to_numpy().astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def encoded(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", size: int = LONG
) -> DataFrame:
    """``docs`` with ``ids array<int>``, the token ids of the text."""
    schema = _added(docs, ids, ArrayType(IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(ranks_path, pattern)
        for whole in batches:
            place = [i for i, n in enumerate(whole.schema.names) if n != ids]
            at = whole.schema.names.index(text)
            for batch in _parts(whole, text, BATCH_SIZE):
                found = [encode_text(encoding, t or "", size) for t in batch.column(at).to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = np.concatenate([*found, np.zeros(0, np.uint32)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                columns = [batch.column(i) for i in place] + [lists]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def decoded(
    frame: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", name: str = "bytes"
) -> DataFrame:
    """``frame`` with ``name binary``, the joined bytes of ``ids``; null ids give no bytes."""
    schema = _added(frame, name, BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = tokenizer(ranks_path, pattern).decode_bytes
        for whole in batches:
            place = [i for i, n in enumerate(whole.schema.names) if n != name]
            at = whole.schema.names.index(ids)
            for batch in _parts(whole, ids, BATCH_SIZE):
                texts = [join(v.values.to_numpy()) if v.is_valid else b"" for v in batch.column(at)]
                columns = [batch.column(i) for i in place] + [pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return frame.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids as text and of what they decode to."""
    ids = encoded(docs.select("doc_id", "text"), ranks_path, pattern).drop("text")
    return decoded(ids, ranks_path, pattern).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
