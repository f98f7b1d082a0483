"""Byte-level BPE encoding and decoding with the tiktoken library.

The merge ranks come from a local file. Texts longer than ``PIECE_CHARS`` are cut
at safe boundaries first: places where a match of the splitting pattern must end
whatever surrounds them, so that the pieces' ids, joined, are the text's ids.
Ids are stored as little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common

#: Longer texts are encoded piece by piece.
PIECE_CHARS = 1 << 16

#: White space after something else, or an ASCII sign after an ASCII letter or digit:
#: no match of the pattern holds both sides.
SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[0-9A-Za-z])(?=[!-/:-@\[-`{-~])")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=4)
def encoding(ranks_file: str | None = None, pattern: str | None = None):
    """The tiktoken encoding of a rank file, without special tokens; one a process."""
    import public_tokenizers
    import tiktoken

    with open(ranks_file or default_ranks(), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}
    return tiktoken.Encoding(
        "local", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in parts of ``size`` characters or a little more, cut at safe boundaries."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(text: str, encoder, size: int = PIECE_CHARS) -> np.ndarray:
    """Ids of one text."""
    if len(text) <= size:
        return np.array(encoder.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(encoder.encode_ordinary(p), dtype="<u4") for p in pieces(text, size)])


@lru_cache(maxsize=4)
def _token_bytes(ranks_file: str | None = None) -> list[bytes]:
    encoder = encoding(ranks_file)
    out = [b""] * (encoder.max_token_value + 1)
    for i in range(len(out)):
        try:
            out[i] = encoder.decode_single_token_bytes(i)
        except KeyError:  # an id that the file leaves out
            continue
    return out


def encode(
    df: DataFrame,
    text: str = "text",
    ranks_file: str | None = None,
    pattern: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds ``n_tokens`` (long) and ``token_ids`` (binary, little-endian 32-bit ids).

    A null or empty text has no tokens. Strings that look like special tokens are
    ordinary text. Repeated rows are encoded alike; input columns with the names
    of the new ones are replaced.
    """

    def make():
        encoder = encoding(ranks_file, pattern)

        def run(texts: common.Texts) -> list:
            ids = [encode_text(t, encoder) for t in texts.strings()]
            return [np.array([len(x) for x in ids], dtype=np.int64), pa.array([x.tobytes() for x in ids], pa.binary())]

        return run

    fields = [("n_tokens", T.LongType()), ("token_ids", T.BinaryType())]
    return common.with_text_columns(df, text, fields, make, keep)


def decode_ids(ids: bytes | None, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids or b"", dtype="<u4").tolist()])


def decode(df: DataFrame, ids: str = "token_ids", ranks_file: str | None = None) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the ids, which need not be whole UTF-8.

    A null value decodes to no bytes. Ids outside the vocabulary are an error.
    """
    rest = [c for c in df.columns if c.lower() != "decoded"]
    source = df.select(*[F.col(f"`{c}`") for c in rest])
    where = rest.index(ids)
    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_bytes(ranks_file)
        for batch in batches:
            column = batch.column(where)
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out = [decode_ids(v, tokens) for v in column.slice(start, 512).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*rest, "decoded"])

    return source.mapInArrow(run, schema)


def id_array(ids: str = "token_ids"):
    """Column: the ids of a binary value as an array of longs."""
    h = F.hex(F.col(ids))
    n = (F.octet_length(F.col(ids)) / 4).cast("int")
    byte = lambda i, k: F.substring(h, (i * 8 + 2 * k + 1).cast("int"), F.lit(2))
    at = lambda i: F.conv(F.concat(byte(i, 3), byte(i, 2), byte(i, 1), byte(i, 0)), 16, 10).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<bigint>"))


def round_trip(df: DataFrame, id_column: str = "doc_id", text: str = "text", ranks_file: str | None = None) -> DataFrame:
    """Digests of a text's ids and of the bytes they decode to, for each row.

    One pass encodes and decodes, so that a task needs one Python worker, not two.
    """

    def make():
        encoder, tokens = encoding(ranks_file), _token_bytes(ranks_file)

        def run(texts: common.Texts) -> list:
            ids = [encode_text(t, encoder) for t in texts.strings()]
            coded = [x.tobytes() for x in ids]
            decoded = [decode_ids(c, tokens) for c in coded]
            return [np.array([len(x) for x in ids], dtype=np.int64), pa.array(coded, pa.binary()), pa.array(decoded, pa.binary())]

        return run

    fields = [("n_tokens", T.LongType()), ("token_ids", T.BinaryType()), ("decoded", T.BinaryType())]
    coded = common.with_text_columns(df, text, fields, make, [id_column])
    return coded.select(
        id_column,
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
