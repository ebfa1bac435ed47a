"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut before they are encoded, at places that no match of the split pattern can cross: between a character that is
certainly no white space and a blank, tab or line break. Tokens of the parts, one after the other, are the tokens of the text.
Ids are kept as bytes, unsigned 32-bit little-endian, and decode to raw bytes, which need not be valid text on their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotlift.llm.shared import without


@dataclass(frozen=True)
class Vocabulary:
    """``ranks`` is a file that every executor has at the same place; ``part`` the characters after which a long text is cut."""

    ranks: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    part: int = 1 << 16

    def encoding(self):
        """The encoding, built once in a worker process."""
        import base64

        import tiktoken
        from tiktoken import registry

        name = f"spotlift {self.ranks} {self.pattern}"
        if name not in registry.ENCODINGS:
            with open(self.ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            registry.ENCODINGS[name] = tiktoken.Encoding(name, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return registry.ENCODINGS[name]


def parts(text: str, size: int) -> Iterator[str]:
    """``text`` in parts of ``size`` characters or somewhat more, cut where tokens cannot cross."""
    safe = re.compile(r"(?<=[!-~\w])(?=[ \t\n\r])")
    low = 0
    while len(text) - low > size:
        cut = safe.search(text, low + size)
        if cut is None or cut.start() >= len(text):
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:]


def _encode(vocabulary: Vocabulary, most: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary.encoding()
        for batch in batches:
            texts = batch.column("text")
            low, size, counts, ids = 0, 0, [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                found = [encoding.encode_ordinary(part) for part in parts(text, vocabulary.part)]
                counts.append(sum(map(len, found)))
                ids.append(np.concatenate([np.array(f, "<u4") for f in found]).tobytes())
                size += len(text)
                if size >= most or i == batch.num_rows - 1:
                    row = batch.column("row").slice(low, len(counts))
                    yield pa.RecordBatch.from_arrays(
                        [row, pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["row", "n_tokens", "ids"]
                    )
                    low, size, counts, ids = i + 1, 0, [], []

    return run


def _decode(vocabulary: Vocabulary, most: int = 1 << 22):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary.encoding()
        for batch in batches:
            low, size, decoded = 0, 0, []
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].as_py() or b""
                decoded.append(encoding.decode_bytes(np.frombuffer(ids, "<u4").tolist()))
                size += len(ids)
                if size >= most or i == batch.num_rows - 1:
                    rows = batch.slice(low, len(decoded))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("row"), rows.column("n_tokens"), rows.column("ids"), pa.array(decoded, pa.binary())],
                        ["row", "n_tokens", "ids", "decoded"],
                    )
                    low, size, decoded = i + 1, 0, []

    return run


def _packed(df: DataFrame, names: list[str]) -> Column:
    """Columns ``names`` under numbered names in one struct, so that no name can clash."""
    return F.struct(*[df[n].alias(f"c{i}") for i, n in enumerate(names)]).alias("row")


def encoded(docs: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens`` and ``ids``; a null text counts as the empty one, which has no tokens.

    Columns of these two names in ``docs`` give way.
    """
    kept = without(docs, ["text", "n_tokens", "ids"])
    names = kept.columns
    rows = docs.select(_packed(docs, names), F.col("text").cast("string").alias("text"))
    layout = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, ids binary"
    flat = rows.mapInArrow(_encode(vocabulary), layout)
    return flat.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)], "n_tokens", "ids")


def decoded(tokens: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that its ``ids`` stand for."""
    names = [n for n in tokens.columns if n not in ("n_tokens", "ids", "decoded")]
    rows = tokens.select(_packed(tokens, names), "n_tokens", "ids")
    layout = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary"
    flat = rows.mapInArrow(_decode(vocabulary), layout)
    return flat.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)], "n_tokens", "ids", "decoded")


def encoded_and_decoded(docs: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """``decoded(encoded(docs))`` by one Python worker for each task instead of two that run side by side."""
    kept = without(docs, ["text", "n_tokens", "ids", "decoded"])
    names = kept.columns
    rows = docs.select(_packed(docs, names), F.col("text").cast("string").alias("text"))
    layout = f"row {rows.schema['row'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary"
    encode, decode = _encode(vocabulary), _decode(vocabulary)
    flat = rows.mapInArrow(lambda batches: decode(encode(batches)), layout)
    return flat.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)], "n_tokens", "ids", "decoded")


def round_trip(docs: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    return encoded_and_decoded(docs.select("doc_id", "text"), vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
