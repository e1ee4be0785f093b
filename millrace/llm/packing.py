"""Packing of documents into training sequences by power-of-two pieces.

A document of ``n`` ids is cut into as many pieces of the full sequence length
as fit, and the rest into the powers of two of its binary form, the largest
first. Each piece fills a sequence of exactly its own length, so there is no
padding and no sequence holds ids of two documents. Pieces of one length form a
bucket; batches are taken from one bucket at a time.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer


SEQUENCE = 2048
END_ID = 1

# Fixed values of the tokenizer file: its one special token.
SPECIAL = {"<|endoftext|>": 50256}

#: Texts of characters below this one go through the faster of two libraries
#: with the same vocabulary; their splitting rules agree there.
PLAIN_BELOW = "Ͱ"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
    return tiktoken.Encoding(
        "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


def token_ids(text: str, path: str, ranks_path: str) -> np.ndarray:
    """The ids of ``text``, equal to those of the tokenizer file at ``path``.

    Texts of other scripts, and those with runs of white space beyond the
    stack of the fast library, are done by the slower one.
    """
    if max(text, default="") < PLAIN_BELOW:
        try:
            return _ranks(ranks_path).encode_to_numpy(
                text, allowed_special="all", disallowed_special=()
            )
        except ValueError:
            pass
    return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Lengths that add up to ``n``: full ones, then falling powers of two."""
    full, rest = divmod(n, longest)
    return [longest] * full + [
        1 << bit for bit in reversed(range(longest.bit_length())) if rest >> bit & 1
    ]


def pack(
    docs: DataFrame,
    *,
    longest: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = True,
    tokenizer: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; each piece is a sequence.

    * ``longest`` is a power of two. A null or empty text has the end id alone.
    * Equal or null document ids are no trouble: each row is packed by itself.
    * An empty table gives no rows. Other columns are not read.
    * ``with_ids`` adds the ids of the piece.

    There is no shuffle. ``sequence_id`` is the place of the piece in the
    partitions of the scan.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError(f"not a power of two: {longest}")
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, sums, totals, ids_of = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(token_ids(text or "", path, ranks_path), end_id).astype("<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    piece = ids[start : start + length]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
                    if with_ids:
                        ids_of.append(piece.astype(np.int32))
                    start += length
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            if with_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select("doc_id", "text").mapInArrow(
        run, schema + ", ids array<int>" * with_ids
    )
    return pieces.withColumns(
        {
            "sequence_id": F.monotonically_increasing_id(),
            "offset": F.lit(0).cast("long"),
        }
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences with their ids, a folder for each length."""
    packed.write.partitionBy("length").parquet(path)


