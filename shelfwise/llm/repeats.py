"""Which hashes of a corpus occur again: blocks of texts send packed hashes to hash ranges and get bits back.

Shared by the operators that compare parts of texts. A block sends each distinct hash once, with a count, so a hash
that a third of all texts hold is one entry a block. Nothing is gathered by the driver but the number of bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.kernels import lean_group

#: Bytes of text of a block, on average; one longer text is a block's part whole.
BLOCK_BYTES = 4 << 20

Hashes = Callable[[pa.ChunkedArray], Iterator[np.ndarray]]


def blocks(docs: DataFrame, doc_id: str, text: str, *more: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, doc, text, and columns `more`), and the number of blocks, which follows the bytes of text. Rows are dealt by a hash of both."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(n)).alias("block")
    return docs.select(block, F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), *more), n


def _bits(n_blocks: int) -> int:
    return max(n_blocks - 1, 1).bit_length()


def distinct(parts: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    parts = list(parts)
    return np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)


def shared(of_blocks: DataFrame, n_blocks: int, hashes: Hashes) -> DataFrame:
    """(block, bucket, n, data): for the block's distinct hashes in order, the level of each: the logarithm of its
    number of occurrences to base 2, rounded up, hence 0 if it occurs once.

    40 bits beyond the bucket's are compared, so about one unrepeated hash in a million is taken for repeated: callers
    compare content afterwards.
    """
    b = _bits(n_blocks)

    def send(group: pa.Table) -> pa.Table:
        u, count = distinct(hashes(group.column("text")))
        cuts = np.searchsorted(u >> np.uint64(64 - b), np.arange((1 << b) + 1).astype(np.uint64))
        value = ((u << np.uint64(b)) >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
        count = np.minimum(count, 255).astype(np.uint8)
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        data = [value[cuts[k] : cuts[k + 1]].tobytes() + count[cuts[k] : cuts[k + 1]].tobytes() for k in full]
        block = group.column("block")[0].as_py()
        return pa.table({"bucket": pa.array(full, pa.int32()), "block": pa.array([block] * len(full), pa.int64()), "data": pa.array(data, pa.binary())})

    def find(group: pa.Table) -> pa.Table:
        parts = group.column("data").to_pylist()
        sizes = [len(p) // 6 for p in parts]
        wide = np.zeros((sum(sizes), 8), dtype=np.uint8)
        count, at = np.zeros(sum(sizes), dtype=np.int64), 0
        for p, n in zip(parts, sizes, strict=True):
            wide[at : at + n, :5] = np.frombuffer(p, np.uint8, 5 * n).reshape(n, 5)
            count[at : at + n] = np.frombuffer(p, np.uint8, n, 5 * n)
            at += n
        value = wide.view(np.uint64).ravel()
        order = np.argsort(value, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], value[order][1:] != value[order][:-1]]))
        total = np.zeros(len(value), dtype=np.int64)
        total[order] = np.repeat(np.add.reduceat(count[order], new), np.diff([*new, len(value)]))
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        level = np.ceil(np.log2(total)).astype(np.uint8)
        data = [zstandard.compress(level[a:z].tobytes(), 1) for a, z in zip(cuts, cuts[1:], strict=False)]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "n": pa.array(sizes, pa.int32()), "data": pa.array(data, pa.binary())})

    sent = of_blocks.groupBy("block").applyInArrow(lean_group(send), "bucket int, block long, data binary")
    return sent.groupBy("bucket").applyInArrow(lean_group(find), "block long, bucket int, n int, data binary")


def read_levels(rows: pa.Table) -> np.ndarray:
    """Levels of the block's distinct hashes, in order."""
    parts = sorted(zip(rows.column("bucket").to_pylist(), rows.column("data").to_pylist(), strict=True))
    return np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(zstandard.decompress(data), np.uint8) for _, data in parts)])
