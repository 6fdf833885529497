"""Helpers shared by the training-data operators.

Words are maximal runs of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``).  Python-side operators hash words straight from
UTF-8 bytes with numpy, a group of documents at a time, so no Python loop runs
over words; memory is bounded by the group size, or by one document where a
single document is larger.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WS_CHARS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_R = 0x9E3779B97F4A7C15 | 1  # base of the word polynomial, odd so that it has an inverse mod 2^64
_RINV = pow(_R, -1, 1 << 64)
_PIECE = 1 << 18

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str, folds: int = 5) -> Column:
    """True for rows whose crc32 of the id as text is divisible by ``folds`` (a null id counts as '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds == 0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


_POW: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, _PIECE + 1)
        for k, base in enumerate((_R, _RINV)):
            p = np.full(size, U64(base))
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=U64)
    return _POW[0], _POW[1]


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ws = np.empty(len(data) + 2, dtype=bool)
    ws[0] = ws[-1] = True
    ws[1:-1] = _WS[data]
    edge = np.flatnonzero(ws[1:] != ws[:-1])
    starts, ends = edge[0::2], edge[1::2]
    pw, inv = _powers(len(data) + 1)
    s = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * pw[: len(data)], out=s[1:])
    h = mix((s[ends] - s[starts]) * inv[starts] + (ends - starts).astype(U64))
    return starts, ends, h


def hash_words(data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and 64-bit hashes of the words of a UTF-8 byte array.

    Works through pieces of 256 KB cut at white space, so that the helper
    arrays stay small however long the text is.
    """
    if lower:
        data = _LOWER[data]
    if len(data) <= _PIECE:
        return _hash_piece(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data):  # move the cut to the next white space
            step = np.flatnonzero(_WS[data[end:end + 4096]])
            if len(step):
                end += int(step[0])
                break
            end = min(end + 4096, len(data))
        s, e, h = _hash_piece(data[at:end])
        out.append((s + at, e + at, h))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out))


def doc_words(text: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hash_words(np.frombuffer(text, dtype=np.uint8), lower)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ``k`` consecutive words, in order (empty when there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    g = np.zeros(n, U64)
    for j in range(k):
        g = mix(g * U64(3) + h[j:j + n] + U64(j + 1))
    return g


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingle hashes; with fewer words the whole sequence is one, without words none."""
    if len(h) == 0:
        return np.empty(0, U64)
    if len(h) < k:
        return gram_hashes(h, len(h)) ^ U64(len(h))
    return np.unique(gram_hashes(h, k))


def utf8_cells(col) -> list[bytes]:
    """The cells of an Arrow string column as bytes; null becomes empty."""
    import pyarrow as pa
    return [b if b is not None else b"" for b in col.cast(pa.binary()).to_pylist()]


def trim() -> None:
    """Give freed memory back to the system: idle Python workers share their executor's limit with the JVM."""
    import ctypes
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def slices(batch, rows: int = 2000):
    """A record batch in parts, so that only a part's cells are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
    trim()


def grouped(cells: list[bytes], most: int = 1 << 18):
    """Index ranges [a, b) of consecutive cells with about ``most`` bytes together, at least one cell each."""
    a = size = 0
    for i, c in enumerate(cells):
        if i > a and size + len(c) > most:
            yield a, i
            a, size = i, 0
        size += len(c) + 1
    if a < len(cells):
        yield a, len(cells)


def group_words(cells: list[bytes], lower: bool = False):
    """Words of several documents at once: document bounds into the word arrays, byte starts, ends, hashes, bytes.

    ``bounds[i]:bounds[i + 1]`` are the words of cell ``i``; byte positions are in the joined buffer returned last.
    """
    joined = b"\n".join(cells)
    data = np.frombuffer(joined, dtype=np.uint8)
    starts, ends, h = hash_words(data, lower)
    first = np.zeros(len(cells) + 1, np.int64)
    np.cumsum([len(c) + 1 for c in cells], out=first[1:])
    return np.searchsorted(starts, first), starts, ends, h, joined, first


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcasting if its rows take at most ``most`` bytes; beyond, the join shuffles as usual.

    ``df`` is a written table.  A row takes 40 bytes, each column 8 and the contents of its strings and arrays (8 bytes an
    element), which one aggregate sums.
    """
    size = F.lit(40 + 8 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            size = size + F.greatest(F.size(f.name), F.lit(0)) * 8
        elif f.dataType.typeName() in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long")).alias("bytes")).first().bytes or 0) <= most else df
