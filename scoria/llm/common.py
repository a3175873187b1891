"""Small helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps every byte outside [0-9a-z] and 0x80-0xFF to a space and A-Z to a-z:
#: ``text.translate(ALNUM).split()`` are the lower-cased words
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a UTF-8 text.
ALNUM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which the cluster sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc_mod5(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5 (null id: as the empty text)."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if b is None else b for b in column.cast(pa.binary()).to_pylist()]


def pack(a: np.ndarray) -> bytes:
    """Compress an integer array: byte planes, then zstandard."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=0), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)
