"""Media columns: texts kept losslessly as the coefficients of progressive JPEG images, and images as RGB tensors.

A byte b of a payload is the coefficient b - 128; quantisation is by 1, so the coefficients come back as they were.
Contract for odd inputs: null and empty texts are one unit of padding; a text of any length is stored whole; equal
texts have equal values; an empty table gives no rows; extra columns don't matter; in `tensors` a null or damaged
image, or one of another kind, has null height, width and rgb.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import jpeg
from .common import chunks, mapped, table, text_bytes

#: Payloads are padded to a multiple of this; coefficients in an MCU; MCUs in a row of a small image, and at most.
UNIT, MCU, ROW, MOST = 576, 384, 64, 4095
#: Bytes of texts that are coded side by side.
SIDE_BY_SIDE = 3 << 18


def payload(raw: np.ndarray) -> np.ndarray:
    n = max(1, -(-len(raw) // UNIT)) * UNIT
    out = np.full(n, 255, np.uint8)
    out[: len(raw)] = raw
    return out


def shape(n: int) -> tuple[int, int]:
    """Rows and columns of MCUs of an image that holds n coefficients."""
    mcus = -(-n // MCU)
    rows = -(-mcus // ROW)
    if rows > MOST:
        rows = MOST
    return rows, -(-mcus // rows)


def store(payloads: list[np.ndarray], lengths: list[int]) -> list[bytes]:
    """An image for each payload. Its comment holds the payload's size and the number of bytes before padding."""
    shapes = [shape(len(p)) for p in payloads]
    sizes = [r * c * MCU for r, c in shapes]
    coefs = np.zeros(sum(sizes), np.int16)
    at = 0
    for p, size in zip(payloads, sizes, strict=True):
        coefs[at : at + len(p)] = p.astype(np.int16) - 128
        at += size
    return jpeg.encode(coefs.reshape(-1, 64), shapes, [struct.pack(">QQ", len(p), n) for p, n in zip(payloads, lengths, strict=True)])


def load(files: list[bytes]) -> tuple[list[jpeg.Image], np.ndarray, list[np.ndarray], list[int]]:
    """Images, all coefficients, and what store() was given."""
    images = [jpeg.parse(f) for f in files]
    coefs = jpeg.coefficients(images)
    flat, payloads, lengths = coefs.reshape(-1), [], []
    for img in images:
        n, length = struct.unpack(">QQ", img.comments[0])
        payloads.append((flat[img.base[0] : img.base[0] + n] + 128).astype(np.uint8))
        lengths.append(length)
    return images, coefs, payloads, lengths


def feature(rgb: np.ndarray) -> str:
    """Height, width and the mean of each colour in thousandths."""
    means = rgb.reshape(rgb.shape[0], -1).sum(axis=0, dtype=np.int64).reshape(-1, 3).sum(axis=0) * 1000 // (rgb.shape[0] * rgb.shape[1])
    return f"{rgb.shape[0]}x{rgb.shape[1]}:" + ",".join(map(str, means.tolist()))


def _texts(column: pa.Array):
    buf, offs = text_bytes(column)
    for a, b in chunks(offs, SIDE_BY_SIDE):
        raw = [buf[offs[i] : offs[i + 1]] for i in range(a, b)]
        yield a, b, store([payload(x) for x in raw], [len(x) for x in raw])


def stored_texts(docs: DataFrame) -> DataFrame:
    """doc_id and media, the text as an image file."""

    def kernel(batch: pa.RecordBatch):
        for a, b, files in _texts(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(files, pa.binary())], names=["doc_id", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), kernel, f"doc_id {kind}, media binary")


def tensors(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """key, height, width and rgb (rows of pixels of three bytes) of progressive images."""

    def one(raw: bytes | None):
        try:
            img = jpeg.parse(raw or b"")
            rgb = jpeg.pixels(img, jpeg.samples([img], jpeg.coefficients([img])))
            return rgb.shape[0], rgb.shape[1], rgb.tobytes()
        except (ValueError, IndexError, KeyError, TypeError, struct.error):
            return None, None, None

    def kernel(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            h, w, rgb = one(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], pa.array([h], pa.int32()), pa.array([w], pa.int32()), pa.array([rgb], pa.binary())], names=["id", "height", "width", "rgb"])

    kind = media.schema[key].dataType.simpleString()
    return mapped(media.select(media[key].alias("id"), media[column].alias("media")), kernel, f"id {kind}, height int, width int, rgb binary")


def media_digests(docs: DataFrame) -> DataFrame:
    def kernel(batch: pa.RecordBatch):
        for a, b, files in _texts(batch.column(1)):
            images, coefs, payloads, lengths = load(files)
            raw, blocks = [p.tobytes() for p in payloads], jpeg.samples(images, coefs)
            cols = [
                pa.array(lengths, pa.int64()),
                pa.array([len(x) for x in raw], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                pa.array([zlib.crc32(x[-32:]) for x in raw], pa.int64()),
                pa.array([len(f) for f in files], pa.int64()),
                pa.array([hashlib.sha256(f).hexdigest() for f in files]),
                pa.array([feature(jpeg.pixels(img, blocks)) for img in images]),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *cols], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), kernel, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows=1024)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(table(spark, sf_dir, "documents"))
