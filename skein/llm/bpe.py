"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Pieces (matches of the split pattern) are encoded each on its own, so what a worker has met is looked up; new pieces of a
batch go to the library together.
Contract for odd inputs: null and empty texts give no ids; a text of any length is encoded whole; repeated rows
give equal values; extra columns don't matter, as only the named ones are read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, mapped, table

#: Entries of a worker's tables of segments and of pieces, and characters of the longest that are kept. A full table
#: becomes the old one, from which what is met again is taken over; this changes no result.
ENTRIES, LONGEST = 300_000, 200
#: Ids that are decoded at once.
DECODED = 1 << 20
#: Above this, characters may have been given a class by later Unicode versions than the tokenizer's own,
#: and the tokenizer's own splitter decides.
OLD_CHARACTERS = 0x530
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space other than blanks and line ends, which segments don't part at.
ODD_SPACES = "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next free one above 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair whose merge makes each token: what is left after all merges of lower rank."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class Table:
    """Ids of strings that a worker has met, in two generations."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that neither generation has; those of the old one are taken over."""
        if len(self.now) > ENTRIES:
            self.old, self.now = self.now, {}
        out = []
        for k in keys.difference(self.now):
            if k in self.old:
                self.now[k] = self.old[k]
            else:
                out.append(k)
        return out

    def forget(self, keys: Iterable[str]) -> None:
        for k in keys:
            if len(k) > LONGEST:
                self.now.pop(k, None)


class ByteBpe:
    """Encoder and decoder of one vocabulary file.

    A segment is white space (blanks, line ends) and what follows up to the next white space. The split pattern has no
    match with white space after another character, so segments are split and encoded each on its own, and those that
    come again are looked up. Texts with other white space or later characters are looked up by pieces."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        chars = byte_characters()
        shown = lambda token: "".join(chars[b] for b in token)
        self.tokenizer = Tokenizer(models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=[(shown(a), shown(b)) for a, b in merges_of(ranks)], ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.splitter = pre_tokenizers.Split(Regex(pattern), "isolated")
        own = pattern.replace("[^\\s", f"[^{SPACES}").replace("\\s", f"[{SPACES}]").replace("\\S", f"[^{SPACES}]")
        self.pieces_of = regex.compile(own).findall
        self.segments_of = re.compile("[ \\n]*[^ \\n]+|[ \\n]+").findall
        self.newer = re.compile(f"[{chr(OLD_CHARACTERS)}-\U0010ffff]").search
        self.odd = re.compile(ODD_SPACES).search
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lens = np.array([len(x) for x in tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.pieces, self.segments = Table(), Table()

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, in order; they cover the text."""
        if self.newer(text):
            return [piece for piece, _ in self.splitter.pre_tokenize_str(text)]
        return self.pieces_of(text)

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Encodes the pieces that are new, many in one call: the library says of which piece each id is."""
        new = self.pieces.missing(pieces)
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            e = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            ends = np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(part)), "right").tolist()
            start = 0
            for piece, end in zip(part, ends, strict=True):
                self.pieces.now[piece] = ids[start:end].tobytes()
                start = end

    def _learn_segments(self, segments: set[str]) -> None:
        new = self.segments.missing(segments)
        split = list(map(self.pieces_of, new))
        pieces = set(chain.from_iterable(split))
        self._learn_pieces(pieces)
        of = self.pieces.now.__getitem__
        self.segments.now.update(zip(new, (b"".join(map(of, x)) for x in split), strict=True))
        self.pieces.forget(pieces)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain = [x is not None and not self.newer(x) and not self.odd(x) for x in texts]
        parts = [self.segments_of(x) if p else self.split(x or "") for x, p in zip(texts, plain, strict=True)]
        segments = set(chain.from_iterable(x for x, p in zip(parts, plain, strict=True) if p))
        self._learn_segments(segments)
        pieces = set(chain.from_iterable(x for x, p in zip(parts, plain, strict=True) if not p))
        self._learn_pieces(pieces)
        segment, piece = self.segments.now.__getitem__, self.pieces.now.__getitem__
        out = [b"".join(map(segment if p else piece, x)) for x, p in zip(parts, plain, strict=True)]
        self.segments.forget(segments)
        self.pieces.forget(pieces)
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids. Ids may split a character: bytes are joined before any are read as UTF-8."""
        ids_ = np.frombuffer(ids, "<u4")
        out = []
        for k in range(0, len(ids_), DECODED):
            part = ids_[k : k + DECODED]
            lens = self.lens[part]
            ends = np.cumsum(lens)
            out.append(self.bytes[np.repeat(self.starts[part] - (ends - lens), lens) + np.arange(ends[-1])].tobytes())
        return b"".join(out)

    def decode_all(self, ids: list[bytes]) -> Iterator[bytes]:
        """The bytes of each row of ids."""
        for a, b in chunks(np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]), DECODED):
            joined = b"".join(ids[a:b])
            text = self.decode(joined)
            at = np.concatenate([[0], np.cumsum(self.lens[np.frombuffer(joined, "<u4")])])[np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids[a:b]])])].tolist()
            yield from (text[i:j] for i, j in zip(at[:-1], at[1:], strict=True))

    def decode_text(self, ids: bytes) -> str:
        """The text of any run of ids; bytes of a character that the run cuts show as U+FFFD."""
        return self.decode(ids).decode("utf-8", errors="replace")

    def offsets(self, text: str | None) -> np.ndarray:
        """Start and end, in characters of the text, of each id: all characters of which it holds a byte."""
        raw = (text or "").encode()
        lens = self.lens[np.frombuffer(self.encode(text), "<u4")]
        ends = np.cumsum(lens)
        if not len(ends):
            return np.zeros((0, 2), np.int64)
        char_of = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
        return np.stack([char_of[ends - lens], char_of[ends - 1] + 1], axis=1)


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per worker process."""
    return ByteBpe(path, pattern)


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and split pattern of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocab: tuple[str, str] | None = None, spans: bool = False) -> DataFrame:
    """doc_id, ids array<int>, and with spans also starts and ends array<int>: the characters of each id."""
    vocab = vocab or vocabulary()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(*vocab)
        texts = batch.column(1).to_pylist()
        cols = [batch.column(0), pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode_all(texts)], pa.list_(pa.int32()))]
        names = ["doc_id", "ids"]
        if spans:
            at = [bpe.offsets(t).astype(np.int32) for t in texts]
            cols += [pa.array([x[:, i] for x in at], pa.list_(pa.int32())) for i in (0, 1)]
            names += ["starts", "ends"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    return mapped(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), kernel, f"doc_id {kind}, ids array<int>" + ", starts array<int>, ends array<int>" * spans)


def decode_ids(encoded: DataFrame, vocab: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and text of rows with ids, which may begin or end within a character; null ids give the empty text."""
    vocab = vocab or vocabulary()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(*vocab)
        texts = [bpe.decode_text(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return mapped(encoded.select("doc_id", "ids"), kernel, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocab: tuple[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, the number of ids, and digests of the ids and of the bytes that they decode to."""
    vocab = vocab or vocabulary()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = byte_bpe(*vocab)
        ids = bpe.encode_all(batch.column(1).to_pylist())
        n = [len(x) // 4 for x in ids]
        ids_sha = [hashlib.sha256(x).hexdigest() for x in ids]
        text_sha = [hashlib.sha256(x).hexdigest() for x in bpe.decode_all(ids)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), kernel, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
