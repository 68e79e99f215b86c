"""Byte-level BPE with sentencepiece.

A rank vocabulary (one base64 token and its rank a line) is serialised as a sentencepiece BPE
model, without training: each byte is mapped to one visible character, a token's piece is the
characters of its bytes, its score the negative rank, so that sentencepiece merges in order of
rank; normalisation is the identity, with no dummy prefix and no white-space escapes. Piece
numbers are ranks; the unknown piece that the format asks for comes last.

A text is cut into pre-tokens by the tokenizer's pattern. A pre-token that is a token itself is
that token; others are encoded by the model, all new ones of a group of texts in one call. Each
task keeps what it has encoded; beyond CACHE pre-tokens or
CACHE_CHARS characters it starts afresh, and pre-tokens of over KEPT characters are not kept. Decoding joins the bytes
of the ids.

The vocabulary file is read where the tasks run (``path``: the same place on every machine).

Defined cases: a null or empty text has no tokens and decodes to nothing; repeated rows, ties and
other columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.common import Kept, map_texts

#: Pre-tokens that a task keeps, their characters, and those of one of them, at most.
CACHE, CACHE_CHARS, KEPT, GROUP = 300_000, 8_000_000, 4096, 128


def byte_characters() -> list[str]:
    """A visible character for each byte: itself if printable Latin-1, else from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank; the ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, f)))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not 0 to {len(pairs) - 1}")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(tokens: Sequence[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece ModelProto."""
    shown = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, "".join(shown[b] for b in t).encode()) + _field(2, float(-rank)) + _field(3, normal)
              for rank, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    none = (1 << 64) - 1  # -1 as a varint: no such piece
    trainer = b"".join([_field(3, bpe), _field(4, len(pieces)), _field(40, len(tokens)), _field(41, none), _field(42, none), _field(43, none)])
    normalizer = b"".join([_field(1, b"identity"), _field(3, 0), _field(4, 0), _field(5, 0)])
    return b"".join([*(_field(1, p) for p in pieces), _field(2, trainer), _field(3, normalizer)])


class ByteBpe:
    def __init__(self, tokens: Sequence[bytes], pattern: str):
        self.tokens = list(tokens)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.find = regex.compile(pattern).findall
        self.shown = str.maketrans({b: c for b, c in enumerate(byte_characters())})
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.cache: dict[str, tuple[int, ...]] = {}
        self.size = 0  # its characters

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        """The ids of each text; what no text before had is encoded in one call for all."""
        cut = [self.find(t) for t in texts]
        every = set().union(*cut)
        long = {p for p in every if len(p) > KEPT}
        new = every.difference(self.cache, long)
        self.size += sum(map(len, new))
        if self.size > CACHE_CHARS or len(self.cache) + len(new) > CACHE:
            self.cache, new = {}, every - long
            self.size = sum(map(len, new))
        self.cache.update(self._encoded(new | long))
        out = [list(chain.from_iterable(map(self.cache.__getitem__, parts))) for parts in cut]
        for p in long:
            del self.cache[p]
        return out

    def _encoded(self, parts: set[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        whole = {p: rank for p in parts if (rank := self.rank.get(p.encode())) is not None}
        yield from ((p, (rank,)) for p, rank in whole.items())
        merged = [p for p in parts if p not in whole]
        shown = [p.encode().decode("latin-1").translate(self.shown) for p in merged]
        yield from zip(merged, map(tuple, self.model.encode(shown, num_threads=1)), strict=True)

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) and token_ids."""
    def make() -> Callable:
        c = coder(path, pattern)
        return lambda rows: [(ids,) for ids in c.encode([t or "" for t, in rows])]
    source = Kept(text) if keep is None else docs[text]
    return map_texts(docs, [source], [T.StructField("token_ids", T.ArrayType(T.IntegerType()))], make, keep, group=GROUP)


def decode_texts(rows: DataFrame, path: str, pattern: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``rows`` (or its columns ``keep``) and the decoded bytes."""
    def make() -> Callable:
        c = coder(path, pattern)
        return lambda i: (c.decode(i or ()),)
    return map_texts(rows, [rows[ids]], [T.StructField("decoded", T.BinaryType())], make, keep)


def token_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_tokens, ids_sha256 and, of the decoded ids, decoded_sha256. Encoding
    and decoding run in one task step, so ids are not sent back to Spark and out again."""
    def make() -> Callable:
        c = coder(path, pattern)
        digits = [str(i) for i in range(len(c.tokens))]

        def several(rows: list[tuple]) -> list[tuple]:
            return [(len(ids), sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest(), sha256(c.decode(ids)).hexdigest())
                    for ids in c.encode([t or "" for t, in rows])]
        return several
    out = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_texts(docs.select(F.col(key), F.col(text)), [F.col(text)], out, make, [key], group=GROUP)
