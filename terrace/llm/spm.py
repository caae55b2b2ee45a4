"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file is parsed as protobuf and rebuilt piece by piece: normaliser, metaspace
marker, byte fallback and either unigram scores or, for BPE models, merges ranked by
score. Pieces never cross the start of a marker, so a text's ids are the ids of its
marked words in order. Distinct words are encoded once per worker, in multithreaded
batches. The ids are the tokenizers library's, always. Where parity is asked for, the
sentencepiece library encodes each whole raw text too, with its own normaliser, and the two
lists of ids are compared.

Fixed cases: a null text has null ids, an empty one none; other columns, repeated rows
and ids pass through; texts of any length are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import small

MARK = "▁"

_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_UNIGRAM, _BPE = 1, 2
_CACHED_WORDS = 200_000
_JOINED = 256


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, from wherever Spark can read; read once, then sent with the tasks."""
    if "://" not in path and os.path.exists(path):
        with open(path, "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _ranked_merges(pieces: list, numbers: dict[str, int]) -> list[tuple[str, str]]:
    """Merges of a BPE model: a pair is joined earlier the higher its joint piece scores."""
    merges = []
    for p in pieces:
        if p.type not in (_NORMAL, _USER) or len(p.piece) < 2:
            continue
        for cut in range(1, len(p.piece)):
            pair = p.piece[:cut], p.piece[cut:]
            if pair[0] in numbers and pair[1] in numbers:
                merges.append((-p.score, len(merges), pair))
    return [pair for _, _, pair in sorted(merges)]


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, np.int32).tobytes()


class Codec:
    """Encoder and decoder for one model; holds a cache of encoded words."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trained, normal = proto.trainer_spec, proto.normalizer_spec
        pieces = list(proto.pieces)
        numbers = {p.piece: i for i, p in enumerate(pieces)}
        unknown = next(i for i, p in enumerate(pieces) if p.type == _UNKNOWN)
        if trained.model_type == _UNIGRAM:
            core = models.Unigram([(p.piece, p.score) for p in pieces], unknown, trained.byte_fallback)
        elif trained.model_type == _BPE:
            core = models.BPE(
                numbers, _ranked_merges(pieces, numbers), unk_token=pieces[unknown].piece,
                fuse_unk=True, byte_fallback=trained.byte_fallback,
            )
        else:
            raise ValueError(f"model type {trained.model_type} is neither unigram nor BPE")
        if trained.treat_whitespace_as_suffix or not normal.escape_whitespaces:
            raise ValueError("only models with a leading metaspace marker are supported")

        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.prefix = normal.add_dummy_prefix
        self.squeeze = normal.remove_extra_whitespaces
        charsmap = [normalizers.Precompiled(normal.precompiled_charsmap)] if normal.precompiled_charsmap else []
        self.charsmap = charsmap[0] if charsmap else None

        # Words are given marked and normalised.
        self.words = Tokenizer(core)
        # Many plain words at once, each encoded by itself.
        self.marked = Tokenizer(core)
        self.marked.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.starts = np.array([p.piece.startswith(MARK) for p in pieces])
        # The whole chain in one object, for use outside of Spark.
        self.whole = Tokenizer(core)
        self.whole.normalizer = normalizers.Sequence([
            *charsmap,
            *([normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()] if self.squeeze else []),
            *([normalizers.Prepend(MARK)] if self.prefix else []),
            normalizers.Replace(" ", MARK),
        ])
        self.whole.decoder = decoders.Sequence([
            decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
            *([decoders.Strip(" ", 1, 0)] if self.prefix else []),
        ])

        inner = [p.piece for p in pieces if p.type in (_NORMAL, _USER)]
        if any(MARK in p.lstrip(MARK) for p in inner):
            raise ValueError("pieces cross word boundaries")
        # A line break that no piece contains parts words too.
        self.parted = not any("\n" in p for p in inner) and not self.squeeze
        parts = "\n" if self.parted else ""
        self.pattern = re.compile(f"{MARK}*[^{MARK}{parts}]+|{MARK}+" + ("|\n+" if parts else ""))
        self.cache: dict[str, bytes] = {}

        def surface(p) -> bytes:
            if p.type == _BYTE:
                return bytes([int(p.piece[3:5], 16)])
            if p.type == _CONTROL:
                return b""
            return (trained.unk_surface if p.type == _UNKNOWN else p.piece.replace(MARK, " ")).encode()

        self.surfaces = [surface(p) for p in pieces]

    def normalised(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.squeeze:
            text = re.sub(" {2,}", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", MARK)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w[0] == MARK and len(w) > 1 and w[1] != MARK]
        rest = [w for w in words if not (w[0] == MARK and len(w) > 1 and w[1] != MARK)]
        groups = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        joined = self.marked.encode_batch_fast(["".join(group) for group in groups], add_special_tokens=False)
        for group, found in zip(groups, joined, strict=True):
            parts = self._parts(group, found.ids)
            if parts is None:
                rest += group
            else:
                self.cache.update(zip(group, parts, strict=True))
        if rest:
            found = self.words.encode_batch_fast(rest, add_special_tokens=False)
            self.cache.update((w, _packed(f.ids)) for w, f in zip(rest, found, strict=True))

    def _parts(self, group: list[str], ids: list[int]) -> list[bytes] | None:
        """Ids of joined words, cut where a word's marker begins; None where they cannot be told apart."""
        flat = np.asarray(ids, np.int32)
        cuts = (4 * np.append(np.flatnonzero(self.starts[flat]), len(flat))).tolist()
        if len(cuts) != len(group) + 1 or cuts[0]:
            return None
        raw = flat.tobytes()
        return [raw[cuts[i] : cuts[i + 1]] for i in range(len(group))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [self.pattern.findall(self.normalised(t)) for t in texts]
        if len(self.cache) > _CACHED_WORDS:
            self.cache.clear()
        if new := set().union(*split).difference(self.cache):
            self._learn(sorted(new))
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, words)), np.int32) for words in split]

    def agrees(self, texts: list[str], ids: list[np.ndarray]) -> list[bool]:
        """Whether the sentencepiece library gives the same ids for each whole raw text."""
        expected = self.reference.encode(texts, num_threads=1)
        return [np.array_equal(mine, theirs) for mine, theirs in zip(ids, expected, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that form no character become replacement characters."""
        raw = b"".join(map(self.surfaces.__getitem__, ids.tolist()))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec per worker and model."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    return Codec(model)


# Characters handled at once: bounds what the encoder holds besides its cache.
_BATCH_CHARS = 1_000_000


def encoded(model: bytes, texts: list[str | None], check: bool = False) -> Iterator[tuple[np.ndarray, bool] | None]:
    """(ids, parity) text by text, None for null, in batches of bounded size; parity is True unless checked."""
    coder, batch, size = codec(model), [], 0

    def flush() -> Iterator[tuple[np.ndarray, bool] | None]:
        real = [t for t in batch if t is not None]
        ids = coder.encode(real)
        found = zip(ids, coder.agrees(real, ids) if check else [True] * len(real), strict=True)
        for t in batch:
            yield None if t is None else next(found)

    for text in texts:
        batch.append(text)
        size += len(text or "")
        if size >= _BATCH_CHARS:
            yield from flush()
            batch, size = [], 0
    yield from flush()


def token_ids(model: bytes, text: Column) -> Column:
    """array<int> of the text's ids."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in small(batches):
            yield pd.Series([None if got is None else got[0] for got in encoded(model, texts.tolist())], dtype=object)

    return ids(text)


def token_text(model: bytes, ids: Column) -> Column:
    """The text of an array of ids."""

    @F.pandas_udf(T.StringType())
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = codec(model)
        for lists in batches:
            yield pd.Series([None if x is None else coder.decode(np.asarray(x, np.int64)) for x in lists], dtype=object)

    return text(ids)


DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("parity", T.BooleanType()),
    T.StructField("round_trip", T.BooleanType()),
])


@dataclass(frozen=True)
class _Digest:
    model: bytes

    def __call__(self, batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        coder = codec(self.model)
        names = DIGEST.fieldNames()
        for series in batches:
            texts = series.tolist()
            rows = []
            for text, got in zip(texts, encoded(self.model, texts, check=True), strict=True):
                if got is None:
                    rows.append((0, None, True, True))
                    continue
                ids, same = got
                plain = coder.normalised(text).replace(MARK, " ")
                plain = plain[1:] if coder.prefix else plain
                rows.append((len(ids), sha256(ids.astype("<i4").tobytes()).hexdigest(), same, coder.decode(ids) == plain))
            yield pd.DataFrame(rows, columns=names)


def digest(model: bytes, text: Column) -> Column:
    """Number and SHA-256 of the ids (32 bits each, little-endian), parity and round trip; for null text no hash."""
    run = _Digest(model)

    @F.pandas_udf(DIGEST)
    def checked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from run(batches)

    return checked(text)
