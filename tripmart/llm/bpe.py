"""Byte-level BPE encoding and decoding.

Texts of up to ``CHUNK`` characters are encoded at once.  Longer ones are cut into
chunks that overlap by ``OVERLAP`` characters and are spread over the cluster.  Each
chunk is split into pre-tokens from its own first character, which may lie inside a
pre-token of the whole text.  Where a pre-token boundary of one chunk meets one of
the next inside their overlap, the two splits agree from there on, because the
split at a position depends only on the text after it; the text is cut at the
first such meeting that does not follow white space (a run of white space looks
at what comes after it, so a piece must not end in one).  Only the boundaries inside
the overlaps travel to that choice, never the texts.  Where none meets (one pre-token
longer than the overlap) the next cut is the first white space after other text in a
later overlap, which begins a pre-token whatever stands before it, and the chunks up
to there are one piece.  Pieces are encoded in parallel with the given ranks; their
ids come together in order as a stream.  Decoding concatenates the bytes of the ids.
Texts that may hold very long runs go to the library one pre-token at a time, since
its own split fails on some million white-space characters.

Defined results: a null text is the empty text (no ids, hash of nothing); rows are
independent and a long text that repeats is encoded once; bytes that are not UTF-8
are read as U+FFFD; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import batches, utf8

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK, OVERLAP = 32_768, 512
#: Texts of more characters go to the library one pre-token at a time.
SAFE = 100_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Codec:
    """The library's merges for one rank file, and its pre-token split."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.names = {i: str(i) for i in ranks.values()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= SAFE:
            return self.encoding.encode_ordinary(text)
        merge = lru_cache(maxsize=1 << 14)(self.encoding._encode_single_piece)
        return [i for m in self.pattern.finditer(text) for i in merge(m.group())]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def starts(self, text: str):
        """Starts of the pre-tokens of ``text``."""
        return (m.start() for m in self.pattern.finditer(text))

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    import public_tokenizers

    return Codec(vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary))


def chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """(number, text) of each chunk with its overlap into the next."""
    for i, start in enumerate(range(0, max(len(text), 1), chunk)):
        yield i, text[start : start + chunk + overlap]


def overlaps(codec: Codec, piece: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list, list, list]:
    """Places of a chunk where the text may be cut: (head, certain, tail).

    ``head``: its boundaries inside the overlap with the chunk before; ``certain``: those of them
    that are boundaries whatever stands before; ``tail``: boundaries inside the overlap with the
    next chunk, counted from that chunk's first character.
    """
    # what follows the last characters of a chunk may still change its split
    end = len(piece) if len(piece) < chunk + overlap else len(piece) - 4
    found = [s for s in codec.starts(piece)
             if (0 < s < overlap or chunk <= s < end) and not piece[s - 1].isspace()]
    head = [s for s in found if s < overlap]
    return head, [s for s in head if piece[s] in " \t\n"], [s - chunk for s in found if s >= chunk]


def cuts(heads: list[list[int]], certain: list[list[int]], tails: list[list[int]]) -> list[tuple[int, int]]:
    """(chunk, place) of each piece's first character, from the chunks' ``overlaps``."""
    out, known = [(0, 0)], True
    for i in range(1, len(heads)):
        before = set(tails[i - 1]) if known else ()
        met = next((p for p in heads[i] if p in before), None)
        if met is None and certain[i]:
            met = certain[i][0]
        known = met is not None
        if known:
            out.append((i, met))
    return out


def piece_of(parts: list[str], begin: int, end: int, chunk: int = CHUNK) -> str:
    """The piece that begins in the first of these chunks and ends at ``end`` of the chunk after the
    last one (or with the text: -1)."""
    last = parts[-1] if end < 0 else parts[-1][: chunk + end]
    return "".join([*(p[:chunk] for p in parts[:-1]), last])[begin:]


class Digests:
    """Count and digests over the ids of consecutive pieces of a text."""

    def __init__(self, codec: Codec):
        self.codec, self.n = codec, 0
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[int]) -> Digests:
        if ids:
            self.ids.update((("," if self.n else "") + self.codec.decimal(ids)).encode())
            self.decoded.update(self.codec.decode(ids))
            self.n += len(ids)
        return self

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def pieces(codec: Codec, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The pieces of one text by the chunked method, in one process."""
    parts = [t for _, t in chunks(text, chunk, overlap)]
    at = cuts(*zip(*(overlaps(codec, t, chunk, overlap) for t in parts)))
    ends = [*at[1:], (len(parts), -1)]
    return [piece_of(parts[i:j], begin, end, chunk) for (i, begin), (j, end) in zip(at, ends)]


def encode_text(codec: Codec, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of one text by the chunked method, in one process."""
    return [i for piece in pieces(codec, text, chunk, overlap) for i in codec.encode(piece)]


def encode(df: DataFrame, vocabulary: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row's ``text``."""
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])

    def short(batches_in):
        c = codec(vocabulary)

        def rows():
            for batch in batches_in:
                for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    yield doc_id, *Digests(c).add(c.encode((raw or b"").decode("utf-8", "replace"))).row()

        yield from batches(rows(), out)

    split = pa.schema([("digest", pa.string()), ("part", pa.int64()), ("piece", pa.string())])

    def cut(batches_in):
        def rows():
            for batch in batches_in:
                for digest, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    for i, piece in chunks(raw.decode("utf-8", "replace"), chunk, overlap):
                        yield digest, i, piece

        yield from batches(rows(), split)

    marked = pa.schema([("digest", pa.string()), ("part", pa.int64()),
                        *((k, pa.list_(pa.int32())) for k in ("head", "certain", "tail"))])

    def pretokenise(batches_in):
        c = codec(vocabulary)

        def rows():
            for batch in batches_in:
                for digest, i, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    yield digest, i, *overlaps(c, raw, chunk, overlap)

        yield from batches(rows(), marked)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        at = cuts(list(pdf["head"]), [list(x) for x in pdf["certain"]], list(pdf["tail"]))
        first, begin = (np.array(x, np.int64) for x in zip(*at))
        number = np.searchsorted(first, pdf["part"].to_numpy(), "right") - 1
        return pd.DataFrame({"digest": pdf["digest"], "part": pdf["part"], "first": first[number],
                             "begin": begin[number], "end": np.append(begin[1:], -1)[number]})

    coded = pa.schema([("digest", pa.string()), ("first", pa.int64()), ("ids", pa.binary())])

    def merge(batches_in):
        c = codec(vocabulary)

        def rows():
            now, parts = None, []
            for batch in batches_in:
                for *key, piece in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    if key != now:
                        if parts:
                            yield done_piece(now, parts)
                        now, parts = key, []
                    parts.append(piece)
            if parts:
                yield done_piece(now, parts)

        def done_piece(key, parts):
            digest, first, begin, end = key
            return digest, first, np.array(c.encode(piece_of(parts, begin, end, chunk)), np.int32).tobytes()

        yield from batches(rows(), coded)

    hashed = pa.schema([("digest", pa.string()), *list(out)[1:]])

    def join_up(batches_in):
        c = codec(vocabulary)

        def rows():
            now, digests = None, None
            for batch in batches_in:
                for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    if digest != now:
                        if digests:
                            yield now, *digests.row()
                        now, digests = digest, Digests(c)
                    digests.add(np.frombuffer(ids, np.int32).tolist())
            if digests:
                yield now, *digests.row()

        yield from batches(rows(), hashed)

    docs = df.select("doc_id", "text")
    is_long = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    done = docs.where(~is_long).mapInArrow(short, SCHEMA)
    long = docs.where(is_long).select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    parts = (
        long.select("digest", "text").groupBy("digest").agg(F.any_value("text").alias("text"))
        .mapInArrow(cut, "digest string, part bigint, piece string")
        .repartition("digest", "part")
    )
    places = "digest string, part bigint, head array<int>, certain array<int>, tail array<int>"
    plan = parts.mapInArrow(pretokenise, places).groupBy("digest").applyInPandas(
        choose, "digest string, part bigint, first bigint, begin bigint, end bigint"
    )
    encoded = (
        parts.join(plan, ["digest", "part"])
        .repartition("digest", "first").sortWithinPartitions("digest", "first", "part")
        .select("digest", "first", "begin", "end", "piece")
        .mapInArrow(merge, "digest string, first bigint, ids binary")
        .repartition("digest").sortWithinPartitions("digest", "first")
        .mapInArrow(join_up, "digest string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    )
    return done.unionByName(
        long.select("doc_id", "digest").join(encoded, "digest").select(*done.columns)
    )
