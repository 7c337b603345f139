"""Token counts.

Arrow batches go to the tokenizer library and only lengths come back.  Texts are
cut at boundaries that no pre-token can cross: a space between two characters that
are not white space.  Such a space always opens the next pre-token of a byte-level
tokenizer, so the lengths of the parts add up to the length of the whole.  Parts
not met before are encoded in batches of about equal bytes; lengths of parts met
before come from a bounded memo.  A tokenizer that may look across such a space
(another pre-tokenizer, a normaliser, an added token with white space) gets whole
texts, also in batches by bytes.

Defined results: a null text counts as the empty text (0 bytes, 0 tokens); rows
are independent, so repeated rows and null ids need no rule; an empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmart.llm.common import batches, utf8

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Bytes of text handed to the library at once, and parts whose length is remembered.
BATCH_BYTES, MEMO = 1 << 20, 300_000
#: A space that surely opens a pre-token: both neighbours are visible characters.
SAFE = re.compile(r" (?=[\w!-~])(?<=[\w!-~] )")
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


@lru_cache(maxsize=2)
def _library(path: str):
    """(encode a list of texts to lengths, may texts be cut) for a vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    cut = (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                    for t in spec.get("added_tokens", []))
    )
    fast = tokenizer.encode_batch_fast
    return (lambda texts: [len(x) for x in fast(texts, add_special_tokens=False)]), bool(cut)


class Lengths:
    """Token lengths of texts, with the memo of one Python worker."""

    def __init__(self, path: str):
        self.encode, self.cut = _library(path)
        self.first: dict[str, int] = {}  # parts that open a text
        self.inner: dict[str, int] = {}  # parts that follow a safe space

    def of(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return self._in_batches(texts)
        if len(self.inner) + len(self.first) > MEMO:
            self.first.clear()
            self.inner.clear()
        parts = [SAFE.split(t) for t in texts]
        new = set()
        for p in parts:
            new.update(p[1:])
        new.difference_update(self.inner)
        self._learn(list(new), self.inner, " ")
        new = {p[0] for p in parts}
        new.difference_update(self.first)
        self._learn(list(new), self.first, "")
        inner, first = self.inner.__getitem__, self.first.__getitem__
        return [first(p[0]) + sum(map(inner, p[1:])) for p in parts]

    def _learn(self, parts: list[str], memo: dict[str, int], lead: str) -> None:
        memo.update(zip(parts, self._in_batches([lead + p for p in parts])))

    def _in_batches(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        start = size = 0
        for i, t in enumerate(texts):
            size += len(t) + 32
            if size >= BATCH_BYTES:
                out += self.encode(texts[start : i + 1])
                start, size = i + 1, 0
        return out + (self.encode(texts[start:]) if start < len(texts) else [])


@lru_cache(maxsize=2)
def _lengths(path: str) -> Lengths:
    return Lengths(path)


def _pieces(text: str, most: int = 4 * BATCH_BYTES):
    """A long text in slices that begin at safe spaces."""
    start = 0
    while len(text) - start > most:
        cut = SAFE.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def count_tokens(df: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row's ``text``.

    ``vocabulary`` is a file name of the public tokenizer set or a path that every
    executor has.
    """

    def rows(batches_in):
        import public_tokenizers

        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        lengths = _lengths(path)
        group: list[tuple] = []
        size = 0

        def done():
            texts, spans = [], []
            for _, _, text in group:
                slices = list(_pieces(text)) if lengths.cut else [text]
                spans.append(len(slices))
                texts += slices
            counts = iter(lengths.of(texts))
            for (doc_id, n_bytes, _), n in zip(group, spans):
                n_tokens = sum(next(counts) for _ in range(n))
                yield doc_id, n_bytes, n_tokens, n_tokens > limit

        for batch in batches_in:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                raw = raw or b""
                group.append((doc_id, len(raw), raw.decode("utf-8", "replace")))
                size += len(raw)
                if size >= 4 * BATCH_BYTES:
                    yield from done()
                    group, size = [], 0
        yield from done()

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(batches_in):
        yield from batches(rows(batches_in), schema)

    return df.select("doc_id", "text").mapInArrow(run, SCHEMA)
