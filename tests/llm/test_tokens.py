import base64
import hashlib

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.brute import frame, odd_docs
from tripmart.llm import bpe, tokencount

PATH = public_tokenizers.path(tokencount.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "  a  b ", "a\n\nb c\t d", "don't we'll I'M", "x<|endoftext|> y <|endoftext|>", "<|endoftext|>",
       "nbsp em line sep\x85next\x1cfs", "日本語 テキスト", "🎉🎉 👩‍👩‍👧", "a" * 3000, "́ combining é x",
       "end ", " start", "tab\tx y", "1 2 33 ½ ², ٣", "a  \n b", "zero​width ᠎ x"]
mixed = st.lists(st.sampled_from([*"ab Zé\n\t'st,.19\xa0\u2003日🎉", "  ", "'ll", "<|endoftext|>"]), max_size=80).map("".join)


def tik():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TIK = tik()


@settings(max_examples=400, deadline=None)
@given(mixed)
def test_counts_equal_the_library(text):
    lengths = tokencount.Lengths(PATH)
    assert lengths.cut
    assert lengths.of([text]) == [len(LIBRARY.encode(text, add_special_tokens=False))]


def test_counts_of_odd_texts_and_long_slices():
    lengths = tokencount.Lengths(PATH)
    assert lengths.of(ODD) == [len(LIBRARY.encode(t, add_special_tokens=False)) for t in ODD]
    long = " ".join(ODD * 20)
    pieces = list(tokencount._pieces(long, 50))
    assert len(pieces) > 10 and "".join(pieces) == long
    assert sum(lengths.of(pieces)) == len(LIBRARY.encode(long, add_special_tokens=False))


def test_memo_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(tokencount, "MEMO", 3)
    lengths = tokencount.Lengths(PATH)
    for text in ["a b c d e", "f g h", "a b c d e"]:
        assert lengths.of([text]) == [len(LIBRARY.encode(text, add_special_tokens=False))]


def test_count_rows(spark):
    rows = odd_docs() + [(100 + i, t, "en", "s", 0) for i, t in enumerate(ODD)]
    want = sorted(((r[0], len((r[1] or "").encode()), n := len(LIBRARY.encode(r[1] or "", add_special_tokens=False)),
                    n > 512) for r in rows), key=str)
    got = tokencount.count_tokens(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert tokencount.count_tokens(frame(spark, [])).count() == 0


def test_other_vocabularies_get_whole_texts(spark):
    import sentencepiece

    rows = odd_docs()
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = tokencount.count_tokens(frame(spark, rows), "word_bpe_49k.json").collect()
    assert [r.n_tokens for r in got] == [len(word.encode(r[1] or "", add_special_tokens=False)) for r in rows]
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = tokencount.count_tokens(frame(spark, rows), "piece_bpe_32k.model").collect()
    assert [r.n_tokens for r in got] == [len(piece.encode(r[1] or "")) for r in rows]


@settings(max_examples=400, deadline=None)
@given(mixed, st.integers(5, 40), st.integers(1, 12))
def test_chunks_equal_the_library(text, chunk, overlap):
    c = bpe.codec(bpe.VOCABULARY)
    text = text * 3
    ids = bpe.encode_text(c, text, chunk, min(overlap, chunk))
    assert ids == TIK.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def expected(text):
    ids = TIK.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_encode_rows(spark):
    long = ("word don't  " * 900 + "z" * 9000 + "\n\n" + "日本" * 3000 + " end") * 2
    rows = odd_docs() + [(100 + i, t, "en", "s", 0) for i, t in enumerate([*ODD, long, long, " " * 40_000])]
    want = sorted(((r[0], *expected(r[1])) for r in rows), key=str)
    assert sorted(map(tuple, bpe.encode(frame(spark, rows)).collect()), key=str) == want
    small = bpe.encode(frame(spark, rows), chunk=1000, overlap=40)
    assert sorted(map(tuple, small.collect()), key=str) == want
    assert bpe.encode(frame(spark, [])).count() == 0


def test_very_long_runs():
    # the library's own split ends in an error on such runs; its merges of a single piece do not
    c = bpe.codec(bpe.VOCABULARY)
    for run in (" ", "\n", "\u3000", "a", "é", "."):
        for n in (1_000_000, 5_000_000):
            text = "one" + run * n + "x two"
            plain = [i for m in c.pattern.finditer(text) for i in TIK._encode_single_piece(m.group())]
            assert bpe.encode_text(c, text) == plain
            assert c.decode(plain) == text.encode()


def test_a_long_text_is_cut_into_many_pieces():
    c = bpe.codec(bpe.VOCABULARY)
    text = "日本語テキスト、don't  stop 12.5\n\n" * 20_000 + " " * 100_000 + "so it goes on and on, " * 20_000
    found = bpe.pieces(c, text)
    assert "".join(found) == text and len(found) > len(text) // bpe.CHUNK - 6
    assert sorted(map(len, found))[-2] <= bpe.CHUNK + bpe.OVERLAP
    assert [i for p in found for i in c.encode(p)] == [i for m in c.pattern.finditer(text) for i in TIK._encode_single_piece(m.group())]


def test_runs_over_many_chunks_of_rows(spark):
    texts = ["one" + " " * 1_000_000 + "x", "\n" * 1_200_000 + "日本語", "a" * 300_000 + " end. " * 20_000]
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode(frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()}
    c = bpe.codec(bpe.VOCABULARY)
    for i, t in enumerate(texts):
        ids = [k for m in c.pattern.finditer(t) for k in TIK._encode_single_piece(m.group())]
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(t.encode()).hexdigest())
