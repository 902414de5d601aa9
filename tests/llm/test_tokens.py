import os
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm.lexicon import Lexicon, build
from rollcall.llm.tokens import TOKENIZERS, VOCABULARY, Merger, encode, most_frequent, token_counts, word_counts

PATH = os.path.join(TOKENIZERS, VOCABULARY)
needs_files = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")
TEXTS = [
    None, "", " ", "\n", "  two  spaces ", "a\n\n  b\t\tc \n", "Hello, world's <|endoftext|> they'LL we've", "हिन्दी पाठ 123 ४५६", "x\x1cy \x85 z\xa0w　v", "🌾🚜 emoji…—", "1234567 ½ ² Ⅻ",
    "word " * 3000, "no-break space", "\r\n\r\nend", "'s 's''t", "a" * 5000,
]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), max_size=4).map(tuple), max_size=40))
def test_automaton_against_a_dictionary(words):
    lexicon = Lexicon(build(words))
    assert all(lexicon.get(w) == ids for w, ids in words.items())
    for w in words:
        for other in (w[:-1], w + b"x"):
            assert lexicon.get(other) == words.get(other)


def test_suffixes_are_shared_and_mapped(tmp_path):
    stems = [bytes([97 + i, 97 + j]) for i in range(20) for j in range(20)]
    block = build({s + b"isation": (1, 2) for s in stems})
    p = tmp_path / "l.bin"
    p.write_bytes(block)
    lexicon = Lexicon.mapped(str(p))
    assert len(lexicon.final) < 15 and lexicon.get(b"ccisation") == (1, 2) and lexicon.get(b"cc") is None


@needs_files
def test_ids_against_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ab 'sह\n ,.9Z") for _ in range(r.randint(1, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, ids string")
    for most in (4, 1000):
        got = {x.doc_id: list(x.ids) for x in encode(df, most_words=most).collect()}
        assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    sizes = {x.doc_id: x.n_tokens for x in token_counts(df, ["doc_id"]).collect()}
    assert sizes == {i: len(v) for i, v in got.items()}


@needs_files
def test_empty_table_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((len(r.ids) for r in encode(df).collect())) == [0, 2, 2]
    assert encode(df.limit(0)).collect() == []


@needs_files
def test_merges_are_a_round_trip():
    m = Merger(PATH)
    back = {v: k for k, v in m.ranks.items()}
    for t in TEXTS:
        assert b"".join(back[i] for i in m.ids(t or "")).decode() == (t or "")


@needs_files
def test_long_pieces_merge_like_short_ones():
    m, r = Merger(PATH), random.Random(6)
    for letters in ("ab", "the ", "aह🌾", "abcdefghijklmnopqrstuvwxyz"):
        for n in (2, 3, 50, 400):
            token = "".join(r.choice(letters) for _ in range(n)).encode()
            assert m._merge_long(token) == m._merge_short(token)
    began = time.time()
    assert len(m.ids("".join(r.choice("abcdefgh") for _ in range(300_000)))) > 50_000
    assert time.time() - began < 20


def test_only_the_most_frequent_words_are_kept(spark):
    df = spark.createDataFrame([("a a a a b b c c",), ("a d",), (None,)], "t string")
    counts = word_counts(df, "t")
    assert {r.word: r.n for r in counts.collect()} == {"a": 5, "b": 2, "c": 2, "d": 1}
    assert [r.word for r in most_frequent(counts, "word", 3)] == ["a", "b", "c"] and [r.word for r in most_frequent(counts, "word", 2)] == ["a"]
