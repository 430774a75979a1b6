"""Token counts and byte BPE against the tokenizers library."""

import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plantlake.llm import byte_bpe, token_counts
from tests.llm.cases import documents, odd_rows

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_counts_equal_library(spark):
    library = Tokenizer.from_file(WORD)
    got = token_counts.count_tokens(documents(spark, odd_rows()), WORD)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "c0", "size", "_row", "n_tokens"]
    wanted = sorted((i or 0, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in odd_rows())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == wanted


def test_encode_and_decode_equal_library(spark):
    library = Tokenizer.from_file(BYTE)
    encoded = byte_bpe.encode(documents(spark, odd_rows()), BYTE)
    assert encoded.columns[-1] == "ids" and "c0" in encoded.columns
    rows = byte_bpe.decode(encoded, BYTE).collect()
    wanted = []
    for i, text, *_ in odd_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((i or 0, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in rows) == sorted(wanted)


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert token_counts.count_tokens(docs, WORD).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(docs, BYTE), BYTE).count() == 0


LETTERS = st.text(st.sampled_from("aabcdeé ïßΣ's\n\t!?.,12³<|>漢😀\x1c　İ"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(LETTERS, st.text(max_size=30)), max_size=5))
def test_random_texts(texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    library, own = Tokenizer.from_file(BYTE), byte_bpe.tokenizer(BYTE)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids.tolist()) == text
    words = Tokenizer.from_file(WORD)
    assert token_counts.counter(WORD).count(texts) == [len(words.encode(t, add_special_tokens=False).ids) for t in texts]


def test_cuts_are_where_no_token_lies():
    own = byte_bpe.tokenizer(BYTE)
    assert own.cut.any()
    for token in list(own.ids)[:5000]:
        assert not any(own.cut[a, b] for a, b in zip(token, token[1:], strict=False))


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    texts = ["one two three four five", "six seven one", "two eight"]
    fresh, counter = byte_bpe.ByteBpe(BYTE), token_counts.WordBpe(WORD)
    twice = [fresh.encode([t])[0].tolist() for t in texts + texts]
    assert twice[:3] == twice[3:] == [Tokenizer.from_file(BYTE).encode(t).ids for t in texts]
    assert counter.count(texts) == counter.count(texts)


def test_digest_of_nothing(spark):
    from plantlake.llm.queries import op10_forced_boundary_bpe

    row = op10_forced_boundary_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    assert len(row.ids_sha256) == 64 and row.ids_sha256 != hashlib.sha256(b"").hexdigest()
