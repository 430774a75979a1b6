"""Every stage of the pipeline against brute force over what the stage before it kept."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plantlake.llm import mixing
from tests.llm.cases import documents, odd_rows, prose
from tests.llm.test_simhash import brute_components, brute_print
from tests.llm.test_suffix import brute


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(None if i is None else 10_000 + i, *rest) for i, *rest in odd_rows()]
    near = prose(4, 200)
    odd += [(20_000, near, "en", "src1"), (20_001, near.upper(), "en", None), (20_002, "12 !! 34", "en", "src1")]
    return base.unionByName(documents(spark, odd).select(base.columns))


def row(r):
    return (r.doc_id, r.text, r.lang, r.source)


def test_stages(spark, docs):
    columns, kept = docs.columns, docs
    before = Counter(map(row, docs.collect()))
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    for name in ("language_id", "simhash_dedup", "suffix_dedup", "mixing"):
        source = kept
        # Stored, as the pipeline does.
        kept = corpus_pipeline.store(stages[name](spark, source, ""), name)
        assert kept.columns == columns, name
        after = Counter(map(row, kept.collect()))
        texts = sorted(before.elements(), key=lambda r: (r[0] is None, r[0] or 0))
        if name == "language_id":
            wanted = Counter(r for r in texts if any(c.isalpha() for c in r[1] or ""))
            # A missing language is filled in.
            assert Counter((i, t, s) for i, t, _, s in after.elements()) == Counter((i, t, s) for i, t, _, s in wanted.elements())
            assert all(lang for _, _, lang, _ in after)
        elif name == "simhash_dedup":
            groups = brute_components([brute_print(t) for _, t, *_ in texts], 2)
            assert sorted(t for _, t, *_ in after.elements()) == sorted(texts[i][1] for i in sorted(set(groups.tolist())))
        elif name == "suffix_dedup":
            wanted = [(r[0], b.decode("utf-8", "ignore")) for r, (b, *_) in zip(texts, brute([t for _, t, *_ in texts], 200), strict=True)]
            assert Counter(wanted) == Counter((i, t) for i, t, *_ in after.elements())
        else:
            counts = {(r.id, r.source): r.copies for r in mixing.mix_counts(source).collect()}
            assert after == Counter({r: n * counts[r[0], r[3]] for r, n in before.items() if counts[r[0], r[3]]})
        before = after
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter()
    for i, text, _, source in before.elements():
        ids = library.encode(text, add_special_tokens=False).ids
        wanted[i, source, len(ids), tuple(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    last = stages["bpe_encoding"](spark, kept, "").collect()
    assert Counter((r.doc_id, r.source, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in last) == wanted


def test_empty(spark, docs):
    kept = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.store(stage(spark, kept, ""), "empty")
    assert kept.count() == 0


def test_columns_with_the_names_of_inner_ones_keep_their_values(spark):
    names = ("_lang", "_lang_", "_score", "_SCORE_2", "kept", "n_bytes", "n_removed", "n_spans", "_text", "_row", "fingerprint")
    docs = documents(spark, [(i, prose(i, 40), None if i % 5 else "en", "s") for i in range(30)]).drop("_row", "size")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), "doc_id"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = corpus_pipeline.store(stage(spark, kept, ""), name)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name
