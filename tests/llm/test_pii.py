"""Personal data against plain regular expressions."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from plantlake.llm import pii, queries
from tests.llm.cases import documents, odd_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "url": r"(?:https?|ftp)://[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+(:[0-9]+)?(/[A-Za-z0-9._~%/?#&=+-]*)?",
    "account": r"(?:account|acct|iban|passport|ssn)[ :#=]{1,3}(?P<id>[A-Z]{0,2}[0-9][0-9A-Z-]{4,32})",
}


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        sums = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(sums) % 10 == 0
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return kind != "account" or len(digits) >= 6


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        group = "id" if kind == "account" else 0
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m.group(group)):
                out.append((kind, *m.span(group)))
    return out


PIECES = st.sampled_from(
    ["a", "Z.", "@", "@x", "b.co", ".", "..", "-", " ", "+", "+1", "(0)", "12", "255", "256", "007", "1.2.3", "4111 1111 1111 1111",
     "4111-1111-1111-1111", "é", "漢😀", "http://", "https://", "ftp://", "mailto:", "/p?q=1", ":80", "iban", "ssn", "account", "acct",
     "passport", ": ", "#", "=", "DE44500105", "123-45-6789", "\n", "%", "0"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_spans_of_awkward_texts(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.finder().spans(text)] == brute(text)


TEXTS = [
    "write a@b.c@d.e or x.y@mail.example.com.", "9.9.9.9.1.2.3.4 and 1.2.3.256 and 1.2.3.004",
    "é 4111 1111 1111 1111 漢 +1 (017) 555-7713 😀 +123456789012345678", "see https://ex.org:8/a?b and ftp://h, account: AB12345-678",
    "@@@ a@ @b.c a@b a@b. a@b..c", "1" * 4_000 + "." + "2.3.4", "a" * 50_000 + "@" + "b." * 1000 + "c", "ssn 12345 iban #DE12345678",
]


def test_spans_and_masks(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, TEXTS[0])]
    docs = documents(spark, rows).withColumnRenamed("size", "spans")
    found = pii.find_spans(docs, mask="masked")
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "c0", "_row", "spans", "masked"]
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans], r.masked) for r in found.collect()), key=repr)
    wanted = []
    for doc_id, text in rows:
        spans, out = brute(text), list(text or "")
        for _, a, b in spans:
            out[a:b] = pii.MARK * (b - a)
        wanted.append((doc_id, spans, "".join(out)))
    assert got == sorted(wanted, key=repr)


def test_query_of_empty_and_null_texts(spark, tmp_path):
    documents(spark, [(1, None), (2, ""), (3, "x 1.2.3.4 y a@b.c")]).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_anchor_expansion(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) for r in found] == [
        (0, 0, 0, 0, ""), (0, 0, 0, 0, ""), (1, 1, 0, 0, "email:12:17,ip:2:9"),
    ]
    assert found[0].base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_empty_table(spark):
    assert pii.find_spans(documents(spark, [])).collect() == []


def test_long_text():
    text = ("plain words and more of them " * 40 + "a@b.c 10.0.0.1 ") * 3000
    assert len(pii.finder().spans(text)) == 6000
