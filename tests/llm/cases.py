"""Small tables with what each operator must bear."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, c0 string, size long, _row long"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with further columns whose names clash with inner ones."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4]
        full.append((doc_id, text, lang, source, len(text or ""), "c", 1, 2))
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(words))


def odd_rows():
    """Nulls, blanks, repeated rows, marks, other scripts, one long word and one long text."""
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "a"), (4, "one", "en", None),
        (4, "one", "en", None), (None, "Two words", None, "b"), (5, "İÑ ΣΑΣ ça va 12³ ½ 漢字 😀 á​", "fr", "b"),
        (6, "see <|endoftext|> and <|startoftext|>x", "en", "b"), (7, "a" * 3000, "en", "b"),
        (8, prose(1, 4000), "en", "c"), (9, "12 34 !!", "en", "c"), (10, "it's we'll x\x1c y　 ", "en", "c"),
    ]
