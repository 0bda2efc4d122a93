"""Fixtures: a session for the operators, and documents with the cases that break things."""

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n  \t",
    "word",
    " word",
    "word ",
    "two  spaces and\n new line \n here",
    "it's they're I'll  don't",
    "<|endoftext|> and <|startoftext|>x",
    "naïve façade Ünïcode é ́x ΣΣ ς",
    "日本語のテキスト と 한국어",
    " nbsp em　wide\u0085next\x1cfile",
    "emoji 👩‍👩‍👧 🇩🇪 x",
    "1234567890 3.14 0x7f",
    "a" * 3000,
    "the&&& thing### of*** (and) 'quoted'",
    "tab\tseparated\tvalues\r\nnext",
    "same text twice",
    "same text twice",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Ids (with a NULL and a repeated one), odd texts, and columns named like results."""
    rows = [(i if i != 5 else None, t, "en", "s", 0, 7, 8) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (3, "another text of id three", "en", "s", 0, 7, 8)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, length long"
    )
