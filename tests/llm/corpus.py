"""Tables and odd texts that the tests of the corpus operators share."""

from __future__ import annotations

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use themselves.
CLASHES = [
    "n_words", "row", "bucket", "part", "id", "key", "label", "group", "component", "score", "found", "piece", "number",
    "length", "statistics", "stratum", "host", "declared", "lines", "_row", "leaf", "kept", "hits", "word", "s",
]
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards mix a potion of odd herbs"
LONG = " ".join(f"word{k % 977} goes{k % 31}" for k in range(60_000))
ODD = [
    (None, "a text without an id that goes on for a while, with words enough to count", None, None),
    (None, None, None, None),
    (1, None, "en", "web"),
    (2, "", "en", None),
    (3, " \n\t \n", None, "web"),
    (4, SENTENCE, "en", "web"),
    (4, SENTENCE, "en", "web"),
    (5, SENTENCE, "de", "web"),
    (6, LONG, "en", "web"),
    (7, LONG + " and a tail", "en", "web"),
    (8, "é ü ß 日本語 ☃ \U0001f600", "xx", ""),
    (9, "x" * 200_000, "en", "web"),
    (10, "one\n\n\none\n", "en", "web"),
]
