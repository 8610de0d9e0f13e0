"""Documents with every awkward case: nulls, empties, repeats, ties, long texts, clashing columns."""

from __future__ import annotations

EXTRA = "score double, size long, key long, digest string, hits int, tid string, position double, `__key` int, grp int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))


def row(doc_id, text, source="s0"):
    return (doc_id, text, None, source, None, 0.5, 1, 2, "d", 3, "t", 0.1, 7, 8)


def nasty(spark, extra=()):
    rows = [
        row(1, "The quick brown fox jumps over the lazy dog again and again."),
        row(1, "The quick brown fox jumps over the lazy dog again and again."),
        row(2, "the QUICK brown fox jumps over the lazy dog again and again."),
        row(3, None), row(4, ""), row(5, "   \n\t "), row(6, None, None), row(None, "lonely text without an id at all"),
        row(None, None, None), row(None, "lonely text without an id at all", "s1"), row(7, "ÄÖÜ Straße ÉÈ ascii"), row(8, "äöü Straße éè ASCII"),
        row(9, "word"), row(10, LONG, "s1"), row(11, LONG, "s2"), row(12, "x" * 5000), row(13, "a\x00b ​ \U0001f600 control \x01 \x02 marks"),
    ]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
