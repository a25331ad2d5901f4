"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NOT_SPACE = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    """ASCII letters only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, texts, extra=None):
    """Rows of ``documents`` with running ids, plus (id, text) pairs."""
    rows = [*enumerate(texts), *(extra or [])]
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def keyed(df):
    return sorted(rows(df), key=lambda r: (r[0] is not None, *map(str, r)))
