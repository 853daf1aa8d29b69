"""Documents with whatever an operator must bear, and brute-force versions to compare with."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

SEPARATORS = r"[^\x20\x09-\x0D]+"
PASSAGE = " ".join(f"word{i}" for i in range(120))

# doc_id, text
ROWS = [
    (1, "A first text. It ends here, and is read again below."),
    (2, None),
    (3, ""),
    (4, " \n\t \x0b "),
    (5, "one"),
    (6, f"Before it. {PASSAGE} after it."),
    (7, f"{PASSAGE}"),
    (7, f"{PASSAGE}"),
    (8, "line\nline\nHome\nline " + "naïve café ▁ 梦 🙂 x y " * 30),
    (9, f"Another start. {PASSAGE} and yet another end of it all."),
    (10, "x" * 3000),
    (11, "long text " * 4000 + PASSAGE),
    (12, "a b c " * 60),
    (12, f"the id again, with another text: {PASSAGE}"),
    (None, f"no id. {PASSAGE}"),
    (13, f"{PASSAGE}"),
    (14, "###### $$$$ %%%% &&&& " * 30),
    (15, "ab" * 40 + "cd" * 40),
    (16, "ab" * 40 + "ce" * 40),
]
EXTRA = ("id", "key", "text_", "score", "evidence", "bucket", "slot", "anchor", "words", "lines", "ids", "decoded", "fp", "first", "kept", "item_id")


def documents(spark):
    """The rows above with columns of names that operators use themselves."""
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    return df.select("*", *[F.lit("other").alias(c) for c in EXTRA])


def words(text: str | None) -> list[str]:
    return re.findall(SEPARATORS, text or "")


def removed(rows, units, window):
    """Which units of every row lie in a window that also starts under a smaller id."""
    first: dict = {}
    for id_, text in rows:
        if id_ is not None:
            u = units(text)
            for k in range(len(u) - window + 1):
                w = u[k : k + window]
                first[w] = min(first.get(w, id_), id_)
    out = []
    for id_, text in rows:
        u = units(text)
        gone = bytearray(len(u))
        for k in range(len(u) - window + 1):
            if id_ is not None and first[u[k : k + window]] < id_:
                gone[k : k + window] = b"\1" * window
        out.append(gone)
    return out
