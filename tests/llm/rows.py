"""Documents with every awkward case, for the tests of this folder."""

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, bucket string, score double, payload binary"


def text(rng, words, letters="abcdefgh"):
    return " ".join("".join(rng.choice(list(letters), int(rng.integers(2, 7)))) for _ in range(words))


def documents(seed=5):
    """(doc_id, text, lang): ties, repeated rows, nulls, empty and very long texts, near copies."""
    rng = np.random.default_rng(seed)
    base = text(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [(i, text(rng, int(rng.integers(1, 60))), "xx") for i in range(30)]
    rows += [(100, base, "xx"), (101, base, "xx"), (102, " ".join(near), "yy"), (102, " ".join(near), "yy"), (103, base.upper() + "!", None)]
    rows += [(200, None, "xx"), (201, "", "xx"), (None, base, "xx"), (None, None, None), (202, "?! 123 ...", None), (203, "é😀 naïve", "yy"), (204, text(rng, 30_000), "xx"), (-5, "one two", "yy")]
    return rows


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1, "b", 0.5, b"p") for i, t, lang in rows], SCHEMA).repartition(3)
