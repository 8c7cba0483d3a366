"""Small tables for the operator tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, kept string, score string, fp string, component_id string, _key string"


def prose(seed: int, n: int, letters: str = "abcdefghij") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


def table(spark, rows):
    """rows of (doc_id, text, lang, source); further columns have clashing names."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", "s", "f", "c", "x") for r in rows], SCHEMA)


def edge_rows():
    """NULLs in every column, empty and long texts, ties and repeated rows."""
    base = prose(1, 80)
    return [
        (1, base, "en", "a"), (1, base, "en", "a"),  # repeated row
        (2, base, "en", "b"),  # exact copy
        (3, base + " extra", "en", None),
        (4, None, "en", "a"), (5, "", None, "b"), (6, " \n\t ", "de", ""),
        (None, prose(2, 70), "en", "a"), (None, None, None, None),
        (7, prose(3, 60) + "\n" + base, "de", "c"),
        (8, prose(4, 9000), "en", "c"),  # long
        (9, "Ünïcode \U0001F600 wörds ß   x", "de", "c"),
        (10, "\n".join([prose(5, 12)] * 4 + ["1 2 3"]), "en", "a"),
    ]


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def same(a, b):
    assert sorted(a, key=key) == sorted(b, key=key)
