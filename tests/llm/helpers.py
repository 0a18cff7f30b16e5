"""Small documents that hold every awkward case, and plain versions of what is computed."""

import re

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FILLER = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(300))

DOCS = [
    (1, None), (2, ""), (3, "  \t\n"), (4, FILLER), (5, FILLER), (5, FILLER), (6, "one two"), (7, "one  TWO"), (8, "ONE two three"),
    (9, "é " + FILLER + "\x0b end"), (10, OTHER), (11, OTHER.replace("v150", "X")), (12, "a " * 400), (13, "a " * 300),
    (14, "x" * 5000), (15, "y" * 250 + "x" * 300), (None, FILLER), (None, None), (16, OTHER + " tail " + FILLER),
    (17, FILLER.upper()), (18, "\u00a0nbsp\u2028line " + "漢字 🙂 " * 80), (-3, "neg " + FILLER),
]
SCHEMA = "doc_id long, text string"
#: Extra columns, some named like results or helpers of the operators.
EXTRA = ["host", "score", "predicted", "evidence", "node", "chunk", "part", "bucket", "n", "root", "rank", "base", "terms", "kept"]


def frame(spark, rows=DOCS, extra=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in EXTRA}) if extra else df


def words(text):
    return (text or "").encode().split()


def shingles(text, n=5):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_spans(text):
    """The base spans as the patterns are stated."""
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds)
             for m in re.finditer(p, text or "") if ok(m[0])]
    return [(name, a, b) for a, _, b, name in sorted(found)]
