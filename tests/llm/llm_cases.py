"""Rows that operators must handle, and brute-force versions of what they compute."""

import random
import re
import zlib

import duckdb
import numpy as np

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
# columns whose names operators use inside
EXTRA = "lang string, source string, n_chars long, size long, key string, rep long, score double, block long, digest string, kept boolean, `_key` string"


def small_rows():
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    return [tuple(r) for r in rows]


def tricky_rows():
    """Null ids and texts, empty and blank texts, repeats, one id with two texts, near copies, long texts and long words."""
    rnd = random.Random(7)
    base = [f"word{rnd.randrange(400)}" for _ in range(120)]
    near = [*base[:60], "changed", *base[61:]]
    far = [*base[:30], *(f"other{i}" for i in range(90))]
    long_text = " ".join(f"w{rnd.randrange(3000)}" for _ in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two Words"), (6, "two words"), (None, "two words"), (None, None),
        (7, " ".join(base)), (8, " ".join(near)), (9, " ".join(far)), (10, " ".join(base).upper()), (10, " ".join(far[::-1])),
        (11, long_text), (12, long_text + " end"), (13, "x" * 60_000), (14, "a b c d e f g h"), (14, "a b c d e f g h"),
        (15, "mail a.b@c.example now, call +1 (555) 555-0100, card 4111 1111 1111 1111, host 10.0.0.256 10.0.0.25"),
        (-3, "▁ ▁▁ café \U0001f600 �  <|endoftext|> <s>"), (16, "ends with spaces   "), (17, "   begins"), (18, "á á ẛ̣"),
    ]


def frame(spark, rows, extra=True):
    """The rows as documents, with other columns that hold nulls and have clashing names."""
    schema = f"doc_id long, text string, {EXTRA}" if extra else "doc_id long, text string"
    width = len(EXTRA.split(", ")) if extra else 0
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], schema).repartition(3)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def classes(nodes, links):
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()
