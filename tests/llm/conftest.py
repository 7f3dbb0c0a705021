"""Small documents with every case that the operators define a result for."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, _row int, _key string, score string"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n, vocabulary=400):
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "é", "ß", "ou", "Ti"]
    stock = ["".join(rng.choice(parts) for _ in range(1 + i % 4)) for i in range(vocabulary)]
    out = []
    for i in range(n):
        out.append(rng.choice(stock) + rng.choice(["", "", "", ",", ".", " \n"]))
    return " ".join(out)


def messy_rows(seed=1):
    """(id, text) pairs: prose, copies, near copies, shared passages, nulls,
    empty and blank texts, one very long text, odd characters."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(5, 200)) for _ in range(40)]
    passage = prose(rng, 60)
    texts = [*base, *base[:6], None, "", " \t\n\x0b\x0c\r ", "a", "one two", "a " * 300, "x y " * 60,
             prose(rng, 6000), " nbsp  em　wide \u0085nel", "tab\tcr\r\nvt\x0bff\x0cend", "😀 emoji <|endoftext|> it's we'll 'tis I'D 123abc  \n\n x"]
    for i in range(8):
        own = base[i].split(" ")
        texts.append(" ".join(own[:len(own) // 2]) + " " + passage + " " + " ".join(own[len(own) // 2:]))
    edited = base[3].split(" ")
    for i in range(5):
        texts.append(" ".join([*edited[:i], "changed", *edited[i + 1:]]))
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """Documents with extra columns whose names clash with private ones."""
    langs, sources = ["en", "de", None], ["src0", "src0", "src1", None]
    return spark.createDataFrame(
        [(i, t, langs[k % 3], sources[k % 4], None if t is None else len(t), "x", "y", 1, "z", "s")
         for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="session")
def messy(spark):
    rows = messy_rows()
    return rows, frame(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_ids(spark):
    """Repeated rows and null ids."""
    rng = random.Random(5)
    t, u = prose(rng, 60), prose(rng, 60)
    rows = [(1, t), (1, t), (None, t), (None, t), (2, u), (None, u), (3, None), (3, ""), (None, None)]
    return rows, frame(spark, rows)
