"""Token counts of very long runs of one kind of character."""

import random

import pytest

from labelloom.llm import token_counts as T


@pytest.fixture(scope="module")
def enc():
    with open(T.VOCABULARY, "rb") as f:
        return T.encoder(f.read())


def test_cut_texts_have_the_same_tokens(enc):
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "\xa0", "　", "\x85", "\x1c", "​", "a", "word", "7", "-", "é", "'s", ".", "字"]
    for _ in range(4000):
        text = "".join(rng.choice(parts[: rng.randrange(1, len(parts) + 1)]) for _ in range(rng.randrange(0, 40)))
        cut = T.pieces(text, rng.randrange(1, 5))
        assert "".join(cut) == text
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "\t \n", "a", "7", "-", "é", "ab "])
def test_two_million_characters(spark, enc, unit):
    """A run's tokens grow in proportion, alone and before a letter, from what a tenth of it has."""
    long, short = 2_000_000 // len(unit), 200_000 // len(unit)
    docs = spark.createDataFrame([(unit * n + end,) for n in (long, short) for end in ("", "b", " b")], "text string")
    got = [r.n_tokens for r in T.token_lengths(docs.coalesce(1)).collect()]
    assert got[3:] == [len(enc.encode_ordinary(unit * short + end)) for end in ("", "b", " b")]
    for a, b in zip(got[:3], got[3:]):
        assert abs(a - b * long / short) <= 0.03 * a + 4
    if unit == " ":
        assert got[:3] == [long, long, long + 1]
