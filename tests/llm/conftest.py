import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[2]), str(Path(__file__).parents[1])]

from stratiform.llm.base import prepare  # noqa: E402

# Names that the operators use inside, as extra columns of the input.
CLASHING = "key row digest place batch kept keep_key component_id piece start length number chunk slot source_name block part marks next text_key score n_tokens copies removed"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in [*CLASHING.split(), "a b.c"])
EXTRA = ("x",) * (len(CLASHING.split()) + 1)

LONG = " ".join(f"word{n % 977} and{n % 31}" for n in range(6000))
PASSAGE = " ".join(f"passage{n}" for n in range(60))
TEXTS = [
    (1, "One and the same text, said again and again."), (2, "One  and\tthe same\ntext, said again and again."), (3, "One and the same text, said again and again."),
    (3, "One and the same text, said again and again."), (4, None), (5, ""), (6, " \n\t "), (None, "A text without an id, that is all there is to it."),
    (None, None), (7, LONG), (8, LONG + " end"), (9, "x" * 200_000), (10, f"before it {PASSAGE} after"), (11, f"something else {PASSAGE} and more"),
    (12, "short"), (12, "another text of the same id, not the same at all"), (13, "ünï çødé 日本語 \U0001f600 <|endoftext|> <s> ▁ ends"), (14, "word " * 300),
]


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def awkward(llm):
    """NULLs, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, None if n % 5 == 0 else "en", None if n % 3 == 0 else f"s{n % 2}", None, *EXTRA) for n, (i, t) in enumerate(TEXTS)]
    return llm.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(llm):
    return llm.createDataFrame([(1, 0, 0), (7, 1, 1), (None, 0, 1), (4, None, None), (7, 0, 1), (12, 1, 0)], "doc_id bigint, quality int, toxic int")
