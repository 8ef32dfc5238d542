import random

import pytest

pytest.importorskip("tidewell.llm")

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper kapok larch maple nutmeg oak pine quince rowan spruce teak umbra viburnum willow yew zelkova".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "en", "ish", "ly", "wood"]) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, maybe__ int, sha__ string, fp int, row__ string, k1__ int, gone__ int, body string, t__ string, margin int, W__ int"
EXTRA = (1, "x", 2, "y", 3, 4, "z", "t", 5, 6)


def frame(spark, rows):
    """Documents with clashing extra columns from (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *EXTRA) for r in rows], SCHEMA)


LONG = prose(99, 60_000)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, very long and repeated texts, ties, repeated rows."""
    same = prose(1, 300)
    return frame(
        spark,
        [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, same), (6, same), (6, same), (None, same), (None, None), (7, LONG), (8, LONG), (9, "!!! ...  "), (10, same + " end"), (11, "日本語 テキスト"), (12, "mit license\nMIT License.")],
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
