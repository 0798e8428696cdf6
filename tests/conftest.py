import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from linetrace.session import local_session  # noqa: E402

LINES = "pair_id string, side string, line_no int, text string, has_eol boolean"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make_lines(spark):
    def make(pairs):
        rows = [
            (pair, side, number, text, True)
            for pair, versions in pairs.items()
            for side, texts in zip(("old", "new"), versions)
            for number, text in enumerate(texts, 1)
        ]
        return spark.createDataFrame(rows, LINES).coalesce(4)

    return make


WORDS = "alpha beta gamma delta if else return count total value 12 7 x_y ( ) { } ; é".split()


def edited_pairs(seed, count, longest=14):
    """Random code-like versions with edits, moves, copies and blank lines."""
    rng = random.Random(seed)

    def line():
        if rng.random() < 0.15:
            return rng.choice(["", "  ", ");"])
        return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 7)))

    def touched(text):
        parts = text.split(" ")
        parts[rng.randrange(len(parts))] = rng.choice(WORDS)
        return " ".join(parts)

    pairs = {}
    for number in range(count):
        old = [line() for _ in range(rng.randrange(0, longest))]
        new = []
        for text in old:
            dice = rng.random()
            if dice < 0.5:
                new.append(text)
            elif dice < 0.75:
                new.append(touched(text))
            elif dice < 0.85:
                middle = len(text) // 2
                new += [text[:middle], text[middle:]]
        for _ in range(rng.randrange(3)):
            new.insert(rng.randrange(len(new) + 1), line())
        if new and rng.random() < 0.3:
            new.append(rng.choice(new))
        pairs[f"p{number}"] = (old, new)
    return pairs
