import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

#: Extra columns with names that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, d long, g int, start string, anchor double, "
          "n_words string, rank int, copies string, passes int, piece boolean, s array<int>")


def prose(seed: int, count: int, vocabulary: int = 4000) -> list[str]:
    source = random.Random(seed)
    return [f"w{source.randrange(vocabulary)}x" for _ in range(count)]


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and white texts, ties, repeated rows, near copies, shared and inner repeats, a very long text."""
    shared = prose(1, 60)
    base = prose(2, 300)
    near = list(base)
    near[40] = "changed"
    far = [f"{word}q" if k % 7 == 0 else word for k, word in enumerate(base)]
    long = prose(3, 30_000)
    inner = prose(4, 40)
    rows = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""),
        (7, " \t\n \r"), (8, "one two three"), (9, "one two three"), (10, "ONE Two thRee"), (11, "x" * 3000),
        (12, " ".join(prose(5, 80) + shared + prose(6, 50))), (13, "\n".join(prose(7, 30) + shared + prose(8, 90))),
        (14, " ".join(shared)), (15, " ".join(inner + prose(9, 10) + inner + inner)), (16, " ".join(long)),
        (17, " ".join(long[5000:9000]) + " end"), (18, "a " * 700), (19, "line of words\n" * 60), (20, "é ü ß   中文 🙂 " * 40),
        (None, " ".join(base[:200])), (None, None), (21, " ".join(prose(10, 120))), (21, " ".join(prose(10, 120))),
        (-5, " ".join(shared + prose(11, 30))), (1 << 60, " ".join(prose(12, 25) + shared)),
        (22, "mail a.b@c.de at 10.0.0.1, 4111 1111 1111 1111 or +1 (234) 555-0000 " + " ".join(prose(13, 60))),
    ]
    return rows


@pytest.fixture(scope="session")
def odd():
    return odd_texts()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    rows = [(doc, text, ["en", None, "de"][k % 3], ["a", "b", None][k % 3], len(text or ""), 7, 1, "s", 0.5, "w", 3, "c", 2,
             True, [k]) for k, (doc, text) in enumerate(odd)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True, scope="session")
def _checkpoints(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
