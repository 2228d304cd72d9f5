import random

import pytest
from pyspark.sql import functions as F

# Names that operators use inside or return; a table may have them too.
CLASHING = ["score", "shard", "slot", "key", "kept", "label", "bucket", "spans", "h", "n", "t1", "_text", "_k1", "class_id", "start", "u", "v"]
SYLLABLES = "an er th in on re es st or ti ar te".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns of clashing names, in several partitions."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING}).repartition(4)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Missing and empty texts and ids, repeated rows, ties, one very long text."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [
        (1, base), (2, base), (2, base), (3, near), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None), (7, "one two"),
        (8, prose(2, 30_000)), (9, prose(3, 80)), (10, "é " * 70), (11, "a\x1cb c\u00a0d e f g"),
    ]
