import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, blanks, copies, near copies, very long and repeated rows, and columns with clashing names."""
    rng = random.Random(7)
    long = prose(rng, 30_000)
    base = prose(rng, 300)
    near = base.replace(base.split()[150], "changed", 1)
    rows = [
        (0, None, "en", "a"),
        (1, "", "en", "a"),
        (2, " \n\t ", None, "a"),
        (3, base, "en", "a"),
        (4, base, "en", None),
        (5, near, "en", "b"),
        (6, long, "de", "b"),
        (7, "same words here " * 60, "de", "b"),
        (None, base, "en", "b"),
        (8, "One LINE\nmenu\n" + prose(rng, 60), "en", "b"),
        (8, "One LINE\nmenu\n" + prose(rng, 60), "en", "b"),
        (9, "### %%% $$$ " * 80, "en", "c"),
        (10, "漢字 кот — é \U0001f600 " + prose(rng, 55), "ru", "c"),
    ]
    rows += [(20 + i, f"menu\n{prose(rng, 70)}\nfooter {i % 3}", "en", "d") for i in range(30)]
    rows += [(100 + i, f"{prose(rng, 12)} && ##", "en", "junk") for i in range(40)]
    full = [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows]
    df = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in ("n_words", "kept", "host_rejected", "n_lines", "fingerprint", "component_id", "piece", "n_tokens", "licenses", "piece_ids")}).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
