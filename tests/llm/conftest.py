import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty and long texts, ties, repeated rows, clashing columns."""
    rows = _rows()
    names = ["node", "th", "key", "spans", "score", "bucket", "component_id", "kept_text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *names) for i, t in rows], schema)


def _rows():
    base = " ".join(f"w{k}x" for k in range(60))
    long_text = " ".join(f"tok{k % 977}q{k % 131}" for k in range(20000))
    return [
        (1, base), (2, base), (2, base),                     # a copy, and a repeated row
        (3, base.replace("w5x", "other")), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "ONE"), (9, "one two"),
        (10, long_text), (11, "start " + long_text), (12, "Ünï çödé ñandú 🙂 漢字"), (None, base + " tail"), (None, None),
        (13, "mail a.b@c.example.org or +1 (017) 555-7713, card 4111 1111 1111 1111, ip 10.0.0.255 and 10.0.0.256"),
        (14, "x" * 5000), (15, "x" * 4000), (16, "same id, one"), (16, "same id, two words more"),
    ]


@pytest.fixture(scope="session")
def odd_rows():
    return _rows()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
