import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts or (id, text) or (id, text, source), with columns that clash with inner names."""

    def make(*rows):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            doc, text, source = (*r, "s0")[:3] if len(r) < 3 else r
            full.append((doc, text, "en", source, len(text or "")))
        df = spark.createDataFrame(full, SCHEMA)
        for name in ("row", "key", "n", "h", "u", "v", "rep", "id", "item", "x1", "key_", "size", "words", "label"):
            df = df.selectExpr("*", f"'clash' as {name}")
        return df

    return make


WORDS = [f"w{i}x{i * 7 % 13}" for i in range(400)]


@pytest.fixture
def prose():
    """``prose(rng, n)``: n invented words."""
    return lambda rng, n: " ".join(rng.choice(WORDS) for _ in range(n))
