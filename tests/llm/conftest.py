import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, places string"


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash."""
    long = " ".join(f"w{k * k % 997}x" for k in range(60_000))
    copy = " ".join(f"copy{k}" for k in range(80))
    texts = [(0, None), (1, ""), (2, " \n\t "), (3, long), (4, copy), (5, copy), (5, copy), (6, copy + " tail"), (6, "other text"), (None, copy), (None, None),
             (7, "### $$$ %%%"), (8, "one two"), (9, "one two"), (10, "é ß ü 漢字 \U0001f600 <|endoftext|> x"), (11, "a\r\nb  c\n\n\nd\te")]
    return frame([(i, t, None if k % 3 else "en", None if k % 4 == 1 else f"s{k % 2}", None if t is None else len(t), "clash", "clash") for k, (i, t) in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="session")
def none(frame):
    return frame([], SCHEMA)
