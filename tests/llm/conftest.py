import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Texts at the edges: null, empty, blank, short, repeated, long, many lines, wide characters."""
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(9000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text here with five words"), (6, "same text here with five words"),
        (7, long), (8, "line a\nline a\n\nline a b\n" * 5), (9, "𝔘𝔫𝔦 code points é ß 漢字 " * 40), (10, "x" * 30000),
        (11, "#*$ %&| <> " * 9), (12, "a b c d e f g h " * 12),
    ]
