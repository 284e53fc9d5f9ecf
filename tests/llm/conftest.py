import pytest
import public_tokenizers


@pytest.fixture(scope="session")
def model():
    return public_tokenizers.path("piece_bpe_32k.model")


ODD = [
    "", " ", "  a  b ", "▁", "a ▁b", "<s> x</s>", "<0x0A>", "\n\n a", "日本語 😀\u0000x", "a" * 5000, " \n ", "x   y", "tab\tq",
    "é̂ ü", "aaaaaaa aa aaaaa", "  x", "  ▁ ▁▁  ", "a b c", " a", "b ", "word " * 3000,
]


@pytest.fixture(scope="session")
def odd_texts():
    return ODD
