import pytest

SF = "/root/testdata/sf0.001"

#: Texts with everything that may go wrong.
ODD = [
    None, "", " ", "\n\n\t", "one", "one two", "\x00 \x1f", "été ÉTÉ   wide space ünï", "a" * 5000, "1" * 3000, "x@" * 300, "+1" * 200,
    "mail me.at+x%y@ex-ample.co.uk, or a@b, or @c.de, ..@d.e 1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 4111 1111 1111 1111 4111-1111-1111-1112",
    "call +49 (0)30 1234567 now, +1-2, iban DE89 3704 0044 0532 0130 00 AND MORE, DE89370400440532013001, ssn 123-45-6789, 123-45-6789",
    "It's we'll   I'D 'd <|endoftext|><|endoftext|> tail\r\n\r\n  x 12345 ١٢٣ ½ 漢字 😀😀 é", "same line\nsame line\n same line\nsame line\r",
    "a b c a b c a b c d", " ".join(str(i) for i in range(60)), " ".join(["the cat sat"] * 30), "w " * 20000, "Σίσυφος ΣΊΣΥΦΟΣ ß ẞ ﬁ",
]


@pytest.fixture(scope="session")
def table(spark):
    """rows(list of texts or (id, text)) -> documents with extra columns whose names clash with results"""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en", None, 7, 1.5, b"x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_words long, score double, start binary")

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
