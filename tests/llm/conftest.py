"""Frames that every operator has to take: nulls, ties, repeated rows, odd texts, odd columns."""

import pytest

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def odd_rows():
    long = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] for i in range(9_000))
    base = " ".join(WORDS[(3 * i * i + i) % len(WORDS)] for i in range(60))
    texts = [
        None, "", " ", "\n\t ", "!!! ... 123", "word", "Word", "a b c d", base, base, base.upper(), base + " extra", "intro " + base,
        long, long, long[:-40], "é́ ﬁ Ⅷ ß İI ΣΑΣ", "x\x01y \x1c 　z", "<|endoftext|> a<|startoftext|>b", "two  spaces\n\nlines\r\n end ",
        "日本語 テキスト です ね はい", "🙂 🙂🙃", "don't we'll I'M 12,345.67", "a" * 50_000,
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s0", "s1", "é", None)[i % 4], i) for i, t in enumerate(texts)]
    rows += [(100, base, "en", "s0", 1), (100, base, "en", "s0", 1), (101, base, "fr", "s1", None), (None, base, None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names the operators use themselves."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, digest string, row int, shard string, size int, unit string"
    return spark.createDataFrame([(*r, 7, "d", 7, "s", 7, "u") for r in odd_rows()], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
