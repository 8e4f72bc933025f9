import pytest

TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs far away from here, every single day of the week.",
    "the quick brown fox jumps over the lazy dog and runs far away from here every single day of the week",
    "mail me at bob.smith@example.com or call +1 (017) 555-7713 now, host 10.0.0.1 card 4111 1111 1111 1111",
    "user=alice99 pwd=hunter22 host=db.example.com token = \"abcdef123456\"",
    "",
    None,
    "   \n\t ",
    "<|endoftext|> special <|endoftext|>x  strings  and 　 wide blanks  ",
    "word " * 3000,
    "x" * 40000,
    "é" * 9000 + " ü " * 9000,
    "1.2.3.4.5.6.7.8 a@b.c_d@e.f 999999999999 " * 40,
]


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like those the operators use."""
    rows = [(k, text, "en", "s", len(text or ""), k, True, "id", 1.5) for k, text in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, TEXTS[0], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row long, keep boolean, id string, `a.b` double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
