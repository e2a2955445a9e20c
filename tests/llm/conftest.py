import pytest

from matchbook.session import checkpoint_dir


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and blank texts, repeats, ties, a very long text, and extra columns with clashing names."""
    checkpoint_dir(spark)
    base = " ".join(f"word{i % 37}x{i}" for i in range(120))
    near = base.replace("word3x3 ", "changed ")
    rows = [
        (1, base, "en"), (2, base, "en"), (2, base, "en"), (3, near, "en"), (4, "", None), (5, None, "fr"), (6, " \n\t ", "en"),
        (None, "no id here", "en"), (7, "1234 !!", "en"), (8, "long " * 60_000, "en"), (9, "mail a@b.co, ip 10.0.0.1 é", "fr"),
    ]
    rows = [(*r, "src", 0.5, True, "x", 9) for r in rows]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, score double, kept boolean, class string, row bigint"
    ).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
