import pytest


@pytest.fixture(scope="session")
def ship_llm(spark):
    from quarry.session import ship
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"
