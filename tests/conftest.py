import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

from corpuslens.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.ui.showConsoleProgress": "false",
    }
    session = local_session("8", "8g", 4, settings)
    yield session
    session.stop()


@pytest.fixture
def books(spark):
    """Texts to a ``(file_name, text)`` table, named b0, b1, ... unless names are given."""

    def make(*texts, **named):
        rows = [(f"b{i}", text) for i, text in enumerate(texts)] + list(named.items())
        return spark.createDataFrame(rows, "file_name string, text string")

    return make


@pytest.fixture
def dated(spark):
    def make(*rows):
        data = [(f"b{i}", author, year) for i, (author, year) in enumerate(rows)]
        return spark.createDataFrame(data, "file_name string, author string, release_year int")

    return make


@pytest.fixture
def small(monkeypatch, spark):
    """Sizes at which small inputs take the ways made for large ones."""
    from corpuslens.operators import influence, lookup, similarity

    monkeypatch.setattr(similarity, "BLOCK_DOCUMENTS", 7)
    monkeypatch.setattr(similarity, "BLOCK_POSTINGS", 60)
    monkeypatch.setattr(similarity, "SMALL_GROUP", 3)
    monkeypatch.setattr(similarity, "BIN_DOCUMENTS", 5)
    monkeypatch.setattr(influence, "GROUP_SLICE", 2)
    monkeypatch.setattr(influence, "SALT_SETS", 2)
    monkeypatch.setattr(lookup.join_lookup, "__defaults__", (6,))
