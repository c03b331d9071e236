import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillroll.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def session():
    spark = local_session("4")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def spark(session, request):
    """Every operator must give the same result with ANSI mode on and off."""
    session.conf.set("spark.sql.ansi.enabled", request.param)
    yield session
    session.conf.set("spark.sql.ansi.enabled", "true")
