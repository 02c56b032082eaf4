from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opinionlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture(scope="session")
def small_posts(spark):
    """A few hundred posts with every awkward value, and the same rows in Python."""
    import random

    rng = random.Random(7)
    words = ["vote", "blue", "red", "tax", "jobs", "the", "economy", "border", "it", "health", "economy's"]
    tags = ["#Vote", "#vote", "maga", "#", "x", "#Blue2024", "'q1'"]
    rows = []
    for i in range(400):
        rows.append(
            (
                i,
                rng.choice([None, "u1", "u1", "u1", "u2", "u3", f"u{i % 30}"]),
                " ".join(rng.choices(words, k=rng.randint(0, 12))),
                ";".join(rng.choices(tags, k=rng.randint(0, 4))),
                rng.choice(["Reno", "Reno", "Troy", "Unknown"]),
                rng.choice(["Nevada", "Michigan", "Unknown"]),
                rng.choice([None, 0, 1, 1]),
                rng.choice([None, "2024-09-01", "2024-09-02"]),
            )
        )
    schema = "post_id int, user_id string, text string, hashtags string, city string, state string, binary_label int, date string"
    df = spark.createDataFrame(rows, schema).withColumn("date", _to_date())
    names = [f.name for f in df.schema]
    return df.cache(), [dict(zip(names, r)) for r in rows]


def _to_date():
    from pyspark.sql import functions as F

    return F.to_date("date")
