"""Shared fixtures: one local session, scratch folders, generated CSV tables."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowcast.plans.jobs import FEATURES  # noqa: E402

GRADE = "quality"
SCRATCH = tempfile.mkdtemp(prefix="rowcast-tests-")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("rowcast-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Tests set their own shared folder; on a cluster it is given.
        .config("spark.checkpoint.dir", f"{SCRATCH}/checkpoints")
        # A second file system, which only Spark's readers and writers reach.
        .config("spark.hadoop.fs.viewfs.mounttable.store.link./data", f"file://{SCRATCH}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never cleared; each run takes a new root)."""
    path = f"{SCRATCH}/{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def wine_rows(n: int, seed: int = 0, grades=(3, 4, 5, 6, 7, 8)) -> list[tuple]:
    """Generated rows in the reference's layout: 11 measures and a grade.

    The grade depends on alcohol and volatile acidity, so learners have
    signal to find.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        m = [
            round(rng.uniform(4.6, 15.9), 1),    # fixed acidity
            round(rng.uniform(0.12, 1.58), 3),   # volatile acidity
            round(rng.uniform(0.0, 1.0), 2),     # citric acid
            round(rng.uniform(0.9, 15.5), 1),    # residual sugar
            round(rng.uniform(0.012, 0.611), 3), # chlorides
            float(rng.integers(1, 72)),          # free sulfur dioxide
            float(rng.integers(6, 289)),         # total sulfur dioxide
            round(rng.uniform(0.990, 1.004), 4), # density
            round(rng.uniform(2.74, 4.01), 2),   # pH
            round(rng.uniform(0.33, 2.0), 2),    # sulphates
            round(rng.uniform(8.4, 14.9), 1),    # alcohol
        ]
        score = (m[10] - 8.4) / 6.5 * 4 - m[1] + rng.normal(0, 0.3)
        grade = int(np.clip(round(3 + score), min(grades), max(grades)))
        rows.append((*m, grade))
    return rows


def write_delimited_text(path: str, header: list[str], rows: list[tuple], sep: str = ";") -> str:
    """Write a delimited file byte for byte (headers exactly as given)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(sep.join(header) + "\n")
        for r in rows:
            f.write(sep.join("" if v is None else str(v) for v in r) + "\n")
    return path


@pytest.fixture
def wine_csv(scratch):
    """A 300-row ';' file with the reference's header."""
    return write_delimited_text(
        f"{scratch}/wine.csv", [*FEATURES, GRADE], wine_rows(300, seed=1)
    )
