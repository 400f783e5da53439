"""One session for all tests and generated encounter rows (all values invented)."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def modelling_rows(spark):
    """300 encounters whose class depends on the age, in 3 partitions."""
    draw = random.Random(7)
    rows = []
    for i in range(300):
        age = draw.randint(0, 99)
        rows.append((
            i, i % 90, age, draw.randint(1, 14), draw.randint(0, 99), draw.randint(0, 9), draw.randint(0, 19),
            draw.randint(0, 9), draw.randint(0, 9), draw.randint(0, 9), draw.randint(1, 9),
            draw.choice(["Caucasian", "Asian", "Other"]), draw.choice(["Male", "Female"]),
            "YES" if age + draw.randint(-20, 20) > 60 else "NO",
        ))
    return spark.createDataFrame(rows, (
        "encounter_id long, patient_nbr long, age int, time_in_hospital int, num_lab_procedures int, "
        "num_procedures int, num_medications int, number_outpatient int, number_emergency int, "
        "number_inpatient int, number_diagnoses int, race string, gender string, readmitted string"
    )).repartition(3)
