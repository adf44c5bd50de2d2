"""Random strings against identifiers: what is found, what is left alone, and in what time."""

import math
import random
import string
import time
from pathlib import Path

import pytest

from tidemark.llm import secrets
from tidemark.llm.common import read


CORPUS = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def ratios(spark):
    """Of 2,500 given documents; fewer words give a weaker model."""
    if not Path(CORPUS).exists():
        pytest.skip("no given tables")
    docs = read(spark, CORPUS, "documents").limit(2_500)
    return secrets.log_ratios(secrets.transition_counts(docs, secrets.scan(docs)))


def looks_random(value, ratios):
    at, size = secrets.ALPHABET.index, len(secrets.ALPHABET)
    mean = sum(ratios[at(a) * size + at(b)] for a, b in zip(value, value[1:], strict=False)) / (len(value) - 1)
    return mean >= secrets.THRESHOLD * math.sqrt(max(1, secrets.FULL_LENGTH / len(value)))


@pytest.mark.parametrize(("characters", "length", "least"), [
    (string.ascii_letters + string.digits, 10, 0.85), (string.ascii_letters + string.digits, 24, 0.97),
    ("0123456789abcdef", 16, 0.9), (string.ascii_lowercase, 24, 0.7)])
def test_made_up_strings_are_found(ratios, characters, length, least):
    rng = random.Random(1)
    made = ["".join(rng.choice(characters) for _ in range(length)) for _ in range(400)]
    assert sum(looks_random(m, ratios) for m in made) >= least * len(made)


@pytest.mark.parametrize("value", ["2026-12-01", "2026-12-01T10-22", "0123456789", "192-168-0-1", "+49-30-123456",
                                   "org_apache_spark_sql", "user_name_2", "AWS_SECRET_ACCESS_KEY", "XMLHttpRequest"])
def test_dates_numbers_and_identifiers_are_left_alone(ratios, value):
    assert not looks_random(value, ratios)


def test_expression_equals_plain_python(spark, ratios):
    rng = random.Random(2)
    values = ["".join(rng.choice(secrets.ALPHABET) for _ in range(rng.randint(10, 60))) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = df.select("value", secrets.mean_ratio(df["value"], ratios).alias("mean")).collect()
    at, size = secrets.ALPHABET.index, len(secrets.ALPHABET)
    for r in got:
        steps = [round(ratios[at(a) * size + at(b)], 6) for a, b in zip(r["value"], r["value"][1:], strict=False)]
        assert math.isclose(r["mean"], sum(steps) / len(steps), rel_tol=1e-9, abs_tol=1e-12)


def test_a_very_long_token(spark):
    rng = random.Random(2)
    token = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(1_000_000))
    docs = spark.createDataFrame([(1, "plain words of a text"), (2, f"x {token} y"), (3, "more words")], "doc_id long, text string")
    secrets.digest(secrets.find_secrets(docs.where("doc_id <> 2"))).collect()      # warm
    start = time.perf_counter()
    assert secrets.digest(secrets.find_secrets(docs)).count() == 3
    assert len(secrets.digest(secrets.find_secrets(docs)).collect()) == 3
    assert time.perf_counter() - start < 60
