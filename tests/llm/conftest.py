"""Fixtures for the text operators."""

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]
# Python workers import the package by name.
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from texts import awkward_texts, frame  # noqa: E402

@pytest.fixture(scope="session")
def awkward(spark):
    return frame(spark, awkward_texts())


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, []).limit(0)
