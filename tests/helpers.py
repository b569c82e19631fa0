"""Helpers shared by the test modules (a name of its own, so that no other
folder's ``conftest`` can stand in its place)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FIX = os.path.join(ROOT, "tests", "fixtures")


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
