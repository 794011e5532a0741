"""What the entry does without the text operators, and without a folder to write to."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from tallyframe.plans import FOLDER_SETTING

HERE = Path(__file__).resolve().parents[1]
WITHOUT = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as e
print(len(e.queries()), any(n.startswith("op") or n == "pipeline" for n in e.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["tokenizers", "tallyframe.llm"])
def test_other_queries_stay_if_the_text_operators_cannot_be_imported(name):
    said = subprocess.run(
        [sys.executable, "-c", WITHOUT.format(name=name)], cwd=HERE, capture_output=True, text=True, check=True
    )
    assert said.stdout.split() == [str(len(entry_module._registry())), "False"]


class Settings(dict):
    conf = property(lambda self: self)

    def set(self, name, value):
        self[name] = value


@pytest.mark.parametrize(
    ("master", "warehouse", "folder"),
    [
        ("local[8]", "file:/home/w", "file:/home/w/work"),
        ("local", "/home/w", "/home/w/work"),
        ("local-cluster[2,1,900]", "file:/home/w", None),
        ("spark://host:7077", "/home/w", None),
        ("yarn", "hdfs://store/w", "hdfs://store/w/work"),
    ],
)
def test_a_folder_of_one_machine_is_no_shared_folder(master, warehouse, folder):
    settings = Settings({"spark.master": master, "spark.sql.warehouse.dir": warehouse})
    entry_module._name_folder(settings)
    assert settings.get(FOLDER_SETTING) == folder
    named = Settings({"spark.checkpoint.dir": "hdfs://c", "spark.master": master})
    entry_module._name_folder(named)
    assert FOLDER_SETTING not in named
