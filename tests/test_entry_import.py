"""The entry must work in a process that has no session, no jars next to pyspark and another working directory."""

import os
import subprocess
import sys

from pyspark.ml.feature import StopWordsRemover

from reviewmill.queries.classify import STOP_WORDS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_without_spark_files(tmp_path):
    code = f"""
import sys, pyspark
pyspark.__file__ = {str(tmp_path / "nothing" / "__init__.py")!r}
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) >= 99


def test_stop_words_are_those_of_spark(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
