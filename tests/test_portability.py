"""The entry module works when loaded by path from another directory, and
the one Python UDF runs on workers that have no copy of the package."""
import os
import shutil
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
spec = importlib.util.spec_from_file_location('entry_by_path', {os.path.join(ROOT, '__spark_entry__.py')!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
rows = m.queries()['cuped_ttest_pvalue'](spark, {SF!r}).collect()
assert len(rows) == 2 and all(r.p_value is not None for r in rows)
print('OK')
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_entry_loaded_by_path_from_elsewhere():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="meridian-cwd-"),
                         env=env, capture_output=True, text=True, timeout=600)
    assert "OK" in out.stdout, out.stderr[-2000:]


CLEAN = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config(
    'spark.sql.shuffle.partitions', '4').getOrCreate()
assert spark.sparkContext.getCheckpointDir() is None
import __spark_entry__ as E
print('ROWS', E.entry(spark).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_entry_runs_without_any_spark_settings():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["SPARK_CONF_DIR"] = tempfile.mkdtemp(prefix="meridian-conf-")
    out = subprocess.run([sys.executable, "-c", CLEAN], cwd=tempfile.mkdtemp(prefix="meridian-cwd-"),
                         env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_cluster_without_shared_folder_is_refused():
    from meridian.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


ALONE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 40 and names >= set(entry.oracle_sql()), names
assert not any(n.startswith('op') or n == 'pipeline' for n in names), names
print('ALONE')
"""


@pytest.mark.parametrize("pipeline_file", [True, False])
def test_the_rest_stands_without_the_optional_subpackage(pipeline_file):
    """A copy of the repository without the optional folders: the entry file
    imports, and every remaining test module is collected."""
    copy = os.path.join(tempfile.mkdtemp(prefix="meridian-alone-"), "repo")
    leave = {"llm", ".git", "__pycache__", ".pytest_cache"} | (set() if pipeline_file else {"corpus_pipeline.py"})
    shutil.copytree(ROOT, copy, ignore=lambda _, names: leave & set(names))
    run = [sys.executable, "-c", ALONE, copy]
    out = subprocess.run(run, cwd=copy, capture_output=True, text=True, timeout=300)
    assert "ALONE" in out.stdout, out.stderr[-2000:]
    run = [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"]
    out = subprocess.run(run, cwd=copy, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "error" not in out.stdout.lower(), out.stdout[-2000:]
