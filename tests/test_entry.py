"""The driver's contract, with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def told(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, env={"PYTHONPATH": str(folder), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=False)


@pytest.fixture
def bare(tmp_path):
    """The repository without the two folders of the operators; the pipeline's file may still be there."""
    for folder in ("hirelens", "tests"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / file).exists():
            shutil.copy(ROOT / file, tmp_path)
    return tmp_path


def test_without_the_operators(bare):
    run = told(bare, "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))")
    assert run.returncode == 0, run.stderr
    many, told_, some = run.stdout.split()
    assert int(many) > 70 and int(told_) > 70 and some == "False"


def test_tests_without_the_operators(bare):
    """Nothing left needs what is gone: every test module can be collected."""
    run = told(bare, "import sys, pytest; sys.exit(pytest.main(['-q', '--collect-only', '-p', 'no:cacheprovider', 'tests']))")
    assert run.returncode == 0, run.stdout + run.stderr


def test_errors_inside_the_operators_show(bare):
    (bare / "hirelens" / "llm").mkdir()
    assert told(bare, "import __spark_entry__").returncode == 0
    (bare / "hirelens" / "llm" / "__init__.py").write_text("")
    (bare / "hirelens" / "llm" / "queries.py").write_text("import no_such_module")
    run = told(bare, "import __spark_entry__")
    assert run.returncode and "no_such_module" in run.stderr


def test_a_cluster_needs_a_shared_folder():
    from hirelens.functions.shared import shared_dir

    class Session:
        def __init__(self, master, folder=None):
            self.conf, self.sparkContext = self, self
            self.master, self.folder = master, folder

        def get(self, key, default):
            return self.folder or default

        def set(self, key, value):
            self.folder = value

    assert shared_dir(Session("local[4]")) and shared_dir(Session("local")) and shared_dir(Session("local[*]"))
    assert shared_dir(Session("yarn", "hdfs:///x/")) == "hdfs:///x"
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master))


def test_temporary_folders_are_deleted(spark):
    from hirelens.functions import shared

    before = shared.folders()
    with shared.temporary():
        rows = shared.written(spark.range(3), "numbers")
        path = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert rows.count() == 3 and Path(path).is_dir() and len(shared.folders()) == len(before) + 1
    assert not Path(path).exists() and shared.folders() == before
