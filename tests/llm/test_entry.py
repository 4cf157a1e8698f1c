import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E
from quarry.llm import common, queries


def test_every_operator_is_registered():
    names = E.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)
    assert set(queries.ORACLE_SQL) <= set(E.oracle_sql())


def test_library_does_not_import_the_subpackage():
    code = "import sys, quarry.jobs, quarry.plans.catalog, quarry.streaming; print([m for m in sys.modules if m.startswith('quarry.llm')])"
    out = subprocess.run([sys.executable, "-c", code], cwd=E._ROOT, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "[]"


@pytest.mark.parametrize("pipeline", [True, False])
def test_a_copy_without_the_subpackage(tmp_path, pipeline):
    """With both folders deleted (and the pipeline there or not) the entry imports and the other tests are collected."""
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(E._ROOT, tmp_path / "copy", ignore=skip)
    (tmp_path / "copy" / "quarry" / "llm" / "__pycache__").mkdir(parents=True)  # as a deletion of the sources may leave it
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q), len(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    n, own, sql = map(int, out.stdout.split())
    assert n > 50 and own == 0 and sql > 50
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=tmp_path / "copy",
                           capture_output=True, text=True)
    assert found.returncode == 0, found.stdout[-2000:]


def test_words_follow_the_rules():
    text = "Ab\x1ccD Ä x\x0by Zİ 1-2_3 é'K"
    import re
    lower = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    assert [w.decode() for w in common.space_words(text)] == re.findall(common.SPACE_WORD, lower)
    assert [w.decode() for w in common.alnum_words(text)] == re.findall(common.ALNUM_WORD, lower)
    assert common.space_words(None) == common.alnum_words("") == []


def test_fresh_names():
    assert common.fresh(["a", "_A"], "a") == "__a" and common.fresh(["b"], "a") == "a"
