import importlib.util
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_optional_part(tmp_path):
    """A copy without the llm folder and the pipeline still imports and registers the rest."""
    (tmp_path / "braidlake").mkdir()
    for source in (ROOT / "braidlake").rglob("*.py"):
        if "llm" not in source.relative_to(ROOT).parts:
            target = tmp_path / source.relative_to(ROOT)
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(source.read_bytes())
    (tmp_path / "__spark_entry__.py").write_bytes((ROOT / "__spark_entry__.py").read_bytes())
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op1_') for q in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    count, has_llm = said.stdout.split()
    assert int(count) > 80 and has_llm == "False"


def test_nothing_else_imports_llm():
    for source in (ROOT / "braidlake").rglob("*.py"):
        if "llm" not in source.relative_to(ROOT).parts:
            assert "llm" not in source.read_text()


def test_optional_part_is_registered_where_it_is():
    import __spark_entry__ as entry

    if importlib.util.find_spec("braidlake.llm.queries") if (ROOT / "braidlake/llm").is_dir() else False:
        assert sum(q.startswith("op") and q[2].isdigit() for q in entry.queries()) == 10
