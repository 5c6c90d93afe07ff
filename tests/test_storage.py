import importlib.util
import subprocess
import sys
from pathlib import Path

from pagewright.sources import storage as st


def there(spark, path):
    target, files = st._located(spark, path)
    return files.exists(target)


def test_scopes_delete_what_is_not_kept(spark):
    with st.scratch_scope(spark) as outer:
        first = st.stored(spark.range(3), "first")
        with st.scratch_scope(spark) as inner:
            second, third = st.stored(spark.range(4), "second"), st.stored(spark.range(5), "third")
            inner.append(third)
        assert [there(spark, t._scratch_path) for t in (first, second, third)] == [True, False, True]
        outer.append(first)
    assert [there(spark, t._scratch_path) for t in (first, third)] == [True, False]
    assert first.count() == 3
    st.discard(first, spark.range(1))
    assert not there(spark, first._scratch_path)


def test_after_an_error_tables_stay(spark):
    try:
        with st.scratch_scope(spark):
            kept = st.stored(spark.range(2), "kept")
            raise KeyError
    except KeyError:
        assert kept.count() == 2 and not st._scopes


def test_the_entry_works_without_the_llm_folder(tmp_path):
    root = Path(__file__).resolve().parent.parent
    (tmp_path / "pagewright").mkdir()
    (tmp_path / "__spark_entry__.py").write_bytes((root / "__spark_entry__.py").read_bytes())
    for part in (root / "pagewright").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "pagewright" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), any(n.startswith('op') for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=120).stdout.split()
    assert int(said[0]) > 60 and said[1:] == ["[]", "False"]
    assert importlib.util.find_spec("pagewright.sources.storage")
