"""Source-level rules: operators never bring rows to the driver, and use no Python UDFs."""

import pathlib
import re

OPS = pathlib.Path(__file__).resolve().parent.parent / "sparkplate"


def _sources():
    found = {p.relative_to(OPS).as_posix(): p.read_text() for p in OPS.rglob("*.py")}
    return {name: text for name, text in found.items() if not name.startswith("llm/")}


def test_no_row_collection_in_library():
    hits = []
    for name, text in _sources().items():
        for m in re.finditer(r"\.(collect|toPandas|toLocalIterator)\(", text):
            hits.append((name, text[max(0, m.start() - 120):m.end()]))
    assert not hits


def test_no_python_udfs_or_local_checkpoints():
    for name, text in _sources().items():
        assert "@udf" not in text and "F.udf(" not in text and "pandas_udf" not in text, name
        assert "localCheckpoint" not in text, name
        assert ".rdd.map" not in text and "mapPartitions" not in text, name


def test_entry_survives_missing_optional_libraries():
    """Each library that only the optional subpackage needs may be absent."""
    import subprocess
    import sys

    root = str(OPS.parent)
    for name in ("sparkplate.llm", "corpus_pipeline", "public_tokenizers", "numpy.no_such", "xxhash", "zstandard", "tokenizers"):
        code = (f"import sys; sys.path.insert(0, {root!r}); sys.modules[{name!r}] = None\n"
                "import __spark_entry__ as e\nfrom sparkplate.plans.registry import QUERIES\n"
                "assert set(QUERIES) <= set(e.queries()) and len(QUERIES) > 120, len(QUERIES)")
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
        assert done.returncode == 0, (name, done.stderr[-500:])
