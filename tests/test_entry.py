"""The driver's contract."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 5 and "mean" in df.columns


def test_names_are_unique_and_sql_has_queries():
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert {"p1_found", "p5_found", "p6_found"} <= set(names)


def test_core_doesnt_import_llm():
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "curatella"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "curatella.llm" not in f.read_text(), f
