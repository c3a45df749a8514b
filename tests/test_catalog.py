"""Each query of the catalog against its SQL in DuckDB, values and types."""

import duckdb
import pytest

from trivox.plans import catalog

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", catalog.queries())
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, D)
    made = duck.execute(catalog.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in made.description}
    columns = sorted(df.columns)
    assert columns == sorted(types)
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: "BOOLEAN" if t == "BOOL" else t for c, t in types.items()}
    names = [c[0] for c in made.description]
    want = sorted(repr([r[names.index(c)] for c in columns]) for r in made.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_training_data_is_apart():
    """Nothing outside the subpackage imports it, and without it the entry still has the engine's queries."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    for f in (root / "trivox").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "trivox.llm" not in f.read_text(), f
    code = "import sys; sys.modules['trivox.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 30 and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
