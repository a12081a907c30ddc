"""Every query with SQL against that SQL, over the smallest tables; and the registry without the optional parts."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from quarry.plans import registry

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return [plain(x) for x in v] if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    r = duck.execute(registry.SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = sorted(([plain(row[names.index(c)]) for c in cols] for row in r.fetchall()), key=str)
    got = sorted(([plain(row[c]) for c in cols] for row in df.collect()), key=str)
    assert got == want


def test_every_query_has_a_name_of_its_own():
    assert set(registry.SQL) <= set(registry.QUERIES)


def test_the_rest_works_without_the_optional_parts(tmp_path):
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT)
        if "llm" in rel.parts or rel.name == "corpus_pipeline.py" or rel.parts[0] == "tests":
            continue
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text(p.read_text())
    code = "import __spark_entry__ as e; n = e.queries(); assert n and 'pipeline' not in n and set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
