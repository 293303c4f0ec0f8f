import subprocess
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from citylode.catalog.oracles import ORACLES  # noqa: E402
from citylode.catalog.queries import REGISTRY  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("missing", [("citylode.llm", "corpus_pipeline"), ("public_tokenizers",), ("tokenizers",)])
def test_without_the_optional_subpackage(missing):
    code = (
        f"import sys; sys.modules.update(dict.fromkeys({missing!r}))\n"
        "import __spark_entry__ as e; print(len(e.queries()) == len(e.oracle_sql()) == len(e.REGISTRY))")
    root = Path(__file__).resolve().parent.parent
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "True"


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, duck, name):
    from collections import Counter
    df = contract.queries()[name](spark, SF)
    got_columns, got, _ = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(contract.oracle_sql()[name])
    want_columns, want, _ = rows_of([d[0] for d in result.description], result.fetchall())
    assert got_columns == want_columns
    assert Counter(got) == Counter(want)
