import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
import check_oracle
from claimweave.workload import oracle
from claimweave.workload.queries import QUERIES

UNCHECKED = {"train_compare", "feature_ablation", "classify_pairs"}
FITTED = sorted(UNCHECKED)


def test_every_query_has_sql_unless_it_fits_models():
    assert set(QUERIES) - set(oracle.oracle_sql()) == UNCHECKED
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["split", "field_variant", "query_id", "doc_id"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check_oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - UNCHECKED))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    assert check_oracle.compare(spark, duck, name, sf_dir) is None


def test_library_avoids_what_does_not_scale():
    root = Path(contract.__file__).parent / "claimweave"
    for path in root.rglob("*.py"):
        code = path.read_text()
        if path.relative_to(root).parts[0] == "llm":  # has its own guard
            continue
        assert not re.search(r"crossJoin|localCheckpoint|toPandas|\.rdd\b|@F\.udf|applyInPandas|tempfile|mkdtemp", code), path
        assert "claimweave.llm" not in code, path
