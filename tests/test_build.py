import duckdb
import pytest

from compare import compare, connect
from conftest import FOLDER
from loanloom.catalog import present
from loanloom.oracles import all_statements
from loanloom.plans.build import broken_rows, build, row_rules
from loanloom.samples.lending import COHORT, CUTOFF, RawTables
from loanloom.sources.bronze import EXTRACTS, write_csv
from loanloom.sources.layers import Layers


@pytest.mark.slow
def test_build_from_csv(spark, tmp_path):
    """CSV files in, stored tables and exports out, with the same results."""
    source, target = str(tmp_path / "extracts"), str(tmp_path / "lake")
    raw = RawTables(spark, FOLDER)
    for name in EXTRACTS:
        write_csv(raw[name], f"{source}/{name}.csv")
    counts = build(spark, source, target, CUTOFF, COHORT)
    # The sample reverses some payments twice on purpose; nothing else is wrong.
    assert len(counts) == 49
    assert {rule for rule, n in counts.items() if n} == {"reversals resolve"}

    con, sql = connect(FOLDER), all_statements()
    for layer, name in (
        ("silver", "int_installment_status"),
        ("gold", "agg_merchant_monthly"),
        ("gold", "dm_loan_delinquency_snapshot"),
    ):
        stored = spark.read.parquet(Layers(spark, target).current(layer, name))
        assert compare(present(stored), con, sql[name]) == "", name
    exported = duckdb.sql(
        f"select * from read_csv('{target}/exports/q5_par30_balance/*.csv', header=true)"
    ).fetchall()
    assert exported == con.execute(sql["q5_par30_balance"]).fetchall()


def test_row_rules_count_each_breach(spark):
    rows = [(None, "COP", "DISBURSED", 1.0), (2, "EUR", None, -1.0), (3, "USD", "GONE", None)]
    df = spark.createDataFrame(rows, "loan_id long, currency string, status string, principal_usd double")
    counts = {r.rule: r.n_violations for r in broken_rows(df, row_rules()["fct_loan"]).collect()}
    assert counts == {
        "not_null fct_loan.loan_id": 1,
        "not_null fct_loan.principal_usd": 1,
        "accepted fct_loan.currency": 2,
        "accepted fct_loan.status": 1,
        "not_negative fct_loan.principal_usd": 1,
    }
