import __spark_entry__ as contract


def test_entry_and_names(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["dominio", "corte", "valor_ajustado"] and rows.count() > 0
    own = {name for name in contract.queries() if not (name == "pipeline" or name.startswith("op"))}
    assert own <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
