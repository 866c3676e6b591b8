"""Two callers of one ledger: every partition goes to one of them."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest

from tests.conftest import rows
from urbanlake.operators import control
from urbanlake.plans import claims

NOW = datetime(2024, 1, 1)


def seeded(spark, store):
    spans = spark.createDataFrame([("taxi", date(2023, 1, 1), date(2023, 8, 1)), ("air", date(2023, 1, 1), date(2023, 2, 1))], "source_name string, first_day date, last_day date")
    return claims.change_ledger(spark, store, lambda ledger: control.seed(ledger, spans, NOW))


def test_interleaved_claims(spark, scratch):
    store = scratch + "/ledger"
    assert claims.read_ledger(spark, store).ledger.count() == 0
    seeded(spark, store)
    # Both read the same version; one commits, the other finds the ledger moved.
    one, two = claims.read_ledger(spark, store), claims.read_ledger(spark, store)
    claims.commit_ledger(spark, store, one.version, control.claim(one.ledger, "taxi", "bronze", NOW, 3))
    with pytest.raises(claims.LedgerMoved):
        claims.commit_ledger(spark, store, two.version, control.claim(two.ledger, "taxi", "bronze", NOW, 3))
    assert claims.read_ledger(spark, store).version == one.version + 1
    assert claims.claim(spark, store, "taxi", "bronze", NOW, 3) == ["2023-04", "2023-05", "2023-06"]


def test_claims_side_by_side(spark, scratch):
    store = scratch + "/ledger"
    seeded(spark, store)
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: claims.claim(spark, store, "taxi", "bronze", NOW, 2), range(4)))
    assert sorted(key for keys in found for key in keys) == [f"2023-0{m}" for m in range(1, 9)]
    ledger = claims.read_ledger(spark, store).ledger
    assert rows(ledger.groupBy("source_name", "status").count()) == [("air", "pending", 2), ("taxi", "running", 8)]


def test_claim_and_finish(spark, scratch):
    store = scratch + "/ledger"
    seeded(spark, store)
    assert claims.claim(spark, store, "air", "bronze", NOW) == ["2023-01", "2023-02"]
    assert claims.claim(spark, store, "air", "bronze", NOW) == []
    results = spark.createDataFrame([("air", "2023-01", "succeeded", 5, None)], "source_name string, partition_key string, new_status string, rows_written bigint, message string")
    claims.finish(spark, store, results, "bronze", NOW, cascade=True)
    assert claims.claim(spark, store, "air", "silver", NOW) == ["2023-01"]
    first = claims.read_version(spark, store, 1)
    assert first.where("status = 'running'").count() == 0


def test_a_ledger_that_keeps_moving(spark, scratch, monkeypatch):
    store = scratch + "/ledger"
    seeded(spark, store)

    def moved(*_):
        raise claims.LedgerMoved("moved")

    monkeypatch.setattr(claims, "commit_ledger", moved)
    with pytest.raises(claims.LedgerMoved):
        claims.claim(spark, store, "taxi", "bronze", NOW, 1)
