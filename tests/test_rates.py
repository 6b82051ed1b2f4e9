from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidelog import rules, schemas
from tidelog.operators.rates import currency_list, rates_to_events, sorted_events
from workload import logs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def payloads(spark):
    """Payloads made from the given customers and nations."""
    return logs.rate_payloads(spark, SMALL).cache()


def _plain(payloads, currencies):
    """The events by a walk over the JSON texts."""
    quotes = []
    for row in payloads.collect():
        p = json.loads(row.payload)
        quotes += [(p["base"], c, round(v, 6), p["date"]) for c, v in p["rates"].items() if not currencies or c in currencies]
    return quotes


@pytest.mark.parametrize("currencies", [(), ("GBP",), ("SEK", "USD", "XXX"), ("XXX",), rules.QUOTED_CURRENCIES])
def test_events_equal_a_walk_over_the_payloads(payloads, currencies):
    events = rates_to_events(payloads, currencies)
    assert events.columns == schemas.RATE_EVENT.fieldNames()
    got = events.select("base", "currency", "rate", "rate_date").collect()
    assert sorted(map(tuple, got)) == sorted(_plain(payloads, currencies))
    assert {r.event_type for r in events.collect()} <= {"exchange_rate"} and all(r.fetched_at for r in events.collect())


def test_order_for_display(payloads):
    rows = [(r.currency, r.rate_date, r.base) for r in sorted_events(rates_to_events(payloads, ())).collect()]
    assert rows == sorted(rows) and len(rows) > 100


def test_rates_have_six_digits(spark):
    text = json.dumps({"base": "N", "date": "2020-02-29", "rates": {"A": 2 / 3, "B": 1e-7}})
    rows = {r.currency: r.rate for r in rates_to_events(spark.createDataFrame([(text,)], "payload string"), ()).collect()}
    assert rows == {"A": 0.666667, "B": 0.0}


def test_no_sort_below_messages(payloads):
    plan = rates_to_events(payloads, ()).select(F.to_json(F.struct("currency")))._jdf.queryExecution().toString()
    assert "Sort" not in plan


@pytest.mark.parametrize("text, codes", [(" chf,Sek ,, nok", ("CHF", "SEK", "NOK")), ("", ()), (" , ", ())])
def test_currency_list(text, codes):
    assert currency_list(text) == codes
