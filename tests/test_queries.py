"""Registered queries against their SQL on the smallest set; the larger sets are checked by oracle_check.py."""

import duckdb
import pytest
from oracle_check import TABLES, compare

import __spark_entry__ as entry_module
from headway.plans import registry

FOLDER = "/root/testdata/sf0.001"
NAMES = ("stops_in_regions", "connections", "delay_quantile_tables", "connection_success", "label_dominance", "latest_departure_rounds",
         "ranked_routes", "confidence_breakdown", "replayed_success", "pit_values", "external_journeys_to_legs",
         "monotonicity_check", "robust_vs_deterministic", "feasibility_audit", "feasibility_at_stops", "ranked_alternatives", "service_days",
         "itineraries_on_date", "one_transfer_itineraries", "one_transfer_within_wait", "latest_transfers")


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    made.sql("SET TimeZone='UTC'")
    for t in TABLES:
        made.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return made


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    queries = entry_module.queries()
    ok, note = compare(spark, con, FOLDER, name, queries[name], registry.oracle_texts(slow=True)[name])
    assert ok, note


def test_entry(spark):
    assert entry_module.entry(spark).columns[:3] == ["query_id", "start_id", "end_id"]


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
