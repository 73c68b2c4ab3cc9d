"""Results do not depend on the session time zone (all timestamps are
TIMESTAMP_NTZ; whole-unit differences avoid the zone-dependent
``timestampdiff``).  1995-10-15 00:00 does not exist in America/Sao_Paulo."""

import pytest

from tessera.plans.queries import all_queries
from tessera.sources.adapter import AS_OF, DriverSources
from tessera.sources.driver import DriverTables
from tests.conftest import SF_SMALL

NAMES = ["vw_glpi_tickets", "vw_fact_asset_financials", "vw_backlog_open", "page_asset_drillthrough",
         "vw_fact_projects", "ti_ticket_volume"]


def _rows(spark, name):
    src = DriverSources(DriverTables(spark, SF_SMALL), AS_OF)     # fresh plans, analysed in the current zone
    return sorted(map(repr, all_queries()[name](src, AS_OF).collect()))


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_dst_zone(spark, name):
    base = _rows(spark, name)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        other = _rows(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other
