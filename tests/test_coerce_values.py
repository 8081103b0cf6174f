"""The coercion query covers every accepted row of both tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from larkspur.plans.queries import _routed
from larkspur.sources.catalog import PACKAGE_CATALOG, load_catalog, specs_from_catalog
from tests.conftest import SF001


def test_every_declared_attribute_of_every_accepted_row(spark):
    got = E.queries()["coerce_values"](spark, SF001).cache()
    accepted = {
        (r["namespace"], r["type"]): r["n"]
        for r in _routed(spark, SF001).where("reason is null").groupBy("namespace", "type").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    fields = {(s.namespace, s.table_name, name): dt for s in specs_from_catalog(load_catalog(spark, PACKAGE_CATALOG)) for _, name, dt in s.fields}
    cells = {
        (r["namespace"], r["type"], r["column_name"]): (r["n"], r["data_type"])
        for r in got.groupBy("namespace", "type", "column_name", "data_type").agg(F.sum("n").alias("n")).collect()
    }
    assert {t for _, t, _ in fields} == {"page_actions", "alarms"}
    assert cells == {k: (accepted[k[:2]], dt) for k, dt in fields.items()}
    # a natural value beside the probes, and text beside a number of the same digits
    assert got.where("column_name = 'active' and raw_text = 'false' and value_text = 'false'").count() == 1
    assert {r["raw_text"] for r in got.where("type = 'page_actions' and column_name = 'count' and value_text = '10'").collect()} >= {"10", '"10"', "10.0"}
