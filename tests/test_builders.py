"""Every table builder: empty inputs give an empty output with the table's schema."""

import pytest
from pyspark.sql import functions as F

from tamarind.queries.builders import CTX, QUERIES, adapter_inputs


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_inputs_give_empty_typed_output(spark, sf_dir, name):
    q = QUERIES[name]
    inputs = {k: v.where(F.lit(False)) for k, v in adapter_inputs(spark, sf_dir, q.spec, q.overrides).items()}
    out = q.spec.build(inputs, CTX)
    # names, order and types as declared (literal columns may come out non-nullable)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in q.spec.schema]
    assert out.count() == 0
