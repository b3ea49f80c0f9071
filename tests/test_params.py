"""Empty parameters are unset ones (SRC-6, FLT-1 ... FLT-4); salted joins refuse types they would get wrong."""

import pytest

from clickscope.operators.joins import salted_join, skew_join
from clickscope.params import SessionParams, task_params_table


def test_empty_parameters_are_unset(spark):
    text = '{"professionals":[""],"sex":[""],"keywords":[""],"startAge":[""],"endAge":[""],"targetPageFlow":[""]}'
    assert SessionParams.from_json(text) == SessionParams()
    row = task_params_table(spark.createDataFrame([(1, text)], "task_id long, task_param string")).first()
    assert row.asDict() == {**{k: None for k in row.asDict()}, "task_id": 1}


@pytest.mark.parametrize("how", ["right", "full", "outer"])
def test_salted_joins_refuse_right_and_full(spark, how):
    a, b = spark.range(3).withColumnRenamed("id", "k"), spark.range(4).withColumnRenamed("id", "k")
    for join in (salted_join, skew_join):
        with pytest.raises(ValueError):
            join(a, b, "k", how=how)
