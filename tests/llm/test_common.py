import pytest

from tidelog.llm import common


@pytest.mark.parametrize("hot", [1, 10, 1000])
def test_hot_and_other_groups_are_joined_alike(spark, monkeypatch, hot):
    """With none, the large, and all groups broadcast; values without a group, and null ones, go."""
    monkeypatch.setattr(common, "HOT", hot)
    values = [None] * 5 + ["big"] * 300 + ["mid"] * 40 + ["two"] * 2 + ["one"]
    rows = spark.createDataFrame(list(enumerate(values)), "id long, v string").repartition(5)
    groups = spark.createDataFrame([(v, values.count(v), v.upper()) for v in ("big", "mid", "two")], "v string, n long, name string")
    made = common.join_groups(rows, groups, "v", len(values)).select("id", "name").collect()
    assert sorted(tuple(r) for r in made) == [(i, v.upper()) for i, v in enumerate(values) if v in ("big", "mid", "two")]
