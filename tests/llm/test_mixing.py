import pytest
from helpers import nothing, odd, odd_rows, space_split

from basketry.llm import mixing


def shared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing what is over, again and again."""
    target = [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, todo = share * sum(sizes), set(range(len(sizes)))
    while todo and left > 1e-9:
        total = sum(weight[i] for i in todo)
        full = {i for i in todo if left * weight[i] / total >= most * sizes[i]}
        if not full:
            for i in todo:
                target[i] = left * weight[i] / total
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        todo -= full
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 3, 70, 0, 9], [7], [0, 0], [10, 1, 1, 1000, 30, 2, 2]])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size bigint")
    found = {r.source: r.target for r in mixing.targets(table).collect()}
    for i, want in enumerate(shared(sizes)):
        assert abs(found[f"s{i}"] - want) < 1e-6


def test_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{min(i % 9, 4)}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    found = mixing.mix_report(table).toPandas()
    assert (found.taken <= 2 * found["size"]).all()
    by_source = found.merge(spark.createDataFrame(rows, "doc_id bigint, t string, source string").drop("t").toPandas()).groupby("source")
    for _, part in by_source:
        assert part.source_size.iloc[0] == part["size"].sum()
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 100
    again = mixing.mix_report(table.repartition(3)).toPandas()
    assert found.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_odd_documents(spark):
    found = mixing.copies(odd(spark)).collect()
    assert len(found) == len(odd_rows())
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(r[0]), len(space_split(r[1]))) for r in odd_rows())
    mix = mixing.mixed(odd(spark))
    assert mix.columns == odd(spark).columns
    assert mix.count() == sum(r.copies for r in found)
    words = sum(len(space_split(r.text)) for r in mix.collect())
    assert words == sum(r.copies * r.size for r in found)
    assert mixing.mix_report(nothing(spark)).collect() == []
    assert mixing.mixed(nothing(spark)).collect() == []
