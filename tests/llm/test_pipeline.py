"""The pipeline, stage by stage, and the registered queries."""

import pytest
from test_jaccard import brute

import corpus_pipeline
from compare import difference, oracle
from pluvio.llm import quality, queries, toxicity
from pluvio.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_ways(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept, results = docs, []
    for _, fn in corpus_pipeline.STAGES:
        kept = fn(spark, kept, SF)
        results.append(kept)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
    assert all(r.columns == docs.columns for r in results[:-1])
    one, two, three = ({r.doc_id: r.text for r in x.collect()} for x in results[:3])
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"]).collect()}
    assert set(one) == {d for d, s in scores.items() if s < 0.5}
    good = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels), ["doc_id"]).collect()}
    assert set(two) == {d for d in one if good[d] >= 0.3}
    groups = brute(sorted(two.items()), 5, 80)
    assert set(three) == {d for d, _, c in groups if d == c}
    packed = results[3].toPandas()
    assert set(packed.doc_id) == set(three)
    fill = packed.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and len(fill) <= -(-fill.sum() // 2048) + 1


def test_repeated_and_null_rows_in_the_join_stage(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", "y", 1), (1, "a b c d e f", "x", "y", 1), (2, "A b c d e f", "x", "y", 1), (None, "a b c d e f", None, None, None),
                                  (3, None, "x", "y", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_one_of_group(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "3", "None"]


def test_ids_of_several_texts_in_the_join_stage(spark):
    """A clean text stays although another row of its id goes; linked texts of one id leave one; copies of null ids are one."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base, "b"), (2, base.upper(), "b"), (2, "a clean text of its own", "c"), (2, "a clean text of its own", "a"),
            (3, "z " + " ".join(f"v{k}" for k in range(60)), "b"), (3, " ".join(f"v{k}" for k in range(60)), "b"), (4, None, "b"), (4, "", "b"),
            (None, "copies of null id here", "d"), (None, "copies of null id here", "c"), (None, None, "d"), (None, None, "d")]
    want = None
    for docs in (rows, rows[::-1]):
        frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
        got = sorted((tuple(r) for r in corpus_pipeline.keep_one_of_group(spark, frame, SF).collect()), key=str)
        want = want or got
        assert got == want
    assert [r[0] for r in got].count(3) == 1 and len(got) == 7
    assert {(1, base, "b"), (2, "a clean text of its own", "a"), (4, None, "b"), (4, "", "b"), (None, "copies of null id here", "c"), (None, None, "d")} < set(got)


def test_texts_that_stay_are_not_shuffled_in_the_join_stage(spark):
    """Only rows whose document goes or comes twice are brought together; the texts of others are not."""
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(40))) for k in range(300)] + [(300, "a b c d e f g"), (301, "A b c d e f g"), (7, " ".join(f"w7x{i}" for i in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.keep_one_of_group(spark, docs, SF)
    assert sorted(r.doc_id for r in got.collect()) == list(range(301))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Aggregate" not in plan[:plan.index("Join LeftAnti")].split("+-")[1]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    sql = oracle(SF).sql(queries.ORACLES[name]).df()
    assert difference(queries.QUERIES[name](spark, SF).toPandas(), sql) is None
