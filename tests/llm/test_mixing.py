import pytest
from pyspark.sql import functions as F

from callcast.llm import mixing as M

ROWS = [(i, "w " * (1 + i % 7), ["s0", "s0", "s0", "s1", None][i % 5], ["en", "de", "en"][i % 3], 1 + i % 7) for i in range(600)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string, tokens long")


def test_raked_cells_meet_all_margins(spark, docs):
    cells = M.cell_table(docs, ["source", "lang"], "tokens")
    want = {"source": M.tempered(cells, "source", 0.5), "lang": spark.createDataFrame([("en", 0.3), ("de", 0.7)], "value string, share double")}
    out = M.rake(cells, want, rounds=30).collect()
    whole = sum(r.tokens for r in out)
    for m, t in want.items():
        for r in t.collect():
            assert sum(x.weight for x in out if x[m] == r.value) == pytest.approx(r.share * whole, rel=1e-6)


def test_chances_and_draw(docs):
    out = M.sample(docs, ["source", "lang"], {"source": 0.5, "lang": 0.5}, keep_share=0.4).collect()
    assert len(out) == 600 and all(0 <= r.prob <= 1 for r in out)
    whole = sum(r.tokens for r in out)
    assert sum(r.tokens * r.prob for r in out) == pytest.approx(0.4 * whole, rel=1e-5)
    assert sum(r.tokens for r in out if r.kept) == pytest.approx(0.4 * whole, rel=0.2)
    again = M.sample(docs.repartition(9), ["source", "lang"], {"source": 0.5, "lang": 0.5}, keep_share=0.4).collect()
    assert {(r.doc_id, r.kept) for r in out} == {(r.doc_id, r.kept) for r in again}


def test_saturated_cells_and_whole_corpus(docs):
    out = M.sample(docs, ["source"], {"source": 0.0}, keep_share=0.9).collect()
    assert sum(r.tokens * r.prob for r in out) == pytest.approx(0.9 * sum(r.tokens for r in out), rel=1e-5)
    assert max(r.prob for r in out) == 1.0
    assert all(r.kept for r in M.sample(docs, ["source"], {"source": 1.0}, keep_share=1.0).collect())


def test_edge_rows(spark, edge_docs, no_docs):
    rows = edge_docs.withColumns({"tokens": M.token_count(F.col("text")), "topic": M.topic_of(F.coalesce("text", F.lit(""))), "Kept": F.lit("x")})
    out = M.sample(rows, ["source", "lang", "topic"], {"source": 0.5, "lang": 0.5, "topic": 0.5})
    assert out.count() == edge_docs.count() and out.where("prob IS NULL OR kept IS NULL").count() == 0
    assert len({(r.prob, r.kept) for r in out.collect() if r.doc_id == 6}) == 1
    assert [r.tokens for r in rows.where("doc_id IN (2, 3, 4)").collect()] == [1, 1, 1]
    none = no_docs.withColumn("tokens", F.lit(1).cast("long"))
    assert M.sample(none, ["source"], {"source": 0.5}).count() == 0


def test_value_without_target_is_never_sampled(spark, docs):
    cells = M.cell_table(docs, ["lang"], "tokens")
    out = {r.lang: r.weight for r in M.rake(cells, {"lang": spark.createDataFrame([("en", 1.0)], "value string, share double")}).collect()}
    assert out["de"] == 0 and out["en"] == pytest.approx(sum(r[4] for r in ROWS))


def test_bounded_cells_meet_all_margins(spark):
    """Cells that are too small for their share go in whole, and the others of their margins make up for them."""
    tokens = {("a", "x"): 50.0, ("a", "y"): 950.0, ("b", "x"): 100.0, ("b", "y"): 200.0, ("c", "x"): 400.0, ("c", "y"): 300.0}
    cells = spark.createDataFrame([(*k, v) for k, v in tokens.items()], "m string, n string, tokens double")
    want = {"m": spark.createDataFrame([("a", 0.4), ("b", 0.25), ("c", 0.35)], "value string, share double"), "n": spark.createDataFrame([("x", 0.4), ("y", 0.6)], "value string, share double")}
    out = M.rake(cells, want, rounds=60, keep_share=0.5, tolerance=1e-8).collect()
    assert all(0 <= r.weight <= r.tokens for r in out) and any(r.weight == r.tokens for r in out)
    for m, t in want.items():
        for r in t.collect():
            assert sum(x.weight for x in out if x[m] == r.value) == pytest.approx(r.share * 1000, abs=1e-4)


def test_margin_value_that_is_too_small_goes_in_whole(spark, docs):
    drawn = M.sample(docs, ["source"], {"source": 0.0}, keep_share=0.9)
    want = {"source": M.tempered(M.cell_table(docs, ["source"], "tokens"), "source", 0.0)}
    rows = {r.value: r for r in M.reached(drawn, want).collect()}
    whole = sum(r[4] for r in ROWS)
    assert set(rows) == {"s0", "s1", None} and all(r.target == pytest.approx(1 / 3) for r in rows.values())
    for v in ("s1", None):  # a third of nine tenths is more than a fifth
        assert rows[v].share * 0.9 * whole == pytest.approx(sum(r[4] for r in ROWS if r[2] == v), rel=1e-5)
    assert sum(r.share for r in rows.values()) == pytest.approx(1)


def test_few_cells_are_raked_without_shuffles_and_many_with_them(spark, docs, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    written, kept = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: written.append((name, plan(df))) or kept(df, name))
    few = {r.doc_id: r.prob for r in M.sample(docs, ["source", "lang"], {"source": 0.5, "lang": 0.5}).collect()}
    raked = [p for n, p in written if n == "mixing-raked"]
    assert raked and not any("hashpartitioning" in p for p in raked)
    written.clear()
    monkeypatch.setattr(M, "FEW_CELLS", 2)
    many = {r.doc_id: r.prob for r in M.sample(docs, ["source", "lang"], {"source": 0.5, "lang": 0.5}).collect()}
    assert any("hashpartitioning" in p for n, p in written if n == "mixing-raked")
    assert few.keys() == many.keys() and all(few[i] == pytest.approx(many[i], abs=2e-9) for i in few)
