"""The registry, and the pipeline's stages against brute force on a small table."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from callcast.llm.queries import ORACLE
from callcast.session import materialize
from callcast.sources.tables import table
from test_jaccard_join import brute as near_brute
from test_suffix_dedup import brute as cut_brute

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(ORACLE) <= set(E.oracle_sql())
    assert [s for s, _ in C.STAGES] == ["language_id", "near_duplicates", "suffix_array_dedup", "benchmark_decontamination", "source_mixture"]


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's result, written and read again."""
    docs, out = table(spark, SF, "documents"), {}
    for name, f in C.STAGES:
        docs = out[name] = materialize(f(spark, docs, SF), f"test-{name}")
    return out


def test_language_stage_keeps_clean_documents(spark, stages):
    docs = table(spark, SF, "documents")
    assert stages["language_id"].columns == docs.columns
    lettered = docs.where(F.col("text").rlike(r"\p{L}{8}")).count()
    assert stages["language_id"].count() >= 0.99 * lettered


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages["language_id"].collect()]
    want = {d for d, (c, _) in near_brute(rows).items() if c == d}
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == want


def test_repeated_passage_stage(stages):
    before = sorted((r.doc_id, r.text, r.n_chars) for r in stages["near_duplicates"].collect())
    want = {}
    for (d, t, n), (size, gone, _, kept) in zip(before, cut_brute([t.encode() for _, t, _ in before], C.PASSAGE_BYTES)):
        text = kept.decode("utf-8", "ignore") if gone else t
        if text or not gone:
            want[d] = (text, len(text) if gone else n)
    assert {r.doc_id: (r.text, r.n_chars) for r in stages["suffix_array_dedup"].collect()} == want


def test_passages_of_51_short_words_go_and_clean_texts_stay_whole(spark):
    word = lambda seed: " ".join(f"{chr(97 + (i * seed) % 26)}{chr(97 + (i * seed // 26) % 26)}{chr(97 + (i * i + seed) % 26)}" for i in range(51))
    shared = word(7)
    own = [" ".join(f"x{d}y{i * 31 % 997}" for i in range(120)) for d in range(6)]
    rows = [(d, f"{own[d]} {shared} {d}end" if d < 3 else own[d], "en", "a", 1) for d in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in C.repeated_passages(spark, docs, SF).collect()}
    assert len(shared.split()) == 51 and len(shared) == 203
    for d in range(6):
        assert (shared[3:-3] not in kept[d]) and own[d][:-4] in kept[d]
    assert all(kept[d] == own[d] for d in range(3, 6))


def test_decontamination_stage(spark, stages):
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    before = {r.doc_id: r.text for r in stages["suffix_array_dedup"].collect()}
    after = {r.doc_id for r in stages["benchmark_decontamination"].collect()}
    exact = {d for d, t in before.items() if any(i in t for i in items)}
    assert not exact & after and after <= set(before)
    flat = lambda s: " ".join(s.lower().split())
    lost = [d for d in set(before) - after if d not in exact]
    assert all(any(flat(i)[k : k + 20] in flat(before[d]) for i in items for k in range(0, len(flat(i)) - 20, 5)) for d in lost)


def test_mixture_stage(spark, stages, tmp_path):
    kept = stages["benchmark_decontamination"]
    kept.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, prob FROM ({ORACLE['op5_mixing']}) WHERE kept").fetchall()}
    got = {r.doc_id: r.prob for r in stages["source_mixture"].collect()}
    assert got == pytest.approx(want)
    assert stages["source_mixture"].columns == [*kept.columns, "topic", "tokens", "prob"]


def test_empty_and_edge_documents(spark, edge_docs, no_docs):
    columns = table(spark, SF, "documents").columns
    for docs in (edge_docs.withColumn("n_chars", F.length("text").cast("long")), no_docs.withColumn("n_chars", F.lit(1).cast("long"))):
        docs = docs.select(*columns)
        for _, f in C.STAGES:
            docs = materialize(f(spark, docs, SF), "test-edge")
        assert set(columns) <= set(docs.columns)
