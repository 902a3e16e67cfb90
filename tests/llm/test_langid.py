import random
import string
import tracemalloc

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import functions as F

from callcast.llm import langid
from callcast.llm.queries import QUERIES
from callcast.sources.tables import table

SF = "/root/testdata/sf0.01"


def test_query_contract_and_held_out_accuracy(spark):
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    truth = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.97
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_edge_rows(edge_docs, no_docs):
    out = langid.identify(edge_docs.withColumn("Score", F.lit("x"))).collect()
    assert len(out) == edge_docs.count()
    by = {r.doc_id: r for r in out}
    for d in (2, 3, 4, 5):
        assert (by[d].lang_pred, by[d].score, by[d].rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in out} <= {"en", "fr", "de", "und"}
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id in (1, 6)}) == 1
    assert langid.identify(no_docs).count() == 0


def test_nothing_to_learn_from(edge_docs):
    out = langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in out} == {"und"}


def test_label_source_and_id_are_not_inputs(spark):
    docs = table(spark, SF, "documents").limit(200)
    model = langid.fit(table(spark, SF, "documents"), row_key=F.col("doc_id"))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    other = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")}), model).collect()}
    assert plain == other


def test_foreign_script_is_rejected(spark):
    model = langid.fit(table(spark, SF, "documents"), row_key=F.col("doc_id"))
    far = spark.createDataFrame([(1, "съешь же ещё этих мягких французских булок да выпей чаю")], "doc_id long, text string")
    assert langid.predict(far, model).first().rejected


UNKNOWN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
}


def test_unknown_latin_script_and_random_letters_are_rejected_and_held_out_texts_kept(spark):
    rnd = random.Random(5)
    texts = list(UNKNOWN.values()) + [t[:60] for t in UNKNOWN.values()]
    for n in (5, 20, 50, 200, 1000):
        texts.append(" ".join("".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(2, 9))) for _ in range(n)))
    docs = table(spark, SF, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), row_key=F.col("doc_id"))
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.doc_id for r in got if not r.rejected] == []
    kept = langid.predict(docs.where(langid.held_out(F.col("doc_id")) & F.col("text").rlike("[a-z]")), model)
    assert kept.agg(F.avg(F.col("rejected").cast("int"))).first()[0] <= 0.01


def plain_prediction(text, model):
    """N-grams counted one by one in plain Python, cosine with every centroid, the first best language."""
    from callcast.llm.textops import mix

    low = [ord(c) if c.isalpha() else 0 for c in f" {text.lower()} "]
    cells = {}
    for n in (1, 2, 3):
        for i in range(n - 1, len(low)):
            g = low[i]
            for back in range(1, n):
                g = (low[i - back] * 0x1F0003**back + g) % (1 << 64)
            if g:
                cell = int(mix(np.array([(g * 4 + n) % (1 << 64)], dtype=np.uint64))[0]) >> 52
                cells[cell] = cells.get(cell, 0) + 1
    if not cells:
        return "und", 0.0
    weights = {c: k * float(model.idf[c]) for c, k in cells.items()}
    norm = sum(w * w for w in weights.values()) ** 0.5
    cosines = [sum(w * float(m[c]) for c, w in weights.items()) / norm for m in model.centroids]
    best = max(range(len(cosines)), key=lambda j: (round(cosines[j], 6), -j))
    return model.langs[best], cosines[best]


def test_prediction_equals_plain_counting(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), row_key=F.col("doc_id"))
    some = docs.where("length(text) < 1500").orderBy("doc_id").limit(60).select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "a"), (-2, "Ünder größer 12 ß"), (-3, "?!"), (-4, None)], "doc_id long, text string")
    for r in langid.predict(some.union(extra), model).collect():
        lang, cosine = plain_prediction(r.text or "", model)
        assert r.lang_pred == lang and abs(r.score - min(1.0, cosine)) < 1e-4


def test_a_worker_holds_little_beside_its_batch(spark):
    texts = ["".join(random.Random(i).choices("abcdefgh ijk", k=2000)) for i in range(600)]
    langid.count_matrix(texts[:2])
    tracemalloc.start()
    for a, b in langid._chunks(texts):
        langid.count_matrix(texts[a:b])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    rows = pa.record_batch({"text": pa.array(texts)})
    parts = list(langid._small([rows]))
    assert max(p.num_rows for p in parts) <= langid._CHUNK_DOCS and pa.Table.from_batches(parts).column("text").to_pylist() == texts
