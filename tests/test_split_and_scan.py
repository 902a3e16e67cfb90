"""Deterministic splits and the strict CSV scan."""

from pyspark.sql import functions as F

from callcast.operators import split as SP
from callcast.sources.contacts import contacts
from callcast.sources.strict import scan_strict
from callcast.sources.tables import scan_contacts

from sf_dirs import SF


def test_stratified_split_exact_and_complete(spark):
    c = contacts(spark, SF)
    s = SP.stratified_split(c)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    sizes = {r.y: r["count"] for r in c.groupBy("y").count().collect()}
    for y, n in sizes.items():
        tr, va = int(n * 0.6 + 0.5), int(n * 0.8000000000000002 + 0.5)
        assert counts[(y, "train")] == tr
        assert counts[(y, "validation")] == va - tr
        assert counts[(y, "test")] == n - va
    checks = {r.check: r.passed for r in SP.split_integrity(SP.parts_of(s.select("contact_id", "split")), c).collect()}
    assert all(checks.values())
    # same split on a different partitioning
    again = SP.stratified_split(c.repartition(3))
    assert again.join(s, ["contact_id", "split"]).count() == c.count()


def test_kfold_balanced(spark):
    f = SP.kfold_assign(contacts(spark, SF), k=5, seeds=(42,))
    sizes = [r["count"] for r in f.groupBy("fold_42").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2


def test_scan_contacts_csv(spark, small_csv):
    df = scan_contacts(spark, small_csv)
    assert df.count() == 12
    assert [r.contact_id for r in df.orderBy("contact_id").collect()] == list(range(1, 13))
    assert df.where(F.col("job") == "unknown").count() == 1


def test_scan_strict_edge_rows(spark, tmp_path):
    header = "age,job,marital,education,default,balance,housing,loan,contact,day,month,duration,campaign,pdays,previous,poutcome,y"
    good = "30,admin.,married,secondary,no,100,yes,no,cellular,5,may,10,1,-1,0,unknown,no"
    lines = [
        header,
        good,
        good,  # exact duplicate: kept
        ",".join(good.split(",")[:16]),  # 16 fields
        good + ",extra",  # 18 fields
        good.replace(",100,", ",,"),  # blank balance -> skipped
        good.replace("admin.", ""),  # blank job -> skipped
        good.replace("30,", "abc,", 1),  # bad age -> quarantine
        good.replace(",100,", ", 120 ,"),  # spaces trimmed
        good.replace(",may,", ",foo,"),
        good.replace("admin.", '"admin, retired"'),  # quoted comma
    ]
    p = tmp_path / "edge.csv"
    p.write_text("\n".join(lines) + "\n")
    clean, quarantine = scan_strict(spark, str(p))
    assert clean.count() == 5
    assert clean.where(F.col("balance") == 120).count() == 1
    assert clean.where(F.col("job") == "admin, retired").count() == 1
    reasons = {r.reason: r["count"] for r in quarantine.groupBy("reason").count().collect()}
    assert reasons == {"width": 2, "bad_number": 1}
