"""Queries on tables with larger keys than the given ones have."""


import __spark_entry__ as entry


def supplier(spark, root, numbers):
    rows = [(n, f"Supplier#{n:09d}", 0, 0.0) for n in numbers]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{root}/supplier.parquet")
    return str(root)


def test_names_of_more_digits_have_no_capture(spark, tmp_path):
    got = entry.queries()["e07_like_capture"](spark, supplier(spark, tmp_path, [7, 999, 1000])).collect()
    assert {r.s_suppkey: r.digits for r in got} == {7: "007", 999: "999", 1000: ""}


def test_sizes_near_a_tie_are_not_rounded_twice(spark):
    from decimal import ROUND_HALF_EVEN, Decimal

    from custodia.functions import items

    ns = [7 * 286023**2, 7 * 858069**2, 2**63 - 1, 1024**3 + 5 * 1024**3 // 1000, 3 * 2**27, 1024 + 128, 10 * 1024**3 + 2**27, *(7 * k * k for k in range(12384, 12400))]
    got = spark.createDataFrame([(n,) for n in ns], "n long").select("n", items.human_size("n").alias("h"), items.size_gb_text("n").alias("gb"), items.size_kb_text("n").alias("kb")).collect()
    text = lambda n, unit, step: str((Decimal(n) / unit).quantize(Decimal(step), ROUND_HALF_EVEN))
    for r in got:
        power = 3 if r.n >= 1024**3 else 2 if r.n >= 1024**2 else 1
        assert r.h == f"{text(r.n, 1024**power, '0.01')} {('', 'KB', 'MB', 'GB')[power]}"
        assert (r.gb, r.kb) == (text(r.n, 1024**3, "0.001"), text(r.n, 1024, "0.01"))


def test_suppliers_of_more_digits_are_in_scope_by_all_nine(spark, tmp_path):
    got = entry.queries()["p01_in_scope"](spark, supplier(spark, tmp_path, [6, 999, 1000, 1001])).collect()
    assert {r.s_suppkey: (r.key, r.in_scope) for r in got} == {6: ("006", True), 999: ("999", False), 1000: ("000001000", True), 1001: ("000001001", False)}


def test_manifests_are_compared_by_tasks_of_bounded_rows(spark, monkeypatch):
    from custodia.operators import integrity

    monkeypatch.setattr(integrity, "TASK_ROWS", 100, raising=False)
    name = "concat('20240101_', lpad(id, 6, '0'), '.wav')"
    base = spark.range(2000)
    manifest = base.where("id % 7 > 0").selectExpr("concat('s', id % 3) AS site", f"{name} AS name", "id AS bytes", "'' AS kb_text")
    entries = base.where("id % 5 > 0").selectExpr("concat('s', id % 3) AS site", "concat('s', id % 3, '_2024_01_01') AS archive", f"{name} AS name", "id + CAST(id % 11 = 0 AS INT) AS bytes")
    archives = entries.select("site", "archive").distinct().selectExpr("site", "archive", "true AS recorded")
    problems = integrity.manifest_problems(manifest, entries, archives)
    want = {}
    for i in range(2000):
        code = "missing" if i % 7 and not i % 5 else "extra" if i % 5 and not i % 7 else "size_differs" if i % 5 and i % 7 and not i % 11 else None
        if code:
            want[f"s{i % 3}", code] = want.get((f"s{i % 3}", code), 0) + 1
    assert {(r.site, r.code): r.n for r in problems.collect()} == want
    assert "REPARTITION_BY_NUM" in problems._jdf.queryExecution().toString()
