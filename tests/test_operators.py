import random
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from snapmart.operators import aggregate, dims, lookup, quality, shape
from snapmart.sources import catalogs, files, manifest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- aggregates -----------------------------------------------------------------

def test_top_k_ignores_null_winner_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("n", None), ("c", 0.5)], "k string, v double")
    assert [r.k for r in aggregate.top_k(df, "v", ["k"], 3).collect()] == ["a", "b", "c"]


def test_top_n_others_against_brute_force(spark):
    rnd = random.Random(3)
    data = [(g, f"l{i:03d}", float(rnd.randint(0, 9))) for g in "xyz" for i in range({"x": 400, "y": 12, "z": 3}[g])]
    data.append(("z", None, 4.0))
    got = rows(aggregate.top_n_others(spark.createDataFrame(data, "g string, l string, v double"), ["g"], "l", "v", 10))
    want = []
    for g in "xyz":
        part = sorted((r for r in data if r[0] == g), key=lambda r: (-r[2], r[1] is None, r[1] or ""))
        want += [(g, r[1] or "Não informado", r[2]) for r in part[:10]]
        rest = sum(r[2] for r in part[10:])
        if rest > 0:
            want.append((g, "Outros", rest))
    assert got == sorted(want, key=repr)


def test_distributions_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.choice(["m", "f", None]), rnd.choice("abcdefghij")) for _ in range(500)]
    df = spark.createDataFrame(data, "s string, e string")
    got = {(r.group, r.category): r.quantity for r in aggregate.distributions(df, {"s": "sex", "e": "kind"}, {"kind": 3}).collect()}
    kinds = sorted(Counter(e for _, e in data).items(), key=lambda x: (-x[1], x[0]))[:3]
    want = {("sex", s): n for s, n in Counter(s for s, _ in data if s).items()} | {("kind", k): n for k, n in kinds}
    assert got == want


def test_detail_and_total(spark):
    df = spark.createDataFrame([("u", "o1", "p"), ("u", "o2", "p"), ("u", "o1", "q"), ("u", "o1", "q"), ("u", None, "r")], "u string, o string, p string")
    got = {(r.o, r.is_total): r.quantity for r in aggregate.detail_and_total_distinct(df, ["u"], "o", "p").collect()}
    assert got == {("o1", 0): 2, ("o2", 0): 1, (None, 0): 1, (None, 1): 3}


def test_side_by_side_and_distinct_values(spark):
    a, b = spark.range(3).agg(F.count("*").alias("n")), spark.range(0).agg(F.max("id").alias("m"))
    assert rows(aggregate.side_by_side(a, b)) == [(3, None)]
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "x string, y int")
    assert rows(aggregate.distinct_values(df, ["x", "y"])) == [("x", "a"), ("y", "1"), ("y", "2")]


def test_hot_group_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 1).alias("g"), "id")
    plan = aggregate.top_k_per_group(df, ["g"], [F.col("id")], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# ---- lookups --------------------------------------------------------------------

def test_translations(spark):
    known = lookup.lookup_from(spark, {"01": "one", "02": "two"})
    df = spark.createDataFrame([("01",), ("99",), (None,)], "c string")
    assert rows(lookup.translate_code(df, "c", F.col("c"), known)) == [("99",), ("one",), (None,)]
    assert rows(lookup.translate_inline(df, "c", F.col("c"), known)) == [("01 - one",), ("99",), (None,)]
    assert rows(lookup.add_description(df, "c", known, "t")) == [("01", "one"), ("99", None), (None, None)]
    pairs = lookup.lookup_from(spark, {("1", "01"): "a", ("2", "01"): "b"})
    both = spark.createDataFrame([("2", "01"), ("3", "01")], "g string, c string")
    assert rows(lookup.add_description_by_pair(both, "g", "c", pairs, "t")) == [("2", "01", "b"), ("3", "01", None)]


def test_repeated_lookup_keys_do_not_multiply_rows(spark):
    twice = spark.createDataFrame([("01", "b"), ("01", "a"), ("01", None), ("02", "c")], "code string, text string")
    df = spark.createDataFrame([("01",), ("02",), ("03",), (None,)], "c string")
    assert rows(lookup.translate_code(df, "c", F.col("c"), twice)) == [("03",), ("a",), ("c",), (None,)]
    assert rows(lookup.translate_inline(df, "c", F.col("c"), twice)) == [("01 - a",), ("02 - c",), ("03",), (None,)]
    assert rows(lookup.add_description(df, "c", twice, "t")) == [("01", "a"), ("02", "c"), ("03", None), (None, None)]
    pairs = spark.createDataFrame([("1", "01", "b"), ("1", "01", "a"), ("2", "01", "z")], "group string, code string, text string")
    both = spark.createDataFrame([("1", "01")], "g string, c string")
    assert rows(lookup.add_description_by_pair(both, "g", "c", pairs, "t")) == [("1", "01", "a")]


def test_empty_lookup_keeps_codes(spark):
    df = spark.createDataFrame([("01",)], "c string")
    assert rows(lookup.translate_code(df, "c", F.col("c"), lookup.lookup_from(spark, {}))) == [("01",)]


def test_unmatched_profile_keeps_ten_examples(spark):
    df = spark.range(50).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("c"))
    checks = {"c": ([F.col("c")], lookup.lookup_from(spark, {"00": "zero"}), ["code"])}
    r = lookup.unmatched_profile(df, checks).first()
    assert (r.unmatched_rows, r.unmatched_codes) == (49, 49)
    assert r.examples == [f"{i:02d}" for i in range(1, 11)]


def test_catalog_files(spark, tmp_path):
    (tmp_path / "cid.csv").write_bytes("SUBCAT;DESCRICAO;\nA00.1; Cólera ;\na001;Zebra;\n;x;\nB1;;\n".encode("latin-1"))
    assert rows(catalogs.disease_catalog(spark, str(tmp_path / "cid.csv"))) == [("A001", "Cólera")]
    (tmp_path / "cbo.csv").write_bytes("COD_OCUPACAO,Título\n3222-05,Enfermeiro\n51,\n".encode("latin-1"))
    assert rows(catalogs.occupation_catalog(spark, str(tmp_path / "cbo.csv"))) == [("322205", "Enfermeiro")]
    (tmp_path / "m.json").write_text('[{"id": 1100015, "nome": "Alta"}, {"id": 1100023, "nome": "Ari"}]')
    assert rows(catalogs.place_names(spark, str(tmp_path / "m.json"))) == [("110001", "Alta"), ("110002", "Ari")]
    with pytest.raises(ValueError):
        lookup.resolve_header(["x"], ["code"], [["cod"]])


# ---- shape ----------------------------------------------------------------------

def test_raw_text_writes_floats_out(spark):
    df = spark.createDataFrame([(12345678.0, 7, 0.5), (None, None, None)], "a double, b int, c double")
    assert rows(shape.raw_text(df, ["a", "b", "c", "d"])) == [("12345678", "7", "0.5", None), (None, None, None, None)]


def test_enforce_and_compare(spark):
    df = spark.createDataFrame([("x", " ")], "n string, t string")
    wanted = T.StructType.fromDDL("n bigint, t string, d date")
    assert rows(shape.enforce_schema(df, wanted, blanks_to_null=True)) == [(None, None, None)]
    assert shape.schema_diff(df, wanted) == {"extra": [], "missing": ["d"]}
    with pytest.raises(ValueError, match="missing"):
        shape.assert_schema(df, wanted, "t")
    assert shape.rename_aliases(df, {"n": "m", "t": "n"}).columns == ["m", "t"]
    legacy = spark.createDataFrame([(" a ", None)], "CNS string, other string")
    assert rows(shape.coalesce_columns(legacy, "person_id", ["person_id", "CNS"]).select("person_id")) == [("a",)]


# ---- quality --------------------------------------------------------------------

def test_primary_key(spark):
    good = spark.range(5)
    quality.assert_pk(good, ["id"], "t")
    bad = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id int")
    assert rows(quality.pk_report(bad, ["id"])) == [(4, 2, 2)]
    with pytest.raises(ValueError, match="2 null and 2 duplicate"):
        quality.assert_pk(bad, ["id"], "t")
    with pytest.raises(ValueError, match="no key column"):
        quality.assert_pk(good, ["key"], "t")
    assert rows(quality.pk_report(good.where("id > 9"), ["id"])) == [(0, 0, 0)]


def test_grain_and_reconcile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    assert rows(quality.grain_report(df, ["k", "v"])) == [(3, 1, 2)]
    want = spark.createDataFrame([("202501", 2), ("202502", 1)], "period string, row_count bigint")
    have = spark.createDataFrame([("202501", 3)], "period string, row_count bigint")
    exact = quality.reconcile(want, have, "period")
    assert rows(exact) == [("202501", 2, 3, False), ("202502", 1, 0, False)]
    with pytest.raises(ValueError, match="row counts differ"):
        quality.assert_reconciled(exact, "period", "t")
    assert rows(quality.reconcile(want, have, "period", at_least=True))[0][-1] is True


# ---- dimensions and files ---------------------------------------------------------

def test_place_dim(spark):
    df = spark.createDataFrame([("110001", "999999"), (None, "53")], "a string, b string")
    names = lookup.lookup_from(spark, {"110001": "Alta", "000053": "nan"})
    prefixes = spark.createDataFrame([("11", "RO", "Norte")], "code string, state string, region string")
    assert rows(dims.place_dim([(df, ["a", "b"])], names, prefixes)) == [
        ("000053", "Não Informado", "Exterior/Outros", "EX"),
        ("110001", "Alta", "Norte", "RO"),
        ("999999", "Não Informado", "Exterior/Outros", "EX"),
    ]


def test_period_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "202501"), (2, "202502")], "v int, period string")
    files.write_periods(df, path)
    files.write_periods(spark.createDataFrame([(9, "202502")], "v int, period string"), path)
    files.write_periods(df.where("v > 9"), path)  # nothing to write changes nothing
    assert rows(files.scan_periods(spark, path)) == [(1, "202501"), (9, "202502")]
    assert rows(files.scan_periods(spark, path, ["202501"])) == [(1, "202501")]
    assert files.discover_periods(spark, path) == ["202501", "202502"]
    with pytest.raises(ValueError):
        files.discover_periods(spark, str(tmp_path))
    assert files.read_or_empty(spark, str(tmp_path / "none"), df.schema).count() == 0
    assert files.read_table(spark, path, ["v", "w"]).columns == ["v"]
    with pytest.raises(ValueError, match="2 rows written"):
        files.verify_rows(files.read_table(spark, path), 3, T.StructType.fromDDL("v int"), "t")
    assert files.source_inventory(spark, path).count() == 2


def test_inventory_tells_files_of_one_name_apart(spark, tmp_path):
    """Files of two folders share a name; each is found by its own path, with its own rows."""
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, k string").coalesce(1).write.partitionBy("k").parquet(path)
    found = files.source_inventory(spark, path)
    assert found.select("name").distinct().count() == 1
    read = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).count()
    assert sorted(r["count"] for r in found.join(read, "path").collect()) == [1, 2]


def test_inventory_query_writes_every_table(spark, tmp_path):
    """Every table is written and inventoried: orders of two months and of none, suppliers, and no nation."""
    from registry import load_all

    d = str(tmp_path)
    spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'1996-01-02'), (2, timestamp_ntz'1996-02-02'), (3, NULL) AS t(o_orderkey, o_orderdate)").write.parquet(f"{d}/orders.parquet")
    spark.range(4).write.parquet(f"{d}/supplier.parquet")
    spark.range(0).write.parquet(f"{d}/nation.parquet")
    got = load_all().QUERIES["source_inventory"](spark, d).select("name", "row_count", "sized", "own_tags", "all_listed", "months")
    assert rows(got) == [("nation", 0, True, True, True, 0), ("orders", 3, True, True, True, 3), ("supplier", 4, True, True, True, 1)]


def test_named_files(spark, tmp_path):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    one.write.parquet(str(tmp_path / "raw_cnes_st_ac_202501.parquet"))
    one.drop("b").write.parquet(str(tmp_path / "raw_cnes_st_sp_202501.parquet"))
    one.write.parquet(str(tmp_path / "raw_cnes_st_sp_202502.parquet"))
    got = files.scan_named_files(spark, str(tmp_path), "raw_cnes_st", ["202501"])
    assert rows(got.select("a", "b", "state", "period")) == [(1, "x", "AC", "202501"), (1, None, "SP", "202501")]
    assert files.scan_named_files(spark, str(tmp_path), "raw_cnes_pf").count() == 0


def test_manifest(spark):
    months = spark.createDataFrame([("202501",)], "period string")
    plan = manifest.landing_manifest(months, manifest.text_list(["AC", "SP"]), manifest.source_list({"RD": "raw_sih_rd"}))
    assert [r[-1] for r in rows(plan)] == ["raw_sih_rd_ac_202501.parquet", "raw_sih_rd_sp_202501.parquet"]
    landed = spark.createDataFrame([("raw_sih_rd_ac_202501.parquet",)], "name string")
    assert manifest.not_landed(plan, landed).first().state == "SP"
    offers = spark.createDataFrame([("202501", "AC", "RDAC2.dbc"), ("202501", "AC", "RDAC1.dbc"), ("202501", "AC", "STAC1.dbc")], "period string, state string, name string")
    assert [r.file for r in manifest.choose_files(plan, offers).collect()] == ["RDAC1.dbc"]
