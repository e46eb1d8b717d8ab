from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import genotypes
from tablewright.operators.features import fit_pca
from tablewright.plans import genotype_queries
from tablewright.sources import genotype_text
from tablewright.workspace import scratch_path

HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\tC"
RECORDS = [
    "chr1\t100\t.\tA\tT\t.\t.\t.\tGT:DP\t0/0:7\t0|1:5\t1/1:9",
    "chr1\t205\t.\tAC\tG,T\t.\t.\t.\tGT\t./.\t1/2\t0/2",
]


def test_text_records(spark):
    path = scratch_path(spark, "vcf")
    spark.createDataFrame([("##fileformat=VCFv4.2",), (HEADER,), *[(r,) for r in RECORDS]], "value string").coalesce(1).write.text(path)
    rows = {(r["sample"], r.start): r for r in genotype_text.read_genotypes(spark, path).collect()}
    assert len(rows) == 6
    assert (rows["B", 99].alleles, rows["B", 99].end) == (["REF", "ALT"], 100)
    assert (rows["B", 204].alleles, rows["B", 204].end) == (["ALT", "OTHER_ALT"], 206)
    assert rows["A", 204].alleles == ["NO_CALL", "NO_CALL"]
    counts = {(r["sample"], r.variant): r.alt_count for r in genotype_text.sample_variants(genotype_text.read_genotypes(spark, path)).collect()}
    assert counts == {
        ("A", "chr1:99:100"): 0, ("B", "chr1:99:100"): 1, ("C", "chr1:99:100"): 2,
        ("A", "chr1:204:206"): 2, ("B", "chr1:204:206"): 2, ("C", "chr1:204:206"): 1,
    }


def written(spark, *files):
    paths = []
    for lines in files:
        paths.append(scratch_path(spark, "vcf"))
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(paths[-1])
    return paths


OTHER = [HEADER.rsplit("\t", 3)[0] + "\tD\tA", "chr2\t5\t.\tG\tC\t.\t.\t.\tGT\t1/1\t0/1"]


def test_files_with_different_samples_give_their_union(spark):
    paths = written(spark, [HEADER, *RECORDS], OTHER)
    got = genotype_text.sample_variants(genotype_text.read_genotypes(spark, paths)).collect()
    assert len(got) == 8
    assert {("D", "chr2:4:5", 2), ("A", "chr2:4:5", 1), ("A", "chr1:99:100", 0)} <= set(map(tuple, got))


def test_a_file_without_header_takes_the_only_list(spark):
    paths = written(spark, [HEADER], RECORDS)
    assert genotype_text.read_genotypes(spark, paths).count() == 6
    paths = written(spark, [HEADER], RECORDS, OTHER)
    spark.createDataFrame([(r,) for r in RECORDS], "value string").write.mode("append").text(paths[0])
    assert genotype_text.read_genotypes(spark, [paths[0], paths[2]]).count() == 8
    with pytest.raises(Exception, match="no sample list for"):
        genotype_text.read_genotypes(spark, paths).collect()


def test_two_lists_in_one_file_and_no_header_are_refused(spark):
    with pytest.raises(Exception, match="different sample lists within"):
        genotype_text.read_genotypes(spark, written(spark, [HEADER, *RECORDS, *OTHER])).collect()
    with pytest.raises(ValueError, match="no #CHROM line"):
        genotype_text.read_genotypes(spark, written(spark, RECORDS))


def test_records_of_other_lengths(spark):
    short, long = RECORDS[0].rsplit("\t", 1)[0], RECORDS[1] + "\t0/0"
    rows = genotype_text.read_genotypes(spark, written(spark, [HEADER, short, long])).collect()
    assert sorted((r["sample"], r.start) for r in rows) == [("A", 99), ("A", 204), ("B", 99), ("B", 204), ("C", 204)]


def test_panel_lines_split_on_tab_or_space(spark):
    path = scratch_path(spark, "panel")
    spark.createDataFrame([("s1\tGBR\tEUR",), ("s2 MXL",), ("s1\tGBR",), ("s2\tZZZ",), ("broken",)], "value string").write.text(path)
    panel = genotype_text.read_panel(spark, path)
    assert sorted(map(tuple, panel.collect())) == [("s1", "GBR"), ("s2", "MXL")]
    assert genotype_text.bad_panel_lines(spark, path).first().n == 1
    assert [r["sample"] for r in genotype_text.panel_samples(panel, ["MXL"]).collect()] == ["s2"]


@pytest.fixture(scope="module")
def calls(spark):
    """v0 to v9 in ten samples; v3 is missing in one of them, v4 is listed twice in another."""
    rows = [(f"s{s}", f"v{v}", (s + v) % 3) for s in range(10) for v in range(10) if (s, v) != (2, 3)]
    return spark.createDataFrame([*rows, ("s5", "v4", 0)], "sample string, variant string, alt_count int").cache()


def test_only_fully_called_variants_stay(calls):
    whole = {r.variant for r in genotypes.complete_variants(calls).collect()}
    assert whole == {f"v{v}" for v in range(10)} - {"v3"}
    assert genotypes.complete_variants(calls, min_call_rate=0.9).count() == 10


def test_repeated_calls_count_once(calls):
    f = {r.variant: r for r in genotypes.variant_frequency(calls).collect()}
    assert (f["v4"].n_samples, f["v4"].n_carriers) == (10, sum((s + 4) % 3 > 0 for s in range(10)))
    assert f["v3"].n_samples == 9


def test_frequency_range(calls):
    carriers = {v: sum((s + v) % 3 > 0 for s in range(10)) for v in range(10) if v != 3}
    kept = {r.variant for r in genotypes.filter_by_frequency(calls, 7, 7).select("variant").distinct().collect()}
    assert kept == {f"v{v}" for v, n in carriers.items() if n == 7}


@pytest.mark.parametrize("width", [65_535, 4, 1])
def test_vectors_in_blocks(calls, width):
    rows = genotypes.variant_vectors(calls, width).collect()
    assert max(len(r.counts) for r in rows) <= width
    for s in range(10):
        blocks = {r.block: list(r.counts) for r in rows if r["sample"] == f"s{s}"}
        want = [float((s + v) % 3) for v in range(10)]
        if s == 2:
            want[3] = 0.0
        assert [x for b in sorted(blocks) for x in blocks[b]] == want


def test_matrix_has_null_where_a_call_is_missing(calls):
    header = genotypes.variant_header(calls, 10)
    m = genotypes.variant_matrix(calls, header).where(F.col("sample") == "s2").first()
    assert header == [f"v{v}" for v in range(10)] and m.v3 is None and m.v4 == 0
    with pytest.raises(Exception, match="not in the header"):
        genotypes.variant_matrix(calls, ["v3", "v4"]).collect()
    with pytest.raises(ValueError, match="variant_vectors"):
        genotypes.variant_header(calls, 9)


@pytest.mark.parametrize("width", [65_535, 3])
def test_components_between_samples_are_those_of_the_variants(spark, calls, width):
    got = {r["sample"]: r.pcs for r in genotypes.sample_components(genotypes.variant_vectors(calls, width), 3).collect()}
    whole = genotypes.variant_vectors(calls).select("sample", array_to_vector("counts").alias("features"))
    rows = fit_pca(whole, 3).transform(whole).select("sample", vector_to_array("pcs").alias("p")).collect()
    names = [r["sample"] for r in rows]
    want = np.array([r.p for r in rows])
    want = want - want.mean(axis=0)
    assert np.allclose(np.abs([got[n] for n in names]), np.abs(want), atol=1e-6)


def test_population_clusters(spark, many_blocks):
    rows = [(f"s{s}", f"v{v:02d}", 2 if (s < 6) == (v < 10) else 0) for s in range(12) for v in range(20)]
    calls = spark.createDataFrame(rows, "sample string, variant string, alt_count int")
    samples = calls.select("sample").distinct()
    found = {r["sample"]: r.prediction for r in genotypes.population_clusters(calls, samples, 0.05, 0.95).collect()}
    assert len(found) == 12
    assert len({found[f"s{s}"] for s in range(6)}) == 1 and found["s0"] != found["s11"]
    with pytest.raises(ValueError, match="share of carriers"):
        genotypes.population_clusters(calls, samples, 0.6, 0.9)


def test_clusters_where_every_sample_carries_the_variants(spark):
    rows = [(f"s{s}", v, n) for s in range(12) for v, n in [("all", 2), ("none", 0), ("count", 2 if s < 6 else 1), ("some", int(s < 6))]]
    rows += [("s0", "count", 0), ("s3", "missing", 1)]
    calls = spark.createDataFrame(rows, "sample string, variant string, alt_count int")
    samples = calls.select("sample").distinct()
    assert {r.variant for r in genotypes.varying_calls(calls).collect()} == {"count", "some"}
    counted = calls.where("variant in ('all', 'count')")
    found = {r["sample"]: r.prediction for r in genotypes.population_clusters(counted, samples).collect()}
    assert len({found[f"s{s}"] for s in range(6)}) == 1 and found["s0"] != found["s11"] and len(found) == 12
    with pytest.raises(ValueError, match="no fully called variant"):
        genotypes.population_clusters(calls.where("variant in ('all', 'none')"), samples)


@pytest.mark.parametrize(("size", "n"), [("sf0.001", 6), ("sf0.1", 15)])
def test_population_queries_return_rows_at_every_size(spark, size, n):
    folder = f"/root/testdata/{size}"
    clusters = genotype_queries.population_clusters(spark, folder).collect()
    assert len(clusters) == n and {r.cluster for r in clusters} == {0, 1}
    assert genotype_queries.population_sweep(spark, folder).count() > 0


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_ranges_leave_rows_at_every_size(spark, size):
    folder = f"/root/testdata/{size}"
    kept = genotype_queries.filter_by_frequency(spark, folder)
    every = genotype_queries.views.genotype(spark, folder).select("variant").distinct().count()
    assert 0 < kept.select("variant").distinct().count() < every
    assert {r.cluster for r in genotype_queries.population_range_clusters(spark, folder).collect()} == {0, 1}


def test_population_queries_have_variants_when_every_cell_has_many_rare_lines(spark, tmp_path):
    """Lines repeated under other orders: every capped count is 2, the shares stay."""
    views = genotype_queries.views
    for name in ("part", "supplier", "nation", "region"):
        views.table(spark, "/root/testdata/sf0.01", name).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = views.table(spark, "/root/testdata/sf0.01", "lineitem")
    copies = lines.withColumn("l_orderkey", F.explode(F.sequence(F.col("l_orderkey"), F.col("l_orderkey") + 900_000, F.lit(100_000))))
    flat = copies.withColumns({"l_discount": F.lit(0.1), "l_quantity": F.lit(50.0)})
    # A few lines of every cell are rare already: with more of them only shares differ.
    flat.where("l_orderkey % 7 = 0").unionByName(copies).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert views.genotype(spark, str(tmp_path)).agg(F.min("alt_count")).first()[0] == 2
    assert {r.cluster for r in genotype_queries.population_clusters(spark, str(tmp_path)).collect()} == {0, 1}
    assert {r.cluster for r in genotype_queries.population_range_clusters(spark, str(tmp_path)).collect()} == {0, 1}
    assert genotype_queries.population_sweep(spark, str(tmp_path)).count() > 0
