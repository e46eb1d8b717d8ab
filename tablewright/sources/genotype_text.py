"""Population panels and variant-call text, parsed on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import alternate_count, string_key

# Fixed values of the variant-call text format.
FIXED_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
META_PREFIX = "##"
HEADER_PREFIX = "#CHROM"


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """(sample, population) from lines split on a tab or a space; later tokens are ignored.

    One row per sample: a repeated line counts once, and a sample with several populations
    belongs to the first of them by name.  ``bad_panel_lines`` counts what is no entry.
    """
    tokens = F.split("value", "[\t ]")
    return (
        spark.read.text(path)
        .filter(F.size(tokens) >= 2)
        .groupBy(tokens[0].alias("sample"))
        .agg(F.min(tokens[1]).alias("population"))
    )


def bad_panel_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n): lines with fewer than two tokens, which ``read_panel`` leaves out."""
    return spark.read.text(path).agg(F.count_if(F.size(F.split("value", "[\t ]")) < 2).alias("n"))


def panel_samples(panel: DataFrame, populations: list[str]) -> DataFrame:
    """Samples that belong to one of the chosen populations."""
    return panel.filter(F.col("population").isin(populations))


def _sample_lists(lines: DataFrame) -> DataFrame:
    """(file, samples) of each file with a header line; a file with two different lists fails."""
    headers = lines.filter(F.col("value").startswith(HEADER_PREFIX)).select(
        "file", F.split("value", "\t").alias("names")
    )
    start = len(FIXED_COLUMNS) + 1
    listed = headers.select("file", F.slice("names", start, F.size("names")).alias("samples"))
    one = F.min("samples") == F.max("samples")
    refused = F.raise_error(F.concat(F.lit("different sample lists within "), "file"))
    return listed.groupBy("file").agg(F.when(one, F.min("samples")).otherwise(refused).alias("samples"))


def read_genotypes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per called (sample, variant): sample, contig, start, end, alleles.

    Positions are zero-based and half-open.  Each call becomes a list of allele names:
    REF for 0, ALT for 1, OTHER_ALT for a higher number, NO_CALL for a dot.  The files may
    list different samples: each record takes the names of its own file, which stay a table
    joined to the records.  A file without a header line takes the list of the other files of
    its folder, or of all files, when those have one and the same, and fails otherwise; no
    header at all is an error.  A record
    with fewer calls than names lacks the last ones; calls beyond the names are left out.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lists = _sample_lists(lines)
    n_lists, only = lists.agg(F.count("*") > 0, F.min("samples") == F.max("samples")).first()
    if not n_lists:
        raise ValueError(f"{path} has no {HEADER_PREFIX} line")
    fields = F.split("value", "\t")
    records = lines.filter(~F.col("value").startswith("#")).select(
        "file",
        fields[0].alias("contig"),
        (fields[1].cast("bigint") - 1).alias("start"),
        F.length(fields[3]).alias("ref_length"),
        F.slice(fields, len(FIXED_COLUMNS) + 1, F.size(fields)).alias("calls"),
    )
    if only:
        named = records.withColumn("samples", lists.agg(F.min("samples")).scalar())
    else:
        folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
        shared = lists.groupBy(folder).agg(
            F.when(F.min("samples") == F.max("samples"), F.min("samples")).alias("folder_samples")
        )
        missing = F.raise_error(F.concat(F.lit("no sample list for "), "file"))
        named = (
            records.withColumn("folder", folder)
            .join(lists, "file", "left")
            .join(shared, "folder", "left")
            .withColumn("samples", F.coalesce("samples", "folder_samples", missing))
        )
    calls = named.select(
        "contig",
        "start",
        (F.col("start") + F.col("ref_length")).alias("end"),
        "samples",
        F.posexplode(F.slice("calls", 1, F.size("samples"))).alias("position", "call"),
    )
    genotype = F.split(F.split("call", ":")[0], "[/|]")
    return calls.select(
        F.get("samples", F.col("position")).alias("sample"),
        "contig",
        "start",
        "end",
        F.transform(
            genotype,
            lambda a: F.when(a == "0", "REF")
            .when(a == "1", "ALT")
            .when(a == ".", "NO_CALL")
            .otherwise("OTHER_ALT"),
        ).alias("alleles"),
    )


def sample_variants(genotypes: DataFrame) -> DataFrame:
    """Reduce genotype records to (sample, variant, alt_count)."""
    return genotypes.select(
        "sample",
        string_key("contig", "start", "end").alias("variant"),
        alternate_count("alleles").cast("int").alias("alt_count"),
    )


def write_genotypes(calls: DataFrame, samples: list[str], path: str) -> str:
    """Write (contig, pos, sample, alt_count 0 to 2) as variant-call text.

    A record line holds one call per sample, so ``samples`` is the known sample list;
    the records are written in parallel, after the header line's own file.
    """
    spark = calls.sparkSession
    call = (
        F.when(F.col("alt_count") == 0, "0/0").when(F.col("alt_count") == 1, "0/1").otherwise("1/1")
    )
    # A record gathers its calls as one map, so the plan does not widen with the samples.
    wide = calls.groupBy("contig", "pos").agg(
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct("sample", call.alias("call"))))).alias("calls")
    )
    names = F.split(F.lit("\t".join(samples)), "\t")
    cells = F.transform(names, lambda s: F.coalesce(F.try_element_at("calls", s), F.lit("./.")))
    fixed = [F.lit(v) for v in (".", "A", "T", ".", ".", ".", "GT")]
    records = wide.select(
        F.concat_ws("\t", "contig", F.col("pos").cast("string"), *fixed, F.array_join(cells, "\t")).alias("value")
    )
    head = [(META_PREFIX + "fileformat=VCFv4.2",), ("\t".join([*FIXED_COLUMNS, *samples]),)]
    spark.createDataFrame(head, "value string").coalesce(1).write.text(path)
    records.write.mode("append").text(path)
    return path
