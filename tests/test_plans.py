"""Physical plans: what is pushed, what is shuffled, and how skew is met."""

import pytest
from pyspark.sql import functions as F

from claimweave.checks.queries import QUERIES
from claimweave.operators import asof_join, drop_superseded_lines, joins, only_keys, stage
from claimweave.operators.broadcast import broadcast_if_small
from claimweave.operators.joins import lookup_join, spread_null_join
from claimweave.operators.ordering import ordered_join, split_points
from claimweave.plans import assemble, clinical, header, provider
from claimweave.plans.amounts import claim_amounts, line_sums
from claimweave.sources import Warehouse
from small import values


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def files(spark, folder, tmp_path_factory):
    """The sample warehouse written as parquet, as a real warehouse would be read."""
    from claimweave.sources.sample import sample_warehouse

    root = str(tmp_path_factory.mktemp("warehouse"))
    wh = sample_warehouse(spark, folder)
    for name in ("all_claim_fact", "all_claim_line_fact", "all_member_version_hist_fact",
                 "payment_fact_to_claim_fact", "payment_fact", "date_dimension"):
        wh[name].write.parquet(f"{root}/{name}")
    return Warehouse.from_files(spark, root)


def test_scan_reads_only_the_columns_in_use_and_gets_the_filters(files):
    plan = plan_of(files.live("payment_fact_to_claim_fact").groupBy("claim_fact_key").max("payment_fact_key"))
    assert "ReadSchema: struct<claim_fact_key:bigint,payment_fact_key:bigint,deleted_flag:string>" in plan
    window = files["all_claim_fact"].filter(F.col("claim_fact_key").between(1, 5)).select("claim_hcc_id")
    assert "GreaterThanOrEqual(claim_fact_key,1)" in plan_of(window)


def test_amounts_combine_before_the_shuffle_and_use_no_python(files, settings):
    settings(autoBroadcastJoinThreshold=-1)
    plan = plan_of(line_sums(drop_superseded_lines(files["all_claim_line_fact"])))
    assert "partial_sum" in plan and "LeftAnti" in plan
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_the_liability_is_made_from_the_sums_of_its_parts(spark):
    parts = "base_coinsurance_amount base_copay_amount base_deductible_amount".split()
    others = "billed_amount base_non_covered_amount base_allowed_amount base_paid_amount".split()
    rows = [(1, None, 2, 3), (1, 4, None, None), (2, None, None, None), (None, 1, 1, 1)]
    lines = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ("claim_fact_key", *parts))).withColumns(
        {c: F.col(c).cast("decimal(19,2)") for c in parts}
        | {c: (F.col("claim_fact_key") + n).cast("decimal(19,2)") for n, c in enumerate(others)}
    )
    sums = line_sums(lines)
    assert plan_of(sums).count("partial_sum") == 7
    found = values(sums, "claim_fact_key", "claim_coinsurance_amount", "claim_patient_liability_amount")
    assert found == [(None, 1, 3), (1, 4, 9), (2, None, 0)]


def test_a_professional_table_stages_its_own_claims_and_their_parts_before_the_wide_join(
    spark, folder, settings, monkeypatch
):
    from claimweave.sources.sample import sample_warehouse

    staged = {}

    def recorded(df, label):
        staged[label] = stage(df, label)
        return staged[label]

    monkeypatch.setattr(assemble, "stage", recorded)
    build = assemble.build_claims(sample_warehouse(spark, folder), "PAYER")
    rows = build.professional
    kinds = staged["header-professional"].select(F.upper("claim_type_name")).distinct().collect()
    assert [k[0] for k in kinds] == ["PROFESSIONAL"] and "header" not in staged
    assert staged["parts"].count() == staged["header-professional"].select("claim_fact_key").distinct().count()
    settings(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    plan = plan_of(rows)
    # No line, payment or diagnosis is read, and each staged table is met once.
    assert "l_linenumber" not in plan and plan.count("LeftOuter") <= 8
    assert build.header.count() > staged["header-professional"].count()


def test_newest_payment_is_reduced_before_any_join(files, settings):
    settings(autoBroadcastJoinThreshold=-1)
    plan = plan_of(clinical.latest_payment(files))
    assert "partial_max(payment_fact_key" in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["claim_details", "member_details", "rendering_provider",
                                  "cds_institutional", "extract_institutional"])
def test_no_python_and_no_pair_joins(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_a_hot_history_key_is_split_at_run_time(spark, settings):
    settings(
        autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor=2,
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    claims = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("claim_fact_key"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).alias("supplier_key"),
        F.lit(20230101).alias("statement_start_date_key"),
    )
    history = spark.range(997).select(
        F.col("id").alias("supplier_key"), F.lit("A").alias("supplier_status"),
        F.lit(19900101).alias("version_eff_date_key"), F.lit(99991231).alias("version_exp_date_key"),
        F.lit(None).cast("string").alias("deleted_flag"), F.lit("x").alias("name"),
    )
    joined = asof_join(claims, history, ("supplier_key", "supplier_key"), ["name"],
                       status="supplier_status")
    assert joined.count() == 60000
    final = joined.groupBy("claim_fact_key").count()
    final.collect()
    assert "skew=true" in plan_of(final)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_met_by_time_cells_give_the_same_rows(spark, how, monkeypatch):
    claims = spark.range(400).select(
        F.col("id").alias("c"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("k"),
        F.when(F.col("id") % 13 > 0, 19990000 + F.col("id") * 97).cast("int").alias("as_of"),
    )
    history = spark.range(300).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v"),
        (19980000 + F.col("id") * 111).cast("int").alias("version_eff_date_key"),
        F.when(F.col("id") % 9 == 0, 99991231).otherwise(19980500 + F.col("id") * 120).cast("int")
        .alias("version_exp_date_key"), F.lit(None).cast("string").alias("deleted_flag"),
    )
    found = []
    for many in (10**9, 20):
        monkeypatch.setattr(joins, "MANY_VERSIONS", many)
        found.append(asof_join(claims, history, ("k", "k"), ["v"], as_of="as_of", how=how, spread_by="c"))
    plain, cut = found
    assert cut.columns == plain.columns
    assert values(cut) == values(plain) and plain.count() > 400


def test_a_hot_key_is_met_in_linear_work(spark):
    """A key of 20,000 overlapping versions: pairs tested stay near the matches, and no cell is hot."""
    def key_of(days):
        return F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), days.cast("int")), "yyyyMMdd").cast("int")

    versions = spark.range(20_000).select(
        F.lit(7).alias("_key"), key_of(F.col("id") / 2).alias("_from"), F.col("id").alias("v"),
        F.when(F.col("id") % 500 == 0, 99991231).otherwise(key_of(F.col("id") / 2 + 5 + F.col("id") % 40)).alias("_to"),
    )
    claims = spark.range(200_000).select(
        F.col("id").alias("c"), F.lit(7).alias("k"), key_of(F.col("id") % 10_000).alias("as_of")
    )
    left, right = joins.time_cells(claims, versions, "k", "as_of", "c")
    assert right.count() <= 3.5 * versions.count()
    met = left.join(right, (left["k"] == right["_key"]) & (left["_cell"] == right["_in_cell"]))
    counts = met.agg(
        F.count(F.lit(1)).alias("tested"),
        F.count(F.when((F.col("_from") <= F.col("as_of")) & (F.col("as_of") < F.col("_to")), 1)).alias("kept"),
    ).first()
    assert counts["tested"] <= 4 * counts["kept"] and counts["kept"] > 5_000_000
    assert left.groupBy("_cell").count().agg(F.max("count")).first()[0] < 2_000


def test_null_keys_of_an_as_of_join_are_spread(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    claims = spark.range(4000).select(
        F.col("id").alias("claim_fact_key"), F.when(F.col("id") % 10 == 0, F.col("id") % 50).alias("k"),
        F.lit(20200101).alias("statement_start_date_key"),
    )
    history = spark.range(50).select(
        F.col("id").alias("k"), F.lit(19900101).alias("version_eff_date_key"),
        F.lit(99991231).alias("version_exp_date_key"), F.lit(None).cast("string").alias("deleted_flag"), F.lit("x").alias("v"),
    )
    joined = asof_join(claims, history, ("k", "k"), ["v"], how="left")
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000 / 3 and sum(sizes) == 4000


def test_null_keys_are_spread(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__enabled="false")
    left = spark.range(4000).select(F.col("id").alias("c"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"))
    right = spark.range(0, 4000, 8).select(F.col("id").alias("r"), F.lit("hit").alias("v"))
    joined = spread_null_join(left, right, ("k", "r"), "c")
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000 / 3
    assert values(joined.groupBy("v").count()) == [(None, 3500), ("hit", 500)]


def test_broadcast_needs_a_checked_size(spark, folder):
    derived = spark.read.parquet(f"{folder}/lineitem.parquet").crossJoin(spark.range(1))
    big = derived.select((F.col("l_orderkey") % 10).alias("k"))
    huge = big.unionAll(big).join(spark.range(20_000_000), F.col("k") == F.col("id")).select("k").distinct()
    assert "ResolvedHint" in broadcast_if_small(huge)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(huge, 5)._jdf.queryExecution().analyzed().toString()
    small = spark.read.parquet(f"{folder}/nation.parquet")
    assert broadcast_if_small(small) is small


def test_stage_writes_to_the_shared_folder(spark):
    df = spark.range(5)
    staged = stage(df, "numbers")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in name and "/claimweave/" in name for name in staged.inputFiles())
    assert values(staged) == values(df)


def ordered_pair(spark, parts):
    lines = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 41).otherwise((F.col("id") * 7919) % 97).alias("k"),
        F.when(F.col("id") % 50 != 1, (F.col("id") * 31) % 5003).alias("l"), F.col("id").alias("t"),
    )
    claims = spark.range(0, 90, 1, 3).select(
        F.col("id").alias("k"), F.concat(F.lit("c"), "id").alias("name"), (1 + F.col("id") % 2).alias("_copies")
    )
    points = split_points(lines.select("k", "l"), "k", "l", parts)
    return claims, lines, ordered_join(claims, lines, points, "k", "l", parts)


@pytest.mark.parametrize("parts", [1, 2, 8, 13])
def test_an_ordered_join_is_sorted_and_shuffles_each_side_once(spark, parts):
    claims, lines, joined = ordered_pair(spark, parts)
    plan = plan_of(joined)
    assert "rangepartitioning" not in plan and (parts == 1 or "passthrough" in plan)
    main = plan.split("Subquery", 1)[0]
    assert main.count("Sort [") <= 3
    rows = [(r.k, -1 if r.l is None else r.l) for r in joined.collect()]
    assert rows == sorted(rows)
    copies = claims.withColumn("_c", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
    wanted = lines.join(copies, "k").select("k", "l", "t", "name")
    assert values(joined.select("k", "l", "t", "name")) == values(wanted)


def test_an_ordered_join_cuts_a_hot_claim_and_holds_on_empty_sides(spark):
    claims, lines, joined = ordered_pair(spark, 12)
    sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < joined.count() / 6
    none = lines.limit(0)
    points = split_points(none.select("k", "l"), "k", "l", 4)
    assert ordered_join(claims, none, points, "k", "l", 4).count() == 0


def scanned(plan):
    """Rows that each table scan of a finished plan read."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return scanned(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return scanned(plan.plan())
    if plan.nodeName().startswith("Scan parquet"):
        return [plan.metrics().apply("numOutputRows").value()]
    return [n for i in range(plan.children().size()) for n in scanned(plan.children().apply(i))]


@pytest.fixture(scope="module")
def sorted_facts(spark, tmp_path_factory):
    """100,000 facts in ten files sorted by key, and eight keys of the second file."""
    root = str(tmp_path_factory.mktemp("facts"))
    facts = spark.range(100_000).select(F.col("id").alias("claim_fact_key"), (F.col("id") % 7).alias("v"))
    facts.repartitionByRange(10, "claim_fact_key").write.parquet(f"{root}/facts")
    keys = spark.range(11_000, 19_000, 1_000).select(F.col("id").alias("claim_fact_key"))
    keys.write.parquet(f"{root}/keys")
    return spark.read.parquet(f"{root}/facts"), spark.read.parquet(f"{root}/keys")


def test_chosen_keys_reach_the_scan_as_a_range(sorted_facts):
    facts, keys = sorted_facts
    chosen = only_keys(facts, keys)
    assert [r["claim_fact_key"] for r in sorted(chosen.collect())] == list(range(11_000, 19_000, 1_000))
    assert max(scanned(chosen._jdf.queryExecution().executedPlan())) < 25_000


def test_many_chosen_keys_thin_out_the_facts_before_their_shuffle(sorted_facts, settings):
    settings(
        autoBroadcastJoinThreshold=-1,
        optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold=0,
    )
    facts, keys = sorted_facts
    plan = plan_of(only_keys(facts, keys).groupBy("claim_fact_key").sum("v"))
    assert "might_contain" in plan and "LeftSemi" in plan


def test_each_fact_table_of_a_build_is_cut_to_the_chosen_keys(files, spark, settings):
    settings(autoBroadcastJoinThreshold=-1, optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold=0)
    keys = files["all_claim_fact"].filter("claim_fact_key < 40").select("claim_fact_key")
    chosen = (
        header.selected_claims(files, keys),
        clinical.latest_payment(files, keys),
        claim_amounts(files["all_claim_fact"], files, keys),
        provider.first_line_practitioner(files, keys),
    )
    for part in chosen:
        assert "might_contain" in plan_of(part)


@pytest.mark.parametrize("rows", [[], [(None,)], [(None,), (3,), (3,)]])
def test_no_keys_and_null_keys_choose_nothing(spark, rows):
    keys = spark.createDataFrame(rows, "claim_fact_key long")
    facts = spark.range(5).withColumnRenamed("id", "claim_fact_key")
    assert [r[0] for r in only_keys(facts, keys).collect()] == sorted({k for (k,) in rows if k})
    assert only_keys(facts, None) is facts


def test_narrow_claim_rows_are_the_headers_rows(spark, folder):
    from claimweave.sources.sample import sample_warehouse

    wh = sample_warehouse(spark, folder)
    assert values(header.claim_rows(wh), *header.ROW_KEYS) == values(
        header.claim_details(wh, "PAYER"), *header.ROW_KEYS
    )


def test_null_keys_of_large_lookups_are_dealt_out(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__enabled="false", shuffle__partitions=8)
    rows = spark.range(2000).selectExpr("id AS claim_fact_key", "CASE WHEN id % 10 = 0 THEN id END AS address")
    table = spark.range(0, 2000, 20).selectExpr("id AS postal_address_key", "'c' || id AS city", "'N' AS deleted_flag")
    joined = lookup_join(rows, table, ("address", "postal_address_key"), ["city"], spread_by="claim_fact_key")
    assert values(joined, "claim_fact_key", "city") == sorted(
        ((k, f"c{k}" if k % 20 == 0 else None) for k in range(2000)), key=lambda r: str(r[0])
    )
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 600
