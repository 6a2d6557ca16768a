"""A contract holding a third of all documents: only it takes the split numbering, results equal
the plain window, and the rank-1 aggregation agrees."""

from pyspark.sql import functions as F

from slipflow.config import FIXTURE
from slipflow.operators import priority
from slipflow.plans.catalog import registry

SF = "/root/testdata/sf0.01"
HOT = 3  # customer 3 is a master policy (code P) whose contract passes the date filter


def hot_registry(spark):
    reg = registry(spark, SF)
    third = F.col("DocumentID") % 3 == 0  # reassign (never drop) a third of the documents
    docs = (reg.docs.withColumn("RootObjectID", F.when(third, F.lit(HOT).cast("long"))
                                .otherwise(F.col("RootObjectID")))
            .withColumn("RootObjectCode", F.when(third, F.lit("P")).otherwise(F.col("RootObjectCode"))))
    return reg.with_tables(docs=docs)


def ranks(df):
    rows = df.select("DocumentID", "DocumentFileURL", "RootObjectID", "DocumentPriorityOrdinal").collect()
    out = {(r["DocumentID"], r["DocumentFileURL"], r["RootObjectID"]): r["DocumentPriorityOrdinal"] for r in rows}
    assert len(out) == len(rows)
    return out


def test_hot_contract_is_split_and_exact(spark):
    reg = hot_registry(spark)
    p = priority.rank_input(priority.prioritised_documents(reg, FIXTURE))
    sizes = p.groupBy(*priority.CONTRACT_KEYS).count().orderBy(F.desc("count")).take(2)
    assert sizes[0]["RootObjectID"] == HOT and sizes[0]["count"] > 10 * sizes[1]["count"]

    want = ranks(priority.rank_documents(p, strategy="window"))
    auto = priority.rank_documents(p, single_task_rows=sizes[1]["count"], **priority.ranking_parts(reg, FIXTURE))
    plan = auto._jdf.queryExecution().optimizedPlan().toString()
    assert "_pos" in plan and "Union" in plan   # hot rows split (staged slices), rest plain
    # the cold rows' anti-join with the table of hot groups lies below the contract join; no key is inlined
    lines = auto._jdf.queryExecution().optimizedPlan().toString().splitlines()
    anti = next(i for i, ln in enumerate(lines) if "Join LeftAnti" in ln)
    contract = next(i for i, ln in enumerate(lines) if "Join Inner" in ln and "ObjectID" in ln)
    assert contract < anti and lines[contract].index("Join") < lines[anti].index("Join")
    assert " INSET " not in plan and not any("xxhash64" in ln and " IN (" in ln for ln in lines)
    assert ranks(auto) == want
    assert ranks(priority.rank_documents(p, strategy="split", num_slices=16)) == want

    first = {d for d, r in want.items() if r == 1}
    key = lambda r: (r["DocumentID"], r["DocumentFileURL"], r["RootObjectID"])
    assert {key(r) for r in priority.best_document(p).collect()} == first
    assert {key(r) for r in priority.best_documents(hot_registry(spark), FIXTURE).collect()} == first


def test_hot_contract_is_measured_and_reduced_before_the_contract_join(spark):
    """Neither the measuring nor the rank-1 aggregation stands on the contract join."""
    reg = hot_registry(spark)
    keys, shared = priority.contract_sizes(reg, FIXTURE)
    p = priority.rank_input(priority.prioritised_documents(reg, FIXTURE))
    real = {tuple(r[:2]): r[2] for r in p.groupBy(*priority.CONTRACT_KEYS).count().collect()}
    counted = {tuple(r[:2]): r[2] for r in keys.groupBy(*priority.CONTRACT_KEYS).count().collect()}
    weight = {tuple(r[:2]): r[2] for r in shared.collect()}
    assert all(counted[k] * weight.get(k, 1) >= n for k, n in real.items())
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    want = ranks(priority.rank_documents(p, strategy="window"))
    got = priority.rank_documents(p, single_task_rows=40, measured=lambda: (keys, shared))
    assert ranks(got) == want
    best = priority.best_documents(reg, FIXTURE)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, ln in enumerate(best) if "Join Inner" in ln and "ContractCode" in ln]
    limits = [i for i, ln in enumerate(best) if "WindowGroupLimit" in ln]
    assert joins and limits and min(joins) < min(limits)  # the limits lie below the join


def test_references_split_hot_keys(spark):
    """Semi-join to repeated references: plain exchanges on both sides. Policy flags: a frequent
    name is joined under many salts, each document once."""
    from slipflow.operators import selection
    reg = registry(spark, SF)
    sel = selection.selected_documents(reg, FIXTURE, ordered=False)
    refs = reg.master_policy.select("UniqueMarketRef")
    plan = selection.filter_by_reference(sel, refs.unionByName(refs), FIXTURE)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text and "Aggregate" not in text.split("LeftSemi")[1].split("master")[0][:200]
    assert plan.exceptAll(selection.filter_by_reference(sel, refs, FIXTURE)).count() == 0
    docs = reg.docs.withColumn("DocumentName", F.when(F.col("DocumentID") % 3 == 0, F.lit("POL 3"))
                               .otherwise(F.col("DocumentName")))
    flagged = priority.policy_ref_flags(reg, docs, FIXTURE)
    assert flagged.count() == docs.count()
    hot = flagged.where("DocumentName = 'POL 3'")
    assert hot.where("NOT IsPolicyRef OR IsPolicyRef IS NULL").count() == 0
    assert flagged.where("DocumentName IS NULL AND IsPolicyRef IS NOT NULL").count() == 0


def test_policy_references_are_not_broadcast(spark):
    """The references stand once a salt, which Spark's estimate does not see: no broadcast of them,
    neither planned nor from the sizes of the run."""
    reg = registry(spark, SF)
    flagged = priority.policy_ref_flags(reg, reg.docs, FIXTURE)
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_registry_row_bound(spark):
    from slipflow.sources.fixtures import fixture_registry
    reg = fixture_registry(spark, "/root/testdata/sf0.001")
    once = reg.with_tables(divisions=reg.divisions.where("Server NOT LIKE 'http://alt%'"))
    assert priority.registry_row_bound(once, FIXTURE) == reg.docs.count()     # keys unique: fan-out 1
    assert priority.registry_row_bound(reg, FIXTURE) == 2 * reg.docs.count()  # division 1 matches twice
    bos = reg.business_objects.unionByName(reg.business_objects.where("ObjectCode = 'P'"))
    doubled = reg.with_tables(business_objects=bos)                           # code P twice
    assert priority.registry_row_bound(doubled, FIXTURE) == 8 * reg.docs.count()  # divisions x lookup x contracts


def test_manifest_with_every_department_hot(spark):
    """At scale every department is hot: the manifest then comes from the split plan only."""
    from slipflow.operators import manifest, selection
    sel = selection.selected_documents(registry(spark, SF), FIXTURE, ordered=False)
    plain = manifest.batch_manifest(sel, 10, strategy="window")
    hot = manifest.batch_manifest(sel, 10, single_task_rows=5, num_slices=12)
    plan = hot._jdf.queryExecution().optimizedPlan().toString()
    assert "_pos" in plan and "row_number" not in plan.split("_pos")[0]  # no second branch
    assert plain.count() > 500 and plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_one_duplicated_contract_makes_no_other_hot(spark):
    """A key with many contracts is hot by its own product; contracts without duplicates are not."""
    from slipflow.operators.numbering import heavy_groups
    rows = spark.range(3000).select((F.col("id") % 100).alias("g"))  # 30 rows each
    weights = spark.createDataFrame([(7, 1000), (8, 2), (999, 50)], "g long, _weight long")
    hot, groups, n = heavy_groups(rows, ["g"], 100, 3000, weights)
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert [tuple(r) for r in hot.collect()] == [(want, 30_000)] and (groups, n) == (1, 30_000)


def test_sketch_misses_no_heavy_group(spark):
    """Groups above the bound among far more small ones, in any order and many partitions."""
    import random

    from slipflow.operators.numbering import heavy_groups
    rng = random.Random(2)
    sizes = {f"h{i}": rng.randint(201, 400) for i in range(20)} | {f"b{i}": rng.randint(150, 200) for i in range(30)}
    values = [k for k, n in sizes.items() for _ in range(n)] + [f"s{i}" for i in range(20_000)] + [None] * 500
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "g string").repartition(13)
    hot, groups, n = heavy_groups(df, ["g"], 200, len(values))
    named = {r[0]: r[1] for r in df.select(F.xxhash64("g"), "g").distinct().collect()}
    assert {named[r[0]]: r[1] for r in hot.collect()} == {k: c for k, c in sizes.items() if c > 200} | {None: 500}
    assert (groups, n) == (21, 500 + sum(c for c in sizes.values() if c > 200))
    none, groups, n = heavy_groups(df.limit(0), ["g"], 200, 0)
    assert none.collect() == [] and (groups, n) == (0, 0)


def test_best_document_under_summer_time(spark):
    """01:30 does not exist in London on 28 March 2021, and comes before 02:15 all the same."""
    import datetime as dt

    from helpers import CFG, doc, registry
    cfg = CFG.with_(created_before=dt.datetime(2030, 1, 1))
    docs = [doc(1, "MRC", created=dt.datetime(2021, 3, 28, 1, 30)), doc(2, "MRC", created=dt.datetime(2021, 3, 28, 2, 15)),
            doc(3, "MRC", created=dt.datetime(2021, 3, 28, 0, 59)), doc(4, "MRC"), doc(5, "Scan")]
    docs += [doc(6, "MRC", root=102, created=None) | {"CreateDate": None}, doc(7, "MRC", root=102)]
    policies = [dict(PolicyID=i, PolicyRef=f"P{i}", UniqueMarketRef="U", InceptionDate=dt.date(1998, 1, 1), DepartmentID=1,
                     SubDepartmentID=1) for i in (100, 102)]
    reg = registry(spark, docs, master_policy=policies)
    for zone in ("UTC", "Europe/London", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            p = priority.rank_input(priority.prioritised_documents(reg, cfg))
            first = {r["DocumentID"] for r in priority.rank_documents(p).where("DocumentPriorityOrdinal = 1").collect()}
            assert {r["DocumentID"] for r in priority.best_documents(reg, cfg).collect()} == first
            assert {r["DocumentID"] for r in priority.best_document(p).collect()} == first and 2 in first
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_best_documents_sort_no_wide_rows(spark):
    """No SortAggregate; what is ranked over all documents carries neither paths nor URLs."""
    reg = registry(spark, SF)
    plan = priority.best_documents(reg, FIXTURE)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    exchanges = [ln for ln in plan.splitlines() if "Window" in ln and "rank(" in ln and "row_number" not in ln]
    assert exchanges and not any("DocumentFileURL" in ln or "LibraryPath" in ln for ln in exchanges)
