"""The listing in tasks against Spark's own file index, on a tree of odd names."""

import os
import pickle

import pytest
from pyspark.sql import functions as F

from slipflow.operators import reconcile
from slipflow.sources.inventory import landed_inventory
from slipflow.sources.landing import write_landing
from slipflow.sources.listing import LandedReader, is_listed, list_landed


def put(root, name, text="x"):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def tree(tmp_path):
    root = str(tmp_path / "land ing")
    for name, text in {"top.pdf": "abc", " 0 Marine/0 - 1_1_REF.pdf": "12345", " 0 Marine/1 - 2_1_REF.docx": "",
                       "dept=/a.pdf": "yy", "dept=x y/deep/er/still/b.PDF": "z" * 5000, "dept=x y/deep/c.pdf": "",
                       "é ü/日本.pdf": "q", "_hidden/no.pdf": "n", ".hidden/no.pdf": "n", "seen/_no.pdf": "n",
                       "seen/.no.pdf": "n", "seen/_k=v.pdf": "yes", "_k=v/d.pdf": "yes", "seen/e._COPYING_": "n",
                       "seen/100%.pdf": "p", "seen/a+b&c.pdf": "pp", "_SUCCESS": ""}.items():
        put(root, name, text)
    os.makedirs(os.path.join(root, "empty", "emptier"))
    return root


def rows(df):
    return sorted(tuple(r) for r in df.select("landing_path", "path", "length", "modificationTime").collect())


@pytest.mark.parametrize("suffix", [None, ".pdf", "pdf", ".nothing"])
@pytest.mark.parametrize("tasks", [1, 3, 1000])
def test_equal_to_sparks_index(spark, tree, suffix, tasks):
    got = list_landed(spark, tree, suffix, tasks)
    assert rows(got.where("length > 0")) == rows(landed_inventory(spark, tree, suffix))
    empty = {r["landing_path"] for r in got.where("length = 0").collect()}
    assert empty == {n for n in (" 0 Marine/1 - 2_1_REF.docx", "dept=x y/deep/c.pdf") if n.endswith(suffix or "")}
    assert [t for _, t in got.dtypes] == ["string", "string", "bigint", "timestamp"]


def test_file_address_and_slash(spark, tree):
    assert rows(list_landed(spark, f"file://{tree}/")) == rows(list_landed(spark, tree))


def test_driver_holds_folders_only(tmp_path):
    """What the driver makes of a tree is as large with two files a folder as with 300."""
    sizes = []
    for files in (2, 300):
        root = str(tmp_path / str(files).zfill(4))
        for d in range(20):
            for f in range(files):
                put(root, f"folder {d}/{f}.pdf")
        parts = LandedReader(root, "", 8).partitions()
        assert len(parts) == 9 and sorted(n for p in parts[1:] for n in p.names) == sorted(f"folder {d}" for d in range(20))
        sizes.append(len(pickle.dumps(parts)))
    assert sizes[0] == sizes[1]


def test_plan_has_a_partition_per_share_of_folders(spark, tree):
    assert list_landed(spark, tree, tasks=3).rdd.getNumPartitions() == 4  # the root's own files and three shares
    assert list_landed(spark, os.path.join(tree, "empty", "emptier")).count() == 0


def test_names():
    assert [is_listed(n) for n in ("a", ".a", "_a", "_a=b", "a._COPYING_", "a_b")] == [
        True, False, False, True, False, True]


def test_reconcile_with_listing(spark, tree):
    man = spark.createDataFrame([(" 0 Marine/0 - 1_1_REF.pdf", "Marine", 0), (" 0 Marine/9 - x.pdf", "Marine", 1)],
                                "landing_path string, DepartmentName string, record_num long")
    got = {r["record_num"]: r["status"] for r in reconcile.fetch_status(man, list_landed(spark, tree)).collect()}
    assert got == {0: "OK", 1: "FILE NOT FOUND"}
    assert list_landed(spark, tree).agg(F.sum("length")).first()[0] > 5000


def test_landed_departments_tells_suffixes_and_folders_apart(spark, tmp_path):
    """Without the suffix filter, or with the file index's view of folders, the numbers change."""
    from slipflow.operators import manifest
    key = {n: spark.range(1).select(manifest.department_key(F.lit(n))).first()[0] for n in ("A", "", "B")}
    root = str(tmp_path / "t")
    for name, text in {f"department_key={key['A']}/folder_num=0/x.txt": "abc", f"department_key={key['A']}/folder_num=0/y.txt": "d",
                       f"department_key={key['A']}/folder_num=1/x.json": "abcdef", f"department_key={key['']}/folder_num=7/z.txt": "",
                       f"department_key={key['']}/folder_num=7/_z.txt": "no"}.items():
        put(root, name, text)
    man = spark.createDataFrame([("A",), ("A",), ("",), ("C",)], "DepartmentName string")
    names = spark.createDataFrame([("A",), ("",), ("B",)], "DepartmentName string")
    other = list_landed(spark, root).where(~F.col("path").endswith(".txt"))
    got = lambda files: {tuple(r) for r in reconcile.landed_departments(man, names, files, other).collect()}
    want = {("A", 2, 1, 4, 1), ("", 1, 1, 0, 0), ("B", 0, 0, 0, 0)}
    assert got(list_landed(spark, root, ".txt")) == want
    assert got(list_landed(spark, root)) != want


def test_a_landing_folder_gets_one_file(spark, tmp_path):
    """However many tasks its rows come from; files of earlier calls stay, and lines are kept whole."""
    root = str(tmp_path / "t")
    lines = spark.range(200).repartition(8).selectExpr(
        "concat('d', id % 3) AS department_key", "id % 10 AS folder_num", "concat('é ', id) AS value")
    assert write_landing(lines, root, ".txt") == 30
    assert write_landing(lines.where("folder_num = 4"), root, ".json") == 3
    assert write_landing(lines.where("false"), root, ".txt") == 0
    assert list_landed(spark, root, ".txt").count() == 30 and list_landed(spark, root).count() == 33
    assert sorted(x for d, _, names in os.walk(root) for n in names if n.endswith(".txt")
                  for x in open(os.path.join(d, n), encoding="utf-8").read().split("\n")[:-1]) \
        == sorted(f"é {i}" for i in range(200))
    assert not [n for _, _, names in os.walk(root) for n in names if n.startswith(".")]


def test_landed_departments_writes_one_file_a_folder(spark):
    from slipflow.plans import catalog
    from slipflow.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    got = catalog.q_landed_departments(spark, "/root/testdata/sf0.01").agg(
        F.sum("landed_folders"), F.sum("other_folders")).first()
    root, = [n for n in set(os.listdir(base)) - before if n.startswith("landing-")]
    for suffix, folders in zip((".txt", ".json"), got):
        assert list_landed(spark, os.path.join(base, root), suffix).count() == folders > 0
