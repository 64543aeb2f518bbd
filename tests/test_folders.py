"""Folders and files listed inside tasks: hidden names, empty folders, any number of parts."""

from conftest import rows

from treeledger.sources import folders


def test_listing(spark, tmp_path):
    for folder, name in [("A16a - 5 MW", "x.xlsx"), ("A16a - 5 MW", "_y.xlsx"), (".hidden", "z.xlsx"), ("B17a", "n.txt")]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"12345")
    (tmp_path / "empty").mkdir()
    (tmp_path / "top.xlsx").write_bytes(b"1")
    one = rows(folders.list_folders(spark, str(tmp_path), parts=1), "folder_name", "file_name", "length")
    many = rows(folders.list_folders(spark, str(tmp_path), parts=7), "folder_name", "file_name", "length")
    assert one == many == sorted(
        [("A16a - 5 MW", "_y.xlsx", 5), ("A16a - 5 MW", "x.xlsx", 5), (".hidden", "z.xlsx", 5), ("B17a", None, None), ("empty", None, None)],
        key=repr,
    )
    paths = [r.path for r in folders.list_folders(spark, str(tmp_path)).where("path is not null").collect()]
    assert all(p.startswith("file://") and p.endswith(".xlsx") for p in paths)
    plots = spark.createDataFrame([("A-16A", "p1"), ("B-17A", "")], "k_plot string, PROJECT_ID string")
    status = folders.folder_status(folders.empty_folders(folders.list_folders(spark, str(tmp_path))), plots)
    assert rows(status) == [("B17a", "no_project"), ("empty", "folder_name")]
