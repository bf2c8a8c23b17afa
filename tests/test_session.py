import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from tidemark.session import new_folder, remove_folder, shared_folder

ROOT = Path(__file__).resolve().parent.parent


def session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{folder}-{master}"),
    )


def test_the_named_folder_is_used():
    named = session("hdfs://name/checkpoints/", "yarn")
    assert shared_folder(named) == "hdfs://name/checkpoints"


def test_folders_belong_to_the_application(spark):
    first, second = new_folder(spark, "lake"), new_folder(spark, "lake")
    assert first.startswith(f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}/lake-")
    assert first != second
    spark.range(3).write.parquet(first)
    remove_folder(spark, first)
    with pytest.raises(AnalysisException):
        spark.read.parquet(first)
    remove_folder(spark, second)
    with pytest.raises(ValueError, match="not a folder"):
        remove_folder(spark, shared_folder(spark))


def test_folders_are_gone_when_the_driver_ends(tmp_path):
    code = f"""
from tidemark.session import local_session, new_folder
spark = local_session(1, "end", {{"spark.checkpoint.dir": "{tmp_path}"}})
spark.range(3).write.parquet(new_folder(spark, "x"))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, capture_output=True)
    assert list((tmp_path / "tidemark").iterdir()) == []


def test_one_machine_gets_a_folder_of_its_own():
    local = session(None, "local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "spark://host:7077"))


def test_the_real_session_has_a_folder(spark):
    assert shared_folder(spark)
