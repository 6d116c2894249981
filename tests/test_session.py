import pytest

from parley.functions import windows
from parley.session import staged, work_dir


class Session:
    """Just what the check of a missing folder looks at."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = self
        self.master = master


def test_a_cluster_needs_the_shared_folder():
    with pytest.raises(RuntimeError):
        work_dir(Session("spark://host:7077"), "x")


def test_work_dir_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (work_dir(spark, "x") for _ in range(2))
    assert first.startswith(f"{root}/x-") and first != second


def test_staged_tables_keep_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) s")
    copy = staged(df, "numbers")
    assert copy.dtypes == df.dtypes and sorted(copy.collect()) == sorted(df.collect())
    assert "Range" not in copy._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "text, seconds",
    [("60 seconds", 60), ("5 Seconds", 5), ("1 hour", 3600), ("2 days", 172800), ("1 week", 604800)],
)
def test_durations(text, seconds):
    assert windows.duration_seconds(text) == seconds


@pytest.mark.parametrize("text", ["", "5", "0 seconds", "1 month", "five minutes"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        windows.duration_seconds(text)


def test_pane_width():
    assert windows.pane_width("60 seconds", "5 seconds") == "5 seconds"
    assert windows.pane_width("50 seconds", "20 seconds") == "10 seconds"
