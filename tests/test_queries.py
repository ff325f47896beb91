import pytest

import __spark_entry__ as entry_points
from harness.compare import differences
from harness.registry import all_queries


def test_every_query_states_its_result():
    assert set(all_queries()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.fixture
def default_session(spark):
    """The session with none of this package's settings that Spark has otherwise."""
    ours = {key: spark.conf.get(key) for key in ("spark.sql.caseSensitive", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.caseSensitive", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    for key, value in ours.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_its_sql(default_session, sf_dir, name):
    spark = default_session
    df = entry_points.queries()[name](spark, sf_dir)
    assert differences(df, sf_dir, entry_points.oracle_sql()[name]) is None


def test_stages_are_built_once_by_many_threads(spark, sf_dir):
    from concurrent.futures import ThreadPoolExecutor

    from harness import trips

    built = []
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(
            lambda _: trips._once(spark, sf_dir, "thread-test", lambda: built.append(1) or object()), range(2)
        ))
    assert len(built) == 1 and results[0] is results[1]


@pytest.mark.parametrize("master, local", [
    ("local[4]", True), ("local", True), ("local-cluster[3,2,900]", False), ("yarn", False),
])
def test_scratch_needs_a_shared_folder_on_a_cluster(master, local):
    from types import SimpleNamespace

    from farestar.session import scratch_folder

    settings = {}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )
    if local:
        assert "/x-" in scratch_folder(session, "x")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(session, "x")
    settings["spark.checkpoint.dir"] = "hdfs://shared/"
    assert scratch_folder(session, "x").startswith("hdfs://shared/x-")


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4621
